"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def _state(edges: DataFrame) -> tuple:
    """Tells whether two sets of links differ, from sums alone."""
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node) of every node in the links a-b, as a written table.

    Links may come in any direction and more than once. Each step is a
    pre-aggregated minimum and a join, written to the shared folder, so neither
    a hub nor a lost executor needs more than a task's share (the minima are
    written, too, so that the join may split a hub's rows); a step's tables go when
    the next one stands.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), "links")
        low = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        small = written(small.where("a <> b").distinct(), "links")
        dropped(edges, large, least, low)
        edges = small
        after = _state(edges)
        if after == before:
            break
        before = after
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    found = written(found, "components")
    dropped(edges)
    return found
