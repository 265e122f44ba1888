"""Keyed results: upsert, outer merge, complete groups, nesting and unnesting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEYS = ["theorem", "attempt_key"]


def upsert(old: DataFrame, new: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """New rows, and old ones that no new row replaces."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"))


def merge_outer(raw: DataFrame, lean: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """raw and lean texts by key; a missing side is empty."""
    both = raw.select(*keys, "raw").join(lean.select(*keys, "lean"), keys, "full_outer")
    return both.select(*keys, F.coalesce("raw", F.lit("")).alias("raw"), F.coalesce("lean", F.lit("")).alias("lean"))


def complete_groups(results: DataFrame, n: int, key: str = "theorem") -> DataFrame:
    """Results of the groups that have n or more; incomplete ones are dropped."""
    full = results.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= n).select(key)
    return results.join(full, key, "left_semi")


def pending(theorems: DataFrame, done: DataFrame) -> DataFrame:
    """Theorems that are not in the done-set."""
    return theorems.join(done.select("name").distinct(), "name", "left_anti")


def done_counts(models: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Of every model the size of its done-set (0 where there is none)."""
    n = checkpoint.distinct().groupBy(F.col("model").alias("_m")).agg(F.count("*").alias("total_done"))
    return models.select("name", "ord").join(n, F.col("name") == F.col("_m"), "left").select("name", "ord", F.coalesce("total_done", F.lit(0)).alias("total_done"))


def nest(results: DataFrame, value: str) -> DataFrame:
    """theorem and attempts: a map from attempt keys (by bytes) to one of the texts."""
    entries = F.array_sort(F.collect_list(F.struct("attempt_key", value)))
    return results.groupBy("theorem").agg(F.map_from_entries(entries).alias("attempts"))


def document(results: DataFrame, model: str, value: str, pretty: bool = True) -> DataFrame:
    """One row: the JSON document {model: {theorem: {attempt: text}}}.

    An export for results of one model that fit a string: it is one value, of 2 GB
    at most, made in one task. The default sink is rows.
    """
    by_name = lambda a, b: F.when(a["theorem"] < b["theorem"], -1).when(a["theorem"] > b["theorem"], 1).otherwise(0)
    inner = nest(results, value).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("theorem", "attempts")), by_name)).alias("d"))
    return inner.select(F.to_json(F.create_map(F.lit(model), "d"), {"pretty": str(pretty).lower()}).alias("document"))


def documents(results: DataFrame, model: str, value: str, part: Column) -> DataFrame:
    """The JSON documents {model: {theorem: {attempt: text}}}, one for each theorem and part of its results."""
    entries = F.array_sort(F.collect_list(F.struct("attempt_key", value)))
    attempts = results.groupBy("theorem", part.alias("_part")).agg(F.map_from_entries(entries).alias("attempts"))
    return attempts.select(F.to_json(F.create_map(F.lit(model), F.create_map("theorem", "attempts"))).alias("document"))


def unnest(documents: DataFrame, model: str, column: str = "document", leaves: str = "drop") -> DataFrame:
    """theorem, attempt_key and value of the texts under a model.

    leaves: "drop" leaves out values that are no strings (resume), "empty" keeps
    them as empty texts (re-extraction). A missing model gives no rows.
    """
    theorem = documents.select(F.parse_json(column).alias("v")).lateralJoin(documents.sparkSession.tvf.variant_explode_outer(F.try_variant_get(F.col("v").outer(), f"$['{model}']", "variant")))
    theorem = theorem.select(F.col("key").alias("theorem"), F.col("value").alias("t")).where("theorem is not null")
    leaf = theorem.lateralJoin(documents.sparkSession.tvf.variant_explode(F.col("t").outer())).select("theorem", F.col("key").alias("attempt_key"), "value")
    text = F.when(F.schema_of_variant("value") == "STRING", F.try_variant_get("value", "$", "string"))
    leaf = leaf.where("attempt_key is not null").select("theorem", "attempt_key", text.alias("value"))
    return leaf.where("value is not null") if leaves == "drop" else leaf.withColumn("value", F.coalesce("value", F.lit("")))


def skip(df: DataFrame, n: int, order: str) -> DataFrame:
    """Rows behind the first n by the order column (distinct values). The first ones are found by a top-n in each partition; no order over all rows is made."""
    if n < 1:
        return df
    last = df.orderBy(order).limit(n).agg(F.max(order).alias("_last"))  # one row
    return df.join(F.broadcast(last), F.col(order) > F.col("_last")).drop("_last")


def numbered(df: DataFrame, column: str, lead: int = 8) -> DataFrame:
    """Distinct texts of a column with their place in order, from 1.

    Texts are dealt by their first characters and numbered within those; the
    places before come from the counts of the leads, so the window over all rows
    sees one row for each lead.
    """
    rows = df.select(column).distinct().withColumn("_lead", F.substring(column, 1, lead))
    counts = rows.groupBy("_lead").agg(F.count("*").alias("_n"))
    before = counts.select(F.col("_lead").alias("_l"), (F.sum("_n").over(Window.orderBy("_lead")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_lead").orderBy(column))
    return rows.withColumn("_own", own).join(before, F.col("_lead") == F.col("_l")).select(column, (F.col("_before") + F.col("_own")).alias("place"))


def file_stem(name: str) -> str:
    """SQL text of a name that is safe in file names."""
    return f"replace(replace({name}, '/', '_'), ' ', '_')"
