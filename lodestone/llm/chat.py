"""Chat formatting by quotation linking.

Messages of a conversation are put in order (turn, role, text). The lines of a
message have a quote level (their leading `>` marks); runs of lines of one level
are its passages, and each passage and each of its lines is normalised (letters
and digits in lower case) and hashed. A quoted passage links to the latest
earlier message of its conversation whose own (unquoted) text has that passage;
it is found by a window over (conversation, hash) in which originals come before
quotes, so there is one row out for each row in, whatever repeats. A message's
parent is what its outermost, first linked quote quotes; without a linked quote
it is the message before it. Depth counts replies from the first message, and
the conversation's reply order is (depth, message order), in which each message
follows its parent. Texts come out without quotes and the lines that announce
them.

Depths: messages that follow the one before form runs, and a run's messages need
only the depth of its head, which pointer jumping finds in logarithmic rounds.
Null texts count as empty, null turns come last, rows with a null conv_id are
one conversation, and repeated rows are messages of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

_MARKS = r"^((?:[ \t]{0,3}>)+) ?"
_ANNOUNCES = r"^\s*(?:On\b.{0,200}\bwrote|Am\b.{0,200}\bschrieb.{0,80}|Le\b.{0,200}\ba écrit|El\b.{0,200}\bescribió)\s?:\s*$"


def normal(passage: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(passage), r"[^\p{L}\p{N}]+", " "))


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def ordered(messages: DataFrame) -> DataFrame:
    """conv_id, seq (from 0), turn, role and text, null text as empty."""
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn("seq", (F.row_number().over(w) - 1).cast("long"))


def passages(rows: DataFrame) -> DataFrame:
    """conv_id, seq, line (where it begins), level, whole (passage or single line) and hash of every passage and line with letters or digits."""
    lines = rows.select("conv_id", "seq", F.posexplode(F.split("text", "\r?\n")).alias("line", "value"))
    lines = lines.select("conv_id", "seq", "line", level(F.col("value")).alias("level"), normal(F.regexp_replace("value", _MARKS, "")).alias("value"))
    by_line = Window.partitionBy("conv_id", "seq").orderBy("line")
    new = (F.lag("level", 1, -1).over(by_line) != F.col("level")) | (F.lag("value", 1, "").over(by_line) == "")
    lines = lines.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(by_line)).where("value <> ''")
    runs = lines.groupBy("conv_id", "seq", "level", "run").agg(F.min("line").alias("line"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), " ").alias("value"))
    both = runs.select("conv_id", "seq", "line", "level", F.lit(0).alias("part"), "value").unionByName(lines.select("conv_id", "seq", "line", "level", F.lit(1).alias("part"), "value"))
    return both.select("conv_id", "seq", "line", "level", "part", F.xxhash64("value", F.length("value")).alias("hash"))


def links(rows: DataFrame) -> DataFrame:
    """conv_id, seq, line, level, part and original (seq of the quoted message or null) of each quoted passage."""
    quoting = rows.where(F.col("text").rlike(r"(?m)^[ \t]{0,3}>")).select(F.col("conv_id").alias("c")).distinct()
    found = passages(rows.join(quoting, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi"))
    w = Window.partitionBy("conv_id", "hash").orderBy("seq", F.col("level").desc(), "line", "part").rowsBetween(Window.unboundedPreceding, -1)
    own = F.last(F.when(F.col("level") == 0, F.col("seq")), ignorenulls=True).over(w)
    return found.withColumn("original", own).where("level > 0")


def threads(rows: DataFrame) -> DataFrame:
    """rows with n_quotes, n_linked, parent (seq) and depth."""
    found = links(rows)
    first = F.min(F.when(F.col("original").isNotNull(), F.struct("level", "line", "part", "original")))["original"]
    quotes = found.groupBy("conv_id", "seq").agg(F.count_if(F.col("part") == 0).alias("n_quotes"), F.count_if((F.col("part") == 0) & F.col("original").isNotNull()).alias("n_linked"), first.alias("quoted"))
    q = quotes.select(F.col("conv_id").alias("c"), F.col("seq").alias("s"), "n_quotes", "n_linked", "quoted")
    rows = rows.join(q, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("seq") == F.col("s")), "left").drop("c", "s")
    rows = rows.withColumn("parent", F.when(F.col("seq") > 0, F.coalesce("quoted", F.col("seq") - 1)))
    head = (F.col("seq") == 0) | (F.col("parent") != F.col("seq") - 1)
    w = Window.partitionBy("conv_id").orderBy("seq")
    rows = rows.withColumn("head", F.max(F.when(head, F.col("seq"))).over(w)).drop("quoted")
    rows = written(rows, "messages")

    # heads that reply to an earlier message than the one before: up is the head of the run they reply into
    heads = rows.where("head = seq and seq > 0").select(F.col("conv_id").alias("c"), "seq", "parent")
    into = rows.select("conv_id", F.col("seq").alias("p"), F.col("head").alias("up"))
    jump = heads.join(into, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("parent") == F.col("p"))).select("c", "seq", "up", (F.col("parent") - F.col("up") + 1).alias("depth"))
    jump = written(jump, "heads")
    while jump.where("up > 0").limit(1).count():
        far = jump.select(F.col("c").alias("c2"), F.col("seq").alias("s2"), F.col("up").alias("up2"), F.col("depth").alias("depth2"))
        jump = jump.join(far, F.col("c").eqNullSafe(F.col("c2")) & (F.col("up") == F.col("s2")), "left")
        jump = written(jump.select("c", "seq", F.coalesce("up2", "up").alias("up"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth")), "heads")
    depth = jump.select("c", F.col("seq").alias("h"), F.col("depth").alias("at"))
    rows = rows.join(depth, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("head") == F.col("h")), "left")
    return rows.withColumn("depth", F.coalesce("at", F.lit(0)) + F.col("seq") - F.col("head")).drop("c", "h", "at", "head")


def unquoted(text: Column) -> Column:
    """The text without quoted lines and the lines that announce them, trimmed."""
    lines = F.split(text, "\r?\n")
    keep = F.filter(lines, lambda v, k: (level(v) == 0) & ~(v.rlike(_ANNOUNCES) & (level(F.coalesce(F.get(lines, k + 1), F.lit(""))) > 0)))
    quoted = text.rlike(r"(?m)^[ \t]{0,3}>")
    return F.when(quoted, F.regexp_replace(F.array_join(keep, "\n"), r"^\s+|\s+$", "")).otherwise(text)


def reply_ordered(messages: DataFrame) -> DataFrame:
    """One row for each message: conv_id, position in reply order, turn, role, text without quotes, parent_turn, depth, n_quotes, n_linked."""
    rows = threads(ordered(messages))
    turns = rows.select(F.col("conv_id").alias("c"), F.col("seq").alias("s"), F.col("turn").alias("parent_turn"))
    rows = rows.join(turns, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("s")), "left")
    w = Window.partitionBy("conv_id").orderBy("depth", "seq")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("conv_id", F.row_number().over(w).cast("long").alias("position"), "turn", "role", unquoted(F.col("text")).alias("text"), "parent_turn", "depth", zero("n_quotes"), zero("n_linked"))
