"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the SKETCH least distinct 64-bit hashes of a
text's shingles (SHINGLE words; a shorter text is one shingle; no words: an empty
sketch). Sketches of parts merge into that of the whole, and two sketches
estimate resemblance, containment and distinct shingle counts. Null text counts
as empty; two empty sketches resemble each other fully, an empty one and another
not at all. In ``compare`` the order of documents is descending by id, null ids
last, rows with one id by text; each row is a document of its own. Very long
texts only have more shingles, an empty table gives an empty one, and columns
other than doc_id and text are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Hashes kept: the standard error of a resemblance r is sqrt(r * (1 - r) / SKETCH).
SKETCH = 128
#: Words in a shingle.
SHINGLE = 5
#: Documents in a bucket of neighbours, about; and buckets, at most.
BUCKET_ROWS = 2000
MAX_BUCKETS = 1 << 16


def let(value: Column, body) -> Column:
    """body(value) with value computed once (a lambda's variable is never inlined)."""
    return F.transform(F.array(value), body)[0]


def sketch(text: Column, k: int = SKETCH, n: int = SHINGLE) -> Column:
    """The sketch of a text."""

    def shingles(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(n))))
        return F.when(F.size(w) >= n, many).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), "")
    return F.slice(F.sort_array(F.array_distinct(let(words, shingles))), 1, k)


def merge(a: Column, b: Column, k: int = SKETCH) -> Column:
    """The sketch of two parts' union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SKETCH) -> Column:
    """The estimated share of common shingles among all of both."""
    some = let(merge(a, b, k), lambda u: F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(some)


def distinct_count(a: Column, k: int = SKETCH) -> Column:
    """The estimated number of distinct shingles; exact for a sketch that is not full."""
    fraction = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / fraction)


def containment(a: Column, b: Column, k: int = SKETCH) -> Column:
    """The estimated share of a's shingles that b has too (1 for an empty a)."""
    common = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_count(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as a string (base64 of its big-endian hashes); equal sketches give equal strings."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")))


def with_next(df: DataFrame, columns: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with next_<column>: the columns of the row that follows by descending id; after the last comes the first.

    Ties go by text; null ids come last. Rows are dealt by id quantiles into
    buckets that a window goes through one by one; each bucket also gets a copy
    of the row that follows its last one, so no order over all rows is needed.
    """
    rows = df.count()
    parts = max(1, min(MAX_BUCKETS, rows // BUCKET_ROWS))
    cuts: list[int] = []
    if parts > 1:
        fractions = [k / parts for k in range(1, parts)]
        cuts = sorted(set(df.agg(F.percentile_approx(doc_id, fractions, max(10000, 4 * parts))).first()[0] or []))
    of = F.lit(0)
    if cuts:
        bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")  # folded into one literal
        steps = [1 << s for s in range(len(cuts).bit_length() - 1, -1, -1)]
        of = F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda a, s: F.when((a + s <= len(cuts)) & (F.get(bounds, a + s - 1) < F.col(doc_id)), a + s).otherwise(a),
        )
    df = df.withColumn("_next_bucket", F.when(F.col(doc_id).isNull(), F.lit(-1)).otherwise(of))
    order = Window.orderBy(F.col("_next_bucket").desc())  # over one row for each bucket
    heads = df.groupBy("_next_bucket").agg(F.max(doc_id).alias("_next_head"))
    follows = heads.select(
        F.col("_next_bucket").alias("_next_for"),
        F.when(F.row_number().over(Window.orderBy("_next_bucket")) == 1, F.first("_next_head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).otherwise(F.lead("_next_head").over(order)).alias("_next_head"),
    )
    # at most MAX_BUCKETS + 1 rows of two numbers
    extra = df.join(F.broadcast(follows), F.col(doc_id).eqNullSafe(F.col("_next_head"))).drop("_next_head", "_next_bucket").withColumnRenamed("_next_for", "_next_bucket")
    both = df.withColumn("_next_extra", F.lit(0)).unionByName(extra.withColumn("_next_extra", F.lit(1)))
    w = Window.partitionBy("_next_bucket").orderBy("_next_extra", F.col(doc_id).desc_nulls_last(), text)
    out = both.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
    return out.where("_next_extra = 0").drop("_next_extra", "_next_bucket")


def edited(n_chars: Column, text: Column, following: Column) -> Column:
    """The text with its last floor(n/2) code points replaced by the first as many of the following one."""
    half = F.floor(n_chars / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n_chars - half), F.substring(following, F.lit(1), half))


def compare(docs: DataFrame) -> DataFrame:
    """The contract's columns for documents."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("sketch", sketch(F.col("text")))
    pairs = with_next(own, ["text", "sketch"]).withColumn("n_chars", F.length("text"))
    pairs = pairs.withColumn("edited_text", edited(F.col("n_chars"), F.col("text"), F.col("next_text")))
    pairs = pairs.select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), sketch(F.col("edited_text")).alias("edited_sketch"))
    return pairs.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
