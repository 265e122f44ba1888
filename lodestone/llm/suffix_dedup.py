"""Suffix-array dedup: blockwise suffix sorting with a difference cover.

A byte goes when a string of LENGTH bytes that covers it also starts anywhere
else in the corpus. Every suffix (cut to LENGTH bytes, its window) is dealt to a
bucket by its content: by the least hash of the GRAM-byte strings in it, the
leftmost on ties, so equal windows share a bucket whatever document they are in.
Neighbouring windows with one anchor are one row, so a bucket table has a row for
about each (LENGTH - GRAM) / 2 bytes. Buckets with a single row cannot repeat
and fall away; rows with equal bytes are one class, repeated as a whole.

The classes of the other buckets are sorted, one group of buckets at a time: by
their first V bytes, and longer ties by the precomputed ranks of cover samples.
The samples are the positions whose residue modulo V lies in a difference cover,
so for any two suffixes some offset below V leads both to samples, whose ranks
decide. Ranks of samples come from prefix doubling in steps of V over the
samples only, so memory is bounded by the group's bytes. In that order equal
windows are neighbours. A bucket with very many classes is split by the distance of window
and anchor, which is the same in equal windows; of one with still more, windows of
one distance are counted by their hash, so that no task needs all of them.

Null text counts as empty and keeps nothing; texts shorter than LENGTH are
never touched, and very long ones are hashed in pieces that overlap. Repeated
rows (same id and text) are repeats of each other; rows that share only the id,
and rows with null ids, are documents of their own. An empty table gives an
empty one, and columns other than doc_id and text are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BYTE64, dropped, mix, powers, ship, slices, tidy, utf8, written

#: Bytes of a string that must not start twice.
LENGTH = 400
#: Bytes of the strings among which a window's anchor is the least.
GRAM = 128
#: The period of the difference cover.
V = 32
#: Bytes of contexts sorted together, about; and the longest piece of a document hashed at once.
GROUP_BYTES = 4 << 20
PIECE = 1 << 20


def difference_cover(v: int) -> np.ndarray:
    """A set of residues whose differences are all residues: 0..r-1 and every r-th after."""
    r = math.isqrt(v - 1) + 1
    return np.array(sorted({*range(r), *(k * r - 1 for k in range(2, v // r + 2) if k * r - 1 < v), v - 1}))


COVER = difference_cover(V)
IN_COVER = np.isin(np.arange(V), COVER)
#: The least offset that leads two residues into the cover.
OFFSET = np.array([[next(d for d in range(V) if IN_COVER[(a + d) % V] and IN_COVER[(b + d) % V]) for b in range(V)] for a in range(V)])


def anchors(raw: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Rows of windows: document number, first and last window start, anchor, bucket and content hash (positions in raw)."""
    n = len(raw)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    p, q = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE64[raw] * p[:n], out=sums[1:])
    grams = mix((sums[gram:] - sums[:-gram]) * q[: n - gram + 1])
    low = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    w, have = length - gram + 1, 1
    while have * 2 <= w:
        low = np.minimum(low[: len(low) - have], low[have:])
        have *= 2
    low = np.minimum(low[: len(low) - (w - have)], low[w - have :]) if w > have else low
    anchor = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    doc = np.searchsorted(ends, np.arange(len(anchor)), "right") - 1
    start = np.flatnonzero(np.arange(len(anchor)) + length <= ends[doc + 1])
    if not len(start):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    a = anchor[start]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(new)
    lo, hi = start[first], start[np.append(first[1:], len(start)) - 1]
    content = mix((sums[hi + length] - sums[lo]) * q[lo] + (hi - lo).astype(np.uint64))
    return doc[lo], lo, hi, a[first], grams[a[first]], content


def row_key() -> Column:
    """Tells texts apart: equal only for the same id and text."""
    return F.xxhash64("doc_id", "text")


ROWS = T.StructType([T.StructField(c, T.LongType(), False) for c in ("bucket", "content", "row", "lo", "hi", "anchor")])


def suffix_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The bucket table; docs: row and text."""

    def run(batches):
        for b in slices(batches, "text", 1 << 20):
            raw, ends = utf8(b.column("text"))
            keys = b.column("row").to_numpy(zero_copy_only=False)
            if len(raw) <= PIECE:
                pieces = [(raw, ends, keys, 0)]
            else:  # long documents: pieces that overlap by length - 1 bytes, one window in one piece
                pieces = []
                for k, (s, e) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                    for at in range(s, max(s + 1, e - length + 1), PIECE):
                        part = raw[at : min(e, at + PIECE + length - 1)]
                        pieces.append((part, np.array([0, len(part)]), keys[k : k + 1], at - s))
            for part, bounds, own, shift in pieces:
                doc, lo, hi, a, bucket, content = anchors(part, bounds, length, gram)
                base = bounds[doc] - shift
                if len(doc):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket.view(np.int64), content.view(np.int64), own[doc], lo - base, hi - base, a - base)], ROWS.names)

    return docs.select("row", "text").mapInArrow(tidy(run), ROWS)


def dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 1 of rows of keys, the first key weighing most."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def repeated_windows(contexts: list[bytes], groups: np.ndarray, length: int) -> list[np.ndarray]:
    """Of each context, whether each window also occurs at another place in its group.

    The windows are suffixes cut to length; they are sorted by the first V bytes
    and then by ranks of cover samples.
    """
    pad = bytes(V)
    text = np.frombuffer(b"".join(x for c in contexts for x in (c, pad)), np.uint8)
    size = np.array([len(c) for c in contexts], np.int64)
    base = np.cumsum(size + V) - size - V
    n_windows = size - length + 1
    owner = np.repeat(np.arange(len(contexts)), n_windows)
    pos = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + base[owner]
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(8, np.uint8)]), 8)

    def lead(at: np.ndarray) -> list[np.ndarray]:
        """The first V bytes at each position, as big-endian numbers."""
        return [np.ascontiguousarray(words[np.minimum(at + k, len(text))]).view(">u8").ravel().astype(np.uint64) for k in range(0, V, 8)]

    # ranks of the samples, by prefix doubling in steps of V
    place = np.arange(len(text))
    end = np.repeat(base + size, size + V)
    sample = place[IN_COVER[place % V] & (place < end)]
    left = end[sample] - sample
    rank = np.zeros(len(text) + 2 * length + 2 * V, np.int64)  # 0: past the end of a context
    rank[sample] = dense(*lead(sample), np.minimum(left, V))
    step = V
    while step < length:
        follow = np.where(left > step, rank[sample + step], 0)
        rank[sample] = dense(rank[sample], follow)
        step *= 2

    # by the first V bytes within each group, then ties by samples
    tie = dense(groups[owner], *lead(pos))
    order = np.argsort(tie, kind="stable")
    sorted_pos, sorted_tie = pos[order], tie[order]
    count = np.bincount(sorted_tie)
    slots = np.flatnonzero(count[sorted_tie] > 1)
    group = sorted_tie[slots].copy()
    who = order[slots]
    final = order.copy()
    while len(slots):
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        many = np.diff(np.append(first, len(group)))
        at = pos[who]
        pivot = np.repeat(at[first + many // 2], many)
        d = OFFSET[at % V, pivot % V]
        side = np.sign(rank[at + d] - rank[pivot + d])
        number = np.repeat(np.arange(len(first)), many) * 3 + side + 1
        new = np.argsort(number, kind="stable")
        who, number, side = who[new], number[new], side[new]
        final[slots] = who
        size_of = np.bincount(number)
        keep = (side != 0) & (size_of[number] > 1)
        slots, who, group = slots[keep], who[keep], number[keep]

    again = np.zeros(len(pos), bool)
    near = np.flatnonzero(sorted_tie[1:] == sorted_tie[:-1])
    rows = np.lib.stride_tricks.sliding_window_view(text, length)
    for k in range(0, len(near), 1 << 15):
        x, y = final[near[k : k + (1 << 15)]], final[near[k : k + (1 << 15)] + 1]
        same = (rows[pos[x]] == rows[pos[y]]).all(1)
        again[x[same]] = again[y[same]] = True
    return np.split(again, np.cumsum(n_windows)[:-1])


RANGES = T.ArrayType(T.StructType([T.StructField("lo", T.LongType(), False), T.StructField("hi", T.LongType(), False)]), False)
FOUND = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("content", T.LongType()), T.StructField("from", T.LongType()), T.StructField("ranges", RANGES)])


def sort_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """bucket, content, from (first window) and the ranges of repeated windows after it of each context."""

    def flush(rows: list[tuple]):
        ids: dict[tuple, int] = {}
        groups = np.array([ids.setdefault(r[:2], len(ids)) for r in rows], np.int64)
        out = []
        for r, again in zip(rows, repeated_windows([r[4] for r in rows], groups, length)):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], again.astype(np.int8), [0]])))
            if len(edge):
                out.append((r[0], r[2], r[3], [{"lo": s, "hi": e - 1} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))))], FOUND.names)

    def run(batches):
        rows, total, last = [], 0, None
        for batch in batches:
            for b in slices(iter([batch]), "bytes", 1 << 20):
                for r in zip(*[b.column(c).to_pylist() for c in ("bucket", "part", "content", "from", "bytes")]):
                    if total >= GROUP_BYTES and r[:2] != last:
                        yield from flush(rows)
                        rows, total = [], 0
                    rows.append(r)
                    total += len(r[4])
                    last = r[:2]
        if rows:
            yield from flush(rows)

    dealt = contexts.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    return dealt.select("bucket", "part", "content", "from", "bytes").mapInArrow(tidy(run), FOUND)


def contexts_of(docs: DataFrame, need: DataFrame, length: int) -> DataFrame:
    """bucket, part, content, from and bytes of each window range from..to of a row that need names."""
    wanted = need.groupBy("row").agg(F.collect_list(F.struct("bucket", "part", "content", "lo", "from", "to")).alias("wanted"))  # at most the windows of a text
    one_each = docs.join(wanted, "row").select("row", F.col("text").cast("binary").alias("bytes"), "wanted").dropDuplicates(["row"])
    cut = F.expr("substring(bytes, cast(c.from + 1 as int), cast(c.to - c.from as int) + " + str(length) + ")")
    return one_each.select("bytes", F.explode("wanted").alias("c")).select("c.bucket", "c.part", "c.content", (F.col("c.from") - F.col("c.lo")).alias("from"), cut.alias("bytes"))


def equal_windows(contexts: DataFrame) -> DataFrame:
    """FOUND of contexts that are one window each: those whose bytes stand in another one of their bucket and part, by counts of hashes."""
    hashed = written(contexts.select("bucket", "part", "content", "from", F.xxhash64("bytes").alias("window")), "windows")
    several = written(hashed.groupBy("bucket", "part", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "windows")
    range_ = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi")))
    return hashed.join(several, ["bucket", "part", "window"], "left_semi").select("bucket", "content", "from", range_.alias("ranges"))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """row and windows, the array of ranges of repeated window starts, as a written table; docs: row and text."""
    every = written(suffix_rows(docs, length, gram), "suffixes")
    # the buckets are written first, so that the join may split a frequent one's rows
    shared = written(every.groupBy("bucket").agg(F.count("*").alias("rows")).where("rows > 1").select("bucket"), "shared")
    table = written(every.join(shared, "bucket", "left_semi"), "buckets")
    dropped(every, shared)
    classes = table.groupBy("bucket", "content").agg(F.count("*").alias("n"), F.min(F.struct("row", "lo", "hi", "anchor")).alias("one"))
    classes = written(classes, "classes")
    several = classes.groupBy("bucket").agg(F.count("*").alias("classes"), F.count_if(F.col("n") == 1).alias("single")).where("classes > 1 and single > 0")
    w = length - gram + 1
    # buckets of more than a group's bytes are split by the distance of window and anchor; of those of more than w groups each window stands alone
    groups = F.ceil(F.col("classes") * (length + w // 2) / F.lit(GROUP_BYTES))
    parts = F.least(F.lit(w), F.greatest(F.lit(1), groups)).cast("int")
    several = written(several.select("bucket", parts.alias("parts"), (groups > w).alias("alone")), "several")
    need = classes.join(several, "bucket").select("bucket", "content", "n", "one.*", "parts", "alone")
    need = need.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    nearest, farthest = F.floor(F.col("part") * w / F.col("parts")), F.floor((F.col("part") + 1) * w / F.col("parts")) - 1
    need = need.withColumns({"from": F.greatest("lo", F.col("anchor") - farthest), "to": F.least("hi", F.col("anchor") - nearest)}).where("from <= to")
    found = sort_buckets(contexts_of(docs, need.where("not alone"), length), length)
    if not several.where("alone").isEmpty():
        found = found.unionByName(equal_windows(contexts_of(docs, need.where("alone"), length)))
    found = written(found, "sorted")
    dropped(several)
    moved = F.transform("ranges", lambda r: F.struct((r["lo"] + F.col("from")).alias("lo"), (r["hi"] + F.col("from")).alias("hi")))
    ranges = found.select("bucket", "content", moved.alias("ranges")).groupBy("bucket", "content").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    verdict = classes.join(ranges, ["bucket", "content"], "left").where("n > 1 or ranges is not null").select("bucket", "content", F.col("n").alias("copies"), "ranges")
    verdict = written(verdict, "verdict")
    dropped(classes, found)
    hits = table.join(verdict, ["bucket", "content"])
    whole = F.array(F.struct(F.col("lo"), F.col("hi")))
    moved = F.transform("ranges", lambda r: F.struct((r["lo"] + F.col("lo")).alias("lo"), (r["hi"] + F.col("lo")).alias("hi")))
    hits = hits.select("row", F.when(F.col("copies") > 1, whole).otherwise(moved).alias("ranges"))
    windows = written(hits.groupBy("row").agg(F.flatten(F.collect_set("ranges")).alias("windows")), "windows")
    dropped(table, verdict)
    return windows


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, removed (array of spans of bytes, end exclusive) and kept (binary) of each row."""
    if not V <= length or not 1 <= gram <= length:
        raise ValueError(f"length must be {V} or more, and gram from 1 to length")
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text").withColumn("row", row_key())
    both = docs.join(repeats(docs, length, gram), "row", "left").select("doc_id", "text", "windows")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), False)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType(), False), T.StructField("removed", spans, False), T.StructField("kept", T.BinaryType(), False)])

    def run(batches):
        for b in slices(batches, "text"):
            sizes, removed, kept = [], [], []
            for text, windows in zip(b.column("text").to_pylist(), b.column("windows").to_pylist()):
                raw = (text or "").encode()
                runs: list[list[int]] = []
                for r in sorted(windows or [], key=lambda r: r["lo"]):
                    s, e = r["lo"], r["hi"] + length
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(e, runs[-1][1])
                    else:
                        runs.append([s, e])
                cuts = [0, *(x for r in runs for x in r), len(raw)]
                sizes.append(len(raw))
                removed.append([{"start": s, "end": e} for s, e in runs])
                kept.append(b"".join(raw[s:e] for s, e in zip(cuts[::2], cuts[1::2])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())], schema.names)

    return both.mapInArrow(tidy(run), schema)


def digest(deduped: DataFrame) -> DataFrame:
    """The contract's columns."""
    return deduped.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
