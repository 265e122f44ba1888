"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings of the training texts as a table of blocks:
a block holds whole documents of about BLOCK_BYTES, its terms (64-bit hashes of
words, sorted), and for each term the sorted positions of its postings. Blocks
are made where the texts are read, so nothing is shuffled and no term, however
frequent, meets in one task. ``matches`` answers test windows on each block:
the postings of the rarest term of a window, less the term's offset, are the
candidates; they are intersected with the offset-adjusted postings of the other
terms, from rare to frequent. For proximity the offsets are ranges: every other
term must stand within so many words of the rarest one, in any order.
``decontaminate`` returns the exact phrases and, where ``within`` is given, the
items that match by proximity only.

Words: A-Z in lower case, runs of letters, digits and non-ASCII characters. The
benchmark's windows are the stated query set: they are sent to the blocks in
chunks of at most CHUNK windows, one pass over the stored index for each chunk,
so what is broadcast is bounded whatever the benchmark's size.

Null or empty texts have no words, hits or items; null item ids are skipped in
lists of items. Ids of documents and items may be of any type; null and repeated
ids of documents are kept, each row for itself, and repeated items count once. A
very long document is a block of its own. Empty tables of documents give empty
ones, empty benchmarks no hits. Columns other than ids and texts are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import LOWER, ship, slices, span_hashes, spans, tidy, utf8, written

#: Words in a window.
WINDOW = 10
#: Bytes of text in a block of the index.
BLOCK_BYTES = 1 << 20
#: Windows in a broadcast chunk (about 100 bytes each).
CHUNK = 200_000

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True



def block_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("block", T.LongType(), False),
            T.StructField("doc_ids", T.ArrayType(id_type, True), False),
            T.StructField("n_words", T.ArrayType(T.LongType(), False), False),
            T.StructField("terms", T.BinaryType(), False),
            T.StructField("counts", T.BinaryType(), False),
            T.StructField("positions", T.BinaryType(), False),
        ]
    )


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text column; the number of words of each text."""
    raw, ends = utf8(column)
    low = LOWER[raw]
    starts, stops = spans(_WORD[low], ends)
    hashes = span_hashes(low, starts, stops)
    before = np.searchsorted(starts, ends)
    return hashes, np.diff(before)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index: one row for each block; block tells them apart once the index is written."""
    ship(docs.sparkSession)
    schema = block_schema(docs.schema[doc_id].dataType)
    ids = to_arrow_type(docs.schema[doc_id].dataType)

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for b in slices(batches, text, BLOCK_BYTES):
            hashes, n = words(b.column(text))
            order = np.argsort(hashes, kind="stable")
            in_order = hashes[order]
            first = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]])[: len(in_order)])
            counts = np.diff(np.append(first, len(in_order))).astype(np.int32)
            row = [block, b.column(doc_id).to_pylist(), n.tolist(), in_order[first].tobytes(), counts.tobytes(), order.astype(np.int32).tobytes()]
            kinds = (pa.int64(), pa.list_(ids), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], schema.names)
            block += 1

    return docs.select(doc_id, text).mapInArrow(tidy(run), schema)


class Block:
    """A row of the index, opened. Positions count words from the block's start."""

    def __init__(self, row: dict):
        self.doc_ids, self.n_words = row["doc_ids"], np.asarray(row["n_words"], np.int64)
        self.ends = np.cumsum(self.n_words)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        counts = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.positions = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        self.total = max(1, len(self.positions))
        self.keys = np.repeat(np.arange(len(counts)) * self.total, counts) + self.positions  # of term and position, sorted

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of terms; -1 where the block lacks the term."""
        if not len(self.terms):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether the postings of each term hold the position."""
        want = term * self.total + position
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return (self.keys[at] == want) & (position >= 0) & (position < self.total)

    def doc(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, position, "right")

    def candidates(self, queries: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each query whose terms the block has: its number, terms by offset, which offsets are used, and the offsets from the rarest term on."""
        used = np.arange(queries.shape[1])[None, :] < size[:, None]
        term = self.find(queries)
        alive = np.flatnonzero(((term >= 0) | ~used).all(1) & (size > 0))
        term, used = term[alive], used[alive]
        if not len(alive):
            return alive, term, used, term
        df = np.where(used, (self.first[1:] - self.first[:-1])[np.maximum(term, 0)], np.iinfo(np.int64).max)
        return alive, term, used, np.argsort(df, axis=1, kind="stable")

    def postings(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and position of every posting of each term."""
        n = self.first[term + 1] - self.first[term]
        which = np.repeat(np.arange(len(term)), n)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return which, self.positions[self.first[term][which] + nth]

    def phrases(self, queries: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query number and start of each exact occurrence; queries: rows of hashes, of which the first size count."""
        alive, term, used, order = self.candidates(queries, size)
        if not len(alive):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        query, start = self.postings(term[np.arange(len(term)), order[:, 0]])
        start = start - order[query, 0]
        keep = (start >= 0) & (start + size[alive][query] <= self.total)
        query, start = query[keep], start[keep]
        for k in range(1, queries.shape[1]):
            offset = order[query, k]
            ok = ~used[query, offset] | self.has(term[query, offset], start + offset)
            query, start = query[ok], start[ok]
        inside = start + size[alive][query] <= self.ends[self.doc(start)]
        return alive[query[inside]], start[inside]

    def proximity(self, queries: np.ndarray, size: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """Query number and position of each posting of the rarest term that has every other term within so many words in its document."""
        alive, term, used, order = self.candidates(queries, size)
        if not len(alive):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        query, at = self.postings(term[np.arange(len(term)), order[:, 0]])
        doc = self.doc(at)
        low = np.maximum(at - within, np.concatenate([[0], self.ends])[doc])
        high = np.minimum(at + within, self.ends[doc] - 1)
        for k in range(1, queries.shape[1]):
            offset = order[query, k]
            other = np.maximum(term[query, offset], 0)
            nearest = np.searchsorted(self.keys, other * self.total + low)
            found = self.keys[np.minimum(nearest, len(self.keys) - 1)]
            ok = ~used[query, offset] | (nearest < len(self.keys)) & (found >= other * self.total + low) & (found <= other * self.total + high)
            query, at, low, high = query[ok], at[ok], low[ok], high[ok]
        return alive[query], at


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """The distinct windows of the items: hashes (array<long>) and items (sorted array<long>)."""
    ship(items.sparkSession)
    kind = items.schema[item_id].dataType
    schema = T.StructType([T.StructField("item", kind), T.StructField("hashes", T.ArrayType(T.LongType(), False))])

    def run(batches):
        for b in slices(batches, text):
            hashes, n = words(b.column(text))
            flat, end = hashes.view(np.int64), np.cumsum(n)
            out = []
            for item, e, k in zip(b.column(item_id).to_pylist(), end.tolist(), n.tolist()):
                w = flat[e - k : e].tolist()
                out += [(item, w[i : i + size]) for i in range(max(1, k - size + 1))] if k else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], to_arrow_type(kind)), pa.array([x[1] for x in out], pa.list_(pa.int64()))], ["item", "hashes"])

    found = items.select(item_id, text).mapInArrow(tidy(run), schema)
    return found.groupBy("hashes").agg(F.array_sort(F.collect_set("item")).alias("items"))


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), False)


def matches(index: DataFrame, queries: list[tuple[list[int], list]], item_type: T.DataType, within: int | None = None) -> DataFrame:
    """Of each indexed document (block and place) n_words, hit_spans (the maximal runs of hit words, end exclusive), the items that occur in it, and near_items.

    queries: (hashes, items) of distinct windows; at most CHUNK of them. near_items
    are those with a window whose words all stand within so many words of its
    rarest one; it has the items that occur, too, if within is the window's length or more.
    """
    width = max([len(h) for h, _ in queries], default=1)
    matrix = np.zeros((len(queries), width), np.int64)
    for k, (h, _) in enumerate(queries):
        matrix[k, : len(h)] = h
    size = np.array([len(h) for h, _ in queries], np.int64)
    number: dict = {}
    owners = [[number.setdefault(x, len(number)) for x in i if x is not None] for _, i in queries]
    shared = index.sparkSession.sparkContext.broadcast((matrix, size, owners, list(number)))
    id_type = index.schema["doc_ids"].dataType.elementType
    kinds = [T.LongType(), T.LongType(), id_type, T.LongType(), _SPANS, T.ArrayType(item_type, False), T.ArrayType(item_type, False)]
    schema = T.StructType([T.StructField(c, t, c == "doc_id") for c, t in zip(("block", "place", "doc_id", "n_words", "hit_spans", "items", "near_items"), kinds)])
    arrow = [to_arrow_type(t) for t in kinds]

    def run(batches):
        matrix, size, owners, names = shared.value
        n_owners = np.array([len(x) for x in owners], np.int64)
        flat = np.array([x for o in owners for x in o], np.int64)
        first = np.cumsum(n_owners) - n_owners

        def found(block: Block, query: np.ndarray, at: np.ndarray) -> dict[int, list]:
            n = n_owners[query]
            nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out: dict[int, list] = {}
            if len(nth):
                for d, i in np.unique(np.stack([np.repeat(block.doc(at), n), flat[np.repeat(first[query], n) + nth]], 1), axis=0).tolist():
                    out.setdefault(d, []).append(names[i])
            return out

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                block = Block(row)
                query, start = block.phrases(matrix.view(np.uint64), size)
                step = np.zeros(len(block.positions) + 1, np.int64)
                np.add.at(step, start, 1)
                np.add.at(step, start + size[query], -1)
                hit = np.cumsum(step[:-1]) > 0
                edge = np.concatenate([[False], hit, [False]])
                change = np.flatnonzero(edge[1:] != edge[:-1])
                begin = np.concatenate([[0], block.ends])
                cut = np.unique(np.concatenate([change, begin[1:-1][hit[np.minimum(begin[1:-1], len(hit) - 1)]] if len(hit) else change]))
                lo, hi = cut[:-1], cut[1:]
                keep = hit[lo] if len(lo) else np.zeros(0, bool)
                lo, hi = lo[keep], hi[keep]
                of = block.doc(lo)
                runs: dict[int, list] = {}
                for d, s, e in zip(of.tolist(), (lo - begin[of]).tolist(), (hi - begin[of]).tolist()):
                    runs.setdefault(d, []).append({"start": s, "end": e})
                items = found(block, query, start)
                near = {} if within is None else found(block, *block.proximity(matrix.view(np.uint64), size, within))
                docs = range(len(block.doc_ids))
                columns = [[row["block"]] * len(docs), list(docs), block.doc_ids, block.n_words, *[[x.get(d, []) for d in docs] for x in (runs, items, near)]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, arrow)], schema.names)

    return index.mapInArrow(tidy(run), schema)


def chunks(found: DataFrame, chunk: int = CHUNK):
    """The windows in lists of at most about chunk rows."""
    total = found.count()
    parts = max(1, -(-total // (chunk * 3 // 4))) if total > chunk else 1
    for k in range(parts):
        part = found if parts == 1 else found.where(F.pmod(F.xxhash64("hashes"), F.lit(parts)) == k)
        yield [(r["hashes"], r["items"]) for r in part.collect()]


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW, chunk: int = CHUNK, within: int | None = None) -> DataFrame:
    """doc_id, n_words, hit_spans and items of each document: exact occurrences of the items' windows; near_items: of items by proximity only."""
    index = written(build_index(docs), "postings")
    found = written(windows(items, size=size), "windows")
    kind = found.schema["items"].dataType.elementType
    parts = [matches(index, queries, kind, within) for queries in chunks(found, chunk)]
    out = parts[0]
    if len(parts) > 1:  # each chunk saw each document once
        for p in parts[1:]:
            out = out.unionByName(p)
        every = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
        out = out.groupBy("block", "place", "doc_id", "n_words").agg(F.flatten(F.collect_list("hit_spans")).alias("s"), every("items").alias("items"), every("near_items").alias("near_items"))
        out = out.withColumn("hit_spans", merge_spans("s"))
    return out.select("doc_id", "n_words", "hit_spans", "items", F.array_except("near_items", "items").alias("near_items"))


def merge_spans(column: str):
    """The union of spans as maximal runs."""
    empty = f"cast(array() as array<struct<start:bigint,end:bigint>>)"
    return F.expr(
        f"aggregate(array_sort({column}), {empty}, (a, x) -> if(size(a) > 0 and element_at(a, -1).end >= x.start, "
        f"concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end)))), concat(a, array(x))))"
    )


def digest(hits: DataFrame) -> DataFrame:
    """The contract's columns."""
    n_hit = F.expr("aggregate(hit_spans, 0L, (a, x) -> a + x.end - x.start)")
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
