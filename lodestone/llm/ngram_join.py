"""N-gram Jaccard join of documents with a token-group matrix.

A text is the set of its distinct word shingles (64-bit hashes). Two texts link
when 100 * intersection >= percent * union, and the result is their connected
components. The steps:

1. Count shingles in a sketch of fixed size over all texts; it fixes the global
   order of tokens, rare ones first. Keep of each distinct set the prefix that
   any linked set must meet (the prefix filter), with positions.
2. Partition similar sets into groups: of the tokens that several sets share,
   compare each set with the first LEADERS ones in which the token comes
   earliest. The components of the verified links are the groups, found in a
   number of pairs that is linear in the tokens.
3. Token-group matrix: the union of each group's tokens, one row for each token
   and group, with the range of the members' sizes, the least position and the
   parity bits that all members with the token have alike. A query meets a group only
   by tokens that can be the first they have in common, by sizes and positions, and
   only once the whole parities of the query and of all members leave room for a link.
   For these the query's overlap with the group is the sum over all its tokens of the
   group's rows; a group is opened where that sum allows a link, and of an opened group
   the members that share a token are compared.
4. Components over all verified links.

Step 3 leaves out only pairs within one group, whose link cannot change a
component, so no link between groups is lost. Equal sets are one node.

Null or wordless texts have no shingles and are linked with nothing, not even
with each other; their component is their own id. Rows that share an id are one
document that has each of their texts, so they are linked with each other. Rows
with a null id are documents of their own; the least id of a component leaves
nulls out, so it is null only where all of them are. Very long texts are one
row of their own. An empty table gives an empty one, and columns other than
doc_id and text are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import LOWER, dropped, mix, ship, slices, span_hashes, spans, tidy, utf8, written
from .graph import components

#: Counters of the sketch that orders tokens: a fixed 4 MB.
COUNTERS = 1 << 20
_CHUNK = 1 << 12
#: Bits of a set's parity sketch; bytes of text or hashes worked on at once.
BITS = 1024
SLICE = 1 << 20
#: Sets of a token that all others with the token are compared with first: those in which it comes earliest, which have the least tokens of their own.
LEADERS = 8
#: The parity folded into WORDS 64-bit numbers, which travel with the tokens.
WORDS = 4
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    raw, ends = utf8(column)
    low = LOWER[raw]
    starts, stops = spans(_WORD[low], ends)
    words = span_hashes(low, starts, stops)
    at = np.searchsorted(starts, ends)
    mul = np.uint64(0xD6E8FEB86659FD93)
    out = []
    rolled = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        rolled = rolled * mul + words[k : k + len(rolled)]
    rolled = mix(rolled)
    for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
        if e - s >= n:
            x = np.sort(rolled[s : e - n + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif e > s:
            x = np.zeros(1, np.uint64)
            for w in words[s:e]:
                x = x * mul + w
            out.append(mix(x + np.uint64(e - s)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def parity(x: np.ndarray) -> bytes:
    """BITS bits, each the parity of the hashes that fall on it."""
    return np.packbits(np.bincount((x >> np.uint64(40)).astype(np.int64) % BITS, minlength=BITS) & 1 == 1).tobytes()


def set_key(x: np.ndarray) -> int:
    """A 64-bit hash of a set."""
    m = mix(x)
    return int(mix(m.sum(dtype=np.uint64, keepdims=True) ^ mix(np.bitwise_xor.reduce(mix(x * np.uint64(7)), keepdims=True))).astype(np.int64)[0])


def frequencies(docs: DataFrame, n: int, text: str = "text") -> np.ndarray:
    """Counts of shingles by their last bits, over all texts: COUNTERS numbers."""
    part = T.StructType([T.StructField("chunk", T.IntegerType(), False), T.StructField("counts", T.BinaryType(), False)])

    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for b in slices(batches, text, SLICE):
            sets = shingle_sets(b.column(text), n)
            total += np.bincount((np.concatenate(sets) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(COUNTERS // _CHUNK), pa.int32()), pa.array([x.astype(np.int32).tobytes() for x in np.minimum(total, 2**31 - 1).reshape(-1, _CHUNK)], pa.binary())], ["chunk", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist()):
                sums[k] = np.minimum(sums.get(k, 0) + np.frombuffer(c, np.int32).astype(np.int64), 2**31 - 1)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.astype(np.int32).tobytes() for x in sums.values()], pa.binary())], ["chunk", "counts"])

    out = np.zeros(COUNTERS, np.int32)
    for r in docs.select(text).mapInArrow(tidy(count), part).repartition("chunk").mapInArrow(add, part).collect():
        out[r["chunk"] * _CHUNK : (r["chunk"] + 1) * _CHUNK] = np.frombuffer(r["counts"], np.int32)
    return out


def prefixes(docs: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """doc_id, row, n (set size), key (of the set) and prefix (tokens in order) of each text; docs: doc_id, row and text."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("row", T.LongType()), T.StructField("n", T.LongType(), False), T.StructField("key", T.LongType(), False), T.StructField("parity", T.BinaryType(), False), T.StructField("prefix", T.ArrayType(T.LongType(), False), False)])
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        counts = shared.value
        for b in slices(batches, "text", SLICE):
            sizes, keys, bits, kept = [], [], [], []
            for x in shingle_sets(b.column("text"), n):
                size = len(x)
                sizes.append(size)
                keys.append(set_key(x) if size else 0)
                bits.append(parity(x))
                p = size - (percent * size + 99) // 100 + 1 if size else 0
                c = counts[(x & np.uint64(COUNTERS - 1)).astype(np.int64)]
                kept.append(x[np.lexsort((x, c))[:p]].astype(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(bits, pa.binary()), lists], schema.names)

    return docs.select("doc_id", "row", "text").mapInArrow(tidy(run), schema)


def may_link(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Length and positional filters of two sets that share the token at their positions i and j."""
    most = F.least(n - i, m - j)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))


def at_most(n: Column, m: Column, percent: int) -> Column:
    """In how many shingles two linked sets of these sizes differ at most."""
    return n + m - 2 * F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def sizes_in(n: Column, low: Column, high: Column, percent: int) -> tuple[Column, Column]:
    """The least and the largest size from low to high that can link with n."""
    return F.greatest(low, F.ceil(percent * n / F.lit(100))), F.least(high, F.floor(100 * n / F.lit(percent)))


def may_share(n: Column, low: Column, high: Column, unlike: Column, percent: int) -> Column:
    """Whether one of a group's members with a token can link with a set of n shingles that has the token, too.

    The members' sizes are from low to high, and all of them differ from the set
    in unlike bits at least. It holds for every token that a linked pair shares.
    """
    least, most = sizes_in(n, low, high, percent)
    # at_most falls by one at some sizes, but never at two in a row
    differ = F.greatest(at_most(n, most, percent), at_most(n, F.greatest(most - 1, least), percent))
    return (least <= most) & (unlike <= differ)


def may_begin(n: Column, i: Column, low: Column, high: Column, first: Column, percent: int) -> Column:
    """Whether a linked pair's first common token can be one at position i of the set and at first or later in the members.

    What follows i is the easier to match the smaller a member is, and what
    follows first the larger it is.
    """
    least, most = sizes_in(n, low, high, percent)
    return ((100 + percent) * (n - i) >= percent * (n + least)) & ((100 + percent) * (most - first) >= percent * (n + most))


def least_overlap(n: Column, low: Column, high: Column, percent: int) -> Column:
    """How many prefix tokens a set of n shingles shares at least with one of low to high shingles that it links with.

    Up to where the shorter-reaching of two prefixes ends, all common tokens are in both
    prefixes; behind it there are no more than that set has outside its prefix,
    ceil(percent * size / 100) - 1.
    """
    least, most = sizes_in(n, low, high, percent)
    smaller = F.ceil(percent * (n + least) / F.lit(100 + percent)) - F.ceil(percent * n / F.lit(100)) + 1
    larger = F.ceil(percent * (n + most) / F.lit(100.0 + percent) - percent * most / F.lit(100.0) - 1e-6)
    return F.greatest(F.lit(1), F.least(smaller, larger))


def apart(x: str, y: str) -> Column:
    """Bits in which the folded parities of x and y differ."""
    return sum(F.bit_count(F.col(f"{x}.s{k}").bitwiseXOR(F.col(f"{y}.s{k}"))) for k in range(WORDS))


def fits(x: str, y: str, percent: int) -> Column:
    """Length, positional and parity filters on two entries of one token."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    return may_link(n, F.col(f"{x}.pos"), m, F.col(f"{y}.pos"), percent) & (apart(x, y) <= at_most(n, m, percent))


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Of the pairs a, b (keys) those that link, as a written table; sets: key, rep (id and row), n and parity of each set.

    The parity of a set's hash bits differs in no more of BITS bits than two sets
    differ in shingles, so it rules out nearly all pairs that do not link before
    any text is fetched. The others are compared on their whole sets.
    """
    side = lambda k: sets.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("parity").alias(f"p{k}"))
    pairs = written(pairs, "pairs")
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "pa", "pb")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def may(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint64).reshape(-1, BITS // 64) for c in ("pa", "pb"))
            total = b.column("na").to_numpy() + b.column("nb").to_numpy()
            least = -(-percent * total // (100 + percent))  # of the intersection
            keep = np.bitwise_count(x ^ y).sum(1) <= total - 2 * least
            yield b.filter(pa.array(keep)).select(["a", "b"])

    near = written(near.mapInArrow(tidy(may), schema), "near")
    dropped(pairs)
    keys = near.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    reps = sets.select("key", F.col("rep.doc_id").alias("rep_id"), F.col("rep.row").alias("rep_row")).join(keys, "key")
    texts = docs.join(reps, docs["doc_id"].eqNullSafe(F.col("rep_id")) & (docs["row"] == F.col("rep_row")))
    whole = T.StructType([T.StructField("key", T.LongType()), T.StructField("hashes", T.BinaryType(), False)])

    def hashes(batches):
        for b in slices(batches, "text", SLICE):
            own = [x.tobytes() for x in shingle_sets(b.column("text"), n)]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(own, pa.binary())], whole.names)

    # rows that share id and text give a set each; one of them stays
    found = written(texts.select("key", "text").mapInArrow(tidy(hashes), whole).dropDuplicates(["key"]), "shingles")
    both = near.join(found.select(F.col("key").alias("a"), F.col("hashes").alias("x")), "a").join(found.select(F.col("key").alias("b"), F.col("hashes").alias("y")), "b")

    def run(batches):
        for b in slices(batches, "x", SLICE):
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    out = written(both.select("a", "b", "x", "y").mapInArrow(tidy(run), schema), "links")
    dropped(near, found)
    return out


def parity_words() -> list[Column]:
    """The parity as 64-bit numbers w0, w1, ..."""
    return [F.conv(F.hex(F.substring("parity", 8 * k + 1, 8)), 16, -10).cast("long").alias(f"w{k}") for k in range(BITS // 64)]


def alike(pairs: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Of the pairs of a set (key, of n shingles) and a group those whose whole parities and sizes allow a link with a member.

    The bits that all members have alike and the set otherwise tell the set from each member.
    """
    words = range(BITS // 64)
    wanted = pairs.select("group").distinct()
    own = sets.select("key", "n", "parity").join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("group", F.coalesce("component", "key"))
    own = own.join(wanted, "group", "left_semi").select("group", "n", *parity_words())
    common = [f(f"w{k}").alias(f"{name}{k}") for k in words for name, f in (("every", F.bit_and), ("any", F.bit_or))]
    union = own.groupBy("group").agg(F.min("n").alias("low"), F.max("n").alias("high"), *common)
    query = sets.join(pairs.select("key").distinct(), "key", "left_semi").select("key", *parity_words())
    both = pairs.join(query, "key").join(union, "group")
    unlike = sum(F.bit_count(F.col(f"w{k}").bitwiseXOR(F.col(f"every{k}")).bitwiseAND(F.col(f"every{k}").bitwiseOR(F.bitwise_not(F.col(f"any{k}"))))) for k in words)
    return both.where(may_share(F.col("n"), F.col("low"), F.col("high"), unlike, percent)).select("key", "group")


def shared_by(rows: DataFrame, key: str, name: str) -> DataFrame:
    """The rows whose key stands in several of them. The keys are written first, so that a join may split a frequent one's rows."""
    several = written(rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key), name)
    return rows.join(several, key, "left_semi")


def link(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id that links reach) of each row."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    rows = written(prefixes(docs, frequencies(docs, n), n, percent), "sets")
    # one row of each set; only its columns that a step needs are read and sent
    sets = rows.where("n > 0").groupBy("key").agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("prefix").alias("prefix"))
    sets = written(sets, "classes")
    folded = sets.select("key", *parity_words())
    fold = lambda k: F.col(f"w{k}").bitwiseXOR(F.col(f"w{k + 4}")).bitwiseXOR(F.col(f"w{k + 8}")).bitwiseXOR(F.col(f"w{k + 12}"))
    folds = [f"s{k}" for k in range(WORDS)]
    folded = folded.select("key", *[fold(k).alias(f"s{k}") for k in range(WORDS)])
    tokens = written(shared_by(sets.select("key", "n", F.posexplode("prefix").alias("pos", "token")), "token", "tokens"), "entries")
    entries = written(tokens.join(folded, "key"), "entries")
    dropped(tokens)

    rank = F.row_number().over(Window.partitionBy("token").orderBy("pos", "key"))
    leaders = written(entries.withColumn("rank", rank).where(F.col("rank") <= LEADERS).drop("rank"), "leaders")
    stars = entries.alias("x").join(leaders.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.key") != F.col("y.key")) & fits("x", "y", percent))
    stars = stars.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()
    links = verified(stars, sets, docs, n, percent)
    dropped(leaders)
    groups = components(links)

    member = entries.join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("group", F.coalesce("component", "key")).drop("component")
    member = written(member, "members")
    dropped(entries)
    common = [f(f"s{k}").alias(f"{name}{k}") for k in range(WORDS) for name, f in (("every", F.bit_and), ("any", F.bit_or))]
    union = written(member.groupBy("token", "group").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("pos").alias("first"), *common), "union")
    matrix = written(shared_by(union, "token", "tokens"), "matrix")
    dropped(union)
    query = written(member.join(matrix.select("token", "group"), ["token", "group"], "left_semi"), "queries")
    dropped(member)
    q, g = query.alias("q"), matrix.alias("g")
    # bits that all members have alike and the query otherwise
    unlike = sum(
        F.bit_count(F.col(f"q.s{k}").bitwiseXOR(F.col(f"g.every{k}")).bitwiseAND(F.col(f"g.every{k}").bitwiseOR(F.bitwise_not(F.col(f"g.any{k}")))))
        for k in range(WORDS)
    )
    size, low, high = F.col("q.n"), F.col("g.low"), F.col("g.high")
    begins = may_begin(size, F.col("q.pos"), low, high, F.col("g.first"), percent)
    other = F.col("q.group") < F.col("g.group")
    met = q.join(g, (F.col("q.token") == F.col("g.token")) & other & begins & may_share(size, low, high, unlike, percent))
    met = written(met.select("q.token", "q.key", "q.n", "q.pos", *[f"q.{c}" for c in folds], F.col("g.group").alias("group")), "met")
    likely = written(alike(met.select("key", "group", "n").distinct(), sets, groups, percent), "likely")
    dropped(groups)
    asked = written(query.join(likely.select("key", F.col("group").alias("with")), "key"), "asked")
    shared = asked.alias("q").join(g, (F.col("q.token") == F.col("g.token")) & (F.col("q.with") == F.col("g.group")) & may_share(size, low, high, unlike, percent))
    overlap = shared.select("q.key", "g.group", "q.n", "g.low", "g.high").groupBy("key", "group").agg(F.count("*").alias("overlap"), F.first("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    opened = overlap.where(F.col("overlap") >= least_overlap(F.col("n"), F.col("low"), F.col("high"), percent))
    opened = written(opened.select("key", "group"), "opened")
    tries = met.join(opened, ["key", "group"], "left_semi")
    pairs = tries.alias("x").join(query.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.group") == F.col("y.group")) & fits("x", "y", percent))
    pairs = pairs.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()
    more = verified(pairs, sets, docs, n, percent)
    dropped(met, likely, asked, opened, query, matrix)

    # rows that share an id
    several = rows.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("last")).where("a <> last")
    same_id = rows.where("n > 0").join(several.select("doc_id", "a"), "doc_id").select("a", F.col("key").alias("b"))
    found = components(links.unionByName(more).unionByName(same_id))
    dropped(links, more)

    ids = sets.select("key", "least").join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = ids.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(ids.join(least, "component").select("key", "component_id"), "named")
    dropped(found, sets)
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("key")).alias("key")).join(named, "key", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
