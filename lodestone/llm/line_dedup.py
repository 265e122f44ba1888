"""Line dedup: an exact set-similarity join of lines, in DataFrame functions only.

A line is the set of its distinct words (runs between spaces; 64-bit hashes).
Lines are in the order (doc_id, row, line number), where row is a 64-bit hash of
the text, which tells rows that share an id apart; a line goes when an earlier one has
a Jaccard similarity of THRESHOLD or more with it, whether that one stays or
not. Lines without words always stay.

1. Words are counted over all texts by the first BITS bits of their hashes; the
   ranks of these counters order the words of a line, rare ones first.
   The order key is a bijection of the hash, so it loses nothing.
2. Equal sets collapse to their first line, after which only first lines are
   compared. The prefix filter keeps the rarest words of each.
3. A semi join on the word finds the entries that have any partner passing the
   length, positional and parity filters (the parity of a set's hash bits
   differs in at most as many bits as two sets differ in words). It gives at
   most one row for each entry, however many partners it has.
4. What is left meets the earliest line of each word's entries first; lines that
   this decides go, and only the undecided ones are joined with all earlier
   entries. Pairs are verified on the whole sets.

Null text stays null, and an empty one empty. Rows with the same doc_id and text
share their lines' positions, so their lines never remove each other; rows that
share only the id are rows of their own. Null ids come first. Very long texts
only have more lines, and an empty table gives an empty one. Columns with the
names of the output columns are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dropped, written
from .fingerprint import let

#: Similarity in hundredths from which the later line goes.
THRESHOLD = 80
#: Counters that order words: 2 to the BITS, a fixed number.
BITS = 16


def row_of(text: Column) -> Column:
    """Together with doc_id the key of a row."""
    return F.xxhash64(text)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def order_key(h: Column, rank: Column) -> Column:
    """A bijection of a word's hash: the rank (from ranks, in its place) of its first BITS bits, then the others."""
    first = F.coalesce(F.get(rank, F.shiftrightunsigned(h, 64 - BITS).cast("int")), F.lit(0))  # never null, so arrays of keys sort as numbers
    return first.bitwiseOR(h.bitwiseAND(F.lit((1 << 64 - BITS) - 1)))


def hashes_of(line: Column) -> Column:
    """The hashes of a line's distinct words, in any order."""
    return F.array_remove(F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def words_of(line: Column, rank: Column) -> Column:
    """The order keys of a line's distinct words, rarest first."""
    # an argument used twice is made twice, so the words are hashed before
    return F.sort_array(F.transform(hashes_of(line), lambda h: order_key(h, rank)))


def ranks(docs: DataFrame) -> Column:
    """The rank of each counter of words over all texts, rarest first, as one literal array of first bits of order keys."""
    size = 1 << BITS
    words = docs.select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    counts = words.groupBy(F.shiftrightunsigned(F.xxhash64("w"), 64 - BITS).alias("c")).agg(F.count("*").alias("n"))
    every = docs.sparkSession.range(size).join(counts, F.col("id") == F.col("c"), "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))
    place = F.row_number().over(Window.orderBy("n", "id")) - size // 2 - 1  # over a fixed number of counters
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("id", "r"))), lambda x: F.shiftleft(x["r"].cast("long"), 64 - BITS).cast("string"))
    text = every.select("id", place.alias("r")).agg(F.array_join(in_order, ",").alias("text")).first()["text"]
    return F.split(F.lit(text), ",").cast("array<bigint>")


def parity(hashes: Column, odd: bool) -> Column:
    """64 bits, each the parity of the hashes that fall on it: of all, or of those whose next bit is set."""
    one = F.lit(1).cast("long")
    weight = lambda h: F.shiftright(h, 6).bitwiseAND(one) if odd else one
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(F.call_function("shiftleft", weight(h), h.bitwiseAND(F.lit(63)).cast("int"))))


def apart(x, y) -> Column:
    """Bits of 128 in which the parities of two lines differ: those of hashes with and without the next bit."""
    odd = x("odd").bitwiseXOR(y("odd"))
    return F.bit_count(x("sig").bitwiseXOR(y("sig")).bitwiseXOR(odd)) + F.bit_count(odd)


def plausible(x, y, percent: int) -> Column:
    """Length, positional and parity filters on entries x and y (functions from names to columns) of the same word."""
    n, m = x("n"), y("n")
    most = F.least(n - x("pos"), m - y("pos"))
    differ = n + m - 2 * F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m)) & (apart(x, y) <= differ)


def of(alias: str):
    return lambda c: F.col(f"{alias}.{c}")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The later lines (key) of the pairs a (later), b that are similar."""
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("h").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("h").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(let(common, lambda c: 100 * c >= percent * (F.size("x") + F.size("y") - c))).select(F.col("a").alias("key")).distinct()


def words_by_line(docs: DataFrame, rank: Column) -> DataFrame:
    """doc_id, row, line and k (words_of) of each line with words; docs: doc_id, row and text."""
    lines = docs.select("doc_id", "row", F.posexplode(lines_of(F.col("text"))).alias("line", "value"))
    # a filter on the number of words, instead, would make the words twice
    return lines.where(F.trim("value") != "").select("doc_id", "row", "line", words_of(F.col("value"), rank).alias("k"))


def removed_lines(docs: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """doc_id, row and gone, the array of line numbers to remove, as a written table."""
    docs = docs.select("doc_id", row_of(F.col("text")).alias("row"), "text").where("text is not null")
    rank = ranks(docs)
    n = F.size("k")
    least = n - F.ceil(F.lit(percent) * n / F.lit(100)).cast("int") + 1
    lines = words_by_line(docs, rank).select("doc_id", "row", "line", n.alias("n"), F.xxhash64("k").alias("key"), parity(F.col("k"), False).alias("sig"), parity(F.col("k"), True).alias("odd"), F.slice("k", 1, least).alias("prefix"))
    lines = written(lines, "lines")
    at = F.struct("doc_id", "row", "line")
    classes = lines.groupBy("key").agg(F.min("n").alias("n"), F.min("sig").alias("sig"), F.min("odd").alias("odd"), F.first("prefix").alias("prefix"), F.min(at).alias("at"), F.count("*").alias("copies"))
    classes = written(classes, "classes")
    members = written(lines.select("doc_id", "row", "line", "key"), "members")
    dropped(lines)
    entries = classes.select("key", "n", "sig", "odd", F.posexplode("prefix").alias("pos", "token"))
    x, y = entries.alias("x"), entries.alias("y")
    some = (F.col("x.token") == F.col("y.token")) & (F.col("x.key") != F.col("y.key")) & plausible(of("x"), of("y"), percent)
    candidates = written(x.join(y, some, "left_semi"), "candidates")
    firsts = written(classes.select("key", "at", "copies"), "firsts")
    dropped(classes)
    near = written(candidates.join(firsts.select("key", "at"), "key"), "near")
    dropped(candidates)

    wanted = near.groupBy("at.doc_id", "at.row").agg(F.collect_set(F.struct("key", "at.line")).alias("wanted"))  # at most the lines of a document
    same_row = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.row") == F.col("w.row"))
    sets = docs.alias("d").join(wanted.alias("w"), same_row).select(let(lines_of(F.col("text")), lambda ls: F.transform("wanted", lambda w: F.struct(w["key"].alias("key"), hashes_of(F.get(ls, w["line"])).alias("h")))).alias("s"))
    sets = written(sets.select(F.explode("s").alias("s")).select("s.key", "s.h").dropDuplicates(["key"]), "words")

    # written, so that the join may split a frequent word's entries
    earliest = written(near.groupBy("token").agg(F.min(F.struct("at", "key", "n", "pos", "sig", "odd")).alias("first")), "earliest")
    stars = near.join(earliest, "token").where((F.col("first.key") != F.col("key")) & plausible(F.col, of("first"), percent)).select(F.col("key").alias("a"), F.col("first.key").alias("b"))
    stars = written(stars.distinct(), "stars")
    dropped(earliest)
    decided = written(verified(stars, sets, percent), "decided")
    open_ = near.join(decided, "key", "left_anti").alias("x")
    rest = open_.join(near.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("y.at") < F.col("x.at")) & plausible(of("x"), of("y"), percent))
    rest = rest.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
    similar = decided.unionByName(verified(rest, sets, percent))

    # the first lines of sets similar to an earlier one, and every line but the first of each set
    later = written(near.select("key", "at").distinct().join(similar, "key", "left_semi").select("at.*"), "later")
    dropped(near, sets, stars, decided)
    copies = members.join(firsts.where("copies > 1").select("key", F.col("at").alias("first")), "key").where(at != F.col("first"))
    gone = later.unionByName(copies.select("doc_id", "row", "line"))
    gone = written(gone.groupBy("doc_id", "row").agg(F.collect_set("line").alias("gone")), "gone")
    dropped(members, firsts, later)
    return gone


def dedup(docs: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """docs with their text without removed lines, n_lines and n_removed (which replace columns of these names)."""
    gone = removed_lines(docs, percent).toDF("_gone_id", "_gone_row", "_gone_lines")
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed", "_gone_id", "_gone_row", "_gone_lines")]
    out = docs.select(own).join(gone, F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (row_of(F.col("text")) == F.col("_gone_row")), "left")
    gone = F.coalesce("_gone_lines", F.array().cast("array<int>"))
    parts = F.transform(lines_of(F.col("text")), lambda v, k: F.when(~F.array_contains(gone, k), v))
    kept = F.when(F.size(gone) == 0, F.col("text")).otherwise(F.array_join(F.array_compact(parts), "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines_of(F.col("text")))).cast("long")
    return out.select(*[kept.alias(c) if c == "text" else c for c in own], n_lines.alias("n_lines"), F.size(gone).cast("long").alias("n_removed"))


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
