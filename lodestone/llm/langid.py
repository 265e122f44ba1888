"""Language identification by cross-parsing with suffix automata.

For each language the operator takes a bounded sample of labelled texts and
builds its suffix automaton. A text is cross-parsed by each automaton: the
longest match with the sample is one phrase, and the next one starts behind it.
The cost of a language is phrases * log2(sample length), the bits that pointers
into its sample would take; the language of least cost wins (ties: the first by
name). Letters are lower-cased, each run of other characters is one space, and
a text is parsed whole, from its first phrase to its last.

The parse is a walk in a complete transition table. So that many walks advance
together in numpy, a text is cut into stretches of STRETCH characters, and each
is walked as if a phrase began there. Then the phrase that truly runs across
its beginning is walked on from the stretch before, until a phrase begins where
the first walk also began one: from there on both are the same. A stretch that
comes to no such place hands its state on to the next, so the phrases are those
of a single walk through the whole text.

Null text, or text without a letter: `und` with score 0. Rows whose language is
null are never learnt from. Without any labelled text all rows are `und`, and an
empty table gives an empty one. Repeated rows are predicted each for itself.
Columns with the names of the output columns are replaced, all others stay.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, slices, tidy

#: The sample: at most so many whole texts of a language, of at most so many characters (of a language without such texts: its shortest one).
SAMPLE_ROWS = 16
SAMPLE_LONGEST = 4_000
#: Characters in a stretch of a text.
STRETCH = 256
UNKNOWN = "und"


def held_out(doc_id=None):
    """Rows never learnt from: crc32 of the id's text modulo 3 is 1."""
    return F.crc32((F.col("doc_id") if doc_id is None else doc_id).cast("string").cast("binary")) % 3 == 1


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)]))
    return _letters[0]


def normal(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts with runs of other characters as one space; their offsets."""
    low = [t.lower() for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[codes]
    codes = np.where(is_letter, codes, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # of a run, the first
    keep[ends[:-1][ends[:-1] < len(keep)]] = True  # a text does not depend on the one before it
    before = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], before[ends]


def automaton(text: str, alphabet: dict[str, int], width: int) -> np.ndarray:
    """The transition table, flat: next state * 2 + whether a phrase begins. width: a power of two over the alphabet."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for ch in text:
        c = alphabet[ch]
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    table = np.full((len(nxt), width), -1, np.int64)
    for s, row in enumerate(nxt):
        if row:
            table[s, list(row)] = list(row.values())
    # the last state stands before a phrase: each character begins one there, and one that the sample lacks is a phrase
    void = len(nxt)
    begin = np.where(table[0] >= 0, table[0], void) * 2 + 1
    return np.vstack([np.where(table >= 0, table * 2, begin), begin]).astype(np.int32).ravel()


class CrossParser:
    """samples: text for each language."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        plain = {}
        for lang in self.langs:
            codes, _ = normal([samples[lang]])
            plain[lang] = "".join(map(chr, codes.tolist()))
        chars = sorted({c for t in plain.values() for c in t} | {" "})
        self.width = 1 << (len(chars)).bit_length()
        alphabet = {c: k + 1 for k, c in enumerate(chars)}  # 0: a letter in no sample
        self.codes = np.zeros(0x110000, np.uint8 if self.width <= 256 else np.int32)
        for c, k in alphabet.items():
            self.codes[ord(c)] = k
        self.tables = [automaton(plain[lang], alphabet, self.width) for lang in self.langs]
        self.bits = np.array([np.log2(len(plain[lang]) + 2) for lang in self.langs])

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text by each language; whether the text has a letter."""
        codes, ends = normal(texts)
        n = len(texts)
        size = np.diff(ends)
        letters_before = np.concatenate([[0], np.cumsum(codes != 32)])
        has = letters_before[ends[1:]] > letters_before[ends[:-1]]
        counts = np.zeros((n, len(self.langs)), np.int64)
        many = -(-size // STRETCH)
        doc = np.repeat(np.arange(n), many)
        if not len(doc):
            return counts, has
        start = ends[doc] + (np.arange(len(doc)) - (np.cumsum(many) - many)[doc]) * STRETCH
        stop = np.minimum(start + STRETCH, ends[doc + 1])
        inner = np.flatnonzero(doc[1:] == doc[:-1]) + 1  # stretches that have one before
        symbols = self.codes[codes]
        for k, table in enumerate(self.tables):
            counts[:, k] = self._parse(table, symbols, start, stop, inner, doc, n)
        return counts, has

    def _parse(self, table, symbols, start, stop, inner, doc, n) -> np.ndarray:
        shift = self.width.bit_length() - 1
        begun = np.zeros(len(symbols), bool)  # where a phrase begins
        state = np.full(len(start), (len(table) >> shift) - 1, np.int64)
        size = stop - start
        order = np.argsort(-size, kind="stable")
        active = np.searchsorted(-size[order], -np.arange(int(size.max())), "left")  # longer than t come first
        at, own = start[order], state[order]
        for t, m in enumerate(active.tolist()):
            e = table[(own[:m] << shift) | symbols[at[:m] + t]]
            own[:m] = e >> 1
            begun[at[:m] + t] = e & 1
        state[order] = own
        # walk on across the beginnings; a stretch whose last state changes so is walked on from again
        todo = inner
        while len(todo):
            s, pos, end, of = state[todo - 1], start[todo].copy(), stop[todo], todo
            ended, final = [], []
            while len(of):
                e = table[(s << shift) | symbols[pos]]
                s, new = e.astype(np.int64) >> 1, (e & 1).astype(bool)
                meets = new & begun[pos]
                begun[pos] = new
                pos = pos + 1
                out = (pos == end) & ~meets
                ended.append(of[out])
                final.append(s[out])
                go = ~(meets | out)
                s, pos, end, of = s[go], pos[go], end[go], of[go]
            ended, final = np.concatenate(ended), np.concatenate(final)
            changed = state[ended] != final
            state[ended] = final
            after = ended[changed] + 1
            after = after[after < len(start)]
            todo = np.sort(after[doc[after] == doc[after - 1]])
        before = np.concatenate([[0], np.cumsum(begun)])
        return np.bincount(doc, before[stop] - before[start], n).astype(np.int64)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        counts, has = self.phrases(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cost = np.maximum(counts, 1) * self.bits
        best = cost.argmin(1)
        share = (1 / cost).max(1) / (1 / cost).sum(1)
        return [self.langs[b] if h else UNKNOWN for b, h in zip(best, has)], np.where(has, share, 0.0)


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_LONGEST) -> dict[str, str]:
    """A sample of each language: the whole texts with the least hashes of ids and texts, within the two bounds.

    Rows are counted for each language; then a hash threshold leaves a few times
    as many as wanted, so no language is sorted whole. There are as many samples
    as distinct values of lang, a set of names.
    """
    size = F.length("text")
    at = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    fitting = labelled.select("lang", "doc_id", "text", at.alias("at")).where(size <= longest)
    all_langs = labelled.groupBy("lang").agg(F.count_if(size <= longest).alias("n")).collect()
    out: dict[str, str] = {}
    share = {r["lang"]: min(1.0, (2 * rows + 50) / r["n"]) for r in all_langs if r["n"]}
    if share:
        few = fitting.where(F.col("at") <= F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")])
        least = few.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct("at", "doc_id", "text"))), 1, rows)["text"].alias("texts"))
        out |= {r["lang"]: " ".join(r["texts"]) for r in least.collect()}
    rest = [r["lang"] for r in all_langs if r["lang"] not in out]
    if rest:
        shortest = labelled.where(F.col("lang").isin(rest)).groupBy("lang").agg(F.min(F.struct(size.alias("size"), "text"))["text"].alias("text"))
        out |= {r["lang"]: r["text"] for r in shortest.collect()}
    return out


def identify(docs: DataFrame, samples: dict[str, str], text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with the predicted language and its score (the winner's share of the inverse costs)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    docs = docs.drop(lang, score)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType(), False), T.StructField(score, T.DoubleType(), False)])

    def run(batches):
        parser = CrossParser(shared.value)
        for b in slices(batches, text):
            pred, p = parser.predict([t or "" for t in b.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(p)], [*b.schema.names, lang, score])

    return docs.mapInArrow(tidy(run), schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows with a letter and a label that are not held out."""
    return docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~F.coalesce(held_out(), F.lit(False)))
