"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is halved down to leaves of LEAF characters. A leaf is scanned into the
pattern's pieces and each piece is encoded; two neighbours are joined by scanning
and encoding a window around their boundary anew, which grows until everything
outside is provably that of the joined text:

* Pieces. A piece that ends before the boundary and begins more than REACH
  characters before it cannot change, as no alternative of the pattern decides by
  more than REACH characters ahead or looks back. The window begins behind the last
  such piece, and grows piece by piece until one ends where a piece of the right
  half ends: from a common end on two scans of one text are the same.
* Tokens. Where the boundary cuts a long piece, its two parts were encoded
  already. A window of some tokens on each side is encoded anew and grows until
  its first and last token are again those it began and ended with. A sequence of
  tokens is the encoding of its bytes exactly if each two neighbours are that of
  theirs: a merge across a border, the first one there, involves the two tokens at
  that border alone. Those pairs all stand in the left, the window's or the right
  encoding, so the whole is the encoding.

The join is associative, so any tree gives the same tokens, and a piece of any
length costs a scan and a small window in each join. Decoding concatenates the
halves' bytes up the same kind of tree.

Null text counts as empty and has no tokens; an empty table gives an empty one;
repeated rows are encoded each for itself, and no ids are looked at. Very long
texts only deepen the tree. Other columns stay as they are, but for those with
the names of the output columns, which are replaced.
"""

from __future__ import annotations

import base64
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, slices, tidy

#: Characters in a leaf of the text's tree, and bytes in one of a piece's.
LEAF = 512
#: Characters ahead by which the pattern decides (the longest alternative of fixed text has as many).
REACH = 3
#: Bytes of remembered pieces, about; then a partition's memory of them starts anew. Longer pieces are not remembered.
REMEMBERED, SHORT = 16 << 20, 64
#: Bytes that an entry takes beside its text, about.
_ENTRY = 200
#: The public pattern's pieces, for texts of Latin-1 characters alone, with its classes spelled out.
LATIN = {
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""": re.compile(
        "'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+| ?[0-9²³¹¼-¾]+"
        "| ?[^\t-\r \x85\xa0A-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼-¾]+"
        "|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+"
    )
}


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file of lines "base64 rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Pieces(dict):
    """The tokens of a piece, as the bytes of 32-bit numbers."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.held = encode, 0

    def __missing__(self, piece: str) -> bytes:
        found = array("i", self.encode(piece.encode())).tobytes()
        if len(piece) < SHORT:
            self.held += _ENTRY + len(piece)
            if self.held > REMEMBERED:
                self.clear()
                self.held = 0
            self[piece] = found
        return found


class TreeBpe:
    """Encodes and decodes texts; pattern: of pieces whose alternatives look no more than REACH characters ahead."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        import regex
        import tiktoken

        self.leaf = max(2, leaf)
        self.base = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        # White space is Unicode's property, without the separators U+001C to U+001F
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.latin = LATIN.get(pattern)
        self.pieces = Pieces(self.bytes_encoded)
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token

    def encode(self, text: str) -> np.ndarray:
        scan = self.pattern
        if self.latin is not None:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                scan = self.latin
        return np.frombuffer(b"".join(self._encode(scan, text, 0, len(text))[1]), np.int32)

    def _encode(self, scan, text: str, lo: int, hi: int) -> tuple[list[str], list[bytes]]:
        """The pieces of text[lo:hi] and the tokens of each."""
        if hi - lo <= self.leaf:
            found = scan.findall(text, lo, hi)
            return found, list(map(self.pieces.__getitem__, found))
        mid = (lo + hi) // 2
        return self.join(scan, text, mid, hi, self._encode(scan, text, lo, mid), self._encode(scan, text, mid, hi))

    def join(self, scan, text: str, mid: int, hi: int, left: tuple, right: tuple) -> tuple[list[str], list[bytes]]:
        """The pieces and tokens up to hi from those before and behind mid."""
        pieces, tokens = left
        after, after_tokens = right
        keep, at = len(pieces) - 1, mid - len(pieces[-1])
        while keep and at > mid - REACH:
            keep -= 1
            at -= len(pieces[keep])
        last = at if keep == len(pieces) - 1 else mid - len(pieces[-1])
        new, new_tokens = [], []
        skip, end = 0, mid  # of the right half's pieces
        while at < mid or at != end:
            to = scan.match(text, at, hi).end()
            while end < to:
                end += len(after[skip])
                skip += 1
            piece = text[at:to]
            if len(piece) < SHORT:
                found = self.pieces[piece]
            elif at == last and to == mid + len(after[0]):
                found = self.merged(tokens[-1], after_tokens[0])
            elif at == last and to == mid:
                found = tokens[-1]
            else:
                found = array("i", self.bytes_encoded(piece.encode())).tobytes()
            new.append(piece)
            new_tokens.append(found)
            at = to
        return pieces[:keep] + new + after[skip:], tokens[:keep] + new_tokens + after_tokens[skip:]

    def bytes_encoded(self, piece: bytes) -> list[int]:
        """The tokens of a piece, by halves of its bytes."""
        if len(piece) <= self.leaf:
            return self.base(piece)
        mid = len(piece) // 2
        return self._merged(self.bytes_encoded(piece[:mid]), self.bytes_encoded(piece[mid:]))

    def merged(self, left: bytes, right: bytes) -> bytes:
        """The tokens of a piece from those of its two parts."""
        return array("i", self._merged(array("i", left).tolist(), array("i", right).tolist())).tobytes()

    def _merged(self, left: list[int], right: list[int]) -> list[int]:
        k = 2
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            window = self.base(b"".join([self.bytes[t] for t in left[a:] + right[:b]]))
            if (not a or window[0] == left[a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[:a] + window + right[b:]
            k *= 2

    def decode(self, tokens: np.ndarray) -> bytes:
        if len(tokens) <= self.leaf:
            table = self.bytes
            return b"".join([table[t] for t in tokens.tolist()])
        mid = len(tokens) // 2
        return self.decode(tokens[:mid]) + self.decode(tokens[mid:])


def _ranks(df: DataFrame, path: str):
    """The vocabulary (its size is that of a public file, fixed) is sent to each executor once."""
    ship(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(load_ranks(path))


def _tokens(coder: TreeBpe, texts: pa.Array) -> tuple[list[np.ndarray], pa.Array]:
    ids = [coder.encode(t or "") for t in texts.to_pylist()]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", tokens: str = "tokens", leaf: int = LEAF, decoded: str | None = None) -> DataFrame:
    """df with the column tokens, array<int>; with the name of a column decoded, also that of the tokens decoded again, in the same pass."""
    shared = _ranks(df, path)
    df = df.drop(tokens) if decoded is None else df.drop(tokens, decoded)
    more = [T.StructField(tokens, T.ArrayType(T.IntegerType(), False), False)]
    more += [T.StructField(decoded, T.BinaryType(), False)] if decoded else []
    schema = T.StructType([*df.schema.fields, *more])

    def run(batches):
        coder = TreeBpe(shared.value, pattern, leaf)
        for b in slices(batches, text):
            ids, lists = _tokens(coder, b.column(text))
            back = [pa.array([coder.decode(x) for x in ids], pa.binary())] if decoded else []
            yield pa.RecordBatch.from_arrays([*b.columns, lists, *back], schema.names)

    return df.mapInArrow(tidy(run), schema)


def decode(df: DataFrame, path: str, pattern: str, tokens: str = "tokens", decoded: str = "decoded", leaf: int = LEAF) -> DataFrame:
    """df with the column decoded, binary. Null tokens decode to no bytes."""
    shared = _ranks(df, path)
    df = df.drop(decoded)
    schema = T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType(), False)])

    def run(batches):
        coder = TreeBpe(shared.value, pattern, leaf)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                col = b.column(tokens)
                ids = [np.asarray(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else np.zeros(0, np.int64) for x in col]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([coder.decode(x) for x in ids], pa.binary())], [*b.schema.names, decoded])

    return df.mapInArrow(tidy(run), schema)


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns, from the operators' tokens and bytes."""
    return df.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def round_trip(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row's text, by one pass of one worker for each task."""
    return digest(encode(df.select("doc_id", "text"), path, pattern, decoded="decoded"))
