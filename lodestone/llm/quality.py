"""Quality classifier: Bradley-Terry pairwise ranking of documents.

Each text becomes a vector of surface features (shares of character classes,
repetition of lines, words and word pairs, lengths), computed over whole texts
in numpy. Weights are learnt from preference pairs, a text of label 1 over one
of label 0, by logistic loss on the difference of their features. The score is
the text's ranking value, moved and scaled so that the cut-off (CUT) lies at the
quantile of the training scores that the share of label 0 marks: texts at or
above it are predicted 1.

All labelled rows that are not held out and all their pairs count. The features
are written once, and each step of the fit is one pass over them: rows are added
up by class and by the cell of a fixed grid that their ranking value falls in, and
the loss, its slope and curvature are those of all pairs of rows, each at the mean
value of its cell. Order statistics of the values are found on the same grid, made
finer in each pass. So what goes to the driver has a fixed length.
Null text counts as empty and is scored like an empty text.
A document with several labels has the least of them. Without labels of both
kinds every text has the score 0.5 and is kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, dropped, mix, ship, slices, span_hashes, spans, tidy, utf8, written

#: Cells of the grid of ranking values; those of its coarser form, for the curvature.
GRID, COARSE = 1024, 64
#: The value at half of the grid's upper part; passes that make the grid finer for an order statistic.
HALF, FINER = 8.0, 4
#: The slope of the loss at which the fit ends; far below it rows only move to and fro between cells.
FLAT = 1e-6
_CHUNK = 1 << 12
#: The score at the threshold quantile.
CUT = 0.3
SEED = 7

_CLASSES = {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "space": (32, 9),
    "line": (10, 13),
    "stop": b".,",
    "bar": b"|",
    "bang": b"!?",
    "symbol": b"#$%&*@^~+=<>\\/_`{}[]",
    "quote": b"\"'():;-",
    "high": range(128, 256),
}
_OF = np.full(256, len(_CLASSES), np.int64)
for _k, _v in enumerate(_CLASSES.values()):
    _OF[list(_v)] = _k
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def held_out(doc_id=None):
    """Rows never learnt from: crc32 of the id's text modulo 5 is 0."""
    return F.crc32((F.col("doc_id") if doc_id is None else doc_id).cast("string").cast("binary")) % 5 == 0


def _distinct(owner: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """How many distinct keys each owner has."""
    if not len(owner):
        return np.zeros(n)
    order = np.lexsort((key, owner))
    o, k = owner[order], key[order]
    new = np.concatenate([[True], (o[1:] != o[:-1]) | (k[1:] != k[:-1])])
    return np.bincount(o[new], minlength=n).astype(float)


def features(column: pa.Array) -> np.ndarray:
    """One row of features for each text."""
    raw, ends = utf8(column)
    n = len(ends) - 1
    size = np.diff(ends)
    doc = np.repeat(np.arange(n), size)
    width = len(_CLASSES) + 1
    counts = np.bincount(doc * width + _OF[raw], minlength=n * width).reshape(n, width).astype(float)
    chars = np.maximum(size, 1).astype(float)
    starts, stops = spans(~_SPACE[raw], ends)
    owner = np.searchsorted(ends, starts, "right") - 1
    words = np.bincount(owner, minlength=n).astype(float)
    hashes = span_hashes(LOWER[raw], starts, stops)
    some = np.maximum(words, 1)
    tail = np.bincount(owner, _OF[raw[stops - 1]] >= _OF[33], minlength=n) if len(stops) else np.zeros(n)
    caps = np.bincount(owner, (_OF[raw[starts]] == 1) & (_OF[raw[np.minimum(starts + 1, stops - 1)]] == 1), minlength=n) if len(starts) else np.zeros(n)
    lone = np.bincount(owner, stops - starts == 1, minlength=n)
    same = owner[1:] == owner[:-1]
    pairs = mix(hashes[:-1] * np.uint64(3) + hashes[1:])[same]
    n_pairs = np.bincount(owner[1:][same], minlength=n).astype(float)
    l_starts, l_stops = spans(raw != 10, ends)
    l_owner = np.searchsorted(ends, l_starts, "right") - 1
    lines = np.bincount(l_owner, minlength=n).astype(float)
    distinct_lines = _distinct(l_owner, span_hashes(raw, l_starts, l_stops), n)
    shares = counts / chars[:, None]
    columns = [
        *np.sqrt(shares).T,
        np.log1p(words),
        _distinct(owner, hashes, n) / some,
        1 - _distinct(owner[1:][same], pairs, n) / np.maximum(n_pairs, 1),
        1 - distinct_lines / np.maximum(lines, 1),
        chars / some / 10,
        tail / some,
        caps / some,
        lone / some,
        lines / some,
        words == 0,
        words < 5,
    ]
    return np.stack([np.asarray(c, float) for c in columns], 1)


def minimise(slopes: Callable, width: int, l2: float, steps: int) -> np.ndarray:
    """Newton's method until the slope is below FLAT; slopes gives the loss of weights, its slope and curvature.

    A step that raises the loss is halved.
    """
    w, step = np.zeros(width), np.zeros(width)
    least = np.inf
    for _ in range(steps):
        now = w - step
        loss, gradient, hessian = slopes(now)
        loss, gradient = loss + l2 / 2 * float(now @ now), gradient + l2 * now
        if np.abs(gradient).max() < FLAT:
            return now
        if loss > least:
            step = step / 2
            continue
        w, least = now, loss
        step = np.linalg.solve(hessian + l2 * np.eye(width), gradient)
    return w


def on_grid(value: np.ndarray) -> np.ndarray:
    """A value's place on the grid, from 0 to 1; it keeps the order and has no bounds for values."""
    return (value / (HALF + np.abs(value)) + 1) / 2


def cells(place: np.ndarray, low: float = 0.0, cells_each: float = GRID) -> np.ndarray:
    return np.clip(((place - low) * cells_each).astype(np.int64), 0, GRID - 1)


def added(x: np.ndarray, label: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Of the rows x with label 0 and of those with label 1: counts and sums of x by cell, and sums of products by coarse cell."""
    width = len(w)
    count, total = np.zeros((2, GRID)), np.zeros((2, GRID, width))
    product = np.zeros((2, COARSE, width, width))
    for k in (0, 1):
        z = x[label == k]
        cell = cells(on_grid(z @ w))
        order = np.argsort(cell, kind="stable")
        z, cell = z[order], cell[order]
        count[k] = np.bincount(cell, minlength=GRID)
        for f in range(width):
            total[k, :, f] = np.bincount(cell, z[:, f], GRID)
        rough = cell // (GRID // COARSE)
        cuts = np.searchsorted(rough, np.arange(COARSE + 1))
        for c in np.unique(rough):
            part = z[cuts[c] : cuts[c + 1]]
            product[k, c] = part.T @ part
    return np.concatenate([count.ravel(), total.ravel(), product.ravel()])


def all_pairs(sums: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, slope and curvature, a pair each, of all pairs of a row of label 1 and one of label 0, from what added() gives."""
    width = len(w)
    count = sums[: 2 * GRID].reshape(2, GRID)
    total = sums[2 * GRID : 2 * GRID * (1 + width)].reshape(2, GRID, width)
    product = sums[2 * GRID * (1 + width) :].reshape(2, COARSE, width, width)
    pairs = count[0].sum() * count[1].sum()

    def lost(count, total):
        """Counts and sums of the cells that have rows, and all differences of their mean values."""
        bad, good = ((n[n > 0], t[n > 0]) for n, t in zip(count, total))
        return bad, good, (good[1] @ w / good[0])[:, None] - (bad[1] @ w / bad[0])[None, :]

    (n0, t0), (n1, t1), apart = lost(count, total)
    loss = n1 @ np.logaddexp(0, -apart) @ n0 / pairs
    p = 1 / (1 + np.exp(np.clip(apart, -30, 30)))
    gradient = -((p @ n0) @ t1 - (n1 @ p) @ t0) / pairs
    rough_n = count.reshape(2, COARSE, -1).sum(2)
    (n0, t0), (n1, t1), apart = lost(rough_n, total.reshape(2, COARSE, -1, width).sum(2))
    p = 1 / (1 + np.exp(np.clip(apart, -30, 30)))
    p = p * (1 - p)
    across = t1.T @ p @ t0
    own = np.tensordot(p @ n0, product[1][rough_n[1] > 0], 1) + np.tensordot(n1 @ p, product[0][rough_n[0] > 0], 1)
    return float(loss), gradient, (own - across - across.T) / pairs


def places(tally: Callable, value: Callable, wanted: list[tuple[int | None, int]]) -> list[float]:
    """For each label (None: any) and k the least value that all but k rows of the label reach, to the last of the finer grids."""
    low, each = [0.0] * len(wanted), float(GRID)
    rest = [k for _, k in wanted]
    for _ in range(FINER):
        now, width = list(low), 1 / each

        def count(x, label, now=now, each=each):
            place = on_grid(value(x))
            out = np.zeros((len(wanted), GRID))
            for r, (kind, _) in enumerate(wanted):
                inside = (place >= now[r]) & (place < now[r] + GRID / each) & ((label == kind) if kind is not None else True)
                out[r] = np.bincount(cells(place[inside], now[r], each), minlength=GRID)
            return out.ravel()

        for r, counts in enumerate(tally(count).reshape(len(wanted), GRID)):
            below = np.cumsum(counts)
            cell = min(int(np.searchsorted(below, rest[r], "right")), GRID - 1)
            rest[r] -= int(below[cell - 1]) if cell else 0
            low[r] += cell * width
        each *= GRID
    t = [2 * x - 1 for x in low]
    return [HALF * x / (1 - abs(x)) for x in t]


def fitted(tally: Callable, l2: float, steps: int, drawn: Callable | None = None) -> dict | None:
    """The model of the rows behind tally, which adds up a function's array over all of their (features, labels).

    drawn gives the slopes on pairs of its own, from the centre and scale of the features.
    """
    sums = tally(lambda x, label: np.concatenate([[len(x), (label == 1).sum(), (label == 0).sum()], x.sum(0), (x * x).sum(0)]))
    if sums is None or not sums[1] or not sums[2]:
        return None
    (n, good, bad), (first, second) = sums[:3], sums[3:].reshape(2, -1)
    centre = first / n
    scale = np.sqrt(np.maximum(tally(lambda x, _: ((x - centre) ** 2).sum(0)) / n, 0))
    scale = np.maximum(scale, 1e-6)
    slopes = drawn(centre, scale) if drawn else lambda w: all_pairs(tally(lambda x, label: added((x - centre) / scale, label, w)), w)
    w = np.round(minimise(slopes, len(centre), l2, steps), 9)  # sums of floats come in any order
    cut, of_good, of_bad = places(tally, lambda x: ((x - centre) / scale) @ w, [(None, int(bad)), (1, int(good - 1) // 2), (0, int(bad - 1) // 2)])
    return {"w": w, "centre": centre, "scale": scale, "cut": cut, "slope": 6 / max(of_good - of_bad, 1e-6)}


def fit(x: np.ndarray, label: np.ndarray, pairs: int | None = None, l2: float = 1e-4, steps: int = 60) -> dict | None:
    """Weights, centre and scale of the features, and the map of ranking values to scores.

    From all pairs of the rows, or from so many drawn ones.
    """

    def drawn(centre, scale):
        z, rng = (x - centre) / scale, np.random.default_rng(SEED)
        d = z[rng.choice(np.flatnonzero(label == 1), pairs)] - z[rng.choice(np.flatnonzero(label == 0), pairs)]

        def slopes(w):
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            return float(np.logaddexp(0, -(d @ w)).mean()), -d.T @ p / pairs, (d * (p * (1 - p))[:, None]).T @ d / pairs

        return slopes

    return fitted(lambda f: f(x, label), l2, steps, drawn if pairs else None) if len(x) else None


def scores(model: dict | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    value = ((x - model["centre"]) / model["scale"]) @ model["w"]
    logit = model["slope"] * (value - model["cut"]) + np.log(CUT / (1 - CUT))
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and x, the features as bytes, of each row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("x", T.BinaryType(), False)])

    def run(batches):
        for b in slices(batches, "text"):
            x = np.ascontiguousarray(features(b.column("text")), "<f8")
            ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1] * 8)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x)])], schema.names)

    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


def added_up(rows: DataFrame) -> Callable:
    """A function that adds up a function's array, of a length of its own, over all rows (label and x); None without rows."""
    schema = T.StructType([T.StructField("chunk", T.IntegerType(), False), T.StructField("sums", T.BinaryType(), False)])

    def tally(f: Callable) -> np.ndarray | None:
        def some(batches):
            total = None
            for b in batches:
                if b.num_rows:
                    x = np.frombuffer(b"".join(b.column("x").to_pylist()), "<f8").reshape(b.num_rows, -1)
                    now = np.asarray(f(x, b.column("label").to_numpy()), float)
                    total = now if total is None else total + now
            if total is not None:  # the last chunk always goes, for the length
                parts = [total[k : k + _CHUNK] for k in range(0, len(total), _CHUNK)]
                sent = [k for k, part in enumerate(parts) if part.any() or k == len(parts) - 1]
                yield pa.RecordBatch.from_arrays([pa.array(sent, pa.int32()), pa.array([parts[k].tobytes() for k in sent], pa.binary())], schema.names)

        def add(batches):
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                for k, part in zip(b.column("chunk").to_pylist(), b.column("sums").to_pylist()):
                    sums[k] = sums.get(k, 0) + np.frombuffer(part)
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], schema.names)

        found = {r["chunk"]: np.frombuffer(r["sums"]) for r in rows.mapInArrow(some, schema).repartition("chunk").mapInArrow(add, schema).collect()}
        if not found:
            return None
        last = max(found)
        out = np.zeros(last * _CHUNK + len(found[last]))
        for k, part in found.items():
            out[k * _CHUNK : k * _CHUNK + len(part)] = part
        return out

    return tally


def learn(docs: DataFrame, labels: DataFrame, l2: float = 1e-4, steps: int = 60) -> dict | None:
    """Fit on all labelled rows of docs that are not held out."""
    ship(docs.sparkSession)
    own = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    # features are joined, not texts, as they are shorter
    rows = featured(docs.where(F.col("doc_id").isNotNull() & ~held_out())).join(own, "doc_id").select("label", "x")
    rows = written(rows, "features")
    model = fitted(added_up(rows), l2, steps)
    dropped(rows)
    return model


def score(docs: DataFrame, model: dict | None, text: str = "text", column: str = "score") -> DataFrame:
    """docs with the score of each whole text."""
    ship(docs.sparkSession)
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType(), False)])

    def run(batches):
        for b in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores(model, features(b.column(text))))], [*b.schema.names, column])

    return docs.mapInArrow(run, schema)
