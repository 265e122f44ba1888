"""What the operators share: the shared folder, written tables, Arrow slices, byte hashing."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()


#: Rows in an Arrow batch between the JVM and Python, of which both sides keep some, where the session has Spark's default.
BATCH_ROWS = 2000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python, once for each application, and bound batches of whole texts."""
    sc = spark.sparkContext
    if spark.conf.get(_ARROW_ROWS) == "10000":
        spark.conf.set(_ARROW_ROWS, str(BATCH_ROWS))
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    path = Path(tempfile.mkdtemp(prefix="lodestone-")) / "lodestone_package.zip"  # the driver serves it until it ends
    atexit.register(shutil.rmtree, path.parent, ignore_errors=True)
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "lodestone").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Only where it is unset and all runs in one process (tests) a temporary folder is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        atexit.register(shutil.rmtree, base.removeprefix("file://"), ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: While a table is written: its query's shuffle files go when it has ended, not when the driver
#: happens to collect its garbage; and the text of its plan, which the driver keeps and
#: logs with every change, is cut, as it may hold a table of constants.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxPlanStringLength": "50000"}


@contextlib.contextmanager
def writing(spark: SparkSession):
    """While this holds, the settings of WRITING do."""
    before = {k: spark.conf.get(k, None) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _path(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as a table in the shared folder and read it back.

    A lost executor then costs no recomputation of what came before, and the
    shuffle files behind the table go. The table itself goes when dropped() names
    it, or when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with writing(spark):
        df.write.option("compression", "zstd").parquet(path)
    fs, hpath = _path(spark, path)
    fs.deleteOnExit(hpath)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for t in tables:
        fs, hpath = _path(t.sparkSession, t._written)
        fs.delete(hpath, True)


def trim() -> None:
    """Give freed memory back to the system, so that a worker that is used again begins small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable) -> Callable:
    """run, a function of a partition's batches, after which the worker's freed memory is given back."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about max_bytes of one text column (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, end to end, and the n+1 offsets; null counts as empty."""
    column = pa.compute.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


#: ASCII bytes in lower case; all others as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(0x5EED))
#: A random 64-bit number for each byte.
BYTE64 = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_Q = pow(_P, -1, 1 << 64)
#: So many powers are kept for the next call, 8 MB each; more are made when asked for.
_KEPT = (1 << 20) + 1
_powers: list[np.ndarray] = []


def _accumulated(n: int) -> list[np.ndarray]:
    out = []
    for base in (_P, _Q):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n."""
    if n > _KEPT:
        p, q = _accumulated(n)
        return p, q
    if not _powers:
        _powers.extend(_accumulated(_KEPT))
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of raw[s:e] for each span, from one pass of prefix sums."""
    n = len(raw)
    p, q = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE64[raw] * p[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * q[starts] + (ends - starts).astype(np.uint64))


def spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of word bytes; a run never crosses a document's end."""
    n = len(is_word)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[1:n] = is_word[1:] != is_word[:-1]
    edge[0] = edge[n] = True
    inner = offsets[1:-1]
    edge[inner] = True
    at = np.flatnonzero(edge)
    keep = is_word[at[:-1]]
    return at[:-1][keep], at[1:][keep]
