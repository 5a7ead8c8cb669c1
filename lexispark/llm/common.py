"""Scratch tables in the shared folder, Arrow helpers and vectorised text hashing used by the operators here."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: `[\x20\x09-\x0D]`, the only characters that separate words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD = r"[^\x20\x09-\x0D]+"

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_BLOCK = 1 << 20


# ---------------------------------------------------------------- shared folder


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where it is unset."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="lexispark-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir()
    return base.rstrip("/")


class Scratch:
    """Tables written to the shared folder to cut lineage.  They survive lost executors; drop() frees one early."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = f"lexispark-{name}-{uuid.uuid4().hex}"
        self.root = f"{shared_dir(spark)}/{self.name}"
        atexit.register(self._remove, self.root)

    def _remove(self, path: str) -> None:
        try:
            jvm, jsc = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
            if jvm is not None and jsc is not None:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session has ended; the folder's owner cleans up
            pass

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Removes tables; shuffle files that nothing refers to go with them, as Spark only sees to these when the driver's JVM collects."""
        for t in tables:
            if t is not None and getattr(t, "_scratch_path", None):
                self._remove(t._scratch_path)
        self.spark.sparkContext._jvm.System.gc()

    def close(self) -> None:
        """Removes all tables."""
        self._remove(self.root)
        self.spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- Python workers

_KEPT: dict[tuple, object] = {}


def remembered(key: tuple, make: Callable[[], object]):
    """What a worker keeps from task to task, one thing at a time: that of another operator goes."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Frees what an earlier operator left in a reused worker."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()


# ---------------------------------------------------------------- Arrow


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = column.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def rows_of(batch: pa.RecordBatch, *names: str, most: int = 1 << 17) -> Iterator[list[tuple]]:
    """Rows of list and plain columns as Python values, made for at most so many list items at a time, or one row."""
    sizes = np.zeros(len(batch), np.int64)
    for c in names:
        if pa.types.is_list(batch.column(c).type):
            sizes += pc.list_value_length(batch.column(c)).fill_null(0).to_numpy(zero_copy_only=False)
    for i, j in slices(np.concatenate([[0], np.cumsum(sizes + 1)]), most):
        yield list(zip(*(batch.column(c).slice(i, j - i).to_pylist() for c in names), strict=True))


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


# ---------------------------------------------------------------- hashing


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (a public-domain generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_BLOCK, 1 << (int(n) - 1).bit_length())
    if size not in _TABLES:
        made = _powers(_MULT, size), _powers(_INV, size)
        if size > _BLOCK:
            return made
        _TABLES[size] = made
    return _TABLES[size]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of data[start:end] for ascending, non-overlapping spans; work is cut into blocks of about 1 MB."""
    table, out = _LOWER if lower else _BYTES, np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        pw, inverse = _power_tables(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * pw[: b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(_INV))
        i = j
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and row of every word `[^\\x20\\x09-\\x0D]+`."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def salted(df: DataFrame, key: str, by: str, n: int) -> DataFrame:
    """A salt of n values taken from `by`, so that one value of key spreads over n tasks."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(n)).cast("int"))
