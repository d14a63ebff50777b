"""Helpers shared by the operators: worker-side caches, word hashing, keyed lookups."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

BATCH_BYTES = 4 << 20


#: Whole texts go to Python workers in batches of at most so many rows, unless the session says otherwise.
TEXT_BATCH_ROWS = 512
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession) -> None:
    """Rows of whole texts (two of them in pairs) are too large for Spark's 10,000 rows a batch."""
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(TEXT_BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage is cut, and a
    lost executor costs no recomputation."""
    text_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its rows and their text, both measured, are few; else as it is.
    No more than the bound is read to find out."""
    rows = BROADCAST_ROWS if rows is None else rows
    n, size = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_BYTES else df


def file_bytes(path: str, most: int = 64 << 20) -> bytes:
    """A vocabulary file, read on the driver to be sent with the tasks; its size is checked."""
    with open(path, "rb") as f:
        data = f.read(most + 1)
    if len(data) > most:
        raise ValueError(f"{path} has over {most} bytes; a vocabulary is expected")
    return data


class TwoGenerations(dict):
    """Memo of a pure function with bounded memory: when the young generation is full it
    becomes the old one and the former old one is dropped.  Long keys are never kept."""

    def __init__(self, make: Callable, entries: int = 200_000, longest: int = 60):
        super().__init__()
        self.make, self.entries, self.longest, self.old = make, entries, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


_PER_WORKER: dict = {}
_USES = [0]
#: A worker that waits for its next task keeps its tables for so many seconds.
IDLE_SECONDS = 3.0


def per_worker(name: str, payload: bytes, build: Callable[[bytes], object]) -> object:
    """An object built once in each Python worker from a broadcast file (vocabulary tables and
    memos).  A worker keeps one, and only while tasks that use it follow each other: it goes
    once the worker has been idle (see ``idle``), so it doesn't take memory from later stages."""
    key = (name, hashlib.sha1(payload).hexdigest())
    _USES[0] += 1
    if key not in _PER_WORKER:
        _PER_WORKER.clear()
        _PER_WORKER[key] = build(payload)
    return _PER_WORKER[key]


def idle() -> None:
    """Called when a task has read its last batch: unless another task asks for the worker's
    tables soon, they are dropped and their memory goes back to the system."""
    if not _PER_WORKER:
        return
    uses = _USES[0]

    def drop() -> None:
        if _USES[0] == uses:
            _PER_WORKER.clear()
            gc.collect()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    timer = threading.Timer(IDLE_SECONDS, drop)
    timer.daemon = True
    timer.start()


def added(kept: DataFrame, **made: T.DataType) -> T.StructType:
    """The schema of all columns of ``kept`` but the last (the text), then the ``made`` ones."""
    fields = kept.schema.fields[:-1]
    clash = sorted({f.name for f in fields} & set(made))
    if clash:
        raise ValueError(f"columns {clash} are made here and must not be among the kept ones")
    return T.StructType([*fields, *(T.StructField(n, t) for n, t in made.items())])


def slices(batches: Iterator[pa.RecordBatch], column: str | int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text of one slice stays near ``most`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(column if isinstance(column, int) else batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()
    idle()


def utf8_rows(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column as one array, and each row's bounds (nulls are empty)."""
    col = col.cast(pa.large_binary()) if col.type in (pa.string(), pa.large_string(), pa.binary()) else col
    if col.null_count:
        col = pc.fill_null(col, b"")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), on unsigned arrays."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: The white space that separates words in the contracts: space and U+0009 to U+000D.
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space, over all rows at once.

    Returns first byte, end byte and row of each word, and the number of words per row.
    Row ends separate words as white space does."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(len(offsets) - 1, np.int64)
    word = ~_SPACE[raw]
    start = word.copy()
    start[1:] &= ~word[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < n]
    start[inner] = word[inner]
    end = np.zeros(n + 1, bool)
    end[1:] = word
    end[1:n] &= ~word[1:]
    at = inner[inner > 0]
    end[at] = word[at - 1]
    a, b = np.flatnonzero(start), np.flatnonzero(end)
    row = np.searchsorted(offsets, a, side="right") - 1
    return a, b, row, np.bincount(row, minlength=len(offsets) - 1)


def word_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bytes of words only, in order."""
    size = b - a
    first = np.cumsum(size) - size
    return raw[np.repeat(a - first, size) + np.arange(int(size.sum()), dtype=np.int64)]


def hashes_of(bytes_: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, given the bytes of all words and their lengths."""
    if not len(size):
        return np.zeros(0, np.uint64)
    longest = int(size.max())
    power = np.empty(longest, np.uint64)
    power[0] = 1
    if longest > 1:
        np.multiply.accumulate(np.full(longest - 1, 0x9E3779B97F4A7C15, np.uint64), out=power[1:])
    first = np.cumsum(size) - size
    place = np.arange(len(bytes_), dtype=np.int64) - np.repeat(first, size)
    return mix(np.add.reduceat((bytes_.astype(np.uint64) + np.uint64(1)) * power[place], first) + size.astype(np.uint64))


def word_hashes(raw: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: polynomial over the bytes (wrapping), then mixed."""
    return hashes_of(word_bytes(raw, a, b), b - a) if len(a) else np.zeros(0, np.uint64)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive hashes (len(h) - k + 1 of them; rows not regarded)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9FB21C651E98DF25) + h[i: i + len(out)]
    return mix(out)


def salted_lookup(rows: DataFrame, key: str, value: DataFrame, salts: int, salt_of: str) -> DataFrame:
    """``rows`` joined (left) with ``value`` (one row per ``key``), where a key may hold most rows.

    Each row gets one of ``salts`` numbers from ``salt_of``; ``value`` is repeated once for
    each of them, so no join partition receives more than a fraction of a hot key."""
    copies = value.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salts)).cast("int"))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")
