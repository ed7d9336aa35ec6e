"""Shared pieces: scratch tables, UTF-8 blocks of whole texts, vectorised word hashing.

Texts reach Python as Arrow batches. ``text_blocks`` cuts a batch into runs of
whole documents of at most ``BLOCK_BYTES`` so that numpy temporaries stay small;
one longer document forms a block of its own and is never cut.
"""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 19
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes that go to a Python worker at once, so that its memory doesn't follow the length of texts.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def steady(df: DataFrame) -> DataFrame:
    """The same rows; the session then hands Python workers small batches, unless it is set to smaller ones."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


#: What a worker process keeps from task to task, by name, with what drops it.
KEPT: dict[str, Callable[[], None]] = {}


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def give_back(batches: Iterator[pa.RecordBatch], keep: str = "") -> Iterator[pa.RecordBatch]:
    """The same batches; first drops what other passes kept in this worker, at the end returns freed memory to the system."""
    for name, drop in KEPT.items():
        if name != keep:
            drop()
    _trim()
    try:
        yield from batches
    finally:
        _trim()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir. Only a session without a cluster may leave it unset and gets a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        root = "file://" + tempfile.mkdtemp(prefix="rowkin-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def materialise(df: DataFrame) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: cuts lineage and survives lost executors.

    The table goes when ``release`` is called or else when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/rowkin-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target, files = _hadoop(spark, path)
    files.deleteOnExit(target)
    out = spark.read.schema(df.schema).parquet(path)
    out.rowkin_scratch = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Deletes tables of ``materialise``, and those that a plan says it reads (``rowkin_reads``): call it once what was made of them is written."""
    for df in tables:
        if df is None:
            continue
        release(*df.__dict__.pop("rowkin_reads", ()))
        path = df.__dict__.pop("rowkin_scratch", None)
        if path:
            target, files = _hadoop(df.sparkSession, path)
            files.delete(target, True)


#: Rows of a thin table that may be broadcast; beyond that Spark joins it by shuffling both sides.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df (a materialised thin table) with a broadcast hint if its counted size allows."""
    return F.broadcast(df) if df.count() <= rows else df


#: No more keys than this can each hold more than one part in HOT_KEYS of all rows.
HOT_KEYS = 2000


def look_up(rows: DataFrame, table: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """Inner join of rows with a table of one row per key whose column n counts the key's rows, of total in all.

    Keys with more than one in HOT_KEYS of the rows are at most HOT_KEYS by count: they
    are broadcast, so that no task gets a hot key's rows. All other keys are small and
    joined by shuffle.
    """
    least = total // HOT_KEYS + 1
    hot = F.broadcast(table.where(F.col(n) > least))
    cold = rows.join(hot.select(key), key, "left_anti").join(table.where(F.col(n) <= least), key)
    return rows.join(hot, key).unionByName(cold)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive whole texts; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, stop, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x ^= x >> U64(27)
    x *= U64(0x81DADEF4BC2DD44D)
    x ^= x >> U64(33)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        size = max(BLOCK_BYTES + 1, n)
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(size, base, U64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=U64)
    return _powers[kind][:n]


BYTE_VALUES = np.random.RandomState(20240).randint(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes outside words of letters and digits; all of UTF-8's longer signs count as letters.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
NOT_ALNUM[0x80:] = False


def prefix_sums(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Sums of value * base**position: any span's hash follows from two of them."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(values[data] * _power("up", len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _power("down", len(sums))[start] + (end - start).astype(U64))


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and each text's first word (one entry more than texts). Words never cross texts."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = edge[:-1].copy()
    before[1:] |= ~inside[:-1]
    after = edge[1:].copy()
    after[:-1] |= ~inside[1:]
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    return start, end, np.searchsorted(start, offsets)


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


_STEP = [U64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words (also across texts: the caller drops those)."""
    if len(words) < n:
        return np.zeros(0, U64)
    size = len(words) - n + 1
    total = np.zeros(size, U64)
    for i in range(n):
        total = mix(total + words[i : i + size] * _STEP[i % 5])
    return total


class SlotTable:
    """A bounded table from hash to a number. A hash has two slots; an entry takes the first that is free and stays."""

    def __init__(self, bits: int):
        self.bits = bits
        self.keys = np.zeros(1 << bits, U64)
        self.values = np.zeros(1 << bits, np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers, and the places of the hashes that have none."""
        slot = (hashes >> U64(64 - self.bits)).astype(np.int64)
        out = self.values[slot]
        rest = np.flatnonzero(self.keys[slot] != hashes)
        if len(rest):
            slot = (hashes[rest] & U64((1 << self.bits) - 1)).astype(np.int64)
            out[rest] = self.values[slot]
            rest = rest[self.keys[slot] != hashes[rest]]
        return out, rest

    def store(self, hashes: np.ndarray, values: np.ndarray) -> None:
        for shift in (64 - self.bits, 0):
            slot = ((hashes >> U64(shift)) & U64((1 << self.bits) - 1)).astype(np.int64)
            free = np.flatnonzero(self.keys[slot] == 0)
            free = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[free]], self.values[slot[free]] = hashes[free], values[free]
            left = self.keys[slot] != hashes
            hashes, values = hashes[left], values[left]


def planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unplanes(raw: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def pack(keys: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    """Sorted keys as gaps, byte plane by byte plane."""
    return packer.compress(planes(np.diff(keys, prepend=U64(0))))


def keys_in(raw: bytes) -> int:
    """How many keys were packed."""
    return zstandard.frame_content_size(raw) // 8


def unpack(raw: bytes, opener: zstandard.ZstdDecompressor) -> np.ndarray:
    return np.cumsum(unplanes(opener.decompress(raw), "<u8"), dtype=U64)
