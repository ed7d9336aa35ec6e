"""Operator 1, token ids as fixed-stride binary shards in training order.

Every text is cut into sequences of ``Layout.stride`` ids. Sequence number i
(of n) gets the global slot ``permute(i)``: a keyed Feistel network over the
next even power of two, walked until it falls below n, so the slots are a
bijection and nothing but the key and n is stored. Slots are dealt to shards
by range; a shard is a file of records of equal size, so record k of the
training run lies at a computed place and reading resumes anywhere.

Numbers come from two passes over the same partitions: the first counts each
partition's sequences, the second numbers them from the sum of the earlier
counts and fails if a partition no longer holds what was counted, so the source
must be stable, as files are. (Writing the ids once instead would need the shuffle,
the shards and a copy of all ids on disk at the same time.)

The folder is an Arrow file system's (a local or mounted path, s3, gs, hdfs); another
scheme fails before any work. Column ``path`` names each record's shard file.
Attempts write under names that begin with a dot and rename when whole; what lost
attempts leave behind ``tidy`` deletes once the job is done.

Defined results: a null or empty text has no sequences. Repeated rows are
separate sequences. Extra columns are ignored. An empty table writes no shard.
A record's unused places hold ``Layout.fill``; ``n_tokens`` tells how many are used.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.llm.common import U64, give_back, mix, planes, scratch_root, steady, unplanes
from rowkin.llm.token_ids import encoded, largest_id, tokenizer_path


@dataclass(frozen=True)
class Layout:
    stride: int = 512
    slots_per_shard: int = 16384
    key: int = 20_240_117
    rounds: int = 6
    fill: int = 65535
    dtype: str = "<u2"  # must hold every id below ``fill``; "<u4" for larger vocabularies

    @property
    def record_bytes(self) -> int:
        return self.stride * np.dtype(self.dtype).itemsize


def _round(half: np.ndarray, key: int, i: int, mask: np.uint64) -> np.ndarray:
    return mix(half + U64((key * 0x9E3779B97F4A7C15 + (i + 1) * 0xC2B2AE3D27D4EB4F) % (1 << 64))) & mask


def permute(number: np.ndarray, n: int, key: int, rounds: int = 6, inverse: bool = False) -> np.ndarray:
    """A keyed bijection of 0..n-1."""
    half_bits = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, shift = U64((1 << half_bits) - 1), U64(half_bits)
    out = np.asarray(number).astype(U64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for i in range(rounds)[:: -1 if inverse else 1]:
            if inverse:
                left, right = right ^ _round(left, key, i, mask), left
            else:
                left, right = right, left ^ _round(right, key, i, mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= U64(n)]
    return out.astype(np.int64)


def _sequences(ids: np.ndarray, first: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, piece, first id and number of ids of each sequence."""
    count = np.diff(first)
    pieces = -(-count // stride)
    doc = np.repeat(np.arange(len(count)), pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return doc, piece, first[:-1][doc] + piece * stride, np.minimum(count[doc] - piece * stride, stride)


def _count(batches: Iterator[pa.RecordBatch], path: str, stride: int) -> Iterator[pa.RecordBatch]:
    total, check = 0, 0
    for rows, ids, first in encoded(batches, path):
        total += int((-(-np.diff(first) // stride)).sum())
        check = zlib.crc32(ids.tobytes(), check)
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total], pa.int64()), pa.array([check], pa.int64())], names=["part", "n", "check"])


def _number(batches: Iterator[pa.RecordBatch], path: str, layout: Layout, begins: tuple[np.ndarray, ...], n: int) -> Iterator[pa.RecordBatch]:
    own = int(np.searchsorted(begins[0], TaskContext.get().partitionId()))
    begin, counted, check = (int(x[own]) for x in begins[1:])
    packer, at, seen = zstandard.ZstdCompressor(level=1), begin, 0
    for rows, ids, first in encoded(batches, path):
        seen = zlib.crc32(ids.tobytes(), seen)
        doc, piece, left, size = _sequences(ids, first, layout.stride)
        slots = permute(np.arange(at, at + len(doc)), n, layout.key, layout.rounds) if len(doc) else np.zeros(0, np.int64)
        at += len(doc)
        short = ids.astype(layout.dtype)
        packed = [packer.compress(planes(short[a : a + k])) for a, k in zip(left.tolist(), size.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots), rows.column(0).cast(pa.int64()).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(packed, pa.binary())],
            names=["slot", "doc_id", "piece", "n_tokens", "packed"],
        )
    if (at - begin, seen) != (counted, check):
        raise RuntimeError("a partition changed between counting and writing")


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


PLACED = "slot long, shard long, byte_offset long, doc_id long, piece int, n_tokens int, record_crc32 long, path string"


def _write(batches: Iterator[pa.RecordBatch], folder: str, layout: Layout, n: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows to shard files. A repeated attempt writes the same bytes and renames them over."""
    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)
    opener = zstandard.ZstdDecompressor()
    shard, sink, temp, expected = -1, None, "", 0
    place = folder.rstrip("/")

    def close() -> None:
        if sink is not None:
            if expected != min(n, (shard + 1) * layout.slots_per_shard):
                raise RuntimeError(f"shard {shard} ends at slot {expected}")
            sink.close()
            store.move(temp, os.path.join(root, shard_name(shard)))

    for batch in batches:
        crc = []
        slots, sizes = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        for slot, size, packed in zip(slots, sizes, batch.column(4).to_pylist(), strict=True):
            if slot // layout.slots_per_shard != shard:
                close()
                shard = slot // layout.slots_per_shard
                expected = shard * layout.slots_per_shard
                temp = os.path.join(root, f".{shard_name(shard)}.{uuid.uuid4().hex}")
                sink = store.open_output_stream(temp)
            if slot != expected:
                raise RuntimeError(f"slot {expected} is missing")
            expected += 1
            record = np.full(layout.stride, layout.fill, layout.dtype)
            record[:size] = unplanes(opener.decompress(packed, max_output_size=size * np.dtype(layout.dtype).itemsize), layout.dtype)
            raw = record.tobytes()
            crc.append(zlib.crc32(raw))
            sink.write(raw)
        at = batch.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(at // layout.slots_per_shard), pa.array(at % layout.slots_per_shard * layout.record_bytes), *batch.columns[1:4], pa.array(crc, pa.int64()), pa.array([f"{place}/{shard_name(x)}" for x in (at // layout.slots_per_shard).tolist()])],
            names=[x.split()[0] for x in PLACED.split(", ")],
        )
    close()


def write_training_order(docs: DataFrame, folder: str | None = None, layout: Layout | None = None, path: str | None = None) -> DataFrame:
    """Writes the shards when the result is evaluated; one row per sequence says where its record lies."""
    layout, path = layout or Layout(), path or tokenizer_path()
    spark = docs.sparkSession
    folder = folder or f"{scratch_root(spark)}/rowkin-shards-{uuid.uuid4().hex}"
    _filesystem(folder)  # fails here rather than on the executors
    if largest_id(path) >= min(layout.fill, 1 << 8 * np.dtype(layout.dtype).itemsize):
        raise ValueError(f"the tokenizer's ids reach {largest_id(path)}: fill {layout.fill} and dtype {layout.dtype} can't tell them apart")
    texts = steady(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = texts.mapInArrow(lambda b: give_back(_count(b, path, layout.stride), keep="tokens"), "part long, n long, check long").collect()  # a row per partition
    parts, sizes, checks = (np.array([row[k] for row in sorted(counts)], np.int64) for k in ("part", "n", "check"))
    n = int(sizes.sum())
    begins = spark.sparkContext.broadcast((parts, np.cumsum(sizes) - sizes, sizes, checks))  # 32 bytes a partition
    numbered = texts.mapInArrow(lambda b: give_back(_number(b, path, layout, begins.value, n), keep="tokens"), "slot long, doc_id long, piece int, n_tokens int, packed binary")
    shards = -(-n // layout.slots_per_shard)
    parts = max(1, min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * layout.record_bytes // (64 << 20))))
    per_part = max(1, -(-shards // parts))
    ranged = numbered.repartitionById(parts, (F.col("slot") / F.lit(layout.slots_per_shard * per_part)).cast("int")).sortWithinPartitions("slot")
    return ranged.mapInArrow(lambda b: give_back(_write(b, folder, layout, n)), PLACED)


def tidy(folder: str) -> int:
    """Deletes what attempts that were lost left behind; to be called when no job writes to the folder. Returns how many files."""
    store, root = _filesystem(folder)
    left = [x.path for x in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if os.path.basename(x.path).startswith(".shard-")]
    for path in left:
        store.delete_file(path)
    return len(left)


def read_from(folder: str, slot: int, layout: Layout) -> Iterator[np.ndarray]:
    """Records in training order from a slot on, sequentially and across shards."""
    store, root = _filesystem(folder)
    while True:
        name = os.path.join(root, shard_name(slot // layout.slots_per_shard))
        if store.get_file_info(name).type == pafs.FileType.NotFound:
            return
        with store.open_input_file(name) as source:
            source.seek(slot % layout.slots_per_shard * layout.record_bytes)
            while raw := source.read(layout.record_bytes):
                yield np.frombuffer(raw, layout.dtype)
                slot += 1
        if slot % layout.slots_per_shard:
            return
