"""Operator 4, best-fit packing planned on a length histogram.

Pieces of at most ``capacity`` tokens are counted by length; best-fit
decreasing runs on these counts (at most ``capacity`` rows), whole groups of
equal bins at a time. The plan gives, for each length, ranges of ranks and
where they go; pieces take their place by rank within their length.

Defined results: a null or empty text is one piece, the end token alone.
Repeated rows are packed each on their own; rows that agree in everything are
interchangeable. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowkin.llm.common import give_back, materialise, steady
from rowkin.llm.token_ids import encoded, tokenizer_path

CAPACITY, END_ID = 2048, 0
#: Pieces of one length that are ranked by one task.
RANKED = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "sequence_id long, offset long"


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    for rows, ids, first in encoded(batches, path):
        n = rows.num_rows
        count = np.diff(first) + 1
        stream = np.full(len(ids) + n, END_ID, "<u4")
        stream[np.arange(len(ids)) + np.repeat(np.arange(n), count - 1)] = ids
        begin = np.cumsum(count) - count
        pieces = -(-count // capacity)
        doc = np.repeat(np.arange(n), pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * capacity
        length = np.minimum(count[doc] - start, capacity)
        left = begin[doc] + start
        crc = [zlib.crc32(stream[a:b]) for a, b in zip(left.tolist(), (left + length).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [rows.column(0).cast(pa.int64()).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return steady(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda batches: give_back(_cut(batches, path, capacity), keep="tokens"), PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing on counts.

    Rows are (length, first rank, first sequence, pieces in a sequence, offset of
    the first): the k-th rank from there is piece k % pieces of sequence
    first + k // pieces. Also the number of sequences. Its size depends on the
    lengths, not on how many documents there are.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    sequences = 0

    def put(room: int, first: int, bins: int) -> None:
        if bins and room:
            if room not in free:
                bisect.insort(rooms, room)
                free[room] = []
            free[room].append((first, bins))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, bins = free[room].pop()
                if not free[room]:
                    del free[room], rooms[at]
            else:
                room, first = capacity, sequences
                bins = -(-left // (capacity // length))
                sequences += bins
            each = room // length
            full = min(bins, left // each)
            rows.append((length, rank, first, each, capacity - room))
            put(room - each * length, first, full)
            rank, left = rank + full * each, left - full * each
            if full < bins and left:  # fewer than a bin takes: this length ends here
                rows.append((length, rank, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                put(room, first + full + 1, bins - full - 1)
                left = 0
            else:
                put(room, first + full, bins - full)
            if not full:
                rows.pop(-2)
    return rows, sequences


def ranked(cut: DataFrame, parts: int) -> DataFrame:
    """Rank within length from 0. A common length is ranked in many parts, whose counts give where each starts."""
    key = ["doc_id", "piece", "ids_crc32"]
    cut = cut.withColumn("part", F.pmod(F.xxhash64(*key), F.lit(parts)))
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    begins = counts.select("length", "part", F.coalesce(earlier, F.lit(0)).alias("begin"))
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy(*key))
    return cut.withColumn("own", own).join(begins, ["length", "part"]).withColumn("rank", F.col("begin") + F.col("own") - 1).drop("part", "own", "begin")


def best_fit(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: PIECES and PLACED."""
    path = path or tokenizer_path()
    cut = materialise(pieces(docs, path, capacity))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    rows, _ = plan(histogram, capacity)
    table = np.array(rows or [(0, 0, 0, 1, 0)], np.int64)
    key = (table[:, 0] << 48) + table[:, 1]
    order = np.argsort(key)
    key, table = key[order], table[order]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            row = table[np.searchsorted(key, (length << 48) + rank, "right") - 1]
            k = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(row[:, 2] + k // row[:, 3]), pa.array(row[:, 4] + k % row[:, 3] * length)], names=[x.split()[0] for x in f"{PIECES}, {PLACED}".split(", ")])

    parts = max(16, sum(histogram.values()) // RANKED)
    wide = ranked(cut, parts).select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long"))
    return wide.mapInArrow(place, f"{PIECES}, {PLACED}")
