"""Operator 9, quality rules by compression bands.

A text is judged by its zstandard ratio (compressed bytes / bytes) as a whole
and in fixed chunks, against limits that depend on its length: text that packs
too well repeats itself, text that hardly packs is noise. Chunks cover every
byte: the last one ends with the text and overlaps the one before, and shorter
texts are cut into smaller chunks with limits of their own. Two counting rules
(too few words, too many repeated three-word windows) come before the bands.

Defined results: null and empty texts have zero counts, ratio null, fail the
base rules and are not kept. Repeated rows are judged one by one. Ties on a
limit count as inside the band. Any other input columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.llm.common import BYTE_VALUES, LOWER_VALUES, SPACE, U64, give_back, gram_hash, mix, owners, prefix_sums, span_hash, steady, text_blocks, word_spans

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
LEADING = np.ones(256, bool)
LEADING[0x80:0xC0] = False


@dataclass(frozen=True)
class Bands:
    """Rows of (shortest length in bytes, lowest ratio, highest ratio); a text takes the last row it reaches.

    ``short_chunks`` are rows of (bytes, lowest ratio, highest ratio) for texts of fewer than two chunks of ``chunk_bytes``.
    ``bad_chunks``: the largest share of a text that may lie in chunks outside their band.
    """

    whole: tuple[tuple[int, float, float], ...] = ((0, 0.02, 1.60), (256, 0.14, 0.95), (1024, 0.14, 0.80), (4096, 0.12, 0.72), (16384, 0.10, 0.68), (65536, 0.08, 0.66))
    chunk_bytes: int = 4096
    chunk_band: tuple[float, float] = (0.10, 0.80)
    short_chunks: tuple[tuple[int, float, float], ...] = ((256, 0.10, 0.95), (1024, 0.10, 0.88))
    bad_chunks: float = 0.5
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated_words(data: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Per text: words in three-word windows that occur twice or more in it, the first included."""
    text = owners(first)
    hashes = gram_hash(span_hash(sums, start, end), 3)
    whole = text[:-2] == text[2:] if len(text) > 2 else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    key = mix(hashes[at] + mix(text[at].astype(U64)))
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(text), bool)
    for i in range(3):
        covered[at[twice] + i] = True
    return np.bincount(text[covered], minlength=len(offsets) - 1)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, start: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    breaks = np.flatnonzero(data == 10)
    left = np.union1d(offsets[:-1], breaks + 1)
    left = left[left < len(data)]
    if not len(left):
        return np.zeros(len(offsets) - 1, np.int64)
    right = np.append(left[1:], len(data))
    right = right - ((right > left) & (data[right - 1] == 10))
    worded = np.searchsorted(start, right) > np.searchsorted(start, left)
    left, right = left[worded], right[worded]
    text = np.searchsorted(offsets, left, "right") - 1
    key = mix(span_hash(sums, left, right) + mix(text.astype(U64)))
    order = np.argsort(key, kind="stable")
    again = key[order][1:] == key[order][:-1]
    return np.bincount(text[order[1:][again]], minlength=len(offsets) - 1)


def _limits(length: int, bands: Bands) -> tuple[float, float]:
    low, high = bands.whole[0][1:]
    for least, lo, hi in bands.whole:
        if length >= least:
            low, high = lo, hi
    return low, high


def _chunk_size(length: int, bands: Bands) -> tuple[int, float, float]:
    """The largest chunk of which a text has two, or the smallest, and its band."""
    rows = (*bands.short_chunks, (bands.chunk_bytes, *bands.chunk_band))
    return max((x for x in rows if length >= 2 * x[0]), default=min(rows))


def compression(text: bytes, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[float | None, int, int, bool]:
    """(whole ratio, chunks, chunks outside the band, verdict). A text below the smallest chunk is one chunk, judged as a whole.

    A chunk weighs as many bytes as no chunk before it holds.
    """
    if not text:
        return None, 0, 0, False
    n = len(text)
    ratio = len(packer.compress(text)) / n
    low, high = _limits(n, bands)
    inside = low <= ratio <= high
    size, least, most = _chunk_size(n, bands)
    if n < size:
        return ratio, 1, int(not inside), inside
    bad = bad_bytes = chunks = 0
    for at in range(0, n, size):
        end = min(at + size, n)
        part = len(packer.compress(text[end - size : end])) / size
        chunks += 1
        if not least <= part <= most:
            bad += 1
            bad_bytes += end - at
    return ratio, chunks, bad, inside and bad_bytes <= bands.bad_chunks * n


def _measure(batches: Iterator[pa.RecordBatch], bands: Bands) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=bands.level)
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(1)):
            start, end, first = word_spans(data, offsets)
            sums = prefix_sums(data)
            n_words = np.diff(first)
            repeats = repeated_words(data, offsets, start, end, first, sums)
            packed = [compression(data[a:b].tobytes(), packer, bands) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            failed = (n_words < bands.min_words) | (100 * repeats > bands.max_repeat_percent * n_words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo).cast(pa.int64()),
                    pa.array(n_words),
                    pa.array(_per_text(LEADING[data] & ~SPACE[data], offsets)),
                    pa.array(_per_text(SYMBOLS[data], offsets)),
                    pa.array(duplicate_lines(data, offsets, start, sums)),
                    pa.array(repeats),
                    pa.array(failed),
                    pa.array(~failed & np.array([x[3] for x in packed], bool)),
                    pa.array([x[0] for x in packed], pa.float64()),
                    pa.array([x[1] for x in packed], pa.int64()),
                    pa.array([x[2] for x in packed], pa.int64()),
                ],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )


def quality_rules(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """One row per input row, with counts, ratios and the verdict. One pass, no shuffle."""
    bands = bands or Bands()
    return steady(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda batches: give_back(_measure(batches, bands)), SCHEMA)


def keep_good(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """The input's rows and columns without the rejected ones: a filter inside the same pass."""
    bands = bands or Bands()
    names = docs.columns

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            narrow = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(names.index("text"))], names=["doc_id", "text"])
            verdict = [x.column(7) for x in _measure(iter([narrow]), bands)]
            if verdict:
                yield batch.filter(pa.chunked_array(verdict).combine_chunks())

    return steady(docs).mapInArrow(lambda batches: give_back(filtered(batches)), docs.schema)
