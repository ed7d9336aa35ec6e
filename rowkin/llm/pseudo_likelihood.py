"""Operator 7, language-model scoring by masked pseudo-likelihood.

A network reads ``Shape.side`` words on both sides of a masked one: vectors by
place are added, pass a tanh layer, and give the masked word's class and its
place in the class. The commonest ``Shape.known`` words have outputs of their own;
all others share learned outputs by hash (buckets), as inputs and as targets, so
every word is predicted from both sides. Which word of its bucket it is follows
from counts over the whole corpus without the document itself: a word that other
documents hold has its share there, one that none holds pays the bucket's share of
new words and is spelled by byte frequencies. The sum of these conditional
log-probabilities over all words scores a document.

What the model knows is gathered from the whole corpus and grows with it: counts of
every word of every document, dealt by hash and handed back to each run of texts;
then rounds of training in which every task trains a copy on its own documents, and
the copies are averaged in a tree, weighted by their places. A round masks
``1 / rounds`` of the residues of ``Shape.stride``, so that over all rounds every word
of every document is masked once. The network, which is all that reaches the
driver, has a fixed size. As copies are averaged, scores depend a little on how the
input is partitioned; counts and buckets don't.

Defined results: null and empty texts, and texts without a word, have no words,
sum 0 and a null mean. Repeated rows are scored one by one, count each time and are
other documents to each other. Ties in frequency go to the lower hash. Extra columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.llm.common import LOWER_VALUES, NOT_ALNUM, U64, give_back, materialise, mix, owners, pack, planes, prefix_sums, release, span_hash, steady, text_blocks, unpack, unplanes, word_spans


@dataclass(frozen=True)
class Shape:
    classes: int = 64
    per_class: int = 64
    buckets: int = 1024  # outputs shared by all words that have none of their own
    hidden: int = 16
    side: int = 2
    stride: int = 8
    rounds: int = 2
    batch: int = 4096
    rate: float = 0.1

    @property
    def size(self) -> int:
        return self.classes * self.per_class

    @property
    def known(self) -> int:
        return self.size - self.buckets


#: Words of one class that are scored together, at least.
ROWS = 32
#: Words whose scores are made at once.
AT_ONCE = 32768
CHUNKS = 64
#: Copies of the model, or of means of copies, that one task averages.
FAN = 64
#: The most slices (as a power of two) of the hash range; one task tallies a slice.
SLICES = 14
END = 256  # the sign that ends a word

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def bucket_of(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    """Buckets ascend with the hash, so a slice of the hash range holds few of them."""
    return (((hashes >> U64(32)) * U64(shape.buckets)) >> U64(32)).astype(np.int64)


def _spans(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of the spans in a row."""
    return data[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]


READ = "run long, doc_ids array<long>, first binary, words binary, at binary, letters binary, sizes binary, tally binary, signs binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of whole texts: distinct words (hash, letters, count) and each word's place among them."""
    packer, number = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 32
    for batch in batches:
        hashes, first, letters, sizes, own = [np.zeros(0, U64)], [np.zeros(1, np.int64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)], [np.zeros(0, U64)]
        signs, seen = np.zeros(257, np.int64), 0
        for _, _, data, offsets in text_blocks(batch.column(1)):
            start, end, begin = word_spans(data, offsets, NOT_ALNUM)
            h = span_hash(prefix_sums(data, LOWER_VALUES), start, end)
            new, where = np.unique(h, return_index=True)
            own.append(new)
            sizes.append((end - start)[where])
            letters.append(LOWER[_spans(data, start[where], sizes[-1])])
            hashes.append(h)
            first.append(begin[1:] + seen)
            seen += len(h)
            signs[:256] += np.bincount(LOWER[data[~NOT_ALNUM[data]]], minlength=256)
        signs[END] = seen
        words, where = np.unique(np.concatenate(own), return_index=True)
        size, every = np.concatenate(sizes), np.concatenate(letters)
        said = _spans(every, (np.cumsum(size) - size)[where], size[where])
        at = np.searchsorted(words, np.concatenate(hashes)).astype("<u4")
        tally = np.bincount(at, minlength=len(words)).astype("<u4")
        column = lambda x: pa.array([x], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())), column(_squeeze(np.concatenate(first), "<i8", packer)), column(pack(words, packer) if len(words) else b""), *(column(_squeeze(x, "<u4", packer)) for x in (at,)), column(packer.compress(said.tobytes())), column(_squeeze(size[where], "<u4", packer)), column(_squeeze(tally, "<u4", packer)), column(signs.astype("<i8").tobytes())],
            names=[x.split()[0] for x in READ.split(", ")],
        )
        number += 1


def _squeeze(values: np.ndarray, dtype: str, packer: zstandard.ZstdCompressor) -> bytes:
    return packer.compress(planes(values.astype(dtype))) if len(values) else b""


def _open(raw: bytes, dtype: str, opener: zstandard.ZstdDecompressor) -> np.ndarray:
    return unplanes(opener.decompress(raw), dtype) if raw else np.zeros(0, dtype)


def _deal(batches: Iterator[pa.RecordBatch], slice_bits: int) -> Iterator[pa.RecordBatch]:
    """Each run's words and counts by slices of the hash range."""
    packer, opener = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    for batch in batches:
        for row in batch.to_pylist():
            if not row["words"]:
                continue
            words, tally = unpack(row["words"], opener), _open(row["tally"], "<u4", opener)
            edges = np.arange(1, 1 << slice_bits, dtype=np.uint64) << U64(64 - slice_bits)
            cuts = np.concatenate([[0], np.searchsorted(words, edges), [len(words)]])
            used = np.flatnonzero(np.diff(cuts)).tolist()
            parts = [slice(int(cuts[i]), int(cuts[i + 1])) for i in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array([row["run"]] * len(used), pa.int64()), pa.array([pack(words[x], packer) for x in parts], pa.binary()), pa.array([_squeeze(tally[x], "<u4", packer) for x in parts], pa.binary())],
                names=["slice", "run", "words", "tally"],
            )


TALLY = "kind int, run long, slice long, key long, n long, m long, counts binary"
RUN, TOP, BUCKET = 0, 1, 2


def _tally(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[pa.RecordBatch]:
    """Per slice: every run's words' counts in the corpus, candidates for the commonest words, and each bucket's words and tokens. Rows come sorted by slice."""
    packer, opener = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

    def rows(kind: int, at: int, runs: list, keys: list, n: list, m: list, counts: list) -> pa.RecordBatch:
        size = max(map(len, (runs, keys)))
        values = ([kind] * size, runs or [None] * size, [at] * size, keys or [None] * size, n or [None] * size, m or [None] * size, counts or [None] * size)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), *[pa.int64()] * 5, pa.binary()), strict=True)], names=[x.split()[0] for x in TALLY.split(", ")])

    def finish(at: int, held: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sizes = [len(x[1]) for x in held]
        words, back = np.unique(np.concatenate([x[1] for x in held]), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate([x[2] for x in held]).astype(np.float64)).astype(np.int64)
        cuts = np.cumsum([0, *sizes]).tolist()
        yield rows(RUN, at, [x[0] for x in held], [], [], [], [_squeeze(total[back[a:b]], "<u8", packer) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        top = np.lexsort((words.view(np.int64), -total))[: shape.known]
        yield rows(TOP, at, [], words[top].view(np.int64).tolist(), total[top].tolist(), [], [])
        bucket = bucket_of(words, shape)
        own, begin = np.unique(bucket, return_index=True)
        yield rows(BUCKET, at, [], own.tolist(), np.add.reduceat(total, begin).tolist(), np.diff(np.append(begin, len(words))).tolist(), [])

    at, held = -1, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["slice"] != at and held:
                yield from finish(at, held)
                held = []
            at = row["slice"]
            held.append((row["run"], unpack(row["words"], opener), _open(row["tally"], "<u4", opener)))
    if held:
        yield from finish(at, held)


def _signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(257, np.int64)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            total += np.frombuffer(raw, "<i8")
    yield pa.RecordBatch.from_arrays([pa.array(range(257), pa.int64()), pa.array(total)], names=["sign", "n"])


@dataclass
class Vocabulary:
    hashes: np.ndarray  # in order of frequency
    counts: np.ndarray  # of all ids: words of their own, then buckets
    spelling: np.ndarray  # log-probability of each byte and of a word's end
    types: np.ndarray  # different words of each bucket


CODED = "doc_ids array<long>, first binary, ids binary, inside binary, novel binary"


def _code(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, shape: Shape) -> Iterator[pa.RecordBatch]:
    """Runs as ids, with log p(word | bucket) of each bucketed word and each text's words that no other text holds."""
    packer, opener = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    order = np.argsort(vocabulary.hashes)
    known = vocabulary.hashes[order]
    tokens, types = vocabulary.counts[shape.known :], np.maximum(vocabulary.types, 1)
    for batch in batches:
        for row in batch.to_pylist():
            first = _open(row["first"], "<i8", opener)
            ids, inside, novel = np.zeros(0, np.int64), np.zeros(0), np.zeros(len(first) - 1, np.int64)
            if row["words"]:
                words, at, size = unpack(row["words"], opener), _open(row["at"], "<u4", opener).astype(np.int64), _open(row["sizes"], "<u4", opener).astype(np.int64)
                total = np.concatenate([_open(x["counts"], "<u8", opener) for x in row["counts"]]).astype(np.int64)
                letters = np.frombuffer(opener.decompress(row["letters"]), np.uint8)
                spelled = np.add.reduceat(vocabulary.spelling[letters], np.cumsum(size) - size) + vocabulary.spelling[END]
                of_word = shape.known + bucket_of(words, shape)
                if len(known):
                    place = np.minimum(np.searchsorted(known, words), len(known) - 1)
                    hit = known[place] == words
                    of_word[hit] = order[place[hit]]
                ids = of_word[at]
                rare = np.flatnonzero(ids >= shape.known)
                word, bucket, text = at[rare], ids[rare] - shape.known, owners(first)[rare]
                elsewhere = total[word] - _equal(text * len(words) + word)
                outside = tokens[bucket] - _equal(text * shape.buckets + bucket) + types[bucket]
                inside = np.where(elsewhere > 0, np.log(np.maximum(elsewhere, 1)), np.log(types[bucket]) + spelled[word]) - np.log(np.maximum(outside, 1))
                novel = np.bincount(text[elsewhere <= 0], minlength=len(novel))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["doc_ids"]], pa.list_(pa.int64())), *(pa.array([_squeeze(x, t, packer)], pa.binary()) for x, t in ((first, "<i8"), (ids, "<u2" if shape.size <= 1 << 16 else "<u4"), (inside, "<f4"), (novel, "<i8")))],
                names=[x.split()[0] for x in CODED.split(", ")],
            )


def _equal(keys: np.ndarray) -> np.ndarray:
    """How many keys equal each one."""
    _, back, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[back]


def gather(docs: DataFrame, shape: Shape) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and the corpus in ids (CODED): words are read and hashed once."""
    read = materialise(steady(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda b: give_back(_read(b)), READ))
    bits = min(max(8, read.count().bit_length()), SLICES)
    dealt = read.select("run", "words", "tally").mapInArrow(lambda b: give_back(_deal(b, bits)), "slice long, run long, words binary, tally binary")
    tallied = materialise(dealt.repartition("slice").sortWithinPartitions("slice", "run").mapInArrow(lambda b: give_back(_tally(b, shape)), TALLY))
    top = tallied.where(F.col("kind") == TOP).orderBy(F.desc("n"), "key").limit(shape.known).collect()
    buckets = tallied.where(F.col("kind") == BUCKET).groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect()  # one row each
    signs = np.ones(257)
    for row in read.select("signs").mapInArrow(_signs, "sign long, n long").groupBy("sign").agg(F.sum("n").alias("n")).collect():
        signs[row["sign"]] += row["n"]
    hashes = np.array([r["key"] for r in top], np.int64).view(U64)
    counts, types = np.zeros(shape.size), np.zeros(shape.buckets, np.int64)
    counts[: len(top)] = [r["n"] for r in top]
    for row in buckets:
        counts[shape.known + row["key"]] += row["n"]
        types[row["key"]] += row["m"]
    np.subtract.at(counts, shape.known + bucket_of(hashes, shape), counts[: len(top)])
    np.subtract.at(types, bucket_of(hashes, shape), 1)
    vocabulary = Vocabulary(hashes, counts, np.log(signs / signs.sum()), types)
    mine = tallied.where(F.col("kind") == RUN).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("slice", "counts"))).alias("counts"))
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    whole = read.drop("tally", "signs").join(mine, "run", "left").select("doc_ids", "first", "words", "at", "letters", "sizes", "counts")
    coded = materialise(whole.mapInArrow(lambda b: give_back(_code(b, known.value, shape)), CODED))
    release(read, tallied)
    return vocabulary, coded


class Places:
    """Where the words of a run of texts stand: words in a row, with ``side`` signs for no word around each text."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, shape: Shape):
        self.shape = shape
        self.at = np.arange(len(ids)) + shape.side * (owners(first) + 1)
        self.ids = np.full(len(ids) + shape.side * len(first), shape.size, np.int64)
        self.ids[self.at] = ids

    def contexts(self, at: np.ndarray | slice) -> np.ndarray:
        """(word, place) rows into the table of vectors for the words ``at``: a row block per place, whose last row stands for no word."""
        shape, here = self.shape, self.at[at]
        out = np.empty((len(here), 2 * shape.side), np.int64)
        for k, step in enumerate([*range(-shape.side, 0), *range(1, shape.side + 1)]):
            np.add(self.ids[here + step], k * (shape.size + 1), out=out[:, k])
        return out


def contexts(ids: np.ndarray, first: np.ndarray, shape: Shape, at: np.ndarray | None = None) -> np.ndarray:
    """Contexts of all words or those ``at``."""
    return Places(ids, first, shape).contexts(slice(None) if at is None else at)


def start_model(vocabulary: Vocabulary, shape: Shape, seed: int = 3) -> dict[str, np.ndarray]:
    r = np.random.RandomState(seed)
    f = lambda *n: (r.randn(*n) * 0.1).astype(np.float32)
    counts = (vocabulary.counts + 1).reshape(shape.classes, shape.per_class)
    return {
        "vectors": f(2 * shape.side * (shape.size + 1), shape.hidden),
        "bias": np.zeros(shape.hidden, np.float32),
        "classes": f(shape.hidden, shape.classes),
        "class_bias": np.log(counts.sum(1) / counts.sum()).astype(np.float32),
        "words": f(shape.size, shape.hidden),
        "word_bias": np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32).reshape(-1),
    }


def _pick(x: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-probability of each row's place, exponentials, their sums). One shift for all rows of a block: scores lie close together."""
    x -= x.max(axis=(-2, -1), keepdims=True)
    at = np.take_along_axis(x, place[..., None], -1)[..., 0]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[-1], x.dtype)
    return at - np.log(total), x, total


def _sum_rows(context: np.ndarray, d_in: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the table that a batch reads, ascending, and the sum of d_in over the words that read each)."""
    read = context.reshape(-1)
    order = np.argsort(read.astype(np.uint16) if len(read) and read.max() < 1 << 16 else read, kind="stable")
    ranked = read[order]
    begin = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]][: len(ranked)])
    each = d_in.take(order // context.shape[1], 0)
    two = np.complex64 if d_in.dtype == np.float32 and d_in.shape[1] % 2 == 0 else d_in.dtype  # adds two columns at once
    return ranked[begin], np.add.reduceat(each.view(two), begin, axis=0).view(d_in.dtype)


def log_probs(model: dict, context: np.ndarray, ids: np.ndarray, shape: Shape, grads: dict | None = None) -> np.ndarray:
    """log p(word | both sides) of each word; with ``grads``, also the summed gradients of minus that, and the rows of vectors that were read."""
    if not len(ids):
        return np.zeros(0)
    h = np.ones((len(ids), shape.hidden + 1), model["vectors"].dtype)  # the last column is for biases
    sums = model["vectors"].take(context[:, 0], 0)
    for k in range(1, context.shape[1]):
        sums += model["vectors"].take(context[:, k], 0)
    sums += model["bias"]
    np.tanh(sums, out=h[:, :-1])
    kind = (ids // shape.per_class).astype(np.uint16)
    out, e, total = _pick(h @ np.vstack([model["classes"], model["class_bias"]]), kind.astype(np.int64))
    out = out.astype(np.float64)
    # words by class, in blocks of ``rows`` that hold one class each; what fills a class's last block counts for nothing
    order = np.argsort(kind, kind="stable")
    count = np.bincount(kind, minlength=shape.classes)
    rows = max(ROWS, len(ids) // 256)
    blocks = -(-count // rows)
    end = np.cumsum(blocks) * rows
    at = np.empty(len(ids), np.int64)
    at[order] = np.arange(len(ids)) + np.repeat(end - blocks * rows - np.cumsum(count) + count, count)
    of = np.repeat(np.arange(shape.classes), blocks)
    inputs, place = np.zeros((len(of) * rows, shape.hidden + 1), h.dtype), np.zeros(len(of) * rows, np.int64)
    inputs[at], place[at] = h, ids % shape.per_class
    words = np.concatenate([model["words"], model["word_bias"][:, None]], 1).reshape(shape.classes, shape.per_class, -1)
    each = inputs.reshape(len(of), rows, -1) @ np.ascontiguousarray(words.transpose(0, 2, 1)).take(of, 0)
    inner, e_inner, total_inner = _pick(each, place.reshape(len(of), rows))
    out += inner.reshape(-1).take(at)
    if grads is not None:
        e *= (1 / total)[:, None]
        e[np.arange(len(ids)), kind] -= 1
        both = e.T @ h
        grads["classes"], grads["class_bias"] = both[:, :-1].T, both[:, -1]
        used = np.zeros(len(of) * rows, h.dtype)
        used[at] = 1
        e_inner *= (used.reshape(total_inner.shape) / total_inner)[..., None]
        flat_e = e_inner.reshape(-1, shape.per_class)
        flat_e[at, place[at]] -= 1
        both = np.zeros((shape.classes, shape.per_class, shape.hidden + 1), h.dtype)
        for c in np.flatnonzero(count).tolist():
            own = slice(int(end[c] - blocks[c] * rows), int(end[c]))
            np.matmul(flat_e[own].T, inputs[own], out=both[c])
        grads["words"], grads["word_bias"] = both[..., :-1].reshape(shape.size, -1), both[..., -1].reshape(-1)
        d_h = e @ model["classes"].T
        d_h += (e_inner @ words[..., :-1].take(of, 0)).reshape(len(of) * rows, -1).take(at, 0)
        d_in = (d_h * (1 - h[:, :-1] * h[:, :-1])).astype(np.float32)
        grads["bias"] = d_in.sum(0)
        grads["vectors"] = np.zeros_like(model["vectors"])
        grads["read"], sums = _sum_rows(context, d_in)
        grads["vectors"][grads["read"]] = sums
    return out


def flat(model: dict) -> np.ndarray:
    return np.concatenate([model[k].reshape(-1) for k in sorted(model)]).astype("<f4")


def unflat(values: np.ndarray, like: dict) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


class Trainer:
    def __init__(self, model: dict, shape: Shape):
        self.model = {k: v.copy() for k, v in model.items()}
        self.squares = {k: np.full_like(v, 1e-3) for k, v in model.items()}
        self.shape, self.places = shape, 0

    def step(self, context: np.ndarray, ids: np.ndarray) -> None:
        grads: dict = {}
        log_probs(self.model, context, ids, self.shape, grads)
        read = grads.pop("read")
        for k, g in grads.items():
            rows = read if k == "vectors" else slice(None)
            g = (g[rows] / len(ids)).astype(np.float32, copy=False)
            squares = self.squares[k][rows] + g * g
            self.squares[k][rows] = squares
            g *= self.shape.rate
            g /= np.sqrt(squares, out=squares)
            self.model[k][rows] -= g
        self.places += len(ids)


def taught(at: np.ndarray, turn: int, shape: Shape) -> np.ndarray:
    """Whether a round masks the words at these places of their documents: over all rounds, each place once."""
    return at % shape.stride % shape.rounds == turn


COPIES = "part long, chunk int, places long, values binary"


def _copies(part: int, places: int, values: list[bytes], chunks: list[int]) -> pa.RecordBatch:
    n = len(chunks)
    return pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int64()), pa.array(chunks, pa.int32()), pa.array([places] * n, pa.int64()), pa.array(values, pa.binary())], names=[x.split()[0] for x in COPIES.split(", ")])


def _ids(raw: bytes, shape: Shape, opener: zstandard.ZstdDecompressor) -> np.ndarray:
    return _open(raw, "<u2" if shape.size <= 1 << 16 else "<u4", opener).astype(np.int64)


def _train(batches: Iterator[pa.RecordBatch], model: dict, shape: Shape, turn: int, part: int = 0) -> Iterator[pa.RecordBatch]:
    """A copy of the model after a task's texts. batches: first, ids."""
    trainer, opener = Trainer(model, shape), zstandard.ZstdDecompressor()
    for batch in batches:
        for first, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            first, ids = _open(first, "<i8", opener), _ids(ids, shape, opener)
            at = np.arange(len(ids)) - np.repeat(first[:-1], np.diff(first))
            chosen = np.flatnonzero(taught(at, turn, shape))
            chosen = chosen[np.argsort(mix(chosen.astype(U64)))]
            places = Places(ids, first, shape)
            for i in range(0, len(chosen), shape.batch):
                some = chosen[i : i + shape.batch]
                trainer.step(places.contexts(some), ids[some])
    if trainer.places:
        yield _copies(part, trainer.places, [x.tobytes() for x in np.array_split(flat(trainer.model), CHUNKS)], list(range(CHUNKS)))


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Means of copies by part and chunk, weighted by places."""
    sums: dict[tuple[int, int], tuple[np.ndarray, int]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            key = row["part"], row["chunk"]
            total, places = sums.get(key, (0.0, 0))
            sums[key] = total + np.frombuffer(row["values"], "<f4").astype(np.float64) * row["places"], places + row["places"]
    for (part, chunk), (total, n) in sums.items():
        yield _copies(part, n, [(total / n).astype("<f4").tobytes()], [chunk])


def mean_model(copies: DataFrame, parts: int, like: dict, fan: int = FAN) -> dict:
    """The mean of all copies (COPIES, of ``parts`` parts) in a tree: no task takes more than ``fan`` copies of a chunk."""
    while True:
        parts = -(-parts // fan)
        copies = copies.withColumn("part", F.floor(F.col("part") / fan)).repartition("part", "chunk").mapInArrow(_average, COPIES)
        if parts <= 1:
            break
    rows = copies.select("chunk", "values").collect()  # one model
    return unflat(np.concatenate([np.frombuffer(r["values"], "<f4") for r in sorted(rows)]), like) if rows else like


def fit(docs: DataFrame, shape: Shape | None = None) -> tuple[dict, Vocabulary, DataFrame]:
    """The trained network, the vocabulary and the corpus in ids."""
    shape = shape or Shape()
    vocabulary, coded = gather(docs, shape)
    model, parts = start_model(vocabulary, shape), coded.rdd.getNumPartitions()
    for turn in range(shape.rounds):
        known = docs.sparkSession.sparkContext.broadcast(model)
        copies = coded.select("first", "ids").mapInArrow(lambda b, known=known, turn=turn: give_back(_train(b, known.value, shape, turn, TaskContext.get().partitionId())), COPIES)
        model = mean_model(copies, parts, model)
    return model, vocabulary, coded


SCHEMA = "doc_id long, n_words long, log_likelihood double, mean_log_prob double, n_novel long"


def score_documents(docs: DataFrame, shape: Shape | None = None) -> DataFrame:
    """One row per input row. ``n_novel``: its words that stand in no other row."""
    shape = shape or Shape()
    model, _, coded = fit(docs, shape)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                first, ids = _open(row["first"], "<i8", opener), _ids(row["ids"], shape, opener)
                each = np.zeros(len(ids) + 1)
                places = Places(ids, first, shape)
                parts = [log_probs(known.value, places.contexts(slice(i, i + AT_ONCE)), ids[i : i + AT_ONCE], shape) for i in range(0, len(ids), AT_ONCE)]
                own = np.concatenate([np.zeros(0), *parts])
                own[ids >= shape.known] += _open(row["inside"], "<f4", opener)
                np.cumsum(own, out=each[1:])
                total, n = each[first[1:]] - each[first[:-1]], np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1), mask=n == 0), pa.array(_open(row["novel"], "<i8", opener))],
                    names=[x.split()[0] for x in SCHEMA.split(", ")],
                )

    return coded.mapInArrow(lambda b: give_back(score(b)), SCHEMA)
