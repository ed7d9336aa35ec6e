"""Operator 5, toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as a learned word vector, the mean of learned vectors of its
character n-grams, and two log-odds (of the word, and the largest of its
n-grams). The network reads every window of ``Shape.window`` words, windows
overlapping, over the whole text. Attention pools its states and the inputs
beside them; a text's score comes from its highest window.

Labels mark whole texts, so training chooses windows: the most toxic-looking one
of a toxic text, the most toxic-looking and some others of a clean one, chosen
anew in each round. It runs in numpy on the driver on a bounded sample of
labelled rows (``Training.toxic`` and ``Training.clean`` texts, together at most
``Training.chars`` signs: in the order of their hash, texts of more than
``Training.longest`` passed over; this is the bound of the fit). Log-odds, network and calibration each get rows of their own.

Defined results: null and empty texts, and texts without a word, score 0.
Repeated rows are scored one by one; a text labelled twice counts as toxic if any
label says so. Ties on the threshold are predicted toxic. Rows without a doc_id
are not held out. Extra columns are ignored. Empty tables: no rows; without
labels of both classes every text with a word scores the labels' mean, or 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowkin.llm.common import LOWER_VALUES, NOT_ALNUM, SlotTable, U64, prefix_sums, span_hash, steady, text_blocks, word_spans

THRESHOLD = 0.3
HELD_OUT = 2
DECAY = 0.05


@dataclass(frozen=True)
class Shape:
    window: int = 48
    step: int = 32
    hidden: int = 8
    wide: int = 4  # of word vectors and of n-gram vectors
    word_bits: int = 15
    gram_bits: int = 16
    odds_bits: int = 18
    grams: tuple[int, ...] = (4, 5, 6)


@dataclass(frozen=True)
class Training:
    toxic: int = 2000
    clean: int = 4000
    chars: int = 60_000_000
    longest: int = 400_000
    rounds: int = 6
    steps: int = 120  # at least so many updates in all
    batch: int = 256
    rate: float = 0.004
    seed: int = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


@dataclass
class Words:
    """Distinct words: hash, and the hashes of their n-grams as ragged rows."""

    hashes: np.ndarray
    grams: np.ndarray
    begin: np.ndarray


def _word_grams(sums: np.ndarray, start: np.ndarray, end: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes of each word in a row, and each word's first one. A short word is its own gram."""
    length = end - start
    counts = [np.maximum(length - n + 1, 0) for n in sizes]
    counts[0] = np.maximum(counts[0], 1)
    total = np.sum(counts, 0)
    begin = np.concatenate([[0], np.cumsum(total)])
    out = np.zeros(int(begin[-1]), U64)
    offset = begin[:-1].copy()
    for n, count in zip(sizes, counts, strict=True):
        k = np.repeat(np.arange(len(start)), count)
        i = np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)
        left = start[k] + i
        out[offset[k] + i] = span_hash(sums, left, np.minimum(left + n, end[k]))
        offset += count
    return out, begin


@dataclass
class Network:
    shape: Shape
    word_odds: np.ndarray
    gram_odds: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    recurrent: bool = True

    def inputs(self, words: np.ndarray, grams: np.ndarray, begin: np.ndarray, odds: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        s, (word_odds, gram_odds) = self.shape, odds or (self.word_odds, self.gram_odds)
        x = np.empty((len(words), 2 * s.wide + 2), np.float32)
        x[:, : s.wide] = self.p["word"][_fold(words, s.word_bits)]
        if len(words):
            x[:, s.wide : 2 * s.wide] = np.add.reduceat(self.p["gram"][_fold(grams, s.gram_bits)], begin[:-1]) / np.diff(begin)[:, None]
            x[:, 2 * s.wide] = word_odds[_fold(words, s.odds_bits)]
            x[:, 2 * s.wide + 1] = np.maximum.reduceat(gram_odds[_fold(grams, s.odds_bits)], begin[:-1])
        return x


def _fold(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def windows(first: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and number of words of all windows; the last one of a text is as long as what is left."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(-(-(n - shape.window) // shape.step), 0) + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    i = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, first[:-1][text] + i * shape.step, np.minimum(n[text] - i * shape.step, shape.window)


def _run(p: dict, side: str, x: np.ndarray, at: np.ndarray, inside: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (window, place, hidden) of one direction. x: input parts of the gates per word."""
    u, h_size = p[f"u{side}"], p[f"u{side}"].shape[0]
    steps = range(at.shape[1]) if side == "f" else range(at.shape[1] - 1, -1, -1)
    h = np.zeros((len(at), h_size), np.float32)
    out = np.empty((len(at), at.shape[1], h_size), np.float32)
    for t in steps:
        g = x[at[:, t]]
        a = h @ u
        z = _sigmoid(g[:, : 2 * h_size] + a[:, : 2 * h_size])
        r, z = z[:, :h_size], z[:, h_size:]
        n = np.tanh(g[:, 2 * h_size :] + r * a[:, 2 * h_size :])
        new = n + z * (h - n)
        m = inside[:, t, None]
        if keep is not None:
            keep.append((t, h, r, z, n, a[:, 2 * h_size :]))
        h = np.where(m, new, h)
        out[:, t] = h
    return out


def _pool(p: dict, states: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    e = np.where(inside, states @ p["attend"], np.float32(-1e9))
    e = np.exp(e - e.max(1, keepdims=True))
    share = e / e.sum(1, keepdims=True)
    pooled = np.einsum("wt,wth->wh", share, states)
    return pooled @ p["out"] + p["bias"][0], share, pooled


def _places(start: np.ndarray, size: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    t = np.arange(longest)
    inside = t < size[:, None]
    return np.where(inside, start[:, None] + t, start[:, None]), inside


def window_logits(net: Network, table: np.ndarray, words: np.ndarray, start: np.ndarray, size: np.ndarray, batch: int = 2048) -> np.ndarray:
    """table: inputs of distinct words; words: their rows in text order. Windows come in order of their starts.

    ``net.recurrent`` false leaves the states out of attention and score, to measure what they add.
    """
    out = np.empty(len(start), np.float32)
    for i in range(0, len(start), batch):
        some = slice(i, i + batch)
        lo = int(start[i])
        x = table[words[lo : int((start[some] + size[some]).max())]]
        gates = {side: x @ net.p[f"w{side}"] + net.p[f"b{side}"] for side in "fb"}
        at, inside = _places(start[some] - lo, size[some], int(size[some].max()))
        states = np.concatenate([*(_run(net.p, side, gates[side], at, inside) * np.float32(net.recurrent) for side in "fb"), x[at]], 2)
        out[some] = _pool(net.p, states, inside)[0]
    return out


def _gradients(net: Network, x: np.ndarray, start: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray]:
    """Of the weighted log loss, for the parameters and for x."""
    p, h_size = net.p, net.shape.hidden
    at, inside = _places(start, size, net.shape.window)
    kept: dict[str, list] = {"f": [], "b": []}
    gates = {side: x @ p[f"w{side}"] + p[f"b{side}"] for side in "fb"}
    states = np.concatenate([*(_run(p, side, gates[side], at, inside, kept[side]) for side in "fb"), x[at]], 2)
    logit, share, pooled = _pool(p, states, inside)
    d = ((_sigmoid(logit) - y) * weight).astype(np.float32)
    g = {"bias": np.array([d.sum()]), "out": pooled.T @ d}
    d_pooled = d[:, None] * p["out"]
    d_share = np.einsum("wth,wh->wt", states, d_pooled)
    d_e = share * (d_share - (share * d_share).sum(1, keepdims=True))
    g["attend"] = np.einsum("wt,wth->h", d_e, states)
    d_states = share[:, :, None] * d_pooled[:, None] + d_e[:, :, None] * p["attend"]
    d_x = np.zeros_like(x)
    np.add.at(d_x, at, d_states[:, :, 2 * h_size :])
    for k, side in enumerate("fb"):
        own = d_states[:, :, k * h_size : (k + 1) * h_size]
        d_h, d_u, d_g = np.zeros((len(start), h_size), np.float32), np.zeros_like(p[f"u{side}"]), np.zeros((len(x), 3 * h_size), np.float32)
        for t, h, r, z, n, a_n in reversed(kept[side]):
            d_h = d_h + own[:, t]
            m = inside[:, t, None]
            new = np.where(m, d_h, 0)
            d_n = new * (1 - z) * (1 - n * n)
            d_z = new * (h - n) * z * (1 - z)
            d_r = d_n * a_n * r * (1 - r)
            d_a = np.concatenate([d_r, d_z, d_n * r], 1)
            d_u += h.T @ d_a
            np.add.at(d_g, at[:, t], np.concatenate([d_r, d_z, d_n], 1))
            d_h = np.where(m, new * z + d_a @ p[f"u{side}"].T, d_h)
        g[f"u{side}"], g[f"w{side}"], g[f"b{side}"] = d_u, x.T @ d_g, d_g.sum(0)
        d_x += d_g @ p[f"w{side}"].T
    return g, d_x


def _start(shape: Shape, seed: int) -> dict[str, np.ndarray]:
    r = np.random.RandomState(seed)
    f = lambda *n, k=0.3: (r.randn(*n) * k).astype(np.float32)
    d, h = 2 * shape.wide + 2, shape.hidden
    p = {"word": f(1 << shape.word_bits, shape.wide, k=0.05), "gram": f(1 << shape.gram_bits, shape.wide, k=0.05), "attend": f(2 * h + d, k=0.1), "out": f(2 * h + d, k=0.1), "bias": np.array([-2.0], np.float32)}
    p["attend"][-2:], p["out"][-2:] = 1.5, 1.0  # at first it attends to the log-odds
    for side in "fb":
        p |= {f"w{side}": f(d, 3 * h), f"u{side}": f(h, 3 * h), f"b{side}": np.zeros(3 * h, np.float32)}
    return p


@dataclass
class Corpus:
    """Encoded training texts: words as numbers of distinct words."""

    words: Words
    at: np.ndarray
    first: np.ndarray


def _encode(texts: list[str | None], shape: Shape) -> Corpus:
    hashes, places, firsts, seen, words = [], [], [np.zeros(1, np.int64)], 0, []
    known: dict[int, int] = {}
    grams, counts = [], []
    for _, _, data, offsets in text_blocks(pa.array(texts, pa.string())):
        start, end, first = word_spans(data, offsets, NOT_ALNUM)
        sums = prefix_sums(data, LOWER_VALUES)
        h = span_hash(sums, start, end)
        own, where, back = np.unique(h, return_index=True, return_inverse=True)
        new = np.array([i for i, x in enumerate(own.tolist()) if x not in known], np.int64)
        for x in own[new].tolist():
            known[x] = len(known)
        g, begin = _word_grams(sums, start[where[new]], end[where[new]], shape.grams)
        grams.append(g)
        counts.append(np.diff(begin))
        words.append(own[new])
        number = np.array([known[x] for x in own.tolist()], np.int64)
        places.append(number[back])
        firsts.append(first[1:] + seen)
        seen += len(start)
    flat = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return Corpus(Words(np.concatenate(words or [np.zeros(0, U64)]), np.concatenate(grams or [np.zeros(0, U64)]), np.concatenate([[0], np.cumsum(flat)])), np.concatenate(places or [np.zeros(0, np.int64)]), np.concatenate(firsts))


def _odds(corpus: Corpus, docs: np.ndarray, y: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Shrunken log-odds by document presence of word and gram places, from the given texts."""
    n = [max(int((y[docs] == k).sum()), 1) for k in (0, 1)]
    out = []
    for grams in (False, True):
        seen = np.zeros((2, 1 << shape.odds_bits), np.float32)
        for d in docs.tolist():
            own = np.unique(corpus.at[corpus.first[d] : corpus.first[d + 1]])
            if grams:
                count = np.diff(corpus.words.begin)[own]
                flat = np.repeat(corpus.words.begin[own] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
                hashes = corpus.words.grams[flat]
            else:
                hashes = corpus.words.hashes[own]
            seen[int(y[d]), np.unique(_fold(hashes, shape.odds_bits))] += 1
        odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
        both = seen.sum(0)
        out.append((odds * both / (both + 4) / 2).astype(np.float32))
    return out[0], out[1]


def train(texts: list[str | None], labels: np.ndarray, prior: float, shape: Shape | None = None, training: Training | None = None) -> Network:
    """prior: the share of toxic texts among all labelled ones, for the calibration."""
    shape, training = shape or Shape(), training or Training()
    y = np.asarray(labels, np.int64)
    zero = np.zeros(1 << shape.odds_bits, np.float32)
    if len(set(y.tolist())) < 2:
        return Network(shape, zero, zero, _start(shape, training.seed), constant=float(y.mean()) if len(y) else 0.0)
    corpus = _encode(texts, shape)
    r = np.random.RandomState(training.seed)
    part = np.zeros(len(y), np.int64)  # 0 and 1 train the network, each on the other's log-odds; 2 calibrates; each class is split alike
    for k in (0, 1):
        own = np.flatnonzero(y == k)
        part[r.permutation(own)] = np.minimum(np.arange(len(own)) * 5 // max(len(own), 1) // 2, 2)
    odds = [_odds(corpus, np.flatnonzero(part == 1 - k), y, shape) for k in (0, 1)]
    net = Network(shape, *_odds(corpus, np.flatnonzero(part < 2), y, shape), _start(shape, training.seed))
    text, begin, size = windows(corpus.first, shape)
    inputs = lambda own=None: net.inputs(corpus.words.hashes, corpus.words.grams, corpus.words.begin, own)
    folds = [np.flatnonzero((part == k)[text]) for k in (0, 1)]
    best = []
    for k in (0, 1):
        own = inputs(odds[k])[:, -2:].max(1)
        best.append(np.array([own[corpus.at[b : b + n]].max() for b, n in zip(begin[folds[k]], size[folds[k]], strict=True)], np.float32))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    turn = 0
    for _ in range(training.rounds):
        jobs = []
        for k in (0, 1):
            # the highest window of each text, for clean ones also the next and two at random
            fit = folds[k]
            order = np.lexsort((-best[k], text[fit]))
            ranked = text[fit][order]
            rank = np.arange(len(order)) - np.searchsorted(ranked, ranked)
            random = r.rand(len(order)) < 2 / np.maximum(np.bincount(ranked, minlength=1)[ranked], 1)
            chosen = fit[order[np.where(y[ranked] == 1, rank == 0, (rank < 2) | random)]]
            label = y[text[chosen]]
            weight = np.where(label == 1, len(label) / max(2 * label.sum(), 1), len(label) / max(2 * (1 - label).sum(), 1))
            shuffled = r.permutation(len(chosen))
            jobs += [(k, chosen[w], label[w], weight[w]) for w in np.split(shuffled, range(training.batch, len(shuffled), training.batch))]
        passes = max(1, -(-training.steps // training.rounds // max(len(jobs), 1)))
        for j in np.concatenate([r.permutation(len(jobs)) for _ in range(passes)]).tolist():
            k, w, label, weight = jobs[j]
            at, inside = _places(begin[w], size[w], shape.window)
            used, back = np.unique(corpus.at[at], return_inverse=True)
            count = np.diff(corpus.words.begin)[used]
            flat = np.repeat(corpus.words.begin[used] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            grams = corpus.words.grams[flat]
            x = net.inputs(corpus.words.hashes[used], grams, np.concatenate([[0], np.cumsum(count)]), odds[k])
            g, d = _gradients(net, x[back.reshape(-1)], np.arange(len(w)) * shape.window, size[w], label, weight / len(w))
            d_x = np.zeros_like(x)
            np.add.at(d_x, back.reshape(-1), d)
            turn += 1
            sparse = {"word": (_fold(corpus.words.hashes[used], shape.word_bits), d_x[:, : shape.wide]), "gram": (_fold(grams, shape.gram_bits), np.repeat(d_x[:, shape.wide : 2 * shape.wide] / count[:, None], count, 0))}
            for name, (at_k, d_k) in sparse.items():
                touched, inv = np.unique(at_k, return_inverse=True)
                grad = np.zeros((len(touched), shape.wide), np.float32)
                np.add.at(grad, inv, d_k)
                _adam(net.p[name], moment[name], grad, turn, training.rate, touched)
            for name, grad in g.items():
                _adam(net.p[name], moment[name], grad, turn, training.rate)
        best = [window_logits(net, inputs(odds[k]), corpus.at, begin[folds[k]], size[folds[k]]) if len(folds[k]) else best[k] for k in (0, 1)]
    # calibration of the highest window's logit, with the labels' own mix
    last = np.flatnonzero((part == 2)[text])
    top = np.full(len(y), -np.inf)
    if len(last):
        np.maximum.at(top, text[last], window_logits(net, inputs(), corpus.at, begin[last], size[last]))
    use = np.flatnonzero((part == 2) & np.isfinite(top))
    net.scale, net.shift = _platt(top[use], y[use], prior)
    return net


def _adam(w: np.ndarray, moment: tuple[np.ndarray, np.ndarray], g: np.ndarray, turn: int, rate: float, rows: np.ndarray | None = None) -> None:
    at = slice(None) if rows is None else rows
    m, v = moment
    m[at] = 0.9 * m[at] + 0.1 * g
    v[at] = 0.99 * v[at] + 0.01 * g * g
    if rows is None:
        w *= 1 - DECAY * rate
    w[at] -= rate * (m[at] / (1 - 0.9**turn)) / (np.sqrt(v[at] / (1 - 0.99**turn)) + 1e-6)


def _platt(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift by Newton's steps on smoothed targets, texts weighted to the prior."""
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, prior / n1, (1 - prior) / n0)
    middle, spread = float(x.mean()), float(x.std()) or 1.0
    a = np.stack([(x - middle) / spread, np.ones_like(x)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(60):
        p = _sigmoid(np.clip(a @ w, -30, 30))
        grad = a.T @ (weight * (p - target)) + 1e-4 * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-4 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -1, 1)
    slope = max(float(w[0]), 0.05) / spread
    return slope, float(w[1]) - slope * middle


CACHE_BITS, CACHE_WORDS = 21, 1_200_000


def score_texts(net: Network, column: pa.Array) -> Iterator[np.ndarray]:
    """Scores of whole texts, block by block. Inputs of words seen before come from a bounded table."""
    table, rows, used = SlotTable(CACHE_BITS), np.zeros((1 << 16, 2 * net.shape.wide + 2), np.float32), 0
    for lo, hi, data, offsets in text_blocks(column):
        if used > CACHE_WORDS:
            table, used = SlotTable(CACHE_BITS), 0
        start, end, first = word_spans(data, offsets, NOT_ALNUM)
        if net.constant is not None:
            yield np.where(np.diff(first) > 0, net.constant, 0.0)
            continue
        sums = prefix_sums(data, LOWER_VALUES)
        hashes = span_hash(sums, start, end)
        place, new = table.find(hashes)
        if len(new):
            own, where, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            where = new[where]
            x = net.inputs(own, *_word_grams(sums, start[where], end[where], net.shape.grams))
            if used + len(own) > len(rows):
                rows = np.concatenate([rows, np.zeros((max(len(rows), len(own)), rows.shape[1]), np.float32)])
            rows[used : used + len(own)] = x
            table.store(own, np.arange(used, used + len(own)))
            place[new] = used + back
            used += len(own)
        text, begin, size = windows(first, net.shape)
        top = np.full(hi - lo, -np.inf)
        if len(text):
            np.maximum.at(top, text, window_logits(net, rows, place, begin, size))
        yield np.where(np.isfinite(top), _sigmoid(np.clip(net.scale * top + net.shift, -30, 30)), 0.0)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def fit(docs: DataFrame, labels: DataFrame, training: Training | None = None) -> Network:
    """Labels of held-out rows are never read. The sample is the first rows of each class in hash order."""
    training = training or Training()
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((1, training.toxic), (0, training.clean))]
    sample = F.broadcast(picked[0].union(picked[1]).withColumnRenamed("doc_id", "labelled"))  # toxic + clean rows at most
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), size.alias("size")).where(F.col("size") <= training.longest)
    labelled = texts.join(sample, F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "toxic", "size").dropDuplicates(["doc_id"])
    so_far = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id", F.lit("bound")), "doc_id").rowsBetween(Window.unboundedPreceding, 0))  # of a sample of bounded size
    rows = labelled.withColumn("so_far", so_far).where(F.col("so_far") <= training.chars).select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: r["doc_id"])
    total = sum(counts.values())
    return train([r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.int64), counts.get(1, 0) / total if total else 0.0, None, training)


def score_toxicity(docs: DataFrame, labels: DataFrame, training: Training | None = None) -> DataFrame:
    """One row per input row, in one pass over whole texts without a shuffle."""
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, training))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.concatenate([np.zeros(0), *score_texts(net.value, batch.column(2))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return steady(docs).select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")).mapInArrow(judge, SCHEMA)
