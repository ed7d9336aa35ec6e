"""Operator 8, n-gram Jaccard self-join by T-occurrence search (DivideSkip).

A document's set holds its distinct five-word shingles. Two documents link when
their sets' Jaccard similarity reaches 0.8. Copies of a set are one node.

1. Every shingle's document count is taken over all documents, on packed, sorted
   hashes. Two bit fields, sized by these counts up to a bound, say which hashes lie
   in two documents or more, and which in many. They only order shingles, so a false
   bit costs time, never a link.
2. In that order (in one document, in a few, in many) linked sets share one of
   their first n - ceil(0.8 n) + 1 shingles. Shingles in one document link
   nothing and are dropped; few texts without near copies keep any.
3. A shingle in few documents (64 at most) pairs its nodes. How many such shingles
   two sets share bounds what they can share at all; pairs that may still link are
   ties. A shingle in many ties its nodes to its least node, without pairs.
   Components of ties are blocks. Without that bound a rare shingle here and there
   would chain unlike texts, and the largest block would outgrow the corpus. Blocks
   that are large still are searched by shingles in many documents alone; after that
   the pairs of step 3 that no link has joined are compared one by one.
4. In a block, each set is searched for in an inverted index: the short lists are
   heap-merged with skips, the long ones binary-probed, and sets that reach the
   required overlap are compared by exact count. After a set's first candidates the
   short lists are counted in arrays, and so are the long ones if the candidates
   left are many. A candidate already in the same component is passed over. A large block is searched against few pivots, then
   against all that did not join its largest component, until none is left, so a
   group of near copies of any size takes time in proportion to its size.

Defined results: null, empty and blank texts have an empty set and form a class
of their own (their doc_id). Texts of under five words have one shingle, the whole
sequence. Repeated rows are copies. A null doc_id gets its class's least id.
Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowkin.llm.common import LOWER_VALUES, U64, broadcast_if_small, give_back, gram_hash, keys_in, look_up, materialise, mix, pack, planes, prefix_sums, release, span_hash, steady, text_blocks, unpack, unplanes, word_spans
from rowkin.llm.graph import components


@dataclass(frozen=True)
class Join:
    words: int = 5
    percent: int = 80
    field: int = 16  # bits per counted hash in the fields of shared and of common shingles
    least_bits: int = 20
    most_bits: int = 30  # 128 MB: what is broadcast has this bound, however many shingles there are
    many: int = 64
    block: int = 256  # nodes of a block that is searched at once
    chunk: int = 512  # nodes of a larger block that are dealt together, or twice the pivots if more
    pivots: tuple[int, ...] = (64, 1024, 4096)
    rows_per_task: int = 256  # a row of a search costs milliseconds, whatever its bytes


COUNTED = 48  # bits of a shingle's hash that are counted
KEY_SHIFT = U64(64 - COUNTED)
FLUSH = 1_500_000
#: The most slices (as a power of two) of the hash range: one task holds a slice.
SLICES = 18
#: Rows of shingles and nodes that are paired at once.
POSTINGS = 50_000
#: Nodes that a task remembers having sent; forgetting some only sends a copy again.
SEEN = 1_000_000


def _grams(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows of (doc_id, key, text) and each text's shingle hashes, repeated ones included."""
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(2)):
            start, end, first = word_spans(data, offsets)
            hashes = span_hash(prefix_sums(data, LOWER_VALUES), start, end)
            grams = gram_hash(hashes, words)
            out = []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                k = b - a
                out.append(grams[a : b - words + 1] if k >= words else gram_hash(hashes[a:b], k) + U64(k) if k else grams[:0])
            yield batch.slice(lo, hi - lo), out


def _count(batches: Iterator[pa.RecordBatch], words: int, slice_bits: int) -> Iterator[pa.RecordBatch]:
    """Sorted hashes with their counts, packed by slices of the hash range."""
    packer = zstandard.ZstdCompressor(level=1)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.searchsorted(keys, np.arange((1 << slice_bits) + 1, dtype=np.uint64) << U64(COUNTED - slice_bits))
        rows = []
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if b > a:
                part = keys[a:b] - (U64(i) << U64(COUNTED - slice_bits))
                rows.append((i, packer.compress(planes(np.diff(part, prepend=U64(0)))), packer.compress(np.minimum(counts[a:b], 255).astype(np.uint8).tobytes()), b - a))
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.int64()), strict=True)], names=["slice", "keys", "counts", "n"])

    held, size = [], 0
    for _, texts in _grams(batches, words):
        for grams in texts:
            if len(grams):
                one = np.unique(grams >> KEY_SHIFT)
                held.append(one)
                size += len(one)
        if size >= FLUSH:
            yield flush(held)
            held, size = [], 0
    if held:
        yield flush(held)


def _merge(batches: Iterator[pa.RecordBatch], many: int) -> Iterator[pa.RecordBatch]:
    """Per slice, the hashes of two documents or more, those of many first. Rows come sorted by slice."""
    opener, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)

    def finish(at: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys = np.concatenate([x[0] for x in held])
        order = np.argsort(keys)
        keys, counts = keys[order], np.concatenate([x[1] for x in held])[order].astype(np.int64)
        begin = np.flatnonzero(np.diff(keys, prepend=keys[:1] + U64(1)) != 0)
        total = np.add.reduceat(counts, begin)
        keys = keys[begin]
        often, some = keys[total > many], keys[(total > 1) & (total <= many)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((at, pa.int64()), (len(often), pa.int64()), (len(some), pa.int64()), *((pack(k, packer) if len(k) else b"", pa.binary()) for k in (often, some)))], names=[x.split()[0] for x in MERGED.split(", ")])

    at, held = -1, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["slice"] != at and held:
                yield finish(at, held)
                held = []
            at = row["slice"]
            keys = np.cumsum(unplanes(opener.decompress(row["keys"], max_output_size=row["n"] * 8), "<u8"))
            held.append((keys, np.frombuffer(opener.decompress(row["counts"], max_output_size=row["n"]), np.uint8)))
    if held:
        yield finish(at, held)


MERGED = "slice long, n_often long, n_some long, often binary, some binary"


def _paint(batches: Iterator[pa.RecordBatch], slice_bits: int, bits: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Per slice, its part of the field of shared hashes and of the field of common ones."""
    opener, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)

    def field(keys: np.ndarray, width: int) -> bytes:
        out = np.zeros(1 << (width - slice_bits), bool)
        out[(keys >> U64(COUNTED - width)).astype(np.int64)] = True
        return packer.compress(np.packbits(out).tobytes())

    for batch in batches:
        for row in batch.to_pylist():
            often, some = (unpack(row[k], opener) if row[f"n_{k}"] else np.zeros(0, U64) for k in ("often", "some"))
            yield pa.RecordBatch.from_arrays([pa.array([row["slice"]], pa.int64()), pa.array([field(np.concatenate([often, some]), bits[0])], pa.binary()), pa.array([field(often, bits[1])], pa.binary())], names=["slice", "shared", "many"])


def _bits(n: int, join: Join, slice_bits: int) -> int:
    """The width of a field for n hashes, so that few others hit it; a slice of it is a byte at least."""
    return min(max((n * join.field).bit_length(), join.least_bits, slice_bits + 3), join.most_bits)


def _bit_fields(texts: DataFrame, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """The fields of shingles in two documents or more and in many. Their widths follow the counts up to a bound; they are all that reaches the driver."""
    slices = min(max(8, texts.rdd.getNumPartitions().bit_length()), SLICES)
    words, many = join.words, join.many
    counted = texts.mapInArrow(lambda b: give_back(_count(b, words, slices)), "slice long, keys binary, counts binary, n long")
    merged = materialise(counted.repartition("slice").sortWithinPartitions("slice").mapInArrow(lambda b: give_back(_merge(b, many)), MERGED))
    sums = merged.agg(F.sum("n_often").alias("often"), F.sum(F.col("n_often") + F.col("n_some")).alias("shared")).first()
    bits = (_bits(sums["shared"] or 0, join, slices), _bits(sums["often"] or 0, join, slices))
    opener = zstandard.ZstdDecompressor()
    fields = [np.zeros(1 << (x - 3), np.uint8) for x in bits]
    for row in merged.mapInArrow(lambda b: give_back(_paint(b, slices, bits)), "slice long, shared binary, many binary").toLocalIterator():
        for field, packed in zip(fields, (row["shared"], row["many"]), strict=True):
            size = len(field) >> slices
            field[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(opener.decompress(packed, max_output_size=size), np.uint8)
    release(merged)
    return fields[0], fields[1]


def _bit(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> U64(64 - (len(field).bit_length() + 2))
    return (field[(at >> U64(3)).astype(np.int64)] >> (U64(7) - (at & U64(7))).astype(np.uint8)) & 1


def _sets(batches: Iterator[pa.RecordBatch], join: Join, shared: np.ndarray, many: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per text: set size, node (null without a shingle), and if it may link at all its tokens (signature) and ordered set.

    Keys hold the class of a shingle in the two highest bits, so they sort by class. Tokens
    keep 62 bits of the hash, sets 46. A node's later copies within the task carry nothing.
    """
    seen: set[int] = set()
    packer = zstandard.ZstdCompressor(level=1)
    for rows, texts in _grams(batches, join.words):
        ids = rows.column(0)
        sizes, nodes, tokens, keys = [], [], [], []
        whole = np.concatenate(texts) if texts else np.zeros(0, U64)
        kind = _bit(shared, whole).astype(U64) + (_bit(shared, whole) & _bit(many, whole)).astype(U64)
        whole = (kind << U64(62)) | (whole >> U64(2))
        at = 0
        for grams in texts:
            own = np.unique(whole[at : at + len(grams)])
            at += len(grams)
            n = len(own)
            node = int(mix(own ^ U64(0x5851F42D4C957F2D)).sum().astype(np.int64)) if n else None
            head = own[: n - -(-join.percent * n // 100) + 1]
            head = head[head >= U64(1 << 62)]
            if not n or node in seen:
                head = head[:0]
            if len(head):
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(node)
            sizes.append(n)
            nodes.append(node)
            tokens.append(head.view(np.int64) if len(head) else None)
            keys.append(pack(np.unique(own >> U64(16)), packer) if len(head) else None)
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), rows.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(tokens, pa.list_(pa.int64())), pa.array(keys, pa.binary())],
            names=["doc_id", "key", "n_shingles", "node", "tokens", "keys"],
        )


def _pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, need) for each few-document shingle that two nodes' prefixes share; fewer than ``need`` of them in all can't make a link.

    Rows (token, node, n, own, last) come sorted by token and node: a set's size, how many of its first shingles lie in few
    documents or in one (``own``), and the last of these. Of two sets, all that the one with the lower last holds up to there and
    shares lies among the other's first ones too; so both share no more than these and what follows in that set.
    """
    held: list[list[np.ndarray]] = []
    size = 0

    def emit(token: np.ndarray, node: np.ndarray, n: np.ndarray, own: np.ndarray, last: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(token):
            return
        fresh = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))  # not a copy from another task
        token, node, n, own, last = (x[fresh] for x in (token, node, n, own, last))
        at = np.arange(len(token))
        for step in range(1, len(token)):
            at = at[at + step < len(token)]
            at = at[token[at] == token[at + step]]
            if not len(at):
                return
            to = at + step
            fit = 100 * np.minimum(n[at], n[to]) >= percent * np.maximum(n[at], n[to])
            x, y = at[fit], to[fit]
            least = -(-percent * (n[x] + n[y]) // (100 + percent))
            rest = np.where(last[x] <= last[y], n[x] - own[x], n[y] - own[y])
            yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y]), pa.array(least - rest)], names=["a", "b", "need"])

    def taken() -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*held, strict=True)]

    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        size += batch.num_rows
        if size >= POSTINGS:
            rows = taken()
            cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last token may go on
            held, size = [[x[cut:] for x in rows]], len(rows[0]) - cut
            yield from emit(*(x[:cut] for x in rows))
    if size:
        yield from emit(*taken())


def _close(able: DataFrame, join: Join) -> DataFrame:
    """(node, other): pairs that share as many shingles of few documents as two linked sets must, if they share any."""
    percent = join.percent
    n, rare = F.col("n_shingles"), F.filter("tokens", lambda t: t >= 0)  # tokens of many documents are negative as signed numbers
    head = n - F.expr(f"({percent} * n_shingles + 99) div 100") + 1
    facts = able.select("node", n.alias("n"), (head - F.size("tokens") + F.size(rare)).alias("own"), F.array_max(rare).alias("last"), F.explode(rare).alias("token"))
    dealt = facts.select("token", "node", "n", "own", "last").repartition("token").sortWithinPartitions("token", "node")
    met = dealt.mapInArrow(lambda b: give_back(_pairs(b, percent)), "a long, b long, need long")
    return met.groupBy("a", "b", "need").agg(F.count(F.lit(1)).alias("shared")).where("shared >= need").select(F.col("b").alias("node"), F.col("a").alias("other"))


def _common(able: DataFrame) -> DataFrame:
    """(node, other): ties of nodes that share a shingle of many documents, by way of its least node."""
    lists = able.select("node", F.explode(F.filter("tokens", lambda t: t < 0)).alias("token"))
    heads = lists.groupBy("token").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head != last").select("token", "head")
    return lists.join(heads, "token").where("node != head").select("node", F.col("head").alias("other")).distinct()


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The links among rows of (a, b, keys of a, keys of b)."""
    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            n, m = keys_in(x), keys_in(y)
            shared = len(np.intersect1d(unpack(x, opener), unpack(y, opener), assume_unique=True)) if 100 * min(n, m) >= percent * max(n, m) else 0
            keep.append(shared > 0 and 100 * shared >= percent * (n + m - shared))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


OWNER = U64(16)  # bits below a key of 48 that say which set of an index holds it


class Index:
    """Inverted lists of up to 65,536 sets, in one array of (key, set) that is sorted in place.

    Sets are read once, one after the other, so they may be unpacked on the way if their sizes are given.
    """

    def __init__(self, sets: Iterable[np.ndarray], sizes: list[int] | None = None):
        if sizes is None:
            sets = list(sets)
        self.sizes = [len(x) for x in sets] if sizes is None else sizes
        if len(self.sizes) > 1 << int(OWNER):
            raise ValueError("too many sets in one index")
        self.places = np.empty(sum(self.sizes), U64)
        at = 0
        for i, keys in enumerate(sets):
            self.places[at : at + len(keys)] = (keys << OWNER) | U64(i)
            at += len(keys)
        self.places.sort()
        self.owners = (self.places & U64((1 << int(OWNER)) - 1)).astype(np.int32)
        self.view = memoryview(self.owners)  # lists are read in place
        keys = self.places >> OWNER
        self.begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if at else np.zeros(0, np.int64)
        self.keys = keys[self.begin]
        self.length = np.diff(np.append(self.begin, at))

    def lists(self, query: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, query)
        at[at == len(self.keys)] = 0
        return at[self.keys[at] == query] if len(self.keys) else at[:0]

    def probe(self, lists: np.ndarray, candidate: int) -> int:
        """How many of the lists hold the candidate, by binary search."""
        want = (self.keys[lists] << OWNER) | U64(candidate)
        at = np.searchsorted(self.places, want)
        at[at == len(self.places)] = 0
        return int((self.places[at] == want).sum())

    def count(self, lists: np.ndarray) -> np.ndarray:
        """How many of the lists hold each set, by reading them whole, some at a time."""
        begin, length = self.begin[lists], self.length[lists]
        total, end = np.zeros(len(self.sizes), np.int64), np.cumsum(length)
        cuts = np.searchsorted(end, np.arange(READ, int(length.sum()), READ)) + 1 if len(lists) else []
        for a, b in zip([0, *cuts], [*cuts, len(lists)], strict=True):
            if b > a:
                parts = [self.owners[x:y] for x, y in zip(begin[a:b].tolist(), (begin + length)[a:b].tolist(), strict=True)]
                total += np.bincount(np.concatenate(parts), minlength=len(total))
        return total


def merge_skip(lists: Sequence[Sequence[int]], need: int) -> Iterator[tuple[int, int]]:
    """(id, lists that hold it) of ids in at least ``need`` sorted lists, lowest id first: a heap of fronts; fronts that cannot reach ``need`` skip ahead."""
    heap = [(x[0], i, 0) for i, x in enumerate(lists) if len(x)]
    heapq.heapify(heap)
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= need:
            yield top, len(popped)
            for _, i, at in popped:
                if at + 1 < len(lists[i]):
                    heapq.heappush(heap, (lists[i][at + 1], i, at + 1))
            continue
        while heap and len(popped) < need - 1:
            popped.append(heapq.heappop(heap))
        if not heap:
            return
        target = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(lists[i], target, at)
            if at < len(lists[i]):
                heapq.heappush(heap, (lists[i][at], i, at))


MU = 0.0085  # the usual constant of DivideSkip
#: Candidates of a set that the heap finds one by one; what a probe costs, in entries of a list; entries that are counted at once.
FIRST, PROBE, READ = 4, 16, 1_000_000


def search(index: Index, query: np.ndarray, percent: int, skip, below: int | None = None) -> Iterator[int]:
    """Sets of the index similar to the query, lowest first. ``skip(i)``: whether set i need not be looked at; ``below``: where the sets to be looked at end."""
    n = len(query)
    need = -(-percent * n // 100)
    lists = index.lists(query)
    if len(lists) < need:
        return
    length = index.length[lists]
    lists = lists[np.argsort(length, kind="stable")]
    longest = int(length.max())
    n_long = min(int(need / (MU * np.log2(max(longest, 2)) + 1)), need - 1)
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    begin = index.begin[short]
    fronts = [index.view[a:b] for a, b in zip(begin.tolist(), (begin + index.length[short]).tolist(), strict=True)]
    for looked, (i, count) in enumerate(merge_skip(fronts, need - n_long)):
        if below is not None and i >= below:
            return
        if looked == FIRST:  # a heap's steps cost more than lists read in arrays
            yield from (j for j in _counted(index, short, long, n, percent, need - n_long, i, below) if not skip(j))
            return
        m = index.sizes[i]
        if skip(i) or 100 * min(m, n) < percent * max(m, n):
            continue
        shared = count + index.probe(long, i)
        if 100 * shared >= percent * (n + m - shared):
            yield i


def _counted(index: Index, short: np.ndarray, long: np.ndarray, n: int, percent: int, need: int, first: int, below: int | None) -> list[int]:
    """What ``search`` finds from set ``first`` on, for a set of n shingles: the short lists are counted, the long ones probed or counted, whichever reads less."""
    count = index.count(short)
    left = np.flatnonzero(count[first:below] >= need) + first
    m = np.asarray(index.sizes, np.int64)[left]
    fit = 100 * np.minimum(m, n) >= percent * np.maximum(m, n)
    left, m = left[fit], m[fit]
    if PROBE * len(left) * len(long) < int(index.length[long].sum()):
        more = np.asarray([index.probe(long, i) for i in left.tolist()], np.int64)
    else:
        more = index.count(long)[left]
    shared = count[left] + more
    return left[100 * shared >= percent * (n + m - shared)].tolist()


class Classes:
    def __init__(self, n: int):
        self.up = list(range(n))
        self.count = n

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
            self.count -= 1


def _search(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of each (block, chunk): among its pivots, and from its other nodes to the pivots' components.

    Rows come sorted by block, chunk, pivots first. Enough links to join whatever belongs together.
    """
    state: dict = {"at": None}
    opener = zstandard.ZstdDecompressor()
    last: tuple | None = None
    out: list[tuple[int, int]] = []

    def build() -> None:
        index, nodes = Index((unpack(x, opener) for x in state["sets"]), [keys_in(x) for x in state["sets"]]), state["nodes"]
        classes = Classes(len(nodes))
        for q, packed in enumerate(state["sets"]):
            for i in search(index, unpack(packed, opener), percent, lambda i, q=q: classes.find(i) == classes.find(q), q):
                classes.join(i, q)
                out.append((nodes[i], nodes[q]))
                if classes.count == len(nodes) - q:  # sets 0 to q are one class, those after q are alone so far
                    break
        state.update(index=index, classes=classes, sets=[])

    def look(node: int, keys: np.ndarray) -> None:
        if state["index"] is None:
            build()
        classes, met = state["classes"], set()
        for i in search(state["index"], keys, percent, lambda i: classes.find(i) in met):
            met.add(classes.find(i))
            out.append((state["nodes"][i], node))
            if len(met) == classes.count:
                break

    def close() -> None:
        if state["at"] is not None and state["index"] is None and len(state["nodes"]) > 1:
            build()

    for batch in batches:
        for block, chunk, rest, node, keys in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if (block, chunk) != state["at"]:
                close()
                state = {"at": (block, chunk), "nodes": [], "sets": [], "index": None}
                last = None
            if (rest, node) == last:  # a copy from another task
                continue
            last = (rest, node)
            if rest:
                look(node, unpack(keys, opener))
            else:
                state["nodes"].append(node)
                state["sets"].append(keys)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])


def _searched(rows: DataFrame, join: Join, n: int) -> DataFrame:
    """rows: block, chunk, rest (false for pivots), node, keys; about n of them, dealt to as many tasks as their search needs."""
    percent = join.percent
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // join.rows_per_task))
    dealt = rows.select("block", "chunk", "rest", "node", "keys").repartition(tasks, "block", "chunk").sortWithinPartitions("block", "chunk", "rest", "node")
    return dealt.mapInArrow(lambda b: give_back(_search(b, percent)), "a long, b long")


def _large(members: DataFrame, join: Join) -> list[DataFrame]:
    """Tables of links of blocks with more nodes than are searched at once. Each turn's tables go when the next turn's are written."""
    spare = members.select("block", "node", F.xxhash64("node").alias("hash"))
    found: list[DataFrame] = []
    used, todo, turn, n = None, materialise(spare), 0, members.count()
    while todo.count():
        take = join.pivots[min(turn, len(join.pivots) - 1)]
        turn += 1
        order = Window.partitionBy("block").orderBy("hash", "node")
        pivots = materialise(todo.withColumn("at", F.row_number().over(order)).where(F.col("at") <= take).select("block", "node"))
        chunks = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / max(join.chunk, 2 * take))).cast("int").alias("chunks")
        sizes = materialise(members.groupBy("block").agg(chunks).join(pivots.select("block").distinct(), "block"))
        turned = members.join(broadcast_if_small(sizes), "block").join(broadcast_if_small(pivots.withColumn("pivot", F.lit(True))), ["block", "node"], "left")
        chunk = F.explode(F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), "chunks").cast("int"))))
        rows = turned.select("block", chunk.alias("chunk"), F.col("pivot").isNull().alias("rest"), "node", "keys")
        found.append(materialise(_searched(rows, join, n)))
        reached = components(reduce(DataFrame.union, found))
        # what lies outside its block's largest component, and was no pivot yet, may still link
        roots = materialise(spare.join(reached, "node", "left").withColumn("root", F.coalesce("root", "node")))
        counts = roots.groupBy("block", "root").agg(F.count(F.lit(1)).alias("n"))
        largest = counts.groupBy("block").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
        before, earlier = todo, used
        used = pivots if used is None else materialise(used.union(pivots))
        todo = materialise(roots.join(largest, "block").where("root != largest").join(used, ["block", "node"], "left_anti").select("block", "node", "hash"))
        release(before, sizes, roots, reached, *([] if earlier is None else [earlier, pivots]))
    release(todo, used)
    return found


def _small(able: DataFrame, ties: DataFrame, join: Join) -> tuple[list[DataFrame], DataFrame]:
    """A table of links of the ties' blocks that are searched at once, and the members of larger ones."""
    tied = components(ties, "node", "other")
    blocks = materialise(tied.withColumnRenamed("root", "block"))
    sized = materialise(look_up(blocks, blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "block", "n", blocks.count()))
    members = able.select("node", "keys").join(broadcast_if_small(sized), "node")
    small = members.where(F.col("n") <= join.block).withColumn("chunk", F.lit(0)).withColumn("rest", F.lit(False))
    links = materialise(_searched(small, join, sized.where(F.col("n") <= join.block).count()))
    large = materialise(members.where(F.col("n") > join.block).dropDuplicates(["node"]).select("block", "node", "keys"))
    release(sized, blocks, tied)
    return [links], large


def _loose(able: DataFrame, large: DataFrame, close: DataFrame, join: Join) -> list[DataFrame]:
    """Tables of links of large blocks: searches among what shares a shingle of many documents, then the close pairs not yet joined, one by one."""
    if large.isEmpty():
        return []
    percent, inside = join.percent, broadcast_if_small(large.select("node"))
    found, larger = _small(able.join(inside, "node", "left_semi"), _common(able.join(inside, "node", "left_semi")), join)
    found += _large(larger, join)
    reached = components(reduce(DataFrame.union, found))
    roots = materialise(large.select("node").join(reached, "node", "left").select("node", F.coalesce("root", "node").alias("root")))
    side = lambda x: broadcast_if_small(roots.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")))
    pairs = close.join(side("node"), "node").join(side("other"), "other").where("node_root != other_root").select("node", "other")
    keys = lambda x: large.select(F.col("node").alias(x), F.col("keys").alias(f"{x}_keys"))
    both = pairs.join(keys("node"), "node").join(keys("other"), "other").select(F.col("node").alias("a"), F.col("other").alias("b"), "node_keys", "other_keys")
    found.append(materialise(both.mapInArrow(lambda b: give_back(_verify(b, percent)), "a long, b long")))
    release(larger, reached, roots)
    return found


def classes(docs: DataFrame, join: Join | None = None) -> DataFrame:
    """One row per input row: doc_id, key (of its text), n_shingles, component_id, stays.

    ``stays`` marks the rows of a class that equal its first one, by doc_id (nulls last) and text.
    """
    join = join or Join()
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    texts = steady(docs).select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("key"), text.alias("text"))
    shared, many = _bit_fields(texts, join)
    fields = spark.sparkContext.broadcast((shared, many))
    sets = materialise(texts.mapInArrow(lambda b: give_back(_sets(b, join, *fields.value)), "doc_id long, key long, n_shingles long, node long, tokens array<long>, keys binary"))

    able = sets.where("tokens IS NOT NULL")
    close = materialise(_close(able, join))
    links, large = _small(able, close.union(_common(able)), join)
    links += _loose(able, large, close, join)
    release(large, close)

    # a row per node: its least row and how many it has; then a row per linked class
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("least")
    least = materialise(sets.where("node IS NOT NULL").groupBy("node").agg(first, F.count(F.lit(1)).alias("rows")))
    joined = components(reduce(DataFrame.union, links))
    linked = materialise(joined.join(least.select("node", "least"), "node"))
    release(joined, *links)
    tops = materialise(linked.groupBy("root").agg(F.min("least").alias("top"), F.count(F.lit(1)).alias("nodes")))
    top_of = look_up(linked.select("node", "root"), tops, "root", "nodes", linked.count()).select("node", "top")
    lookup = materialise(least.join(top_of, "node", "left").select("node", "rows", F.coalesce("top", "least").alias("top")))
    release(least, linked, tops)
    thin = sets.select("doc_id", "key", "n_shingles", "node")
    out = look_up(thin.where("node IS NOT NULL"), lookup, "node", "rows", sets.count())
    same = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("key") == F.col("top.key"))
    alone = thin.where("node IS NULL").select("doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"))
    named = out.select("doc_id", "key", "n_shingles", F.col("top.doc_id").alias("component_id"), same.alias("stays")).unionByName(alone)
    named.rowkin_reads = (sets, lookup)
    return named


def near_duplicates(docs: DataFrame, join: Join | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the least doc_id that links reach)."""
    return classes(docs, join).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, join: Join | None = None) -> DataFrame:
    """One row of each class with the input's columns: the one with the least doc_id.

    Rows that equal each other by doc_id and text are told apart by nothing else that
    is known to be whole, so only these few are shuffled with their texts; all others are
    kept or dropped by a join with thin rows. Texts without a shingle are linked with
    nothing: all of them stay, but for repeated rows.
    """
    found = classes(docs, join)
    thin = materialise(found.groupBy("doc_id", "key").agg(F.first("stays").alias("stays"), F.count(F.lit(1)).alias("n")))
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("key"))
    release(found)
    both = lambda table: [own["doc_id"].eqNullSafe(table["doc_id"]), own["key"] == table["key"]]
    out = materialise(thin.where("NOT stays OR n > 1").select("doc_id", "key"))
    again = materialise(thin.where("stays AND n > 1").select("doc_id", "key"))
    release(thin)
    single = own.join(broadcast_if_small(out), both(out), "left_anti")
    repeated = own.join(broadcast_if_small(again), both(again), "left_semi").dropDuplicates(["doc_id", "key"])
    return single.select("row").union(repeated.select("row")).select("row.*")
