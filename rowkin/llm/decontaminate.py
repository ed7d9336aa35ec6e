"""Operator 2, benchmark decontamination on canonical templates.

Words become template tokens: a run of numbers is one <num>, a run of names
(capitalised inside a sentence) one <name>, a unit after a number <unit>, any
other word itself, lower-cased. Windows of ``Rules.window`` tokens (fewer for
short items, ``Rules.shorter``) of documents and items meet in a hash join.
Chains of windows that follow each other in both texts must cover enough of the
item, and what stands in its slots must map consistently, so that a question
asked again with other names and numbers is caught and unrelated text of the
same shape isn't. A chain may step to another diagonal (document place minus
item place) by up to half the item's tokens, so words put in, left out or
replaced don't break it; two copies of an item are further apart.

An item without such windows (too short, or of slots alone) is matched as a
whole: its words, lower-cased, must stand in the document one after another, and
signs of longer UTF-8 sequences are words of their own in both. Two windows whose
length is a power of two, from its start and to its end, hold all of its words.
An item of fewer than ``Rules.whole`` words must be the whole document.

Consistency holds both ways: few values of the item may stand for several values of
the document, and few of the document for several of the item. Items that agree in
their template and in which of their slots are equal are one group: every document
matches all of them or none, so they are joined once.

Number words and units are English; a noun of a language that writes nouns with a
capital is a name, in the item as in the document.

Documents are filtered against a bit field of fixed size over the windows of
all items before the join, whatever the benchmark's size; a false bit costs a
row, never a result.

Defined results: null and empty texts and items are clean and match nothing. Repeated rows get the same verdict each. Ties: item ids
are listed in ascending order. Extra columns are ignored. Empty tables: all
documents are clean, or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.llm.common import HOT_KEYS, LOWER_VALUES, NOT_ALNUM, U64, broadcast_if_small, give_back, gram_hash, materialise, mix, owners, prefix_sums, span_hash, steady, text_blocks, word_spans


@dataclass(frozen=True)
class Rules:
    window: int = 8
    literals: int = 4  # words other than slots that a window needs
    shorter: tuple[tuple[int, int, int], ...] = ((14, 3, 1), (23, 5, 2))  # items of fewer tokens: window, literals; a word replaced in the middle leaves half of the windows
    coverage: float = 0.5  # share of an item's windows
    conflicts: float = 0.2  # share of slot values that may map to more than one
    whole: int = 3  # words that an item without windows needs to be found inside a document
    bits: int = 24  # 2 MB
    broadcast_rows: int = 1_000_000

    @property
    def sizes(self) -> list[tuple[int, int, int, int]]:
        """(fewest tokens of an item, tokens it has fewer than, window, literals); below ``window`` tokens an item has none."""
        out, low = [], self.window
        for below, k, literals in self.shorter:
            out.append((low, below, k, literals))
            low = below
        return [*out, (low, 1 << 62, self.window, self.literals)]


#: Words that count as numbers, and units.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
UNITS = "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents usd eur mph kmh kph degree degrees watt watts volt volts joule joules newton newtons hz khz mhz ghz kb mb gb tb".split()

DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
BREAKS = np.zeros(256, bool)
BREAKS[np.frombuffer(b".!?:;\n\"()", np.uint8)] = True
WORD, NUM, NAME, UNIT = 0, 1, 2, 3
KIND_HASH = mix(np.arange(101, 105, dtype=np.uint64))


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    start, end, _ = word_spans(data, np.array([0, len(data)]), NOT_ALNUM)
    return np.unique(span_hash(prefix_sums(data, LOWER_VALUES), start, end))


_NUMBERS, _UNITS = _hash_words(NUMBER_WORDS), _hash_words(UNITS)


def template(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: token hashes, token kinds, slot values (hash of what stands there), each text's first token."""
    start, end, first = word_spans(data, offsets, NOT_ALNUM)
    n = len(start)
    if not n:
        none = np.zeros(0, U64)
        return none, np.zeros(0, np.int8), none, first
    hashes = span_hash(prefix_sums(data, LOWER_VALUES), start, end)
    text = owners(first)
    fresh = np.ones(n, bool)
    fresh[1:] = text[1:] != text[:-1]
    breaks = np.zeros(len(data) + 1, np.int32)
    np.cumsum(BREAKS[data], out=breaks[1:])
    opens = fresh.copy()
    opens[1:] |= breaks[start[1:]] > breaks[end[:-1]]
    digits = np.zeros(len(data) + 1, np.int32)
    np.cumsum(DIGIT[data], out=digits[1:])
    capital = UPPER[data[start]]
    wide = (data[start] == 0xC3) & (end - start > 2)
    capital[wide] = (data[start[wide] + 1] >= 0x80) & (data[start[wide] + 1] <= 0x9E)
    kind = np.zeros(n, np.int8)
    kind[capital & ~opens & (end - start > 1)] = NAME
    kind[np.isin(hashes, _NUMBERS)] = NUM
    kind[digits[end] > digits[start]] = NUM
    after_number = np.zeros(n, bool)
    after_number[1:] = (kind[:-1] == NUM) & ~fresh[1:]
    kind[after_number & (kind == WORD) & np.isin(hashes, _UNITS)] = UNIT
    same = np.zeros(n, bool)
    same[1:] = (kind[1:] == kind[:-1]) & ((kind[1:] == NUM) | (kind[1:] == NAME)) & ~fresh[1:]
    keep = np.flatnonzero(~same)
    ordinal = np.arange(n) - np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    values = np.add.reduceat(mix(hashes + ordinal.astype(U64)), keep)
    kind = kind[keep]
    return np.where(kind == WORD, hashes[keep], KIND_HASH[kind]), kind, values, np.searchsorted(keep, first)


def _windows(tokens: np.ndarray, kind: np.ndarray, first: np.ndarray, k: int, literals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in it and hash of each window with enough literal words."""
    n = len(tokens)
    if n < k:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U64)
    hashes = gram_hash(tokens, k)
    text = owners(first)
    literal = np.zeros(n + 1, np.int64)
    np.cumsum(kind == WORD, out=literal[1:])
    good = np.flatnonzero((text[: n - k + 1] == text[k - 1 :]) & (literal[k:] - literal[: n - k + 1] >= literals))
    return text[good], good, hashes[good]


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, each sign beyond ASCII a word of its own, and each text's first word."""
    n = len(data)
    inside = ~NOT_ALNUM[data]
    wide = data >= 0x80
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside & edge[:-1]
    begins[1:] |= inside[1:] & (~inside[:-1] | (wide[1:] != wide[:-1]))
    begins |= data >= 0xC0
    start = np.flatnonzero(begins)
    ends = np.zeros(n + 1, bool)
    ends[start] = True
    ends[:-1] |= ~inside
    ends |= edge
    stops = np.flatnonzero(ends)
    end = stops[np.searchsorted(stops, start, "right")] if len(start) else start
    return span_hash(prefix_sums(data, LOWER_VALUES), start, end), np.searchsorted(start, offsets)


def _power_below(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def _whole_windows(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and hash of every k words of a text, by doubling: k is a power of two."""
    n = len(words)
    if n < k:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U64)
    hashes, size = mix(words ^ U64(0x5851F42D4C957F2D)), 1
    while size < k:
        hashes = mix(hashes[: len(hashes) - size] * U64(0x9E3779B97F4A7C15) + hashes[size:])
        size *= 2
    text = owners(first)
    good = np.flatnonzero(text[: n - k + 1] == text[k - 1 :])
    return text[good], good, hashes[good]


def _groups(tokens: np.ndarray, kind: np.ndarray, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each item's group: hash of its tokens and of which slots are equal, slot values as numbers of their first occurrence)."""
    numbers, groups = np.zeros(len(values), U64), np.zeros(len(first) - 1, np.int64)
    for t in range(len(first) - 1):
        own = slice(int(first[t]), int(first[t + 1]))
        slots = np.flatnonzero(kind[own] != WORD) + own.start
        _, where, back = np.unique(values[slots], return_index=True, return_inverse=True)
        numbers[slots] = where[back].astype(U64)
        parts = mix(np.where(kind[own] == WORD, tokens[own], tokens[own] + numbers[own] * U64(0x9E3779B97F4A7C15)) + np.arange(own.stop - own.start, dtype=np.uint64))
        groups[t] = mix(np.array([parts.sum(dtype=np.uint64) + U64(own.stop - own.start)], U64)).view(np.int64)[0]
    return groups, numbers


def _slots(kind: np.ndarray, values: np.ndarray, at: int, k: int) -> list[int]:
    part = slice(at, at + k)
    return values[part][kind[part] != WORD].view(np.int64).tolist()


ITEMS = "item_id long, grp long, place int, window long, slots array<long>, n_windows int, n_tokens int, size int, whole int"


def _item_windows(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(1)):
            ids = batch.column(0).slice(lo, hi - lo).to_pylist()
            tokens, kind, values, first = template(data, offsets)
            length = np.diff(first)
            groups, numbers = _groups(tokens, kind, values, first)
            rows, windowed = [], np.zeros(hi - lo, bool)
            for low, below, k, literals in rules.sizes:
                text, at, hashes = _windows(tokens, kind, first, k, literals)
                own = (length[text] >= low) & (length[text] < below)
                text, at, hashes = text[own], at[own], hashes[own]
                count = np.bincount(text, minlength=hi - lo)
                windowed |= count > 0
                rows += [(ids[t], int(groups[t]), a - int(first[t]), h, _slots(kind, numbers, a, k), int(count[t]), int(length[t]), k, 0) for t, a, h in zip(text.tolist(), at.tolist(), hashes.view(np.int64).tolist(), strict=True)]
            words, at = plain_words(data, offsets)
            for t in np.flatnonzero(~windowed & (np.diff(at) > 0)).tolist():
                own, n = words[at[t] : at[t + 1]], int(at[t + 1] - at[t])
                k = _power_below(n)
                ends = _whole_windows(own, np.array([0, n]), k)[2].view(np.int64)
                group = int(mix(gram_hash(own, n) + U64(n)).view(np.int64)[0])
                rows += [(ids[t], group, place, int(ends[place]), [], len({0, n - k}), n, k, n) for place in sorted({0, n - k})]
            columns = list(zip(*rows, strict=True)) or [()] * 9
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in ITEMS.split(", ")])


def _place(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes.view(U64) >> U64(64 - bits)).astype(np.int64)


def _bits(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    out = np.zeros(1 << bits, bool)
    for batch in batches:
        out[_place(batch.column(0).to_numpy().copy(), bits)] = True
    import zstandard

    yield pa.RecordBatch.from_arrays([pa.array([zstandard.compress(np.packbits(out).tobytes())], pa.binary())], names=["field"])


def _field(windows: DataFrame, bits: int) -> np.ndarray:
    import zstandard

    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in windows.select("window").coalesce(64).mapInArrow(lambda b: _bits(b, bits), "field binary").toLocalIterator():
        out |= np.frombuffer(zstandard.decompress(row["field"], max_output_size=len(out)), np.uint8)
    return np.unpackbits(out).astype(bool)


def _hits(batches: Iterator[pa.RecordBatch], rules: Rules, field: np.ndarray, sizes: list[int], wholes: list[int]) -> Iterator[pa.RecordBatch]:
    hit = pa.struct([("place", pa.int32()), ("n_words", pa.int32()), ("window", pa.int64()), ("slots", pa.list_(pa.int64()))])
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(2)):
            tokens, kind, values, first = template(data, offsets)
            lists: list[list | None] = [None] * (hi - lo)
            for _, _, k, literals in rules.sizes:
                if k not in sizes:
                    continue
                text, at, hashes = _windows(tokens, kind, first, k, literals)
                found = field[_place(hashes, rules.bits)]
                for t, a, h in zip(text[found].tolist(), at[found].tolist(), hashes[found].view(np.int64).tolist(), strict=True):
                    if lists[t] is None:
                        lists[t] = []
                    lists[t].append({"place": a - int(first[t]), "n_words": 0, "window": h, "slots": _slots(kind, values, a, k)})
            if wholes:
                words, begin = plain_words(data, offsets)
                for k in wholes:
                    text, at, hashes = _whole_windows(words, begin, k)
                    found = field[_place(hashes, rules.bits)]
                    for t, a, h in zip(text[found].tolist(), at[found].tolist(), hashes[found].view(np.int64).tolist(), strict=True):
                        if lists[t] is None:
                            lists[t] = []
                        lists[t].append({"place": a - int(begin[t]), "n_words": int(begin[t + 1] - begin[t]), "window": h, "slots": []})
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).cast(pa.int64()), batch.column(1).slice(lo, hi - lo), pa.array(lists, pa.list_(hit))], names=["doc_id", "key", "hits"])


Hit = tuple[int, int, list]


def chains(hits: list[Hit], drift: int) -> list[list[Hit]]:
    """Hits (place, item place, pairs) that follow each other in both texts: every diagonal's, and the longest from each first hit.

    A step to another diagonal, ``drift`` away at most, costs half a window.
    """
    hits = sorted(hits, key=lambda x: x[:2])
    diagonals: dict[int, list[Hit]] = {}
    last: dict[int, int] = {}
    score, back, root, best = [], [], [], {}
    for x, (place, own, _) in enumerate(hits):
        d = place - own
        diagonals.setdefault(d, []).append(hits[x])
        near = list(last) if len(last) <= 2 * drift else [e for e in range(d - drift, d + drift + 1) if e in last]
        top, before = 0.0, -1
        for e in near:
            y = last[e]
            if abs(e - d) <= drift and hits[y][0] < place and hits[y][1] < own and score[y] - 0.5 * (e != d) > top:
                top, before = score[y] - 0.5 * (e != d), y
        score.append(top + 1)
        back.append(before)
        root.append(root[before] if before >= 0 else x)
        last[d] = x
        if root[x] not in best or score[x] > score[best[root[x]]]:
            best[root[x]] = x
    out = list(diagonals.values())
    for x in best.values():
        chain = []
        while x >= 0:
            chain.append(hits[x])
            x = back[x]
        out.append(chain)
    return out


def _judge(hits: list[Hit], n_windows: int, n_tokens: int, size: int, whole: int, n_words: int, rules: Rules) -> tuple[float, int] | None:
    """(coverage, slots) of a document's copy of an item, if there is one."""
    if whole:
        places: dict[int, set[int]] = {}
        for place, own, _ in hits:
            places.setdefault(place - own, set()).add(own)
        inside = whole >= rules.whole or n_words == whole
        return (1.0, 0) if inside and max(map(len, places.values())) == n_windows else None
    good = []
    for chain in chains(hits, n_tokens // 2):
        pairs = {p for _, _, ps in chain for p in ps}
        n_slots, n_said = len({a for a, _ in pairs}), len({b for _, b in pairs})
        steady_slots = len(pairs) - n_slots <= rules.conflicts * n_slots and len(pairs) - n_said <= rules.conflicts * n_said
        tokens = {i + j for _, i, _ in chain for j in range(size)}
        if len(chain) >= rules.coverage * n_windows and len(tokens) >= rules.window - 1 and steady_slots:
            good.append((len(chain) / n_windows, n_slots))
    return (max(c for c, _ in good), max(n for _, n in good)) if good else None


LEAKS = "key long, grp long, coverage double, n_slots int"


def _leaks(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            hits = [(h["place"], h["item_place"], [(p["a"], p["b"]) for p in h["pairs"]]) for h in row["hits"]]
            found = _judge(hits, row["n_windows"], row["n_tokens"], row["size"], row["whole"], row["n_words"], rules)
            if found:
                out.append((row["key"], row["grp"], *found))
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int32()), strict=True)], names=[x.split()[0] for x in LEAKS.split(", ")])


def _met(hits: DataFrame, windows: DataFrame, rules: Rules) -> DataFrame:
    """Hits and the items' windows of the same hash.

    Windows that are few enough are broadcast, so that a window of many documents burdens
    no task. Otherwise both sides are shuffled, and a window of more than its share of the
    hits is dealt out in parts, its item rows copied to each; such windows are at most HOT_KEYS.
    """
    if windows.count() <= rules.broadcast_rows:
        return hits.join(F.broadcast(windows), "window")
    hits = materialise(hits)
    share = hits.count() // HOT_KEYS + 1
    hot = F.broadcast(hits.groupBy("window").agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("parts")).where("parts > 1"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = hits.join(hot, "window", "left").withColumn("part", F.pmod(F.xxhash64("key", "place"), parts)).drop("parts")
    copied = windows.join(hot, "window", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long")))).drop("parts")
    return dealt.join(copied, ["window", "part"]).drop("part")


def _find(docs: DataFrame, benchmark: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id and key of every row, leaks as key, grp, coverage, n_slots, members as grp, item_id). A key stands for a text."""
    spark = docs.sparkSession
    items = materialise(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda b: _item_windows(b, rules), ITEMS))
    windows = materialise(items.drop("item_id").dropDuplicates(["grp", "place"]))
    members = items.select("grp", "item_id").distinct()
    field = spark.sparkContext.broadcast(_field(windows, rules.bits))
    used = windows.select("size", (F.col("whole") > 0).alias("whole")).distinct().collect()
    sizes, wholes = [x["size"] for x in used if not x["whole"]], sorted(x["size"] for x in used if x["whole"])
    keyed = steady(docs).select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("key"), F.col("text").cast("string"))
    seen = materialise(keyed.mapInArrow(lambda b: give_back(_hits(b, rules, field.value, sizes, wholes)), "doc_id long, key long, hits array<struct<place:int,n_words:int,window:long,slots:array<long>>>"))
    hits = seen.where("hits IS NOT NULL").select("key", F.explode("hits").alias("hit")).select("key", "hit.place", "hit.n_words", "hit.window", F.col("hit.slots").alias("own")).distinct()
    met = _met(hits, windows.withColumnRenamed("place", "item_place"), rules)
    pairs = F.zip_with("slots", "own", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    by = ["key", "grp", "n_windows", "n_tokens", "size", "whole", "n_words"]
    grouped = (
        met.select(*by, F.struct("place", "item_place", pairs.alias("pairs")).alias("hit"))
        .groupBy(*by)
        .agg(F.collect_list("hit").alias("hits"))
        .where(F.size(F.array_distinct(F.col("hits.item_place"))) >= rules.coverage * F.col("n_windows"))
    )
    return seen.select("doc_id", "key"), grouped.mapInArrow(lambda b: give_back(_leaks(b, rules)), LEAKS), members


def find_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id and key of every row, leaks as key, item_id, coverage, n_slots). A key stands for a text."""
    rows, leaks, members = _find(docs, benchmark, rules or Rules())
    return rows, leaks.join(members, "grp").drop("grp")


def decontaminate(docs: DataFrame, benchmark: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One row per input row: doc_id, contaminated, n_items, item_ids, coverage."""
    rows, leaks = find_leaks(docs, benchmark, rules)
    by_text = leaks.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_set("item_id")), lambda x: x.cast("string")), ",").alias("item_ids"), F.count(F.lit(1)).alias("n_items"), F.max("coverage").alias("coverage"))
    out = rows.join(by_text, "key", "left")
    return out.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("item_ids", F.lit("")).alias("item_ids"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules | None = None) -> DataFrame:
    """The input's rows and columns without contaminated texts. Texts move only if the leaks exceed ``broadcast_rows``."""
    rules = rules or Rules()
    _, leaks, _ = _find(docs, benchmark, rules)
    keys = materialise(leaks.select("key").distinct())
    own = docs.select(F.struct("*").alias("row"), F.xxhash64(docs["text"].cast("string")).alias("key"))
    return own.join(broadcast_if_small(keys, rules.broadcast_rows), "key", "left_anti").select("row.*")
