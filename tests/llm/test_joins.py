import random
import re

import pytest

from rowkin.llm import graph, ngram_join
from rowkin.llm.decontaminate import decontaminate, drop_leaks
from rowkin.llm.ngram_join import Join, Index, keep_one, merge_skip, near_duplicates, search


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain(rows):
    sets, up = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            a, b = sets[x], sets[y]
            if x < y and a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = top(x), top(y)
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.fixture(scope="module")
def near_rows():
    r = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    bases = [[r.choice(words) for _ in range(r.randint(6, 60))] for _ in range(12)]
    rows = []
    for i in range(220):
        b = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            k = r.randrange(len(b))
            b[k] = r.choice(words) if r.random() < 0.6 else b[k].upper()
        if r.random() < 0.3:
            b += [r.choice(words) for _ in range(r.randint(1, 4))]
        rows.append((i, "  ".join(b)))
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "a b"), (1004, "A  b"), (1005, "a b c"), (1006, "É b c d e f"), (1007, "é b c d e f")]


@pytest.mark.parametrize(("join", "one_task"), [(Join(), 10**6), (Join(block=4, chunk=16, pivots=(2, 3, 8)), 10), (Join(block=8, chunk=1000, pivots=(1,), many=2, rows_per_task=3), 10)])
def test_classes_equal_the_plain_version(spark, near_rows, join, one_task, monkeypatch):
    monkeypatch.setattr(ngram_join, "components", lambda e, a="a", b="b": graph.components(e, a, b, one_task))
    docs = spark.createDataFrame(near_rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_duplicates(docs, join).collect()}
    assert got == plain(near_rows)


@pytest.mark.parametrize("postings", [7, 50_000])
def test_chains_of_unlike_texts_are_no_block(spark, postings, monkeypatch):
    """Texts that share a few shingles with the next are not searched together: FINDINGS_r02 F1, F2."""
    r = random.Random(5)
    words = [f"w{r.randrange(10**9)}" for _ in range(9200)]
    rows = [(i, " ".join(words[i * 30 : i * 30 + 60])) for i in range(300)]  # half of each text is the next one's
    for i in range(0, 300, 9):
        near = rows[i][1].split(" ")
        near[r.randrange(60)] = "x"
        rows.append((1000 + i, " ".join(near)))
    monkeypatch.setattr(ngram_join, "POSTINGS", postings)
    real = ngram_join._large
    monkeypatch.setattr(ngram_join, "_large", lambda members, join: real(members, join) if not members.count() else pytest.fail("a large block"))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), Join(block=16)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == plain(rows)
    assert sum(x.component_id != x.doc_id for x in got) > 30


def test_one_row_of_a_class_stays(spark, near_rows, odd_docs):
    docs = spark.createDataFrame(near_rows, "doc_id long, text string")
    kept = keep_one(docs.union(docs).withColumn("node", docs["doc_id"]))
    assert kept.columns == ["doc_id", "text", "node"]
    assert sorted(x.doc_id for x in kept.collect()) == sorted({v[1] for v in plain(near_rows).values()})
    assert keep_one(docs.limit(0)).count() == 0 and near_duplicates(docs.limit(0)).count() == 0
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {x.component_id for x in rows if x.doc_id == 1} == {1}
    assert keep_one(odd_docs).count() == odd_docs.count() - 1


def test_unlike_sets_of_many_common_shingles_are_counted(monkeypatch):
    """A block of sets just below the threshold takes few steps of the heap a set, and loses no link: FINDINGS_r02 F1."""
    import numpy as np

    draw, steps, real = np.random.default_rng(5), [], ngram_join.merge_skip
    base = draw.integers(0, 1 << 46, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[draw.random(300) < draw.choice([0.8, 0.85, 0.97])], draw.integers(0, 1 << 46, 5, dtype=np.uint64)])) for _ in range(150)]

    def counted(*a):
        for x in real(*a):
            steps.append(1)
            yield x

    monkeypatch.setattr(ngram_join, "merge_skip", counted)
    monkeypatch.setattr(ngram_join, "READ", 5000)
    index, found = Index(sets), 0
    for q, own in enumerate(sets):
        both = [len(np.intersect1d(own, x)) for x in sets]
        want = [i for i, x in enumerate(sets) if 100 * both[i] >= 80 * (len(x) + len(own) - both[i])]
        assert list(search(index, own, 80, lambda i: False)) == want
        assert list(search(index, own, 80, lambda i: i % 2 == 0, q)) == [i for i in want if i < q and i % 2]
        found += len(want)
    assert 150 < found < 150 * 150 and len(steps) < 150 * 2 * 10


def test_merge_skip_counts_lists():
    r = random.Random(5)
    for _ in range(300):
        lists = [sorted(r.sample(range(30), r.randint(0, 15))) for _ in range(r.randint(1, 9))]
        need = r.randint(1, 5)
        want = {i: sum(i in x for x in lists) for i in range(30)}
        assert list(merge_skip(lists, need)) == sorted((i, n) for i, n in want.items() if n >= need)


def test_search_finds_every_similar_set():
    import numpy as np

    r = random.Random(6)
    for _ in range(60):
        base = r.sample(range(1, 400), 60)
        sets = [np.array(sorted(set(base[: r.randint(40, 60)] + r.sample(range(1, 400), r.randint(0, 15)))), np.uint64) for _ in range(20)]
        index = Index(sets)
        for q in sets:
            want = {i for i, s in enumerate(sets) if 100 * len(set(q) & set(s)) >= 80 * len(set(q) | set(s))}
            assert set(search(index, q, 80, lambda i: False)) == want
            for below in (0, 7, 20):
                assert list(search(index, q, 80, lambda i: False, below)) == sorted(i for i in want if i < below)


def test_index_takes_packed_sets_and_searches_of_a_block_join_what_brute_force_joins():
    import numpy as np
    import pyarrow as pa
    import zstandard

    from rowkin.llm.common import keys_in, pack, unpack
    from rowkin.llm.ngram_join import Classes, _search

    r, packer, opener = random.Random(7), zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    for groups, rest in ((1, 0), (3, 0), (1, 9), (4, 9)):
        bases = [[r.randrange(1 << 48) for _ in range(80)] for _ in range(groups)]
        sets = [np.unique(np.array(r.sample(r.choice(bases), r.randint(68, 80)) + [r.randrange(1 << 48) for _ in range(r.randint(0, 6))], np.uint64)) for _ in range(30)]
        packed = [pack(x, packer) for x in sets]
        assert [keys_in(x) for x in packed] == [len(x) for x in sets]
        given = Index((unpack(x, opener) for x in packed), [keys_in(x) for x in packed])
        assert (given.places == Index(sets).places).all()

        batch = pa.RecordBatch.from_arrays([pa.array([5] * 30), pa.array([0] * 30), pa.array([i >= 30 - rest for i in range(30)]), pa.array(range(30)), pa.array(packed)], names=["block", "chunk", "rest", "node", "keys"])
        got, want = Classes(30), Classes(30)
        for out in _search(iter([batch]), 80):
            for a, b in zip(*(x.to_pylist() for x in out.columns), strict=True):
                got.join(a, b)
        linked = lambda x, y: 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))
        for a in range(30 - rest):
            for b in range(a + 1, 30):
                if linked(sets[a], sets[b]):
                    want.join(a, b)
        assert [got.find(i) for i in range(30)] == [want.find(i) for i in range(30)]


ITEM = "Alice buys 3 apples for 12 dollars at the corner market and later sells 2 apples to Bob for 9 dollars. How many apples does Alice have?"


def test_reparameterised_questions_are_caught(spark, odd_docs):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "short one"), (4, ""), (5, "the quick brown fox jumps over the lazy dog near the old river bank at dawn")], "item_id long, text string")
    other = "Carol buys 17 apples for 120 dollars at the corner market and later sells 5 apples to Dave for 90 dollars. How many apples does Carol have?"
    mixed = "Carol buys 17 apples for 120 dollars at the corner market and later sells 17 apples to Dave for 17 dollars. How many apples does Erin have?"
    rows = [(1, f"Well. {other} So."), (2, ITEM), (2, ITEM), (3, None), (4, ""), (5, "nothing of the kind is said here by anyone at all"), (6, "Carol buys 17 apples for 120 euros"), (7, f"{ITEM} The QUICK brown fox jumps over the lazy dog, near the old river bank at dawn."), (8, mixed)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.item_ids for x in decontaminate(docs, items).collect()}
    assert got == {1: "1", 2: "1", 3: "", 4: "", 5: "", 6: "", 7: "1,5", 8: got[8]}
    assert decontaminate(docs, items).count() == len(rows)
    assert {x.doc_id for x in drop_leaks(docs, items).collect()} >= {3, 4, 5, 6}
    assert not {1, 2, 7} & {x.doc_id for x in drop_leaks(docs, items).collect()}
    assert decontaminate(odd_docs, items).where("contaminated").count() == 0
    assert drop_leaks(odd_docs, items).columns == odd_docs.columns and drop_leaks(odd_docs, items).count() == odd_docs.count()
    assert decontaminate(docs.limit(0), items).count() == 0 and decontaminate(docs, items.limit(0)).where("contaminated").count() == 0


def test_slots_must_map_consistently(spark):
    item = "if Zed has 11 red balls and 22 green balls and 33 blue balls then Zed and Yan share 11 red balls and 22 green balls and 33 blue balls"
    good = item.replace("11", "4").replace("22", "5").replace("33", "6").replace("Zed", "Kim").replace("Yan", "Lee")
    bad = "if Kim has 1 red balls and 2 green balls and 3 blue balls then Lee and Pat share 7 red balls and 8 green balls and 9 blue balls"
    docs = spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")
    got = {x.doc_id: x.contaminated for x in decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {1: True, 2: False}


def plain_template(text):
    """Template tokens as (kind, said), by rules of its own: regular expressions and loops over words."""
    from rowkin.llm.decontaminate import NUMBER_WORDS, UNITS

    out, last = [], None
    for m in re.finditer(r"[0-9A-Za-z\u0080-\U0010FFFF]+", text):
        w, gap = m.group(), text[last.end() : m.start()] if last else ""
        opens = last is None or re.search(r"[.!?:;\n\"()]", gap)
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
        if re.search("[0-9]", w) or low in NUMBER_WORDS:
            kind = "num"
        elif (w[0].isascii() and w[0].isupper() or "\u00c0" <= w[0] <= "\u00de") and not opens and len(w.encode()) > (1 if w[0].isascii() else 2):
            kind = "name"
        elif low in UNITS and out and out[-1][0] == "num":
            kind = "unit"
        else:
            kind = "word"
        if kind in ("num", "name") and out and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1] + (low,))
        else:
            out.append((kind, (low,)))
        last = m
    return out


def plain_contains(doc, item):
    """Whether a document holds an item, by the longest chain of equal windows over all pairs of places."""
    a, b = plain_template(item), plain_template(doc)
    k, least = (3, 1) if len(a) < 14 else (5, 2) if len(a) < 23 else (8, 4)
    shown = lambda t: t[1] if t[0] == "word" else t[0]
    good = [i for i in range(len(a) - k + 1) if sum(t[0] == "word" for t in a[i : i + k]) >= least]
    spots = [(j, i) for i in good for j in range(len(b) - k + 1) if all(shown(x) == shown(y) for x, y in zip(a[i : i + k], b[j : j + k], strict=True))]
    chains = {}
    for j, i in sorted(spots):  # one diagonal after the other: copies here have no words put in
        chains.setdefault(j - i, []).append((j, i))
    for chain in chains.values():
        pairs = {(a[i + x][1], b[j + x][1]) for j, i in chain for x in range(k) if a[i + x][0] != "word"}
        left, right = {x for x, _ in pairs}, {y for _, y in pairs}
        if len(chain) >= 0.5 * len(good) and len({i + x for _, i in chain for x in range(k)}) >= 7 and len(pairs) - len(left) <= 0.2 * len(left) and len(pairs) - len(right) <= 0.2 * len(right):
            return True
    return False


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_decontamination_equals_the_plain_version(spark, rows):
    r = random.Random(8)
    words = ["".join(r.choice("abdeiklmnorstu") for _ in range(r.randint(3, 7))) for _ in range(60)]
    names = ["Alda", "Bert", "Cleo", "Dora", "Egon", "Fred", "Gina", "Hugo"]

    def sentence(n):
        return " ".join(r.choice(names) if r.random() < 0.12 else f"{r.randint(2, 99)} apples" if r.random() < 0.15 else r.choice(words) for _ in range(n))

    items = [f"Then {sentence(r.randint(10, 30))}." for _ in range(25)]
    items += [re.sub(r"[0-9]+", lambda m: str(int(m.group()) + 7), items[0]), items[3]]  # the same template; the same text

    def asked_again(text, clash):
        numbers, people = {}, dict(zip(names, r.sample(names, len(names)), strict=True))
        text = re.sub(r"[0-9]+", lambda m: "5" if clash else numbers.setdefault(m.group(), str(100 + len(numbers))), text)
        return " ".join(people.get(w, w) for w in text.split(" "))

    docs = [sentence(r.randint(5, 60)) for _ in range(60)]
    for k, i in enumerate(items):
        docs += [f"{sentence(6)}. {i} {sentence(5)}", f"{sentence(4)}. {asked_again(i, False)} {sentence(9)}", f"So. {asked_again(i, True)}", " ".join(i.split()[: len(i.split()) // 3]), f"{items[k - 1]} {i}"]
    from rowkin.llm.decontaminate import Rules

    got = {x.doc_id: x.item_ids for x in decontaminate(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), Rules(broadcast_rows=rows)).collect()}
    want = {d: ",".join(str(k) for k, i in enumerate(items) if plain_contains(text, i)) for d, text in enumerate(docs)}
    assert sum(map(bool, want.values())) > 60 and got == want


def test_hot_keys_are_joined_whole(spark):
    from pyspark.sql import functions as F

    from rowkin.llm import common

    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = common.look_up(rows, table, "k", "n", 5000)
    assert got.count() == 5000 and got.where("k = 0").agg(F.min("top")).first()[0] == 4998
    assert table.where(F.col("n") > 5000 // common.HOT_KEYS + 1).count() == 1


def test_scratch_tables_go_when_released(spark):
    import os

    from rowkin.llm.common import materialise, release

    df = materialise(spark.range(5))
    path = df.rowkin_scratch.removeprefix("file:")
    assert os.path.exists(path) and df.count() == 5
    release(df, None)
    release(df)
    assert not os.path.exists(path)
    found = ngram_join.classes(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string"))
    assert found.count() == 3 and len(found.rowkin_reads) == 2


def test_empties_without_an_id_join_nothing(spark):
    rows = [(None, None), (None, ""), (0, ""), (0, ""), (0, "a b"), (5, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F_key()).withColumn("row", F_key())
    got = sorted((x.doc_id is None, x.doc_id or 0, x.n_shingles, x.component_id is None, x.component_id or 0) for x in near_duplicates(docs).collect())
    assert got == [(False, 0, 0, False, 0), (False, 0, 0, False, 0), (False, 0, 1, False, 0), (False, 5, 0, False, 5), (True, 0, 0, True, 0), (True, 0, 0, True, 0)]
    kept = keep_one(docs)
    assert kept.columns == ["doc_id", "text", "key", "row"] and kept.count() == 5  # the repeated row goes


def F_key():
    from pyspark.sql import functions as F

    return F.lit("clash")
