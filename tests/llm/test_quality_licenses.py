import collections
import random
import re

import zstandard

from rowkin.llm.licenses import Rule, rules, scan_licenses
from rowkin.llm.quality import Bands, compression, keep_good, quality_rules


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
        seen.add(line)
    c = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_the_plain_version(spark, odd_docs):
    r = random.Random(2)
    signs = ["a", "bb", "é", "\n", " ", "\x0b", "#", "<", "a b c", "😀", "\x1c"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for df, known in ((docs, dict(enumerate(texts))), (odd_docs, None)):
        source = known or {row.doc_id: row.text for row in odd_docs.collect()}
        out = quality_rules(df).collect()
        assert len(out) == df.count()
        for x in out:
            want = counts(source[x.doc_id])
            assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
            assert x.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (x.kept and x.base_failed)


def test_bands_reject_repetition_and_noise():
    packer, r = zstandard.ZstdCompressor(level=3), random.Random(3)
    words = [f"{''.join(r.choice('abcdefghij') for _ in range(r.randint(2, 9)))}" for _ in range(3000)]
    assert compression(" ".join(words).encode(), packer, Bands())[3]
    assert not compression(("again and again " * 800).encode(), packer, Bands())[3]
    assert not compression(r.randbytes(8000), packer, Bands())[3]
    assert compression(b"", packer, Bands()) == (None, 0, 0, False)


def test_verdicts_equal_the_plain_version(spark):
    """Ratios, chunks and verdicts by plain slices, from the limits as they are stated."""
    r, bands = random.Random(12), Bands()
    words = ["".join(r.choice("etaoinshrdlucm") for _ in range(r.randint(2, 9))) for _ in range(400)]
    noise = lambda n: "".join(chr(r.randint(33, 126)) for _ in range(n))
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    texts = [f(k) for k in (5, 60, 200, 255, 256, 511, 512, 900, 2048, 5000, 8191, 8192, 20_000) for f in (noise, prose)]
    texts += [prose(300) + noise(n) for n in (300, 2000, 9000)] + ["la la la " * n for n in (10, 100, 3000)] + [noise(1500) + " " + prose(900) for _ in range(5)] + ["é" * 700, "x", "", None]
    packed = lambda b: len(zstandard.ZstdCompressor(level=3).compress(b))

    def plain(text):
        raw = (text or "").encode()
        n = len(raw)
        if not n:
            return None, 0, 0, False
        low, high = [(lo, hi) for least, lo, hi in bands.whole if n >= least][-1]
        inside = low <= packed(raw) / n <= high
        if n < 256:
            return packed(raw) / n, 1, int(not inside), inside
        size, lo, hi = (4096, 0.10, 0.80) if n >= 8192 else (1024, 0.10, 0.88) if n >= 2048 else (256, 0.10, 0.95)
        bad = [min(size, n - i) for i in range(0, n, size) if not lo <= packed(raw[min(i + size, n) - size : min(i + size, n)]) / size <= hi]
        return packed(raw) / n, -(-n // size), len(bad), inside and sum(bad) <= 0.5 * n

    out = {x.doc_id: x for x in quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        x, (ratio, chunks, bad, good) = out[i], plain(text)
        assert (x.ratio, x.n_chunks, x.n_bad_chunks, x.kept) == (ratio, chunks, bad, good and not x.base_failed), i
    assert 3 < sum(x.kept for x in out.values()) < len(texts)


def test_keep_good_keeps_rows_and_columns(spark, odd_docs):
    kept = keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    verdict = {(x.doc_id, x.kept) for x in quality_rules(odd_docs).collect()}
    assert {x.doc_id for x in kept.collect()} == {i for i, k in verdict if k} == {5}
    assert keep_good(odd_docs.limit(0)).count() == 0 and quality_rules(odd_docs.limit(0)).count() == 0


def plain_scan(text, signatures):
    """Every rule on every text, without gates; containment by comparing all detections."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")) for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    joined, hits = f" {' '.join(w)} ", []
    for k, rule in enumerate(signatures):
        if rule.gate in w:
            for m in re.finditer(f" {rule.pattern}(?= )", joined):
                start = joined[: m.start()].count(" ")
                hits.append((start, start + m.group().count(" "), rule.priority, k, rule))
    def beats(g, h):
        if not (g[0] <= h[0] and g[1] >= h[1] and g[2] >= h[2]) or g is h:
            return False
        return (g[0], -g[1], -g[2], g[3]) < (h[0], -h[1], -h[2], h[3])
    kept = [h for h in hits if not any(beats(g, h) for g in hits)]
    labels = {x[1] for x in places} | {h[4].label for h in kept}
    score = max([h[4].confidence for h in kept] + [0.6 if places else 0.0])
    at = sorted(x[0] for x in places)
    return len(w), len(places), at[0] if at else None, at[-1] if at else None, ",".join(sorted({x[1] for x in places})), ",".join(sorted(labels)), score


def test_scan_equals_the_plain_version(spark, odd_docs):
    r = random.Random(4)
    bits = ["MIT License", "the GNU General Public License, version 3", "Apache License, Version 2.0", "CC BY-NC 4.0", "all rights reserved", "without any warranty", "released under the MIT license", "SPDX-License-Identifier: GPL-3.0-only", "bsd 3-clause", "words", "é", "mit", "license", "public", "general", ".", "\n", "_", "Creative Commons Attribution 4.0"]
    texts = [" ".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(150)]
    rows = list(enumerate(texts))
    signatures = rules()
    assert len(signatures) > 200
    got = {x.doc_id: x for x in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for i, text in rows:
        x = got[i]
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels, x.score) == plain_scan(text, signatures), text
    assert scan_licenses(odd_docs).count() == odd_docs.count()
    empty = {x.doc_id: x for x in scan_licenses(odd_docs).collect()}[2]
    assert (empty.n_words, empty.n_base, empty.labels, empty.score) == (0, 0, "", 0.0)
    assert scan_licenses(odd_docs.limit(0)).count() == 0


def test_scan_runs_no_python(spark, odd_docs):
    plan = scan_licenses(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_a_rule_is_dropped_inside_a_stronger_one(spark):
    own = [Rule("short", "license", "license", 1, 0.5), Rule("long", "license", "big license here", 2, 0.9), Rule("wide", "license", "a big license here now", 1, 0.4)]
    x = scan_licenses(spark.createDataFrame([(1, "a big license here now, license")], "doc_id long, text string"), own).first()
    assert x.labels == "long,short,wide" and x.found.count('"short"') == 1


def test_scan_is_linear_in_detections(spark):
    import time

    began = time.time()
    n = 100_000
    x = scan_licenses(spark.createDataFrame([(1, "released under the MIT License\n" * n), (2, "MIT " * n)], "doc_id long, text string")).select("doc_id", "n_base", "labels", "score").orderBy("doc_id").collect()
    assert [tuple(y) for y in x] == [(1, n, "mit", 0.8), (2, 0, "", 0.0)] and time.time() - began < 90


def test_signatures_hold_their_gates():
    from rowkin.llm.license_rules import table

    rows = table()
    assert len(rows) >= 300 and len({x[2] for x in rows}) == len(rows)
    for _, gate, pattern, _, _ in rows:
        bare = pattern
        while (now := re.sub(r"\(\?:[^()]*\)\?", "", bare)) != bare:
            bare = now
        assert re.search(rf"(?<![0-9a-z]){gate}(?![0-9a-z?])", bare), pattern
