"""Operator 6, URL filtering: exact host and path rules, then logistic regression.

The model sees character n-grams of host and path (bytes of UTF-8, A-Z lower-cased,
a run of digits as one sign), hashed to a fixed number of places, and is trained on
a small labelled table of URLs: rows of (label, url), 1 to be blocked. The table is
an argument (rows, or a DataFrame of at most ``MOST_LABELLED`` rows); the default one
comes from ``labelled_urls``, a generator with a seed. A rule that fits decides; the
model decides the rest.

Defined results: a null url, or one without ``://``, has an empty host and path,
no rule, and the model's verdict on its bias. Repeated rows are judged one by
one; of rules that fit, the longest wins, then the first. Extra columns are
ignored. An empty table gives no rows; without labels of both classes the model
allows, or blocks, everything as its labels do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.llm.common import U64, give_back, mix, owners, prefix_sums, span_hash, steady, text_blocks

PLACE_BITS = 15
GRAMS = (3, 4, 5)
THRESHOLD = 0.5
MOST_LABELLED = 20_000

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Words of which the generated table's unwanted and wanted addresses are made, and what stands around them.
UNWANTED = "casino slots jackpot poker betting bet odds bingo roulette lottery porn xxx adult cam sex escort viagra pills cheap meds pharma replica rolex payday loan cash prize winner claim giveaway spam farm backlinks seo link clickbait warez crack keygen torrent malware phish verify doorway parked popup track ads banner pixel".split()
WANTED = "news science museum library school college university history weather garden recipes music maps travel health council docs guide reference archive journal lecture physics poetry river mountain village theatre orchestra biology software manual forum blog stories reader wiki encyclopedia gallery letters museum parks census atlas grammar".split()
SYLLABLES = "an ba co da el fi ga ho in ka li mo ne or pa ra si ta un ve wi th er on re ti es".split()
ENDS = "com net org info biz online site co.uk de fr es".split()
SUBDOMAINS = ("", "", "www.", "m.", "blog.", "en.")
TAILS = ("", "", "/", ".html", "?page=2", "?utm_source=feed", "#top")


def labelled_urls(n: int = 4000, seed: int = 20, share: float = 0.4) -> list[tuple[int, str]]:
    """n labelled addresses, a share of them to be blocked: one or two words of a list among invented ones, in host or path.

    Plain paths hold words of neither list in both classes, and one wanted address in
    fifty also holds an unwanted word, so that no single word decides.
    """
    r = np.random.RandomState(seed)
    pick = lambda x: x[r.randint(len(x))]
    invented = lambda: "".join(pick(SYLLABLES) for _ in range(r.randint(2, 5)))
    out = []
    for _ in range(n):
        bad = r.rand() < share
        words = UNWANTED if bad else WANTED
        host = pick(("-", "")).join([pick(words), pick(words) if r.rand() < 0.4 else invented()][:: pick((1, -1))])
        if not bad and r.rand() < 0.4:
            host = invented()
        path = "/".join(["", pick(("en", "fr", "de", "es", "p", "item")), pick(words) if r.rand() < 0.4 else invented() if r.rand() < 0.3 else str(r.randint(1, 1000))])
        if not bad and r.rand() < 0.02:
            path += f"/{pick(UNWANTED)}"
        out.append((int(bad), f"{pick(('http', 'https'))}://{pick(SUBDOMAINS)}{host}.{pick(ENDS)}{path}{pick(TAILS)}"))
    return out


def split_urls(urls: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(hosts, paths) of whole URLs: host behind the first :// up to / ? # or the end, A-Z lower-cased; path up to ? # or the end."""
    found = pc.extract_regex(urls.cast(pa.string()), r"(?s)^(?:.*?)://(?P<host>[^/?#]*)(?P<path>[^?#]*)")
    host, path = (pc.fill_null(pc.struct_field(found, i), "") for i in (0, 1))
    return pc.ascii_lower(host), path


def _grams(texts: pa.Array, kind: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, row and place of each n-gram) by blocks; a text stands between ^ and $."""
    said = pc.replace_substring_regex(pc.binary_join_element_wise("^", pc.ascii_lower(texts), "$", ""), "[0-9]+", "0")
    for lo, hi, data, offsets in text_blocks(said):
        sums, rows, places = prefix_sums(data), [], []
        length = np.diff(offsets)
        for n in GRAMS:
            count = np.maximum(length - n + 1, 0)
            first = np.concatenate([[0], np.cumsum(count)])
            row = owners(first)
            start = offsets[:-1][row] + np.arange(len(row)) - first[:-1][row]
            rows.append(row)
            places.append((mix(span_hash(sums, start, start + n) + U64(kind * 8 + n)) >> U64(64 - PLACE_BITS)).astype(np.int64))
        yield lo, hi, np.concatenate(rows), np.concatenate(places)


def inputs(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the distinct n-grams of all rows, host and path apart."""
    pairs = [np.zeros(0, np.int64)]
    for kind, texts in ((1, hosts), (2, paths)):
        pairs += [np.unique(((lo + row) << PLACE_BITS) + place) for lo, _, row, place in _grams(texts, kind)]
    pairs = np.unique(np.concatenate(pairs))
    return pairs >> PLACE_BITS, pairs & ((1 << PLACE_BITS) - 1)


def _sums(rows: np.ndarray, places: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))
    return np.bincount(rows, weights=weights[places], minlength=n) / size + weights[-1]


def train(labelled: Sequence[tuple[int, str]], rounds: int = 400, rate: float = 2.0, l2: float = 3e-4) -> np.ndarray:
    """Weights and, last, the bias: full-batch gradient steps on length-normalised inputs."""
    y = np.array([v for v, _ in labelled], float)
    w = np.zeros((1 << PLACE_BITS) + 1)
    if len(set(y.tolist())) < 2:
        w[-1] = 10.0 if len(y) and y[0] else -10.0
        return w
    rows, places = inputs(*split_urls(pa.array([u for _, u in labelled], pa.string())))
    share = 1 / np.sqrt(np.bincount(rows, minlength=len(y)))[rows]
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) / len(y)
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-_sums(rows, places, len(y), w))) - y) * weight
        grad = np.append(np.bincount(places, weights=error[rows] * share, minlength=len(w) - 1), error.sum())
        w -= rate * (4 * grad + l2 * w)
    return w


def scores(hosts: pa.Array, paths: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The model's probability that each address is to be blocked."""
    rows, places = inputs(hosts, paths)
    return 1 / (1 + np.exp(-_sums(rows, places, len(hosts), weights)))


def auc(score: np.ndarray, label: np.ndarray) -> float:
    """The share of pairs of a blocked and an allowed address in the right order; ties count half."""
    order, ranks = np.argsort(score, kind="stable"), np.empty(len(score))
    ranked = score[order]
    low, high = np.searchsorted(ranked, ranked, "left"), np.searchsorted(ranked, ranked, "right")
    ranks[order] = (low + high + 1) / 2
    n = int(label.sum())
    return float((ranks[label == 1].sum() - n * (n + 1) / 2) / max(n * (len(label) - n), 1))


def judged(hosts: pa.Array, paths: pa.Array, rules: Sequence[tuple[str, str, str]]) -> np.ndarray:
    """The number of the rule that decides each address, -1 without one."""
    out = np.full(len(hosts), -1)
    for k in sorted(range(len(rules)), key=lambda k: -len(rules[k][1]) - len(rules[k][2])):
        _, host, path = rules[k]
        fits = pc.and_(pc.or_(pc.equal(hosts, host), pc.ends_with(hosts, "." + host)), pc.starts_with(paths, path))
        out[(out < 0) & fits.to_numpy(zero_copy_only=False)] = k
    return out


SCHEMA = "page_id long, host string, path string, rule string, verdict string, score double"


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labelled: Sequence[tuple[int, str]] | DataFrame | None = None) -> DataFrame:
    """One row per page; reads two columns, in one pass without a shuffle. The model is of fixed size.

    ``labelled``: rows of (label, url), or a DataFrame with these columns, of which the
    first ``MOST_LABELLED`` by hash are used.
    """
    if isinstance(labelled, DataFrame):
        known = labelled.select(F.col("label").cast("int"), F.col("url").cast("string")).where("label IS NOT NULL")
        labelled = [(x["label"], x["url"]) for x in known.orderBy(F.xxhash64("url"), "url", "label").limit(MOST_LABELLED).collect()]
    weights = train(labelled_urls() if labelled is None else labelled)
    names, verdicts = np.array([*(h + p for _, h, p in rules), None], object), np.array([*(v for v, _, _ in rules), ""], object)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = split_urls(batch.column(1))
            rule, p = judged(hosts, paths, rules), scores(hosts, paths, weights)
            verdict = np.where(rule >= 0, verdicts[rule], np.where(p >= THRESHOLD, "block", "allow"))
            yield pa.RecordBatch.from_arrays([batch.column(0), hosts, paths, pa.array(names[rule], pa.string()), pa.array(verdict, pa.string()), pa.array(p)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return steady(pages).select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(lambda b: give_back(judge(b)), SCHEMA)
