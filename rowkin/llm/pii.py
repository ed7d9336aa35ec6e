"""Operator 3, personal data by exact patterns and a skip-chain conditional random field.

Patterns give the base spans (email, ip, card, phone). The field labels tokens
that could be personal at all (they hold a digit or an @, a cue word announces
them, as in "password: x", "token=x" and "username x", or they repeat the name or
value of such a token); every other token is plain and cuts the chain. Its
potentials join neighbours in the chain and, across any distance, tokens of one
document that are the same or similar; loopy belief propagation carries what is
certain at one place to the others. Tokens it labels become further spans.

Weights are trained here by pseudo-likelihood on generated sentences (their
number is a parameter), on the driver; they are of fixed size.

Defined results: null and empty texts have no spans. Repeated rows are scanned
one by one. Overlaps: a span of the field that touches a base span is dropped.
Ties between labels go to the plain one. Extra columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.llm.common import give_back, steady

BASE_KINDS = ("email", "ip", "card", "phone")
LABELS = ("plain", "email", "ip", "card", "phone", "secret", "handle")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def _emails(text: str) -> list[Span]:
    """Leftmost matches: at each @ the longest run before it, back to the last match, and the domain after it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append(("email", begin, domain.end()))
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start. Spans count code points, ends are exclusive."""
    out = _emails(text)
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.groups()):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---- the field ----

_MARK = re.compile(r"[0-9@]")
_MARKED = re.compile(r"[0-9@]\S*+")  # from a token's first mark to its end
_WORD = re.compile(r"\S++")
_TRIM = "\"'.,;:!?()[]{}<>"
#: Words that announce a kind.
CUES = {"email": {"email", "e-mail", "mail", "contact"}, "ip": {"ip", "address", "host", "server"}, "card": {"card", "visa", "mastercard", "credit"}, "phone": {"phone", "tel", "call", "mobile", "fax"}, "secret": {"password", "passwd", "token", "secret", "key", "apikey", "api_key"}, "handle": {"user", "username", "login", "account", "id"}}
_KEYED = re.compile(r"(?i)(?:password|passwd|pwd|token|secret|api_?key|key)\W*[=:]\W*")
#: Words that announce the next token whatever it is made of: those that do so with = or :, and those that need no sign.
_SAID = ("password", "passwd", "pwd", "token", "secret", "apikey", "api_key", "username", "user", "login")
_BARE = ("password", "passwd", "apikey", "api_key", "username", "login")
_CUE = re.compile(rf"(?i)(?<![a-z0-9])(?:(?:{'|'.join(_SAID)})[\"']?\s*+[=:]\s*+|key=|(?:{'|'.join(_BARE)})\s++)(?=\S)")
#: Words that follow a cue in plain sentences.
_FUNCTION = frozenset("is was are be and or for of to in the a an as with on at not must should can could will would has have had may that which this by from your my our his her their its it if when reset field page name".split())


def _token_start(text: str, at: int) -> int:
    while at and not text[at - 1].isspace():
        at -= 1
    return at


def _candidates(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or @. Each sign is looked at a bounded number of times, however long a token is."""
    return [(_token_start(text, m.start()), m.end()) for m in _MARKED.finditer(text)]


def _announced(text: str) -> list[tuple[int, int]]:
    """Tokens without a digit or @ that a cue word announces; of several cues inside one token, those after its last = count."""
    low = text.lower()
    if not any(w in low for w in (*_SAID, "key=")):
        return []
    out: list[tuple[int, int]] = []
    begin = end = last = -1  # of the token that was looked at last: its bounds, its last =
    taken = False
    for m in _CUE.finditer(text):
        a = m.end()
        if a >= end:
            begin, end = _token_start(text, a), _WORD.match(text, a).end()
            last, taken = text.rfind("=", a, end), _MARK.search(text, begin, end) is not None
        if taken or last >= a:
            continue
        value = text[a:end].strip(_TRIM)
        if len(value) >= 3 and not (len(value) <= 8 and value.lower() in _FUNCTION):
            out.append((begin, end))
            taken = True
    return out


def shape(token: str) -> list[str]:
    """Observed features of one token."""
    core = token.strip(_TRIM)
    digits = sum(c.isdigit() for c in core)
    upper = sum("A" <= c <= "Z" for c in core)
    n = max(len(core), 1)
    out = ["bias", f"len{min(n, 40) // 5}", f"digits{min(digits, 20) // 4}", f"share{int(4 * digits / n)}"]
    out.append("at" if "@" in core else "noat")
    if "@" in core and "." in core.rpartition("@")[2]:
        out.append("domain")
    if core.count(".") == 3 and core.replace(".", "").isdigit():
        out.append("quad")
    if core.startswith("+") and digits:
        out.append("plus")
    if digits >= 12 and digits == len(core.replace("-", "")):
        out.append("longnum")
        out.append("luhn" if luhn("".join(c for c in core if c in "0123456789")) else "noluhn")
    if "." in core and digits and digits < n and "@" not in core and core[:1].isalpha():
        out.append("dotname")
    if _KEYED.search(token):
        out.append("keyed")
    if n >= 16 and digits >= 3 and re.fullmatch(r"[0-9a-f]+", core.rpartition("=")[2].strip('"')):
        out.append("hex")
    if n >= 16 and digits and upper + digits == n and upper >= 4:
        out.append("capskey")
    if "=" in core:
        out.append("equals")
    if re.fullmatch(r"(?:1[89]|20)[0-9][0-9]", core):
        out.append("year")
    if re.fullmatch(r"[0-9]{1,3}(?:[.,][0-9]{1,3})?%?", core):
        out.append("small")
    if not digits and "@" not in core:
        out.append("word")
    return out


def cues(before: list[str]) -> list[str]:
    """Features from the few words before a token."""
    said = {w.strip(_TRIM + "=").lower() for w in before}
    return [f"cue_{kind}" for kind, words in CUES.items() if said & words]


def similar_keys(token: str) -> list[str]:
    """Tokens that share a key are joined: the token itself, its digits alone, the part of an address before @."""
    core = token.strip(_TRIM).lower()
    keys = [f"t:{core}"] if core else []
    digits = "".join(c for c in core if c.isdigit())
    if len(digits) >= 6:
        keys.append(f"d:{digits}")
    name = core.partition("@")[0] if "@" in core else core
    if len(name) >= 4 and name != core or ("@" not in core and len(name) >= 4):
        keys.append(f"n:{name}")
    tail = core.rpartition("=")[2].strip('"')
    if tail and tail != core and len(tail) >= 6:
        keys += [f"t:{tail}", f"n:{tail}"]
    return keys


#: Edges whose messages are computed at once.
EDGES = 1 << 14


@dataclass
class Field:
    """unary: feature -> weight per label; chain, skip: label by label."""

    unary: dict[str, np.ndarray]
    chain: np.ndarray
    skip: np.ndarray
    rounds: int = 12

    def scores(self, features: list[list[str]]) -> np.ndarray:
        none = np.zeros(len(LABELS))
        return np.array([sum((self.unary.get(f, none) for f in fs), none) for fs in features]).reshape(len(features), len(LABELS))

    def marginals(self, unary: np.ndarray, chain: list[tuple[int, int]], skip: list[tuple[int, int]]) -> np.ndarray:
        """Loopy sum-product with damped messages along both directions of every edge."""
        n = len(unary)
        pairs = np.array([*chain, *skip], np.int64).reshape(-1, 2)
        if not len(pairs):
            return _softmax(unary)
        pair = np.stack([self.chain, self.skip, self.chain.T, self.skip.T])
        kind = np.repeat([0, 1, 2, 3], [len(chain), len(skip), len(chain), len(skip)])
        src = np.concatenate([pairs[:, 0], pairs[:, 1]])
        dst = np.concatenate([pairs[:, 1], pairs[:, 0]])
        back = (np.arange(len(src)) + len(pairs)) % len(src)
        messages = np.zeros((len(src), len(LABELS)))
        for _ in range(self.rounds):
            belief = unary.copy()
            np.add.at(belief, dst, messages)
            new = np.empty_like(messages)
            for i in range(0, len(src), EDGES):
                some = slice(i, i + EDGES)
                cavity = (belief[src[some]] - messages[back[some]])[:, :, None] + pair[kind[some]]
                top = cavity.max(1, keepdims=True)
                new[some] = np.log(np.exp(cavity - top).sum(1)) + top[:, 0]
            new -= new.max(1, keepdims=True)
            messages = 0.5 * messages + 0.5 * new
        belief = unary.copy()
        np.add.at(belief, dst, messages)
        return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@dataclass
class Graph:
    tokens: list[tuple[int, int]]
    features: list[list[str]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def _has_nodes(text: str) -> bool:
    return _MARK.search(text) is not None or bool(_announced(text))


def graph_of(text: str) -> Graph:
    """Nodes in text order; chain edges join neighbours, skip edges each token to the previous one with the same key."""
    said = set(_announced(text))
    spans = sorted([*_candidates(text), *said])
    before = [text[max(0, a - 48) : a].split()[-3:] for a, _ in spans]
    named = {k for a, b in spans for k in similar_keys(text[a:b]) if k[0] == "n" and not k[2:].isdigit()}
    tokens, features = list(spans), [shape(text[a:b]) + cues(w) + ["said"] * ((a, b) in said) for (a, b), w in zip(spans, before, strict=True)]
    wanted = {k[2:] for k in named if not _MARK.search(k[2:])} | {k[2:] for a, b in said for k in similar_keys(text[a:b])}
    if wanted:  # other words that repeat the name of an address or what was announced
        for m in _WORD.finditer(text):
            core = m.group().strip(_TRIM).lower()
            if core in wanted and m.span() not in said and not _MARK.search(m.group()):
                tokens.append(m.span())
                features.append(shape(m.group()) + cues(text[max(0, m.start() - 48) : m.start()].split()[-3:]))
    order = sorted(range(len(tokens)), key=lambda i: tokens[i])
    tokens, features = [tokens[i] for i in order], [features[i] for i in order]
    chain = [(i, i + 1) for i in range(len(tokens) - 1) if not text[tokens[i][1] : tokens[i + 1][0]].strip()]
    last: dict[str, int] = {}
    skip = set()
    for i, (a, b) in enumerate(tokens):
        for key in similar_keys(text[a:b]):
            if key in last and last[key] != i:
                skip.add((last[key], i))
            last[key] = i
    return Graph(tokens, features, chain, sorted(skip.difference(chain)))


def _generated(n: int, seed: int) -> list[tuple[Graph, list[int]]]:
    """Sentences with known labels: words of random letters, personal data among them, some of it repeated."""
    r = np.random.RandomState(seed)

    def letters(lo: int, hi: int) -> str:
        return "".join(chr(97 + x) for x in r.randint(0, 26, r.randint(lo, hi + 1)))

    def number(k: int) -> str:
        return "".join(str(x) for x in r.randint(0, 10, k))

    def long_number(valid: bool) -> str:
        """Sixteen digits that pass the check sum of cards, or don't."""
        body = number(15)
        right = next(c for c in "0123456789" if luhn(body + c))
        return body + (right if valid else str((int(right) + r.randint(1, 10)) % 10))

    def make(kind: str) -> tuple[str, str]:
        """(text, core that may be repeated later)"""
        if kind == "email":
            name = f"{letters(3, 9)}.{number(2)}" if r.rand() < 0.6 else letters(4, 10)
            return f"{name}@{letters(3, 8)}.{letters(2, 3)}", name
        if kind == "card":
            t = long_number(True)
        elif kind == "ip":
            t = ".".join(str(x) for x in r.randint(0, 256, 4))
        elif kind == "phone":
            t = f"+{number(11)}"
        elif kind == "secret":
            body = "".join("0123456789abcdef"[x] for x in r.randint(0, 16, r.randint(16, 40)))
            if r.rand() < 0.4:
                body = "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[x] for x in r.randint(0, 36, 20))
                return (f"AKIA{body[4:]}",) * 2
            return f"{r.choice(['password', 'token', 'secret', 'api_key'])}={body}", body
        else:
            t = f"{letters(3, 8)}{number(2)}"
        return t, t

    out = []
    for _ in range(n):
        words, known = [], []

        def say(word: str, label: int, known=known, words=words) -> None:
            known.append((sum(len(w) + 1 for w in words), label))
            words.append(word)

        for _ in range(r.randint(1, 4)):
            for _ in range(r.randint(2, 8)):
                words.append(letters(1, 9))
            roll = r.rand()
            if roll < 0.3:
                say(str(r.choice([number(r.randint(1, 4)), f"{r.randint(1800, 2030)}", f"{number(1)}.{number(2)}", f"{number(2)}%", f"{letters(2, 5)}{number(1)}", f"{number(2)}-{number(2)}", f"v{number(1)}.{number(1)}.{number(1)}", long_number(False), number(r.randint(7, 15))])), 0)
                continue
            kind = LABELS[r.randint(1, len(LABELS))]
            if kind == "handle" or r.rand() < 0.25:
                words.append(str(r.choice(sorted(CUES[kind]))))
            text, core = make(kind)
            if kind in ("secret", "handle") and r.rand() < 0.25:  # letters alone, told by a cue word
                core = letters(4, 20) if kind == "secret" else letters(3, 9)
                cue, sign = str(r.choice(["password", "token", "secret", "api_key"] if kind == "secret" else ["username", "login", "user"])), r.rand()
                text = f"{cue}={core}" if sign < 0.4 else core
                if sign >= 0.4:
                    words.append(f"{cue}:" if sign < 0.7 or cue not in _BARE else cue)
            say(text, LABELS.index(kind))
            if r.rand() < 0.5:
                for _ in range(r.randint(1, 6)):
                    words.append(letters(1, 9))
                say(core if kind in ("email", "secret") else text, LABELS.index("handle" if kind == "email" and core != text else kind))
        text = " ".join(words)
        graph, at = graph_of(text), dict(known)
        out.append((graph, [at.get(a, 0) for a, _ in graph.tokens]))
    return out


def train(sentences: int = 1500, seed: int = 11, epochs: int = 30, rate: float = 0.3, l2: float = 1e-4) -> Field:
    """Pseudo-likelihood: each token's label given its features and its neighbours' true labels; full-batch AdaGrad."""
    examples = _generated(sentences, seed)
    names = sorted({f for g, _ in examples for fs in g.features for f in fs})
    place = {f: i for i, f in enumerate(names)}
    k, offset = len(LABELS), 0
    rows, cols, y, chain, skip = [], [], [], [], []
    for g, labels in examples:
        for i, fs in enumerate(g.features):
            rows += [offset + i] * len(fs)
            cols += [place[f] for f in fs]
        chain += [(offset + a, offset + b) for a, b in g.chain]
        skip += [(offset + a, offset + b) for a, b in g.skip]
        y += labels
        offset += len(labels)
    rows, cols, y = np.array(rows), np.array(cols), np.array(y)
    chain, skip = np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2)
    unary, pair = np.zeros((len(names), k)), [np.zeros((k, k)), np.zeros((k, k))]
    squares = [np.full_like(w, 1e-6) for w in (unary, *pair)]
    target = np.eye(k)[y]
    for _ in range(epochs):
        s = np.zeros((offset, k))
        np.add.at(s, rows, unary[cols])
        for w, edges in zip(pair, (chain, skip), strict=True):
            np.add.at(s, edges[:, 0], w[:, y[edges[:, 1]]].T)
            np.add.at(s, edges[:, 1], w[y[edges[:, 0]]])
        error = (_softmax(s) - target) / offset
        g_unary = np.zeros_like(unary)
        np.add.at(g_unary, cols, error[rows])
        grads = [g_unary]
        for edges in (chain, skip):
            g = np.zeros((k, k))
            np.add.at(g.T, y[edges[:, 1]], error[edges[:, 0]])
            np.add.at(g, y[edges[:, 0]], error[edges[:, 1]])
            grads.append(g)
        for w, g, q in zip((unary, *pair), grads, squares, strict=True):
            g = g + l2 * w
            q += g * g
            w -= rate * g / np.sqrt(q)
    return Field({f: unary[i] for f, i in place.items()}, pair[0], pair[1])


def field_spans(text: str, field: Field, taken: list[Span], least: float = 0.5) -> list[Span]:
    """Spans of tokens that the field labels, next to none of the taken ones, by label, then start.

    A token that overlaps a base span is observed with that kind, so its certainty travels along its edges.
    """
    g = graph_of(text)
    if not g.tokens:
        return []
    scores = field.scores(g.features)
    busy, i = sorted(taken, key=lambda s: s[1]), 0
    covered = [False] * len(g.tokens)
    ends = np.maximum.accumulate([s[2] for s in busy]) if busy else []
    for t, (a, b) in enumerate(g.tokens):
        i = int(np.searchsorted(ends, a, "right")) if busy else 0
        while i < len(busy) and busy[i][1] < b:
            if busy[i][2] > a:
                covered[t] = True
                scores[t, LABELS.index(busy[i][0])] += 20
                break
            i += 1
    p = field.marginals(scores, g.chain, g.skip)
    out = []
    for t, (a, b) in enumerate(g.tokens):
        label = int(p[t].argmax())
        if covered[t] or not label or p[t, label] < least:
            continue
        token = text[a:b]
        a += len(token) - len(token.lstrip(_TRIM))
        b -= len(token) - len(token.rstrip(_TRIM))
        if b > a:
            out.append((LABELS[label], a, b))
    return sorted(out, key=lambda s: (LABELS.index(s[0]), s[1]))


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): by kind as listed in LABELS, then start."""
    if not _has_nodes(text):
        return [], []
    base = base_spans(text)
    more = field_spans(text, field, base)
    return base, sorted([*base, *more], key=lambda s: (LABELS.index(s[0]), s[1]))


def _said(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"


def find_personal(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per input row, in one pass without a shuffle."""
    field = field or train()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = all_spans(text or "", field)
                counts = defaultdict(int)
                for s in base:
                    counts[s[0]] += 1
                rows.append((*(counts[k] for k in BASE_KINDS), hashlib.sha256(_said(base).encode()).hexdigest(), _said(every), len(every)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return steady(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda batches: give_back(scan(batches)), SCHEMA)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    out.append(text[at:])
    return "".join(out)


def mask_personal(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """The input's rows and columns with personal data masked in ``text`` and ``n_chars`` counted again."""
    field = field or train()
    names, schema = docs.columns, docs.schema

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            texts = [t if t is None else masked(t, all_spans(t, field)[1]) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if "n_chars" in names:
                n = names.index("n_chars")
                columns[n] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return steady(docs).mapInArrow(lambda batches: give_back(mask(batches)), schema)
