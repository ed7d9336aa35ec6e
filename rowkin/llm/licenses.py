"""Operator 10, license scans by ordered signature rules, in DataFrame functions alone.

The signatures stand in ``license_rules``. A cheap pattern over the raw text finds
texts that hold any gate word at all. Only these are cut into words; the gate
words they hold select rules, each rule's regular expression runs over the words,
and of detections that overlap, one contained in another of the same or a higher
priority is dropped. Time is linear in the text and in its detections.

Defined results: a null text is empty: no words, no labels, score 0. Repeated
rows are scanned one by one. Detections of the same place and priority: the
lower rule number stays. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowkin.llm.license_rules import table

#: A word, before A-Z are lower-cased.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++"


@dataclass(frozen=True)
class Rule:
    label: str
    gate: str
    pattern: str
    priority: int
    confidence: float


def rules() -> list[Rule]:
    """The hand-written signatures, more specific ones with a higher priority."""
    return [Rule(*x) for x in table()]


def _gates(signatures: list[Rule]) -> list[str]:
    return sorted({r.gate for r in signatures} | {"license"})


def _prefilter(gates: list[str]) -> str:
    """A pattern that any lower-cased text with a gate word matches; words that start alike share a branch."""
    tree: dict = {}
    for word in gates:
        at = tree
        for c in word:
            at = at.setdefault(c, {})
        at[""] = {}

    def branch(at: dict) -> str:
        parts = [c + branch(x) for c, x in sorted(at.items()) if c]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
        return f"(?:{body})?" if "" in at else body

    starts = "".join(sorted({w[0] for w in gates}))
    return f"(?<![0-9a-z])(?=[{starts}])(?:{branch(tree)})(?![0-9a-z])"


OPEN, CLOSE = "\x01", "\x02"  # never part of a word


def _marked(joined: Column, rule: Column) -> Column:
    """The words with a sign before and behind each match of a rule, so that places follow from one pass over them."""
    return F.struct(rule["number"].alias("number"), rule["label"].alias("label"), rule["priority"].alias("priority"), rule["confidence"].alias("confidence"), F.regexp_replace(joined, rule["pattern"], F.lit(f" {OPEN}$1{CLOSE}")).alias("marked"))


def _places(m: Column) -> Column:
    """Detections of one rule: a match begins at a word with the first sign and ends behind one with the second."""
    words = F.split(m["marked"], " ")
    begins = F.filter(F.transform(words, lambda w, i: F.when(w.startswith(OPEN), i - 1)), lambda i: i.isNotNull())
    ends = F.filter(F.transform(words, lambda w, i: F.when(w.endswith(CLOSE), i)), lambda i: i.isNotNull())
    return F.zip_with(begins, ends, lambda a, z: F.struct(a.alias("start"), (-z).alias("back"), (-m["priority"]).alias("order"), m["number"].alias("number"), m["label"].alias("label"), m["confidence"].alias("confidence")))


#: How many detections before one are looked at for one that contains it; each is taken only where it is proven to be enough.
LOOK_BACK = (64, 1024)


def _look_back(ordered: Column, longest: Column) -> Column:
    """The least step of LOOK_BACK beyond which all earlier detections begin too far away to reach into a later one, else all."""

    def enough(k: int) -> Column:
        gaps = F.transform(ordered, lambda h, i: F.get(ordered, i + k)["start"] - h["start"])
        return ~F.exists(gaps, lambda gap: F.coalesce(gap <= longest, F.lit(False)))

    out = F.when(enough(LOOK_BACK[0]), LOOK_BACK[0])
    for k in LOOK_BACK[1:]:
        out = out.when(enough(k), k)
    return out.otherwise(F.size(ordered))


def _kept(ordered: Column, back: Column) -> Column:
    """Detections that none of the same or a higher priority contains. Sorted by start, longest and strongest first, only earlier ones can."""
    earlier = lambda i: F.slice(ordered, F.greatest(i - back, F.lit(0)) + 1, F.least(i, back))
    alone = F.filter(ordered, lambda h, i: ~F.exists(earlier(i), lambda g: (g["back"] <= h["back"]) & (g["order"] <= h["order"])))
    return F.transform(alone, lambda h: F.struct(h["start"].alias("start"), (-h["back"]).alias("end"), h["label"].alias("label"), h["confidence"].alias("confidence")))


def scan_licenses(docs: DataFrame, signatures: list[Rule] | None = None) -> DataFrame:
    """One row per input row: counts, base places, labels, score, and the kept detections. No shuffle."""
    signatures = rules() if signatures is None else signatures
    gates = _gates(signatures)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"))
    no_words = F.array().cast("array<string>")
    out = out.withColumn("words", F.when(F.lower("text").rlike(_prefilter(gates)), F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))).otherwise(no_words)).drop("text")
    words = F.col("words")
    at = lambda i: F.get(words, i)

    def base(word: Column, i: Column) -> Column:
        one = lambda start, label: F.struct(start.cast("long").alias("at"), F.lit(label).alias("label"))
        return F.when(word != "license", None).when(at(i - 1) == "mit", one(i - 1, "mit")).when(at(i - 1) == "apache", one(i - 1, "apache")).when((at(i - 1) == "public") & (at(i - 2) == "general"), one(i - 2, "gpl"))

    out = out.withColumn("base", F.filter(F.transform(words, base), lambda x: x.isNotNull()))
    out = out.withColumn("joined", F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")))
    out = out.withColumn("gates", F.array_intersect(words, F.array(*map(F.lit, gates))))
    every = F.array(*(F.struct(F.lit(i).alias("number"), F.lit(r.label).alias("label"), F.lit(r.gate).alias("gate"), F.lit(f" ({r.pattern})(?= )").alias("pattern"), F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence")) for i, r in enumerate(signatures)))
    chosen = F.filter(every, lambda r: F.array_contains(F.col("gates"), r["gate"]))
    marked = F.filter(F.transform(chosen, lambda r: _marked(F.col("joined"), r)), lambda m: m["marked"] != F.col("joined"))
    hit = "array<struct<start:int,back:int,order:int,number:int,label:string,confidence:double>>"
    out = out.withColumn("ordered", F.when(F.size("gates") > 0, F.array_sort(F.flatten(F.transform(marked, _places)))).otherwise(F.array().cast(hit)))
    # columns of their own: inside a lambda they would be computed again for every detection
    out = out.withColumn("longest", F.array_max(F.transform("ordered", lambda h: -h["back"] - h["start"])))
    out = out.withColumn("back", F.when(F.size("ordered") > 1, _look_back(F.col("ordered"), F.col("longest"))).otherwise(1))
    out = out.withColumn("found", _kept(F.col("ordered"), F.col("back")))
    starts, base_labels = F.transform("base", lambda x: x["at"]), F.transform("base", lambda x: x["label"])
    labels = F.array_union(base_labels, F.transform("found", lambda x: x["label"]))
    surest = F.aggregate("found", F.when(F.size("base") > 0, F.lit(0.6)).otherwise(F.lit(0.0)), lambda a, x: F.greatest(a, x["confidence"]))
    return out.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        surest.alias("score"),
        F.to_json("found").alias("found"),
    )
