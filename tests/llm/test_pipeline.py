import pytest

import corpus_pipeline
from rowkin.llm.decontaminate import decontaminate
from rowkin.llm.ngram_join import near_duplicates
from rowkin.llm.packing import best_fit
from rowkin.llm.pii import all_spans, masked, train
from rowkin.llm.quality import quality_rules
from rowkin.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_equal_their_plain_versions(spark):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {x.doc_id: x.text for x in docs.collect()}
    now = docs
    steps = dict(corpus_pipeline.STAGES)

    good = {x.doc_id for x in quality_rules(now).where("kept").collect()}
    now = steps["quality rules"](spark, now, SF).cache()
    assert now.columns == docs.columns and {x.doc_id for x in now.collect()} == good

    first = {x.component_id for x in near_duplicates(now).collect()}
    now = steps["n-gram Jaccard join"](spark, now, SF).cache()
    assert now.columns == docs.columns and {x.doc_id for x in now.collect()} == first and now.count() == len(first)

    clean = {x.doc_id for x in decontaminate(now, benchmark).where("NOT contaminated").collect()}
    items = [" ".join(x.text.lower().split()) for x in benchmark.collect()]
    assert clean == {i for i in first if not any(t in " ".join(rows[i].lower().split()) for t in items)}
    now = steps["benchmark decontamination"](spark, now, SF).cache()
    assert {x.doc_id for x in now.collect()} == clean

    field = train()
    now = steps["personal data"](spark, now, SF).cache()
    assert now.columns == docs.columns and {x.doc_id: x.text for x in now.collect()} == {i: masked(rows[i], all_spans(rows[i], field)[1]) for i in clean}

    packed = steps["best-fit packing"](spark, now, SF)
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, packed.select(key).collect())) == sorted(map(tuple, best_fit(now).select(key).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(key).collect())) == sorted(map(tuple, packed.select(key).collect()))


def test_registry():
    ops = [k for k in QUERIES if k.startswith("op")]
    assert ops == sorted(ops, key=lambda k: int(k[2:].split("_")[0])) and len(ops) == 10 and set(ORACLE_SQL) <= set(QUERIES)
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run and set(QUERIES) < set(entry.queries())


def test_run_on_odd_tables(spark, odd_docs, tmp_path):
    """Nulls, empty and very long texts, repeated rows, clashing columns and empty tables through the whole pipeline."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from rowkin.llm.token_ids import tokenizer_path

    r = __import__("random").Random(2)
    words = ["".join(r.choice("etaoinshrdlucm") for _ in range(r.randint(2, 9))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    item = prose(30)
    good, leak, twice = prose(120), f"{prose(70)} {item} {prose(20)}", prose(90)
    rows = [(20, good, "en", "a", 1, "x"), (20, good, "de", "b", 2, "y"), (21, leak, "en", "a", 1, None), (22, twice, "en", None, None, "x"), (23, twice + " end", "en", "a", 1, "x"), (24, f"{prose(80)} ann.lee@mail.org", None, "a", 1, "x"), (None, prose(100), "en", "a", 1, "x"), (25, "too short", "en", "a", 1, "x")]
    docs = odd_docs.union(spark.createDataFrame(rows, odd_docs.schema)).withColumn("key", odd_docs["doc_id"]).withColumn("row", odd_docs["doc_id"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in out} == {5, 20, 22, 24, None}
    coder = Tokenizer.from_file(tokenizer_path())
    for i, text in ((20, good), (22, twice), (24, rows[5][1].replace("ann.lee@mail.org", "<email>"))):
        ids = [*coder.encode(text, add_special_tokens=False).ids, 0]
        (one,) = [x for x in out if x.doc_id == i]
        assert one.length == len(ids) and one.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    empty = tmp_path / "empty"
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


@pytest.mark.parametrize("name", ["op2_template_decontamination", "op4_best_fit_packing", "op6_url_filters", "op9_quality_rules"])
def test_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
