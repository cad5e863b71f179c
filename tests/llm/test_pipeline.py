from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quietwire.llm import queries
from quietwire.session import stage

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, apply in corpus_pipeline.STAGES:
        out.append(stage(apply(spark, out[-1], FOLDER), "test-stage"))
    return out


def test_order_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "repeated passages", "mixing", "packing"]
    assert [s.columns for s in stages[1:-1]] == [COLUMNS] * 4


def test_filters_keep_what_is_clean(spark, stages):
    raw, civil, single, cut = stages[:4]
    scores = {r.doc_id: r.predicted for r in queries.op1_toxicity(spark, FOLDER).collect()}
    assert {r.doc_id for r in civil.select("doc_id").collect()} == {i for i, p in scores.items() if not p}
    from test_ngram_join import brute

    rows = [(r.doc_id, r.text) for r in civil.select("doc_id", "text").collect()]
    assert {r.doc_id for r in single.select("doc_id").collect()} == {i for i, n, c in brute(rows) if c == i}
    assert cut.count() == single.count()
    assert cut.where(F.length("text") > F.col("n_chars")).isEmpty()


def test_mixture_and_packing(stages):
    cut, mixed, packed = stages[3:]
    texts = {r.doc_id: r.text for r in cut.select("doc_id", "text").collect()}
    times = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert set(times) <= set(texts) and max(times.values()) <= 3
    assert mixed.count() > 0.5 * cut.count()
    pieces = packed.where("piece = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in pieces} == times


def test_run_gives_the_same(spark, stages):
    assert corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "ids_crc32").exceptAll(stages[-1].select("doc_id", "piece", "ids_crc32")).isEmpty()


def test_every_query_is_registered():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
