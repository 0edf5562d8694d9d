"""The pipeline against its stages by hand, and the registered queries."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from convoy.llm import queries
from tests.llm.test_duplicates import exact_by_hand, near_by_hand
from tests.llm.test_texts import contamination_by_hand


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Tables of a folder with some hundred documents, a few of them awkward."""
    folder = tmp_path_factory.mktemp("small")
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    awkward = [(90001, None), (90002, ""), (None, "no id at all"), (90003, "twice the same row"), (90003, "twice the same row")]
    docs = docs.unionByName(spark.createDataFrame(awkward, "doc_id long, text string"), allowMissingColumns=True)
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pipeline_stage_by_stage(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact dedup", "near dedup", "decontamination", "tokens"]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, small).cache()
    assert good.columns == docs.columns
    labels = spark.read.parquet(f"{small}/labels.parquet")
    assert good.join(labels, "doc_id").filter("quality = 0").count() <= 0.1 * labels.filter("quality = 0").count()
    assert good.join(labels, "doc_id").filter("quality = 1").count() >= 0.9 * docs.join(labels, "doc_id").filter("quality = 1").count()

    def rows(df):
        return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    exact = stages["exact dedup"](spark, good, small).cache()
    want = {r[0] for r in exact_by_hand(rows(good)) if r[3]}
    assert sorted(map(str, want)) == sorted(str(i) for i, _ in rows(exact)) and exact.columns == docs.columns
    near = stages["near dedup"](spark, exact, small).cache()
    want = {r[0] for r in near_by_hand(rows(exact)) if r[3]}
    assert sorted(map(str, want)) == sorted(str(i) for i, _ in rows(near)) and near.columns == docs.columns
    clean = stages["decontamination"](spark, near, small).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = {r[0] for r in contamination_by_hand(rows(near), items) if not r[5]}
    assert want == {i for i, _ in rows(clean)} and clean.columns == docs.columns
    last = corpus_pipeline.run(spark, small).select("doc_id", "n_tokens", F.size("ids").alias("n")).collect()
    assert {r.doc_id for r in last} == want
    assert all(r.n == r.n_tokens for r in last)


def test_rows_of_one_id_are_told_apart_by_their_texts(spark, small):
    """One text of id 7 is a near copy of document 3 and goes, the other stays."""
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(3, base), (7, base + " more"), (7, "quite another text of the same id"), (None, base + " yet"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("lang", "source", "carried", "component", "kept", "bucket", "node")}
    )
    kept = dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, small)
    assert kept.columns == docs.columns
    got = {(r.doc_id, r.text) for r in kept.collect()}
    assert got == {(3, base), (7, "quite another text of the same id"), (9, None)}


def test_pipeline_of_empty_tables(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_query_for_each_operator():
    found = [re.match(r"op(\d+)_", n) for n in queries.QUERIES]
    assert sorted(int(m[1]) for m in found if m) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_native_query_has_no_python(spark):
    plan = queries.QUERIES["op7_block_naming"](spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)
