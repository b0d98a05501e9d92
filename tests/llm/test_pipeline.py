import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, simhash
from millrace.session import store


@pytest.fixture(scope="module")
def stages(spark, sf):
    """(name, input, output) of each stage over the given documents."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in cp.STAGES:
        given, docs = docs, store(stage(spark, docs, sf), "stage")
        out.append((name, given, docs))
    return out


def test_columns_and_subsets(stages):
    for name, given, kept in stages[:-1]:
        assert kept.columns == given.columns, name
        assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in given.collect()}


def test_near_duplicates_stage(stages):
    _, given, kept = stages[2]
    texts = {r.doc_id: simhash.fingerprint_of(r.text) for r in given.collect()}
    left = sorted(r.doc_id for r in kept.collect())
    ids, groups = sorted(texts), []
    for i in ids:
        near = [g for g in groups if any((texts[i] ^ texts[j]).bit_count() <= 3 for j in g)]
        groups = [g for g in groups if g not in near] + [[i, *(j for g in near for j in g)]]
    assert left == sorted(min(g) for g in groups)


def test_decontamination_stage(spark, sf, stages):
    _, given, kept = stages[3]
    items = decontaminate.Items([tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()], 0.8)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in given.collect() if not items.search(r.text))


def test_packing_stage(stages):
    _, given, packed = stages[4]
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in given.collect()}
    done = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all"))
    assert done.where("n <> all").isEmpty()


def test_line_stage_keeps_documents(stages):
    _, given, kept = stages[1]
    assert given.count() == kept.count()
    assert kept.where("n_chars <> char_length(text)").isEmpty()


def test_odd_documents(spark, sf, odd_docs, no_docs):
    for name, stage in cp.STAGES:
        some = stage(spark, odd_docs, sf)
        assert some.count() > 0 or name == "quality rules"
        assert stage(spark, no_docs, sf).count() == 0
        if name != "packing":
            assert some.columns == odd_docs.columns
