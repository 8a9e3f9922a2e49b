import os

import pytest

import corpus_pipeline
from gridspark.llm import queries
from gridspark.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages_in_a_row(spark, tmp_path):
    docs = table(spark, SF, "documents")
    schema = docs.columns
    seen = {r.doc_id for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= seen and len(ids) > 0.5 * len(seen), name
        if i < 4:
            assert docs.columns == schema, name
            assert docs.count() == len(ids)
        elif i == 4:
            assert ids == seen
        seen = ids


def test_toxic_and_contaminated_documents_go(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    kept = corpus_pipeline.toxicity(spark, docs, SF)
    clean = labels.where("toxic = 0").join(docs, "doc_id")
    assert kept.join(clean.select("doc_id"), "doc_id").count() >= 0.97 * clean.count()
    bench = table(spark, SF, "benchmark").collect()
    rest = corpus_pipeline.decontaminate(spark, docs, SF).collect()
    assert not any(b.text in r.text for b in bench for r in rest)


def test_pipeline_on_awkward_documents(spark, tmp_path):
    from .corpus import awkward

    rows = [(i, t, "en", "s", 0) for i, t in awkward()]
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0


def test_registered_names():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(queries.oracle_sql()) <= set(names)
