"""The registered queries against their reference SQL, and the pipeline as a whole."""

import pytest
from compare import connect, differences

import corpus_pipeline
from tripmill.llm.common import table
from tripmill.llm.oracles import ORACLES
from tripmill.llm.queries import QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_reference_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


@pytest.mark.parametrize("name", QUERIES)
def test_every_row_of_the_table_is_answered(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    assert len(set(got.columns)) == len(got.columns)
    if name == "op3_language_id":
        assert got.count() == table(spark, sf_dir, "pages").count() + table(spark, sf_dir, "documents").count()
    elif name == "op8_embedding_near_dups":
        assert got.count() == table(spark, sf_dir, "embeddings").count()
    elif name == "op12_embedding_whitening":
        assert got.select("vec_id").distinct().count() == table(spark, sf_dir, "embeddings").count()
    elif name == "op13_html_extraction":
        assert got.count() == table(spark, sf_dir, "pages").count()
    elif name == "op7_best_fit_packing":
        assert got.select("doc_id").distinct().count() == table(spark, sf_dir, "documents").count()
    else:
        assert got.count() == table(spark, sf_dir, "documents").count()


def test_the_pipeline(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    given, before = docs.columns, {r.doc_id for r in docs.collect()}
    items = [r.text for r in table(spark, sf_dir, "benchmark").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id for r in docs.collect()}
        assert after <= before
        if name != "best_fit_packing":
            assert docs.columns == given
        if name == "benchmark_decontamination":
            assert not any(item in (r.text or "") for r in docs.collect() for item in items)
        if name in ("line_dedup", "best_fit_packing"):
            assert after == before
        before = after
    again = corpus_pipeline.run(spark, sf_dir)
    assert again.columns == docs.columns
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_accept_nulls_repeats_and_no_rows(spark, sf_dir, tmp_path):
    from helpers import documents

    rows = [(None, None), (None, "a"), (1, "a b c d e f"), (1, "a b c d e f"), (2, ""), (3, "x " * 3000), (3, "x " * 3000)]
    for label, data in (("rows", rows), ("none", [])):
        docs = documents(spark, data, clash=True)
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{label}{number}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() >= (5 if data else 0) and bool(data) == bool(docs.count())
