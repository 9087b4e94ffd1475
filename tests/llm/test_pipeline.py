"""The pipeline against plain Python, and the registered queries with SQL against DuckDB."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__
import corpus_pipeline
from ledgermill.llm import frames, queries
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, name, queries.QUERIES[name], queries.ORACLES[name]) == ""


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1


def test_stages_keep_what_they_should(spark):
    docs = frames.cut(spark.read.parquet(f"{SF}/documents.parquet"))
    first = docs
    for name, stage in corpus_pipeline.STAGES[1:4]:  # the classifier has tests of its own
        after = frames.cut(stage(spark, docs, SF))
        assert after.columns == docs.columns, name
        before = {r.doc_id: r for r in docs.collect()}
        kept = {r.doc_id: r for r in after.collect()}
        assert set(kept) <= set(before)
        if name == "n-gram Jaccard join":
            groups = {r.doc_id: r.component_id for r in corpus_pipeline.jaccard.near_duplicates(docs).collect()}
            assert set(kept) == {i for i, c in groups.items() if i == c}
        elif name == "benchmark decontamination":
            bad = corpus_pipeline.decontam.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert set(before) - set(kept) == {r.doc_id for r in bad.collect()}
        else:
            assert set(kept) == set(before)
        docs = after
    assert first.count() > docs.count() > 0


@pytest.mark.parametrize("name", ["n-gram Jaccard join", "benchmark decontamination"])
def test_rows_hold_when_files_are_packed_otherwise(spark, monkeypatch, name):
    """Between two jobs of a stage the files go to other partitions, as when executors are lost."""
    key, few = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(k, leak if k % 7 == 3 else f"document {k} of its own words {k * k} and {k + 5}", "en", "s", 1) for k in range(64)]
    docs = frames.cut(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(16))
    module, inner = (corpus_pipeline.jaccard, "near_duplicates") if "Jaccard" in name else (corpus_pipeline.decontam, "contaminated")
    found = getattr(module, inner)

    def then_packed_otherwise(*args, **kwargs):
        out = frames.cut(found(*args, **kwargs))
        spark.conf.set(key, "1m")
        return out

    monkeypatch.setattr(module, inner, then_packed_otherwise)
    try:
        kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)[name](spark, docs, SF).collect()}
    finally:
        spark.conf.set(key, few)
    assert kept == {k for k in range(64) if k % 7 != 3} | ({3} if "Jaccard" in name else set())


def test_empty_table_passes_through(spark):
    docs = frames.cut(spark.read.parquet(f"{SF}/documents.parquet").limit(0))
    for _, stage in corpus_pipeline.STAGES:
        docs = frames.cut(stage(spark, docs, SF))
    assert docs.count() == 0 and "sequence_id" in docs.columns
