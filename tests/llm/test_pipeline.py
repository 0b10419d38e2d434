"""The pipeline's stages against their own rules, and the registered SQL."""

from __future__ import annotations

import pytest
from compare import compare
from helpers import SF, empty_documents, odd_documents
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    assert compare(spark, SF, name, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_registration():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and len(queries.QUERIES) == 13


def test_stages_keep_columns_and_remove_what_they_reject(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == columns
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in before.select("doc_id").collect()} and 0 < len(ids) < before.count(), name
        before = docs.filter(docs["doc_id"].isin(list(ids)))
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
    assert packed == ids


def test_stages_on_odd_and_empty_tables(spark):
    for docs in (odd_documents(spark), empty_documents(spark)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), SF).collect()


def test_stages_leave_columns_of_the_operators_names_alone(spark):
    """Columns that the operators add, or that the stages use, come out as they went in."""
    names = ["failed_rule", "toxic", "expected_severity", "toxic_probability", "row", "_row", "number", "component_id", "kept"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    docs = docs.select("*", *[F.concat(F.lit(n), F.lit("-"), F.col("doc_id")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.schema.names == docs.schema.names and after.count() > 0, name
        assert after.filter(" OR ".join(f"NOT ({n} <=> concat('{n}-', doc_id))" for n in names)).count() == 0, name


def test_near_copies_of_repeated_rows_and_null_ids(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcd")
    rows = [(3, a), (1, a), (1, a), (None, a), (None, a + " more"), (None, b), (None, b), (5, c), (5, d), (5, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, a), (None, b), (5, c), (5, d)], key=str)
