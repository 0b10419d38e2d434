"""Documents to packed training sequences: toxicity, quality, near-duplicates, packing.

A row travels through a filtering stage as one struct, so that columns of any name, also those that
an operator adds, come out as they went in. An empty table gives no rows in every stage; repeated
rows are judged each.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import minmax, packing, quality, toxicity
from ledgerloom.session import cut_lineage


def wrapped(docs: DataFrame, *beside: str) -> DataFrame:
    """``row`` with all columns of ``docs``, and copies of those named ``beside`` it."""
    return docs.select(F.struct("*").alias("row"), *beside)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model doesn't call toxic; those without a text stay."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(wrapped(docs, "text"), model).filter("NOT toxic").select("row.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule; those without a text have no words and go."""
    return quality.judge_quality(wrapped(docs, "text")).filter("failed_rule IS NULL").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the least doc_id, of each class of near-copies.

    Rows are told apart by a number of their own, saved with them so that retries agree; rows that
    repeat a doc_id and rows without one, which come last, are compared like all others.
    """
    rows = cut_lineage(wrapped(docs).withColumn("number", F.monotonically_increasing_id()), "rows")
    found = minmax.near_duplicates(rows.select("number", "row.text"), doc_id="number").select(F.col("doc_id").alias("number"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "number")).alias("first")
    kept = rows.select("number", "row.doc_id").join(found, "number").groupBy("component_id").agg(first).select("first.number")
    return rows.join(kept, "number", "left_semi").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there; other columns are dropped."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("quality", keep_quality), ("near-duplicates", drop_near_copies), ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: The stages fit a model and confirm links, which SQL doesn't express.
ORACLE_SQL = None
