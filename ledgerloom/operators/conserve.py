"""Invariants checked as jobs: row conservation, dataset partition, fact and lineage bijection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_conservation(before: DataFrame, after: list[DataFrame], by: str) -> DataFrame:
    """Per ``by``: rows in, rows out over all outputs, and whether none was lost or made up."""
    outs = None
    for part in after:
        counted = part.groupBy(by).agg(F.count(F.lit(1)).alias("rows_out"))
        outs = counted if outs is None else outs.unionByName(counted)
    summed = outs.groupBy(by).agg(F.sum("rows_out").alias("rows_out"))
    ins = before.groupBy(by).agg(F.count(F.lit(1)).alias("rows_in"))
    joined = ins.join(summed, by, "full_outer")
    return joined.select(
        by, F.coalesce("rows_in", F.lit(0)).alias("rows_in"), F.coalesce("rows_out", F.lit(0)).alias("rows_out"),
        F.coalesce(F.col("rows_in") == F.col("rows_out"), F.lit(False)).alias("conserved"),
    )


def partition_problems(manifest: DataFrame, parts: dict[str, DataFrame], by: str) -> DataFrame:
    """Ids that break the partition of ``manifest``: in no part, in several, or in no manifest."""
    labelled = None
    for name, part in parts.items():
        ids = part.select(by).distinct().withColumn("_part", F.lit(name))
        labelled = ids if labelled is None else labelled.unionByName(ids)
    counts = labelled.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    listed = manifest.select(by).distinct().withColumn("_listed", F.lit(True))
    joined = listed.join(counts, by, "full_outer")
    problem = (
        F.when(F.col("_listed").isNull(), "not in manifest")
        .when(F.col("_n").isNull(), "in no part")
        .when(F.col("_n") > 1, "in several parts")
    )
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select(by, "problem")


def bijection_problems(facts: DataFrame, lineage: DataFrame, by: str = "fact_id") -> DataFrame:
    """Ids that are repeated on a side or exist on one side only."""
    left = facts.groupBy(by).agg(F.count(F.lit(1)).alias("_facts"))
    right = lineage.groupBy(by).agg(F.count(F.lit(1)).alias("_records"))
    joined = left.join(right, by, "full_outer")
    problem = (
        F.when(F.col("_records").isNull(), "no lineage")
        .when(F.col("_facts").isNull(), "no fact")
        .when(F.col("_facts") > 1, "repeated fact")
        .when(F.col("_records") > 1, "repeated record")
    )
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select(by, "problem")


def resource_status(wired: DataFrame, deferred: DataFrame, by: str = "resource_id") -> DataFrame:
    """``(resource, status, reason)`` of every resource; a deferral always has its reason."""
    ok = wired.select(by).distinct().select(by, F.lit("resolved").alias("status"), F.lit(None).cast("string").alias("deferred_reason"))
    held = deferred.select(by, F.lit("deferred").alias("status"), F.col("deferred_reason"))
    return ok.unionByName(held)


def all_conserved() -> Column:
    return F.bool_and("conserved")
