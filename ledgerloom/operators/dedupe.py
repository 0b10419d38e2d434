"""Snapshot dedupe: one whole row per grain key, the latest by (as-of, row index).

The winner comes from ``max_by`` under a partial aggregation, so copies of a hot key are dropped on
the map side and no task sees the whole group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIE_BREAK_RULE = "R2-DEDUP-TB-01"
MISSING_GRAIN_KEY = "missing_grain_key"


def lacks_key(keys: list[str]) -> Column:
    """All key columns null; a partial key is a key."""
    return reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])


def without_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.filter(lacks_key(keys)).withColumn("reason", F.lit(MISSING_GRAIN_KEY))


def survivors(df: DataFrame, keys: list[str], as_of: str | None = None, row_index: str = "row_index") -> DataFrame:
    """The winning rows, whole, plus ``copies`` (rows of the key); keys compare null-safe."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*([F.col(as_of)] if as_of else []), F.col(row_index))
    best = (
        df.filter(~lacks_key(keys))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), rank).alias("_row"), F.count(F.lit(1)).alias("copies"))
    )
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns], "copies")


def collapsed(df: DataFrame, kept: DataFrame, keys: list[str], row_index: str = "row_index") -> DataFrame:
    """The rows that lost, one per row (their list is as long as the data, so it stays a table)."""
    return df.filter(~lacks_key(keys)).join(kept.select(row_index), row_index, "left_anti")


def summary(kept: DataFrame) -> DataFrame:
    """One row, also over no input: how many rows were collapsed, and by which tie-break."""
    return kept.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicates_collapsed"),
        F.count(F.lit(1)).alias("survivors"),
    ).withColumn("tie_break_rule_id", F.lit(TIE_BREAK_RULE))
