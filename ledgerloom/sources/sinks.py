"""Deterministic sinks: sorted CSV, JSON lines and Parquet.

``ordered`` range-partitions the rows by the sort columns, so a large table is written by many
tasks into files whose names follow the order; ``single_file`` asks for one file and is meant for
the published (small) tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import plain_number
from ledgerloom.session import cut_lineage

#: ``monotonically_increasing_id`` keeps the partition above these bits and the place below them.
PLACE_BITS = 33


def _sort_text(df: DataFrame, name: str) -> Column:
    return F.coalesce(cell_text(df, name), F.lit(""))


def cell_text(df: DataFrame, name: str) -> Column:
    """A cell as printed: decimals in plain notation, null left null (it prints empty)."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return plain_number(F.col(name))
    return F.col(name).cast("string")


def ordered(df: DataFrame, sort_by: list[str], single_file: bool = False) -> DataFrame:
    keys = [_sort_text(df, name) for name in sort_by]
    if single_file:
        return df.coalesce(1).sortWithinPartitions(*keys)
    return df.orderBy(*keys)


def numbered(df: DataFrame, sort_by: list[str], name: str = "position") -> DataFrame:
    """``df`` with the place of each row in the order of ``sort_by``, from 0; nulls sort as empty text.

    The rows are saved range-partitioned and sorted, each with its place within its partition. What
    lies before a partition is a prefix sum over one row a partition, so no task sees all rows. Rows
    with equal keys have neighbouring places in any order.
    """
    keys = [_sort_text(df, column) for column in sort_by]
    saved = cut_lineage(df.orderBy(*keys).withColumn("_place", F.monotonically_increasing_id()), "ordered")
    saved = saved.withColumn("_part", F.shiftright("_place", PLACE_BITS))
    sizes = saved.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_start"))
    place = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return saved.join(starts, "_part").select(*df.columns, place.alias(name))


def write_csv(df: DataFrame, path: str, columns: list[str], sort_by: list[str], single_file: bool = False) -> None:
    """Fixed column order, line feeds, null as an empty cell and never as zero."""
    rows = ordered(df, sort_by, single_file)
    out = rows.select(*[cell_text(df, name).alias(name) for name in columns])
    out.write.option("header", True).option("nullValue", "").option("emptyValue", "").option("lineSep", "\n").option(
        "escape", '"'
    ).csv(path)


def write_records(df: DataFrame, path: str, sort_by: str = "fact_id", single_file: bool = False) -> None:
    """One JSON object per line, null fields kept."""
    rows = ordered(df, [sort_by], single_file)
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    rows.select(line.alias("value")).write.option("lineSep", "\n").text(path)


def write_parquet(df: DataFrame, path: str, columns: list[str], sort_by: list[str], single_file: bool = False) -> None:
    """``value`` as DOUBLE, counts as BIGINT, everything else as text, zstd."""
    rows = ordered(df, sort_by, single_file)
    typed = []
    for name in columns:
        kind = "double" if name == "value" else "bigint" if name.endswith("_count") else "string"
        typed.append(F.col(name).cast(kind).alias(name))
    rows.select(*typed).write.option("compression", "zstd").parquet(path)
