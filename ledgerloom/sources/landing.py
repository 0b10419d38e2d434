"""Landing: every delivered row ends up landed or quarantined with a typed reason, never lost.

A landed table has ``row_index``, ``raw`` (the row as delivered, JSON text) and ``cells``, a map
from column name to ``struct(v, t)``: the cell as text and the type it was delivered with. Nothing
is cast here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MALFORMED = "malformed_row"
EMPTY = "empty_row"
SYNTHETIC_TOTAL = "synthetic_total_row"
FULL, PARTIAL = "full", "partial"


@dataclass(frozen=True)
class TotalRow:
    """The roll-up row a publisher adds to its table: ``column`` reads ``label``."""

    column: str
    label: str = "Total"


def _delivered_type(variant_type: Column) -> Column:
    return (
        F.when(variant_type == "STRING", "str")
        .when(variant_type == "BOOLEAN", "bool")
        .when(variant_type.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
        .when(variant_type == "VOID", "null")
        .when(variant_type.startswith("OBJECT") | variant_type.startswith("ARRAY"), "nested")
        .when(variant_type.endswith(",0)"), "int")
        .otherwise("float")
    )


def classify_rows(rows: DataFrame, total: TotalRow | None = None) -> DataFrame:
    """``rows(row_index, raw, …)`` plus ``cells`` and ``reason`` (null where the row lands).

    The tests apply in this order: no mapping, empty mapping, synthetic total, nested cell. The row
    is parsed inside a generator, so a later filter on ``reason`` cannot move below it and parse
    every row a second time.
    """
    cells = F.transform_values(
        F.expr("from_json(raw, 'map<string,variant>')"),
        lambda _, v: F.struct(v.cast("string").alias("v"), _delivered_type(F.schema_of_variant(v)).alias("t")),
    )
    df = rows.select("*", F.inline(F.array(F.struct(cells.alias("cells")))))
    nested = F.exists(F.map_values("cells"), lambda c: c["t"] == "nested")
    reason = F.when(F.col("cells").isNull(), MALFORMED).when(F.size("cells") == 0, EMPTY)
    if total is not None:
        cell = F.try_element_at("cells", F.lit(total.column))
        reason = reason.when((cell["t"] == "str") & (cell["v"] == total.label), SYNTHETIC_TOTAL)
    return df.withColumn("reason", reason.when(nested, MALFORMED))


def landed(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason").isNull()).drop("reason")


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason").isNotNull()).drop("cells")


def observed_columns(rows: DataFrame, group: tuple[str, ...] = ()) -> DataFrame:
    """The union of row keys with their first-seen place, one row per column name.

    ``first_seen`` orders by (row, place in row). Partial aggregation on the map side keeps the
    shuffle at one row per task and name.
    """
    exploded = rows.select(
        *group, "row_index", F.posexplode(F.expr("json_object_keys(raw)")).alias("_pos", "column_name")
    )
    return exploded.groupBy(*group, "column_name").agg(
        F.min(F.struct("row_index", "_pos")).alias("first_seen")
    )


def schema_fingerprint(columns: DataFrame, group: tuple[str, ...] = ()) -> DataFrame:
    """Order-insensitive fingerprint of a column set, one row per group."""
    return columns.groupBy(*group).agg(fingerprint_of(F.collect_set("column_name")).alias("schema_version"))


def fingerprint_of(names: Column) -> Column:
    """The fingerprint of an array of column names."""
    ordered = F.array_sort(F.array_distinct(names))
    return F.concat(F.lit("sha256:"), F.sha2(F.array_join(ordered, "\n"), 256))


def with_provenance(
    df: DataFrame,
    source_id: str,
    resource_id: str | Column,
    source_grain: str,
    completeness: str = PARTIAL,
    source_as_of: Column | None = None,
) -> DataFrame:
    """Stamp the batch's provenance; an untagged pull counts as partial."""
    if completeness not in (FULL, PARTIAL):
        raise ValueError(f"completeness must be {FULL} or {PARTIAL}: {completeness!r}")
    as_of = source_as_of if source_as_of is not None else F.lit(None).cast("timestamp")
    resource = F.lit(resource_id) if isinstance(resource_id, str) else resource_id
    return (
        df.withColumn("source_id", F.lit(source_id))
        .withColumn("resource_id", resource)
        .withColumn("source_grain", F.lit(source_grain))
        .withColumn("pull_completeness", F.lit(completeness))
        .withColumn("source_as_of", as_of)
    )


def cell_value(name: str) -> Column:
    return F.try_element_at("cells", F.lit(name))["v"]


def cell_type(name: str) -> Column:
    return F.coalesce(F.try_element_at("cells", F.lit(name))["t"], F.lit("null"))


def as_columns(landed_rows: DataFrame, names: list[str], keep: tuple[str, ...] = ("row_index",)) -> DataFrame:
    """Landed cells as text columns; a column absent from a row is null, never zero."""
    return landed_rows.select(*keep, *[cell_value(n).alias(n) for n in names])
