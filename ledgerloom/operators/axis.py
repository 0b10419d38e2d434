"""The axis of financial years: gaps kept as slots, runs of withheld years, local minima.

A series has one row per key and year, so the windows below hold as many rows as there are years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.periods import fy_label, fy_start


def fill_years(points: DataFrame, keys: list[str]) -> DataFrame:
    """Every year from the first to the last point of a key; a missing year has a null value."""
    start = fy_start(F.col("fin_year"))
    span = points.groupBy(*keys).agg(F.min(start).alias("_from"), F.max(start).alias("_to"))
    axis = span.select(*keys, F.explode(F.sequence("_from", "_to")).alias("_year"))
    axis = axis.withColumn("fin_year", fy_label(F.col("_year"))).drop("_year")
    return axis.join(points.select(*keys, "fin_year", "value"), [*keys, "fin_year"], "left")


def withheld_spans(series: DataFrame, keys: list[str]) -> DataFrame:
    """Maximal runs of years without a value: first year, last year and length."""
    order = Window.partitionBy(*keys).orderBy("fin_year")
    numbered = series.withColumn("_place", F.row_number().over(order)).filter(F.col("value").isNull())
    # Within a run the place and the rank among gaps rise together, so their difference names it.
    islands = numbered.withColumn("_run", F.col("_place") - F.row_number().over(order))
    return islands.groupBy(*keys, "_run").agg(
        F.min("fin_year").alias("from_year"), F.max("fin_year").alias("to_year"), F.count(F.lit(1)).alias("years")
    ).drop("_run")


def local_minima(series: DataFrame, keys: list[str]) -> DataFrame:
    """Points below every neighbouring year that has a value, with at least one such neighbour."""
    order = Window.partitionBy(*keys).orderBy("fin_year")
    before, after = F.lag("value").over(order), F.lead("value").over(order)
    df = series.withColumn("_before", before).withColumn("_after", after)
    value = F.col("value")
    lower = (F.coalesce(value < F.col("_before"), F.lit(True))) & (F.coalesce(value < F.col("_after"), F.lit(True)))
    some = F.col("_before").isNotNull() | F.col("_after").isNotNull()
    return df.filter(value.isNotNull() & some & lower).drop("_before", "_after")
