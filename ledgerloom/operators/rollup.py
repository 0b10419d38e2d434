"""Cumulative readings to period-final values and their sums up the geography.

Every step is a ``groupBy`` with mergeable aggregates, so copies of a hot district or state are
combined on the map side before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import MONEY, percent_gap, within_permille
from ledgerloom.functions.periods import fy_position

MARCH = "03"
SUM_TYPE = "decimal(38,12)"


@dataclass(frozen=True)
class Readings:
    """The columns of a monthly year-to-date table."""

    state: str = "state_code"
    district: str = "district_code"
    fin_year: str = "fin_year"
    month: str = "month"
    row_index: str = "row_index"

    @property
    def unit_year(self) -> list[str]:
        return [self.state, self.district, self.fin_year]

    def usable(self) -> Column:
        """Rows with a place and a period; an unknown month still counts as seen."""
        named = [F.col(c).isNotNull() for c in (self.state, self.district, self.fin_year, self.month)]
        return named[0] & named[1] & named[2] & named[3]


def final_value(value: Column, month: Column, row_index: Column) -> Column:
    """Aggregate: the value at the latest month of the financial year, never a sum.

    Of several rows for one month the later one counts. Null values and unknown months are ignored.
    """
    position = fy_position(month)
    rank = F.when(value.isNotNull() & position.isNotNull(), F.struct(position, row_index))
    return F.max_by(value, rank)


def unit_finals(df: DataFrame, columns: list[str], layout: Readings = Readings()) -> DataFrame:
    """Per (state, district, year): the final of every column, and ``_seen_`` flags.

    ``_seen_<column>`` tells that the unit reported the column at all in that year.
    """
    month, place = F.col(layout.month), F.col(layout.row_index)
    aggs = []
    for name in columns:
        aggs.append(final_value(F.col(name).cast(MONEY), month, place).alias(name))
        aggs.append(F.max(F.col(name).isNotNull()).alias(f"_seen_{name}"))
    return df.filter(layout.usable()).groupBy(*layout.unit_year).agg(*aggs)


def authority_counts(districts: DataFrame) -> DataFrame:
    """Units per state in the authority list."""
    return districts.groupBy("state_code").agg(F.count(F.lit(1)).cast("int").alias("units_in_authority"))


def _coverage(finals: DataFrame, seen: Column, layout: Readings, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``totals`` plus the coverage struct: units summed, the source's own universe, the authority's.

    The universe is counted over the reduced table (one row per unit and year), in two grouped
    steps, and joined by state: as many rows as there are states.
    """
    universe = (
        finals.filter(seen)
        .groupBy(layout.state, layout.district)
        .agg(F.lit(1).alias("_one"))
        .groupBy(layout.state)
        .agg(F.count(F.lit(1)).cast("int").alias("_universe"))
    )
    known = counts.withColumnRenamed("state_code", layout.state) if layout.state != "state_code" else counts
    joined = totals.join(universe, layout.state, "left").join(known, layout.state, "left")
    return joined.withColumn(
        "coverage",
        F.struct(
            F.col("units_summed").cast("int").alias("units_summed"),
            F.col("_universe").alias("units_in_source_universe"),
            F.coalesce("units_in_authority", F.lit(0)).alias("units_in_authority"),
        ),
    ).drop("_universe", "units_in_authority", "units_summed")


def coverage_status(coverage: Column) -> Column:
    return (
        F.when(coverage["units_in_source_universe"] < coverage["units_in_authority"], "structural_gap")
        .when(coverage["units_summed"] < coverage["units_in_source_universe"], "year_gap")
        .when(coverage.isNotNull(), "complete")
    )


def state_annual(finals: DataFrame, column: str, counts: DataFrame, layout: Readings = Readings()) -> DataFrame:
    """Per (state, year): the sum of the units' finals with its coverage; none without a unit."""
    totals = (
        finals.groupBy(layout.state, layout.fin_year)
        .agg(F.sum(column).cast(SUM_TYPE).alias("value"), F.count(column).alias("units_summed"))
        .filter(F.col("units_summed") > 0)
    )
    return _coverage(finals, F.col(f"_seen_{column}"), layout, counts, totals)


def state_annual_total(
    finals: DataFrame,
    components: tuple[str, ...],
    stated: str,
    counts: DataFrame,
    tolerance_permille: int = 5,
    layout: Readings = Readings(),
) -> DataFrame:
    """Per (state, year): the total derived from its components, checked against the stated one.

    A missing component counts as zero. A gap beyond the tolerance becomes ``discrepancy``; the
    derived value stays. A state-year is emitted even when no final contributed.
    """
    columns = [*components, stated]
    seen = F.greatest(*[F.col(f"_seen_{c}") for c in columns])
    contributed = F.coalesce(*[F.col(c) for c in columns]).isNotNull()
    zero = F.lit(0).cast(MONEY)
    derived = sum((F.coalesce(F.col(c), zero) for c in components[1:]), F.coalesce(F.col(components[0]), zero))
    totals = (
        finals.filter(seen)
        .groupBy(layout.state, layout.fin_year)
        .agg(
            F.sum(derived).cast(MONEY).alias("value"),
            F.sum(stated).cast(MONEY).alias("_stated"),
            F.count_if(contributed).alias("units_summed"),
        )
    )
    gap = F.expr(f"_stated IS NOT NULL AND NOT {within_permille('value', '_stated', f'{tolerance_permille}BD')}")
    flagged = totals.withColumn(
        "discrepancy",
        F.when(
            gap,
            F.struct(
                F.col("value").alias("derived"),
                F.col("_stated").alias("source_provided"),
                percent_gap(F.col("value"), F.col("_stated")).alias("pct"),
                F.lit("R4-DEF-01").alias("rule_id"),
            ),
        ),
    ).drop("_stated")
    return _coverage(finals, seen, layout, counts, flagged)


def unit_annual(
    finals: DataFrame, direct: dict[str, str], total_metric: str, components: tuple[str, ...], layout: Readings = Readings()
) -> DataFrame:
    """Per (state, district, year, metric): the direct finals and the total of the components.

    The total exists where any component does; a missing one counts as zero.
    """
    zero = F.lit(0).cast(MONEY)
    total = F.when(
        F.coalesce(*[F.col(c) for c in components]).isNotNull(),
        sum((F.coalesce(F.col(c), zero) for c in components[1:]), F.coalesce(F.col(components[0]), zero)),
    ).cast(MONEY)
    wide = finals.select(
        *layout.unit_year,
        *[F.col(column).cast(MONEY).alias(metric) for metric, column in direct.items()],
        total.alias(total_metric),
    )
    return wide.unpivot(layout.unit_year, [*direct, total_metric], "metric", "value").filter(F.col("value").isNotNull())


def complete_year_ratio(df: DataFrame, ratio: str, denominator: str, layout: Readings = Readings()) -> DataFrame:
    """Per (state, district, year): the ratio of the final month, for complete years only.

    The final month is the last with both numbers. It has to be March and the denominator non-zero;
    otherwise the year has no ratio. A ratio is never summed upward.
    """
    value, base = F.col(ratio).cast(MONEY), F.col(denominator).cast(MONEY)
    both = value.isNotNull() & base.isNotNull()
    position = fy_position(F.col(layout.month))
    rank = F.when(both & position.isNotNull(), F.struct(position, F.col(layout.row_index)))
    last = F.max_by(F.struct(value.alias("value"), base.alias("base"), F.col(layout.month).alias("month")), rank)
    return (
        df.filter(layout.usable())
        .groupBy(*layout.unit_year)
        .agg(last.alias("_last"))
        .filter((F.col("_last.month") == MARCH) & (F.col("_last.base") != 0))
        .select(*layout.unit_year, F.col("_last.value").alias("value"))
    )


def national(observations: DataFrame, source_id: str, authority_rank: int, resource_id: str | None = None) -> DataFrame:
    """Per (year, metric): the sum over the states that report; coverage is not passed on.

    Only state rows count. As-of and unit come from the first reporting state in ``seq`` order.
    """
    null = F.lit(None).cast("string")
    dated = F.when(F.col("source_as_of").isNotNull(), F.col("seq"))
    return (
        observations.filter(F.col("geo_level") == "state")
        .groupBy("scheme", "fin_year", "metric")
        .agg(
            F.sum("value").cast(MONEY).alias("value"),
            F.min_by("original_unit", "seq").alias("original_unit"),
            F.min_by("source_as_of", dated).alias("source_as_of"),
            F.min("seq").alias("seq"),
        )
        .select(
            "scheme", F.lit("national").alias("geo_level"), null.alias("state_code"), null.alias("district_code"),
            "fin_year", null.alias("month"), "metric", "seq", F.lit(source_id).alias("source_id"),
            F.lit(resource_id).cast("string").alias("resource_id"), "value", "original_unit", "source_as_of",
            F.lit(authority_rank).alias("authority_rank"),
        )
    )
