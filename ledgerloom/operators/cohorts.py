"""Counts and series over the served facts: named filters, figures, cohorts, net changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WAGE_FLOOR = 1000


def _confidence(state: str) -> Column:
    return F.col("confidence") == state


def named_filters() -> dict[str, Column]:
    """Every selection a count may use, by name; a count by an unnamed predicate is not replayable."""
    return {
        "all": F.lit(True),
        "value_is_null": F.col("value").isNull(),
        "confidence == flagged-disagreement": _confidence("flagged-disagreement"),
        "confidence == partial-period-only": _confidence("partial-period-only"),
        "confidence == unadjudicated": _confidence("unadjudicated"),
        "confidence == single-publisher divergence": _confidence("single-publisher divergence"),
        "era_basis == historical": F.col("era_basis") == "historical",
        "era_basis == flagship-rollup": F.col("era_basis") == "flagship-rollup",
        "value > 1000 (implausible as a daily wage)": F.col("value") > WAGE_FLOOR,
    }


def select(facts: DataFrame, name: str) -> DataFrame:
    """The facts a named filter selects; an unknown name is an error, never an empty result."""
    filters = named_filters()
    if name not in filters:
        raise ValueError(f"unknown filter {name!r}; known: {sorted(filters)}")
    return facts.filter(F.coalesce(filters[name], F.lit(False)))


def filter_counts(facts: DataFrame) -> DataFrame:
    """``(filter, facts)`` for every named filter, from one pass over the facts."""
    filters = named_filters()
    names = list(filters)
    counts = facts.agg(*[F.count_if(F.coalesce(filters[n], F.lit(False))).alias(f"c{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("filter_name"), F.col(f"c{i}").alias("facts")) for i, n in enumerate(names)])
    return counts.select(F.inline(pairs))


def members(facts: DataFrame, name: str, cohort_id: str) -> DataFrame:
    """``(cohort_id, fact_id)``, one row per member; the count is the number of rows."""
    return select(facts, name).select(F.lit(cohort_id).alias("cohort_id"), "fact_id")


def member_counts(membership: DataFrame) -> DataFrame:
    return membership.groupBy("cohort_id").agg(F.count(F.lit(1)).alias("value"))


def distinct_sources(membership: DataFrame, sources: DataFrame) -> DataFrame:
    """The distinct (source, resource, as-of) behind a cohort, with the first place each was seen."""
    return (
        sources.join(membership, "fact_id")
        .groupBy("cohort_id", "source_id", "resource_id", "source_as_of")
        .agg(F.min(F.struct("fact_id", "seq")).alias("first_seen"))
    )


def figures(requests: DataFrame, facts: DataFrame, sources: DataFrame) -> DataFrame:
    """``requests(figure_id, fact filters…)`` joined to its one non-null fact with its lineage.

    The join columns are those ``requests`` shares with ``facts``. ``problem`` says why a request
    has no figure: no row, several rows, a null value, or no lineage.
    """
    shared = [c for c in requests.columns if c in facts.columns]
    found = requests.join(facts.withColumn("_hit", F.lit(1)), shared, "left")
    one = found.groupBy("figure_id").agg(
        F.count("_hit").alias("_rows"),
        F.min("value").alias("value"), F.min("unit").alias("unit"), F.min("fact_id").alias("fact_id"),
    )
    behind = sources.groupBy("fact_id").agg(F.count(F.lit(1)).alias("source_count"))
    problem = (
        F.when(F.col("_rows") == 0, "no row")
        .when(F.col("_rows") > 1, "several rows")
        .when(F.col("value").isNull(), "null value")
        .when(F.col("source_count").isNull(), "no lineage")
    )
    out = one.join(behind, "fact_id", "left").withColumn("problem", problem)
    good = F.col("problem").isNull()
    return out.select(
        "figure_id", F.when(good, F.col("value")).alias("value"), F.when(good, F.col("unit")).alias("unit"),
        F.when(good, F.col("fact_id")).alias("fact_id"), F.when(good, F.col("source_count")).alias("source_count"), "problem",
    )


def series_points(
    facts: DataFrame, metric: str, incomplete_year: str | None = None, scale: Column | None = None, keys: tuple[str, ...] = ()
) -> DataFrame:
    """The points of a series: nulls are gaps and left out, the incomplete year too."""
    kept = facts.filter((F.col("metric") == metric) & F.col("value").isNotNull())
    if incomplete_year is not None:
        kept = kept.filter(F.col("fin_year") != incomplete_year)
    value = F.col("value") if scale is None else F.col("value") / scale
    return kept.select(*keys, "fin_year", value.alias("value"), "fact_id")


def counts_per_period(facts: DataFrame, axis: DataFrame, name: str = "all", by: str = "fin_year") -> DataFrame:
    """Facts a named filter selects, per entry of ``axis``; an entry without any counts zero."""
    counted = select(facts, name).groupBy(by).agg(F.count(F.lit(1)).alias("facts"))
    return axis.join(counted, by, "left").select(by, F.coalesce("facts", F.lit(0)).cast("bigint").alias("facts"))


def net_change(facts: DataFrame, first: str, later: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Reporting facts in two periods and the difference: additions minus those that stopped."""
    a, b = F.count_if(F.col("fin_year") == first), F.count_if(F.col("fin_year") == later)
    return facts.groupBy(*by).agg(a.alias("first_count"), b.alias("later_count"), (b - a).alias("net_change"))


def residual(parents: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
    """Parent value minus the sum of its children, per key; zero when the drill-down adds up."""
    summed = children.groupBy(*keys).agg(F.sum("value").alias("children_sum"), F.count("value").alias("children"))
    joined = parents.filter(F.col("value").isNotNull()).select(*keys, F.col("value").alias("parent_value")).join(summed, keys, "left")
    return joined.withColumn("residual", F.col("parent_value") - F.coalesce("children_sum", F.lit(0)))
