"""Queries over year-to-date readings: finals, coverage, totals, ratios, national sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import cohorts, rollup
from ledgerloom.plans.inputs import AUTHORITY, MONTHLY, authority_districts, fyl, monthly
from ledgerloom.plans.registry import query

COLUMNS = ["cq", "cp", "ct", "cd", "stated"]
COMPONENTS = ("cp", "ct", "cd")

FINALS = f"""{MONTHLY}, finals AS (
  SELECT nk, sk, fy, {', '.join(f"ARG_MAX({c}, pos * 1000000000000 + row_index) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in COLUMNS)},
  BOOL_OR(cq IS NOT NULL) AS saw_q FROM monthly GROUP BY 1, 2, 3)"""

COUNTS = f"{AUTHORITY}, counts AS (SELECT state_code, COUNT(*) AS units FROM authority GROUP BY 1)"
STATUS = """CASE WHEN {u} < COALESCE(units, 0) THEN 'structural_gap' WHEN {s} < {u} THEN 'year_gap' ELSE 'complete' END"""


def finals(spark: SparkSession, sf_dir: str, columns: list[str] = COLUMNS) -> DataFrame:
    return rollup.unit_finals(monthly(spark, sf_dir), columns)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.authority_counts(authority_districts(spark, sf_dir))


def whole(*names: str) -> list:
    return [F.col(n).cast("bigint").alias(n) for n in names]


@query(
    "period_finals",
    f"""WITH {FINALS} SELECT CAST(sk AS STRING) AS district_code, {fyl('fy')} AS fin_year, cq, cp, stated FROM finals""",
)
def period_finals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finals(spark, sf_dir, ["cq", "cp", "stated"]).select("district_code", "fin_year", *whole("cq", "cp", "stated"))


@query(
    "overcount_check",
    f"""WITH {FINALS}, naive AS (SELECT nk, fy, SUM(cq) AS s FROM monthly GROUP BY 1, 2), truth AS (SELECT nk, fy, SUM(cq) AS s FROM finals GROUP BY 1, 2)
    SELECT CAST(t.nk AS STRING) AS state_code, {fyl('t.fy')} AS fin_year, CAST(t.s AS BIGINT) AS final_sum, CAST(n.s AS BIGINT) AS naive_sum
    FROM truth t JOIN naive n ON t.nk = n.nk AND t.fy = n.fy""",
)
def overcount_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What summing cumulative months would give beside the sum of the finals, from one pass."""
    layout = rollup.Readings()
    units = (
        monthly(spark, sf_dir).filter(layout.usable()).groupBy(*layout.unit_year)
        .agg(rollup.final_value(F.col("cq"), F.col("month"), F.col("row_index")).alias("final"), F.sum("cq").alias("naive"))
    )
    return units.groupBy("state_code", "fin_year").agg(F.sum("final").alias("final_sum"), F.sum("naive").alias("naive_sum"))


@query(
    "rollup_coverage",
    f"""WITH {FINALS}, {COUNTS},
    uni AS (SELECT nk, COUNT(DISTINCT sk) AS u FROM finals WHERE saw_q GROUP BY 1),
    s AS (SELECT nk, fy, SUM(cq) AS v, COUNT(cq) AS n FROM finals GROUP BY 1, 2 HAVING COUNT(cq) > 0)
    SELECT CAST(s.nk AS STRING) AS state_code, {fyl('fy')} AS fin_year, CAST(v AS BIGINT) AS value, n AS units_summed, u AS units_in_source_universe,
    COALESCE(units, 0) AS units_in_authority, {STATUS.format(u='u', s='n')} AS status
    FROM s JOIN uni ON s.nk = uni.nk LEFT JOIN counts ON counts.state_code = CAST(s.nk AS STRING)""",
)
def rollup_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollup.state_annual(finals(spark, sf_dir, ["cq"]), "cq", counts(spark, sf_dir))
    return out.select(
        "state_code", "fin_year", *whole("value"), "coverage.*", rollup.coverage_status(F.col("coverage")).alias("status")
    )


@query(
    "derived_total_check",
    f"""WITH {FINALS}, s AS (SELECT nk, fy, SUM(COALESCE(cp, 0) + COALESCE(ct, 0) + COALESCE(cd, 0)) AS v, SUM(stated) AS st FROM finals GROUP BY 1, 2)
    SELECT CAST(nk AS STRING) AS state_code, {fyl('fy')} AS fin_year, CAST(v AS BIGINT) AS value,
    ABS(v - st) * 1000 > 5 * ABS(v) AS disputed, CASE WHEN ABS(v - st) * 1000 > 5 * ABS(v) THEN CAST(st AS BIGINT) END AS source_provided FROM s""",
)
def derived_total_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollup.state_annual_total(
        finals(spark, sf_dir, [*COMPONENTS, "stated"]), COMPONENTS, "stated", counts(spark, sf_dir)
    )
    return out.select(
        "state_code", "fin_year", *whole("value"), F.col("discrepancy").isNotNull().alias("disputed"),
        F.col("discrepancy.source_provided").cast("bigint").alias("source_provided"),
    )


@query(
    "unit_annual_metrics",
    f"""WITH {FINALS} SELECT CAST(sk AS STRING) AS district_code, {fyl('fy')} AS fin_year, 'quantity' AS metric, cq AS value FROM finals WHERE cq IS NOT NULL
    UNION ALL SELECT CAST(sk AS STRING), {fyl('fy')}, 'price', cp FROM finals WHERE cp IS NOT NULL
    UNION ALL SELECT CAST(sk AS STRING), {fyl('fy')}, 'total', cp + ct + cd FROM finals""",
)
def unit_annual_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollup.unit_annual(finals(spark, sf_dir, ["cq", *COMPONENTS]), {"quantity": "cq", "price": "cp"}, "total", COMPONENTS)
    return out.select("district_code", "fin_year", "metric", *whole("value"))


@query(
    "complete_year_ratio",
    f"""WITH {MONTHLY}, paired AS (SELECT * FROM monthly WHERE cq IS NOT NULL AND cp IS NOT NULL),
    last AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sk, fy ORDER BY pos DESC, row_index DESC) AS rn FROM paired)
    SELECT CAST(sk AS STRING) AS district_code, {fyl('fy')} AS fin_year, cp AS value FROM last WHERE rn = 1 AND pos = 11 AND cq <> 0""",
)
def complete_year_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.complete_year_ratio(monthly(spark, sf_dir), "cp", "cq").select("district_code", "fin_year", *whole("value"))


def state_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State sums as observations; ``seq`` is the state's number."""
    sums = rollup.state_annual(finals(spark, sf_dir, ["cq"]), "cq", counts(spark, sf_dir))
    return sums.select(
        F.lit("DEMO").alias("scheme"), F.lit("state").alias("geo_level"), "state_code", "fin_year", F.lit("quantity").alias("metric"),
        F.col("state_code").cast("bigint").alias("seq"), "value",
        F.concat(F.lit("unit-"), F.col("state_code")).alias("original_unit"),
        F.when(F.col("state_code").cast("int") % 2 == 1, F.timestamp_seconds(F.col("state_code").cast("bigint") * 86400)).alias("source_as_of"),
    )


@query(
    "national_rollup",
    f"""WITH {FINALS}, s AS (SELECT nk, fy, SUM(cq) AS v FROM finals GROUP BY 1, 2 HAVING COUNT(cq) > 0)
    SELECT {fyl('fy')} AS fin_year, CAST(SUM(v) AS BIGINT) AS value, 'unit-' || CAST(MIN(nk) AS STRING) AS original_unit,
    MIN(nk) FILTER (WHERE nk % 2 = 1) AS as_of_day FROM s GROUP BY fy""",
)
def national_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollup.national(state_observations(spark, sf_dir), "PUB_A", 0)
    day = F.floor(F.unix_seconds("source_as_of") / 86400).cast("bigint")
    return out.select("fin_year", *whole("value"), "original_unit", day.alias("as_of_day"))


@query(
    "drilldown_residual",
    f"""WITH {FINALS}, s AS (SELECT nk, fy, SUM(cq) AS v, COUNT(cq) AS n FROM finals GROUP BY 1, 2 HAVING COUNT(cq) > 0)
    SELECT CAST(nk AS STRING) AS state_code, {fyl('fy')} AS fin_year, n AS children, 0 AS residual FROM s""",
)
def drilldown_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = finals(spark, sf_dir, ["cq"])
    parents = rollup.state_annual(base, "cq", counts(spark, sf_dir))
    children = rollup.unit_annual(base, {"quantity": "cq"}, "total", ("cq",)).filter("metric = 'quantity'")
    return cohorts.residual(parents, children, ["state_code", "fin_year"]).select(
        "state_code", "fin_year", "children", F.col("residual").cast("bigint").alias("residual")
    )


@query(
    "authority_units",
    f"WITH {COUNTS} SELECT state_code, units AS units_in_authority FROM counts",
)
def authority_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir)


