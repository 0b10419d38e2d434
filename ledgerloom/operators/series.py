"""Labels and summaries of decided facts, and the tables that are served."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ids import fact_id
from ledgerloom.operators import reconcile
from ledgerloom.presets import CorpusPolicy

PRIMARY_BASIS = "flagship (district-monthly, rolled up)"
MULTI_BASIS = "historical multi-source"
SINGLE_BASIS = "historical single-source"

CROSS_PUBLISHER = "cross-publisher"
SINGLE_PUBLISHER = "single-publisher multi-vintage"
SINGLE_SOURCE = "single-source"
FLAGGED = "flagged-disagreement"
IMMATERIAL = "immaterial divergence"
ONE_PUBLISHER_DIVERGENCE = "single-publisher divergence"
SUPERSEDED = "edition-superseded"
UNADJUDICATED = "unadjudicated"
PARTIAL_ONLY = "partial-period-only"

# Summary column of each confidence state.
SUMMARY_COLUMNS = {
    CROSS_PUBLISHER: "cross_publisher",
    SINGLE_PUBLISHER: "single_publisher",
    SINGLE_SOURCE: "single_source",
    FLAGGED: "flagged_disagreement",
    IMMATERIAL: "immaterial_divergence",
    ONE_PUBLISHER_DIVERGENCE: "single_publisher_divergence",
    SUPERSEDED: "edition_superseded",
    UNADJUDICATED: "unadjudicated",
    PARTIAL_ONLY: "partial_period_only",
}

STATE_COLUMNS = [
    "state_lgd_code", "state_name", "financial_year", "metric", "value", "unit", "era_basis", "confidence",
    "sources_seen_count", "contributing_resource_ids", "fact_id",
]
NATIONAL_COLUMNS = [c for c in STATE_COLUMNS if not c.startswith("state_")]
DISTRICT_COLUMNS = [
    "state_lgd_code", "state_name", "district_lgd_code", "district_name", "financial_year", "metric", "value",
    "unit", "grain", "confidence", "sources_seen_count", "contributing_resource_ids", "fact_id",
]


def basis() -> Column:
    return (
        F.when(F.col("has_primary"), PRIMARY_BASIS)
        .when(F.col("surviving_count") >= 2, MULTI_BASIS)
        .otherwise(SINGLE_BASIS)
    )


def confidence() -> Column:
    rule = F.col("resolution_rule_id")
    withheld = (
        F.when(rule == reconcile.ONE_PUBLISHER_RULE, ONE_PUBLISHER_DIVERGENCE)
        .when(rule == reconcile.PARTIAL_RULE, PARTIAL_ONLY)
        .otherwise(UNADJUDICATED)
    )
    return (
        F.when(~F.col("adjudicated"), withheld)
        .when(F.col("disputed"), F.when(F.col("material"), FLAGGED).otherwise(IMMATERIAL))
        .when(F.col("surviving_count") < 2, SINGLE_SOURCE)
        .when(F.col("cross_publisher"), CROSS_PUBLISHER)
        .when(F.col("superseded_count") > 0, SUPERSEDED)
        .otherwise(SINGLE_PUBLISHER)
    )


def era_basis() -> Column:
    return F.when(F.col("basis") == PRIMARY_BASIS, "flagship-rollup").otherwise("historical")


def label(facts: DataFrame, blake_ids: bool = False) -> DataFrame:
    named = facts.withColumns({"basis": basis(), "confidence": confidence(), "fact_id": fact_id(blake_ids)})
    return named.withColumn("era_basis", era_basis())


def assemble(flagged: DataFrame, policy: CorpusPolicy, blake_ids: bool = False) -> DataFrame:
    """Marked readings to labelled facts: decide, quarantine, label."""
    return label(reconcile.quarantine_impossible(reconcile.decide(flagged, policy), policy), blake_ids)


def coverage_summary(facts: DataFrame, split_year: str = "2018") -> DataFrame:
    """Per metric: facts before and from the split year, the nine confidence counts, quarantined."""
    early = F.col("fin_year") < split_year
    return facts.groupBy("metric").agg(
        F.count_if(early).alias("pre_split"),
        F.count_if(~early).alias("from_split"),
        *[F.count_if(F.col("confidence") == state).alias(name) for state, name in SUMMARY_COLUMNS.items()],
        F.count_if("quarantined").alias("quarantined"),
    )


def _served(facts: DataFrame) -> DataFrame:
    return facts.withColumn("financial_year", F.col("fin_year")).withColumn(
        "state_lgd_code", F.coalesce("state_code", F.lit(""))
    ).withColumn("district_lgd_code", F.coalesce("district_code", F.lit("")))


def state_rows(facts: DataFrame, states: DataFrame) -> DataFrame:
    """The served state table; a code without a name has an empty one."""
    names = states.select(F.col("code").alias("state_lgd_code"), F.col("name").alias("state_name"))
    rows = _served(facts.filter(F.col("geo_level") == "state")).join(names, "state_lgd_code", "left")
    return rows.withColumn("state_name", F.coalesce("state_name", F.lit(""))).select(*STATE_COLUMNS)


def national_rows(facts: DataFrame) -> DataFrame:
    return _served(facts.filter(F.col("geo_level") == "national")).select(*NATIONAL_COLUMNS)


def district_rows(facts: DataFrame, states: DataFrame, districts: DataFrame) -> DataFrame:
    names = states.select(F.col("code").alias("state_lgd_code"), F.col("name").alias("state_name"))
    places = districts.select(
        F.col("state_code").alias("state_lgd_code"), F.col("code").alias("district_lgd_code"), F.col("name").alias("district_name")
    )
    rows = _served(facts.filter(F.col("geo_level") == "district")).join(names, "state_lgd_code", "left")
    rows = rows.join(places, ["state_lgd_code", "district_lgd_code"], "left").withColumn("grain", F.lit("district-annual"))
    for column in ("state_name", "district_name"):
        rows = rows.withColumn(column, F.coalesce(column, F.lit("")))
    return rows.select(*DISTRICT_COLUMNS)
