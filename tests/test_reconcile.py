"""The reconciliation rules, one case per key, all cases in one job."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import key_columns
from ledgerloom.operators import extract, lineage, reconcile, series
from ledgerloom.presets import EMPLOYMENT_POLICY

PD, HH, HUNDRED, AW, WAGES = (
    "persondays_generated", "households_employed", "households_completed_100_days", "active_workers", "wages_expenditure",
)
EARLY, LATE = datetime(2020, 1, 1), datetime(2024, 1, 1)


def r(source, value, rank=10, eps=0, cov=None, span=None, terminal=False, as_of=None):
    return {"source_id": source, "value": value, "authority_rank": rank, "rounding_epsilon": eps, "coverage": cov,
            "edition_span_end": span, "is_edition_terminal": terminal, "source_as_of": as_of}


GAP, WHOLE, BOTH = (34, 34, 36), (30, 30, 30), (20, 20, 36)

# name: (metric, readings, value, rule, confidence, extra)
CASES = {
    "single": (PD, [r("A", 94004, 0)], 94004, "R4-REC-04", "single-source"),
    "agree": (PD, [r("B", 94000, 1), r("A", 94004, 0)], 94004, "R4-REC-01", "cross-publisher"),
    "material": (PD, [r("A", 100000, 0), r("B", 130000, 1)], 100000, "R4-REC-02", "flagged-disagreement"),
    "exact metric": (AW, [r("A", 1000000, 0), r("B", 1200000, 1)], 1000000, "R4-REC-02", "flagged-disagreement"),
    "exact metric agrees": (AW, [r("A", 5000, 0), r("B", 5000, 1)], 5000, "R4-REC-01", "cross-publisher"),
    "rounding step": (PD, [r("A", 719, 0), r("B", 1000, 1, eps=500)], 719, "R4-REC-01", "cross-publisher"),
    "structural gap": (PD, [r("A", 71123421, 0, cov=GAP), r("B", 82530000, 1)], None, "R4-REC-05", "unadjudicated"),
    "complete aggregate": (PD, [r("A", 193524566, 0, cov=WHOLE), r("B", 197763000, 1)], 193524566, "R4-REC-02", "flagged-disagreement"),
    "gap against aggregate": (PD, [r("A", 71123421, 0, cov=GAP), r("B", 82530000, 1, cov=BOTH)], 71123421, "R4-REC-02", "flagged-disagreement"),
    "coverage absent": (HUNDRED, [r("M", 0), r("M", 53864)], 53864, "R4-REC-06", "single-source"),
    "genuine zero": (HUNDRED, [r("M", 0), r("R", 0)], 0, "R4-REC-01", "cross-publisher"),
    "scale error": (HH, [r("R", 539000, eps=500), r("M", 539223), r("M", 53890), r("M", 53890)], 539223, "R4-REC-07", "cross-publisher"),
    "no scale error": (HH, [r("R", 539000), r("M", 539223), r("M", 53890)], 539223, "R4-REC-02", "flagged-disagreement"),
    "near zero swing": (HUNDRED, [r("M", 77), r("M", 174)], 77, "R4-REC-08", "immaterial divergence"),
    "small on large base": (HH, [r("M", 2174000), r("R", 2176000)], 2174000, "R4-REC-08", "immaterial divergence"),
    "one publisher": (HUNDRED, [r("M", 7512), r("M", 69264)], None, "R4-REC-09", "single-publisher divergence"),
    "two publishers": (HUNDRED, [r("M", 7512, 10), r("R", 69264, 11)], 7512, "R4-REC-02", "flagged-disagreement"),
    "superseded": (WAGES, [r("M", 500000, span="2014-15"), r("M", 500000, span="2015-16"), r("M", 508000, span="2017-18")], 508000, "R4-REC-10", "edition-superseded"),
    "editions agree": (WAGES, [r("M", 500000, span="2014-15"), r("M", 500000, span="2017-18")], 500000, "R4-REC-01", "single-publisher multi-vintage"),
    "no editions": (WAGES, [r("M", 500000), r("M", 508000)], None, "R4-REC-09", "single-publisher divergence"),
    "superseded with peer": (WAGES, [r("M", 500000, span="2014-15"), r("M", 508000, span="2017-18"), r("R", 508000)], 508000, "R4-REC-10", "cross-publisher"),
    "superseded against peer": (WAGES, [r("M", 500000, span="2014-15"), r("M", 508000, span="2017-18"), r("R", 620000, 11)], 508000, "R4-REC-02", "flagged-disagreement"),
    "terminal beside final": (WAGES, [r("M", 300000, span="2014-15", terminal=True), r("M", 345000, span="2017-18")], 345000, "R4-REC-11", "single-source"),
    "terminal alone": (WAGES, [r("M", 400000, span="2017-18", terminal=True)], None, "R4-REC-11", "partial-period-only"),
    "terminal beside peer": (WAGES, [r("M", 400000, span="2017-18", terminal=True), r("R", 650000)], 650000, "R4-REC-11", "single-source"),
    "dated beats undated": (PD, [r("A", 100000), r("Z", 200000, as_of=EARLY)], 200000, "R4-REC-02", "flagged-disagreement"),
    "newest wins": (PD, [r("A", 100000, as_of=EARLY), r("B", 200000, as_of=LATE)], 200000, "R4-REC-02", "flagged-disagreement"),
    "source id breaks ties": (PD, [r("B", 200000), r("A", 100000)], 100000, "R4-REC-02", "flagged-disagreement"),
    "digit added": (HH, [r("R", 539223), r("M", 539223), r("M", 5392230)], 539223, "R4-REC-07", "cross-publisher"),
    "negative": (PD, [r("A", -5, 0)], -5, "R4-REC-04", "single-source"),
}


def observations(spark, cases):
    rows = []
    for name, case in cases.items():
        for place, reading in enumerate(case[1]):
            coverage = reading["coverage"]
            rows.append((name, case[0], place, reading["source_id"], f"res-{reading['source_id']}", Decimal(reading["value"]),
                         reading["authority_rank"], Decimal(reading["rounding_epsilon"]), coverage, reading["edition_span_end"],
                         reading["is_edition_terminal"], reading["source_as_of"]))
    schema = """state_code string, metric string, seq bigint, source_id string, resource_id string, value decimal(28,12), authority_rank int,
    rounding_epsilon decimal(28,12), coverage struct<units_summed:int,units_in_source_universe:int,units_in_authority:int>,
    edition_span_end string, is_edition_terminal boolean, source_as_of timestamp"""
    df = spark.createDataFrame(rows, schema)
    fixed = {k: F.lit(v).cast("string") for k, v in key_columns("", "").items() if k not in ("state_code", "metric")}
    return extract.as_observations(df.withColumns(fixed).withColumn("original_unit", F.lit("x")))


@pytest.fixture(scope="module")
def flagged(spark):
    return reconcile.flag_readings(observations(spark, CASES), EMPLOYMENT_POLICY).cache()


@pytest.fixture(scope="module")
def facts(flagged):
    return {f["state_code"]: f for f in series.assemble(flagged, EMPLOYMENT_POLICY).collect()}


@pytest.mark.parametrize("name", CASES)
def test_rule(facts, name):
    _, _, value, rule, confidence = CASES[name]
    fact = facts[name]
    assert (fact["value"], fact["resolution_rule_id"], fact["confidence"]) == (value if value is None else Decimal(value), rule, confidence)
    assert fact["sources_seen_count"] == len(CASES[name][1])
    assert fact["adjudicated"] == (value is not None)


def test_buckets_keep_every_reading(flagged):
    def values(name, flag):
        return [int(x["value"]) for x in flagged.filter((F.col("state_code") == name) & F.col(flag)).orderBy("seq").collect()]

    assert values("coverage absent", "absent") == [0]
    assert values("genuine zero", "absent") == []
    assert values("scale error", "scale_error") == [53890, 53890]
    assert values("superseded", "superseded") == [500000, 500000]
    assert values("editions agree", "superseded") == []
    assert values("terminal beside final", "partial") == [300000]
    assert values("material", "rejected") == [130000]


def test_disagreement_percentage_and_materiality(facts):
    assert facts["material"]["disagreement_pct"] == 30.0 and facts["material"]["material"] is True
    assert facts["near zero swing"]["material"] is False
    assert facts["agree"]["disagreement_pct"] is None


def test_negative_value_is_flagged_and_kept(facts):
    assert facts["negative"]["quarantined"] and facts["negative"]["quarantine_reason"] == "negative_value"
    assert not facts["single"]["quarantined"]


def test_persondays_above_the_ceiling_are_flagged(spark):
    cases = {"x": (PD, [r("A", 366001, 0)]), "y": (PD, [r("A", 366000, 0)])}
    workers = {"x": (AW, [r("A", 1000, 0)]), "y": (AW, [r("A", 1000, 0)])}
    obs = observations(spark, cases).unionByName(observations(spark, workers))
    facts = series.assemble(reconcile.flag_readings(obs, EMPLOYMENT_POLICY), EMPLOYMENT_POLICY).collect()
    bad = [(f["state_code"], f["metric"], f["quarantine_reason"]) for f in facts if f["quarantined"]]
    assert bad == [("x", PD, "implausible_persondays")]


def test_only_removed_readings_without_partial_give_no_fact(spark):
    """A key is left out only when nothing survives and no terminal partial explains it."""
    facts = series.assemble(reconcile.flag_readings(observations(spark, {"t": CASES["terminal alone"]}), EMPLOYMENT_POLICY), EMPLOYMENT_POLICY)
    assert facts.count() == 1


def test_same_result_for_any_number_of_partitions(spark, facts):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        again = {f["state_code"]: f for f in series.assemble(
            reconcile.flag_readings(observations(spark, CASES).repartition(7), EMPLOYMENT_POLICY), EMPLOYMENT_POLICY).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert again == facts


def test_cascade_costs_one_exchange(spark, tmp_path):
    path = str(tmp_path / "obs")
    observations(spark, CASES).write.parquet(path)
    plan = reconcile.decide(reconcile.flag_readings(spark.read.parquet(path), EMPLOYMENT_POLICY), EMPLOYMENT_POLICY)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_lineage_in_parts_loses_no_reading(spark, flagged):
    rows = lineage.source_rows(flagged)
    whole = lineage.nested_sources(rows)
    parts = lineage.nested_sources(rows, part_size=1)
    assert whole.filter("parts > 1").count() == 0
    total = "sum(size(sources_seen)) AS n, sum(size(coverage_absent)) AS a, sum(size(rejected_sources)) AS r"
    assert whole.selectExpr(*total.split(", ")).first() == parts.selectExpr(*total.split(", ")).first()
    assert parts.filter("parts > 1").count() > 0


def test_a_fact_of_many_readings_is_one_record(spark, flagged):
    rows = lineage.source_rows(flagged)
    many = rows.withColumn("readings", F.lit(2500)).withColumn("seq", F.explode(F.transform(F.sequence(F.lit(1), F.lit(2500)), lambda i: i + 10000 * F.col("seq"))))
    nested = lineage.nested_sources(many)
    n = rows.groupBy("fact_id").count()
    assert nested.count() == n.count() == nested.select("fact_id").distinct().count()
    assert nested.join(n, "fact_id").filter("size(sources_seen) <> 2500 * count").count() == 0
    assert nested.selectExpr("sum(size(rejected_sources))").first()[0] == 2500 * rows.filter("rejected").count()
