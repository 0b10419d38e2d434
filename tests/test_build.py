"""The whole run on a small archive: files in, served tables and lineage out, read back."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.operators import lineage, normalize, reshape, resolve
from ledgerloom.plans import build
from ledgerloom.sources import landing, readers
from ledgerloom.streaming import pulls

P, T = "Persondays_of_Central_Liability_so_far", "Average_Wage_rate_per_day_per_person"


def envelope(path, name, records, updated="2025-03-07T10:00:00Z"):
    path.write_text(json.dumps({"index_name": name, "updated_date": updated, "title": "t", "records": records}, indent=1))
    return str(path)


def district_month(state, district, month, days, wages, stated, rate="250.5", year="2022-2023"):
    return {"state_code": "10", "district_code": district[:1], "fin_year": year, "month": month, "state_name": state, "district_name": district,
            P: days, T: rate, "Wages": wages, "Material_and_skilled_Wages": "10", "Total_Adm_Expenditure": "5.5", "Total_Exp": stated,
            "Total_Households_Worked": "100", "Total_No_of_HHs_completed_100_Days_of_Wage_Employment": "3", "Total_No_of_Active_Workers": "1,000", "Remarks": "NA"}


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    primary = [
        district_month("GOA", "North Goa", "April", "30000", "20", "35"), district_month("GOA", "North Goa", "March", "42253", "60.25", "75.75"),
        district_month("GOA", "South Goa", "Feb", "50000", "30", "45"), district_month("GOA", "South Goa", "March", "51751", "40", "99"),
        district_month("GOA", "South Goa", "March", "51752", "40", "99"), district_month("Goa", "Atlantis", "March", "9", "1", "1"),
    ]
    pure = [{"si": "1", "state_ut_wise": "Goa", "_2021_22": 0.90, "_2022_23": 0.94}, {"si": "2", "state_ut_wise": "Total", "_2021_22": 1, "_2022_23": 2}]
    compound = [{"state_uts": "Orissa", "person_days_generated__in_lakh____2022_23": "5.00", "person_days_generated__in_lakh____2023_24_upto_30_09_2023": "1.00"}]
    (root / "national.csv").write_text("﻿ Year ,Households Provided Employment,Persondays (In Lakhs) - Total\n2021-22,\"1,200\",3.5\n2022-23,1300,\n")
    return {
        "primary": envelope(root / "primary.json", "ee03643a", primary), "pure": envelope(root / "pure.json", "cea6ee41", pure),
        "compound": envelope(root / "compound.json", None, compound, None), "national": str(root / "national.csv"),
        "states": envelope(root / "states.json", "s", [{"code": 30, "name": "Goa"}, {"code": 21, "name": "Odisha"}]),
        "districts": envelope(root / "districts.json", "d", [{"state_code": 30, "code": 551, "name": "North Goa"}, {"state_code": 30, "code": 552, "name": "South Goa"}]),
        "out": str(root / "dist"),
    }


@pytest.fixture(scope="module")
def run(spark, archive):
    authority = build.load_authority(spark, archive["states"], archive["districts"])
    full = normalize.NormalizeConfig
    resources = [
        build.Resource("primary", "SRC_FLAGSHIP", archive["primary"], full(presets.PRIMARY_GRAIN_KEYS, presets.PRIMARY_COLUMN_TYPES),
                       resolve.GeoConfig("district", "MGNREGA", "state_name", "state_code", "district_name", "district_code", fin_year="fin_year"), "district+monthly"),
        build.Resource("cea6ee41", "SRC_RS", archive["pure"],
                       full(("state_ut_wise", "_fin_year"), {"_fin_year": "fy"}, reshape.ReshapeSpec("simple", ("si", "state_ut_wise"), ("_2021_22", "_2022_23"))),
                       resolve.GeoConfig("state", "MNREGA", "state_ut_wise"), total=landing.TotalRow("state_ut_wise")),
        build.Resource("e289a8fe", "SRC_RS", archive["compound"], full(("state_uts", "_metric", "_fin_year"), {"_fin_year": "fy"}, reshape.ReshapeSpec("compound", ("state_uts",))),
                       resolve.GeoConfig("state", "MGNREGS", "state_uts")),
        build.Resource("04476f1d", "SRC_MOSPI", archive["national"], full(("Year",), {"Year": "fy"}), resolve.GeoConfig("national", "NREGA")),
        build.Resource("unnamed", "SRC_RS", archive["national"], full(("Year",), {"Year": "fy"}), resolve.GeoConfig("national", "NREGA")),
        build.Resource("broken", "SRC_RS", archive["pure"].replace(".json", ".xls"), full(("x",)), resolve.GeoConfig("state", "NREGA", "x")),
    ]
    whole = build.build_all(spark, resources, authority, "primary")
    wired, deferred, built = whole.wired, whole.deferred, whole.built
    counts = {r["table_name"]: r["row_count"] for r in build.export(built, authority, archive["out"]).collect()}
    return wired, deferred, built, counts, archive["out"]


def test_a_failing_resource_is_deferred_with_its_reason(run):
    rows = {r["resource_id"]: r["deferred_reason"] for r in run[1].collect()}
    assert rows.keys() == {"broken", "unnamed"} and "unsupported archive format" in rows["broken"]
    assert rows["unnamed"] == "no mapping names this resource"


def test_quarantine_keeps_what_does_not_resolve(run):
    bad = run[0]["primary"].filter(F.col("reason").isNotNull()).collect()
    assert [(r["reason"], r["detail"]) for r in bad] == [("unresolved_geography", "district:'Atlantis' in state Goa(30)")]


def test_facts(run):
    facts = {(f["geo_level"], f["state_code"], f["district_code"], f["fin_year"], f["metric"]): f for f in run[2].facts.collect()}
    days = facts["state", "30", None, "2022-23", "persondays_generated"]
    # The later of two March rows counts; the peer's 0.94 lakh agrees with 94,005.
    assert (int(days["value"]), days["confidence"], days["resolution_rule_id"]) == (94005, "cross-publisher", "R4-REC-01")
    assert facts["state", "30", None, "2021-22", "persondays_generated"]["confidence"] == "single-source"
    assert int(facts["state", "21", None, "2022-23", "persondays_generated"]["value"]) == 500000
    assert ("state", "21", None, "2023-24", "persondays_generated") not in facts
    assert float(facts["state", "30", None, "2022-23", "total_expenditure"]["value"]) == 131.25
    assert int(facts["district", "30", "552", "2022-23", "persondays_generated"]["value"]) == 51752
    assert float(facts["district", "30", "551", "2022-23", "avg_wage_rate_per_day"]["value"]) == 250.5
    assert int(facts["national", None, None, "2021-22", "households_employed"]["value"]) == 1200
    assert int(facts["national", None, None, "2021-22", "persondays_generated"]["value"]) == 350000
    assert int(facts["state", "30", None, "2022-23", "active_workers"]["value"]) == 2000
    # The nation's own table says nothing here; the primary states add up, and no peer's reading does.
    assert int(facts["national", None, None, "2022-23", "persondays_generated"]["value"]) == 94005
    assert facts["national", None, None, "2022-23", "persondays_generated"]["confidence"] == "single-source"
    # 1,300 in the nation's table against 200 from the states.
    assert facts["national", None, None, "2022-23", "households_employed"]["confidence"] not in ("single-source", "cross-publisher")
    assert not days["quarantined"]


def test_export_and_lineage(spark, run):
    counts, out = run[3], run[4]
    total = run[2].facts.count()
    assert counts["lineage"] == total == counts["state_annual_series"] + counts["national_annual_series"] + counts["district_flagship"]
    served = readers.read_served(spark, f"{out}/state_annual_series.parquet")
    row = served.filter("state_lgd_code = '30' AND financial_year = '2022-23' AND metric = 'persondays_generated'").first()
    assert row["value"] == 94005.0 and row["contributing_resource_ids"] == "cea6ee41;primary" and row["state_name"] == "Goa"
    record = lineage.parse_records(readers.read_records(spark, f"{out}/lineage.jsonl").filter(F.col("fact_id") == row["fact_id"])).first()
    assert [s["source_id"] for s in record["sources_seen"]] == ["SRC_FLAGSHIP", "SRC_RS"]
    spend = served.filter("metric = 'total_expenditure'").first()["fact_id"]
    text = readers.read_records(spark, f"{out}/lineage.jsonl").filter(F.col("fact_id") == spend).first()["record"]
    gap = json.loads(text)["sources_seen"][0]
    assert gap["definition_discrepancy"]["source_provided"] == "174.75" and gap["aggregate_coverage"]["status"] == "complete"
    assert gap["source_as_of"] == "2025-03-07T10:00:00+00:00"
    header = [f for f in os.listdir(f"{out}/district_flagship.csv") if f.endswith(".csv")]
    assert header


def test_pulls_as_a_stream(spark, tmp_path):
    source, history, findings = (str(tmp_path / n) for n in ("in", "history", "findings"))
    schema = pulls.PULLS
    for seq, columns in enumerate([["a", "b"], ["a"], ["a", "c"]]):
        spark.createDataFrame([("s", seq, columns, "full"), (f"t{seq}", 0, ["x"], "partial")], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        pulls.follow_pulls(stream, history, findings, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(findings).filter("source_id = 's'").orderBy("pull_seq").collect()
    assert [(r["detected"], r["added"], r["removed"]) for r in got] == [(False, [], []), (True, [], ["b"]), (True, ["c"], [])]
    assert spark.read.parquet(findings).count() == 6
