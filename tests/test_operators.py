from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.operators import audit, cohorts, conserve, dedupe, derive, drift, extract, lineage, normalize, reshape, resolve, rollup, serve, triage
from ledgerloom.sources import landing


def raw_frame(spark, rows):
    return spark.createDataFrame([(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(rows)], "row_index bigint, raw string")


def test_landing_order_of_reasons(spark):
    rows = [{"s": "Total", "n": {"x": 1}}, {"s": "a", "n": [1]}, {}, [1], {"s": "b", "n": 2}, None, {"s": "Total"}]
    got = landing.classify_rows(raw_frame(spark, rows), landing.TotalRow("s")).orderBy("row_index").select("reason").collect()
    assert [g[0] for g in got] == ["synthetic_total_row", "malformed_row", "empty_row", "malformed_row", None, "malformed_row", "synthetic_total_row"]


def test_absent_column_is_null_never_zero(spark):
    rows = landing.landed(landing.classify_rows(raw_frame(spark, [{"a": "1"}, {"b": 0}])))
    assert [tuple(r) for r in landing.as_columns(rows, ["a", "b"]).orderBy("row_index").collect()] == [(0, "1", None), (1, None, "0")]


def test_headers():
    h = reshape.parse_header
    assert h("households_provided___2015_16") == reshape.Header("households_provided", "2015-16", None)
    assert h("hh___2015_16_upto_30_09_2015") == reshape.Header("hh", "2015-16", "upto 30 09 2015")
    assert h("hh___2011-2012_p_") == reshape.Header("hh", "2011-2012", None)
    assert h("state") is None


def test_compound_melt_refuses_to_lose_a_column(spark):
    df = spark.sql("SELECT 0L AS row_index, 'x' AS state, 1 AS total")
    with pytest.raises(ValueError, match="total"):
        reshape.compound_melt(df, ["state"])


def test_normalize_messy_row(spark):
    row = {"state": "Goa", "fin_year": "2022-2023", "month": "Smarch", "days": "1,234", "rate": "1.2.3", "flag": True, "size": 2.0}
    rows = landing.landed(landing.classify_rows(raw_frame(spark, [row, row, {"state": None, "days": "5"}])))
    config = normalize.NormalizeConfig(("state",), {"fin_year": "fy", "month": "month", "days": "int", "rate": "decimal", "flag": "int", "size": "int"})
    done = normalize.normalize(normalize.delivered_columns(rows, list(row)), config)
    got = done.rows.first()
    assert (got["row_index"], got["fin_year"], got["month"], got["days"], got["rate"], got["flag"], got["size"]) == (1, "2022-23", None, 1234, None, None, 2)
    assert got["notes"]["days"] == ["R2-FMT-01:strip_commas", "R2-TYPE-01:str→int"]
    assert got["notes"]["rate"] == ["R2-TYPE-01:coercion_failed"] and got["notes"]["month"] == ["R2-DATE-01:parse_failed"]
    assert got["notes"]["flag"] == ["R2-TYPE-01:coercion_failed"] and "state" not in got["notes"]
    assert [r[0] for r in done.collapsed.collect()] == [0]
    assert [(r["row_index"], r["reason"]) for r in done.quarantined.collect()] == [(2, "missing_grain_key")]
    assert done.summary.first()["duplicates_collapsed"] == 1


def test_reshape_notes_of_the_title_outrank_the_melt(spark):
    spec = reshape.ReshapeSpec("simple", ("state",), ("_2019_20",), inject_fin_year="2019-20", inject_state="Goa")
    assert reshape.reshape_notes(spec) == {"_fin_year": reshape.PERIOD_NOTE, "_value": "R3.5-MELT-SIMPLE", "_state": reshape.GEO_NOTE}


def test_dedupe_prefers_dated_rows_and_summarises_nothing(spark):
    df = spark.createDataFrame([(0, "k", 5), (1, "k", None), (2, None, None)], "row_index bigint, key string, as_of int")
    kept = dedupe.survivors(df, ["key"], "as_of")
    assert [tuple(r) for r in kept.collect()] == [(0, "k", 5, 2)]
    assert tuple(dedupe.summary(dedupe.survivors(df.limit(0), ["key"])).first())[:2] == (0, 0)


@pytest.mark.parametrize("chunk", [2, 100])
def test_ledger(spark, chunk):
    pulls = [(0, ["a", "b"], "partial"), (1, ["a"], "full"), (2, ["a", "c"], "full"), (3, ["z"], "partial"), (4, ["a"], "full")]
    df = spark.createDataFrame([("s", *p) for p in pulls], "source_id string, pull_seq bigint, columns array<string>, completeness string")
    got = [(r["comparable"], r["detected"], r["added"], r["removed"]) for r in drift.ledger(df, chunk).orderBy("pull_seq").collect()]
    assert got == [(True, False, [], []), (False, False, [], []), (True, True, ["c"], []), (False, False, [], []), (True, True, [], ["c"])]


def test_ledger_goes_on_from_stored_baselines(spark):
    """Sequences far apart, in two parts: the second knows the first by its baselines only."""
    schema = "source_id string, pull_seq bigint, columns array<string>, completeness string"
    rows = [("s", 10**12 * k, [f"c{k % 3}", "id"], "partial" if k % 4 == 1 else "full") for k in range(12)] + [("t", 5, ["x"], "partial"), ("u", 9 * 10**12, ["y"], "partial")]
    whole = spark.createDataFrame(rows, schema)
    early, late = whole.filter("pull_seq < 6e12"), whole.filter("pull_seq >= 6e12")
    stored = drift.baselines_after(early, spark.createDataFrame([], drift.BASELINES))
    parts = drift.ledger(early, 2).unionByName(drift.ledger(late, 3, stored))
    assert sorted(map(str, parts.collect())) == sorted(map(str, drift.ledger(whole, 5).collect()))
    after = {r["source_id"]: (r["columns"], r["full"]) for r in drift.baselines_after(late, stored).collect()}
    assert after == {"s": (["c2", "id"], True), "t": (["x"], False), "u": (["y"], False)}


def test_small_chunks_share_tasks_and_files(spark, monkeypatch):
    """Findings don't change with the chunks or with the tasks that count them off."""
    schema = "source_id string, pull_seq bigint, columns array<string>, completeness string"
    rows = [(f"s{k % 3}", k, [f"c{k * 7 % 5}", "id"], "partial" if k * 5 % 7 < 3 else "full") for k in range(120)]
    pulls = spark.createDataFrame(rows, schema)
    whole = sorted(map(str, drift.ledger(pulls, 1000).collect()))
    cut = drift._in_chunks(pulls, 2)
    assert len(cut.inputFiles()) == 1
    assert sorted(n for _, n in cut.groupBy("_chunk").count().collect()) == [2] * 60
    assert sorted(map(str, drift.ledger(pulls, 2).collect())) == whole
    monkeypatch.setattr(drift, "TASK_ROWS", 16)
    assert len(drift._in_chunks(pulls, 3).inputFiles()) > 1
    assert sorted(map(str, drift.ledger(pulls, 3).collect())) == whole


def test_published_lineage_reads_the_folders_asked_for(spark, tmp_path):
    ids = [f"{n:02x}{n:014x}" for n in range(256)]
    path = str(tmp_path / "lineage")
    lineage.publish(spark.createDataFrame([(i, "single-source") for i in ids], "fact_id string, confidence string"), path)
    asked = [(0, ids[7]), (1, "ff" + "0" * 14), (2, ids[7]), (3, "../x"), (4, ""), (5, None), (6, ids[30])]
    found = lineage.look_up_published(spark.createDataFrame(asked, "position int, fact_id string"), path)
    assert {r["position"]: r["found"] for r in found.collect()} == {0: True, 1: False, 2: True, 3: False, 4: False, 5: False, 6: True}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [id_folder" in plan and all(f"x{p}" in plan for p in ("07", "1e", "ff"))
    none = lineage.look_up_published(spark.createDataFrame([(0, "none")], "position int, fact_id string"), path)
    assert [r["found"] for r in none.collect()] == [False]


def test_cumulative_final_is_march_and_never_a_sum(spark):
    rows = [("1", "1", "2022-23", "04", 0, 10), ("1", "1", "2022-23", "12", 1, 80), ("1", "1", "2022-23", "03", 2, 90), ("1", "1", "2022-23", "03", 3, None),
            ("1", "2", "2022-23", "12", 4, 7), ("1", "2", "2022-23", "13", 5, 99), ("1", "3", "2021-22", "13", 6, 5)]
    df = spark.createDataFrame(rows, "state_code string, district_code string, fin_year string, month string, row_index bigint, v bigint")
    finals = rollup.unit_finals(df, ["v"])
    assert {r["district_code"]: r["v"] for r in finals.collect()} == {"1": 90, "2": 7, "3": None}
    counts = spark.createDataFrame([("1", 4)], "state_code string, units_in_authority int")
    out = rollup.state_annual(finals, "v", counts).collect()
    assert [(r["fin_year"], int(r["value"]), tuple(r["coverage"])) for r in out] == [("2022-23", 97, (2, 3, 4))]


def test_ratio_needs_march_and_a_denominator(spark):
    rows = [("1", "1", "2018-19", "04", 0, "18623.25759", 12050), ("1", "1", "2018-19", "03", 1, "103.392742752098", 5232066),
            ("1", "2", "2018-19", "04", 2, "5", 1), ("1", "3", "2018-19", "03", 3, "5", 0)]
    df = spark.createDataFrame(rows, "state_code string, district_code string, fin_year string, month string, row_index bigint, rate string, days bigint")
    got = rollup.complete_year_ratio(df, "rate", "days").collect()
    assert [(r["district_code"], r["value"]) for r in got] == [("1", Decimal("103.392742752098"))]


def test_rule_patterns_take_the_total_only(spark):
    stems = ["Persondays (In Lakhs) - Total", "persondays_in_lakhs___total", "Persondays In Lakhs - SCs", "No.of households provided employment", "Average persondays"]
    df = spark.createDataFrame([(i, "28", s, "2013-14", "43", None) for i, s in enumerate(stems)],
                               "row_index bigint, state_code string, _metric string, _fin_year string, _value string, _period_qualifier string")
    got = extract.extract_long(df, presets.STATE_IMPLEMENTATION, 10).orderBy("seq").collect()
    assert [(r["seq"], r["metric"], int(r["value"]), int(r["rounding_epsilon"])) for r in got] == [
        (0, "persondays_generated", 4300000, 50000), (1, "persondays_generated", 4300000, 50000), (3, "households_employed", 43, 0)]


def test_delivered_numbers_lose_their_trailing_zeros(spark):
    df = spark.createDataFrame([(0, "28", "2013-14", "0.90"), (1, "28", "2013-14", "43.0")], "row_index bigint, state_code string, _fin_year string, _value string")
    def steps(delivered):
        out = extract.extract_long(df, (), 10, implicit=("persondays_generated", "count_lakh"), delivered=F.lit(delivered)).orderBy("seq")
        return [int(r["rounding_epsilon"]) for r in out.collect()]
    assert steps("float") == [5000, 5000] and steps("str") == [500, 5000]


def test_resolution(spark):
    states = spark.createDataFrame([(0, "30", "Goa"), (1, "38", "The Dadra And Nagar Haveli And Daman And Diu"), (2, "1", "Jammu And Kashmir"), (3, "11", "Sikkim")], "row_index bigint, code string, name string")
    districts = spark.createDataFrame([(0, "30", "551", "South Goa"), (1, "1", "7", "Budgam")], "row_index bigint, state_code string, code string, name string")
    from ledgerloom.plans.build import alias_tables
    sa, da, past, notes = alias_tables(spark)
    rows = spark.createDataFrame([
        (0, " GOA", "South-Goa", "2018-19"), (1, "J & K", "Badgam", "2018-19"), (2, "Dadra & Nagar Haveli and Daman & Diu", "x", "2018-19"),
        (3, "Daman & Diu", "x", "2018-19"), (4, "Atlantis", "x", "2018-19"), (5, None, "x", "2018-19"), (6, "Sikkim", "East District", "2018-19"), (7, "Goa", "O'Hara", "2018-19")],
        "row_index bigint, s string, d string, _fin_year string")
    out = resolve.resolve(rows, resolve.GeoConfig("district", "Mahatma Gandhi NREGA", state_name="s", district_name="d"), presets.SCHEME_SPELLINGS,
                          presets.CANONICAL_SCHEME, resolve.lookup(states, sa, []), resolve.lookup(districts, da, ["state_code"]), past, notes)
    got = {r["row_index"]: (r["state_code"], r["district_code"], r["reason"]) for r in out.collect()}
    old, lost = resolve.HISTORICAL, resolve.UNRESOLVED
    assert got == {0: ("30", "551", None), 1: ("1", "7", None), 2: (None, None, old), 3: (None, None, old), 4: (None, None, lost),
                   5: (None, None, lost), 6: (None, None, old), 7: (None, None, lost)}
    detail = {r["row_index"]: r["detail"] for r in out.collect()}
    assert detail[5] == "state:None" and detail[7] == 'district:"O\'Hara" in state Goa(30)'
    unknown = resolve.resolve(rows, resolve.GeoConfig("national", "Other"), presets.SCHEME_SPELLINGS, presets.CANONICAL_SCHEME, resolve.lookup(states, sa, []))
    assert {r["reason"] for r in unknown.collect()} == {resolve.UNKNOWN_SCHEME}


def test_places_in_a_global_order(spark):
    from ledgerloom.sources import sinks
    rows = [(i, None if i % 5 == 0 else str(i * 7 % 13), Decimal(i % 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, word string, value decimal(28,12)").repartition(9)
    got = {r["id"]: r["position"] for r in sinks.numbered(df, ["word", "value", "id"]).collect()}
    want = sorted(rows, key=lambda r: (r[1] or "", str(r[2]), str(r[0])))
    assert got == {r[0]: n for n, r in enumerate(want)}
    assert sorted(r["position"] for r in sinks.numbered(df, ["word"]).collect()) == list(range(500))
    assert sinks.numbered(df.limit(0), ["word"]).collect() == []


def test_repeated_curated_rows_double_nothing(spark):
    states = spark.createDataFrame([(0, "30", "Goa"), (1, "31", "Kerala")], "row_index bigint, code string, name string")
    districts = spark.createDataFrame([(0, "30", "551", "South Goa")], "row_index bigint, state_code string, code string, name string")
    aliases = spark.createDataFrame([("gomantak", "Goa", None), ("gomantak", "Goa", None), ("gomantak", "Kerala", "2015"), ("konkan", "Kerala", "2018"), ("konkan", "Goa", "2010")], "name_key string, target string, valid_from string")
    local = spark.createDataFrame([("30", "south", "South Goa", None), ("30", "south", "South Goa", None)], "state_code string, name_key string, target string, valid_from string")
    texts = spark.createDataFrame([(None, "atlantis", "sunk"), (None, "atlantis", "gone"), ("30", "east", "split"), ("30", "east", "split")], "state_code string, name_key string, text string")
    rows = spark.createDataFrame([(0, "Gomantak", "South", "2018-19"), (1, "Atlantis", "x", "2018-19"), (2, "Goa", "East", "2018-19"), (3, "Konkan", "South", "2018-19")], "row_index bigint, s string, d string, _fin_year string")
    lookups = resolve.lookup(states, aliases, []), resolve.lookup(districts, local, ["state_code"])
    assert lookups[0].groupBy("name_key").count().filter("count > 1").count() == 0 and lookups[1].count() == 2
    out = resolve.resolve(rows, resolve.GeoConfig("district", "Mahatma Gandhi NREGA", state_name="s", district_name="d"), presets.SCHEME_SPELLINGS,
                          presets.CANONICAL_SCHEME, *lookups, texts, texts).orderBy("row_index").collect()
    assert [(r["state_code"], r["district_code"], r["detail"]) for r in out] == [
        ("30", "551", None), (None, None, "state:'Atlantis' — gone"), (None, None, "district:'East' in state Goa(30) — split"), ("30", "551", None)]


CATALOG = serve.Catalog((
    serve.ServedTable("state_t", "state", ("m1", "m2"), ("state_lgd_code", "state_name", "financial_year", "metric", "value"), "2010-11", "nat_t"),
    serve.ServedTable("nat_t", "national", ("m1", "m3"), ("financial_year", "metric", "value"), "2006-07")), "2026-27")


def test_governed_query(spark):
    state = spark.createDataFrame([("01", "Goa", "2018-19", "m1", 1.0), ("02", "Goa", "2019-20", "m1", None), ("03", "Kerala", "2018-19", "m2", 3.0)],
                                  "state_lgd_code string, state_name string, financial_year string, metric string, value double")
    served = {"state_t": state, "nat_t": state.select("financial_year", "metric", "value")}
    def code(**kw):
        out = serve.run_query(served, CATALOG, serve.Request(**kw))
        return out.code if isinstance(out, serve.Refusal) else out.row_count
    assert code(table="lineage") == "table_not_queryable" and code(table="zz") == "unknown_table"
    assert code(table="state_t", month="04", fy_from="bad") == "monthly_wage_unavailable"
    assert code(table="state_t", fy_from="2019") == "invalid_period" and code(table="state_t", fy_from="2027-28") == "record_sealed"
    assert code(table="state_t", fy_to="2009-10") == "state_series_floor" and code(table="state_t", fy_to="2010-11") == 0
    assert code(table="state_t", metrics=("m3",)) == "unknown_metric" and code(table="state_t", states=("Atlantis",)) == "unknown_geography"
    assert code(table="nat_t", states=("01",)) == "unknown_geography" and code(table="state_t", states=(" goa ", "03")) == 3
    assert serve.run_query(served, CATALOG, serve.Request("state_t"), row_cap=2).code == "row_cap_exceeded"
    assert serve.run_query(served, CATALOG, serve.Request("state_t", metrics=("m3",))).pointer == "nat_t"


def test_triage_of_many_requests_says_what_each_alone_would_get(spark):
    rows = [("01", "Goa", "7", "North", "2018-19", "m1"), ("01", "Goa", "8", "South", "2019-20", "m1"), ("02", "Goa", "9", "North", None, "m1"), ("03", "Kerala", "10", "8", "2018-19", "m2"), ("03", "Kerala", "10", "8", "2020-21", "m1")]
    fine = spark.createDataFrame(rows, "state_lgd_code string, state_name string, district_lgd_code string, district_name string, financial_year string, metric string")
    catalog = serve.Catalog((*CATALOG.tables, serve.ServedTable("fine_t", "district", ("m1", "m2"), tuple(fine.columns), "2012-13")), "2026-27")
    state = fine.selectExpr("state_lgd_code", "state_name", "financial_year", "metric", "1D AS value")
    served = {"state_t": state, "nat_t": state.select("financial_year", "metric", "value"), "fine_t": fine}
    asked = [
        dict(table="lineage"), dict(table="zz"), dict(table="state_t", month="04", fy_from="bad"), dict(table="state_t", fy_from="2019"), dict(table="state_t", fy_from="2027-28"),
        dict(table="state_t", fy_to="2009-10"), dict(table="nat_t", fy_to="1999-00"), dict(table="fine_t", fy_to="2011-12"), dict(table="state_t", metrics=("m1", "m3", "m9")), dict(table="state_t", metrics=("m9",)),
        dict(table="state_t", states=("Goa", "Atlantis", "Mu")), dict(table="nat_t", states=("01",)), dict(table="state_t", districts=("7",)), dict(table="fine_t", districts=("north", "nowhere")),
        dict(table="state_t"), dict(table="state_t", states=(" goa ", "03", "01")), dict(table="fine_t", districts=("north",)), dict(table="fine_t", districts=("North", "8"), states=("01",)), dict(table="fine_t", districts=(" 8 ",)),
        dict(table="fine_t", metrics=("m1", "m1"), fy_from="2019-20"), dict(table="fine_t", fy_to="2018-19"), dict(table="fine_t", fy_from="2018-19", fy_to="2019-20"), dict(table="fine_t", fy_from="2020-21", fy_to="2018-19"), dict(table="fine_t", states=()), dict(table="fine_t", metrics=()),
    ]
    names = ("metrics", "states", "districts", "fy_from", "fy_to", "month")
    requests = spark.createDataFrame([(i, a["table"], *[list(v) if isinstance(v := a.get(n), tuple) else v for n in names]) for i, a in enumerate(asked)],
                                     "request_id int, table_name string, metrics array<string>, states array<string>, districts array<string>, fy_from string, fy_to string, month string")
    got = {r["request_id"]: r for r in triage.triage(requests, catalog, served, row_cap=4).collect()}
    seen = set()
    for i, a in enumerate(asked):
        alone, row = serve.run_query(served, catalog, serve.Request(**a), row_cap=4), got[i]
        if isinstance(alone, serve.Refusal):
            seen.add(alone.code)
            assert (row["code"], row["pointer"]) == (alone.code, alone.pointer), (a, row)
            assert row["reason"] == alone.reason.replace("'", ""), (a, row)
            if alone.options is not None:
                assert tuple(row["options"]) == alone.options
        else:
            assert (row["code"], row["row_count"]) == (None, alone.row_count), (a, row)
            assert [row["metrics"], row["states"], row["districts"]] == [alone.filters[n] for n in ("metrics", "states", "districts")]
    assert len(seen) == 11 and got[14]["row_count"] == 5 and "5 rows match" in got[14]["reason"]
    assert got[10]["options"] == ["Goa", "Kerala"] and got[13]["pointer"] == "get_schema"


def test_unknown_filter_is_an_error(spark):
    with pytest.raises(ValueError, match="nonsense"):
        cohorts.select(spark.range(1), "nonsense")


DERIVATIONS = "id string, operation string, inputs array<string>"


def evaluated(spark, nodes, rows, schema=DERIVATIONS):
    table = spark.createDataFrame(list(nodes.items()), "id string, value decimal(28,12)")
    return {r["id"]: r for r in derive.evaluate(table, spark.createDataFrame(rows, schema)).collect()}


def test_derivation_problems(spark):
    ds = [("s", "sum", ["a", "b"]), ("r", "ratio", ["a", "b"]), ("u", "sum", ["a", "zz"]), ("x", "cube", ["a"]), ("n", "round_2dp", ["a", "b"]), ("t", "difference", ["s", "a"]), ("v", "sum", ["r", "a"]),
          ("e", "sum", []), ("l", "sum", None), ("d", "sum", ["a", "a", "t"]), ("w", "sum", ["a", None]), ("o", None, ["a"])]
    got = {i: (None if r["value"] is None else int(r["value"]), r["problem"]) for i, r in evaluated(spark, {"a": Decimal(10), "b": Decimal(0)}, ds).items()}
    assert got == {"s": (10, None), "r": (None, "zero denominator"), "u": (None, "unknown input"), "x": (None, "unknown operation"),
                   "n": (None, "needs one input"), "t": (0, None), "v": (None, "unknown input"), "e": (None, "no input"), "l": (None, "no input"),
                   "d": (20, None), "w": (None, "unknown input"), "o": (None, "unknown operation")}


def test_derivations_of_any_depth_in_any_order(spark):
    ds = [("x", "sum", ["w", "missing"]), ("w", "sum", ["u", "a"]), ("u", "sum", ["t", "s"]), ("t", "difference", ["s", "a"]), ("s", "sum", ["a", "b"])]
    got = {i: (r["level"], None if r["value"] is None else int(r["value"]), r["problem"]) for i, r in evaluated(spark, {"a": Decimal(10), "b": Decimal(3)}, ds).items()}
    assert got == {"s": (1, 13, None), "t": (2, 3, None), "u": (3, 16, None), "w": (4, 26, None), "x": (5, None, "unknown input")}
    rows = spark.createDataFrame(ds, DERIVATIONS)
    facts = spark.createDataFrame([("a", "fa"), ("b", "fb"), ("b", "fb2")], "id string, fact_id string")
    assert {(r["id"], r["fact_id"]) for r in derive.leaves(rows, facts).collect()} == {(i, f) for i in "stuwx" for f in ("fa", "fb", "fb2")}


def test_cycles_are_told_from_what_rests_on_them(spark):
    ds = [("a1", "sum", ["a2"]), ("a2", "sum", ["a3", "n"]), ("a3", "sum", ["a1"]), ("way", "sum", ["a1"]), ("b1", "sum", ["way", "b1"]),
          ("tail", "sum", ["b1"]), ("tip", "sum", ["tail"]), ("fine", "sum", ["n"])]
    got = {i: (r["level"], r["problem"]) for i, r in evaluated(spark, {"n": Decimal(1)}, ds).items()}
    assert got == {**dict.fromkeys(("a1", "a2", "a3", "way", "b1"), (None, "cycle")), "tail": (None, "unknown input"), "tip": (None, "unknown input"), "fine": (1, None)}
    facts = spark.createDataFrame([("n", "f")], "id string, fact_id string")
    assert {r["id"] for r in derive.leaves(spark.createDataFrame(ds, DERIVATIONS), facts).collect()} == {d[0] for d in ds}


def test_values_out_of_range_end_no_job(spark):
    big = Decimal(9_999_999_999_999_999)
    nodes = {"big": big, "one": Decimal(1), "minus": -big, "tiny": Decimal("0.000000000001"), "frac": Decimal("0.999")}
    ds = [("s", "sum", ["big", "one"]), ("d", "difference", ["minus", "one"]), ("q", "ratio", ["big", "tiny"]), ("q2", "ratio_2dp", ["big", "tiny"]), ("edge", "sum", ["big", "frac"]),
          ("r", "round_2dp", ["edge"]), ("g", "round_sigfig_3", ["big"]), ("m", "to_millions", ["big"]), ("up", "sum", ["s", "one"]), ("ok", "sum", ["one", "frac"])]
    got = {i: (r["value"], r["problem"]) for i, r in evaluated(spark, nodes, ds).items()}
    assert {i for i, (_, p) in got.items() if p == "out of range"} == {"s", "d", "q", "q2", "r", "g"}
    assert got["up"] == (None, "unknown input") and got["ok"] == (Decimal("1.999"), None) and got["m"] == (Decimal(10_000_000_000), None)


def test_quotients_are_exact_to_the_last_place(spark):
    pairs = [("5000000000000", "7000000000000"), ("1", "3"), ("-2", "3"), ("0.333333333333", "0.000000000007"), ("9999999999999999", "7"), ("123456789.123456789012", "0.987654321098"), ("0", "5"), ("1", "-8")]
    nodes = {f"{i}{side}": Decimal(v) for i, pair in enumerate(pairs) for side, v in zip("ab", pair, strict=True)}
    ds = [(f"{op}{i}", op, [f"{i}a", f"{i}b"]) for i in range(len(pairs)) for op in ("ratio", "ratio_2dp")]
    got = evaluated(spark, nodes, ds)
    import decimal
    with decimal.localcontext(prec=60):
        for i, (a, b) in enumerate(pairs):
            exact = Decimal(a) / Decimal(b)
            assert got[f"ratio{i}"]["value"] == exact.quantize(Decimal("1e-12"), decimal.ROUND_DOWN)
            assert got[f"ratio_2dp{i}"]["value"] == exact.quantize(Decimal("0.01"), decimal.ROUND_HALF_UP)


def test_ids_that_repeat_feed_nothing(spark):
    ds = [("s", "sum", ["n"]), ("s", "sum", ["n", "n"]), ("n", "sum", ["n"]), ("t", "sum", ["s"]), ("u", "sum", ["n"])]
    table = spark.createDataFrame([("n", Decimal(4))], "id string, value decimal(28,12)")
    out = sorted((r["id"], r["problem"] or "") for r in derive.evaluate(table, spark.createDataFrame(ds, DERIVATIONS)).collect())
    assert out == [("n", "repeated id"), ("s", "repeated id"), ("s", "repeated id"), ("t", "unknown input"), ("u", "")]
    none = derive.evaluate(table, spark.createDataFrame([], DERIVATIONS))
    assert none.collect() == [] and none.columns == ["id", "level", "operation", "value", "problem"]


def test_wrong_declared_values_feed_no_others(spark):
    nodes = spark.createDataFrame([("a", Decimal(10))], "id string, value decimal(28,12)")
    ds = [("x", "sum", ["a"], Decimal(11)), ("y", "sum", ["x"], Decimal(10)), ("z", "sum", ["y"], Decimal(10)), ("w", "sum", ["a", "a"], Decimal(20)), ("v", "sum", ["w"], None)]
    declared = spark.createDataFrame(ds, f"{DERIVATIONS}, declared decimal(28,12)")
    got = {r["id"]: (r["recomputed_value"], r["problem"]) for r in audit.derivation_problems(nodes, declared).collect()}
    assert got == {"x": (Decimal(10), "mismatch"), "y": (None, "unknown input"), "z": (None, "unknown input"), "v": (Decimal(20), "mismatch")}


def test_text_audits(spark):
    docs = spark.createDataFrame([("s", 1, 'In 2018-19 it was 94,004, then 94004. Rose 1.5% v2 to 300,000, and 7.'), ("s", 2, 'FY 2019-20.')], "section_id string, doc_id int, text string")
    figures = spark.createDataFrame([("s", Decimal("94004.0")), ("s", Decimal(300000))], "section_id string, value decimal(28,12)")
    bad = {(r["doc_id"], r["token"]) for r in audit.unbacked_numbers(docs, audit.renderings(figures)).collect()}
    assert bad == {(1, "1.5"), (1, "7")}
    periods = spark.createDataFrame([("s", "2018-19")], "section_id string, token string")
    assert [r["token"] for r in audit.unbacked_periods(docs, periods).collect()] == ["2019-20"]


def test_quotations_of_every_length(spark):
    """Against a plain substring search, over lengths on both sides of every piece size."""
    served_text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400)) + " tail of the text"
    docs, want = [], set()
    for n, (start, length) in enumerate([(0, 40), (3, 63), (5, 64), (9, 65), (20, 200), (390, 27), (100, 130)]):
        quote = served_text[start:start + length]
        pad = " " * max(0, 40 - len(quote))
        docs.append(("s", 2 * n, f'x "{quote}{pad}" y'))
        docs.append(("s", 2 * n + 1, f'x “{quote[:-1]}#{pad}” y'))
        want.add(2 * n + 1)
    docs += [("s", 100, '"' + " " * 45 + '"'), ("t", 101, '"' + " " * 45 + '"'), ("s", 102, '"' + " " * 44 + 'q' + '"'), ("s", 103, '"' + " " * 44 + '#' + '"')]
    want |= {101, 103}
    df = spark.createDataFrame(docs, "section_id string, doc_id int, text string")
    served = spark.createDataFrame([("s", served_text), ("s", "qqq")], "section_id string, text string")
    assert {r["doc_id"] for r in audit.unbacked_quotations(df, served).collect()} == want


def test_exhibits_go_longest_first(spark):
    docs = spark.createDataFrame([("s", 1, "ask(1) says ask(1, x)!"), ("t", 2, "ask(1)")], "section_id string, doc_id int, text string")
    exhibits = spark.createDataFrame([("s", "ask(1"), ("s", "ask(1, x)")], "section_id string, text string")
    assert {r["doc_id"]: r["text"] for r in audit.strip_exhibits(docs, exhibits).collect()} == {1: " ) says  !", 2: "ask(1)"}


def test_conservation_and_bijection(spark):
    before = spark.createDataFrame([("a",), ("a",), ("b",)], "r string")
    out = {r["r"]: r["conserved"] for r in conserve.row_conservation(before, [before.filter("r = 'a'"), before.limit(0)], "r").collect()}
    assert out == {"a": True, "b": False}
    ids = spark.createDataFrame([("1",), ("2",), ("2",)], "fact_id string")
    got = {(r[0], r[1]) for r in conserve.bijection_problems(ids, spark.createDataFrame([("1",), ("2",), ("3",)], "fact_id string")).collect()}
    assert got == {("2", "repeated fact"), ("3", "no fact")}
