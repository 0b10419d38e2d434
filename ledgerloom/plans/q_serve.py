"""Queries over the served tables: filters, triage, catalog, cohorts, series, derivations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import axis, cohorts, derive, serve, triage
from ledgerloom.plans.inputs import fyl, run
from ledgerloom.plans.q_facts import DECIDED, facts, sources
from ledgerloom.plans.registry import query

# Yearly order values per customer: a long series with gaps, as served rows.
SERIES = f"""pts AS (SELECT CAST(o_custkey AS STRING) AS place, {fyl('year(o_orderdate)')} AS fin_year, year(o_orderdate) AS y,
  CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS value FROM orders GROUP BY 1, 2, 3)"""

# Served state and national tables over the orders.
SERVED = f"""served_state AS (
  SELECT CAST(c_nationkey AS STRING) AS state_lgd_code, n_name AS state_name, {fyl('year(o_orderdate)')} AS financial_year,
    'm_' || LOWER(o_orderstatus) AS metric, CAST(SUM(CAST(ROUND(o_totalprice) AS BIGINT)) AS BIGINT) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4),
served_national AS (SELECT financial_year, metric, CAST(SUM(value) AS BIGINT) AS value FROM served_state WHERE metric <> 'm_o' GROUP BY 1, 2)"""

CATALOG = serve.Catalog(
    (
        serve.ServedTable("state", "state", ("m_f", "m_o"), ("state_lgd_code", "state_name", "financial_year", "metric", "value"), "1996-97", "national"),
        serve.ServedTable("national", "national", ("m_f", "m_p"), ("financial_year", "metric", "value"), "1994-95"),
    ),
    ceiling="1999-00",
)


def served(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: run(spark, sf_dir, f"WITH {SERVED} SELECT * FROM served_{t}") for t in ("state", "national")}


@query(
    "query_filter",
    f"""WITH {SERVED} SELECT * FROM served_state WHERE metric IN ('m_f', 'm_o') AND state_lgd_code IN ('3', '7', '11')
    AND financial_year >= '1996-97' AND financial_year <= '1998-99'""",
)
def query_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and codes mixed, one of them twice, through the whole chain of checks."""
    request = serve.Request("state", states=("NATION_3", " 7 ", "nation_11", "3"), fy_from="1996-97", fy_to="1998-99")
    answer = serve.run_query(served(spark, sf_dir), CATALOG, request)
    if isinstance(answer, serve.Refusal):
        raise RuntimeError(answer.reason)
    return answer.rows


@query(
    "distinct_places",
    f"WITH {SERVED} SELECT DISTINCT state_lgd_code, state_name FROM served_state",
)
def distinct_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.distinct_pairs(served(spark, sf_dir)["state"], "state_lgd_code", "state_name")


# Requests on all three grains: lists of metrics, of states by code and name, of districts by code and
# by names that several districts share.
PLACES = f"""{SERVED}, served_district AS (
  SELECT CAST(c_nationkey AS STRING) AS state_lgd_code, n_name AS state_name, CAST(c_custkey AS STRING) AS district_lgd_code, 'Place ' || CAST(CAST(FLOOR(c_custkey / 3.0) AS BIGINT) AS STRING) AS district_name,
    {fyl('year(o_orderdate)')} AS financial_year, 'm_' || LOWER(o_orderstatus) AS metric, CAST(SUM(CAST(ROUND(o_totalprice) AS BIGINT)) AS BIGINT) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4, 5, 6)"""
TRIAGED = serve.Catalog(
    (*CATALOG.tables, serve.ServedTable("district", "district", ("m_f", "m_o"), ("state_lgd_code", "state_name", "district_lgd_code", "district_name", "financial_year", "metric", "value"), "1993-94", "state")),
    ceiling="1999-00",
)
CAP = 60
REQUESTS = """requests AS (SELECT o_orderkey AS request_id, o_custkey AS ck,
    CASE o_orderkey % 9 WHEN 0 THEN 'lineage' WHEN 1 THEN 'statewide' WHEN 2 THEN 'national' WHEN 3 THEN 'district' WHEN 4 THEN 'district' WHEN 5 THEN 'district' ELSE 'state' END AS table_name,
    CASE o_orderkey % 8 WHEN 0 THEN array('m_o', 'm_p') WHEN 1 THEN array('m_f', 'm_x', 'm_p') WHEN 2 THEN array('m_f', 'm_f') WHEN 3 THEN array('m_f') END AS metrics,
    CASE o_orderkey % 11 WHEN 0 THEN array('4', 'Atlantis', 'Mu') WHEN 1 THEN array('4') WHEN 2 THEN array(' nation_5 ', '7', 'NATION_7', '5') WHEN 3 THEN array('1', '2', '3', '4', '5', '6', '8', '9') END AS states,
    CASE o_orderkey % 10 WHEN 0 THEN array(CAST(o_custkey AS STRING)) WHEN 1 THEN array('place 5', ' Place 7', CAST(o_custkey AS STRING)) WHEN 2 THEN array('Place 11', 'nowhere') END AS districts,
    CASE o_orderkey % 13 WHEN 0 THEN '2003-04' WHEN 1 THEN '1998' WHEN 2 THEN '1998-98' WHEN 3 THEN '1997-98' WHEN 4 THEN '1998-99' END AS fy_from,
    CASE o_orderkey % 17 WHEN 0 THEN '1995-96' WHEN 1 THEN '1990-91' WHEN 2 THEN '1997-1998' WHEN 3 THEN '1999-00' WHEN 4 THEN '1996-97' WHEN 5 THEN '1992-93' END AS fy_to,
    CASE WHEN o_orderkey % 19 = 0 THEN '04' END AS month FROM orders)"""


@query(
    "request_triage",
    f"""WITH {PLACES}, {REQUESTS.replace('array(', 'list_value(')},
    own AS (SELECT * FROM (VALUES ('state', ['m_f', 'm_o'], '1996-97', 'national', TRUE, FALSE), ('national', ['m_f', 'm_p'], '1994-95', NULL, FALSE, FALSE),
      ('district', ['m_f', 'm_o'], '1993-94', 'state', TRUE, TRUE)) t(table_name, own_metrics, low, low_pointer, has_state, has_district)),
    places AS (SELECT 'state' AS table_name, 'state' AS kind, state_lgd_code AS code, state_name AS name FROM served_state UNION SELECT 'district', 'state', state_lgd_code, state_name FROM served_district
      UNION SELECT 'district', 'district', district_lgd_code, district_name FROM served_district),
    tokens AS (SELECT request_id, table_name, 'state' AS kind, unnest(states) AS token, unnest(range(len(states))) AS pos FROM requests
      UNION ALL SELECT request_id, table_name, 'district', unnest(districts), unnest(range(len(districts))) FROM requests),
    hits AS (SELECT t.request_id, t.kind, t.pos, t.token, p.code FROM tokens t LEFT JOIN places p ON p.table_name = t.table_name AND p.kind = t.kind AND (TRIM(t.token) = p.code
      OR (LOWER(TRIM(t.token)) = LOWER(p.name) AND NOT EXISTS (SELECT 1 FROM places q WHERE q.table_name = t.table_name AND q.kind = t.kind AND q.code = TRIM(t.token))))),
    geo AS (SELECT request_id, kind, ARG_MIN(token, pos) FILTER (WHERE code IS NULL) AS lost, LIST(DISTINCT code) FILTER (WHERE code IS NOT NULL) AS codes FROM hits GROUP BY 1, 2),
    firsts AS (SELECT request_id, code, MIN(pos) AS pos, kind FROM hits WHERE code IS NOT NULL GROUP BY request_id, code, kind),
    orders_of AS (SELECT request_id, kind, STRING_AGG(code, ',' ORDER BY pos, code) AS listed FROM firsts GROUP BY 1, 2),
    j AS (SELECT r.*, o.*  EXCLUDE (table_name), COALESCE(r.metrics, o.own_metrics) AS every, s.lost AS s_lost, s.codes AS s_codes, d.lost AS d_lost, d.codes AS d_codes,
        LIST_FILTER(r.metrics, lambda m: NOT LIST_CONTAINS(o.own_metrics, m))[1] AS odd, so.listed AS s_listed, dd.listed AS d_listed
      FROM requests r LEFT JOIN own o USING (table_name) LEFT JOIN geo s ON s.request_id = r.request_id AND s.kind = 'state' LEFT JOIN geo d ON d.request_id = r.request_id AND d.kind = 'district'
      LEFT JOIN orders_of so ON so.request_id = r.request_id AND so.kind = 'state' LEFT JOIN orders_of dd ON dd.request_id = r.request_id AND dd.kind = 'district'),
    c AS (SELECT *, CASE WHEN table_name = 'lineage' THEN 'table_not_queryable' WHEN table_name = 'statewide' THEN 'unknown_table' WHEN month IS NOT NULL THEN 'monthly_wage_unavailable'
      WHEN fy_from IN ('1998', '1998-98') OR fy_to = '1997-1998' THEN 'invalid_period' WHEN fy_from > '1999-00' THEN 'record_sealed' WHEN fy_to < low THEN table_name || '_series_floor'
      WHEN odd IS NOT NULL THEN 'unknown_metric' WHEN states IS NOT NULL AND (NOT has_state OR s_lost IS NOT NULL) THEN 'unknown_geography'
      WHEN districts IS NOT NULL AND (NOT has_district OR d_lost IS NOT NULL) THEN 'unknown_geography' END AS early FROM j),
    cells AS (SELECT 'state' AS table_name, metric, financial_year, state_lgd_code AS s, NULL AS d FROM served_state UNION ALL SELECT 'national', metric, financial_year, NULL, NULL FROM served_national
      UNION ALL SELECT 'district', metric, financial_year, state_lgd_code, district_lgd_code FROM served_district),
    sizes AS (SELECT c.request_id, COUNT(*) AS n FROM c JOIN cells x ON x.table_name = c.table_name AND c.early IS NULL AND LIST_CONTAINS(c.every, x.metric) AND (c.states IS NULL OR LIST_CONTAINS(c.s_codes, x.s))
      AND (c.districts IS NULL OR LIST_CONTAINS(c.d_codes, x.d)) AND (c.fy_from IS NULL OR x.financial_year >= c.fy_from) AND (c.fy_to IS NULL OR x.financial_year <= c.fy_to) GROUP BY 1),
    f AS (SELECT c.*, CASE WHEN early IS NULL THEN COALESCE(n, 0) END AS row_count, COALESCE(early, CASE WHEN n > {CAP} THEN 'row_cap_exceeded' END) AS code FROM c LEFT JOIN sizes USING (request_id)),
    home AS (SELECT * FROM (VALUES ('m_p', 'national'), ('m_o', 'state')) t(odd, home))
    SELECT request_id, table_name, code, row_count,
      CASE code WHEN 'table_not_queryable' THEN 'lineage holds provenance; look facts up by id' WHEN 'unknown_table' THEN 'no table statewide'
        WHEN 'monthly_wage_unavailable' THEN 'the series is annual; monthly year-to-date readings are no monthly values'
        WHEN 'invalid_period' THEN CASE WHEN fy_from IN ('1998', '1998-98') THEN fy_from ELSE fy_to END || ' is no financial year: expected YYYY-YY, the suffix being the next year'
        WHEN 'record_sealed' THEN 'the record ends with 1999-00; nothing exists from ' || fy_from || ' on' WHEN 'unknown_metric' THEN table_name || ' does not serve ' || odd || COALESCE('; it is served by ' || home, '')
        WHEN 'unknown_geography' THEN CASE WHEN states IS NOT NULL AND NOT has_state THEN table_name || ' has no state' WHEN states IS NOT NULL AND s_lost IS NOT NULL THEN 'unknown state ' || s_lost || ': give a code or a current name'
          WHEN NOT has_district THEN table_name || ' has no district' ELSE 'unknown district ' || d_lost || ': give a code or a current name' END
        WHEN 'row_cap_exceeded' THEN CAST(row_count AS VARCHAR) || ' rows match, more than {CAP}; narrow the filters' ELSE CASE WHEN code IS NOT NULL THEN table_name || ' starts with ' || low END END AS reason,
      CASE WHEN code IN ('table_not_queryable', 'unknown_table') THEN 'state,national,district' WHEN code = 'unknown_metric' THEN ARRAY_TO_STRING(own_metrics, ',')
        WHEN code = 'unknown_geography' AND has_state AND states IS NOT NULL AND s_lost IS NOT NULL THEN (SELECT STRING_AGG(DISTINCT name, ',' ORDER BY name) FROM places p WHERE p.table_name = f.table_name AND p.kind = 'state') END AS options,
      CASE WHEN code = 'table_not_queryable' THEN 'get_lineage' WHEN code LIKE '%_series_floor' THEN low_pointer WHEN code = 'unknown_metric' THEN home
        WHEN code = 'unknown_geography' AND NOT (states IS NOT NULL AND (NOT has_state OR s_lost IS NOT NULL)) THEN CASE WHEN has_district THEN 'get_schema' ELSE 'district' END END AS pointer,
      CASE WHEN early IS NULL THEN ARRAY_TO_STRING(every, ',') END AS metrics, CASE WHEN early IS NULL AND states IS NOT NULL THEN s_listed END AS states, CASE WHEN early IS NULL AND districts IS NOT NULL THEN d_listed END AS districts
    FROM f LEFT JOIN home USING (odd)""",
)
def request_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eleven refusals, with what they say, and the true size of every request in scope."""
    requests = run(spark, sf_dir, f"WITH {REQUESTS} SELECT * FROM requests")
    tables = {t: run(spark, sf_dir, f"WITH {PLACES} SELECT * FROM served_{t}") for t in ("state", "national", "district")}
    out = triage.triage(requests, TRIAGED, tables, row_cap=CAP)
    return out.withColumns({c: F.array_join(c, ",") for c in ("options", "metrics", "states", "districts")})


@query(
    "table_catalog",
    f"""WITH {SERVED}, a AS (SELECT 'state' AS table_name, 'state' AS grain, COUNT(*) AS row_count, MIN(financial_year) AS fy_from, MAX(financial_year) AS fy_to, 2 AS metrics FROM served_state
      UNION ALL SELECT 'national', 'national', COUNT(*), MIN(financial_year), MAX(financial_year), 2 FROM served_national)
    SELECT * FROM a UNION ALL SELECT 'lineage', 'per-fact provenance', SUM(row_count), MIN(fy_from), MAX(fy_to), 0 FROM a""",
)
def table_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = served(spark, sf_dir)
    lineage = tables["state"].select("financial_year").unionByName(tables["national"].select("financial_year"))
    return serve.list_tables(tables, CATALOG, lineage)


@query(
    "row_cap_guard",
    f"""WITH {SERVED} SELECT CASE WHEN (SELECT COUNT(*) FROM served_state WHERE metric IN ('m_f', 'm_o')) > 100 THEN 'row_cap_exceeded' ELSE 'answered' END AS outcome,
    (SELECT COUNT(*) FROM served_state WHERE metric IN ('m_f', 'm_o')) AS matching""",
)
def row_cap_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request over the cap is refused while the count of its matches stays whole."""
    tables = served(spark, sf_dir)
    outcome = serve.run_query(tables, CATALOG, serve.Request("state"), row_cap=100)
    code = outcome.code if isinstance(outcome, serve.Refusal) else "answered"
    matching = tables["state"].filter(serve.predicate(serve.Request("state"), ["m_f", "m_o"], None, None))
    return matching.agg(F.count(F.lit(1)).alias("matching")).select(F.lit(code).alias("outcome"), "matching")


FILTERS_SQL = {
    "all": "TRUE", "value_is_null": "value IS NULL", "confidence == flagged-disagreement": "confidence = 'flagged-disagreement'",
    "confidence == partial-period-only": "confidence = 'partial-period-only'", "confidence == unadjudicated": "confidence = 'unadjudicated'",
    "confidence == single-publisher divergence": "confidence = 'single-publisher divergence'", "era_basis == historical": "NOT has_primary",
    "era_basis == flagship-rollup": "has_primary", "value > 1000 (implausible as a daily wage)": "value > 1000",
}


@query(
    "cohort_count",
    f"WITH {DECIDED} " + " UNION ALL ".join(
        f"SELECT '{name}' AS filter_name, COUNT(*) FILTER (WHERE {sql}) AS facts FROM facts" for name, sql in FILTERS_SQL.items()
    ),
)
def cohort_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohorts.filter_counts(facts(spark, sf_dir))


@query(
    "cohort_members",
    f"WITH {DECIDED} SELECT 'withheld' AS cohort_id, fact_id FROM facts WHERE value IS NULL",
)
def cohort_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohorts.members(facts(spark, sf_dir), "value_is_null", "withheld")


@query(
    "cohort_sources",
    f"""WITH {DECIDED} SELECT 'flagged' AS cohort_id, r.source_id, 'res-' || LOWER(RIGHT(r.source_id, 1)) || COALESCE('-' || CAST(r.span AS STRING), '') AS resource_id,
    MIN(f.fact_id) AS first_fact FROM r7 r JOIN facts f ON r.sk = f.sk AND r.fy = f.fy AND r.metric = f.metric WHERE f.confidence = 'flagged-disagreement' GROUP BY 1, 2, 3""",
)
def cohort_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, decided = sources(spark, sf_dir)
    members = cohorts.members(decided, "confidence == flagged-disagreement", "flagged")
    return cohorts.distinct_sources(members, rows).select("cohort_id", "source_id", "resource_id", F.col("first_seen.fact_id").alias("first_fact"))


@query(
    "point_figures",
    f"""WITH {DECIDED}, req AS (SELECT CAST(s_suppkey AS STRING) || '/' || y AS figure_id, s_suppkey AS sk, y FROM supplier
      JOIN (SELECT 1996 AS y UNION ALL SELECT 1999 UNION ALL SELECT 2030) t ON y > 0),
    j AS (SELECT req.figure_id, f.value, f.fact_id, f.seen FROM req LEFT JOIN facts f ON req.sk = f.sk AND req.y = f.fy AND f.metric = 'units_value')
    SELECT figure_id, CAST(value AS BIGINT) AS value, CASE WHEN value IS NOT NULL THEN fact_id END AS fact_id, CASE WHEN value IS NOT NULL THEN seen END AS source_count,
    CASE WHEN fact_id IS NULL THEN 'no row' WHEN value IS NULL THEN 'null value' END AS problem FROM j""",
)
def point_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, decided = sources(spark, sf_dir)
    asked = run(spark, sf_dir, "SELECT CAST(s_suppkey AS STRING) AS district_code, s_suppkey FROM supplier")
    years = F.array(*[F.lit(y) for y in (1996, 1999, 2030)])
    requests = asked.select("district_code", F.explode(years).alias("y")).select(
        F.concat_ws("/", "district_code", "y").alias("figure_id"), "district_code",
        F.format_string("%d-%02d", F.col("y"), (F.col("y") + 1) % 100).alias("fin_year"), F.lit("units_value").alias("metric"),
    )
    return cohorts.figures(requests, decided, rows).select("figure_id", F.col("value").cast("bigint").alias("value"), "fact_id", "source_count", "problem")


@query(
    "series_points",
    f"""WITH {DECIDED} SELECT CAST(sk AS STRING) AS district_code, fin_year, CAST(value AS BIGINT) AS value FROM facts
    WHERE metric = 'units_value' AND value IS NOT NULL AND fin_year <> '2001-02'""",
)
def series_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cohorts.series_points(facts(spark, sf_dir), "units_value", incomplete_year="2001-02", keys=("district_code",))
    return out.select("district_code", "fin_year", F.col("value").cast("bigint").alias("value"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, f"WITH {SERIES} SELECT place, fin_year, value FROM pts")


FILLED = f"""{SERIES}, span AS (SELECT place, MIN(y) AS a, MAX(y) AS b FROM pts GROUP BY 1),
  ax AS (SELECT place, UNNEST(RANGE(a, b + 1)) AS y FROM span),
  filled AS (SELECT ax.place, ax.y, {fyl('ax.y')} AS fin_year, value FROM ax LEFT JOIN pts ON ax.place = pts.place AND ax.y = pts.y)"""


@query("gap_fill", f"WITH {FILLED} SELECT place, fin_year, value FROM filled")
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return axis.fill_years(points(spark, sf_dir), ["place"])


@query(
    "withheld_spans",
    f"""WITH {FILLED}, i AS (SELECT place, y, fin_year, y - ROW_NUMBER() OVER (PARTITION BY place ORDER BY y) AS g FROM filled WHERE value IS NULL)
    SELECT place, MIN(fin_year) AS from_year, MAX(fin_year) AS to_year, COUNT(*) AS years FROM i GROUP BY place, g""",
)
def withheld_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return axis.withheld_spans(axis.fill_years(points(spark, sf_dir), ["place"]), ["place"])


@query(
    "local_minimum",
    f"""WITH {FILLED}, n AS (SELECT *, LAG(value) OVER w AS p, LEAD(value) OVER w AS q FROM filled WINDOW w AS (PARTITION BY place ORDER BY y))
    SELECT place, fin_year, value FROM n WHERE value IS NOT NULL AND (p IS NOT NULL OR q IS NOT NULL) AND (p IS NULL OR p > value) AND (q IS NULL OR q > value)""",
)
def local_minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return axis.local_minima(axis.fill_years(points(spark, sf_dir), ["place"]), ["place"])


@query(
    "counts_per_period",
    f"""WITH {DECIDED}, ax AS (SELECT DISTINCT {fyl('year(o_orderdate)')} AS fin_year FROM orders)
    SELECT ax.fin_year, COUNT(facts.fact_id) AS facts FROM ax LEFT JOIN facts ON ax.fin_year = facts.fin_year AND facts.value IS NULL GROUP BY 1""",
)
def counts_per_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = run(spark, sf_dir, f"SELECT DISTINCT {fyl('year(o_orderdate)')} AS fin_year FROM orders")
    return cohorts.counts_per_period(facts(spark, sf_dir), years, "value_is_null")


@query(
    "net_change",
    f"""WITH {DECIDED} SELECT metric, CAST(nk AS STRING) AS state_code, COUNT(*) FILTER (WHERE fin_year = '1996-97') AS first_count, COUNT(*) FILTER (WHERE fin_year = '2000-01') AS later_count,
    COUNT(*) FILTER (WHERE fin_year = '2000-01') - COUNT(*) FILTER (WHERE fin_year = '1996-97') AS net_change FROM facts GROUP BY 1, 2""",
)
def net_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohorts.net_change(facts(spark, sf_dir), "1996-97", "2000-01", ("metric", "state_code"))


# Nodes are values per customer and order status; derivations combine them in three levels, and in circles.
NODES = """nodes AS (SELECT 'c' || CAST(o_custkey AS STRING) || '.' || o_orderstatus AS id, CAST(o_custkey AS STRING) AS ck, o_orderstatus AS st,
  CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS value, COUNT(*) AS n FROM orders GROUP BY 1, 2, 3),
custs AS (SELECT DISTINCT ck FROM nodes)"""

OPS = {
    "sum": ("F", "P", "O"), "difference": ("F", "P"), "ratio": ("F", "P"), "ratio_2dp": ("F", "O"), "to_millions": ("F",),
    "to_billions": ("P",), "lakh_to_crore": ("O",), "lakh_to_lakh_crore": ("F",), "round_2dp": ("P",), "round_sigfig_3": ("O",), "cube": ("F",),
}


#: Derivations of derivations: operation and inputs. The loops wait for each other, the tail for one of them.
UPPER = {
    "second": ("ratio_2dp", ("sum/", "difference/")), "third": ("sum", ("second/", "sum/")), "over": ("sum", ("huge", "c.F")),
    "loop_a": ("sum", ("loop_b/", "c.F")), "loop_b": ("sum", ("loop_a/",)), "tail": ("round_2dp", ("loop_b/",)),
}
HUGE = 9_999_999_999_999_999


def declared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and, for every customer, eleven derivations over them and six over derivations."""
    nodes = run(spark, sf_dir, f"WITH {NODES} SELECT id, value FROM nodes UNION ALL SELECT 'huge', {HUGE}")
    people = run(spark, sf_dir, f"WITH {NODES} SELECT ck FROM custs")

    def named(text: str) -> Column:
        if text == "huge":
            return F.lit(text)
        return F.concat(F.lit(text), F.col("ck")) if text.endswith("/") else F.concat(F.lit("c"), F.col("ck"), F.lit(text[1:]))

    listed = [(op, op, [f"c.{s}" for s in inputs]) for op, inputs in OPS.items()] + [(name, op, inputs) for name, (op, inputs) in UPPER.items()]
    rows = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(op).alias("operation"), F.array(*map(named, inputs)).alias("inputs")) for name, op, inputs in listed])
    return nodes, people.select("ck", F.explode(rows).alias("d")).select(F.concat_ws("/", "d.name", "ck").alias("id"), "d.operation", "d.inputs")


_RATIO2 = "CASE WHEN ({a} < 0) <> ({b} < 0) THEN -1 ELSE 1 END * ((ABS({a}) * 200 + ABS({b})) // (2 * ABS({b})))"
DERIVED = f"""{NODES}, v AS (SELECT c.ck, f.value AS f, p.value AS p, o.value AS o FROM custs c
    LEFT JOIN nodes f ON f.ck = c.ck AND f.st = 'F' LEFT JOIN nodes p ON p.ck = c.ck AND p.st = 'P' LEFT JOIN nodes o ON o.ck = c.ck AND o.st = 'O'),
  dv AS (
    SELECT 'sum/' || ck AS id, 1 AS level, CAST((f + p + o) * 100 AS BIGINT) AS cents, f IS NULL OR p IS NULL OR o IS NULL AS lost, NULL AS other FROM v
    UNION ALL SELECT 'difference/' || ck, 1, (f - p) * 100, f IS NULL OR p IS NULL, NULL FROM v
    UNION ALL SELECT 'ratio/' || ck, 1, (f * 100) // p, f IS NULL OR p IS NULL, NULL FROM v
    UNION ALL SELECT 'ratio_2dp/' || ck, 1, {_RATIO2.format(a='f', b='o')}, f IS NULL OR o IS NULL, NULL FROM v
    UNION ALL SELECT 'to_millions/' || ck, 1, (f * 2 + 10000) // 20000, f IS NULL, NULL FROM v
    UNION ALL SELECT 'to_billions/' || ck, 1, (p * 2 + 10000000) // 20000000, p IS NULL, NULL FROM v
    UNION ALL SELECT 'lakh_to_crore/' || ck, 1, o, o IS NULL, NULL FROM v
    UNION ALL SELECT 'lakh_to_lakh_crore/' || ck, 1, (f * 2 + 100000) // 200000, f IS NULL, NULL FROM v
    UNION ALL SELECT 'round_2dp/' || ck, 1, p * 100, p IS NULL, NULL FROM v
    UNION ALL SELECT 'round_sigfig_3/' || ck, 1, CAST(CASE WHEN o < 1000 THEN o ELSE (o * 2 + CAST(POW(10, LENGTH(CAST(o AS STRING)) - 3) AS BIGINT)) // (2 * CAST(POW(10, LENGTH(CAST(o AS STRING)) - 3) AS BIGINT)) * CAST(POW(10, LENGTH(CAST(o AS STRING)) - 3) AS BIGINT) END * 100 AS BIGINT), o IS NULL, NULL FROM v
    UNION ALL SELECT 'cube/' || ck, 1, NULL, FALSE, 'unknown operation' FROM v
    UNION ALL SELECT 'second/' || ck, 2, CASE WHEN f <> p THEN {_RATIO2.format(a='(f + p + o)', b='(f - p)')} END, f IS NULL OR p IS NULL OR o IS NULL,
      CASE WHEN f = p THEN 'zero denominator' END FROM v
    UNION ALL SELECT 'third/' || ck, 3, CASE WHEN f <> p THEN {_RATIO2.format(a='(f + p + o)', b='(f - p)')} + (f + p + o) * 100 END,
      f IS NULL OR p IS NULL OR o IS NULL OR f = p, NULL FROM v
    UNION ALL SELECT 'over/' || ck, 1, NULL, f IS NULL, CASE WHEN f IS NOT NULL THEN 'out of range' END FROM v
    UNION ALL SELECT l || ck, NULL, NULL, FALSE, 'cycle' FROM v CROSS JOIN (SELECT 'loop_a/' AS l UNION ALL SELECT 'loop_b/')
    UNION ALL SELECT 'tail/' || ck, NULL, NULL, TRUE, NULL FROM v),
  derived AS (SELECT id, level, CASE WHEN NOT lost AND other IS NULL THEN CAST(cents AS BIGINT) END AS cents, CASE WHEN other IS NOT NULL THEN other WHEN lost THEN 'unknown input' END AS problem FROM dv)"""


@query("derivations", f"WITH {DERIVED} SELECT id, level, cents, problem FROM derived")
def derivations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, rows = declared(spark, sf_dir)
    out = derive.evaluate(nodes, rows)
    return out.select("id", "level", F.floor(F.col("value") * 100).cast("bigint").alias("cents"), "problem")


@query(
    "derivation_leaves",
    f"""WITH {NODES}, every AS (SELECT ck, id, st FROM nodes UNION ALL SELECT ck, 'huge', 'huge' FROM custs)
    SELECT name || '/' || ck AS id, id AS fact_id FROM every JOIN (
      {' UNION ALL '.join(f"SELECT '{name}' AS name, '{st}' AS st" for name, sts in {
          **OPS, "second": OPS["sum"], "third": OPS["sum"], "over": ("huge", "F"), "loop_a": ("F",), "loop_b": ("F",), "tail": ("F",)}.items() for st in sts)}) USING (st)""",
)
def derivation_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, rows = declared(spark, sf_dir)
    return derive.leaves(rows, nodes.select("id", F.col("id").alias("fact_id")))


