"""Queries over names and column stems: resolution with quarantine, rule-mapped extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import conserve, extract, resolve
from ledgerloom.plans.inputs import PLACES, STEMS, fyl, run
from ledgerloom.plans.registry import query
from ledgerloom.presets import FINANCIAL_OUTCOMES, NATIONAL_IMPLEMENTATION, STATE_IMPLEMENTATION

SPELLINGS, CANONICAL = ("DEMO", "DEMOSCHEME"), "DEMO"
RULES = (*FINANCIAL_OUTCOMES, *STATE_IMPLEMENTATION)


def _key(name: str) -> str:
    return f"TRIM(regexp_replace(REPLACE(LOWER({name}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def _quoted(name: str) -> str:
    return f"COALESCE('''' || {name} || '''', 'None')"


RESOLVED = f"""{PLACES},
p AS (SELECT *, {_key('state_label')} AS sk, {_key('district_label')} AS dk, {fyl('yr')} AS fin_year FROM places),
s1 AS (SELECT p.*, COALESCE(e.code, t.code) AS s_code, COALESCE(e.name, t.name) AS s_name,
    CASE WHEN e.code IS NOT NULL THEN 'R3-GEO-02' WHEN t.code IS NOT NULL THEN 'R3-GEO-03:' || p.sk END AS s_rule,
    CASE WHEN e.code IS NULL AND t.code IS NOT NULL THEN a.valid_from END AS s_from, h.text AS s_past
  FROM p LEFT JOIN states e ON {_key('e.name')} = p.sk LEFT JOIN state_aliases a ON a.name_key = p.sk
    LEFT JOIN states t ON {_key('t.name')} = {_key('a.target')}
    LEFT JOIN past h ON h.state_code IS NULL AND h.name_key = p.sk),
s2 AS (SELECT s1.*, COALESCE(e.code, t.code) AS d_code, COALESCE(e.name, t.name) AS d_name,
    CASE WHEN e.code IS NOT NULL THEN 'R3-GEO-02' WHEN t.code IS NOT NULL THEN 'R3-GEO-03:' || dk END AS d_rule, h.text AS d_past, c.text AS d_note
  FROM s1 LEFT JOIN districts e ON e.state_code = s_code AND {_key('e.name')} = dk
    LEFT JOIN district_aliases a ON a.state_code = s_code AND a.name_key = dk
    LEFT JOIN districts t ON t.state_code = s_code AND {_key('t.name')} = {_key('a.target')}
    LEFT JOIN past h ON h.state_code = s_code AND h.name_key = dk LEFT JOIN curated c ON c.state_code = s_code AND c.name_key = dk),
s3 AS (SELECT *, CASE WHEN s_code IS NULL THEN CASE WHEN s_past IS NOT NULL THEN 'historical_geography_not_in_current_lgd' ELSE 'unresolved_geography' END
    WHEN s_from IS NOT NULL AND yr < s_from THEN 'historical_geography_not_in_current_lgd' END AS s_reason FROM s2),
r AS (SELECT *, CASE WHEN s_reason IS NOT NULL THEN s_reason WHEN d_code IS NULL THEN CASE WHEN d_past IS NOT NULL
    THEN 'historical_geography_not_in_current_lgd' ELSE 'unresolved_geography' END END AS reason,
    CASE WHEN s_code IS NULL THEN 'state:' || {_quoted('state_label')} || COALESCE(' — ' || s_past, '')
      WHEN s_reason IS NOT NULL THEN 'state:' || {_quoted('state_label')} || ' — name not valid before FY start ' || CAST(s_from AS STRING) || ' (row: ' || CAST(yr AS STRING) || ')'
      WHEN d_code IS NULL THEN 'district:' || {_quoted('district_label')} || ' in state ' || s_name || '(' || s_code || ')' || COALESCE(' — ' || COALESCE(d_past, d_note), '') END AS detail FROM s3)
"""


def placed(spark: SparkSession, sf_dir: str, level: str = "district") -> DataFrame:
    def part(name: str) -> DataFrame:
        return run(spark, sf_dir, f"WITH {PLACES} SELECT * FROM {name}")

    states = resolve.lookup(part("states"), part("state_aliases"), [])
    districts = resolve.lookup(part("districts"), part("district_aliases"), ["state_code"])
    rows = run(spark, sf_dir, f"WITH {PLACES} SELECT *, {fyl('yr')} AS _fin_year FROM places")
    config = resolve.GeoConfig(
        level, "Demo Scheme", state_name="state_label", district_name="district_label" if level == "district" else None
    )
    return resolve.resolve(rows, config, SPELLINGS, CANONICAL, states, districts, part("past"), part("curated"))


@query(
    "resolve_geo",
    f"""WITH {RESOLVED} SELECT row_index, s_code AS state_code, s_name AS state_name, d_code AS district_code, d_name AS district_name,
    s_rule AS state_rule, d_rule AS district_rule FROM r WHERE reason IS NULL""",
)
def resolve_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolved(placed(spark, sf_dir)).select(
        "row_index", "state_code", F.col("state_name_canonical").alias("state_name"), "district_code",
        F.col("district_name_canonical").alias("district_name"), F.col("geo_resolution.state.rule_id").alias("state_rule"),
        F.col("geo_resolution.district.rule_id").alias("district_rule"),
    )


@query("resolve_quarantine", f"WITH {RESOLVED} SELECT row_index, reason, detail FROM r WHERE reason IS NOT NULL")
def resolve_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.quarantined(placed(spark, sf_dir)).select("row_index", "reason", "detail")


@query(
    "resolve_period_gate",
    f"""WITH {RESOLVED} SELECT row_index, s_reason IS NULL AS resolved, CASE WHEN s_reason IS NULL THEN s_code END AS state_code FROM r WHERE sk LIKE 'merged %'""",
)
def resolve_period_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State level only: a name that is valid from a year on."""
    rows = placed(spark, sf_dir, "state")
    return rows.filter(F.col("state_label").startswith("merged-")).select(
        "row_index", F.col("reason").isNull().alias("resolved"), "state_code"
    )


@query(
    "row_conservation",
    f"""WITH {RESOLVED} SELECT nk AS resource_id, COUNT(*) AS rows_in, COUNT(*) AS rows_out, TRUE AS conserved FROM r GROUP BY nk""",
)
def row_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = placed(spark, sf_dir)
    before = run(spark, sf_dir, f"WITH {PLACES} SELECT nk AS resource_id FROM places")
    named = rows.withColumnRenamed("nk", "resource_id")
    return conserve.row_conservation(before, [resolve.resolved(named), resolve.quarantined(named)], "resource_id")


@query(
    "resource_status",
    f"""WITH {RESOLVED} SELECT ck AS resource_id, CASE WHEN BOOL_OR(reason IS NULL) THEN 'resolved' ELSE 'deferred' END AS status,
    CASE WHEN NOT BOOL_OR(reason IS NULL) THEN MIN(reason) END AS deferred_reason FROM r GROUP BY ck""",
)
def resource_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resource none of whose rows resolves is deferred with a reason; the rest is wired."""
    per = placed(spark, sf_dir).groupBy(F.col("ck").alias("resource_id")).agg(
        F.count_if(F.col("reason").isNull()).alias("good"), F.min("reason").alias("deferred_reason")
    )
    return conserve.resource_status(per.filter("good > 0"), per.filter("good = 0"))


@query(
    "dataset_partition",
    """WITH c AS (SELECT c_custkey AS resource_id, COUNT(o_orderkey) AS n, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS pn
      FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)
    SELECT resource_id, CASE WHEN n = 0 THEN 'in no part' ELSE 'in several parts' END AS problem FROM c WHERE n = 0 OR (pn > 0 AND n > pn)""",
)
def dataset_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = run(spark, sf_dir, "SELECT c_custkey AS resource_id FROM customer")
    pending = run(spark, sf_dir, "SELECT o_custkey AS resource_id FROM orders WHERE o_orderstatus = 'P'")
    other = run(spark, sf_dir, "SELECT o_custkey AS resource_id FROM orders WHERE o_orderstatus <> 'P'")
    return conserve.partition_problems(manifest, {"wired": other, "deferred": pending}, "resource_id")


EXCLUDED = "(?i)%|percentage|central release|funds available|- scs|- sts|- others|- women|average|beneficiary|demanded|not paid|rejection|allotted|registered|wage rate|per personday"
EXTRACTED = f"""{STEMS},
n AS (SELECT *, TRY_CAST(cell AS DECIMAL(18,3)) AS num FROM stems WHERE qualifier IS NULL),
x AS (SELECT *, CASE WHEN stem IS NULL THEN 'persondays_generated' WHEN regexp_matches(stem, '{EXCLUDED}') THEN NULL
    WHEN regexp_matches(stem, '(?i)expenditure on.*wages') THEN 'wages_expenditure' WHEN regexp_matches(stem, '(?i)expenditure on.*material') THEN 'material_skilled_expenditure'
    WHEN regexp_matches(stem, '(?i)expenditure on.*admin') THEN 'admin_expenditure' WHEN regexp_matches(stem, '(?i)expenditure on.*total') THEN 'total_expenditure'
    WHEN regexp_matches(stem, '(?i)households provided employment') THEN 'households_employed'
    WHEN regexp_matches(stem, '(?i)persondays[ (_]*in[ _]*lakhs.*total') THEN 'persondays_generated' END AS metric FROM n),
ob AS (SELECT row_index, resource_id, state_code, fin_year, metric, CAST(CASE metric WHEN 'persondays_generated' THEN num * 100000 ELSE num END * 1000 AS BIGINT) AS value_e3,
    CASE metric WHEN 'persondays_generated' THEN 'lakh' WHEN 'households_employed' THEN 'count' ELSE 'lakh' END AS original_unit,
    CASE WHEN metric = 'persondays_generated' THEN CAST(50000 / POW(10, CASE WHEN cell LIKE '%.%' THEN LENGTH(cell) - INSTR(cell, '.') ELSE 0 END) AS BIGINT) ELSE 0 END AS epsilon
  FROM x WHERE metric IS NOT NULL AND num IS NOT NULL)"""


def extracted(spark: SparkSession, sf_dir: str, editions: bool = False) -> DataFrame:
    rows = run(spark, sf_dir, f"WITH {STEMS} SELECT * FROM stems").select(
        "row_index", "resource_id", "state_code", F.lit("DEMO").alias("scheme"), F.lit("PUB").alias("source_id"),
        F.lit(None).cast("timestamp").alias("source_as_of"), F.col("stem").alias("_metric"), F.col("fin_year").alias("_fin_year"),
        F.col("cell").alias("_value"), F.col("qualifier").alias("_period_qualifier"),
    )
    return extract.extract_long(rows, RULES, 10, implicit=("persondays_generated", "count_lakh"), edition_family=editions)


@query("rule_extract", f"WITH {EXTRACTED} SELECT row_index AS seq, state_code, fin_year, metric, value_e3, original_unit, epsilon FROM ob")
def rule_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark, sf_dir).select(
        "seq", "state_code", "fin_year", "metric", (F.col("value") * 1000).cast("bigint").alias("value_e3"), "original_unit",
        F.col("rounding_epsilon").cast("bigint").alias("epsilon"),
    )


@query(
    "edition_markers",
    f"""WITH {EXTRACTED} SELECT row_index AS seq, resource_id, MAX(fin_year) OVER (PARTITION BY resource_id) AS edition_span_end,
    fin_year = MAX(fin_year) OVER (PARTITION BY resource_id) AS is_edition_terminal FROM ob""",
)
def edition_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark, sf_dir, editions=True).select("seq", "resource_id", "edition_span_end", "is_edition_terminal")


WIDE = f"""wide AS (SELECT CAST(year(o_orderdate) * 100 + CAST(o_custkey % 100 AS INT) AS BIGINT) AS row_index, {fyl('year(o_orderdate)')} AS fin_year,
  COUNT(*) AS households_provided_employment, COUNT(DISTINCT o_custkey) AS availed_100_days, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS availed_100_days_upto_sep,
  COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS persondays_in_lakhs___total, COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS average_persondays_in_lakhs_total
  FROM orders GROUP BY 1, 2)"""


@query(
    "rule_extract_wide",
    f"""WITH {WIDE} SELECT row_index * 3 AS seq, fin_year, 'households_employed' AS metric, households_provided_employment AS value, 0 AS epsilon FROM wide
    UNION ALL SELECT row_index * 3 + 1, fin_year, 'households_completed_100_days', availed_100_days, 0 FROM wide
    UNION ALL SELECT row_index * 3 + 2, fin_year, 'persondays_generated', persondays_in_lakhs___total * 100000, 50000 FROM wide""",
)
def rule_extract_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = run(spark, sf_dir, f"WITH {WIDE} SELECT * FROM wide")
    out = extract.extract_wide(wide, NATIONAL_IMPLEMENTATION, "fin_year", 10, wide.columns[2:])
    return out.select("seq", "fin_year", "metric", F.col("value").cast("bigint").alias("value"), F.col("rounding_epsilon").cast("bigint").alias("epsilon"))


@query(
    "fixed_unit_extract",
    """SELECT o_orderkey AS seq, CAST(o_custkey AS STRING) AS state_code, CAST(o_custkey AS BIGINT) * 100000 AS value, 500 AS epsilon, 1 AS authority_rank
    FROM orders WHERE o_orderkey % 5 <> 0""",
)
def fixed_unit_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in lakh to two decimals: one implicit metric, every rounding step ±500."""
    rows = run(
        spark, sf_dir,
        f"""SELECT CAST(o_orderkey AS BIGINT) AS row_index, CAST(o_custkey AS STRING) AS state_code, {fyl('year(o_orderdate)')} AS _fin_year,
        CASE WHEN o_orderkey % 5 = 0 THEN 'n.a.' ELSE CAST(o_custkey AS STRING) || '.00' END AS _value FROM orders""",
    )
    out = extract.extract_long(rows, (), 1, implicit=("persondays_generated", "count_lakh"))
    return out.select(
        "seq", "state_code", F.col("value").cast("bigint").alias("value"), F.col("rounding_epsilon").cast("bigint").alias("epsilon"), "authority_rank"
    )


@query(
    "source_union",
    """SELECT 'first' AS source_id, CAST(o_orderkey AS BIGINT) AS seq, CAST(o_custkey AS BIGINT) AS value FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'second', CAST(o_orderkey AS BIGINT) + 1099511627776, CAST(o_custkey AS BIGINT) FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'third', CAST(o_orderkey AS BIGINT) + 2 * 1099511627776, CAST(o_custkey AS BIGINT) FROM orders WHERE o_orderstatus NOT IN ('F', 'P')""",
)
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(name: str, status: str) -> DataFrame:
        return run(
            spark, sf_dir,
            f"SELECT '{name}' AS source_id, CAST(o_orderkey AS BIGINT) AS seq, CAST(o_custkey AS BIGINT) AS value FROM orders WHERE o_orderstatus {status}",
        )

    out = extract.union_sources([part("first", "= 'F'"), part("second", "= 'P'"), part("third", "NOT IN ('F', 'P')")])
    return out.select("source_id", "seq", F.col("value").cast("bigint").alias("value"))
