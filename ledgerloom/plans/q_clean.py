"""Queries over delivered cells: cleaning, typing, periods, names, units, dedupe, reshape, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import ids, numbers, periods, text, units
from ledgerloom.operators import dedupe, drift, normalize, reshape
from ledgerloom.plans.inputs import CELLS, PULLS, SNAPSHOTS, fyl, run
from ledgerloom.plans.registry import query
from ledgerloom.presets import CANONICAL_SCHEME, SCHEME_SPELLINGS
from ledgerloom.session import cut_lineage, scratch_path
from ledgerloom.sources import landing
from ledgerloom.streaming import pulls

NUM = "'^[+-]?[0-9]+(\\.[0-9]+)?$'"
CLEANED = f"""{CELLS}, c1 AS (SELECT *, TRIM(cell) AS body, REPLACE(TRIM(cell), ',', '') AS bare FROM cells),
c2 AS (SELECT *, CASE WHEN body IN ('', '-') OR UPPER(body) = 'NA' THEN NULL WHEN regexp_matches(bare, {NUM}) THEN bare ELSE cell END AS value,
  CASE WHEN body = '' THEN 'R2-FMT-01:blank→null' WHEN body = '-' THEN 'R2-FMT-01:dash→null' WHEN UPPER(body) = 'NA' THEN 'R2-FMT-01:NA→null'
    WHEN regexp_matches(bare, {NUM}) AND body LIKE '%,%' THEN 'R2-FMT-01:strip_commas'
    WHEN regexp_matches(bare, {NUM}) AND body <> cell THEN 'R2-FMT-01:trim' END AS note FROM c1)"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, f"WITH {CELLS} SELECT * FROM cells")


@query("fmt_clean", f"WITH {CLEANED} SELECT id, value, note FROM c2")
def fmt_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).select("id", text.clean_cell(F.col("cell")).alias("c")).select("id", "c.*")


@query(
    "type_coerce",
    f"""WITH {CLEANED}, d AS (SELECT id, value, TRY_CAST(value AS DECIMAL(28,12)) AS n FROM c2)
    SELECT id, CASE WHEN n = FLOOR(n) THEN CAST(n AS BIGINT) END AS whole,
    CASE WHEN value IS NULL THEN NULL WHEN n IS NULL OR n <> FLOOR(n) THEN 'R2-TYPE-01:coercion_failed' ELSE 'R2-TYPE-01:str→int' END AS whole_note,
    CAST(n * 100 AS BIGINT) AS hundredths,
    CASE WHEN value IS NULL THEN NULL WHEN n IS NULL THEN 'R2-TYPE-01:coercion_failed' ELSE 'R2-TYPE-01:str→decimal' END AS decimal_note FROM d""",
)
def type_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cells(spark, sf_dir).select("id", text.clean_cell(F.col("cell"))["value"].alias("v"))
    text_cell, v = F.lit("str"), F.col("v")
    typed = cleaned.select(
        "*", normalize.typed_value(v, text_cell, "int").alias("whole"), normalize.typed_value(v, text_cell, "decimal").alias("d")
    )
    return typed.select(
        "id", "whole", normalize.typed_note(v, F.col("whole"), text_cell, "int").alias("whole_note"),
        (F.col("d") * 100).cast("bigint").alias("hundredths"),
        normalize.typed_note(v, F.col("d"), text_cell, "decimal").alias("decimal_note"),
    )


# Cells of a text column as JSON delivers them: text, numbers, truth values and nulls.
DELIVERED = """delivered AS (SELECT event_id AS id, CASE WHEN event_id % 7 = 6 THEN NULL WHEN event_id % 7 IN (3, 4) THEN CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END
    WHEN event_id % 7 = 5 THEN CAST(user_id AS STRING) || '.5' ELSE CAST(user_id AS STRING) END AS cell,
  CASE event_id % 7 WHEN 0 THEN 'str' WHEN 1 THEN 'str' WHEN 2 THEN 'int' WHEN 3 THEN 'bool' WHEN 4 THEN 'bool' WHEN 5 THEN 'float' ELSE 'null' END AS kind FROM events)"""


@query(
    "text_cells",
    f"WITH {DELIVERED} SELECT id, cell AS value, CASE WHEN cell IS NOT NULL AND kind <> 'str' THEN 'R2-TYPE-01:' || kind || '→str' END AS note FROM delivered",
)
def text_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text column keeps every delivered value as text and notes the ones that weren't."""
    rows = run(spark, sf_dir, f"WITH {DELIVERED} SELECT * FROM delivered")
    cell, kind = F.col("cell"), F.col("kind")
    typed = normalize.typed_value(cell, kind, "string")
    return rows.select("id", typed.alias("value"), normalize.typed_note(cell, typed, kind, "string").alias("note"))


@query(
    "provenance",
    """SELECT event_id AS id, CASE WHEN event_type IN ('view', 'click') THEN 'PUB_A' ELSE 'PUB_B' END AS source_id, 'res-' || event_type AS resource_id, 'state+annual' AS source_grain,
    CASE WHEN event_type IN ('view', 'click') THEN 'full' ELSE 'partial' END AS pull_completeness, CASE WHEN event_type IN ('view', 'click') THEN CAST(ts AS TIMESTAMP) END AS source_as_of FROM events""",
)
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publishers' pulls, one tagged full and dated, one without either."""
    events = run(spark, sf_dir, "SELECT event_id AS id, event_type, ts FROM events")
    resource = F.concat(F.lit("res-"), "event_type")
    tagged = F.col("event_type").isin("view", "click")
    full = landing.with_provenance(events.filter(tagged), "PUB_A", resource, "state+annual", landing.FULL, F.col("ts").cast("timestamp"))
    rest = landing.with_provenance(events.filter(~tagged), "PUB_B", resource, "state+annual")
    return full.unionByName(rest).select("id", "source_id", "resource_id", "source_grain", "pull_completeness", "source_as_of")


@query(
    "fy_month",
    f"""WITH {CELLS}, p AS (SELECT id, fy_cell, month_cell, TRIM(fy_cell) AS f, LOWER(TRIM(month_cell)) AS m,
      TRY_CAST(SUBSTR(TRIM(fy_cell), 1, 4) AS INT) AS s FROM cells),
    q AS (SELECT *, CASE WHEN f IN (s || '-' || (s + 1), s || '-' || LPAD(CAST((s + 1) % 100 AS STRING), 2, '0')) AND NOT (LENGTH(f) = 7 AND (s + 1) % 100 = 0)
        THEN s || '-' || LPAD(CAST((s + 1) % 100 AS STRING), 2, '0') END AS fin_year,
      CASE WHEN m = 'april' THEN '04' WHEN m = 'sep' THEN '09' WHEN TRY_CAST(m AS INT) BETWEEN 1 AND 12 THEN LPAD(CAST(CAST(m AS INT) AS STRING), 2, '0') END AS mon FROM p)
    SELECT id, fin_year, CASE WHEN fy_cell IS NULL THEN NULL WHEN fin_year IS NULL THEN 'R2-DATE-01:parse_failed'
      WHEN fin_year <> f THEN 'R2-DATE-01:' || f || '→' || fin_year END AS fy_note,
    mon, CASE WHEN month_cell IS NULL THEN NULL WHEN mon IS NULL THEN 'R2-DATE-01:parse_failed'
      WHEN mon <> TRIM(month_cell) THEN 'R2-DATE-01:' || TRIM(month_cell) || '→' || mon END AS month_note FROM q""",
)
def fy_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = cells(spark, sf_dir).select(
        "id", periods.canonical_fy(F.col("fy_cell")).alias("f"), periods.canonical_month(F.col("month_cell")).alias("m")
    )
    return parsed.select(
        "id", F.col("f.value").alias("fin_year"), F.col("f.note").alias("fy_note"), F.col("m.value").alias("mon"),
        F.col("m.note").alias("month_note"),
    )


@query(
    "period_checks",
    f"""WITH {CELLS} SELECT id, COALESCE(regexp_matches(fy_cell, '^[0-9]{{4}}-[0-9]{{2}}$')
      AND TRY_CAST(SUBSTR(fy_cell, 6, 2) AS INT) = (TRY_CAST(SUBSTR(fy_cell, 1, 4) AS INT) + 1) % 100, FALSE) AS well_formed,
    CASE WHEN regexp_matches(fy_cell, '^[0-9]{{4}}') THEN CAST(SUBSTR(fy_cell, 1, 4) AS INT) END AS start_year,
    CASE WHEN regexp_matches(month_cell, '^(0[1-9]|1[0-2])$') THEN (CAST(month_cell AS INT) + 8) % 12 END AS position FROM cells""",
)
def period_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fy, month = F.col("fy_cell"), F.col("month_cell")
    return cells(spark, sf_dir).select(
        "id", periods.well_formed_fy(fy).alias("well_formed"), periods.fy_start(fy).alias("start_year"),
        periods.fy_position(month).alias("position"),
    )


NAMES = """names AS (SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN UPPER(p_name) || ' & ' || p_brand WHEN 1 THEN '  ' || p_name || ' (' || p_type || ')'
  WHEN 2 THEN p_name || '&' || p_brand || '.' ELSE REPLACE(p_name, ' ', '__') END AS name,
  CASE p_partkey % 5 WHEN 0 THEN 'Mahatma Gandhi NREGA' WHEN 1 THEN 'm.n.r.e.g.a.' WHEN 2 THEN p_type WHEN 3 THEN 'National Rural Employment Guarantee Act'
  ELSE CAST(NULL AS STRING) END AS scheme_label FROM part)"""


@query(
    "name_keys",
    f"""WITH {NAMES} SELECT id, TRIM(regexp_replace(REPLACE(LOWER(name), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS name_key,
    CASE WHEN regexp_replace(UPPER(scheme_label), '[^A-Z0-9]', '', 'g') IN ('MAHATMAGANDHINREGA', 'MNREGA', 'NATIONALRURALEMPLOYMENTGUARANTEEACT')
      THEN 'MGNREGA' END AS scheme FROM names""",
)
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, f"WITH {NAMES} SELECT * FROM names").select(
        "id", text.name_key(F.col("name")).alias("name_key"),
        text.canonical_scheme(F.col("scheme_label"), SCHEME_SPELLINGS, CANONICAL_SCHEME).alias("scheme"),
    )


@query("name_keys_unicode")
def name_keys_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match keys of accented text, over whole documents."""
    docs = run(spark, sf_dir, "SELECT doc_id, text FROM documents")
    key = text.name_key(F.col("text"))
    return docs.select("doc_id", F.sha2(key, 256).alias("key_digest"), F.length(key).alias("key_length"))


AMOUNTS = """amounts AS (SELECT o_orderkey AS id, CAST(o_custkey AS STRING) || CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '.5' WHEN 2 THEN '.25' ELSE '.070' END AS printed,
  CASE o_orderkey % 5 WHEN 0 THEN 'rupee' WHEN 1 THEN 'thousand' WHEN 2 THEN 'lakh' WHEN 3 THEN 'crore' ELSE 'bushel' END AS unit,
  CASE o_orderkey % 2 WHEN 0 THEN 'lakh' ELSE 'count' END AS scale, CAST(o_custkey AS BIGINT) AS n, CAST(o_orderkey % 37 AS BIGINT) AS k FROM orders)"""


@query(
    "unit_conversion",
    f"""WITH {AMOUNTS}, v AS (SELECT *, CAST(printed AS DECIMAL(18,3)) AS d FROM amounts)
    SELECT id, CASE unit WHEN 'rupee' THEN CAST(d * 1000 AS BIGINT) WHEN 'thousand' THEN CAST(d * 1000000 AS BIGINT) WHEN 'lakh' THEN CAST(d * 100000000 AS BIGINT)
      WHEN 'crore' THEN CAST(d * 10000000000 AS BIGINT) END AS lakh_e8,
    CASE WHEN unit IN ('rupee', 'thousand', 'crore') THEN 'R4-UNIT-01:' || unit || '→lakh' END AS money_note,
    CAST(CASE scale WHEN 'lakh' THEN d * 100000 ELSE d END * 1000 AS BIGINT) AS count_e3,
    CASE scale WHEN 'lakh' THEN 'R4-UNIT-01:lakh→count' END AS count_note,
    CAST(50000 / CASE LENGTH(printed) - LENGTH(CAST(n AS STRING)) WHEN 0 THEN 1 ELSE POW(10, LENGTH(printed) - LENGTH(CAST(n AS STRING)) - 1) END AS BIGINT) AS epsilon
    FROM v""",
)
def unit_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = run(spark, sf_dir, f"WITH {AMOUNTS} SELECT * FROM amounts").withColumn("d", numbers.to_decimal(F.col("printed")))
    money, count = units.money_in_lakh(F.col("d"), F.col("unit")), units.raw_count(F.col("d"), F.col("scale"))
    return df.select("id", "printed", money.alias("m"), count.alias("c")).select(
        "id", (F.col("m.value") * 100000000).cast("bigint").alias("lakh_e8"), F.col("m.note").alias("money_note"),
        (F.col("c.value") * 1000).cast("bigint").alias("count_e3"), F.col("c.note").alias("count_note"),
        numbers.printed_step(F.col("printed")).cast("bigint").alias("epsilon"),
    )


@query(
    "number_renderings",
    f"""WITH {AMOUNTS}, v AS (SELECT id, CASE WHEN printed LIKE '%.%' THEN RTRIM(printed, '0') ELSE printed END AS plain, n * 1000003 AS big FROM amounts)
    SELECT id, plain, CAST(big AS STRING) AS big_plain, REGEXP_REPLACE(FORMAT('{{:,}}', big), '^$', '') AS big_grouped FROM v""",
)
def number_renderings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = run(spark, sf_dir, f"WITH {AMOUNTS} SELECT id, printed, n * 1000003 AS big FROM amounts")
    big = F.col("big").cast(numbers.MONEY)
    return df.select(
        "id", text.plain_number(numbers.to_decimal(F.col("printed"))).alias("plain"), text.plain_number(big).alias("big_plain"),
        text.grouped_number(big).alias("big_grouped"),
    )


@query(
    "percent_gaps",
    f"""WITH {AMOUNTS} SELECT id, CASE WHEN n = k THEN 0 WHEN n = 0 THEN CAST(k AS DOUBLE) * 100 ELSE ROUND(CAST(ABS(n - k) AS DOUBLE) * 100 / n, 6) END AS pct,
    (n = k OR ABS(n - k) * 1000 <= CASE WHEN n = 0 THEN 5 ELSE 5 * n END OR ABS(n - k) <= 3) AS agreed,
    (n <> 0 AND k <> 0 AND (ABS(n - 10 * k) * 200 <= n OR ABS(n - 100 * k) * 200 <= n OR ABS(n - 1000 * k) * 200 <= n
      OR ABS(10 * n - k) * 200 <= 10 * n OR ABS(100 * n - k) * 200 <= 100 * n OR ABS(1000 * n - k) * 200 <= 1000 * n)) AS off_by_digits FROM amounts""",
)
def percent_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = run(spark, sf_dir, f"WITH {AMOUNTS} SELECT id, CAST(n AS DECIMAL(28,12)) AS n, CAST(k AS DECIMAL(28,12)) AS k, 3BD AS e, 5BD AS band FROM amounts")
    return df.select(
        "id", F.round(numbers.percent_gap(F.col("n"), F.col("k")), 6).alias("pct"),
        F.expr(numbers.agrees("n", "e", "k", "e", "band")).alias("agreed"),
        F.expr(numbers.off_by_power_of_ten("k", "n")).alias("off_by_digits"),
    )


@query(
    "fact_ids",
    f"""SELECT o_orderkey AS id, SUBSTR(SHA256('DEMO|state|' || CAST(o_custkey AS STRING) || '||' || {fyl('year(o_orderdate)')} || '||' || o_orderpriority), 1, 16) AS fact_id FROM orders""",
)
def fact_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = run(
        spark, sf_dir,
        f"""SELECT o_orderkey AS id, 'DEMO' AS scheme, 'state' AS geo_level, CAST(o_custkey AS STRING) AS state_code, CAST(NULL AS STRING) AS district_code,
        {fyl('year(o_orderdate)')} AS fin_year, CAST(NULL AS STRING) AS month, o_orderpriority AS metric FROM orders""",
    )
    return keyed.select("id", ids.fact_id().alias("fact_id"))


GRAIN = ["user_key", "type_key"]
WINNERS = f"""{SNAPSHOTS}, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_key, type_key ORDER BY COALESCE(as_of, -1) DESC, row_index DESC) AS rn
  FROM snapshots WHERE user_key IS NOT NULL OR type_key IS NOT NULL)"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, f"WITH {SNAPSHOTS} SELECT * FROM snapshots")


@query(
    "snapshot_dedupe",
    f"""WITH {WINNERS}, n AS (SELECT user_key, type_key, COUNT(*) AS copies FROM ranked GROUP BY 1, 2)
    SELECT r.row_index, r.user_key, r.type_key, r.as_of, r.cents, n.copies FROM ranked r JOIN n ON r.user_key IS NOT DISTINCT FROM n.user_key
    AND r.type_key IS NOT DISTINCT FROM n.type_key WHERE rn = 1""",
)
def snapshot_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.survivors(snapshots(spark, sf_dir), GRAIN, as_of="as_of")


@query("dedupe_collapsed", f"WITH {WINNERS} SELECT row_index FROM ranked WHERE rn > 1")
def dedupe_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots(spark, sf_dir)
    return dedupe.collapsed(rows, dedupe.survivors(rows, GRAIN, as_of="as_of"), GRAIN).select("row_index")


@query(
    "dedupe_summary",
    f"""WITH {WINNERS} SELECT COUNT(*) FILTER (WHERE rn > 1) AS duplicates_collapsed, COUNT(*) FILTER (WHERE rn = 1) AS survivors,
    'R2-DEDUP-TB-01' AS tie_break_rule_id FROM ranked""",
)
def dedupe_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.summary(dedupe.survivors(snapshots(spark, sf_dir), GRAIN, as_of="as_of"))


@query(
    "dedupe_quarantine",
    f"WITH {SNAPSHOTS} SELECT row_index, 'missing_grain_key' AS reason FROM snapshots WHERE user_key IS NULL AND type_key IS NULL",
)
def dedupe_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.without_key(snapshots(spark, sf_dir), GRAIN).select("row_index", "reason")


YEARS = range(1995, 2003)
WIDE = f"""wide AS (SELECT CAST(o_custkey AS BIGINT) AS row_index, CAST(o_custkey AS STRING) AS cust, {', '.join(
    f"SUM(CASE WHEN year(o_orderdate) = {y} THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END) AS _{y}_{(y + 1) % 100:02d}" for y in YEARS)}
  FROM orders GROUP BY o_custkey)"""


@query(
    "melt_simple",
    f"WITH {WIDE} " + " UNION ALL ".join(
        f"SELECT row_index * 8 + {i} AS row_index, cust, '{y}-{(y + 1) % 100:02d}' AS _fin_year, CAST(_{y}_{(y + 1) % 100:02d} AS BIGINT) AS _value FROM wide"
        for i, y in enumerate(YEARS)
    ),
)
def melt_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = run(spark, sf_dir, f"WITH {WIDE} SELECT * FROM wide")
    spec = reshape.ReshapeSpec("simple", ("cust",), tuple(c for c in wide.columns if c.startswith("_")))
    return reshape.reshape(wide, spec)


COMPOUND = """compound AS (SELECT CAST(o_custkey AS BIGINT) AS row_index, CAST(o_custkey AS STRING) AS cust,
  COUNT(*) AS orders_placed___1996_97, COUNT(DISTINCT o_orderstatus) AS order_states___1996_97_p_,
  SUM(CAST(ROUND(o_totalprice) AS BIGINT)) AS order_value___1997_1998_upto_30_09_1997 FROM orders GROUP BY o_custkey)"""


@query(
    "melt_compound",
    f"""WITH {COMPOUND} SELECT row_index * 3 AS row_index, cust, 'orders_placed' AS _metric, '1996-97' AS _fin_year, CAST(orders_placed___1996_97 AS BIGINT) AS _value, NULL AS _period_qualifier, 'North' AS _state FROM compound
    UNION ALL SELECT row_index * 3 + 1, cust, 'order_states', '1996-97', order_states___1996_97_p_, NULL, 'North' FROM compound
    UNION ALL SELECT row_index * 3 + 2, cust, 'order_value', '1997-1998', CAST(order_value___1997_1998_upto_30_09_1997 AS BIGINT), 'upto 30 09 1997', 'North' FROM compound""",
)
def melt_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = run(spark, sf_dir, f"WITH {COMPOUND} SELECT * FROM compound")
    return reshape.reshape(wide, reshape.ReshapeSpec("compound", ("cust",), inject_state="North"))


HEADERS = """headers AS (SELECT p_partkey AS id, REPLACE(p_name, ' ', '_') || '___' || CASE p_partkey % 4 WHEN 0 THEN '2015_16' WHEN 1 THEN '2011-2012'
  WHEN 2 THEN 'total' ELSE '1999_00' END || CASE p_partkey % 3 WHEN 0 THEN '_upto_30_09_2015' WHEN 1 THEN '_p_' ELSE '' END AS header FROM part)"""


@query(
    "header_parse",
    f"""WITH {HEADERS}, t AS (SELECT *, regexp_extract(header, '^(.*?)((?:19|20)[0-9]{{2}}[-_][0-9]{{2,4}})(.*)$', 1) AS a,
      regexp_extract(header, '^(.*?)((?:19|20)[0-9]{{2}}[-_][0-9]{{2,4}})(.*)$', 2) AS b,
      regexp_extract(header, '^(.*?)((?:19|20)[0-9]{{2}}[-_][0-9]{{2,4}})(.*)$', 3) AS c FROM headers)
    SELECT id, CASE WHEN b <> '' THEN TRIM(a, '_ ') END AS stem, CASE WHEN b <> '' THEN REPLACE(b, '_', '-') END AS fin_year,
    CASE WHEN b <> '' AND TRIM(c, '_ ') LIKE 'upto%' THEN REPLACE(TRIM(c, '_ '), '_', ' ') END AS qualifier FROM t""",
)
def header_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = run(spark, sf_dir, f"WITH {HEADERS} SELECT * FROM headers")
    return df.select("id", reshape.header_columns(F.col("header")).alias("h")).select("id", "h.*")


FINGERPRINT = "'sha256:' || SHA256(ARRAY_TO_STRING({0}, CHR(10)))"


DRIFT = f"""WITH {PULLS}, p AS (SELECT source_id, pull_seq, completeness, LIST_SORT(LIST(DISTINCT column_name)) AS cols FROM pull_columns GROUP BY 1, 2, 3),
    b AS (SELECT *, LAST_VALUE(CASE WHEN completeness = 'full' THEN cols END IGNORE NULLS) OVER w AS full_cols, FIRST_VALUE(cols) OVER w AS first_cols,
      ROW_NUMBER() OVER (PARTITION BY source_id ORDER BY pull_seq) AS rn FROM p
      WINDOW w AS (PARTITION BY source_id ORDER BY pull_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    c AS (SELECT *, COALESCE(full_cols, first_cols) AS base, full_cols IS NOT NULL AND completeness = 'full' AS cmp FROM b),
    d AS (SELECT *, CASE WHEN cmp AND rn > 1 THEN [x FOR x IN cols IF NOT LIST_CONTAINS(base, x)] ELSE [] END AS added,
      CASE WHEN cmp AND rn > 1 THEN [x FOR x IN base IF NOT LIST_CONTAINS(cols, x)] ELSE [] END AS removed FROM c)
    SELECT source_id, pull_seq, completeness, CASE WHEN rn > 1 THEN {FINGERPRINT.format('base')} END AS previous_version, {FINGERPRINT.format('cols')} AS new_version,
    LEN(added) + LEN(removed) > 0 AS detected, rn = 1 OR cmp AS comparable, ARRAY_TO_STRING(added, ',') AS added, ARRAY_TO_STRING(removed, ',') AS removed FROM d"""


def recorded_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, f"WITH {PULLS} SELECT * FROM pull_columns").groupBy("source_id", "pull_seq", "completeness").agg(
        F.collect_set("column_name").alias("columns")
    )


def _listed(found: DataFrame) -> DataFrame:
    return found.withColumns({"added": F.array_join("added", ","), "removed": F.array_join("removed", ",")})


@query("drift_ledger", DRIFT)
def drift_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(drift.ledger(recorded_pulls(spark, sf_dir), chunk=7))


@query("drift_stream", DRIFT)
def drift_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pulls, arriving in three runs of the stream that each go on from the last one's baselines."""
    folder = scratch_path(spark, "pulls")
    recorded = cut_lineage(recorded_pulls(spark, sf_dir), "recorded")
    third = F.floor((F.col("pull_seq") - 1) / 11)
    for part in range(3):
        recorded.filter(third == part).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(pulls.PULLS).parquet(f"{folder}/in")
        pulls.follow_pulls(stream, f"{folder}/baselines", f"{folder}/findings", f"{folder}/progress").awaitTermination()
    return _listed(spark.read.parquet(f"{folder}/findings").drop("batch"))


RAW = """raw_rows AS (SELECT event_id AS row_index, event_type AS resource_id, CASE event_id % 12
    WHEN 0 THEN '{}' WHEN 1 THEN '[1, 2]' WHEN 2 THEN '{"state":"Total","v":"1"}' WHEN 3 THEN '{"state":"x","v":{"a":1}}'
    WHEN 4 THEN '{"v":' || CAST(event_id AS STRING) || ',"extra":true}' WHEN 5 THEN 'null'
    ELSE '{"state":"' || event_type || '","v":"' || CAST(user_id AS STRING) || '"}' END AS raw FROM events)"""


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, f"WITH {RAW} SELECT * FROM raw_rows")


@query(
    "land_classify",
    """SELECT event_id AS row_index, CASE event_id % 12 WHEN 0 THEN 'empty_row' WHEN 1 THEN 'malformed_row' WHEN 2 THEN 'synthetic_total_row'
    WHEN 3 THEN 'malformed_row' WHEN 5 THEN 'malformed_row' END AS reason,
    CASE event_id % 12 WHEN 4 THEN CAST(event_id AS STRING) WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN '1' WHEN 3 THEN '{"a":1}' WHEN 5 THEN NULL
      ELSE CAST(user_id AS STRING) END AS v,
    CASE event_id % 12 WHEN 4 THEN 'int' WHEN 3 THEN 'nested' WHEN 0 THEN 'null' WHEN 1 THEN 'null' WHEN 5 THEN 'null' ELSE 'str' END AS v_type FROM events""",
)
def land_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landing.classify_rows(raw_rows(spark, sf_dir), landing.TotalRow("state"))
    return rows.select("row_index", "reason", landing.cell_value("v").alias("v"), landing.cell_type("v").alias("v_type"))


@query(
    "observed_columns",
    """WITH k AS (SELECT event_type AS resource_id, event_id AS row_index, event_id % 12 AS m FROM events),
    e AS (SELECT resource_id, row_index, 0 AS pos, CASE WHEN m = 4 THEN 'v' ELSE 'state' END AS column_name FROM k WHERE m NOT IN (0, 1, 5)
      UNION ALL SELECT resource_id, row_index, 1, CASE WHEN m = 4 THEN 'extra' ELSE 'v' END FROM k WHERE m NOT IN (0, 1, 5)),
    c AS (SELECT resource_id, column_name, MIN(row_index * 10 + pos) AS f FROM e GROUP BY 1, 2)
    SELECT resource_id, STRING_AGG(column_name, ',' ORDER BY f) AS columns, 'sha256:' || SHA256(STRING_AGG(column_name, CHR(10) ORDER BY column_name)) AS schema_version
    FROM c GROUP BY 1""",
)
def observed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = landing.observed_columns(raw_rows(spark, sf_dir), ("resource_id",))
    ordered = F.array_sort(F.collect_list(F.struct("first_seen", "column_name")))
    return seen.groupBy("resource_id").agg(
        F.array_join(F.transform(ordered, lambda c: c["column_name"]), ",").alias("columns"),
        landing.fingerprint_of(F.collect_set("column_name")).alias("schema_version"),
    )


STAGE = """stage AS (SELECT o_orderkey AS row_index, '{"cust":"' || CAST(o_custkey AS STRING) || '","fin_year":"' || CAST(year(o_orderdate) AS STRING) || '-' ||
    CAST(year(o_orderdate) + 1 AS STRING) || '","month":"' || CAST(month(o_orderdate) AS STRING) || '","amount":' ||
    CASE o_orderkey % 4 WHEN 0 THEN '"1,' || LPAD(CAST(o_custkey % 1000 AS STRING), 3, '0') || '"' WHEN 1 THEN CAST(o_custkey AS STRING) WHEN 2 THEN '"NA"' ELSE '"1.2.3"' END || '}' AS raw,
    CAST(o_custkey AS STRING) AS cust, year(o_orderdate) AS y, month(o_orderdate) AS mo, o_orderkey % 4 AS kind FROM orders)"""


@query(
    "normalize_stage",
    f"""WITH {STAGE}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cust, y, mo ORDER BY row_index DESC) AS rn FROM stage)
    SELECT row_index, cust, y || '-' || LPAD(CAST((y + 1) % 100 AS STRING), 2, '0') AS fin_year, LPAD(CAST(mo AS STRING), 2, '0') AS month,
    CASE kind WHEN 0 THEN 1000 + CAST(cust AS INT) % 1000 WHEN 1 THEN CAST(cust AS INT) END AS amount,
    CASE kind WHEN 0 THEN 'R2-FMT-01:strip_commas|R2-TYPE-01:str→int' WHEN 2 THEN 'R2-FMT-01:NA→null' WHEN 3 THEN 'R2-TYPE-01:coercion_failed' END AS amount_notes FROM r WHERE rn = 1""",
)
def normalize_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = run(spark, sf_dir, f"WITH {STAGE} SELECT row_index, raw FROM stage")
    rows = landing.landed(landing.classify_rows(raw))
    names = ["cust", "fin_year", "month", "amount"]
    config = normalize.NormalizeConfig(("cust", "fin_year", "month"), {"fin_year": "fy", "month": "month", "amount": "int"})
    out = normalize.normalize(normalize.delivered_columns(rows, names), config).rows
    return out.select("row_index", *names, F.array_join(F.try_element_at("notes", F.lit("amount")), "|").alias("amount_notes"))
