"""Operator inputs derived from the driver's tables, as SQL text that Spark and DuckDB both read.

Every text below is a chain of common table expressions. A query selects from the last of them; the
oracle of the query continues the same chain. All of them scan the whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.periods import fy_label
from ledgerloom.operators.extract import as_observations
from ledgerloom.presets import CorpusPolicy, MetricPolicy

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


_OPENED: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema and file list are read once per session."""
    session = spark._jsparkSession.sessionUUID()
    key = (f"{spark.sparkContext.applicationId}/{session}", f"{sf_dir}/{name}.parquet")
    if key not in _OPENED:
        _OPENED[key] = spark.read.parquet(key[1])
    return _OPENED[key]


def run(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    """Run ``statement`` with the driver's tables it names as views."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", statement):
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(statement)


def fyl(start: str) -> str:
    """SQL for the label of the financial year that starts in ``start``."""
    return f"(CAST({start} AS STRING) || '-' || LPAD(CAST(({start} + 1) % 100 AS STRING), 2, '0'))"


FY_OF_SHIP = "CASE WHEN month(l.l_shipdate) >= 4 THEN year(l.l_shipdate) ELSE year(l.l_shipdate) - 1 END"

# Readings of four publishers per supplier, year and metric. The suppliers' sums are the truth; the
# publishers deviate in ways that reach every reconciliation rule.
OBS = f"""
base AS (
  SELECT s.s_nationkey AS nk, l.l_suppkey AS sk, {FY_OF_SHIP} AS fy, SUM(CAST(l.l_quantity AS BIGINT)) AS q
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY 1, 2, 3),
m AS (
  SELECT nk, sk, fy, 'units_shipped' AS metric, CASE WHEN sk % 13 = 5 THEN -100 ELSE 100 END * q AS v,
         (sk * 31 + fy * 17) % 16 AS h FROM base
  UNION ALL
  SELECT nk, sk, fy, 'units_value' AS metric, CASE WHEN sk % 13 = 5 THEN -100 ELSE 100 END * q AS v,
         (sk * 13 + fy * 7) % 16 AS h FROM base),
pubs AS (
  SELECT 'PUB_A' AS source_id, 1 AS seq, 0 AS rnk, CAST(NULL AS INT) AS span
  UNION ALL SELECT 'PUB_B', 2, 10, NULL UNION ALL SELECT 'PUB_C', 4, 10, 1996 UNION ALL SELECT 'PUB_C', 5, 10, 1997
  UNION ALL SELECT 'PUB_C', 6, 10, 1998 UNION ALL SELECT 'PUB_D', 9, 11, NULL UNION ALL SELECT 'PUB_D', 10, 11, NULL),
obs AS (
  SELECT m.nk, m.sk, m.fy, m.metric, p.seq, p.source_id,
         CAST(FLOOR(CAST(v AS DOUBLE) * CASE
           WHEN p.source_id = 'PUB_B' THEN CASE h WHEN 0 THEN 0.0 WHEN 1 THEN 1.003 WHEN 2 THEN 1.007 WHEN 3 THEN 1.2
             WHEN 4 THEN 1.05 WHEN 5 THEN 0.1 ELSE 1.0 END
           WHEN p.span = m.fy THEN 0.6 WHEN p.span = 1996 AND h = 7 THEN 0.9
           WHEN p.seq = 10 AND h = 15 THEN 1.3 ELSE 1.0 END) AS BIGINT) AS val,
         p.rnk, CASE WHEN p.source_id = 'PUB_B' AND h = 6 THEN 500 ELSE 0 END AS eps, p.span,
         CASE WHEN p.span = m.fy THEN 1 ELSE 0 END AS term,
         CASE WHEN p.source_id = 'PUB_A' THEN CASE WHEN h IN (3, 9) THEN 'structural_gap' ELSE 'complete' END END AS cov
  FROM m JOIN pubs p ON
       (p.source_id = 'PUB_A' AND m.fy >= 1998 AND h NOT IN (10, 15))
    OR (p.source_id = 'PUB_B' AND h NOT IN (10, 15))
    OR (p.source_id = 'PUB_C' AND m.fy <= p.span AND h NOT IN (8, 14))
    OR (p.source_id = 'PUB_D' AND ((m.fy >= 1999 AND h = 15) OR (m.fy >= 1998 AND h = 5 AND p.seq = 9))))
"""

OBS_POLICY = CorpusPolicy(
    metrics={
        "units_shipped": MetricPolicy("units", "count", None, 1000, 1),
        "units_value": MetricPolicy("units", "count", 5, 1000, 1),
    },
    primary_source="PUB_A",
    ceiling_metric="units_value",
    ceiling_base="units_shipped",
    ceiling_factor=1,
    ceiling_reason="above_ceiling",
)


def observations(spark: SparkSession, sf_dir: str, statement: str = f"WITH {OBS} SELECT * FROM obs") -> DataFrame:
    """``obs`` in the observations schema: nation as state, supplier as district."""
    raw = run(spark, sf_dir, statement)
    gap = F.col("cov") == "structural_gap"
    coverage = F.when(
        F.col("cov").isNotNull(),
        F.struct(
            F.lit(3).alias("units_summed"), F.lit(3).alias("units_in_source_universe"),
            F.when(gap, 4).otherwise(3).alias("units_in_authority"),
        ),
    )
    return as_observations(
        raw.select(
            F.lit("DEMO").alias("scheme"), F.lit("district").alias("geo_level"),
            F.col("nk").cast("string").alias("state_code"), F.col("sk").cast("string").alias("district_code"),
            fy_label(F.col("fy")).alias("fin_year"), F.lit(None).cast("string").alias("month"), "metric",
            F.col("seq"), "source_id",
            F.concat(F.lit("res-"), F.lower(F.right("source_id", F.lit(1))), F.coalesce(F.concat(F.lit("-"), F.col("span").cast("string")), F.lit(""))).alias("resource_id"),
            F.col("val").alias("value"), F.lit("units").alias("original_unit"),
            F.lit(None).cast("timestamp").alias("source_as_of"), F.col("rnk").alias("authority_rank"),
            F.col("eps").alias("rounding_epsilon"),
            F.when(F.col("span").isNotNull(), fy_label(F.col("span"))).alias("edition_span_end"),
            (F.col("term") == 1).alias("is_edition_terminal"), coverage.alias("coverage"),
        )
    )


# Monthly year-to-date readings per supplier: quantities (some missing), three money components in
# cents and a stated total that is off for some suppliers. Some months have an earlier, lower row.
MONTHLY = f"""
sold AS (
  SELECT s.s_nationkey AS nk, l.l_suppkey AS sk, {FY_OF_SHIP} AS fy, (month(l.l_shipdate) + 8) % 12 AS pos,
         SUM(CAST(l.l_quantity AS BIGINT)) AS q,
         SUM(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT)) AS p,
         SUM(CAST(ROUND(l.l_extendedprice * 100 * l.l_tax) AS BIGINT)) AS t,
         SUM(CAST(ROUND(l.l_extendedprice * 100 * l.l_discount) AS BIGINT)) AS d
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY 1, 2, 3, 4),
ytd AS (
  SELECT nk, sk, fy, pos,
         CAST(SUM(q) OVER (PARTITION BY nk, sk, fy ORDER BY pos) AS BIGINT) AS cq,
         CAST(SUM(p) OVER (PARTITION BY nk, sk, fy ORDER BY pos) AS BIGINT) AS cp,
         CAST(SUM(t) OVER (PARTITION BY nk, sk, fy ORDER BY pos) AS BIGINT) AS ct,
         CAST(SUM(d) OVER (PARTITION BY nk, sk, fy ORDER BY pos) AS BIGINT) AS cd
  FROM sold),
monthly AS (
  SELECT nk, sk, fy, pos, CASE WHEN (sk * 7 + fy + pos) % 11 = 0 THEN CAST(NULL AS BIGINT) ELSE cq END AS cq,
         cp, ct, cd,
         cp + ct + cd + CASE WHEN nk % 3 = 1 THEN CAST(FLOOR((cp + ct + cd) / 50) AS BIGINT) ELSE 0 END AS stated,
         (CAST(sk AS BIGINT) * 10000 + fy) * 24 + pos * 2 + 1 AS row_index
  FROM ytd
  UNION ALL
  SELECT nk, sk, fy, pos, cq - 1, cp - 7, ct - 7, cd - 7, cp + ct + cd - 21,
         (CAST(sk AS BIGINT) * 10000 + fy) * 24 + pos * 2
  FROM ytd WHERE (sk + pos) % 5 = 0)
"""

MONTH_OF_POS = "LPAD(CAST((pos + 3) % 12 + 1 AS STRING), 2, '0')"


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(
        spark, sf_dir,
        f"""WITH {MONTHLY} SELECT CAST(nk AS STRING) AS state_code, CAST(sk AS STRING) AS district_code,
        {fyl('fy')} AS fin_year, {MONTH_OF_POS} AS month, row_index, cq, cp, ct, cd, stated FROM monthly""",
    )


def authority_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The authority's districts: all suppliers, and one more in every fourth nation."""
    return run(spark, sf_dir, f"WITH {AUTHORITY} SELECT state_code, code FROM authority")


AUTHORITY = """
authority AS (
  SELECT CAST(s_nationkey AS STRING) AS state_code, CAST(s_suppkey AS STRING) AS code FROM supplier
  UNION ALL
  SELECT CAST(n_nationkey AS STRING), 'extra' FROM nation WHERE n_nationkey % 4 = 0)
"""

# Cells as publishers deliver them: commas, blanks, null tokens, fractions, broken numbers.
CELLS = """
cells AS (
  SELECT o_orderkey AS id,
    CASE o_orderkey % 11
      WHEN 0 THEN 'NA' WHEN 1 THEN ' - ' WHEN 2 THEN '   '
      WHEN 3 THEN CAST(o_custkey AS STRING) || ',000'
      WHEN 4 THEN ' ' || CAST(o_custkey AS STRING) || ' '
      WHEN 5 THEN CAST(o_custkey AS STRING) || '.0'
      WHEN 6 THEN CAST(o_custkey AS STRING) || '.50'
      WHEN 7 THEN ' ' || o_orderpriority || ' '
      WHEN 8 THEN '1.2.' || CAST(o_custkey AS STRING)
      WHEN 9 THEN '-' || CAST(o_custkey AS STRING) || ',1' || CAST(o_custkey % 10 AS STRING)
      ELSE 'na' END AS cell,
    CASE o_orderkey % 7
      WHEN 0 THEN CAST(year(o_orderdate) AS STRING) || '-' || CAST(year(o_orderdate) + 1 AS STRING)
      WHEN 1 THEN CAST(year(o_orderdate) AS STRING) || '-' || LPAD(CAST((year(o_orderdate) + 1) % 100 AS STRING), 2, '0')
      WHEN 2 THEN ' ' || CAST(year(o_orderdate) AS STRING) || '-' || CAST(year(o_orderdate) + 1 AS STRING) || ' '
      WHEN 3 THEN CAST(year(o_orderdate) AS STRING) || '-' || CAST(year(o_orderdate) + 2 AS STRING)
      WHEN 4 THEN CAST(year(o_orderdate) AS STRING)
      WHEN 5 THEN CAST(NULL AS STRING)
      ELSE o_orderpriority END AS fy_cell,
    CASE o_orderkey % 6
      WHEN 0 THEN CAST(month(o_orderdate) AS STRING)
      WHEN 1 THEN LPAD(CAST(month(o_orderdate) AS STRING), 2, '0')
      WHEN 2 THEN 'April' WHEN 3 THEN ' sep ' WHEN 4 THEN CAST(month(o_orderdate) + 9 AS STRING)
      ELSE CAST(NULL AS STRING) END AS month_cell
  FROM orders)
"""

# Event snapshots with an as-of number (some unknown) and keys that are partly or wholly missing.
SNAPSHOTS = """
snapshots AS (
  SELECT event_id AS row_index,
         CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(user_id AS BIGINT) END AS user_key,
         CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS STRING) ELSE event_type END AS type_key,
         CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS INT) ELSE CAST(event_id % 3 AS INT) END AS as_of,
         CAST(ROUND(value * 100) AS BIGINT) AS cents
  FROM events)
"""

# Pulls: one per user and day; its columns are the event types seen; every third pull is partial.
PULLS = """
pull_columns AS (
  SELECT DISTINCT CAST(user_id AS STRING) AS source_id, CAST(day(ts) AS BIGINT) AS pull_seq,
         CASE WHEN (user_id + day(ts)) % 3 = 0 THEN 'partial' ELSE 'full' END AS completeness, event_type AS column_name
  FROM events)
"""

# Rows whose place names are written in many ways; the authority lists are nation and customer.
PLACES = """
places AS (
  SELECT o.o_orderkey AS row_index, c.c_nationkey AS nk, o.o_custkey AS ck,
    CASE o.o_orderkey % 9
      WHEN 0 THEN UPPER(n.n_name) WHEN 1 THEN LOWER(REPLACE(n.n_name, '_', ' '))
      WHEN 2 THEN ' ' || REPLACE(n.n_name, '_', ' - ') || '.'
      WHEN 3 THEN 'Old Nation & ' || CAST(c.c_nationkey AS STRING)
      WHEN 4 THEN 'merged-' || CAST(c.c_nationkey AS STRING)
      WHEN 5 THEN CASE WHEN c.c_nationkey % 2 = 0 THEN 'Former State ' || CAST(c.c_nationkey AS STRING) ELSE n.n_name END
      WHEN 6 THEN CASE WHEN c.c_nationkey % 5 = 0 THEN 'Nowhere' ELSE n.n_name END
      WHEN 7 THEN CASE WHEN c.c_nationkey % 5 = 1 THEN CAST(NULL AS STRING) ELSE n.n_name END
      ELSE n.n_name END AS state_label,
    CASE o.o_orderkey % 5
      WHEN 0 THEN LOWER(c.c_name) WHEN 1 THEN REPLACE(c.c_name, '#', ' / ')
      WHEN 2 THEN 'client ' || CAST(o.o_custkey AS STRING)
      WHEN 3 THEN CASE WHEN o.o_custkey % 3 = 0 THEN 'Lost District' ELSE c.c_name END
      ELSE c.c_name END AS district_label,
    year(o.o_orderdate) AS yr
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
states AS (SELECT CAST(n_nationkey AS BIGINT) AS row_index, CAST(n_nationkey AS STRING) AS code, n_name AS name FROM nation),
districts AS (
  SELECT CAST(c_custkey AS BIGINT) AS row_index, CAST(c_nationkey AS STRING) AS state_code, CAST(c_custkey AS STRING) AS code,
         c_name AS name FROM customer),
state_aliases AS (
  SELECT 'old nation and ' || CAST(n_nationkey AS STRING) AS name_key, n_name AS target, CAST(NULL AS INT) AS valid_from FROM nation
  UNION ALL
  SELECT 'merged ' || CAST(n_nationkey AS STRING), n_name, 1998 FROM nation),
district_aliases AS (
  SELECT CAST(c_nationkey AS STRING) AS state_code, 'client ' || CAST(c_custkey AS STRING) AS name_key,
         CASE WHEN c_custkey % 7 = 0 THEN 'No Such Place' ELSE c_name END AS target, CAST(NULL AS INT) AS valid_from FROM customer),
past AS (
  SELECT CAST(NULL AS STRING) AS state_code, 'former state ' || CAST(n_nationkey AS STRING) AS name_key, 'merged away' AS text
  FROM nation WHERE n_nationkey % 4 = 0
  UNION ALL
  SELECT CAST(n_nationkey AS STRING), 'lost district', 'renamed' FROM nation WHERE n_nationkey % 3 = 0),
curated AS (
  SELECT CAST(n_nationkey AS STRING) AS state_code, 'lost district' AS name_key, 'a part only' AS text FROM nation)
"""

# Melted rows with column stems as publishers write them, read off the part table.
STEMS = """
stems AS (
  SELECT p_partkey AS row_index, CAST(p_size AS STRING) AS state_code, 'res' || CAST(p_partkey % 6 AS STRING) AS resource_id,
    CASE p_partkey % 12
      WHEN 0 THEN 'Expenditure on (In Lakhs) - Wages -' WHEN 1 THEN 'Expenditure on (` In lakhs) - Material & skilled'
      WHEN 2 THEN 'expenditure on administration' WHEN 3 THEN 'Expenditure on - Total'
      WHEN 4 THEN 'Persondays (In Lakhs) - Total' WHEN 5 THEN 'persondays_in_lakhs___total'
      WHEN 6 THEN 'Persondays In Lakhs - SCs' WHEN 7 THEN 'No. of Households Provided Employment'
      WHEN 8 THEN '% Age of expenditure on wages' WHEN 9 THEN 'Average wage rate'
      WHEN 10 THEN p_name ELSE CAST(NULL AS STRING) END AS stem,
    CAST(1996 + p_partkey % 7 AS STRING) || '-' || LPAD(CAST((1997 + p_partkey % 7) % 100 AS STRING), 2, '0') AS fin_year,
    CASE p_partkey % 5
      WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN CAST(p_size AS STRING) || '.5' WHEN 2 THEN CAST(p_size AS STRING) || '.07'
      WHEN 3 THEN 'n.a.' ELSE CAST(p_partkey AS STRING) || '.250' END AS cell,
    CASE WHEN p_partkey % 8 = 3 THEN 'upto 30 09 2015' ELSE CAST(NULL AS STRING) END AS qualifier
  FROM part)
"""
