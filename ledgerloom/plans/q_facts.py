"""Queries over reconciled facts: the cascade, labels, summaries, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.ids import key_text
from ledgerloom.functions.text import plain_number
from ledgerloom.operators import lineage, reconcile, series, wide
from ledgerloom.plans.inputs import OBS, OBS_POLICY, fyl, observations, run
from ledgerloom.plans.registry import query
from ledgerloom.session import cut_lineage, scratch_path


def _agree(w: str, o: str) -> str:
    """SQL for the agreement of two readings, the band on the first."""
    step = f"GREATEST({w}.eps, {o}.eps)"
    gap = f"ABS({w}.val - {o}.val)"
    return (
        f"({w}.val = {o}.val OR ({step} > 0 AND {gap} <= {step}) "
        f"OR ({w}.metric <> 'units_shipped' AND {gap} * 1000 <= 5 * ABS({w}.val)))"
    )


def _scale(v: str, a: str) -> str:
    tests = []
    for f in (10, 100, 1000):
        tests.append(f"ABS({a}.val - {v}.val * {f}) * 200 <= ABS({a}.val)")
        tests.append(f"ABS({a}.val * {f} - {v}.val) * 200 <= ABS({a}.val * {f})")
    return f"({v}.val <> 0 AND {a}.val <> 0 AND ({' OR '.join(tests)}))"


def _same(a: str, b: str) -> str:
    return f"{a}.sk = {b}.sk AND {a}.fy = {b}.fy AND {a}.metric = {b}.metric"


def _decided(inputs: str, obs: str) -> str:
    """The rules restated over joins and row numbers, for the readings in table ``obs``."""
    return f"""
{inputs},
z AS (SELECT sk, fy, metric, MAX(CASE WHEN val <> 0 THEN 1 ELSE 0 END) AS nz FROM {obs} GROUP BY 1, 2, 3),
r1 AS (SELECT o.*, (z.nz = 1 AND o.val = 0) AS absent FROM {obs} o JOIN z ON {_same('o', 'z')}),
r2 AS (SELECT *, (NOT absent AND span IS NOT NULL AND term = 1) AS part,
              (NOT absent AND span IS NOT NULL AND term = 0) AS final FROM r1),
ed AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sk, fy, metric ORDER BY span DESC, seq) AS rn
                      FROM r2 WHERE final) t WHERE rn = 1),
r3 AS (SELECT r.*, (r.final AND r.seq <> e.seq AND NOT {_agree('e', 'r')}) AS sup0 FROM r2 r LEFT JOIN ed e ON {_same('r', 'e')}),
r4 AS (SELECT *, COALESCE(sup0, FALSE) AS superseded, (NOT absent AND NOT part AND NOT COALESCE(sup0, FALSE)) AS act FROM r3),
an AS (SELECT * FROM (
   SELECT a.*, ROW_NUMBER() OVER (PARTITION BY a.sk, a.fy, a.metric ORDER BY a.seq) AS rn FROM r4 a
   WHERE a.act
     AND EXISTS (SELECT 1 FROM r4 b WHERE {_same('a', 'b')} AND b.act AND b.source_id <> a.source_id AND {_agree('a', 'b')})
     AND EXISTS (SELECT 1 FROM r4 c WHERE {_same('a', 'c')} AND c.act AND NOT {_agree('c', 'a')} AND {_scale('c', 'a')})) t
   WHERE rn = 1),
r5 AS (SELECT r.*, COALESCE(r.act AND NOT {_agree('r', 'a')} AND {_scale('r', 'a')}, FALSE) AS scaled
       FROM r4 r LEFT JOIN an a ON {_same('r', 'a')}),
r6 AS (SELECT *, (act AND NOT scaled) AS live FROM r5),
win AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sk, fy, metric
          ORDER BY rnk, -COALESCE(span, 0), source_id, seq) AS rn FROM r6 WHERE live) t WHERE rn = 1),
r7 AS (SELECT r.*, w.val AS wval, w.seq AS wseq, w.source_id AS wsource, (w.cov = 'structural_gap') AS wgap,
              COALESCE(r.live AND r.seq <> w.seq AND NOT {_agree('w', 'r')}, FALSE) AS rejected
       FROM r6 r LEFT JOIN win w ON {_same('r', 'w')}),
g AS (SELECT nk, sk, fy, metric, MAX(wval) AS wval, MAX(wsource) AS wsource, BOOL_OR(COALESCE(wgap, FALSE)) AS wgap,
        COUNT(*) AS seen, COUNT(*) FILTER (WHERE live) AS n_live, COUNT(*) FILTER (WHERE rejected) AS n_rej,
        COUNT(*) FILTER (WHERE absent) AS n_abs, COUNT(*) FILTER (WHERE part) AS n_part,
        COUNT(*) FILTER (WHERE superseded) AS n_sup, COUNT(*) FILTER (WHERE scaled) AS n_scale,
        MAX(val) FILTER (WHERE live) AS hi, MIN(val) FILTER (WHERE live) AS lo,
        COUNT(DISTINCT source_id) FILTER (WHERE live) AS pubs,
        COUNT(*) FILTER (WHERE live AND cov IS NULL AND seq <> wseq) AS native,
        COUNT(*) FILTER (WHERE NOT absent AND NOT part AND NOT scaled) AS n_surv,
        COUNT(DISTINCT source_id) FILTER (WHERE NOT absent AND NOT part AND NOT scaled) AS surv_pubs,
        BOOL_OR(source_id = 'PUB_A') AS has_primary,
        STRING_AGG(DISTINCT 'res-' || LOWER(RIGHT(source_id, 1)) || COALESCE('-' || CAST(span AS STRING), ''), ';'
                   ORDER BY 'res-' || LOWER(RIGHT(source_id, 1)) || COALESCE('-' || CAST(span AS STRING), '')) AS resources
      FROM r7 GROUP BY 1, 2, 3, 4),
g2 AS (SELECT *, GREATEST(ABS(wval - lo), ABS(wval - hi)) AS gap,
         CASE WHEN n_sup > 0 THEN 'R4-REC-10' WHEN n_part > 0 THEN 'R4-REC-11' WHEN n_abs > 0 THEN 'R4-REC-06'
              WHEN n_scale > 0 THEN 'R4-REC-07' END AS pre FROM g WHERE n_live > 0 OR n_part > 0),
g3 AS (SELECT *, CASE WHEN n_live = 0 THEN 'R4-REC-11' WHEN n_live = 1 THEN COALESCE(pre, 'R4-REC-04')
         WHEN n_rej = 0 THEN COALESCE(pre, 'R4-REC-01')
         WHEN hi - lo < 1000 OR gap * 100 < ABS(wval) THEN 'R4-REC-08'
         WHEN wgap AND native > 0 THEN 'R4-REC-05' WHEN pubs = 1 THEN 'R4-REC-09' ELSE 'R4-REC-02' END AS rule FROM g2),
g4 AS (SELECT *, (n_live > 0 AND rule NOT IN ('R4-REC-05', 'R4-REC-09')) AS adj FROM g3),
f AS (SELECT *, CASE WHEN adj THEN wval END AS value,
        CASE WHEN has_primary THEN 'flagship (district-monthly, rolled up)' WHEN n_surv >= 2 THEN 'historical multi-source'
             ELSE 'historical single-source' END AS basis,
        CASE WHEN NOT adj THEN CASE rule WHEN 'R4-REC-09' THEN 'single-publisher divergence' WHEN 'R4-REC-11' THEN 'partial-period-only'
               ELSE 'unadjudicated' END
             WHEN n_rej > 0 THEN CASE WHEN rule = 'R4-REC-08' THEN 'immaterial divergence' ELSE 'flagged-disagreement' END
             WHEN n_surv < 2 THEN 'single-source' WHEN surv_pubs >= 2 THEN 'cross-publisher'
             WHEN n_sup > 0 THEN 'edition-superseded' ELSE 'single-publisher multi-vintage' END AS confidence,
        {fyl('fy')} AS fin_year FROM g4),
facts AS (SELECT f.*, SUBSTR(SHA256('DEMO|district|' || CAST(nk AS STRING) || '|' || CAST(sk AS STRING) || '|' || fin_year || '||' || metric), 1, 16) AS fact_id,
        COALESCE(value < 0, FALSE) AS negative,
        COALESCE(metric = 'units_value' AND NOT COALESCE(value < 0, FALSE)
          AND value > MAX(CASE WHEN metric = 'units_shipped' THEN value END) OVER (PARTITION BY nk, sk, fy), FALSE) AS above
      FROM f)
"""


DECIDED = _decided(OBS, "obs")

# The same readings with a third of all suppliers folded into one key per metric.
HOT = f"""{OBS},
hot AS (SELECT CASE WHEN sk % 3 = 0 THEN -1 ELSE nk END AS nk, CASE WHEN sk % 3 = 0 THEN -1 ELSE sk END AS sk,
  CASE WHEN sk % 3 = 0 THEN 1900 ELSE fy END AS fy, metric, (CAST(sk AS BIGINT) * 10000 + fy) * 16 + seq AS seq,
  source_id, val, rnk, eps, span, term, cov FROM obs)"""


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of these readings has at most seven of them, so the window form is right for all."""
    return reconcile.flag_readings(observations(spark, sf_dir), OBS_POLICY)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.assemble(flagged(spark, sf_dir), OBS_POLICY)


def _whole(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


@query(
    "reconcile_value",
    f"""WITH {DECIDED} SELECT CAST(nk AS STRING) AS state_code, CAST(sk AS STRING) AS district_code, fin_year, metric,
    CAST(value AS BIGINT) AS value, CASE WHEN adj THEN wsource END AS source_id, rule AS resolution_rule_id, adj AS adjudicated,
    seen AS sources_seen_count, CASE WHEN n_rej > 0 THEN rule <> 'R4-REC-08' END AS material,
    CASE WHEN n_rej > 0 THEN ROUND(CAST(gap AS DOUBLE) * 100 / ABS(wval), 6) END AS disagreement_pct FROM f""",
)
def reconcile_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.decide(flagged(spark, sf_dir), OBS_POLICY).select(
        "state_code", "district_code", "fin_year", "metric", _whole("value"), "source_id", "resolution_rule_id",
        "adjudicated", "sources_seen_count", "material", F.round("disagreement_pct", 6).alias("disagreement_pct"),
    )


@query(
    "reconcile_buckets",
    f"""WITH {DECIDED} SELECT CAST(sk AS STRING) AS district_code, {fyl('fy')} AS fin_year, metric, seq, source_id,
    CAST(val AS BIGINT) AS value, absent, part AS partial, superseded, scaled AS scale_error, live, rejected,
    wseq AS winner_seq FROM r7""",
)
def reconcile_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(spark, sf_dir).select(
        "district_code", "fin_year", "metric", "seq", "source_id", _whole("value"), "absent", "partial", "superseded",
        "scale_error", "live", "rejected", F.col("winner.seq").alias("winner_seq"),
    )


@query(
    "series_confidence",
    f"""WITH {DECIDED} SELECT fact_id, basis, confidence,
    CASE WHEN has_primary THEN 'flagship-rollup' ELSE 'historical' END AS era_basis FROM facts""",
)
def series_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).select("fact_id", "basis", "confidence", "era_basis")


@query(
    "coverage_summary",
    f"""WITH {DECIDED} SELECT metric, COUNT(*) FILTER (WHERE fin_year < '1999') AS pre_split,
    COUNT(*) FILTER (WHERE fin_year >= '1999') AS from_split,
    {', '.join(f"COUNT(*) FILTER (WHERE confidence = '{c}') AS {n}" for c, n in series.SUMMARY_COLUMNS.items())},
    COUNT(*) FILTER (WHERE negative OR above) AS quarantined FROM facts GROUP BY metric""",
)
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.coverage_summary(facts(spark, sf_dir), split_year="1999")


@query(
    "implausible_facts",
    f"""WITH {DECIDED} SELECT fact_id, metric, CAST(value AS BIGINT) AS value,
    CASE WHEN above THEN 'above_ceiling' ELSE 'negative_value' END AS quarantine_reason FROM facts WHERE negative OR above""",
)
def implausible_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).filter("quarantined").select("fact_id", "metric", _whole("value"), "quarantine_reason")


@query(
    "fact_rows",
    f"""WITH {DECIDED} SELECT CAST(f.nk AS STRING) AS state_lgd_code, n.n_name AS state_name, CAST(f.sk AS STRING) AS district_lgd_code,
    s.s_name AS district_name, f.fin_year AS financial_year, f.metric, CAST(f.value AS BIGINT) AS value, 'units' AS unit,
    'district-annual' AS grain, f.confidence, f.seen AS sources_seen_count, f.resources AS contributing_resource_ids, f.fact_id
    FROM facts f JOIN nation n ON f.nk = n.n_nationkey JOIN supplier s ON f.sk = s.s_suppkey""",
)
def fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = run(spark, sf_dir, "SELECT CAST(n_nationkey AS STRING) AS code, n_name AS name FROM nation")
    districts = run(
        spark, sf_dir, "SELECT CAST(s_nationkey AS STRING) AS state_code, CAST(s_suppkey AS STRING) AS code, s_name AS name FROM supplier"
    )
    return series.district_rows(facts(spark, sf_dir), states, districts).withColumn("value", F.col("value").cast("bigint"))


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Readings and facts of one cascade: the marked readings are written once and read for both."""
    marked = cut_lineage(flagged(spark, sf_dir), "readings")
    return lineage.source_rows(marked), series.assemble(marked, OBS_POLICY)


@query(
    "materiality",
    f"""WITH {DECIDED}, spread AS (SELECT sk, fy, metric, MAX(val) - MIN(val) AS s, COUNT(val) AS n FROM r7 GROUP BY 1, 2, 3)
    SELECT fact_id, CASE WHEN n >= 2 THEN CAST(s AS BIGINT) END AS absolute, rule <> 'R4-REC-08' AS material,
    ROUND(CAST(gap AS DOUBLE) * 100 / ABS(wval), 6) AS relative_pct
    FROM facts f JOIN spread p ON {_same('f', 'p')} WHERE n_rej > 0""",
)
def materiality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.materiality(facts(spark, sf_dir)).select(
        "fact_id", F.col("absolute").cast("bigint").alias("absolute"), "material", F.round("relative_pct", 6).alias("relative_pct")
    )


@query(
    "rejected_values",
    f"""WITH {DECIDED} SELECT f.fact_id, r.seq, r.source_id, CAST(r.val AS BIGINT) AS value
    FROM r7 r JOIN facts f ON {_same('r', 'f')}
    WHERE EXISTS (SELECT 1 FROM r7 x WHERE {_same('x', 'r')} AND x.source_id = r.source_id AND x.rejected)""",
)
def rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.rejected_values(lineage.source_rows(flagged(spark, sf_dir))).select("fact_id", "seq", "source_id", _whole("value"))


@query(
    "null_reasons",
    f"""WITH {DECIDED} SELECT fact_id, CASE confidence WHEN 'cross-publisher' THEN 'corroborated'
    WHEN 'single-publisher multi-vintage' THEN 'corroborated' WHEN 'immaterial divergence' THEN 'corroborated'
    WHEN 'flagged-disagreement' THEN 'flagged conflict' WHEN 'single-publisher divergence' THEN 'unadjudicated'
    ELSE confidence END AS reconciliation_status,
    CASE WHEN value IS NULL THEN confidence END AS null_reason FROM facts""",
)
def null_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).select(
        "fact_id", lineage.status().alias("reconciliation_status"), lineage.null_reason().alias("null_reason")
    )


SEEN = "source_id || '=' || CAST(CAST(val AS BIGINT) AS STRING)"
BUCKET_FLAGS = {"coverage_absent": "absent", "scale_quarantined": "scaled", "edition_superseded": "superseded", "partial_period": "part"}


@query(
    "lineage_records",
    f"""WITH {DECIDED}, src AS (SELECT sk, fy, metric, STRING_AGG({SEEN}, ',' ORDER BY seq) AS seen_list,
      STRING_AGG(COALESCE(cov, '-') || ':' || COALESCE({fyl('span')}, '-'), ',' ORDER BY seq) AS span_list,
      {', '.join(f"COALESCE(STRING_AGG({SEEN}, ',' ORDER BY seq) FILTER (WHERE {flag}), '') AS {bucket}" for bucket, flag in BUCKET_FLAGS.items())},
      COALESCE(STRING_AGG(source_id, ',' ORDER BY seq) FILTER (WHERE rejected), '') AS rejected_list FROM r7 GROUP BY 1, 2, 3)
    SELECT f.fact_id, CAST(f.nk AS STRING) AS state_code, CAST(f.sk AS STRING) AS district_code, fin_year, f.metric,
    CAST(CAST(value AS BIGINT) AS STRING) AS value, basis, confidence, rule AS resolution_rule_id, adj AS adjudicated, negative OR above AS quarantined,
    seen_list, span_list, {', '.join(BUCKET_FLAGS)}, CASE WHEN n_rej > 0 THEN rejected_list END AS rejected_list FROM facts f JOIN src s ON {_same('f', 's')}""",
)
def lineage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as published, through JSON text and back."""
    rows, decided = sources(spark, sf_dir)
    published = lineage.records(decided, lineage.nested_sources(rows))
    lines = published.select("fact_id", F.to_json(F.struct(*published.columns), {"ignoreNullFields": "false"}).alias("record"))
    parsed = lineage.parse_records(lines)

    def listed(name: str) -> Column:
        return F.array_join(F.transform(name, lambda s: F.concat(s["source_id"], F.lit("="), s["value"])), ",")

    dash = F.lit("-")
    spans = F.transform("sources_seen", lambda s: F.concat_ws(":", F.coalesce(s["aggregate_coverage"]["status"], dash), F.coalesce(s["edition_span_end"], dash)))
    return parsed.select(
        "fact_id", "key.state_code", "key.district_code", "key.fin_year", "key.metric", "value", "basis", "confidence",
        "resolution_rule_id", "adjudicated", "quarantined", listed("sources_seen").alias("seen_list"),
        F.array_join(spans, ",").alias("span_list"), *[listed(bucket).alias(bucket) for bucket in lineage.BUCKETS],
        F.array_join("disagreement.rejected_sources", ",").alias("rejected_list"),
    )


@query(
    "lineage_lookup",
    f"""WITH {DECIDED}, req AS (SELECT CAST(o_orderkey AS BIGINT) * 2 + k AS position, SUBSTR(SHA256('DEMO|district|' || CAST(s_nationkey AS STRING) || '|' || CAST(s_suppkey AS STRING)
      || '|' || {fyl('year(o_orderdate)')} || '||' || m), 1, 16) AS fact_id
      FROM orders JOIN supplier ON o_orderkey % (SELECT COUNT(*) FROM supplier) = s_suppkey CROSS JOIN (VALUES (0, 'units_value'), (1, 'units_shipped')) v(k, m))
    SELECT position, req.fact_id, f.fact_id IS NOT NULL AS found, CAST(sk AS STRING) AS district_code, fin_year, metric, CAST(CAST(value AS BIGINT) AS STRING) AS value,
    confidence, rule AS resolution_rule_id FROM req LEFT JOIN facts f ON req.fact_id = f.fact_id""",
)
def lineage_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = run(
        spark, sf_dir,
        f"""SELECT CAST(o_orderkey AS BIGINT) AS position, s_nationkey, s_suppkey, {fyl('year(o_orderdate)')} AS fy
        FROM orders JOIN supplier ON o_orderkey % (SELECT COUNT(*) FROM supplier) = s_suppkey""",
    )
    asked = asked.select("*", F.posexplode(F.array(F.lit("units_value"), F.lit("units_shipped"))).alias("k", "m"))
    key = key_text(F.lit("DEMO"), F.lit("district"), F.col("s_nationkey"), F.col("s_suppkey"), F.col("fy"), F.lit(""), F.col("m"))
    requests = asked.select((F.col("position") * 2 + F.col("k")).alias("position"), F.substring(F.sha2(key, 256), 1, 16).alias("fact_id"))
    path = scratch_path(spark, "published")
    lineage.publish(facts(spark, sf_dir), path)
    return lineage.look_up_published(requests, path).select(
        "position", "fact_id", "found", "district_code", "fin_year", "metric", plain_number(F.col("value")).alias("value"), "confidence", "resolution_rule_id"
    )


@query(
    "reconcile_hot_key",
    f"""WITH {_decided(HOT, "hot")} SELECT CAST(sk AS STRING) AS district_code, {fyl('fy')} AS fin_year, metric, seq, CAST(val AS BIGINT) AS value,
    absent, part AS partial, superseded, scaled AS scale_error, live, rejected, wseq AS winner_seq FROM r7""",
)
def reconcile_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all readings state one fact, and are aggregated and joined, not windowed."""
    readings = observations(spark, sf_dir, f"WITH {HOT} SELECT * FROM hot")
    return wide.flag_any(readings, OBS_POLICY).select(
        "district_code", "fin_year", "metric", "seq", _whole("value"), "absent", "partial", "superseded", "scale_error",
        "live", "rejected", F.col("winner.seq").alias("winner_seq"),
    )


# Two facts, each with half of all orders as readings of seven publishers: prices in whole units, of
# which some lost or gained digits and some are rounded to thousands. Nearly all are distinct, and
# among so many, readings meet others near a power of ten that still are no anchors for them.
CROWD = """crowd AS (
  SELECT 0 AS nk, 0 AS sk, CASE WHEN o_orderkey % 2 = 0 THEN 1995 ELSE 1996 END AS fy,
    CASE WHEN o_orderkey % 2 = 0 THEN 'units_shipped' ELSE 'units_value' END AS metric, CAST(o_orderkey AS BIGINT) AS seq,
    'PUB_' || SUBSTR('ABCDEFG', CAST(o_custkey % 7 AS INT) + 1, 1) AS source_id,
    CAST(CASE CAST(o_orderkey % 31 AS INT) WHEN 7 THEN FLOOR(o_totalprice / 10) WHEN 12 THEN FLOOR(o_totalprice / 1000) WHEN 19 THEN FLOOR(o_totalprice) * 100
      WHEN 23 THEN -FLOOR(o_totalprice) WHEN 25 THEN 0 WHEN 29 THEN FLOOR(o_totalprice / 1000) * 1000 ELSE FLOOR(o_totalprice) END AS BIGINT) AS val,
    CAST(10 + o_custkey % 3 AS INT) AS rnk, CASE CAST(o_orderkey % 31 AS INT) WHEN 29 THEN 500 WHEN 11 THEN 3 ELSE 0 END AS eps,
    CASE WHEN o_orderkey % 11 = 0 THEN CAST(1994 + o_orderkey % 4 AS INT) END AS span,
    CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 4 = 3 THEN 1 ELSE 0 END AS term, CAST(NULL AS STRING) AS cov
  FROM orders)"""


@query(
    "reconcile_crowded_key",
    f"""WITH {_decided(CROWD, "crowd")} SELECT fy, metric, seq, source_id, val AS value, absent, part AS partial, superseded, scaled AS scale_error, live,
    rejected, wseq AS winner_seq FROM r7""",
)
def reconcile_crowded_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of distinct readings of one fact."""
    readings = observations(spark, sf_dir, f"WITH {CROWD} SELECT * FROM crowd")
    return wide.flag_any(readings, OBS_POLICY).select(
        F.left("fin_year", F.lit(4)).cast("int").alias("fy"), "metric", "seq", "source_id", _whole("value"), "absent", "partial", "superseded", "scale_error",
        "live", "rejected", F.col("winner.seq").alias("winner_seq"),
    )
