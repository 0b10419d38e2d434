"""Queries that audit texts and claims against the record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import audit, cohorts, conserve, derive, lineage
from ledgerloom.plans.inputs import run
from ledgerloom.plans.q_facts import DECIDED, facts, sources
from ledgerloom.plans.q_serve import DERIVED, declared
from ledgerloom.plans.registry import query

# Texts to audit and, per section (the source), the texts they may take numbers from: those labelled
# good. Figures per section are the number of its documents and of their characters.
DOCS = """docs AS (SELECT source AS section_id, doc_id, text FROM documents),
briefs AS (SELECT d.source AS section_id, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1),
figs AS (SELECT source AS section_id, COUNT(*) AS n, CAST(SUM(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source)"""

# RE2 has no look-around, so the character before a number is consumed and the labels go in two passes.
FY_SQL = r"(^|[^\pL\pN_])[0-9]{4}-[0-9]{2}($|[^\pL\pN_])"
NUM_SQL = r"(?:^|[^\pL\pN_.])([0-9](?:[0-9,]*[0-9])?(?:\.[0-9]+)?)"


def _numbers(text: str) -> str:
    once = f"regexp_replace({text}, '{FY_SQL}', '\\1 \\2', 'g')"
    return f"regexp_extract_all(regexp_replace({once}, '{FY_SQL}', '\\1 \\2', 'g'), '{NUM_SQL}', 1)"


CLAIMS = f"""{DOCS},
claims AS (SELECT section_id, doc_id, UNNEST({_numbers('text')}) AS token FROM docs),
allowed AS (SELECT DISTINCT section_id, UNNEST({_numbers('text')}) AS token FROM briefs
  UNION SELECT section_id, CAST(n AS STRING) FROM figs UNION SELECT section_id, CAST(chars AS STRING) FROM figs UNION SELECT section_id, FORMAT('{{:,}}', chars) FROM figs)"""


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return run(spark, sf_dir, f"WITH {DOCS} SELECT * FROM {name}")


@query(
    "claim_audit",
    f"""WITH {CLAIMS} SELECT c.section_id, c.doc_id, c.token, COUNT(*) AS uses FROM claims c
    WHERE NOT EXISTS (SELECT 1 FROM allowed a WHERE a.section_id = c.section_id AND a.token = c.token) GROUP BY 1, 2, 3""",
)
def claim_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = texts(spark, sf_dir, "figs")
    figures = values.select("section_id", F.explode(F.array("n", "chars")).alias("value")).withColumn("value", F.col("value").cast("decimal(28,12)"))
    briefed = audit.tokens_of(texts(spark, sf_dir, "briefs"), audit.number_tokens(F.col("text")))
    return audit.unbacked_numbers(texts(spark, sf_dir, "docs"), audit.renderings(figures).unionByName(briefed))


# Documents with dated remarks: the year-month of a conversation turn, as "1998-07" and the like.
DATED = """dated AS (SELECT role AS section_id, conv_id * 1000 + turn AS doc_id,
  text || ' in ' || CAST(1990 + conv_id % 30 AS STRING) || '-' || LPAD(CAST((1991 + conv_id % 30) % 100 AS STRING), 2, '0') ||
  CASE WHEN turn % 2 = 0 THEN ', 2001-02.' ELSE ' x1999-00' END AS text FROM conversations),
seen AS (SELECT section_id, text FROM dated WHERE doc_id % 3 = 0)"""


@query(
    "period_audit",
    f"""WITH {DATED}, p AS (SELECT section_id, doc_id, UNNEST(regexp_extract_all(text, '(?:^|[^\\pL\\pN_])([0-9]{{4}}-[0-9]{{2}})\\b', 1)) AS token FROM dated),
    a AS (SELECT DISTINCT section_id, UNNEST(regexp_extract_all(text, '(?:^|[^\\pL\\pN_])([0-9]{{4}}-[0-9]{{2}})\\b', 1)) AS token FROM seen)
    SELECT section_id, doc_id, token, COUNT(*) AS uses FROM p WHERE (section_id, token) NOT IN (SELECT section_id, token FROM a) GROUP BY 1, 2, 3""",
)
def period_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = run(spark, sf_dir, f"WITH {DATED} SELECT * FROM dated")
    briefed = run(spark, sf_dir, f"WITH {DATED} SELECT * FROM seen")
    return audit.unbacked_periods(docs, audit.tokens_of(briefed, audit.period_labels(F.col("text"))))


# Every document quotes a stretch of a good document of its section; in every third the quote is altered.
QUOTED = """good AS (SELECT d.source AS section_id, d.doc_id, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1),
best AS (SELECT section_id, MIN(doc_id) AS doc_id FROM good GROUP BY 1),
quoting AS (SELECT d.source AS section_id, d.doc_id, d.text || ' says "' || SUBSTR(REPLACE(g.text, '"', ''), 1 + CAST(d.doc_id % 50 AS INT), 40 + CAST(d.doc_id % 90 AS INT)) ||
    CASE WHEN d.doc_id % 3 = 0 THEN ' indeed' ELSE '' END || '".' AS text
  FROM documents d JOIN best b ON d.source = b.section_id JOIN good g ON g.doc_id = b.doc_id),
served AS (SELECT section_id, REPLACE(text, '"', '') AS text FROM good)"""


@query(
    "quote_audit",
    f"""WITH {QUOTED}, q AS (SELECT section_id, doc_id, UNNEST(regexp_extract_all(text, '["“]([^“”"]{{40,}})["”]', 1)) AS raw FROM quoting),
    t AS (SELECT section_id, doc_id, regexp_replace(regexp_replace(raw, '^\\s+', ''), '\\s+$', '') AS quote FROM q)
    SELECT section_id, doc_id, quote FROM t WHERE NOT EXISTS (SELECT 1 FROM served s WHERE s.section_id = t.section_id AND CONTAINS(s.text, t.quote))""",
)
def quote_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = run(spark, sf_dir, f"WITH {QUOTED} SELECT * FROM quoting")
    served = run(spark, sf_dir, f"WITH {QUOTED} SELECT * FROM served")
    return audit.unbacked_quotations(docs, served)


@query(
    "strip_exhibits",
    """SELECT conv_id * 1000 + turn AS doc_id, SHA256(REPLACE(REPLACE(text || ' call(1990-91) says call(1990-91, closed) ', 'call(1990-91, closed)', ' '), 'call(1990-91)', ' ')) AS digest FROM conversations""",
)
def strip_exhibits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = run(
        spark, sf_dir,
        "SELECT role AS section_id, conv_id * 1000 + turn AS doc_id, text || ' call(1990-91) says call(1990-91, closed) ' AS text FROM conversations",
    )
    exhibits = docs.select("section_id").distinct().select(
        "section_id", F.explode(F.array(F.lit("call(1990-91)"), F.lit("call(1990-91, closed)"))).alias("text")
    )
    return audit.strip_exhibits(docs, exhibits).select("doc_id", F.sha2("text", 256).alias("digest"))


# A customer's claims: every third has a wrong sum, every fifth a wrong rounded figure; loops claim 0.
CLAIMED = """claimed AS (
    SELECT *, CAST(SUBSTR(id, STRPOS(id, '/') + 1) AS BIGINT) AS ck, SUBSTR(id, 1, STRPOS(id, '/') - 1) AS name FROM derived),
  claims AS (SELECT *, CASE WHEN level IS NULL THEN 0 WHEN ck % 3 = 0 AND name = 'sum' THEN cents + 1 WHEN ck % 5 = 0 AND name = 'round_sigfig_3' THEN cents - 100
      ELSE cents END AS declared_cents FROM claimed),
  verdicts AS (SELECT *, CASE WHEN problem IS NOT NULL THEN problem WHEN ck % 3 = 0 AND name IN ('second', 'third') THEN 'unknown input'
      WHEN declared_cents <> cents THEN 'mismatch' END AS verdict FROM claims)"""


@query(
    "derivation_audit",
    f"""WITH {DERIVED}, {CLAIMED} SELECT id, declared_cents, CASE WHEN verdict = 'mismatch' THEN cents END AS recomputed_cents,
    CASE WHEN ck % 3 = 0 AND name = 'second' THEN 'unknown input' ELSE verdict END AS problem FROM verdicts WHERE verdict IS NOT NULL""",
)
def derivation_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims of every derivation, some of them wrong at the bottom."""
    nodes, rows = declared(spark, sf_dir)
    right = derive.evaluate(nodes, rows).select("id", "level", "value")
    ck, name = F.substring_index("id", "/", -1).cast("long"), F.substring_index("id", "/", 1)
    off = F.when((ck % 3 == 0) & (name == "sum"), F.lit("0.01")).when((ck % 5 == 0) & (name == "round_sigfig_3"), F.lit("-1")).otherwise(F.lit("0")).cast("decimal(3,2)")
    claim = F.when(F.col("level").isNull(), F.lit(0)).otherwise(F.col("value") + off)
    found = audit.derivation_problems(nodes, rows.join(right, "id").withColumn("declared", claim))
    cents = lambda c: F.floor(F.col(c) * 100).cast("bigint")
    return found.select("id", cents("declared_value").alias("declared_cents"), cents("recomputed_value").alias("recomputed_cents"), "problem")


@query(
    "cohort_audit",
    f"""WITH {DECIDED}, s AS (SELECT metric AS cohort_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE sk % 2 = 1) AS missing FROM facts WHERE value IS NULL GROUP BY 1)
    SELECT cohort_id, n AS declared_count, n AS served_count, 0 AS not_served, missing AS not_declared, FALSE AS count_wrong, TRUE AS members_wrong FROM s WHERE missing > 0""",
)
def cohort_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohorts by metric whose count is right while some members were left out."""
    served = cohorts.select(facts(spark, sf_dir), "value_is_null").select(F.col("metric").alias("cohort_id"), "fact_id", "district_code")
    members = served.filter(F.col("district_code").cast("int") % 2 != 1).select("cohort_id", "fact_id")
    return audit.cohort_problems(cohorts.member_counts(served), members, served.select("cohort_id", "fact_id"))


@query(
    "replay_audit",
    f"""WITH {DECIDED}, fg AS (SELECT 'fig-' || fact_id AS figure_id, CASE WHEN sk % 11 = 4 THEN 'gone' || fact_id ELSE fact_id END AS fact_id,
      CASE WHEN sk % 7 = 2 THEN value + 1 ELSE value END AS value, value AS now, sk FROM facts WHERE value IS NOT NULL)
    SELECT figure_id, fact_id, CAST(value AS BIGINT) AS value, CASE WHEN sk % 11 = 4 THEN 'fact not served' ELSE 'value differs' END AS problem FROM fg WHERE sk % 11 = 4 OR value <> now""",
)
def replay_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = facts(spark, sf_dir)
    number = F.col("district_code").cast("int")
    figures = served.filter(F.col("value").isNotNull()).select(
        F.concat(F.lit("fig-"), "fact_id").alias("figure_id"),
        F.when(number % 11 == 4, F.concat(F.lit("gone"), "fact_id")).otherwise(F.col("fact_id")).alias("fact_id"),
        F.when(number % 7 == 2, F.col("value") + 1).otherwise(F.col("value")).alias("value"),
    )
    return audit.replay_problems(figures, served).select("figure_id", "fact_id", F.col("value").cast("bigint").alias("value"), "problem")


@query(
    "lineage_audit",
    f"""WITH {DECIDED}, b AS (SELECT f.fact_id, f.sk, BOOL_OR(r.source_id = 'PUB_D') AS unnamed FROM facts f JOIN r7 r ON r.sk = f.sk AND r.fy = f.fy AND r.metric = f.metric GROUP BY 1, 2)
    SELECT 'fig-' || fact_id AS figure_id, fact_id, CASE WHEN sk % 9 = 1 THEN 'no lineage' ELSE 'source without resource' END AS problem FROM b WHERE sk % 9 = 1 OR unnamed""",
)
def lineage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures whose lineage was lost, or has a publisher without a resource."""
    rows, decided = sources(spark, sf_dir)
    lost = decided.filter(F.col("district_code").cast("int") % 9 == 1).select("fact_id")
    kept = rows.join(lost, "fact_id", "left_anti").withColumn("resource_id", F.when(F.col("source_id") != "PUB_D", F.col("resource_id")))
    figures = decided.select(F.concat(F.lit("fig-"), "fact_id").alias("figure_id"), "fact_id")
    return audit.lineage_problems(figures, kept)


@query(
    "fact_lineage_bijection",
    f"""WITH {DECIDED} SELECT fact_id, CASE WHEN sk % 10 = 2 THEN 'no lineage' ELSE 'repeated record' END AS problem FROM facts WHERE sk % 10 IN (2, 6)""",
)
def fact_lineage_bijection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts against records of which some were dropped and some doubled."""
    rows, decided = sources(spark, sf_dir)
    place = F.col("key.district_code").cast("int") % 10
    records = lineage.records(decided, lineage.nested_sources(rows)).select("fact_id", place.alias("p"))
    copies = F.when(F.col("p") == 2, 0).when(F.col("p") == 6, 2).otherwise(1)
    tampered = records.select("fact_id", F.explode(F.array_repeat(F.lit(1), copies)).alias("_c"))
    return conserve.bijection_problems(decided, tampered)
