"""Queries that go through files: written to the shared folder, read back with the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators import series
from ledgerloom.plans.inputs import AUTHORITY, run
from ledgerloom.plans.q_facts import DECIDED, facts
from ledgerloom.plans.registry import query
from ledgerloom.session import scratch_path
from ledgerloom.sources import landing, readers, sinks

ROWS = """rws AS (SELECT CAST(o_orderkey AS STRING) AS id, o_orderpriority AS priority, CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS STRING) ELSE CAST(o_custkey AS STRING) END AS cust,
  CASE WHEN o_orderkey % 3 = 0 THEN 'say "x, y"' ELSE o_orderstatus END AS note, CAST(CAST(o_custkey AS BIGINT) AS DECIMAL(28,12)) AS value FROM orders)"""


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, f"WITH {ROWS} SELECT * FROM rws")


@query(
    "csv_round_trip",
    f"WITH {ROWS} SELECT id, priority, cust, note, CAST(CAST(value AS BIGINT) AS STRING) AS value, id AS first_seen FROM rws",
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    rows = table_rows(spark, sf_dir).withColumn("first_seen", F.col("id"))
    columns = ["id", "priority", "cust", "note", "value", "first_seen"]
    sinks.write_csv(rows, path, columns, ["id"])
    classified = landing.classify_rows(readers.read_delimited(spark, path))
    table = landing.as_columns(landing.landed(classified), columns, keep=())
    # A null is printed as an empty cell, which lands as delivered.
    return table.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in columns])


@query(
    "ordered_rows",
    f"WITH {ROWS} SELECT id, cust, note, ROW_NUMBER() OVER (ORDER BY COALESCE(cust, ''), note, id) - 1 AS position FROM rws",
)
def ordered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in the order in which the sinks write."""
    return sinks.numbered(table_rows(spark, sf_dir), ["cust", "note", "id"]).select("id", "cust", "note", "position")


@query(
    "file_order",
    f"WITH {ROWS} SELECT id, ROW_NUMBER() OVER (ORDER BY COALESCE(cust, ''), note, id) - 1 AS position FROM rws",
)
def file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as they follow each other in the written files, read by file name and place in the file."""
    path = scratch_path(spark, "sorted")
    sinks.write_parquet(table_rows(spark, sf_dir), path, ["id", "cust", "note"], ["cust", "note", "id"])
    read = spark.read.parquet(path).select("id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    ahead = read.groupBy("file").count().withColumn("start", F.coalesce(F.sum("count").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return read.join(ahead, "file").select("id", (F.col("start") + F.col("row")).alias("position"))


# Lines as a publisher may send them: whole, with blank cells, blank, short, long and quoted.
LINES = """CASE o_orderkey % 8 WHEN 0 THEN CONCAT(k, ',,', p) WHEN 1 THEN ',,' WHEN 2 THEN CONCAT(k, ',', c) WHEN 3 THEN CONCAT(k, ',', c, ',', p, ',more')
  WHEN 4 THEN CONCAT(k, ',"",', p) WHEN 5 THEN CONCAT('"', k, ', ""x\"""') WHEN 6 THEN CONCAT(k, ',') ELSE CONCAT(k, ',', c, ',', p) END"""


@query(
    "csv_cells",
    """WITH o AS (SELECT o_orderkey % 8 AS m, CAST(o_orderkey AS STRING) AS k, CAST(o_custkey AS STRING) AS c, o_orderstatus AS p FROM orders)
    SELECT CASE m WHEN 1 THEN '' WHEN 5 THEN k || ', "x"' ELSE k END AS key, CASE WHEN m IN (0, 1, 4, 6) THEN '' WHEN m = 5 THEN NULL ELSE c END AS cust,
    CASE WHEN m = 1 THEN '' WHEN m IN (2, 5, 6) THEN NULL ELSE p END AS status, CAST(NULL AS STRING) AS reason FROM o""",
)
def csv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells as delivered: an empty one is text, one that a short row doesn't reach is absent; no row is quarantined."""
    path = scratch_path(spark, "csv-cells")
    lines = run(
        spark, sf_dir,
        f"""SELECT {LINES} AS `key,cust,status` FROM (SELECT o_orderkey, CAST(o_orderkey AS STRING) AS k, CAST(o_custkey AS STRING) AS c, o_orderstatus AS p FROM orders)""",
    )
    lines.write.options(header=True, sep="\u0001", quote="").csv(path)
    rows = landing.classify_rows(readers.read_delimited(spark, path))
    return rows.select(*[landing.cell_value(n).alias(n) for n in ("key", "cust", "status")], "reason")


@query("parquet_round_trip", f"WITH {ROWS} SELECT id, cust, CAST(value AS DOUBLE) AS value FROM rws")
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    sinks.write_parquet(table_rows(spark, sf_dir), path, ["id", "cust", "value"], ["id"])
    return readers.read_served(spark, path)


@query(
    "records_round_trip",
    f"WITH {ROWS} SELECT id AS fact_id, note, cust IS NULL AS cust_is_null FROM rws",
)
def records_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    rows = table_rows(spark, sf_dir).select(F.col("id").alias("fact_id"), "note", "cust")
    sinks.write_records(rows, path)
    record = F.from_json("record", "note string, cust string")
    has = F.expr("array_contains(json_object_keys(record), 'cust')")
    return readers.read_records(spark, path).select(
        "fact_id", record["note"].alias("note"), (has & record["cust"].isNull()).alias("cust_is_null")
    )


@query(
    "envelope_scan",
    """SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'nation-' || CAST(c_nationkey AS STRING) ELSE 'file' END AS resource_id, c_nationkey % 3 = 0 AS dated,
    COUNT(*) AS records, COUNT(DISTINCT c_custkey) AS distinct_customers, CAST(SUM(c_custkey) AS BIGINT) AS key_sum FROM customer GROUP BY 1, 2""",
)
def envelope_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of at most 1,000 records; without an index name the file's own name identifies one."""
    path = scratch_path(spark, "envelopes")
    customers = run(spark, sf_dir, "SELECT c_nationkey, c_custkey, c_name FROM customer")
    chunk = F.floor(F.col("c_custkey") / 1000).alias("chunk")
    docs = customers.groupBy("c_nationkey", chunk).agg(
        F.collect_list(F.struct(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"))).alias("records")
    )
    body = F.to_json(F.struct(
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("nation-"), "c_nationkey")).alias("index_name"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit("2025-03-07T10:00:00Z")).alias("updated_date"),
        "records",
    ))
    docs.select(body.alias("value"), F.col("c_nationkey").alias("part")).write.option("maxRecordsPerFile", 1).partitionBy("part").text(path)
    rows = landing.landed(landing.classify_rows(readers.read_envelopes(spark, f"{path}/part=*/*.txt")))
    named = F.when(F.col("resource_id").startswith("nation-"), F.col("resource_id")).otherwise("file")
    key = landing.cell_value("key")
    return rows.groupBy(named.alias("resource_id"), F.col("source_as_of").isNotNull().alias("dated")).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct(key).alias("distinct_customers"), F.sum(key.cast("bigint")).alias("key_sum")
    )


@query("authority_load", f"WITH {AUTHORITY} SELECT state_code, code FROM authority")
def authority_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "authority")
    units = run(spark, sf_dir, f"WITH {AUTHORITY} SELECT state_code, code FROM authority")
    # Envelopes of at most 1,000 records each, one per file.
    chunk = F.floor(F.monotonically_increasing_id() / 1000)
    records = units.withColumn("_c", chunk).groupBy("_c").agg(F.collect_list(F.struct("state_code", "code")).alias("records"))
    records.select(F.to_json(F.struct("records")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_authority(spark, f"{path}/*.txt", ("state_code", "code")).select("state_code", "code")


@query(
    "manifest_audit",
    """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'mismatch' ELSE 'ok' END AS status,
    COUNT(DISTINCT o_orderpriority || CAST(CAST(FLOOR(o_orderkey / 10000) AS BIGINT) AS STRING)) AS files FROM orders GROUP BY 1 UNION ALL SELECT 'missing', 1""",
)
def manifest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of at most 10,000 orders against a manifest with wrong digests and one absent file."""
    path, listing = scratch_path(spark, "files"), scratch_path(spark, "manifest")
    rows = run(spark, sf_dir, "SELECT o_orderpriority || '-' || CAST(CAST(FLOOR(o_orderkey / 10000) AS BIGINT) AS STRING) AS part, CAST(o_orderkey AS STRING) AS value FROM orders")
    rows.repartition("part").write.partitionBy("part").text(path)
    files = readers.digests(spark, path)
    wrong = F.when(F.col("name").contains("1-URGENT"), F.lit("0" * 64)).otherwise(F.col("digest"))
    lines = files.select(F.concat(wrong, F.lit("  "), F.col("name")).alias("value"))
    head = files.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(F.lit("# made by the build"), F.lit(""), F.lit("ff  absent.csv"))).alias("value"))
    lines.unionByName(head).write.text(listing)
    return readers.audit_files(spark, path, listing).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


@query(
    "export_tables",
    f"""WITH {DECIDED} SELECT 'district' AS table_name, COUNT(*) AS row_count FROM facts UNION ALL SELECT 'lineage', COUNT(*) FROM facts""",
)
def export_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served table as CSV and Parquet and one lineage file for all facts, then counted."""
    from ledgerloom.plans.build import write_tables

    states = run(spark, sf_dir, "SELECT CAST(n_nationkey AS STRING) AS code, n_name AS name FROM nation")
    districts = run(spark, sf_dir, "SELECT CAST(s_nationkey AS STRING) AS state_code, CAST(s_suppkey AS STRING) AS code, s_name AS name FROM supplier")
    decided = facts(spark, sf_dir)
    rows = series.district_rows(decided, states, districts)
    counts = write_tables(scratch_path(spark, "dist"), {"district": (rows, ["state_lgd_code", "district_lgd_code", "financial_year", "metric"])},
                          decided.select("fact_id", "confidence", "resolution_rule_id"))
    return counts
