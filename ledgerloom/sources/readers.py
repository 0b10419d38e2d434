"""File scans: JSON envelopes, CSV tables, served Parquet and NDJSON, authority lists, manifests."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "index_name string, updated_date string, title string, records array<string>"
#: A quoted cell; a doubled quote within it is a quote.
QUOTED_CELL = r'"(?:[^"]|"")*"'
FORMATS = {".json": "envelope", ".csv": "csv"}


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """``(resource_id, source_as_of, row_index, raw)`` of every record of every envelope at ``path``.

    One envelope is one JSON document, so a file is read by one task; many files spread out.
    """
    docs = spark.read.schema(ENVELOPE).option("multiLine", True).json(path)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"\A(.*?)(?:\.[^.]*)?\z", 1)
    return docs.select(
        F.coalesce("index_name", stem).alias("resource_id"),
        F.col("updated_date").try_cast("timestamp").alias("source_as_of"),
        F.posexplode("records").alias("row_index", "raw"),
    ).withColumn("row_index", F.col("row_index").cast("bigint"))


def read_delimited(spark: SparkSession, path: str, quoted_newlines: bool = False) -> DataFrame:
    """``(file, row_index, raw)`` of a CSV table, every cell a string, no as-of date.

    Header cells are trimmed, extra cells are dropped. A delivered cell keeps its text, an empty one
    as ``""``; the columns that a short row doesn't reach are left out. Blank lines are no rows.
    ``row_index`` rises with the place in the file; it is unique over the whole read. A file whose
    quoted cells hold line breaks needs ``quoted_newlines`` and is then read by one task.
    """
    options = {"header": True, "escape": '"', "multiLine": quoted_newlines}
    raw_names = spark.read.options(**options).csv(path).columns
    # Spark fills the record column for the rows of a wrong length only.
    record = "_record"
    while record in raw_names:
        record += "_"
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in [*raw_names, record])
    table = spark.read.schema(schema).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=record).csv(path)
    delivered = F.size(F.split(F.regexp_replace(record, QUOTED_CELL, ""), ",", -1))
    cells = [
        F.when(F.col(record).isNull() | (delivered > k), F.coalesce(F.col(f"`{name.replace('`', '``')}`"), F.lit(""))).alias(name.strip().lstrip("\ufeff"))
        for k, name in enumerate(raw_names)
    ]
    return table.select(
        F.col("_metadata.file_name").alias("file"),
        F.monotonically_increasing_id().alias("row_index"),
        F.to_json(F.struct(*cells)).alias("raw"),
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Dispatch on the file suffix; another suffix is an error."""
    for suffix, kind in FORMATS.items():
        if path.lower().endswith(suffix):
            if kind == "envelope":
                return read_envelopes(spark, path)
            stem = F.regexp_extract(F.col("file"), r"\A(.*?)(?:\.[^.]*)?\z", 1)
            return read_delimited(spark, path).select(
                stem.alias("resource_id"), F.lit(None).cast("timestamp").alias("source_as_of"), "row_index", "raw"
            )
    raise ValueError(f"unsupported archive format: {path}")


def read_authority(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """An authority list (``records`` of an envelope), every code and name as a string.

    ``row_index`` is kept: where two entries share a name the later one counts.
    """
    rows = read_envelopes(spark, path)
    cells = F.from_json("raw", "map<string,string>")
    picked = rows.select("row_index", *[F.try_element_at(cells, F.lit(c)).alias(c) for c in columns])
    return require_names(picked, columns[-1])


def require_names(df: DataFrame, column: str) -> DataFrame:
    """Fail the job at the first null name: such an authority list is corrupt."""
    checked = F.when(F.col(column).isNull(), F.raise_error(F.lit(f"null {column} in authority list"))).otherwise(F.col(column))
    return df.withColumn(column, checked)


def read_served(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(fact_id, record)`` of a JSON-lines file, the record kept as text."""
    lines = spark.read.text(path).filter(F.length("value") > 0)
    return lines.select(F.get_json_object("value", "$.fact_id").alias("fact_id"), F.col("value").alias("record"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(name, expected)`` of a ``<sha256>  <name>`` manifest; ``#`` and blank lines are skipped."""
    line = F.trim("value")
    kept = spark.read.text(path).select(line.alias("line")).filter((line != "") & ~line.startswith("#"))
    return kept.select(
        F.trim(F.regexp_extract("line", r"\A(.*?)  (.*)\z", 2)).alias("name"),
        F.trim(F.regexp_extract("line", r"\A(.*?)  (.*)\z", 1)).alias("expected"),
    )


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """``(name, digest)`` of every file below ``folder``, the name relative to it."""
    base = folder.rstrip("/").rsplit("/", 1)[-1]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(
        F.regexp_replace("path", rf"\A.*?/{re.escape(base)}/", "").alias("name"), F.sha2("content", 256).alias("digest")
    )


def audit_files(spark: SparkSession, folder: str, manifest: str) -> DataFrame:
    """``(name, expected, actual, status)`` for every manifest entry: ok, missing or mismatch.

    ``binaryFile`` holds one file per row, so a file above 2 GB cannot be hashed this way.
    """
    files = digests(spark, folder).withColumnRenamed("digest", "actual")
    joined = read_manifest(spark, manifest).join(files, "name", "left")
    status = F.when(F.col("actual").isNull(), "missing").when(F.col("actual") != F.col("expected"), "mismatch").otherwise("ok")
    return joined.withColumn("status", status)


def require_intact(audit: DataFrame) -> None:
    """Raise for the first bad file in name order (one row reaches the driver)."""
    bad = audit.filter(F.col("status") != "ok").orderBy("name").limit(1).collect()
    if bad:
        row = bad[0]
        raise RuntimeError(f"artifact {row['status']}: {row['name']} (expected {row['expected']}, got {row['actual']})")
