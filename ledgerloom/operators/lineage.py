"""Lineage of facts: one row per reading, nested records for publication, and lookups by fact id.

The flat table (one row per reading and fact) is the working form; any number of readings per fact
is fine there. A nested record holds all readings of its fact, however many; only a caller that asks
for parts of ``part_size`` readings gets several rows of one fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ids import KEY, fact_id
from ledgerloom.functions.text import plain_number
from ledgerloom.operators.rollup import coverage_status
from ledgerloom.presets import NULL_CONFIDENCES, STATUS_BY_CONFIDENCE

BUCKETS = {
    "coverage_absent": "absent",
    "scale_quarantined": "scale_error",
    "edition_superseded": "superseded",
    "partial_period": "partial",
}

#: Digits of an id that name its folder in a published table.
FOLDER_DIGITS = 2

SOURCE = (
    "struct<source_id:string,resource_id:string,value:string,original_unit:string,source_as_of:string,"
    "authority_rank:int,rounding_epsilon:string,edition_span_end:string,is_edition_terminal:boolean,"
    "aggregate_coverage:struct<units_summed:bigint,units_in_source_universe:bigint,units_in_lgd:bigint,status:string>,"
    "definition_discrepancy:struct<derived:string,source_provided:string,pct:string,rule_id:string>>"
)
RECORD = (
    "fact_id string, key struct<scheme:string,geo_level:string,state_code:string,district_code:string,"
    "fin_year:string,month:string,metric:string>, value string, unit string, basis string, confidence string,"
    "resolution_rule_id string, adjudicated boolean, quarantined boolean, quarantine_reason string,"
    f"sources_seen array<{SOURCE}>,"
    "disagreement struct<pct:string,rejected_sources:array<string>,rule_id:string,material:boolean>,"
    + ",".join(f"{bucket} array<{SOURCE}>" for bucket in BUCKETS)
    + ",part int,parts int"
)


def source_rows(flagged: DataFrame, blake_ids: bool = False) -> DataFrame:
    """``(fact_id, seq, source…, flags)``: the readings behind facts, one row each, without a join.

    Readings of a key that comes to no fact are left out, as there is no record to hang them on.
    """
    return flagged.filter("has_fact").select(
        fact_id(blake_ids).alias("fact_id"), "seq", "source_id", "resource_id", "value", "original_unit", "source_as_of",
        "authority_rank", "rounding_epsilon", "edition_span_end", "is_edition_terminal", "coverage",
        "definition_discrepancy", "absent", "partial", "superseded", "scale_error", "rejected", "readings",
    )


def _iso(instant: Column) -> Column:
    """ISO 8601 in UTC, whatever the session's time zone."""
    moment = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
    fraction = F.when(F.date_format(moment, "SSSSSS") != "000000", F.date_format(moment, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def source_struct() -> Column:
    coverage = F.when(
        F.col("coverage").isNotNull(),
        F.struct(
            F.col("coverage.units_summed"), F.col("coverage.units_in_source_universe"),
            F.col("coverage.units_in_authority").alias("units_in_lgd"),
            coverage_status(F.col("coverage")).alias("status"),
        ),
    )
    gap = F.col("definition_discrepancy")
    discrepancy = F.when(
        gap.isNotNull(),
        F.struct(
            plain_number(gap["derived"]).alias("derived"), plain_number(gap["source_provided"]).alias("source_provided"),
            gap["pct"].cast("string").alias("pct"), gap["rule_id"].alias("rule_id"),
        ),
    )
    return F.struct(
        "source_id", "resource_id", plain_number(F.col("value")).alias("value"), "original_unit",
        _iso(F.col("source_as_of")).alias("source_as_of"), "authority_rank",
        plain_number(F.col("rounding_epsilon")).alias("rounding_epsilon"), "edition_span_end", "is_edition_terminal",
        coverage.alias("aggregate_coverage"), discrepancy.alias("definition_discrepancy"),
    )


def nested_sources(sources: DataFrame, part_size: int | None = None) -> DataFrame:
    """``(fact_id, part, parts, sources_seen, …buckets, rejected_sources)`` in arrival order.

    One row per fact, or with ``part_size`` the readings spread over ``ceil(readings / part_size)``
    parts by a hash of their ordinal.
    """
    parts = F.lit(1) if part_size is None else F.ceil(F.col("readings") / part_size).cast("int")
    placed = sources.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("seq"), F.col("parts")).cast("int"))
    entry = F.struct("seq", source_struct().alias("s"), *BUCKETS.values(), "rejected")
    grouped = placed.groupBy("fact_id", "part", "parts").agg(F.array_sort(F.collect_list(entry)).alias("_all"))

    def only(flag: str) -> Column:
        return F.transform(F.filter("_all", lambda e: e[flag]), lambda e: e["s"])

    return grouped.select(
        "fact_id", "part", "parts",
        F.transform("_all", lambda e: e["s"]).alias("sources_seen"),
        *[only(flag).alias(bucket) for bucket, flag in BUCKETS.items()],
        F.transform(F.filter("_all", lambda e: e["rejected"]), lambda e: e["s"]["source_id"]).alias("rejected_sources"),
    )


def records(facts: DataFrame, nested: DataFrame) -> DataFrame:
    """The published lineage: ``fact_id`` and the full record with numbers as strings.

    A record that is one of several parts carries ``part`` and ``parts``.
    """
    joined = facts.join(nested, "fact_id")
    disagreement = F.when(
        F.col("disputed"),
        F.struct(
            F.col("disagreement_pct").cast("string").alias("pct"), "rejected_sources",
            F.col("resolution_rule_id").alias("rule_id"), F.col("material"),
        ),
    )
    several = F.col("parts") > 1
    return joined.select(
        "fact_id",
        F.struct(*KEY).alias("key"),
        plain_number(F.col("value")).alias("value"),
        "unit", "basis", "confidence", "resolution_rule_id", "adjudicated", "quarantined", "quarantine_reason",
        "sources_seen", disagreement.alias("disagreement"), *BUCKETS,
        F.when(several, F.col("part")).alias("part"), F.when(several, F.col("parts")).alias("parts"),
    )


def parse_records(lines: DataFrame) -> DataFrame:
    """JSON lines ``(fact_id, record)`` to typed columns; missing fields become null."""
    return lines.select(F.from_json("record", RECORD).alias("r")).select("r.*")


def status() -> Column:
    """The coarse status of a confidence state; an unknown state passes through."""
    table = F.create_map(*[F.lit(x) for pair in STATUS_BY_CONFIDENCE.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col("confidence")), F.col("confidence"))


def null_reason() -> Column:
    return F.when(F.col("value").isNull() & F.col("confidence").isin(*NULL_CONFIDENCES), F.col("confidence"))


def look_up(requests: DataFrame, lineage: DataFrame) -> DataFrame:
    """Each request with its record; an unknown id gives ``found = false``. ``position`` keeps order."""
    return requests.join(lineage, "fact_id", "left").withColumn("found", F.col("confidence").isNotNull())


def id_folder(digits: int) -> Column:
    """The folder of an id: its first digits behind a letter, so that no reader takes them for a number."""
    return F.concat(F.lit("x"), F.substring("fact_id", 1, digits))


def publish(rows: DataFrame, path: str, digits: int = FOLDER_DIGITS) -> None:
    """Write rows with a ``fact_id`` for look-ups: a folder for each of the ids' first digits, sorted within.

    Ids are digests, so folders are of one size. Rows are dealt by ranges of ids, so a folder is
    written by as many tasks as its size asks for, into files of separate ranges.
    """
    placed = rows.withColumn("id_folder", id_folder(digits)).repartitionByRange("id_folder", "fact_id")
    placed.sortWithinPartitions("id_folder", "fact_id").write.partitionBy("id_folder").parquet(path)


def look_up_published(requests: DataFrame, path: str, digits: int = FOLDER_DIGITS) -> DataFrame:
    """``look_up`` in a published table, of which only the folders asked for are read.

    The driver learns which folders those are: at most 16 ** ``digits`` short names, however many
    requests there are. An id that is no digest is in none of them.
    """
    asked = requests.filter(F.col("fact_id").rlike(f"^[0-9a-f]{{{digits}}}")).select(id_folder(digits).alias("f")).distinct()
    folders = [r["f"] for r in asked.collect()]
    table = requests.sparkSession.read.parquet(path)
    return look_up(requests, table.filter(F.col("id_folder").isin(folders)).drop("id_folder"))


def rejected_values(sources: DataFrame) -> DataFrame:
    """Readings whose publisher is among the rejected ones of their fact.

    The winner shows up too when its publisher also has a rejected reading. The rejected publishers
    are reduced to distinct pairs before the join.
    """
    refused = sources.filter("rejected").groupBy("fact_id", "source_id").agg(F.lit(True).alias("_refused"))
    return sources.join(refused, ["fact_id", "source_id"], "left_semi").select("fact_id", "seq", "source_id", "resource_id", "value")


def materiality(facts: DataFrame) -> DataFrame:
    """Per disputed fact: the spread over all readings seen, null with fewer than two."""
    return facts.filter("disputed").select(
        "fact_id", F.col("seen_spread").alias("absolute"), "unit", F.col("disagreement_pct").alias("relative_pct"), "material"
    )
