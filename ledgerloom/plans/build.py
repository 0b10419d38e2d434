"""The whole run: archives in, reconciled tables and lineage out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.operators import extract, lineage, normalize, resolve, rollup, series, wide
from ledgerloom.session import cut_lineage
from ledgerloom.sources import landing, readers, sinks


@dataclass(frozen=True)
class Resource:
    """One published table and everything needed to read it."""

    resource_id: str
    source_id: str
    path: str
    normalize: normalize.NormalizeConfig
    resolve: resolve.GeoConfig
    source_grain: str = "state+annual"
    completeness: str = landing.FULL
    total: landing.TotalRow | None = None


@dataclass(frozen=True)
class Authority:
    """The authority lists and the lookups made from them."""

    state_names: DataFrame
    district_names: DataFrame
    states: DataFrame
    districts: DataFrame
    historical: DataFrame
    notes: DataFrame


def alias_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The curated tables of the preset: state aliases, district aliases, historical names, notes."""
    states = spark.createDataFrame(presets.table_rows(presets.STATE_ALIASES), "name_key string, target string, valid_from string")
    districts = spark.createDataFrame(
        presets.table_rows(presets.DISTRICT_ALIASES), "state_code string, name_key string, target string"
    ).withColumn("valid_from", F.lit(None).cast("string"))
    text = "state_code string, name_key string, text string"
    return (
        states, districts,
        spark.createDataFrame(presets.table_rows(presets.HISTORICAL_NAMES), text),
        spark.createDataFrame(presets.table_rows(presets.UNRESOLVABLE_DISTRICTS), text),
    )


def load_authority(spark: SparkSession, states_path: str, districts_path: str) -> Authority:
    states = readers.read_authority(spark, states_path, ("code", "name"))
    districts = readers.read_authority(spark, districts_path, ("state_code", "code", "name"))
    state_aliases, district_aliases, historical, notes = alias_tables(spark)
    return Authority(
        states, districts, resolve.lookup(states, state_aliases, []),
        resolve.lookup(districts, district_aliases, ["state_code"]), historical, notes,
    )


def resolve_resource(raw: DataFrame, names: list[str], resource: Resource, authority: Authority) -> DataFrame:
    """The rows of one resource, whose records hold the columns ``names``, to resolved-or-quarantined rows."""
    stamped = landing.with_provenance(
        raw, resource.source_id, resource.resource_id, resource.source_grain, resource.completeness, F.col("source_as_of")
    )
    rows = landing.landed(landing.classify_rows(stamped, resource.total))
    carry = ("source_id", "resource_id", "source_as_of")
    cells = normalize.delivered_columns(rows, names, carry)
    done = normalize.normalize(cells, resource.normalize, carry=carry, as_of="source_as_of")
    return resolve.resolve(
        done.rows, resource.resolve, presets.SCHEME_SPELLINGS, presets.CANONICAL_SCHEME,
        authority.states, authority.districts, authority.historical, authority.notes,
    )


def observed_names(scans: dict[str, DataFrame]) -> dict[str, list[str]]:
    """The column names that each scan's records hold, by first appearance, from one job over all scans.

    Only names come to the driver: plans need them to be built.
    """
    if not scans:
        return {}
    each = [scan.select(F.lit(key).alias("resource_id"), "row_index", "raw") for key, scan in scans.items()]
    found = landing.observed_columns(reduce(DataFrame.unionByName, each), ("resource_id",))
    names: dict[str, list[str]] = {key: [] for key in scans}
    for row in sorted(found.collect(), key=lambda r: (r["resource_id"], r["first_seen"])):
        names[row["resource_id"]].append(row["column_name"])
    return names


def wire(spark: SparkSession, resources: list[Resource], authority: Authority) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every resource's plan, and ``(resource_id, deferred_reason)`` for those whose plan fails.

    The names of all resources come from one job. Where that fails, each resource is asked by itself,
    so that only those that can't be read are deferred.
    """
    deferred: list[tuple[str, str]] = []
    scans: dict[str, DataFrame] = {}
    wired: dict[str, DataFrame] = {}

    def attempt(resource: Resource, step: Callable[[], None]) -> None:
        try:
            step()
        except Exception as error:  # noqa: BLE001 - a resource is deferred with its reason, never dropped
            deferred.append((resource.resource_id, f"{type(error).__name__}: {str(error)[:300]}"))

    for resource in resources:
        attempt(resource, lambda r=resource: scans.update({r.resource_id: readers.read_archive(spark, r.path)}))
    try:
        names = observed_names(scans)
    except Exception:  # noqa: BLE001 - the resource at fault is found below
        names = {}
    for resource in (r for r in resources if r.resource_id in scans):
        def plan(r: Resource = resource) -> None:
            raw = scans[r.resource_id]
            known = names[r.resource_id] if names else observed_names({r.resource_id: raw})[r.resource_id]
            wired[r.resource_id] = resolve_resource(raw, known, r, authority)

        attempt(resource, plan)
    return wired, spark.createDataFrame(deferred, "resource_id string, deferred_reason string")


@dataclass(frozen=True)
class Mapping:
    """How the rows of the resources whose id begins with ``prefix`` become observations.

    A state table has one melted row per value, a national one a column per metric and its year in
    its first grain key.
    """

    prefix: str
    rules: tuple[presets.StemRule, ...] = ()
    implicit: tuple[str, str] | None = None
    national: bool = False
    edition_family: bool = False


def preset_mappings() -> list[Mapping]:
    """The mappings of the preset's tables, in the order in which their readings arrive."""
    states = [Mapping(prefix, rules, implicit, edition_family=prefix in presets.EDITION_FAMILY) for prefix, rules, implicit in presets.STATE_RESOURCES]
    return states + [Mapping(prefix, rules, national=True) for prefix, rules in presets.NATIONAL_RESOURCES]


def delivered_type(name: str) -> Column:
    """The type in which a text cell was delivered, from its lineage note."""
    notes = F.array_join(F.coalesce(F.try_element_at("notes", F.lit(name)), F.array().cast("array<string>")), "\n")
    kind = F.regexp_extract(notes, "R2-TYPE-01:([a-z]+)→str", 1)
    return F.when(kind == "", F.lit("str")).otherwise(kind)


def mapped_observations(resource: Resource, rows: DataFrame, mapping: Mapping, authority_rank: int) -> DataFrame:
    """The observations of one resource's resolved rows."""
    good = resolve.resolved(rows)
    if mapping.national:
        return extract.extract_wide(good, mapping.rules, resource.normalize.grain_keys[0], authority_rank, rows.columns)
    return extract.extract_long(good, mapping.rules, authority_rank, mapping.implicit, mapping.edition_family, delivered=delivered_type("_value"))


def primary_observations(primary: DataFrame, districts: DataFrame, source_rank: int = 0) -> tuple[DataFrame, DataFrame]:
    """State and district observations of the primary (cumulative, district-month) table."""
    columns = list(presets.PRIMARY_CUMULATIVE_COLUMNS.values())
    rows = cut_lineage(resolve.resolved(primary), "primary")
    finals = cut_lineage(rollup.unit_finals(rows, [*columns, presets.PRIMARY_TOTAL_COLUMN]), "finals")
    counts = rollup.authority_counts(districts)
    # One row: the table is one publisher's pull of one resource, so its readings carry one stamp.
    once = ("scheme", "source_id", "resource_id")
    stamp = rows.agg(F.max("source_as_of").alias("source_as_of"), *[f(c).alias(f"{n}_{c}") for c in once for n, f in (("least", F.min), ("most", F.max))])
    stamp = stamp.withColumns({"source_as_of": F.col("source_as_of").cast("string")}).first()
    if any(stamp[f"least_{c}"] != stamp[f"most_{c}"] for c in once):
        raise ValueError("the primary table holds more than one scheme, source or resource")

    parts = [
        rollup.state_annual(finals, column, counts).withColumn("metric", F.lit(metric))
        .withColumn("original_unit", F.lit(presets.METRICS[metric].unit))
        for metric, column in presets.PRIMARY_CUMULATIVE_COLUMNS.items()
    ]
    total = rollup.state_annual_total(finals, presets.PRIMARY_TOTAL_COMPONENTS, presets.PRIMARY_TOTAL_COLUMN, counts)
    parts.append(total.withColumn("metric", F.lit("total_expenditure")).withColumn("original_unit", F.lit("lakh"))
                 .withColumnRenamed("discrepancy", "definition_discrepancy"))

    def observed(df: DataFrame, level: str) -> DataFrame:
        # One publisher and one row per key, so the ordinal decides nothing.
        own = {c: F.lit(stamp[f"least_{c}"]) for c in once} | {"source_as_of": F.lit(stamp["source_as_of"]).cast("timestamp")}
        return df.withColumns({**own, "geo_level": F.lit(level), "authority_rank": F.lit(source_rank), "seq": F.lit(0)})

    states = extract.union_sources([observed(p, "state") for p in parts])
    direct = rollup.unit_annual(finals, presets.PRIMARY_CUMULATIVE_COLUMNS, "total_expenditure", presets.PRIMARY_TOTAL_COMPONENTS)
    rate = rollup.complete_year_ratio(rows, presets.PRIMARY_RATE_COLUMN, presets.PRIMARY_CUMULATIVE_COLUMNS["persondays_generated"])
    units = F.create_map(*[F.lit(x) for m, p in presets.METRICS.items() for x in (m, p.unit)])
    fine = direct.unionByName(rate.withColumn("metric", F.lit("avg_wage_rate_per_day"))).withColumn("original_unit", units[F.col("metric")])
    return states, extract.union_sources([observed(fine, "district")])


@dataclass(frozen=True)
class Built:
    facts: DataFrame
    flagged: DataFrame
    blake_ids: bool


def reconcile_all(observations: DataFrame, policy: presets.CorpusPolicy = presets.EMPLOYMENT_POLICY, blake_ids: bool = False) -> Built:
    """Observations of every grain to labelled facts; the marked readings are kept for the lineage."""
    flagged = cut_lineage(wide.flag_any(observations, policy), "readings")
    return Built(cut_lineage(series.assemble(flagged, policy, blake_ids), "facts"), flagged, blake_ids)


#: Where the primary table and all others stand when publishers disagree; the lesser rank wins.
PRIMARY_RANK, PEER_RANK = 0, 10


@dataclass(frozen=True)
class Whole:
    """The result of a build, with what was left out and why: ``(resource_id, deferred_reason)``."""

    built: Built
    wired: dict[str, DataFrame]
    deferred: DataFrame


def build_all(
    spark: SparkSession,
    resources: list[Resource],
    authority: Authority,
    primary_id: str | None,
    mappings: list[Mapping] | None = None,
    policy: presets.CorpusPolicy = presets.EMPLOYMENT_POLICY,
    blake_ids: bool = False,
) -> Whole:
    """All resources to facts of state, national and district grain.

    States: the primary table's years and every mapped state table's. Nation: the primary states
    added up and every mapped national table. Districts: the primary table. A resource that no mapping
    names is deferred with that reason; ``primary_id`` may be None where there is no primary table,
    but one that is named has to be readable.
    """
    wired, deferred = wire(spark, resources, authority)
    mappings = preset_mappings() if mappings is None else mappings
    states, nation, districts = [], [], []
    if primary_id is not None:
        if primary_id not in wired:
            reasons = [r["deferred_reason"] for r in deferred.filter(F.col("resource_id") == primary_id).collect()]
            raise ValueError(f"the primary table can't be read: {reasons or 'not among the resources'}")
        first, fine = primary_observations(wired[primary_id], authority.district_names, PRIMARY_RANK)
        source = next(r.source_id for r in resources if r.resource_id == primary_id)
        first = cut_lineage(first, "primary-states")
        states.append(first)
        nation.append(rollup.national(first, source, PRIMARY_RANK, primary_id))
        districts.append(fine)
    mapped: set[str] = set()
    for mapping in mappings:
        for resource in resources:
            key = resource.resource_id
            if key in wired and key != primary_id and key not in mapped and key.startswith(mapping.prefix):
                mapped.add(key)
                (nation if mapping.national else states).append(mapped_observations(resource, wired[key], mapping, PEER_RANK))
    rest = [(key, "no mapping names this resource") for key in wired if key != primary_id and key not in mapped]
    deferred = deferred.unionByName(spark.createDataFrame(rest, deferred.schema))
    observations = cut_lineage(extract.union_sources([*states, *nation, *districts]), "observations")
    return Whole(reconcile_all(observations, policy, blake_ids), wired, deferred)


def write_tables(
    folder: str, tables: dict[str, tuple[DataFrame, list[str]]], records: DataFrame, single_file: bool = False
) -> DataFrame:
    """Write each table as CSV and Parquet and the records of all facts as JSON lines.

    Returns ``(table_name, row_count)``, counted on what was written.
    """
    spark = records.sparkSession
    counts = None
    for name, (df, sort_by) in tables.items():
        sinks.write_parquet(df, f"{folder}/{name}.parquet", df.columns, sort_by, single_file)
        sinks.write_csv(spark.read.parquet(f"{folder}/{name}.parquet"), f"{folder}/{name}.csv", df.columns, sort_by, single_file)
        part = readers.read_served(spark, f"{folder}/{name}.parquet").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = part if counts is None else counts.unionByName(part)
    sinks.write_records(records, f"{folder}/lineage.jsonl", single_file=single_file)
    lines = readers.read_records(spark, f"{folder}/lineage.jsonl").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.unionByName(lines.select(F.lit("lineage").alias("table_name"), "row_count"))


def export(built: Built, authority: Authority, folder: str) -> DataFrame:
    """The three served tables and one lineage file."""
    facts = built.facts
    tables = {
        "state_annual_series": (series.state_rows(facts, authority.state_names), ["state_lgd_code", "financial_year", "metric"]),
        "national_annual_series": (series.national_rows(facts), ["financial_year", "metric"]),
        "district_flagship": (
            series.district_rows(facts, authority.state_names, authority.district_names),
            ["state_lgd_code", "district_lgd_code", "financial_year", "metric"],
        ),
    }
    rows = lineage.source_rows(built.flagged, built.blake_ids)
    return write_tables(folder, tables, lineage.records(facts, lineage.nested_sources(rows)))
