"""The governed query surface: five parameters, checked one after another, or a refusal with a reason.

``run_query`` answers one request; ``triage.triage`` checks a whole table of requests at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_CAP = 10_000

# The refusal codes.
UNKNOWN_TABLE = "unknown_table"
NOT_QUERYABLE = "table_not_queryable"
MONTHLY = "monthly_wage_unavailable"
BAD_PERIOD = "invalid_period"
SEALED = "record_sealed"
FLOORS = {"state": "state_series_floor", "national": "national_series_floor", "district": "district_series_floor"}
UNKNOWN_METRIC = "unknown_metric"
UNKNOWN_GEOGRAPHY = "unknown_geography"
OVER_CAP = "row_cap_exceeded"


@dataclass(frozen=True)
class ServedTable:
    """A served table: its grain, metrics, name columns and the first year it covers."""

    name: str
    grain: str
    metrics: tuple[str, ...]
    columns: tuple[str, ...]
    floor: str
    floor_pointer: str | None = None


@dataclass(frozen=True)
class Catalog:
    tables: tuple[ServedTable, ...]
    ceiling: str
    not_queryable: tuple[str, ...] = ("lineage",)

    def table(self, name: str) -> ServedTable | None:
        return next((t for t in self.tables if t.name == name), None)

    def home_of(self, metric: str) -> str | None:
        return next((t.name for t in self.tables if metric in t.metrics), None)


@dataclass(frozen=True)
class Request:
    table: str
    metrics: tuple[str, ...] | None = None
    states: tuple[str, ...] | None = None
    districts: tuple[str, ...] | None = None
    fy_from: str | None = None
    fy_to: str | None = None
    month: str | None = None


@dataclass(frozen=True)
class Refusal:
    """The question is outside the record. Not an empty result and not a null cell."""

    code: str
    reason: str
    options: tuple[str, ...] | None = None
    pointer: str | None = None


@dataclass(frozen=True)
class Answer:
    table: str
    filters: dict[str, object]
    row_count: int
    rows: DataFrame


def is_fy(label: str) -> bool:
    """A label of one request, checked before any plan is built."""
    digits = "0123456789"
    if len(label) != 7 or label[4] != "-" or any(c not in digits for c in label[:4] + label[5:]):
        return False
    return int(label[5:]) == (int(label[:4]) + 1) % 100


def period_refusal(catalog: Catalog, table: ServedTable, request: Request) -> Refusal | None:
    for bound in (request.fy_from, request.fy_to):
        if bound is not None and not is_fy(bound):
            return Refusal(BAD_PERIOD, f"{bound} is no financial year: expected YYYY-YY, the suffix being the next year")
    if request.fy_from is not None and request.fy_from > catalog.ceiling:
        return Refusal(SEALED, f"the record ends with {catalog.ceiling}; nothing exists from {request.fy_from} on")
    if request.fy_to is not None and request.fy_to < table.floor:
        return Refusal(FLOORS[table.grain], f"{table.name} starts with {table.floor}", pointer=table.floor_pointer)
    return None


def metric_refusal(catalog: Catalog, table: ServedTable, metrics: Sequence[str]) -> Refusal | None:
    for metric in metrics:
        if metric not in table.metrics:
            home = catalog.home_of(metric)
            where = f"; it is served by {home}" if home else ""
            return Refusal(UNKNOWN_METRIC, f"{table.name} does not serve {metric}{where}", table.metrics, home)
    return None


def distinct_pairs(df: DataFrame, code: str, name: str) -> DataFrame:
    return df.select(code, name).distinct()


def resolve_tokens(df: DataFrame, code: str, name: str, tokens: Sequence[str]) -> tuple[list[str], str | None]:
    """Codes for the given codes or names, in order and without repeats, and the first unknown token.

    A name may stand for several codes. Only the pairs that match a token leave the executors, and
    those are as many as the request named (times the codes sharing a name).
    """
    wanted = [t.strip() for t in tokens]
    lower = [t.casefold() for t in wanted]
    pairs = distinct_pairs(df.filter(F.col(code).isin(wanted) | F.lower(name).isin(lower)), code, name).collect()
    codes = {row[0] for row in pairs}
    by_name: dict[str, list[str]] = {}
    for row in sorted(pairs):
        by_name.setdefault(row[1].casefold(), []).append(row[0])
    found: list[str] = []
    for token, low in zip(wanted, lower):
        if token in codes:
            found.append(token)
        elif low in by_name:
            found.extend(by_name[low])
        else:
            return found, token
    return list(dict.fromkeys(found)), None


def predicate(request: Request, metrics: Sequence[str], states: Sequence[str] | None, districts: Sequence[str] | None) -> Column:
    """The filter of a checked request; plain comparisons that reach the Parquet scan."""
    test = F.col("metric").isin(list(metrics))
    if states is not None:
        test = test & F.col("state_lgd_code").isin(list(states))
    if districts is not None:
        test = test & F.col("district_lgd_code").isin(list(districts))
    if request.fy_from is not None:
        test = test & (F.col("financial_year") >= request.fy_from)
    if request.fy_to is not None:
        test = test & (F.col("financial_year") <= request.fy_to)
    return test


def run_query(served: dict[str, DataFrame], catalog: Catalog, request: Request, row_cap: int = ROW_CAP) -> Answer | Refusal:
    """Check table, month, period, metrics, states, districts and size, in this order, then filter.

    A result above the cap is refused, never cut, with the number of rows that match.
    """
    names = tuple(t.name for t in catalog.tables)
    if request.table in catalog.not_queryable:
        return Refusal(NOT_QUERYABLE, f"{request.table} holds provenance; look facts up by id", names, "get_lineage")
    table = catalog.table(request.table)
    if table is None:
        return Refusal(UNKNOWN_TABLE, f"no table {request.table}", names)
    if request.month is not None:
        return Refusal(MONTHLY, "the series is annual; monthly year-to-date readings are no monthly values")
    early = period_refusal(catalog, table, request)
    if early is not None:
        return early
    metrics = list(request.metrics) if request.metrics is not None else list(table.metrics)
    bad = metric_refusal(catalog, table, metrics)
    if bad is not None:
        return bad
    df = served[table.name]
    resolved: dict[str, list[str] | None] = {}
    for kind, tokens in (("state", request.states), ("district", request.districts)):
        resolved[kind] = None
        if tokens is None:
            continue
        if f"{kind}_lgd_code" not in table.columns:
            pointer = next((t.name for t in catalog.tables if f"{kind}_lgd_code" in t.columns), None) if kind == "district" else None
            return Refusal(UNKNOWN_GEOGRAPHY, f"{table.name} has no {kind}", pointer=pointer)
        codes, unknown = resolve_tokens(df, f"{kind}_lgd_code", f"{kind}_name", tokens)
        if unknown is not None:
            names_of = distinct_pairs(df, "state_lgd_code", "state_name").select("state_name").distinct().collect() if kind == "state" else None
            return Refusal(UNKNOWN_GEOGRAPHY, f"unknown {kind} {unknown}: give a code or a current name",
                           tuple(sorted(r[0] for r in names_of)) if names_of is not None else None, "get_schema" if kind == "district" else None)
        resolved[kind] = codes
    rows = df.filter(predicate(request, metrics, resolved["state"], resolved["district"]))
    count = rows.count()
    if count > row_cap:
        return Refusal(OVER_CAP, f"{count} rows match, more than {row_cap}; narrow the filters")
    filters = {"metrics": metrics, "states": resolved["state"], "districts": resolved["district"],
               "fy_from": request.fy_from, "fy_to": request.fy_to}
    return Answer(table.name, filters, count, rows.select(*table.columns).orderBy(*table.columns))


def list_tables(served: dict[str, DataFrame], catalog: Catalog, lineage: DataFrame | None = None) -> DataFrame:
    """Per table: grain, rows and year range; lineage spans the union of the tables."""
    parts = []
    for table in catalog.tables:
        parts.append(
            served[table.name].agg(
                F.count(F.lit(1)).alias("row_count"), F.min("financial_year").alias("fy_from"), F.max("financial_year").alias("fy_to")
            ).select(F.lit(table.name).alias("table_name"), F.lit(table.grain).alias("grain"), "row_count", "fy_from", "fy_to",
                     F.lit(len(table.metrics)).cast("bigint").alias("metrics"))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if lineage is not None:
        years = out.agg(F.min("fy_from").alias("fy_from"), F.max("fy_to").alias("fy_to"))
        rows = lineage.agg(F.count(F.lit(1)).alias("row_count"))
        # Two one-row tables side by side.
        record = rows.withColumn("_k", F.lit(1)).join(years.withColumn("_k", F.lit(1)), "_k").select(
            F.lit("lineage").alias("table_name"), F.lit("per-fact provenance").alias("grain"), "row_count", "fy_from", "fy_to",
            F.lit(0).cast("bigint").alias("metrics"),
        )
        out = out.unionByName(record)
    return out
