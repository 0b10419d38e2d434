"""A table of requests checked at once: what each would be refused for, or how many rows it asks for.

The checks are those of ``serve.run_query``, in its order; the first that fails decides. The catalog is
configuration and becomes literals. Place tokens become rows and are resolved by an equality join with
the served places. How many rows a request matches is read off a table of cumulative counts per metric
and place, the rows up to each year, as a difference of two of its entries: the facts are read once to
make it, however many requests there are, and a size is exact above the cap too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.periods import well_formed_fy
from ledgerloom.functions.text import trimmed
from ledgerloom.operators import serve
from ledgerloom.operators.serve import Catalog, ServedTable
from ledgerloom.session import cut_lineage

KINDS = ("state", "district")
REFUSAL = "struct<code: string, reason: string, options: array<string>, pointer: string>"


def _strings(values: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _refusal(test: Column, code: Column | str, reason: Column | str, options: Column | None = None, pointer: Column | str | None = None) -> Column:
    """The refusal as a struct where ``test`` holds, else null."""
    column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(test, F.struct(
        column(code).alias("code"), column(reason).alias("reason"), (options if options is not None else F.lit(None)).alias("options"), column(pointer).alias("pointer"),
    ).cast(REFUSAL))


def _rules(catalog: Catalog, like: DataFrame) -> DataFrame:
    """The catalog as rows, one a table."""
    rows = [(t.name, list(t.metrics), t.floor, serve.FLOORS[t.grain], t.floor_pointer, *(_has(t, kind) for kind in KINDS)) for t in catalog.tables]
    return like.sparkSession.createDataFrame(
        rows, "table_name string, table_metrics array<string>, floor string, floor_code string, floor_pointer string, has_state boolean, has_district boolean").coalesce(1)


def _has(table: ServedTable, kind: str) -> bool:
    return f"{kind}_lgd_code" in table.columns


def served_places(served: dict[str, DataFrame], catalog: Catalog) -> DataFrame:
    """``(table_name, kind, code, name)`` of every place that a served table has."""
    parts = [
        serve.distinct_pairs(served[t.name], f"{kind}_lgd_code", f"{kind}_name").toDF("code", "name").select(F.lit(t.name).alias("table_name"), F.lit(kind).alias("kind"), "code", "name")
        for t in catalog.tables for kind in KINDS if _has(t, kind)
    ]
    return reduce(DataFrame.unionByName, parts)


def cumulative_counts(served: dict[str, DataFrame], catalog: Catalog) -> DataFrame:
    """``(table_name, level, metric, place, state, total, years)``: rows in all, and up to each year.

    Levels are the whole table, a state, and a district (with its state). ``years`` has one entry for
    each financial year.
    """
    parts = []
    for t in catalog.tables:
        state = F.col("state_lgd_code") if _has(t, "state") else F.lit(None).cast("string")
        base = served[t.name].groupBy("metric", "financial_year", *[f"{k}_lgd_code" for k in KINDS if _has(t, k)]).agg(F.count(F.lit(1)).alias("n"))
        places = [F.struct(F.lit("all").alias("level"), F.lit("").alias("place"), F.lit(None).cast("string").alias("state"))]
        if _has(t, "state"):
            places.append(F.struct(F.lit("state").alias("level"), F.col("state_lgd_code").alias("place"), state.alias("state")))
        if _has(t, "district"):
            places.append(F.struct(F.lit("district").alias("level"), F.col("district_lgd_code").alias("place"), state.alias("state")))
        parts.append(base.select(F.lit(t.name).alias("table_name"), "metric", "financial_year", "n", F.explode(F.array(*places)).alias("p")).select("table_name", "p.*", "metric", "financial_year", "n"))
    keys = ["table_name", "level", "metric", "place", "state"]
    yearly = reduce(DataFrame.unionByName, parts).groupBy(*keys, "financial_year").agg(F.sum("n").alias("n"))
    # Nulls come first and are left out of the running count: a year that is not known is in no range.
    known = F.when(F.col("financial_year").isNotNull(), F.col("n")).otherwise(0)
    running = yearly.withColumn("upto", F.sum(known).over(Window.partitionBy(*keys).orderBy("financial_year")))
    entry = F.when(F.col("financial_year").isNotNull(), F.struct(F.col("financial_year").alias("fy"), "upto"))
    return running.groupBy(*keys).agg(F.sum("n").alias("total"), F.collect_list(entry).alias("years"))


def _resolved(asked: DataFrame, places: DataFrame, catalog: Catalog) -> DataFrame:
    """Per request and kind of place: the codes of its tokens, in order, and its first unknown token."""
    parts = []
    for kind in KINDS:
        having = [t.name for t in catalog.tables if _has(t, kind)]
        parts.append(asked.filter(F.col("table_name").isin(having)).select("request_id", "table_name", F.lit(kind).alias("kind"), F.posexplode(f"{kind}s").alias("pos", "token")))
    tokens = reduce(DataFrame.unionByName, parts)
    tokens = tokens.withColumn("key", trimmed(F.col("token"))).withColumn("low", F.lower("key"))
    # A token is a code if any place has it as one; otherwise a name, which may stand for several.
    exact = places.groupBy("table_name", "kind", F.col("code").alias("key")).agg(F.array(F.any_value("code")).alias("c"))
    named = places.groupBy("table_name", "kind", F.lower("name").alias("low")).agg(F.sort_array(F.collect_set("code")).alias("n"))
    each = tokens.join(exact, ["table_name", "kind", "key"], "left").join(named, ["table_name", "kind", "low"], "left").select(
        "request_id", "kind", "pos", "token", F.coalesce("c", "n", F.array().cast("array<string>")).alias("codes"))
    unknown = F.size("codes") == 0
    figures = []
    for kind in KINDS:
        here = F.col("kind") == kind
        figures += [
            F.min(F.when(here & unknown, F.struct("pos", "token"))).alias(f"{kind}_unknown"),
            F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.when(here, F.struct("pos", "codes")))), lambda x: x["codes"]))).alias(f"{kind}_codes"),
        ]
    return each.groupBy("request_id").agg(*figures)


def _sizes(inside: DataFrame, counts: DataFrame) -> DataFrame:
    """``(request_id, row_count)`` of requests that no check refuses."""
    place = lambda level, code: F.struct(F.lit(level).alias("level"), code.alias("place"))
    places = F.when(F.col("districts").isNotNull(), F.transform("district_codes", lambda c: place("district", c))).when(
        F.col("states").isNotNull(), F.transform("state_codes", lambda c: place("state", c))).otherwise(F.array(place("all", F.lit(""))))
    lines = inside.withColumn("metric", F.explode(F.array_distinct("all_metrics"))).withColumn("p", F.explode(places)).select(
        "request_id", "table_name", "metric", "p.level", "p.place", "fy_from", "fy_to", F.when(F.col("states").isNotNull(), F.col("state_codes")).alias("in_states"))
    met = lines.join(counts, ["table_name", "level", "metric", "place"]).filter("level <> 'district' OR in_states IS NULL OR array_contains(in_states, state)")
    upto = lambda test: f"coalesce(array_max(transform(filter(years, y -> {test}), y -> y.upto)), 0L)"
    rows = F.expr(f"CASE WHEN fy_from IS NULL AND fy_to IS NULL THEN total ELSE greatest({upto('fy_to IS NULL OR y.fy <= fy_to')} - {upto('y.fy < fy_from')}, 0L) END")
    return met.groupBy("request_id").agg(F.sum(rows).alias("row_count"))


def triage(requests: DataFrame, catalog: Catalog, served: dict[str, DataFrame], row_cap: int = serve.ROW_CAP) -> DataFrame:
    """``requests(request_id, table_name, metrics, states, districts, fy_from, fy_to, month)``, the lists
    null where nothing is asked, with ``code, reason, options, pointer`` of the first check that refuses
    each (null where none does), and its filters and ``row_count`` where only the cap may refuse it.

    Ids are unique. An empty list matches no rows; a null in a list is an unknown metric or place.
    """
    names = tuple(t.name for t in catalog.tables)
    asked = cut_lineage(requests.select("request_id", "table_name", "metrics", "states", "districts", "fy_from", "fy_to", "month"), "requests")
    places = cut_lineage(served_places(served, catalog), "places")
    listed = places.filter("kind = 'state'").groupBy("table_name").agg(F.array_sort(F.collect_set("name")).alias("state_names"))
    rules = _rules(catalog, asked).join(listed, "table_name", "left")
    checked = asked.join(_resolved(asked, places, catalog), "request_id", "left").join(rules, "table_name", "left").withColumn(
        "all_metrics", F.coalesce("metrics", "table_metrics")).withColumn("odd_metrics", F.array_except("metrics", "table_metrics"))

    name, low, high = F.col("table_name"), F.col("fy_from"), F.col("fy_to")
    malformed = F.array_compact(F.array(*[F.when(b.isNotNull() & ~well_formed_fy(b), b) for b in (low, high)]))
    odd = F.get("odd_metrics", F.lit(0))
    home = F.coalesce(*[F.when(odd.isin(list(t.metrics)), t.name) for t in catalog.tables])
    checks = [
        _refusal(name.isin(list(catalog.not_queryable)), serve.NOT_QUERYABLE, F.concat(name, F.lit(" holds provenance; look facts up by id")), _strings(names), "get_lineage"),
        _refusal(F.coalesce(~name.isin(list(names)), F.lit(True)), serve.UNKNOWN_TABLE, F.concat(F.lit("no table "), F.coalesce(name, F.lit("given"))), _strings(names)),
        _refusal(F.col("month").isNotNull(), serve.MONTHLY, "the series is annual; monthly year-to-date readings are no monthly values"),
        _refusal(F.size(malformed) > 0, serve.BAD_PERIOD, F.concat(F.get(malformed, F.lit(0)), F.lit(" is no financial year: expected YYYY-YY, the suffix being the next year"))),
        _refusal(low > catalog.ceiling, serve.SEALED, F.concat(F.lit(f"the record ends with {catalog.ceiling}; nothing exists from "), low, F.lit(" on"))),
        _refusal(high < F.col("floor"), F.col("floor_code"), F.concat(name, F.lit(" starts with "), F.col("floor")), pointer=F.col("floor_pointer")),
        _refusal(F.size("odd_metrics") > 0, serve.UNKNOWN_METRIC,
                 F.concat(name, F.lit(" does not serve "), F.coalesce(odd, F.lit("null")), F.coalesce(F.concat(F.lit("; it is served by "), home), F.lit(""))), F.col("table_metrics"), home),
    ]
    for kind in KINDS:
        elsewhere = next((t.name for t in catalog.tables if _has(t, kind)), None) if kind == "district" else None
        first = F.col(f"{kind}_unknown")
        checks += [
            _refusal(F.col(f"{kind}s").isNotNull() & ~F.col(f"has_{kind}"), serve.UNKNOWN_GEOGRAPHY, F.concat(name, F.lit(f" has no {kind}")), pointer=elsewhere),
            _refusal(F.col(f"{kind}s").isNotNull() & first.isNotNull(), serve.UNKNOWN_GEOGRAPHY,
                     F.concat(F.lit(f"unknown {kind} "), F.coalesce(first["token"], F.lit("null")), F.lit(": give a code or a current name")),
                     F.col("state_names") if kind == "state" else None, "get_schema" if kind == "district" else None),
        ]
    judged = cut_lineage(checked.withColumn("refusal", F.get(F.array_compact(F.array(*checks)), F.lit(0))).drop("odd_metrics", *rules.columns[1:]), "judged")
    sizes = _sizes(judged.filter("refusal IS NULL"), cumulative_counts(served, catalog))
    size = F.coalesce("row_count", F.lit(0))
    over = _refusal(size > row_cap, serve.OVER_CAP, F.concat(size.cast("string"), F.lit(f" rows match, more than {row_cap}; narrow the filters")))
    inside = lambda column: F.when(F.col("refusal").isNull(), column)
    given = lambda kind: inside(F.when(F.col(f"{kind}s").isNotNull(), F.coalesce(f"{kind}_codes", F.array().cast("array<string>"))))
    return judged.join(sizes, "request_id", "left").withColumn("final", F.coalesce("refusal", over)).select(
        "request_id", "table_name", "final.code", "final.reason", "final.options", "final.pointer", inside(F.col("all_metrics")).alias("metrics"),
        given("state").alias("states"), given("district").alias("districts"), inside(size).cast("long").alias("row_count"))
