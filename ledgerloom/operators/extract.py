"""Resolved rows to ``observations``: which metric a cell states, in which unit, how precisely."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ids import KEY
from ledgerloom.functions.numbers import MONEY, printed_step, to_decimal
from ledgerloom.functions.units import raw_count
from ledgerloom.presets import PARTIAL_COLUMN, STEM_EXCLUDE, StemRule

COVERAGE = "struct<units_summed:int,units_in_source_universe:int,units_in_authority:int>"
DISCREPANCY = "struct<derived:decimal(28,12),source_provided:decimal(28,12),pct:double,rule_id:string>"

# The central fact table: the canonical key, the arrival ordinal and one publisher's reading.
OBSERVATIONS = {
    **{k: "string" for k in KEY},
    "seq": "bigint",
    "source_id": "string",
    "resource_id": "string",
    "value": MONEY,
    "original_unit": "string",
    "source_as_of": "timestamp",
    "authority_rank": "int",
    "rounding_epsilon": MONEY,
    "edition_span_end": "string",
    "is_edition_terminal": "boolean",
    "coverage": COVERAGE,
    "definition_discrepancy": DISCREPANCY,
}
DEFAULTS = {"rounding_epsilon": 0, "is_edition_terminal": False}


def as_observations(df: DataFrame) -> DataFrame:
    """``df`` in the observations schema; an absent column takes its default or null."""
    columns = []
    for name, kind in OBSERVATIONS.items():
        column = F.col(name) if name in df.columns else F.lit(DEFAULTS.get(name))
        if name in DEFAULTS:
            column = F.coalesce(column, F.lit(DEFAULTS[name]))
        columns.append(column.cast(kind).alias(name))
    return df.select(*columns)


def union_sources(parts: list[DataFrame], stride: int = 1 << 40) -> DataFrame:
    """All sources in one table; the place in ``parts`` decides ties before a row's own ordinal."""
    out = None
    for place, part in enumerate(parts):
        shifted = as_observations(part).withColumn("seq", F.col("seq") + F.lit(place * stride))
        out = shifted if out is None else out.unionByName(shifted)
    if out is None:
        raise ValueError("no sources")
    return out


def _matches(stem: Column, pattern: str) -> Column:
    return stem.rlike("(?i)" + pattern)


def matched_rule(stem: Column, rules: tuple[StemRule, ...], implicit: tuple[str, str] | None) -> Column:
    """``struct(metric, scale)`` of the first rule whose pattern is in the stem, after exclusions.

    Without a stem the implicit metric of the table applies. No match is null.
    """
    def pair(metric: str, scale: str) -> Column:
        return F.struct(F.lit(metric).alias("metric"), F.lit(scale).alias("scale"))

    none = F.lit(None).cast("struct<metric:string,scale:string>")
    found = F.when(_matches(stem, STEM_EXCLUDE), none)
    for rule in rules:
        found = found.when(_matches(stem, rule.pattern), pair(rule.metric, rule.scale))
    found = found.otherwise(none)
    return F.when(stem.isNotNull(), found).otherwise(pair(*implicit) if implicit else none)


def _scaled(df: DataFrame, raw: Column, delivered: Column) -> DataFrame:
    """Add value, unit and rounding step from ``_rule`` and the cell as printed.

    A number (not a string) loses its trailing zeros first, as it does in a binary float.
    """
    text = F.when(delivered != "str", F.regexp_replace(raw, r"(\.[0-9]*?[1-9])0+\z|\.0+\z", "$1")).otherwise(raw)
    plain = F.when((delivered == "float") & ~text.contains("."), F.concat(text, F.lit(".0"))).otherwise(text)
    number = to_decimal(plain)
    scale = F.col("_rule.scale")
    count = raw_count(number, F.when(scale == "count_lakh", "lakh").otherwise("count"))
    value = F.when(scale == "money_lakh", number).otherwise(count["value"])
    unit = F.when(scale == "money_lakh", "lakh").otherwise(count["original_unit"])
    step = F.when(scale == "count_lakh", printed_step(plain)).otherwise(F.lit(0).cast(MONEY))
    return (
        df.withColumn("value", value.cast(MONEY)).withColumn("original_unit", unit)
        .withColumn("rounding_epsilon", step).withColumn("metric", F.col("_rule.metric"))
        .filter(F.col("value").isNotNull())
    )


def extract_long(
    rows: DataFrame,
    rules: tuple[StemRule, ...],
    authority_rank: int,
    implicit: tuple[str, str] | None = None,
    edition_family: bool = False,
    stem: str = "_metric",
    fin_year: str = "_fin_year",
    raw: str = "_value",
    delivered: Column | None = None,
) -> DataFrame:
    """Melted state rows to observations. Partial periods, nulls and unmatched stems are left out.

    In an edition family each resource's last year is stamped as its span end.
    """
    label = F.col(stem) if stem in rows.columns else F.lit(None).cast("string")
    partial = F.coalesce(F.col("_period_qualifier"), F.lit("")) != "" if "_period_qualifier" in rows.columns else F.lit(False)
    kept = rows.filter(
        F.col("state_code").isNotNull() & F.col(fin_year).isNotNull() & F.col(raw).isNotNull() & ~partial
    ).withColumn("_rule", matched_rule(label, rules, implicit)).filter(F.col("_rule").isNotNull())
    scaled = _scaled(kept, F.col(raw), delivered if delivered is not None else F.lit("str"))
    out = (
        scaled.withColumn("fin_year", F.col(fin_year)).withColumn("geo_level", F.lit("state"))
        .withColumn("authority_rank", F.lit(authority_rank)).withColumn("seq", F.col("row_index"))
        .withColumn("district_code", F.lit(None).cast("string"))
    )
    return as_observations(stamp_editions(out) if edition_family else out)


def extract_wide(
    rows: DataFrame, rules: tuple[StemRule, ...], fin_year: str, authority_rank: int, columns: list[str]
) -> DataFrame:
    """National rows, one column per metric, to observations.

    Columns are chosen on the driver by name, so the scan reads only those; the rest is
    ``unpivot`` and the same rule ladder.
    """
    import re

    def wanted(name: str) -> bool:
        if name == fin_year or re.search(STEM_EXCLUDE, name, re.I) or re.search(PARTIAL_COLUMN, name, re.I):
            return False
        return any(re.search(rule.pattern, name, re.I) for rule in rules)

    measures = [c for c in columns if wanted(c)]
    carried = [c for c in ("row_index", "scheme", "source_id", "resource_id", "source_as_of") if c in rows.columns]
    if not measures:
        return as_observations(
            rows.limit(0).select(*carried, F.lit(None).alias("value"), F.lit(None).alias("fin_year"), F.lit(None).alias("metric"),
                                 F.lit("national").alias("geo_level"), F.lit(authority_rank).alias("authority_rank"), F.lit(0).alias("seq"))
        )
    long = (
        rows.filter(F.col(fin_year).isNotNull())
        .select(*carried, F.col(fin_year).alias("_fy"), *[F.col(f"`{m}`").cast("string").alias(m) for m in measures])
        .unpivot([*carried, "_fy"], measures, "_metric", "_value")
        .filter(F.col("_value").isNotNull())
        .withColumn("_rule", matched_rule(F.col("_metric"), rules, None))
        .filter(F.col("_rule").isNotNull())
    )
    order = F.create_map(*[x for i, m in enumerate(measures) for x in (F.lit(m), F.lit(i))])
    out = (
        _scaled(long, F.col("_value"), F.lit("str"))
        .withColumn("seq", F.col("row_index") * len(measures) + F.element_at(order, F.col("_metric")))
        .withColumn("fin_year", F.col("_fy")).withColumn("geo_level", F.lit("national"))
        .withColumn("authority_rank", F.lit(authority_rank))
    )
    return as_observations(out)


def stamp_editions(observations: DataFrame, resource: str = "resource_id") -> DataFrame:
    """Mark every reading with its resource's last year, and the readings of that year as terminal.

    The last year is a partial aggregate joined back, one row per resource.
    """
    spans = observations.groupBy(resource).agg(F.max("fin_year").alias("edition_span_end"))
    plain = observations.drop("edition_span_end", "is_edition_terminal")
    return plain.join(spans, resource, "left").withColumn(
        "is_edition_terminal", F.col("fin_year") == F.col("edition_span_end")
    )
