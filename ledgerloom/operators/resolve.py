"""Names to authority codes by name joins; what does not resolve is quarantined with its reason.

Exact names and aliases are merged into one lookup table per level beforehand, so each level costs
one left join. The join strategy is left to Spark: a lookup below the broadcast threshold is sent
to the executors, a larger one is joined by shuffle with adaptive skew handling.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.periods import fy_start
from ledgerloom.functions.text import canonical_scheme, name_key

UNKNOWN_SCHEME = "unknown_scheme"
UNRESOLVED = "unresolved_geography"
HISTORICAL = "historical_geography_not_in_current_lgd"
EXACT_RULE = "R3-GEO-02"
ALIAS_RULE = "R3-GEO-03:"


@dataclass(frozen=True)
class GeoConfig:
    """Which level a resource speaks about and which of its columns hold the names."""

    geo_level: str
    scheme_label: str
    state_name: str | None = None
    state_code: str | None = None
    district_name: str | None = None
    district_code: str | None = None
    fin_year: str | None = "_fin_year"

    def __post_init__(self) -> None:
        if self.geo_level not in ("national", "state", "district"):
            raise ValueError(f"unknown level {self.geo_level!r}")
        if (self.geo_level == "national") != (self.state_name is None):
            raise ValueError("a national resource has no name columns, any other needs the state name")
        if self.geo_level == "district" and self.district_name is None:
            raise ValueError("a district resource needs the district name")


def authority(dimension: DataFrame, keys: list[str]) -> DataFrame:
    """``dimension`` with its match key, one row per key: of equal names the later one counts."""
    keyed = dimension.withColumn("name_key", name_key(F.col("name")))
    return keyed.groupBy(*keys, "name_key").agg(
        F.max_by("code", "row_index").alias("code"), F.max_by("name", "row_index").alias("name")
    )


def lookup(dimension: DataFrame, aliases: DataFrame, keys: list[str]) -> DataFrame:
    """Exact keys and alias keys in one table ``(keys…, name_key, code, name, rule_id, valid_from)``.

    An alias counts only where no exact key exists and its target is in the authority list. Each key has
    one row, so that a join never multiplies rows: of aliases with equal keys the one valid earliest
    counts, then the one with the least code.
    """
    exact = authority(dimension, keys)
    targets = exact.select(*keys, F.col("name_key").alias("target_key"), "code", "name")
    spelled = aliases.withColumn("target_key", name_key(F.col("target")))
    mapped = (
        spelled.join(targets, [*keys, "target_key"])
        .join(exact.select(*keys, "name_key"), [*keys, "name_key"], "left_anti")
        .select(
            *keys, "name_key", "code", "name",
            F.concat(F.lit(ALIAS_RULE), F.col("name_key")).alias("rule_id"),
            F.col("valid_from").cast("int").alias("valid_from"),
        )
    )
    first = F.min(F.struct("valid_from", "code", "name", "rule_id")).alias("a")
    mapped = mapped.groupBy(*keys, "name_key").agg(first).select(*keys, "name_key", "a.code", "a.name", "a.rule_id", "a.valid_from")
    plain = exact.select(
        *keys, "name_key", "code", "name", F.lit(EXACT_RULE).alias("rule_id"), F.lit(None).cast("int").alias("valid_from")
    )
    return plain.unionByName(mapped)


def quoted(name: Column) -> Column:
    """A name in quotes as the quarantine texts print it; null prints as None."""
    mark = F.when(name.contains("'") & ~name.contains('"'), F.lit('"')).otherwise(F.lit("'"))
    return F.coalesce(F.concat(mark, name, mark), F.lit("None"))


def resolve(
    rows: DataFrame,
    config: GeoConfig,
    spellings: tuple[str, ...],
    canonical: str,
    states: DataFrame,
    districts: DataFrame | None = None,
    historical: DataFrame | None = None,
    notes: DataFrame | None = None,
) -> DataFrame:
    """``rows`` plus the authority identity, the resolution record, ``reason`` and ``detail``.

    ``states`` and ``districts`` are lookups; ``historical`` and ``notes`` are
    ``(state_code, name_key, text)``, the state code null for a state.
    """
    scheme = canonical_scheme(F.lit(config.scheme_label), spellings, canonical)
    out = rows.withColumn("scheme", scheme).withColumn("geo_level", F.lit(config.geo_level))
    unknown = F.when(F.col("scheme").isNull(), F.lit(UNKNOWN_SCHEME))
    unknown_text = F.lit(f"scheme:'{config.scheme_label}'")
    null = F.lit(None).cast("string")
    field_type = "struct<rule_id:string,source_code:string,source_name:string,authority_code:string>"

    if config.geo_level == "national":
        kept = [c for c in rows.columns if c not in ("state_code", "district_code")]
        return out.select(
            *kept, "scheme", "geo_level",
            null.alias("state_code"), null.alias("state_name_canonical"),
            null.alias("district_code"), null.alias("district_name_canonical"),
            F.lit(None).cast(f"struct<state:{field_type},district:{field_type}>").alias("geo_resolution"),
            unknown.alias("reason"), F.when(unknown.isNotNull(), unknown_text).alias("detail"),
        )

    name = F.col(config.state_name)
    code = F.col(config.state_code) if config.state_code else null
    out = out.withColumn("_key", name_key(name))
    found = states.select(
        F.col("name_key").alias("_key"), F.col("code").alias("_s_code"), F.col("name").alias("_s_name"),
        F.col("rule_id").alias("_s_rule"), F.col("valid_from").alias("_s_from"),
    )
    out = out.join(found, "_key", "left")
    out = _attach_text(out, historical, "_s_past", None)
    start = fy_start(F.col(config.fin_year)) if config.fin_year in rows.columns else F.lit(None).cast("int")
    early = F.col("_s_from").isNotNull() & (start.isNull() | (start < F.col("_s_from")))
    state_text = F.concat(F.lit("state:"), quoted(name))
    missing = F.col("_s_code").isNull()
    reason = (
        F.when(unknown.isNotNull(), unknown)
        .when(missing & F.col("_s_past").isNotNull(), F.lit(HISTORICAL))
        .when(missing, F.lit(UNRESOLVED))
        .when(early, F.lit(HISTORICAL))
    )
    detail = (
        F.when(unknown.isNotNull(), unknown_text)
        .when(missing & F.col("_s_past").isNotNull(), F.concat(state_text, F.lit(" — "), F.col("_s_past")))
        .when(missing, state_text)
        .when(early, F.concat(state_text, F.lit(" — name not valid before FY start "), F.col("_s_from").cast("string"),
                              F.lit(" (row: "), F.coalesce(start.cast("string"), F.lit("None")), F.lit(")")))
    )
    state_field = F.struct(
        F.col("_s_rule").alias("rule_id"), code.alias("source_code"), name.alias("source_name"),
        F.col("_s_code").alias("authority_code"),
    ).cast(field_type)
    d_code, d_name, district_field = null, null, F.lit(None).cast(field_type)

    if config.geo_level == "district":
        d_label = F.col(config.district_name)
        out = out.withColumn("_d_key", name_key(d_label))
        places = districts.select(
            F.col("state_code").alias("_s_code"), F.col("name_key").alias("_d_key"), F.col("code").alias("_d_code"),
            F.col("name").alias("_d_name"), F.col("rule_id").alias("_d_rule"),
        )
        out = out.join(places, ["_s_code", "_d_key"], "left")
        out = _attach_text(out, historical, "_d_past", "_d_key")
        out = _attach_text(out, notes, "_d_note", "_d_key")
        where = F.concat(F.lit("district:"), quoted(d_label), F.lit(" in state "), F.col("_s_name"),
                         F.lit("("), F.col("_s_code"), F.lit(")"))
        lost = F.col("_d_code").isNull()
        past, note = F.col("_d_past"), F.col("_d_note")
        reason = reason.when(lost & past.isNotNull(), F.lit(HISTORICAL)).when(lost, F.lit(UNRESOLVED))
        detail = (
            detail.when(lost & past.isNotNull(), F.concat(where, F.lit(" — "), past))
            .when(lost & note.isNotNull(), F.concat(where, F.lit(" — "), note))
            .when(lost, where)
        )
        d_code, d_name = F.col("_d_code"), F.col("_d_name")
        source_code = F.col(config.district_code) if config.district_code else null
        district_field = F.when(
            d_code.isNotNull(),
            F.struct(F.col("_d_rule").alias("rule_id"), source_code.alias("source_code"),
                     d_label.alias("source_name"), d_code.alias("authority_code")).cast(field_type),
        )

    kept = [c for c in rows.columns if c not in ("state_code", "district_code")]
    identity = out.withColumn("_reason", reason)
    good = F.col("_reason").isNull()
    return identity.select(
        *kept, "scheme", "geo_level",
        F.when(good, F.col("_s_code")).alias("state_code"),
        F.when(good, F.col("_s_name")).alias("state_name_canonical"),
        F.when(good, d_code).alias("district_code"),
        F.when(good, d_name).alias("district_name_canonical"),
        F.when(good, F.struct(state_field.alias("state"), district_field.alias("district"))).alias("geo_resolution"),
        F.col("_reason").alias("reason"), F.when(~good, detail).alias("detail"),
    )


def _attach_text(df: DataFrame, texts: DataFrame | None, name: str, district_key: str | None) -> DataFrame:
    """``df`` with the text known of its name, the least one where several are."""
    if texts is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    least = texts.groupBy("state_code", "name_key").agg(F.min("text").alias(name))
    if district_key is None:
        return df.join(least.filter(F.col("state_code").isNull()).select(F.col("name_key").alias("_key"), name), "_key", "left")
    known = least.filter(F.col("state_code").isNotNull()).select(F.col("state_code").alias("_s_code"), F.col("name_key").alias(district_key), name)
    return df.join(known, ["_s_code", district_key], "left")


def resolved(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull()).drop("reason", "detail")


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull())
