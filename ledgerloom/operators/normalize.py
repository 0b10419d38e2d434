"""The cleaning stage: reshape, clean every cell, dedupe on cleaned keys, then type the survivors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import numbers, periods, text
from ledgerloom.operators import dedupe
from ledgerloom.operators.reshape import ReshapeSpec, reshape, reshape_notes
from ledgerloom.sources.landing import cell_type, cell_value

TYPES = ("string", "int", "decimal", "fy", "month")


@dataclass(frozen=True)
class NormalizeConfig:
    """Per resource: column types (default string), grain keys and the reshape that runs first."""

    grain_keys: tuple[str, ...]
    column_types: dict[str, str] = field(default_factory=dict)
    reshape: ReshapeSpec = ReshapeSpec()


@dataclass(frozen=True)
class Normalized:
    """The typed rows with their notes, the rows without a key, the rows that lost, and the counts."""

    rows: DataFrame
    quarantined: DataFrame
    collapsed: DataFrame
    summary: DataFrame


def typed_value(value: Column, delivered: Column, kind: str) -> Column:
    """A cleaned cell coerced to ``kind``; what does not parse is null. Periods come trimmed."""
    is_text = delivered == "str"
    if kind == "fy":
        return periods.fy_value(value, is_text)
    if kind == "month":
        return periods.month_value(value, is_text)
    if kind == "string":
        return value
    numeric = F.when(delivered != "bool", value)
    return numbers.to_whole(numeric) if kind == "int" else numbers.to_decimal(numeric)


def typed_note(value: Column, typed: Column, delivered: Column, kind: str) -> Column:
    """The lineage note of ``typed_value``."""
    if kind in ("fy", "month"):
        return periods.date_note(value, typed)
    if kind == "string":
        moved = F.concat(F.lit("R2-TYPE-01:"), delivered, F.lit("→str"))
        return F.when(value.isNotNull() & (delivered != "str"), moved)
    return numbers.typed_note(value, typed, kind, delivered)


def delivered_columns(landed_rows: DataFrame, names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed cells as ``struct(v, t)`` columns, keeping the delivered type for the notes."""
    cells = [F.struct(cell_value(n).alias("v"), cell_type(n).alias("t")).alias(n) for n in names]
    return landed_rows.select("row_index", *keep, *cells)


def normalize(delivered: DataFrame, config: NormalizeConfig, carry: tuple[str, ...] = (), as_of: str | None = None) -> Normalized:
    """``delivered`` has ``row_index``, the ``carry`` columns and ``struct(v, t)`` cells."""
    unknown = set(config.column_types.values()) - set(TYPES)
    if unknown:
        raise ValueError(f"unknown column types: {sorted(unknown)}")
    long = reshape(delivered, config.reshape, carry=carry)
    names = [c for c in long.columns if c not in {"row_index", *carry}]
    kinds = {n: config.column_types.get(n, "string") for n in names}
    keys = list(config.grain_keys)
    keep = ["row_index", *carry]

    def each(*builders: Callable[[str], Column]) -> list[Column]:
        return [build(n) for n in names for build in builders]

    # One small projection per step: cell and type, trimmed body, cleaned value and note. Each step
    # reads the columns of the one before, so no expression is evaluated twice.
    bodies = long.select(
        *keep,
        *each(
            lambda n: F.col(f"`{n}`.v").alias(n),
            lambda n: F.col(f"`{n}`.t").alias(f"{n}__t"),
            lambda n: text.trimmed(F.col(f"`{n}`.v")).alias(f"{n}__body"),
        ),
    )
    cleaned = bodies.select(
        *keep,
        *each(
            lambda n: text.clean_value(F.col(f"`{n}`"), F.col(f"`{n}__body`"), F.col(f"`{n}__t`") == "str").alias(n),
            lambda n: text.clean_note(F.col(f"`{n}`"), F.col(f"`{n}__body`"), F.col(f"`{n}__t`") == "str").alias(f"{n}__fmt"),
            lambda n: F.col(f"`{n}__t`"),
        ),
    )
    kept = dedupe.survivors(cleaned, keys, as_of)

    ready = kept.select(
        *keep,
        *each(
            lambda n: (text.trimmed(F.col(f"`{n}`")) if kinds[n] in ("fy", "month") else F.col(f"`{n}`")).alias(n),
            lambda n: F.col(f"`{n}__fmt`"),
            lambda n: F.col(f"`{n}__t`"),
        ),
    )
    typed = ready.select("*", *each(lambda n: typed_value(F.col(f"`{n}`"), F.col(f"`{n}__t`"), kinds[n]).alias(f"{n}__typed")))
    made = reshape_notes(config.reshape)

    def notes_of(n: str) -> Column:
        note = typed_note(F.col(f"`{n}`"), F.col(f"`{n}__typed`"), F.col(f"`{n}__t`"), kinds[n])
        return F.array_compact(F.array(F.lit(made.get(n)).cast("string"), F.col(f"`{n}__fmt`"), note))

    found = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*each(notes_of)))
    rows = typed.select(
        *keep, *each(lambda n: F.col(f"`{n}__typed`").alias(n)), F.map_filter(found, lambda _, v: F.size(v) > 0).alias("notes")
    )
    return Normalized(
        rows=rows,
        quarantined=dedupe.without_key(cleaned, keys).select(*keep, *names, "reason"),
        collapsed=dedupe.collapsed(cleaned, kept, keys).select("row_index"),
        summary=dedupe.summary(kept),
    )
