"""Unit conversion as Column expressions; a conversion is exact and leaves a note."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import MONEY

# Rupees in one unit of each money scale.
RUPEES = {"rupee": 1, "thousand": 1_000, "lakh": 100_000, "crore": 10_000_000}
LAKH = Decimal(100_000)


def money_in_lakh(value: Column, unit: Column) -> Column:
    """``struct(value, original_unit, note)`` in lakh; an unknown unit gives a null value."""
    factor = F.try_element_at(
        F.create_map(*[x for u, r in RUPEES.items() for x in (F.lit(u), F.lit(Decimal(r)).cast("decimal(8,0)"))]),
        unit,
    )
    lakh = ((value.cast("decimal(24,6)") * factor) / LAKH).cast(MONEY)
    exact = F.when(unit == "lakh", value.cast(MONEY)).otherwise(lakh)
    note = F.when(
        value.isNotNull() & factor.isNotNull() & (unit != "lakh"),
        F.concat(F.lit("R4-UNIT-01:"), unit, F.lit("→lakh")),
    )
    return F.struct(exact.alias("value"), unit.alias("original_unit"), note.alias("note"))


def raw_count(value: Column, scale: Column) -> Column:
    """``struct(value, original_unit, note)`` of a count published raw or in lakh."""
    scaled = F.when(scale == "lakh", value * LAKH).when(scale == "count", value).cast(MONEY)
    note = F.when(value.isNotNull() & (scale == "lakh"), F.lit("R4-UNIT-01:lakh→count"))
    return F.struct(scaled.alias("value"), scale.alias("original_unit"), note.alias("note"))
