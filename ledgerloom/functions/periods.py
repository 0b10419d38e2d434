"""Column expressions for financial years (April to March) and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import trimmed

PARSE_FAILED = "R2-DATE-01:parse_failed"

# English month names.
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)


def fy_label(start: Column) -> Column:
    """``2018`` → ``2018-19``; ``1999`` → ``1999-00``."""
    return F.format_string("%04d-%02d", start.cast("int"), ((start + 1) % 100).cast("int"))


def fy_value(text: Column, is_text: Column | None = None) -> Column:
    """A trimmed financial year ``YYYY-YY`` or ``YYYY-YYYY`` as ``YYYY-YY``, else null.

    A two-digit end takes the century of the start, so ``1999-00`` does not parse here while
    ``1999-2000`` does and becomes ``1999-00``.
    """
    start = F.substring(text, 1, 4).try_cast("int")
    end = F.substring(text, 6, 4).try_cast("int")
    full_end = F.when(end > 99, end).otherwise(start - start % 100 + end)
    good = text.rlike(r"\A[0-9]{4}-(?:[0-9]{2}|[0-9]{4})\z") & (full_end == start + 1)
    if is_text is not None:
        good = good & is_text
    return F.when(good, F.concat(start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0")))


def month_value(text: Column, is_text: Column | None = None) -> Column:
    """A trimmed month name, three-letter form or number as ``01`` to ``12``, else null."""
    entries = []
    for number, name in enumerate(MONTHS, start=1):
        for key in dict.fromkeys((name, name[:3])):
            entries += [F.lit(key), F.lit(f"{number:02d}")]
    named = F.try_element_at(F.create_map(*entries), F.lower(text))
    digits = F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("int"))
    canonical = F.coalesce(named, F.when(digits.between(1, 12), F.lpad(digits.cast("string"), 2, "0")))
    return canonical if is_text is None else F.when(is_text, canonical)


def date_note(text: Column, value: Column) -> Column:
    """The note of a parsed period: failed, or changed from what to what."""
    return (
        F.when(text.isNull(), F.lit(None))
        .when(value.isNull(), PARSE_FAILED)
        .when(value != text, F.concat(F.lit("R2-DATE-01:"), text, F.lit("→"), value))
    )


def canonical_fy(cell: Column) -> Column:
    """``struct(value, note)`` of a financial year delivered as text."""
    text = trimmed(cell)
    return F.struct(fy_value(text).alias("value"), date_note(text, fy_value(text)).alias("note"))


def canonical_month(cell: Column) -> Column:
    """``struct(value, note)`` of a month delivered as text."""
    text = trimmed(cell)
    return F.struct(month_value(text).alias("value"), date_note(text, month_value(text)).alias("note"))


def well_formed_fy(label: Column) -> Column:
    """``YYYY-YY`` in ASCII digits whose suffix is the start plus one; ``1999-00`` passes."""
    start = F.substring(label, 1, 4).try_cast("int")
    follows = F.substring(label, 6, 2).try_cast("int") == (start + 1) % 100
    return F.coalesce(label.rlike(r"\A[0-9]{4}-[0-9]{2}\z") & follows, F.lit(False))


def fy_start(label: Column) -> Column:
    """The first calendar year of a label, null when it does not begin with four digits."""
    return F.regexp_extract(label, r"\A([0-9]{4})", 1).try_cast("int")


def fy_position(month: Column) -> Column:
    """Place of a canonical month in the year: April 0 … March 11; null for any other text."""
    known = month.rlike(r"\A(0[1-9]|1[0-2])\z")
    return F.when(known, (month.try_cast("int") + 8) % 12)
