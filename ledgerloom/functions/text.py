"""Column expressions for text cells: null tokens, name keys, scheme labels, plain numbers."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK_NOTE = "R2-FMT-01:blank→null"
DASH_NOTE = "R2-FMT-01:dash→null"
NA_NOTE = "R2-FMT-01:NA→null"
COMMA_NOTE = "R2-FMT-01:strip_commas"
TRIM_NOTE = "R2-FMT-01:trim"

_KEY_CHARACTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789&")
NUMERIC = r"\A[+-]?[0-9]+(?:\.[0-9]+)?\z"


def trimmed(cell: Column) -> Column:
    """White space of any script removed at both ends (``trim`` removes the ASCII blank only)."""
    return F.regexp_replace(cell, r"(?U)\A\s+|\s+\z", "")


def clean_value(cell: Column, body: Column, is_text: Column | None = None) -> Column:
    """A delivered cell with null tokens nulled and numbers freed of commas; ``body`` is it trimmed.

    Text that is no number stays as delivered. ``is_text`` marks cells delivered as strings; any
    other delivered type passes through.
    """
    bare = F.replace(body, F.lit(","), F.lit(""))
    value = F.when(F.upper(body).isin("", "-", "NA"), F.lit(None)).when(bare.rlike(NUMERIC), bare).otherwise(cell)
    return value if is_text is None else F.when(is_text, value).otherwise(cell)


def clean_note(cell: Column, body: Column, is_text: Column | None = None) -> Column:
    """The lineage note of ``clean_value``, null where the cell is unchanged."""
    comma = body.contains(",")
    number = F.replace(body, F.lit(","), F.lit("")).rlike(NUMERIC)
    note = (
        F.when(body == "", BLANK_NOTE).when(body == "-", DASH_NOTE).when(F.upper(body) == "NA", NA_NOTE)
        .when(comma & number, COMMA_NOTE).when((body != cell) & number, TRIM_NOTE)
    )
    return note if is_text is None else F.when(is_text, note)


def clean_cell(cell: Column) -> Column:
    """``struct(value, note)`` of a cell delivered as text."""
    body = trimmed(cell)
    return F.struct(clean_value(cell, body).alias("value"), clean_note(cell, body).alias("note"))


@lru_cache(maxsize=1)
def _fold_table() -> str:
    """What NFKD and lower case leave of each character beyond ASCII, where that is a key character.

    Derived from the Unicode database, as lines of character and replacement: an accented letter
    becomes the letter and a blank, a ligature its letters, a wide digit the digit.
    """
    lines = []
    for point in range(0x80, 0x20000):  # no character above decomposes to one of these
        character = chr(point)
        plain = unicodedata.normalize("NFKD", character).lower()
        kept = "".join(c if c in _KEY_CHARACTERS else " " for c in plain)
        if kept.strip():
            lines.append(f"{character}\t{kept}")
    return "\n".join(lines)


def name_key(name: Column) -> Column:
    """The match key of a place name: NFKD, lower case, ``&`` as "and", other runs as one blank.

    Spark has no compatibility decomposition. Names beyond ASCII are therefore mapped character by
    character through a constant table; plain names skip that.
    """
    table = F.str_to_map(F.lit(_fold_table()), F.lit("\n"), F.lit("\t"))
    characters = F.regexp_extract_all(name, F.lit("(?s)."), F.lit(0))
    folded = F.transform(
        characters, lambda c: F.when(c > F.lit("\x7f"), F.coalesce(F.try_element_at(table, c), c)).otherwise(c)
    )
    plain = F.when(name.rlike(r"[^\x00-\x7F]"), F.array_join(folded, "")).otherwise(name)
    spelled = F.replace(F.lower(plain), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(spelled, "[^a-z0-9]+", " "))


def scheme_key(label: Column) -> Column:
    return F.regexp_replace(F.upper(label), "[^A-Z0-9]+", "")


def canonical_scheme(label: Column, spellings: tuple[str, ...], canonical: str) -> Column:
    """The canonical scheme for a known spelling, null for any other."""
    return F.when(scheme_key(label).isin(*spellings), F.lit(canonical))


def plain_number(value: Column) -> Column:
    """A decimal as digits without exponent or trailing zeros."""
    text = value.cast("string")
    cut = F.regexp_replace(text, r"(\.[0-9]*?)0+\z", "$1")
    return F.regexp_replace(F.when(text.contains("."), cut).otherwise(text), r"\.\z", "")


def grouped_number(value: Column) -> Column:
    """``plain_number`` with the integer part in comma groups of three."""
    plain = plain_number(value)
    whole = F.regexp_extract(plain, r"\A([+-]?[0-9]+)", 1)
    grouped = F.regexp_replace(whole, r"(?<=[0-9])(?=(?:[0-9]{3})+\z)", ",")
    return F.concat(grouped, F.regexp_extract(plain, r"(\.[0-9]+)\z", 1))
