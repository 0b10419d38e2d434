"""Column expressions for exact numbers: coercion, agreement, scale errors, rounding steps."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,12)"
COERCION_FAILED = "R2-TYPE-01:coercion_failed"
SCALE_FACTORS = (10, 100, 1000)


def to_decimal(text: Column) -> Column:
    return text.try_cast(MONEY)


def to_whole(text: Column) -> Column:
    """A whole number as BIGINT ("12.0" is 12); a fraction or other text is null."""
    number = to_decimal(text)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def typed_note(text: Column, parsed: Column, kind: str, delivered: Column) -> Column:
    """The lineage note of a numeric coercion; a whole number delivered as one carries none."""
    moved = F.concat(F.lit("R2-TYPE-01:"), delivered, F.lit(f"→{kind}"))
    if kind == "int":
        moved = F.when(delivered != "int", moved)
    return F.when(text.isNull(), F.lit(None)).when(parsed.isNull(), COERCION_FAILED).otherwise(moved)


def percent_gap(base: Column, other: Column) -> Column:
    """|other - base| as a percentage of ``base``, as a DOUBLE for display (base zero handled)."""
    gap = F.abs(base - other).cast("double")
    size = F.abs(base).cast("double")
    return F.when(base == other, F.lit(0.0)).when(
        base == 0, F.abs(other).cast("double") * 100
    ).otherwise(gap * 100 / size)


# The tests below are SQL text over column names, as they appear many times in the cascade and inside
# lambdas. Tolerances are whole permille and the products stay within 38 digits, so the comparisons
# are exact; a decimal division would round.


def within_permille(base: str, other: str, permille: str) -> str:
    """|base - other| <= permille/1000 of |base|; a zero base compares |other| * 100 to the percentage."""
    return (
        f"CASE WHEN {base} = 0 THEN abs({other}) * 1000BD <= {permille} "
        f"ELSE abs({base} - {other}) * 1000BD <= abs({base}) * {permille} END"
    )


def agrees(base: str, base_eps: str, other: str, other_eps: str, permille: str) -> str:
    """Whether two readings agree, the band measured on ``base``.

    Equal, or within the coarser rounding step, or within the percentage band; a null ``permille``
    asks for equality.
    """
    step = f"greatest({base_eps}, {other_eps})"
    return (
        f"({base} = {other} OR ({step} > 0 AND abs({base} - {other}) <= {step}) "
        f"OR coalesce({within_permille(base, other, permille)}, false))"
    )


def off_by_power_of_ten(value: str, anchor: str) -> str:
    """``value`` is ``anchor`` with one to three digits dropped or added, give or take 0.5 %."""
    tests = []
    for factor in SCALE_FACTORS:
        tests.append(f"abs({anchor} - {value} * {factor}BD) * 200BD <= abs({anchor})")
        tests.append(f"abs({anchor} * {factor}BD - {value}) * 200BD <= abs({anchor} * {factor}BD)")
    return f"({value} <> 0 AND {anchor} <> 0 AND ({' OR '.join(tests)}))"


def printed_step(text: Column, unit_size: int = 100_000) -> Column:
    """Half a unit of the last printed place of ``text``, in units of ``unit_size``.

    Counted on the printed string: "0.94" lakh is ±500, "43" lakh is ±50,000.
    """
    places = F.length(F.regexp_extract(text, r"\.([0-9]+)\z", 1))
    zeros = F.rpad(F.lit("1"), places + 1, "0").try_cast("decimal(13,0)")
    half = F.lit(Decimal(unit_size) / 2).cast("decimal(18,1)")
    return (half / zeros).cast(MONEY)


def significant_three(value: Column) -> Column:
    """Three significant figures, half up. The digits are counted on the printed form, exactly."""
    size = F.abs(value)
    whole = F.regexp_extract(size.cast("string"), r"\A0*([0-9]*)", 1)
    fraction = F.regexp_extract(size.cast("string"), r"\.([0-9]*)\z", 1)
    lead = F.length(F.regexp_extract(fraction, r"\A(0*)", 1))
    exponent = F.when(F.length(whole) > 0, F.length(whole) - 1).otherwise(-lead - 1)
    # One flat array instead of a branch for each power, which code generation can't nest so deep.
    rounded = F.array(*(F.round(value, 2 - power).try_cast(MONEY) for power in range(-12, 16)))
    return F.when(value == 0, value.cast(MONEY)).otherwise(F.get(rounded, exponent + 12))
