from __future__ import annotations

import hashlib
import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import ids, numbers, periods, text, units


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [row[0] for row in df.orderBy("i").select(build(F.col("c"))).collect()]


CELLS = {
    "1,234": ("1234", text.COMMA_NOTE), " 1234 ": ("1234", text.TRIM_NOTE), "1234": ("1234", None), "-1,2.5": ("-12.5", text.COMMA_NOTE),
    "": (None, text.BLANK_NOTE), "   ": (None, text.BLANK_NOTE), " - ": (None, text.DASH_NOTE), "na": (None, text.NA_NOTE),
    "1.2.3": ("1.2.3", None), " South Goa ": (" South Goa ", None), "2022-23": ("2022-23", None), "1,2,x": ("1,2,x", None),
}


def test_clean_cell(spark):
    got = column(spark, list(CELLS), text.clean_cell)
    assert [tuple(g) for g in got] == list(CELLS.values())


def test_periods(spark):
    years = {"2022-2023": "2022-23", "2021-22": "2021-22", "1999-00": None, "1999-2000": "1999-00", "2021-23": None, "2021": None, None: None}
    assert [g["value"] for g in column(spark, list(years), periods.canonical_fy)] == list(years.values())
    months = {"April": "04", "Jan": "01", " sep ": "09", "9": "09", "12": "12", "13": None, "Smarch": None, "0": None}
    assert [g["value"] for g in column(spark, list(months), periods.canonical_month)] == list(months.values())
    shape = {"2018-19": True, "1999-00": True, "2018-18": False, "2018-2019": False, "２０１８-19": False, "": False}
    assert column(spark, list(shape), periods.well_formed_fy) == list(shape.values())
    assert column(spark, ["04", "12", "03", "13", None], periods.fy_position) == [0, 8, 11, None, None]
    assert column(spark, ["2019-20", "x"], periods.fy_start) == [2019, None]


def test_name_key_matches_unicode_folding(spark):
    """Against the Unicode database, for every character that could matter."""
    import re

    names = [None, "Jammu & Kashmir", "North 24 Parganas (N)", "Café-Ñ 5", "ﬁne  X", "＆co", "Ａ１", "½"]
    names += [f"a{chr(p)}b" for p in range(0x80, 0x3000) if chr(p).isprintable()]
    want = [None if n is None else re.sub("[^a-z0-9]+", " ", unicodedata.normalize("NFKD", n).lower().replace("&", " and ")).strip() for n in names]
    got = column(spark, names, text.name_key)
    assert [(n, g) for n, g, w in zip(names, got, want) if g != w] == []


def test_numbers(spark):
    assert column(spark, ["12.0", "1.5", "x", "7", None], numbers.to_whole) == [12, None, None, 7, None]
    steps = {"0.94": 500, "43": 50000, "36.07": 500, "1.5": 5000}
    assert [int(x) for x in column(spark, list(steps), numbers.printed_step)] == list(steps.values())
    figures = {"905054000": "905000000", "0.00123456": "0.00123", "-17.25": "-17.3", "0": "0", "999.9": "1000", "12": "12"}
    got = column(spark, list(figures), lambda c: text.plain_number(numbers.significant_three(numbers.to_decimal(c))))
    assert got == list(figures.values())
    plain = {"1000000.0": ("1000000", "1,000,000"), "22.090": ("22.09", "22.09"), "-1234.5": ("-1234.5", "-1,234.5"), "100": ("100", "100")}
    got = column(spark, list(plain), lambda c: F.struct(text.plain_number(numbers.to_decimal(c)), text.grouped_number(numbers.to_decimal(c))))
    assert [tuple(g) for g in got] == list(plain.values())


def test_agreement_is_measured_on_the_first_argument(spark):
    df = spark.sql("SELECT 1000BD AS a, 1005BD AS b, 0BD AS e, 5BD AS t")
    df = df.select(*[F.col(c).cast("decimal(28,12)" if c != "t" else "decimal(4,0)").alias(c) for c in df.columns])
    row = df.select(
        F.expr(numbers.agrees("a", "e", "b", "e", "t")).alias("ab"),
        F.expr(numbers.agrees("a - 0.001BD", "e", "b", "e", "t")).alias("below"),
        F.expr(numbers.agrees("a", "e", "b", "e", "CAST(NULL AS decimal(4,0))")).alias("exact"),
    ).first()
    assert (row["ab"], row["below"], row["exact"]) == (True, False, False)


def test_units(spark):
    df = spark.createDataFrame([("120000", "rupee"), ("3", "crore"), ("5.5", "lakh"), ("7", "bushel"), (None, "rupee")], "v string, u string")
    got = [r[0] for r in df.select(units.money_in_lakh(numbers.to_decimal(F.col("v")), F.col("u"))).collect()]
    assert [g["value"] for g in got] == [Decimal("1.2"), Decimal(300), Decimal("5.5"), None, None]
    assert [g["note"] for g in got] == ["R4-UNIT-01:rupee→lakh", "R4-UNIT-01:crore→lakh", None, None, None]


@pytest.mark.parametrize("blake", [False, True])
def test_fact_id(spark, blake):
    df = spark.sql("SELECT 'S' scheme, 'state' geo_level, '1' state_code, CAST(NULL AS STRING) district_code, '2018-19' fin_year, CAST(NULL AS STRING) month, 'm' metric")
    raw = b"S|state|1||2018-19||m"
    want = hashlib.blake2b(raw, digest_size=8).hexdigest() if blake else hashlib.sha256(raw).hexdigest()[:16]
    assert df.select(ids.fact_id(blake)).first()[0] == want
