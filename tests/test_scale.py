"""Scale anchors found by buckets against comparing every pair of readings."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from ledgerloom.operators import scale

SCHEMA = "_key string, value decimal(28,12), rounding_epsilon decimal(28,12), source_id string, seq bigint, _band decimal(4,0)"


def agrees(a, b, band):
    step = max(a[1], b[1])
    return a[0] == b[0] or (step > 0 and abs(a[0] - b[0]) <= step) or (band is not None and abs(a[0] - b[0]) * 1000 <= abs(a[0]) * band)


def misses(value, anchor):
    return value != 0 and anchor != 0 and any(
        abs(anchor - value * f) * 200 <= abs(anchor) or abs(anchor * f - value) * 200 <= abs(anchor * f) for f in (10, 100, 1000))


def brute(rows):
    keys = {}
    for key, *reading in rows:
        keys.setdefault(key, []).append(reading)
    found = {}
    for key, readings in keys.items():
        good = [a for a in readings if any(b[2] != a[2] and agrees(a, b, a[4]) for b in readings)
                and any(not agrees(c, a, a[4]) and misses(c[0], a[0]) for c in readings)]
        if good:
            first = min(good, key=lambda r: r[3])
            found[key] = (first[3], first[0], first[1])
    return found


def readings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA.replace("_band decimal(4,0)", "_band int")).selectExpr("* EXCEPT (_band)", "CAST(_band AS decimal(4,0)) AS _band")


def anchors(spark, rows):
    got = scale.find_anchors(readings(spark, rows).repartition(5)).collect()
    return {r["_key"]: (r["_anchor"]["seq"], r["_anchor"]["value"], r["_anchor"]["rounding_epsilon"]) for r in got}


def random_rows(seed, keys, most, steps):
    pick = random.Random(seed)
    rows = []
    for k in range(keys):
        band = pick.choice([None, 1, 5, 5, 5, 100, 500])
        base = Decimal(pick.choice(["1000", "53921.5", "7", "0.000000000047", "9999999999"]))
        for seq in range(pick.randint(1, most)):
            factor = Decimal(pick.choice(["1", "1", "1.005", "0.995", "1.0050001", "0.99499", "1.01", "1.02", "3"])) * Decimal(10) ** pick.choice([0, 0, 0, 1, -1, 2, -2, 3, -3, 4])
            value = (base * factor * pick.choice([1, 1, 1, 1, -1])).quantize(Decimal("1e-12"))
            rows.append((f"k{k}", value, (abs(value) * Decimal(pick.choice(steps))).quantize(Decimal("1e-12")), pick.choice("ABC"), seq, band))
    return [r for r in rows if r[1] != 0]


@pytest.mark.parametrize(("seed", "steps"), [(1, ["0"]), (2, ["0", "0", "0.001", "0.004", "0.5"]), (3, ["0", "0.002", "0.86", "0.8995", "0.9", "9", "9.01"]), (4, ["0.004", "0.25", "0.5", "2"])])
def test_anchors_equal_those_of_all_pairs(spark, seed, steps):
    rows = random_rows(seed, 300, 7, steps)
    want = brute(rows)
    assert len(want) > 20
    assert anchors(spark, rows) == want


def test_one_key_of_many_readings(spark):
    pick = random.Random(9)
    rows = [("hot", Decimal(pick.randint(100, 10**6)), Decimal(pick.choice([0, 0, 1, 50])), pick.choice("ABCDE"), seq, 1) for seq in range(1500)]
    assert anchors(spark, rows) == brute(rows) != {}


def test_steps_decide_at_their_very_ends(spark):
    """Readings exactly a step apart agree, whichever of the two has the step; a last decimal more and they don't."""
    rows, last = [], Decimal("1e-12")
    for n, step in enumerate(map(Decimal, ("8", "7.999999999999", "0.000000000001", "1024", "1000"))):
        for side in (1, -1):
            for holder in (0, 1):
                for beyond in (0, 1):
                    value = Decimal(10_000_000)
                    other = value + side * (step + beyond * last)
                    key = f"{n}/{side}/{holder}/{beyond}"
                    rows += [(key, value, step * (1 - holder), "A", 0, None), (key, other, step * holder, "B", 1, None), (key, value / 10, Decimal(0), "A", 2, None)]
    want = brute(rows)
    assert anchors(spark, rows) == want and {k[-1] for k in want} == {"0"}


def test_nulls_zeros_and_no_readings(spark):
    rows = [("z", Decimal(0), Decimal(0), "A", 0, 5), ("z", Decimal(0), Decimal(0), "B", 1, 5), ("z", Decimal(10), Decimal(0), "A", 2, 5),
            ("n", None, Decimal(0), "A", 0, 5), ("n", Decimal(100), Decimal(0), None, 1, 5), ("n", Decimal(100), Decimal(0), "B", 2, 5), ("n", Decimal(10), Decimal(0), "B", 3, 5)]
    assert anchors(spark, rows) == {}
    assert scale.find_anchors(readings(spark, [])).collect() == []


def test_no_task_gathers_a_key(spark):
    rows = readings(spark, random_rows(1, 5, 5, ["0"]))
    plan = scale.find_anchors(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan


def test_pairs_are_formed_only_with_coarse_readings(spark):
    """Readings in a crowded bucket meet what is known of the bucket, not each other."""
    classes = scale._classes(readings(spark, random_rows(2, 5, 5, ["0", "0.9"])))
    plan = scale._missed(classes, classes.select("id"))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert joins and not any("coarse" in line for line in joins)


def test_nearest_values_decide_a_miss(spark):
    rows = []
    for power in (-3, -1, 2):
        for other in ("1000.5", "1005", "1005.1", "995", "994.9", "1000", "-1000"):
            key, missing = f"{other}e{power}", Decimal(other).scaleb(power).quantize(Decimal("1e-12"))
            rows += [(key, Decimal(1000), Decimal(0), "A", 0, 5), (key, Decimal(1000), Decimal(0), "B", 1, 5), (key, missing, Decimal(0), "C", 2, 5)]
    assert anchors(spark, rows) == brute(rows) != {}
