"""Keys with very many readings: the same flags as the window form, without a task per key."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import reconcile, series, wide
from ledgerloom.plans.inputs import OBS_POLICY, observations as derived
from ledgerloom.presets import EMPLOYMENT_POLICY
from test_reconcile import CASES, HH, PD, observations, r

FLAGS = ["state_code", "district_code", "fin_year", "metric", "seq", "absent", "partial", "superseded", "active", "scale_error", "live", "rejected"]


def rows(df):
    picked = df.select(*FLAGS, F.col("winner.seq").alias("w"), F.col("winner.gap").alias("g"))
    return sorted(tuple(str(x) for x in row) for row in picked.collect())


def test_rule_cases(spark):
    obs = observations(spark, CASES)
    assert rows(wide.flag_any(obs, EMPLOYMENT_POLICY, wide_from=0)) == rows(reconcile.flag_readings(obs, EMPLOYMENT_POLICY))


def test_derived_observations(spark):
    obs = derived(spark, "/root/testdata/sf0.001").cache()
    assert rows(wide.flag_any(obs, OBS_POLICY, wide_from=4)) == rows(reconcile.flag_readings(obs, OBS_POLICY))


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_keys(spark, seed):
    """Random readings around a few levels, with rounding steps, zeros and editions, one key hot."""
    pick = random.Random(seed)
    cases = {}
    for key, (metric, count) in enumerate([(PD, 400), (HH, 150), (PD, 30), (HH, 3), (PD, 60)]):
        readings = []
        for _ in range(count):
            level = pick.choice([1000, 10000, 7300, 53920, 539200]) if count > 3 else 1000
            value = int(level * pick.choice([1, 1, 1.004, 0.1, 1.02, 1 + pick.random() / 50])) * pick.choice([1, 1, 1, 1, -1, 0])
            span = pick.choice([None, None, None, "2014-15", "2016-17"])
            readings.append(r(pick.choice("ABC"), value, pick.choice([0, 10]), eps=pick.choice([0, 0, 50, 500]), span=span,
                              terminal=span is not None and pick.random() < 0.3))
        cases[f"k{key}"] = (metric, readings)
    obs = observations(spark, cases).cache()
    a, b = wide.flag_any(obs, EMPLOYMENT_POLICY, wide_from=20), reconcile.flag_readings(obs, EMPLOYMENT_POLICY)
    assert rows(a) == rows(b)
    assert a.filter("scale_error").count() > 0
    assert sorted(map(str, series.assemble(a, EMPLOYMENT_POLICY).collect())) == sorted(map(str, series.assemble(b, EMPLOYMENT_POLICY).collect()))


def test_scale_anchor_in_a_key_without_window(spark):
    many = [r("R", 539000, eps=500), r("M", 539223)] + [r("M", 53890)] * 40 + [r("M", 900000 + 7 * i) for i in range(40)]
    out = wide.flag_any(observations(spark, {"k": (HH, many)}), EMPLOYMENT_POLICY, wide_from=10)
    assert out.filter("scale_error").count() == 40
    assert out.filter(F.col("scale_error") & (F.col("value") != Decimal(53890))).count() == 0


def test_wide_plan_has_no_window(spark):
    out = wide.flag_wide_readings(observations(spark, {"k": CASES["scale error"]}), EMPLOYMENT_POLICY)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
