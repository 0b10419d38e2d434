"""Scale anchors: the reading of a fact against which others are found to miss by a power of ten.

A reading is the anchor of its key if it is the first, in order of arrival, that another publisher
backs (they agree) and that some reading misses by ten, a hundred or a thousand without agreeing.
Neither needs a comparison of readings in pairs. Values fall into buckets so narrow that any two in
one bucket agree, and a bucket is summed up by extremes: its least and greatest value, and the least
and greatest among the publishers other than the one that holds that extreme. A reading then asks a
fixed number of buckets by equality joins: its own and its neighbours for backing, those around its
multiples and fractions for misses. As a neighbouring bucket lies on one side altogether, its extreme
decides exactly.

Three kinds of buckets answer the three ways to agree:

* equal values, for metrics without a percentage band;
* the percentage band: buckets of the logarithm a little narrower than the band;
* the rounding step, the coarser of both readings': for each power of two at which a key has steps,
  buckets as wide as the power. A level holds the readings with steps up to it, which one of its own
  steps asks, and apart from these the readings with steps of that level, which the finer ones ask.

Missing by a power of ten means agreeing with nothing, unless a rounding step is almost as large as
the value itself; no number printed with a digit other than 0 has one. Such coarse readings are
compared with those of the few buckets that could miss them, reading by reading.

Work and memory are linear in the distinct (value, step, publisher) of a key, whatever its size, and
no task gathers a key: all groups are per bucket, under partial aggregation.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import SCALE_FACTORS, agrees, off_by_power_of_ten
from ledgerloom.session import cut_lineage

ANCHOR = "struct<value: decimal(28,12), rounding_epsilon: decimal(28,12), seq: bigint>"

#: Widths of the logarithm's buckets: a little below the band of a metric, and below half a percent.
BAND_WIDTH = "ln(1 + CAST(_band AS double) * 0.000998D)"
SCALE_WIDTH = repr(math.log(1.00499)) + "D"
#: A step above this share of its value could let readings a power of ten apart agree.
COARSE = "rounding_epsilon > abs(value) * 0.85BD"

SIGN = "CASE WHEN value < 0 THEN '-' ELSE '+' END"
SIZE = "ln(abs(CAST(value AS double)))"
#: Steps and values as whole numbers of the last decimal; a level is a power of two not above the step.
UNITS = "CAST({0} * 1000000000000BD AS decimal(38,0))"
LEVEL = f"CASE WHEN rounding_epsilon > 0 THEN CAST(floor(log2(CAST({UNITS.format('rounding_epsilon')} AS double) * 0.999999D)) AS int) END"
START = "(_units - pmod(_units, CAST(pow(2D, l) AS decimal(38,0))))"
#: A step is less than 2.1 widths of its level, so three buckets on either side hold all it reaches.
AROUND = "sequence(-3, 3)"


def _classes(active: DataFrame) -> DataFrame:
    """Distinct (value, step, publisher) of each key with its first arrival, and the levels of the key's steps."""
    distinct = active.groupBy("_key", "value", "rounding_epsilon", "source_id", "_band").agg(F.min("seq").alias("seq"))
    distinct = distinct.selectExpr("*", f"{LEVEL} AS level", f"{UNITS.format('value')} AS _units", f"CAST(floor({SIZE} / {BAND_WIDTH}) AS bigint) AS _log")
    # At most one level for each bit of a decimal.
    levels = distinct.filter("level IS NOT NULL").groupBy("_key").agg(F.collect_set("level").alias("levels"))
    return cut_lineage(distinct.join(levels, "_key", "left").withColumn("id", F.monotonically_increasing_id()), "classes")


def _summaries(classes: DataFrame) -> DataFrame:
    """The extremes of each bucket: of all publishers, and of those other than the one at the extreme."""
    into = f"""concat(
      CASE WHEN _band > 0 THEN array(concat('r', {SIGN}, _log)) ELSE array(concat('e', value)) END,
      transform(filter(coalesce(levels, array()), l -> l >= coalesce(level, l)), l -> concat('a', l, ':', {START})),
      transform(filter(coalesce(levels, array()), l -> l = level), l -> concat('o', l, ':', {START})))"""
    rows = classes.selectExpr("_key", "source_id", "value", "rounding_epsilon", f"explode({into}) AS bucket")
    # Logarithms order sizes, all others values.
    rows = rows.selectExpr("*", "CASE WHEN bucket LIKE 'r%' THEN abs(value) ELSE value END AS _at")
    each = rows.groupBy("_key", "bucket", "source_id").agg(
        F.min("_at").alias("low"), F.max("_at").alias("high"),
        F.min(F.expr("_at - rounding_epsilon")).alias("low_step"), F.max(F.expr("_at + rounding_epsilon")).alias("high_step")).repartition("_key", "bucket")
    names = {"low": "min", "high": "max", "low_step": "min", "high_step": "max"}
    first = each.groupBy("_key", "bucket").agg(*[F.expr(f"{f}(struct({n} AS v, source_id AS s)) AS {n}1") for n, f in names.items()])
    return each.join(first, ["_key", "bucket"]).groupBy("_key", "bucket").agg(
        *[F.any_value(f"{n}1").alias(f"{n}1") for n in names],
        *[F.expr(f"{f}(CASE WHEN source_id <> {n}1.s THEN {n} END) AS {n}2") for n, f in names.items()])


def _backed(classes: DataFrame) -> DataFrame:
    """The ids of the classes that agree with a reading of another publisher, the band on themselves."""
    steps = f"flatten(transform({{0}}, l -> transform({AROUND}, d -> struct(concat('{{1}}', l, ':', {START} + d * CAST(pow(2D, l) AS decimal(38,0))) AS bucket, d AS side))))"
    own = steps.format("filter(coalesce(levels, array()), l -> l = level)", "a")
    coarser = steps.format("filter(coalesce(levels, array()), l -> l > coalesce(level, l - 1))", "o")
    asks = f"""concat(
      CASE WHEN _band > 0 THEN transform(sequence(-2, 2), d -> struct(concat('r', {SIGN}, _log + d) AS bucket, d AS side))
        ELSE array(struct(concat('e', value) AS bucket, 0 AS side)) END, {own}, {coarser})"""
    asked = classes.selectExpr("_key", "id", "source_id", "value", "rounding_epsilon AS step", "_band", f"explode({asks}) AS ask").selectExpr("*", "ask.bucket", "ask.side")
    met = asked.join(_summaries(classes).hint("merge"), ["_key", "bucket"])
    other = lambda n: f"CASE WHEN {n}1.s <> source_id THEN {n}1.v ELSE {n}2 END"
    return met.selectExpr("id", "value", "step", "_band", "side", "bucket", *[f"{other(n)} AS {n}" for n in ("low", "high", "low_step", "high_step")]).filter("""
      CASE WHEN side = 0 THEN low IS NOT NULL
        WHEN bucket LIKE 'r%' THEN abs(CASE WHEN side > 0 THEN low ELSE high END - abs(value)) * 1000BD <= abs(value) * _band
        WHEN side > 0 THEN low - value <= step OR low_step <= value
        ELSE value - high <= step OR high_step >= value END""").select("id").distinct()


def _off_by(power: str, value: str, anchor: str) -> str:
    """``off_by_power_of_ten`` of positive numbers for one known power, given as a column."""
    up = " ".join(f"WHEN {round(math.log10(f))} THEN abs({anchor} * {f}BD - {value}) * 200BD <= {anchor} * {f}BD" for f in SCALE_FACTORS)
    down = " ".join(f"WHEN -{round(math.log10(f))} THEN abs({anchor} - {value} * {f}BD) * 200BD <= {anchor}" for f in SCALE_FACTORS)
    return f"(CASE {power} {up} {down} END)"


def _near(found: DataFrame) -> DataFrame:
    """What a number in a bucket has nearest: the greatest of the two buckets below, the extremes of its own, the least of the two above."""
    each = found.groupBy("_key", "sign", "at").agg(F.min(F.abs("value")).alias("low"), F.max(F.abs("value")).alias("high"))
    seen = each.selectExpr("_key", "sign", "at", "low", "high", "explode(sequence(-2, 2)) AS d")
    return seen.groupBy("_key", "sign", F.expr("at + d AS at")).agg(
        F.expr("max(CASE WHEN d > 0 THEN high END) AS below"), F.expr("max(CASE WHEN d = 0 THEN low END) AS low"),
        F.expr("max(CASE WHEN d = 0 THEN high END) AS high"), F.expr("min(CASE WHEN d < 0 THEN low END) AS above"))


def _missed(classes: DataFrame, backed: DataFrame) -> DataFrame:
    """The ids of backed classes that some reading misses by a power of ten without agreeing with them."""
    powers = ", ".join(str(s * round(math.log10(f))) for f in SCALE_FACTORS for s in (1, -1))
    there = f"CAST(floor({SIZE} / {SCALE_WIDTH}) AS bigint) AS at"
    places = f"transform(array({powers}), p -> struct(p, CAST(floor(({SIZE} + p * {math.log(10)!r}D) / {SCALE_WIDTH}) AS bigint) AS at))"
    # Who published a reading doesn't matter here, so equal ones of several publishers count once.
    readings = classes.select("_key", "value", "rounding_epsilon", "_band").distinct()
    found = readings.selectExpr("_key", "value", "rounding_epsilon", f"{SIGN} AS sign", there, f"{COARSE} AS coarse")
    own = classes.join(backed, "id", "left_semi").select("_key", "value", "rounding_epsilon", "_band").distinct()
    asked = own.selectExpr("_key", "value AS a", "rounding_epsilon AS a_step", "_band", f"{SIGN} AS sign", f"{COARSE} AS a_coarse", f"inline({places})")
    # A bucket is narrower than what counts as a miss, so if any of its values is one, an extreme is.
    fine = asked.filter("NOT a_coarse").join(_near(found.filter("NOT coarse")).hint("merge"), ["_key", "sign", "at"]).filter(
        " OR ".join(f"coalesce({_off_by('p', v, 'abs(a)')}, false)" for v in ("below", "low", "high", "above")))
    asked = asked.withColumn("at", F.explode(F.expr("transform(sequence(-2, 2), d -> at + d)")))
    # Pairs are formed only where one of both is coarse: all with the coarse ones, then the coarse ones with the others.
    exact = f"NOT {agrees('value', 'rounding_epsilon', 'a', 'a_step', '_band')} AND {off_by_power_of_ten('value', 'a')}"
    pairs = [asked.join(found.filter("coarse"), ["_key", "sign", "at"]), asked.filter("a_coarse").join(found.filter("NOT coarse"), ["_key", "sign", "at"])]
    missed = reduce(DataFrame.unionByName, [rows.select("_key", "a", "a_step") for rows in (fine, *[p.filter(exact) for p in pairs])]).distinct()
    same = (F.col("c._key") == F.col("m._key")) & (F.col("c.value") == F.col("m.a")) & F.col("c.rounding_epsilon").eqNullSafe(F.col("m.a_step"))
    return classes.join(backed, "id", "left_semi").alias("c").join(missed.alias("m"), same, "left_semi").select("c.id")


def find_anchors(active: DataFrame) -> DataFrame:
    """``(_key, _anchor)`` for the readings (_key, value, rounding_epsilon, source_id, seq, _band).

    ``_band`` is the permille within which readings agree, null for equality; up to 500 of them.
    Defined results: zeros neither are nor have anchors; a null value or publisher backs nothing and is
    not backed; equal arrivals are told apart by value and step; no readings have no anchors.
    """
    classes = _classes(active.filter("value <> 0 AND source_id IS NOT NULL"))
    backed = cut_lineage(_backed(classes), "backed")
    found = classes.join(_missed(classes, backed), "id", "left_semi")
    return found.groupBy("_key").agg(F.expr(f"CAST(min(struct(seq, value, rounding_epsilon)) AS struct<seq: bigint, value: decimal(28,12), rounding_epsilon: decimal(28,12)>) AS _first")).selectExpr(
        "_key", f"CAST(struct(_first.value, _first.rounding_epsilon, _first.seq) AS {ANCHOR}) AS _anchor")
