"""Named derivations over facts: a graph of exact decimals, evaluated from its leaves by joins.

``nodes(id, value)`` are figures and cohorts, unique by id. ``derivations(id, operation, inputs)`` name
their inputs, nodes or other derivations, in any order; how deep a derivation stands follows from its
inputs. Each round settles the derivations that wait for nothing: what they give goes along the edges
that wait for them, into sums and counts per derivation, and those edges and derivations are done with.
So a round reads what is still open, which shrinks; what stays open when a round settles nothing
leads into a cycle. All that a round leaves is saved in the shared folder, so plans stay short and a
lost executor replays one round.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import MONEY, significant_three
from ledgerloom.session import cut_lineage, scratch_path

# The operations and, for the rescaling ones, the power of ten of the divisor.
BINARY = ("difference", "ratio", "ratio_2dp")
RESCALE = {"to_millions": 6, "to_billions": 9, "lakh_to_crore": 2, "lakh_to_lakh_crore": 7, "round_2dp": 0}
OPERATIONS = ("sum", *BINARY, *RESCALE, "round_sigfig_3")
PRESENTATION = (*RESCALE, "round_sigfig_3")

DONE = f"id string, operation string, value {MONEY}, declared {MONEY}, problem string"


def quotient(a: Column, b: Column) -> Column:
    """a / b cut to twelve decimals, by integer division in steps of six digits (null for b = 0 and out of range)."""
    base = F.when(b != 0, F.abs(b))
    top = F.abs(a)
    rest = (top % base) * Decimal(1_000_000)
    last = (rest % base) * Decimal(1_000_000)
    digits = _div(rest, base).try_cast("decimal(6,0)") * Decimal("0.000001") + _div(last, base).try_cast("decimal(6,0)") * Decimal("0.000000000001")
    size = _div(top, base).try_cast(MONEY) + digits
    return F.when((a < 0) != (b < 0), -size).otherwise(size).try_cast(MONEY)


def quotient_2dp(a: Column, b: Column) -> Column:
    """a / b to two decimals, half up, in one exact rounding (null for b = 0 and out of range)."""
    base = F.when(b != 0, F.abs(b))
    cents = _div(F.abs(a) * Decimal(200) + base, base * Decimal(2)).try_cast("decimal(18,0)") * Decimal("0.01")
    return F.when((a < 0) != (b < 0), -cents).otherwise(cents).try_cast(MONEY)


def _div(a: Column, b: Column) -> Column:
    """Integral division of two non-negative decimals: exact, as the remainder goes first.

    A quotient beyond 64 bits is null, so that one row out of range doesn't end the job.
    """
    return ((a - a % b) / b).try_cast("bigint")


def rescaled(value: Column, power: int) -> Column:
    """value / 10**power to two decimals: rounded once, half up, then moved by an exact factor."""
    moved = F.round(value, 2 - power).try_cast("decimal(28,2)" if power == 0 else "decimal(20,0)")
    return (moved * Decimal(1).scaleb(-power)).try_cast(MONEY)


def _arrived(edges: DataFrame) -> DataFrame:
    """What the inputs (id, place, value) of each derivation come to; no array of inputs is built."""
    return edges.groupBy("id").agg(
        F.count(F.lit(1)).alias("_came"), F.count("value").alias("_known"), F.try_sum(F.col("value").cast("decimal(38,12)")).alias("_sum"),
        F.max(F.when(F.col("place") == 0, F.col("value"))).alias("_a"), F.max(F.when(F.col("place") == 1, F.col("value"))).alias("_b"))


def _settle(ready: DataFrame) -> DataFrame:
    """Values and problems of derivations all of whose inputs have arrived."""
    op, n, a, b = F.col("operation"), F.col("input_count"), F.col("a"), F.col("b")
    result = (
        F.when(op == "sum", F.col("total").try_cast(MONEY))
        .when(op == "difference", (a - b).try_cast(MONEY))
        .when(op == "ratio", quotient(a, b))
        .when(op == "ratio_2dp", quotient_2dp(a, b))
        .when(op == "round_sigfig_3", significant_three(a))
    )
    for name, power in RESCALE.items():
        result = result.when(op == name, rescaled(a, power))
    problem = (
        F.when(F.col("repeated"), "repeated id")
        .when(~F.coalesce(op.isin(*OPERATIONS), F.lit(False)), "unknown operation")
        .when(F.col("known") < n, "unknown input")
        .when((op == "sum") & (n == 0), "no input")
        .when(op.isin(*BINARY) & (n != 2), "needs two inputs")
        .when(op.isin(*PRESENTATION) & (n != 1), "needs one input")
        .when(op.isin("ratio", "ratio_2dp") & (b == 0), "zero denominator")
    )
    found = ready.withColumn("problem", problem).withColumn("value", F.when(F.col("problem").isNull(), result))
    missing = F.when(F.col("value").isNull(), "out of range")
    wrong = F.when(F.col("checked") & ~F.col("declared").eqNullSafe(F.col("value")), "mismatch")
    return found.select("id", "operation", "value", "declared", F.coalesce("problem", missing, wrong).alias("problem"))


def _open(nodes: DataFrame, derivations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every derivation with what its nodes give, and the edges that wait for other derivations."""
    checked = "declared" in derivations.columns
    declared = (F.col("declared") if checked else F.lit(None)).cast(MONEY).alias("declared")
    inputs = F.coalesce("inputs", F.array().cast("array<string>")).alias("inputs")
    rows = cut_lineage(derivations.select("id", "operation", inputs, declared), "derivations")
    # Whatever an input may name: the value of a node, or how many derivations go by the name.
    given = nodes.select("id", F.col("value").cast(MONEY).alias("value"), F.lit(1).alias("node"), F.lit(0).alias("times"))
    named = given.unionByName(rows.select("id", F.lit(None).cast(MONEY).alias("value"), F.lit(0).alias("node"), F.lit(1).alias("times")))
    names = cut_lineage(named.groupBy("id").agg(F.max("value").alias("value"), F.max("node").alias("node"), F.sum("times").alias("times")), "names")
    rows = rows.join(names.select("id", ((F.col("times") > 1) | (F.col("node") > 0)).alias("repeated")), "id")
    edges = rows.filter("NOT repeated").select("id", F.posexplode("inputs").alias("place", "input"))
    met = cut_lineage(edges.join(names.withColumnRenamed("id", "input"), "input", "left").select(
        "id", "place", "input", "value", F.coalesce(F.col("node") == 0, F.lit(False)).alias("waits")), "edges")
    waiting = met.filter("waits").groupBy("id").agg(F.count(F.lit(1)).alias("waiting"))
    zero, nothing = F.lit(0).cast("long"), F.lit(None).cast("decimal(38,12)")
    state = rows.join(_arrived(met.filter("NOT waits")), "id", "left").join(waiting, "id", "left").select(
        "id", "operation", "declared", "repeated", F.lit(checked).alias("checked"), F.size("inputs").alias("input_count"),
        F.coalesce("waiting", zero).alias("waiting"), F.coalesce("_known", zero).alias("known"),
        # No input yet is a sum of 0; a sum beyond 38 digits stays null.
        F.when(F.col("_came").isNull() | (F.col("_known") == 0), F.lit(0).cast("decimal(38,12)")).otherwise(F.coalesce("_sum", nothing)).alias("total"),
        F.col("_a").alias("a"), F.col("_b").alias("b"))
    return cut_lineage(state, "open"), met.filter("waits").select("id", "place", "input")


def _after(state: DataFrame, edges: DataFrame, done: DataFrame) -> DataFrame:
    """The derivations still open, with what ``done`` brings along the edges that waited for it."""
    fed = done.select(F.col("id").alias("input"), F.when(F.col("problem").isNull(), F.col("value")).alias("value"))
    came = _arrived(edges.join(fed.dropDuplicates(["input"]), "input"))
    added = F.when(F.col("_known") > 0, F.try_add("total", "_sum")).otherwise(F.col("total"))
    return state.filter("waiting > 0").join(came, "id", "left").select(
        "id", "operation", "declared", "repeated", "checked", "input_count",
        (F.col("waiting") - F.coalesce("_came", F.lit(0))).alias("waiting"), (F.col("known") + F.coalesce("_known", F.lit(0))).alias("known"),
        F.when(F.col("_came").isNull(), F.col("total")).otherwise(added).cast("decimal(38,12)").alias("total"),
        F.coalesce("a", "_a").alias("a"), F.coalesce("b", "_b").alias("b"))


def evaluate(nodes: DataFrame, derivations: DataFrame) -> DataFrame:
    """``(id, level, operation, value, problem)`` of every derivation; level 1 has only nodes as inputs.

    A derivation with a problem feeds none above it, so these have an unknown input. With a column
    ``declared`` the value has to equal it, or the problem is a mismatch: only verified values feed
    others. Derivations on a cycle, or between two, have the problem "cycle", those that rest on one an
    unknown input; neither has a level. Other defined results: an id that occurs twice, or that a node
    has, is a problem of all its rows and feeds nothing; null inputs are none, a null input is unknown;
    a value beyond 16 digits before the point is out of range.
    """
    spark = nodes.sparkSession
    folder = scratch_path(spark, "derivations")
    state, edges = _open(nodes, derivations)
    level = 0
    while True:
        level += 1
        _settle(state.filter("waiting = 0")).write.parquet(f"{folder}/level={level}")
        done = spark.read.schema(DONE).parquet(f"{folder}/level={level}")
        if edges.isEmpty() or done.isEmpty():
            break
        state = cut_lineage(_after(state, edges, done), "open")
        edges = cut_lineage(edges.join(done.select(F.col("id").alias("input")), "input", "left_anti"), "edges")
    settled = spark.read.schema(f"{DONE}, level int").parquet(folder)
    out = settled.select("id", "level", "operation", "value", "declared", "problem")
    if not edges.isEmpty():
        ring = on_cycles(edges).withColumn("_ring", F.lit(True))
        stuck = state.filter("waiting > 0").join(ring, "id", "left")
        out = out.unionByName(stuck.select(
            "id", F.lit(None).cast("int").alias("level"), "operation", F.lit(None).cast(MONEY).alias("value"), "declared",
            F.when(F.col("_ring"), "cycle").otherwise("unknown input").alias("problem")))
    return out if "declared" in derivations.columns else out.drop("declared")


def on_cycles(edges: DataFrame) -> DataFrame:
    """The ids of a graph (id, input) without sources that lie on a cycle or between two.

    Nothing in it is without inputs, so what remains after the ids that nobody waits for have gone,
    round by round, are cycles and the ways between them.
    """
    left = edges.select("id", "input").distinct()
    while True:
        inner = cut_lineage(left.join(left.select(F.col("input").alias("id")).distinct(), "id", "left_semi"), "cycles")
        if inner.count() == left.count():
            return inner.select("id").distinct()
        left = inner


def leaves(derivations: DataFrame, node_facts: DataFrame) -> DataFrame:
    """``(id, fact_id)``: the served facts every derivation rests on, however far below.

    Each round takes the facts that are new to their derivations one edge further, so it ends on cycles
    too.
    """
    edges = cut_lineage(derivations.select("id", F.explode("inputs").alias("input")).distinct(), "edges")
    new = cut_lineage(edges.join(node_facts.select(F.col("id").alias("input"), "fact_id"), "input").select("id", "fact_id").distinct(), "leaves")
    found = new
    while not new.isEmpty():
        further = edges.join(new.select(F.col("id").alias("input"), "fact_id"), "input").select("id", "fact_id").distinct()
        new = cut_lineage(further.join(found, ["id", "fact_id"], "left_anti"), "leaves")
        found = found.unionByName(new)
    return found
