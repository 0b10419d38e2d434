"""Schema drift over the history of pulls of each source.

``pulls`` has ``source_id, pull_seq BIGINT, columns ARRAY<STRING>, completeness``; ``baselines`` has
``source_id, columns ARRAY<STRING>, full BOOLEAN``, at most one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage
from ledgerloom.sources.landing import FULL, fingerprint_of

BASELINES = "source_id string, columns array<string>, full boolean"
#: Rows of a task that counts off chunks, unless one chunk is larger.
TASK_ROWS = 100_000


def drift_between(base: Column, base_full: Column, current: Column, current_full: Column) -> Column:
    """``struct(detected, comparable, added, removed)``; two scopes compare only if both are full."""
    comparable = base_full & current_full
    nothing = F.array().cast("array<string>")
    added = F.when(comparable, F.array_sort(F.array_except(current, base))).otherwise(nothing)
    removed = F.when(comparable, F.array_sort(F.array_except(base, current))).otherwise(nothing)
    detected = (F.size(added) > 0) | (F.size(removed) > 0)
    return F.struct(
        detected.alias("detected"), comparable.alias("comparable"), added.alias("added"), removed.alias("removed")
    )


def _seen() -> Column:
    return F.struct("columns", (F.col("completeness") == FULL).alias("full"))


def _in_chunks(pulls: DataFrame, chunk: int) -> DataFrame:
    """``pulls`` with ``_chunk``: neighbours in the order of source and sequence, ``chunk`` of them or fewer.

    Chunks are counted off inside range partitions, so their size doesn't depend on how densely the
    sequences are used, and many small ones share a task and a file. They are saved, to stay what they
    are when a task is lost.
    """
    saved = cut_lineage(pulls, "pulls")
    tasks = max(1, -(-saved.count() // max(chunk, TASK_ROWS)))
    ranged = saved.repartitionByRange(tasks, "source_id", "pull_seq").sortWithinPartitions("source_id", "pull_seq")
    # The partition's number in the upper bits, the row's in the lower 33.
    at = ranged.withColumn("_at", F.monotonically_increasing_id())
    first = F.shiftleft(F.shiftright("_at", 33), 33)
    return cut_lineage(at.withColumn("_chunk", first + F.floor((F.col("_at") - first) / chunk)).drop("_at"), "chunks")


def baselines_after(pulls: DataFrame, baselines: DataFrame) -> DataFrame:
    """The baselines in force after ``pulls``: the last full pull, else the one before, else the first pull."""
    at = F.when(F.col("completeness") == FULL, F.col("pull_seq"))
    new = pulls.withColumn("_seen", _seen()).groupBy("source_id").agg(
        F.max_by("_seen", at).alias("_full"), F.min_by("_seen", "pull_seq").alias("_start")
    )
    old = baselines.select("source_id", F.struct("columns", "full").alias("_old"))
    both = new.join(old, "source_id", "full_outer")
    return both.select("source_id", F.coalesce("_full", "_old", "_start").alias("b")).select("source_id", "b.columns", "b.full")


def ledger(pulls: DataFrame, chunk: int = 10_000, baselines: DataFrame | None = None) -> DataFrame:
    """Each pull with its drift against the baseline in force when it arrived.

    The first pull of a source is its baseline whatever its scope; later only a full pull replaces
    it. ``baselines`` are those of sources that were seen before ``pulls``. The pulls are cut into
    chunks of at most ``chunk`` rows: windows run inside a chunk, and a window over one row per chunk
    carries the baseline from chunk to chunk, so a source with a long history is spread over many
    tasks.
    """
    if baselines is None:
        baselines = pulls.sparkSession.createDataFrame([], BASELINES)
    rows = _in_chunks(pulls, chunk).withColumn("_seen", _seen())
    full = F.when(F.col("completeness") == FULL, F.col("_seen"))

    inside = Window.partitionBy("source_id", "_chunk").orderBy("pull_seq")
    rows = rows.withColumn("_local", F.last(full, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)))

    across = Window.partitionBy("source_id").orderBy("_chunk")
    carried = (
        rows.groupBy("source_id", "_chunk")
        .agg(
            F.max_by(F.col("_seen"), F.when(F.col("completeness") == FULL, F.col("pull_seq"))).alias("_full"),
            F.min_by(F.struct("pull_seq", "_seen"), F.col("pull_seq")).alias("_start"),
        )
        .select(
            "source_id",
            "_chunk",
            F.last("_full", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"),
            F.first("_start").over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_first"),
        )
        .join(baselines.select("source_id", F.struct("columns", "full").alias("_stored")), "source_id", "left")
    )
    joined = rows.join(carried, ["source_id", "_chunk"])
    is_first = F.col("_stored").isNull() & (F.col("pull_seq") == F.col("_first.pull_seq"))
    base = F.when(~is_first, F.coalesce("_local", "_carried", "_stored", F.col("_first._seen")))
    return (
        joined.withColumn("_base", base)
        .withColumn("_d", drift_between(F.col("_base.columns"), F.col("_base.full"), F.col("columns"), F.col("_seen.full")))
        .select(
            "source_id",
            "pull_seq",
            "completeness",
            F.when(F.col("_base").isNotNull(), fingerprint_of(F.col("_base.columns"))).alias("previous_version"),
            fingerprint_of(F.col("columns")).alias("new_version"),
            F.when(is_first, False).otherwise(F.col("_d.detected")).alias("detected"),
            F.when(is_first, True).otherwise(F.col("_d.comparable")).alias("comparable"),
            F.when(is_first, F.array().cast("array<string>")).otherwise(F.col("_d.added")).alias("added"),
            F.when(is_first, F.array().cast("array<string>")).otherwise(F.col("_d.removed")).alias("removed"),
        )
    )
