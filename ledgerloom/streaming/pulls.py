"""Pulls as they arrive: each is judged against the baseline of its source, which then moves on.

The batch ledger (``operators.drift``) stays the only definition of drift. A micro-batch reads its own
rows and one baseline per source, whatever the history behind them, and writes findings and the next
baselines under its own number, so a replayed batch replaces itself. The sequences of a source ascend
from batch to batch. Baselines older than those of the batch before the last can be deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators import drift
from ledgerloom.session import cut_lineage

PULLS = "source_id string, pull_seq bigint, columns array<string>, completeness string"


def stored_baselines(batch: DataFrame, number: int, folder: str) -> DataFrame:
    """What the batch before ``number`` left; nothing before the first."""
    spark = batch.sparkSession
    if number == 0:
        return spark.createDataFrame([], drift.BASELINES)
    return spark.read.schema(drift.BASELINES).parquet(f"{folder}/batch={number - 1}")


def judge_batch(batch: DataFrame, number: int, baselines: str, findings: str) -> None:
    """Write the drift of one batch of pulls to ``findings`` and the baselines after it."""
    rows = cut_lineage(batch.select("source_id", "pull_seq", "columns", "completeness"), "arrived")
    before = stored_baselines(batch, number, baselines)
    drift.ledger(rows, baselines=before).write.mode("overwrite").parquet(f"{findings}/batch={number}")
    drift.baselines_after(rows, before).write.mode("overwrite").parquet(f"{baselines}/batch={number}")


def follow_pulls(pulls: DataFrame, baselines: str, findings: str, checkpoint: str) -> StreamingQuery:
    """Run ``judge_batch`` on a stream of pulls until what is available is done."""
    return (
        pulls.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda batch, number: judge_batch(batch, number, baselines, findings)).start()
    )
