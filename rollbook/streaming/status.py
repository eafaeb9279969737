"""Run status from the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollbook.operators.ledger import step_rollup


def live_rollup(events: DataFrame, order: tuple[str, ...] = ("ts", "seq")) -> DataFrame:
    """The step rollup as a streaming aggregation: one small state row per (job, step)."""
    return step_rollup(events, order)


def keep_latest(rollup: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write changed rows per micro-batch under ``path``.

    Each batch overwrites a folder of its own, so a repeated batch leaves one copy.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = (
        rollup.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if once else writer.start()


def latest_rows(batches: DataFrame, key: tuple[str, ...] = ("job_id", "step_name")) -> DataFrame:
    """Newest state per key from the batches written so far."""
    columns = [c for c in batches.columns if c not in (*key, "batch")]
    return (
        batches.groupBy(*key)
        .agg(F.max_by(F.struct(*columns), "batch").alias("row"))
        .select(*key, "row.*")
    )
