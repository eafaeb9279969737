"""The run-event table: one appended line per status change."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from rollbook.operators.ledger import EVENT_SCHEMA
from rollbook.sources.tables import read_if_there, small_table


class RunEvents:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def append(
        self, job_id: str, run_key: str, step_name: str, status: str, error: str | None = None,
        artifact_path: str | None = None,
    ) -> None:
        row = (
            job_id, run_key, step_name, status, datetime.now(timezone.utc), error, artifact_path, time.time_ns(),
        )
        small_table(self.spark, [row], EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        events = read_if_there(self.spark, self.path, EVENT_SCHEMA)
        return self.spark.createDataFrame([], EVENT_SCHEMA) if events is None else events
