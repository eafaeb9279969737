"""Run history as an append-only event table, and the reports made from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollbook.functions.status import (
    DEAD, FAILED, FINISHED, MAX_ATTEMPTS, PENDING, RETRYABLE, RUNNING, SUCCESS, finished_at, started_at,
)
from rollbook.operators.joins import SALTS, join_unique

EVENT_SCHEMA = (
    "job_id string, run_key string, step_name string, status string, ts timestamp, error string, "
    "artifact_path string, seq bigint"
)
# Page size of the run list and number of runs in the status summary.
DEFAULT_RUNS, MAX_RUNS, SUMMARY_RUNS = 10, 50, 5
RUN_COLUMNS = (
    "job_id", "run_key", "status", "attempts", "created_at", "started_at", "finished_at", "last_error",
)


def _latest(columns: Sequence[str], order: Sequence[str]) -> Column:
    return F.max_by(F.struct(*columns), F.struct(*order))


# Step name under which a run as a whole is recorded.
WHOLE_RUN = "run"


def whole_runs(events: DataFrame) -> DataFrame:
    """The events that tell about runs, not about their steps."""
    return events.filter(F.col("step_name") == WHOLE_RUN)


def step_rollup(events: DataFrame, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Per job and step: last status, error and artifact, number of writes and of starts, last times.

    All aggregates combine before the shuffle, so a job with very many events costs one row per task.
    """
    status, ts = F.col("status"), F.col("ts")
    return (
        events.groupBy("job_id", "step_name")
        .agg(
            _latest(["status", "error", "artifact_path"], order).alias("last"),
            F.count("*").alias("writes"),
            F.count_if(status == RUNNING).alias("runs"),
            F.max(started_at(status, ts)).alias("started_at"),
            F.max(finished_at(status, ts)).alias("finished_at"),
            F.min(F.struct(*order)).alias("first_write"),
        )
        .select(
            "job_id", "step_name", "last.status", "last.error", "last.artifact_path", "writes", "runs",
            "started_at", "finished_at", "first_write",
        )
    )


def _with_reset(events: DataFrame, of: DataFrame, order: Sequence[str], requeue: str) -> DataFrame:
    """``of`` with ``reset``, the place in ``order`` at which its job was last put back in the queue.

    The join partner has one short row per job. The join is salted, since an aggregate by job follows it: a job
    with a large share of all events is spread over tasks, and combined there before the shuffle.
    """
    resets = (
        events.filter(F.col("status") == requeue).groupBy("job_id").agg(F.max(F.struct(*order)).alias("reset"))
    )
    return join_unique(of, resets, "job_id", "left", salts=SALTS)


def _after_reset(order: Sequence[str]) -> Column:
    return F.col("reset").isNull() | (F.struct(*order) > F.col("reset"))


def since_requeue(events: DataFrame, order: Sequence[str] = ("ts", "seq"), requeue: str = PENDING) -> DataFrame:
    """Step events after their job was last put back in the queue; the requeue events themselves go."""
    steps = events.filter(F.col("status") != requeue)
    return _with_reset(events, steps, order, requeue).filter(_after_reset(order)).drop("reset")


def job_steps(rollup: DataFrame, job_id: str) -> DataFrame:
    """Steps of one job in the order they were first written."""
    return rollup.filter(F.col("job_id") == job_id).orderBy("first_write").drop("first_write")


def run_records(
    events: DataFrame, order: Sequence[str] = ("ts", "seq"), max_attempts: int = MAX_ATTEMPTS,
    lease_seconds: int = 3600,
) -> DataFrame:
    """One row per job from its events.

    Going back to the queue clears attempts, lease, times and error; only the creation time stays. A start is
    an attempt and takes a lease, which a finish leaves as it is. The error is that of the last finish. A
    failure with no attempt left is final.
    """
    status, ts, live = F.col("status"), F.col("ts"), _after_reset(order)
    rolled = _with_reset(events, events, order, PENDING).groupBy("job_id").agg(
        F.min_by("run_key", F.struct(*order)).alias("run_key"),
        F.max_by("status", F.struct(*order)).alias("last"),
        F.max_by("error", F.when(live & status.isin(*FINISHED), F.struct(*order))).alias("last_error"),
        F.count_if(live & (status == RUNNING)).cast("int").alias("attempts"),
        F.min("ts").alias("created_at"),
        F.max(F.when(live, started_at(status, ts))).alias("started_at"),
        F.max(F.when(live, finished_at(status, ts))).alias("finished_at"),
    )
    used_up = (F.col("last") == FAILED) & (F.col("attempts") >= max_attempts)
    lease = F.col("started_at") + F.expr(f"interval {int(lease_seconds)} seconds")
    return rolled.select(
        "job_id", "run_key", F.when(used_up, DEAD).otherwise(F.col("last")).alias("status"), "attempts",
        F.lit(max_attempts).alias("max_attempts"), lease.alias("lease_until"), "created_at", "started_at",
        "finished_at", "last_error",
    )


def recent_runs(runs: DataFrame, limit: int = DEFAULT_RUNS, highest: int = MAX_RUNS) -> DataFrame:
    """Latest runs first, 1 to 50 of them; ties by job."""
    return runs.orderBy(F.desc("created_at"), "job_id").limit(max(1, min(limit, highest))).select(*RUN_COLUMNS)


def eligible_runs(runs: DataFrame, now: str | Column) -> DataFrame:
    """Runs that may start at ``now``: waiting or failed, attempts left, not leased."""
    now = F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now
    free = F.col("lease_until").isNull() | (F.col("lease_until") < now)
    return runs.filter(F.col("status").isin(*RETRYABLE) & (F.col("attempts") < F.col("max_attempts")) & free)


def next_run(runs: DataFrame, now: str | Column) -> DataFrame:
    """The oldest of them."""
    return eligible_runs(runs, now).orderBy("created_at", "job_id").limit(1)


def last_success(runs: DataFrame) -> DataFrame:
    """One row: run key and time of the run that succeeded last; nulls if none did."""
    good = F.col("status") == SUCCESS
    order = F.when(good, F.struct("finished_at", "job_id"))
    return runs.agg(
        F.max_by("run_key", order).alias("last_success_run_key"),
        F.max(F.when(good, F.col("finished_at"))).alias("finished_at"),
    )


def health(runs: DataFrame, serving: DataFrame) -> DataFrame:
    """One row: state, last successful run, rows served."""
    last = last_success(runs).select("last_success_run_key", F.lit(0).cast("bigint").alias("row_count"))
    served = serving.agg(F.count("*").alias("row_count")).select(
        F.lit(None).cast("string").alias("last_success_run_key"), "row_count"
    )
    return last.unionByName(served).agg(
        F.lit("ok").alias("status"),
        F.max("last_success_run_key").alias("last_success_run_key"),
        F.sum("row_count").alias("row_count"),
    )


def outcome_counts(results: DataFrame, ok: str | Column) -> DataFrame:
    """One row: how many of a batch went well and how many did not."""
    ok = F.coalesce(F.col(ok) if isinstance(ok, str) else ok, F.lit(False))
    return results.agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"))


def totals(metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: sums over the tables of a load; a counter a table lacks counts as 0."""
    return metrics.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in columns])


def status_summary(runs: DataFrame, limit: int = SUMMARY_RUNS) -> DataFrame:
    """Position 0 is the last successful run key, positions 1, 2, ... the latest runs.

    The numbering window sees only the few rows the limit lets through.
    """
    last = last_success(runs).select(
        F.lit(0).alias("position"), F.col("last_success_run_key").alias("run_key"), F.lit(None).cast("string").alias("job_id"),
        F.lit(SUCCESS).alias("status"),
    )
    recent = recent_runs(runs, limit).select(
        F.row_number().over(Window.orderBy(F.desc("created_at"), "job_id")).alias("position"),
        "run_key", "job_id", "status",
    )
    return last.unionByName(recent)
