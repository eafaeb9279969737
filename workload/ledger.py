"""Run history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.functions.status import final_status
from rollbook.operators import ledger as L
from workload import roles
from workload.catalog import query
from workload.oracle import RUNS, STAR, sql
from workload.roles import table
from workload.serving import served

ORDER = ("ts", "seq")
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def times(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.date_format(c, TIME) for c in ("created_at", "started_at", "finished_at", "lease_until") if c in df.columns}
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.run_events(table(spark, sf_dir, "events"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.run_records(_events(spark, sf_dir))


def _t(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}"


_ROLLUP = (
    "SELECT job_id, step_name, arg_max(status, seq) AS status, (array_agg(error ORDER BY seq DESC))[1] AS error, "
    "(array_agg(artifact_path ORDER BY seq DESC))[1] AS artifact_path, count(*) AS writes, "
    "count(*) FILTER (status = 'RUNNING') AS runs, "
    "strftime(max(ts) FILTER (status = 'RUNNING'), '%Y-%m-%d %H:%M:%S.%f') AS started_at, "
    "strftime(max(ts) FILTER (status IN ('SUCCESS', 'FAILED', 'SKIPPED')), '%Y-%m-%d %H:%M:%S.%f') AS finished_at "
    "FROM {source} GROUP BY job_id, step_name"
)
_SINCE = (
    "(SELECT e.* FROM run_events e LEFT JOIN (SELECT job_id, max(seq) AS reset FROM run_events WHERE status = 'PENDING' "
    "GROUP BY 1) r USING (job_id) WHERE e.status <> 'PENDING' AND (r.reset IS NULL OR e.seq > r.reset))"
)


@query("step_rollup", sql("run_events", _ROLLUP.format(source="run_events")))
def step_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times(L.step_rollup(_events(spark, sf_dir), ORDER).drop("first_write"))


@query("step_rollup_since_requeue", sql("run_events", _ROLLUP.format(source=_SINCE)))
def step_rollup_since_requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A requeue clears what its job did before."""
    return times(L.step_rollup(L.since_requeue(_events(spark, sf_dir), ORDER), ORDER).drop("first_write"))


@query(
    "job_steps",
    sql(
        "run_events", "SELECT step_name, status, writes FROM (SELECT job_id, step_name, arg_max(status, seq) AS status, "
        "count(*) AS writes FROM run_events GROUP BY ALL) WHERE job_id = (SELECT max(job_id) FROM run_events)",
    ),
)
def job_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of one job; the order is checked in the tests."""
    events = _events(spark, sf_dir)
    job = events.agg(F.max("job_id")).first()[0]
    return L.job_steps(L.step_rollup(events, ORDER), job).select("step_name", "status", "writes")


@query(
    "run_records",
    sql(RUNS, "SELECT job_id, run_key, status, attempts, max_attempts, " + ", ".join(
        _t(c) for c in ("lease_until", "created_at", "started_at", "finished_at")) + ", last_error FROM runs"),
)
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times(_runs(spark, sf_dir))


@query(
    "recent_runs",
    sql(RUNS, f"SELECT job_id, run_key, status, attempts, {_t('created_at')}, {_t('started_at')}, {_t('finished_at')}, "
              "last_error FROM runs ORDER BY runs.created_at DESC, job_id LIMIT 50"),
)
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times(L.recent_runs(_runs(spark, sf_dir), 400))


_NOW = "2024-01-30 22:00:00"
_FREE = (
    f"status IN ('PENDING', 'FAILED') AND attempts < max_attempts AND (lease_until IS NULL OR lease_until < "
    f"TIMESTAMP '{_NOW}')"
)


@query("eligible_runs", sql(RUNS, f"SELECT job_id, run_key, status, attempts FROM runs WHERE {_FREE}"))
def eligible_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.eligible_runs(_runs(spark, sf_dir), _NOW).select("job_id", "run_key", "status", "attempts")


@query("next_run", sql(RUNS, f"SELECT job_id, run_key, status, attempts FROM runs WHERE {_FREE} ORDER BY created_at, job_id "
                             "LIMIT 1"))
def next_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.next_run(_runs(spark, sf_dir), _NOW).select("job_id", "run_key", "status", "attempts")


@query(
    "final_status",
    sql(RUNS, "SELECT job_id, attempts, CASE WHEN status = 'SUCCESS' THEN 'SUCCESS' WHEN attempts >= max_attempts THEN 'DEAD' "
              "ELSE 'FAILED' END AS final_status FROM runs"),
)
def final_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run becomes if it ends now."""
    return _runs(spark, sf_dir).select(
        "job_id", "attempts",
        final_status(F.col("status") == "SUCCESS", F.col("attempts"), F.col("max_attempts")).alias("final_status"),
    )


@query("run_outcomes", sql(RUNS, "SELECT count(*) FILTER (status = 'SUCCESS') AS ok, count(*) FILTER (status <> 'SUCCESS') "
                                 "AS failed FROM runs"))
def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.outcome_counts(_runs(spark, sf_dir), F.col("status") == "SUCCESS")


_LAST = "SELECT arg_max(run_key, finished_at) FILTER (status = 'SUCCESS') AS last_success_run_key"


@query("last_success", sql(RUNS, f"{_LAST}, strftime(max(finished_at) FILTER (status = 'SUCCESS'), "
                                 "'%Y-%m-%d %H:%M:%S.%f') AS finished_at FROM runs"))
def last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times(L.last_success(_runs(spark, sf_dir)))


@query(
    "health",
    sql((*RUNS, *STAR), f"SELECT 'ok' AS status, (SELECT * FROM ({_LAST} FROM runs)) AS last_success_run_key, "
                        "(SELECT count(*) FROM star) AS row_count"),
)
def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.health(_runs(spark, sf_dir), served(spark, sf_dir))


@query(
    "status_summary",
    sql(RUNS, f"SELECT 0 AS position, last_success_run_key AS run_key, CAST(NULL AS VARCHAR) AS job_id, 'SUCCESS' AS status "
              f"FROM ({_LAST} FROM runs) UNION ALL SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY created_at DESC, "
              "job_id) AS INTEGER) AS position, run_key, job_id, status FROM runs) WHERE position <= 5"),
)
def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.status_summary(_runs(spark, sf_dir))


@query(
    "json_payload",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
    "'{\"k\":' || json_extract_string(props, '$.k') || ',\"job\":\"' || CAST(user_id AS VARCHAR) || '\"}' AS payload FROM events",
)
def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read a payload, write another one."""
    parsed = table(spark, sf_dir, "events").select("event_id", "user_id", F.from_json("props", "k bigint").alias("p"))
    return parsed.select(
        "event_id", F.col("p.k").alias("k"),
        F.to_json(F.struct(F.col("p.k").alias("k"), F.col("user_id").cast("string").alias("job"))).alias("payload"),
    )
