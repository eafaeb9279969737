"""Run status from the event stream, in a state that finished jobs leave.

The state has one short record per step of each live job, and jobs share entries by their bucket. A job is finished when its ``finish_step`` ended well or for good;
``keep`` after its last event it leaves the state, as does, ``idle`` after it, a job that never ended. Events
more than ``late`` behind the newest one are dropped (Spark counts them). A job that is heard of again after it left begins a new
generation; :func:`whole_rollup` adds generations up, so the report is that of all events, however often a job left.

Events of a task's batch are combined by job and step before the shuffle: a job that has most events sends a few records.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from rollbook.functions.status import DEAD, RUNNING, SKIPPED, SUCCESS, finished_at
from rollbook.operators.ledger import WHOLE_RUN

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SIDE = "writes bigint, runs bigint, started bigint, finished bigint, first_ts bigint, first_seq bigint, last_ts bigint, last_seq bigint, newest bigint, status string, error string, artifact_path string"
PARTIAL_SCHEMA = f"job_id string, step_name string, at timestamp, {_SIDE}"
ROLLUP_SCHEMA = f"job_id string, step_name string, generation bigint, {_SIDE}"
_FIELDS = [f.split()[0] for f in _SIDE.split(", ")]
_ENDED = (SUCCESS, DEAD, SKIPPED)


#: Groups that jobs are put in; a group is one state entry. The number may not change while a stream lives.
BUCKETS = 1024


def _or(a, b, choose):
    return b if a is None else a if b is None else choose(a, b)


def combined(a: dict | None, b: dict) -> dict:
    """Two records of a step as one: sums, extremes, and what was written last."""
    if a is None:
        return b
    last = b if (b["last_ts"], b["last_seq"]) >= (a["last_ts"], a["last_seq"]) else a
    first = min((a["first_ts"], a["first_seq"]), (b["first_ts"], b["first_seq"]))
    return {
        "writes": a["writes"] + b["writes"], "runs": a["runs"] + b["runs"], "started": _or(a["started"], b["started"], max),
        "finished": _or(a["finished"], b["finished"], max), "first_ts": first[0], "first_seq": first[1], "newest": max(a["newest"], b["newest"]),
        **{f: last[f] for f in ("last_ts", "last_seq", "status", "error", "artifact_path")},
    }


def _plain(value):
    return None if value is None or (isinstance(value, float) and pd.isna(value)) or value is pd.NA else value if isinstance(value, str) else int(value)


def _records(batch: pd.DataFrame) -> Iterator[tuple[str, str, dict]]:
    for row in batch.itertuples(index=False):
        yield row.job_id, row.step_name, {f: _plain(getattr(row, f)) for f in _FIELDS}


def partials(events: DataFrame, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Records of single events, combined by job and step within each batch of a task. ``order`` is (ts, seq), or seq alone."""
    status, micros = F.col("status"), F.unix_micros(F.col("ts").cast("timestamp"))
    place = micros if "ts" in order else F.lit(0).cast("bigint")
    single = events.filter("job_id IS NOT NULL AND step_name IS NOT NULL AND ts IS NOT NULL").select(
        "job_id", "step_name", F.col("ts").cast("timestamp").alias("at"), F.lit(1).cast("bigint").alias("writes"), (status == RUNNING).cast("bigint").alias("runs"),
        F.when(status == RUNNING, micros).alias("started"), F.when(finished_at(status, micros).isNotNull(), micros).alias("finished"),
        place.alias("first_ts"), F.col("seq").alias("first_seq"), place.alias("last_ts"), F.col("seq").alias("last_seq"), micros.alias("newest"), "status", "error", "artifact_path",
    )

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[tuple[str, str], dict] = {}
            for job, step, record in _records(batch.astype(object).where(batch.notna(), None)):
                found[job, step] = combined(found.get((job, step)), record)
            # A record is late if its newest event is.
            yield pd.DataFrame(
                {
                    "job_id": pd.Series([j for j, _ in found], dtype=object), "step_name": pd.Series([s for _, s in found], dtype=object),
                    "at": pd.to_datetime(pd.Series([r["newest"] for r in found.values()], dtype="int64"), unit="us"),
                    **{f: pd.Series([r[f] for r in found.values()], dtype=object) for f in _FIELDS},
                }
            )

    return single.mapInPandas(combine, PARTIAL_SCHEMA)


def live_jobs(
    events: DataFrame, finish_step: str = WHOLE_RUN, keep: str = "1 day", idle: str = "30 days", late: str = "1 hour", order: Sequence[str] = ("ts", "seq"),
    buckets: int = BUCKETS,
) -> DataFrame:
    """The records of steps that changed, of each micro-batch. ``events`` is a stream of run events."""
    keep_ms, idle_ms = (pd.Timedelta(x) // pd.Timedelta("1ms") for x in (keep, idle))

    def until(steps: dict) -> int:
        ended = finish_step in steps and steps[finish_step]["status"] in _ENDED
        return max(r["newest"] for r in steps.values()) // 1000 + (keep_ms if ended else idle_ms)

    def step(key, rows, state):
        known, changed = json.loads(state.get[0]) if state.exists else {}, {}
        if not state.hasTimedOut:
            for batch in rows:
                for job, name, record in _records(batch.astype(object).where(batch.notna(), None)):
                    steps = known.setdefault(job, {"steps": {}, "generation": None})["steps"]
                    steps[name] = combined(steps.get(name), record)
                    changed.setdefault(job, set()).add(name)
        for job in changed:
            if known[job]["generation"] is None:
                known[job]["generation"] = min(r["first_seq"] for r in known[job]["steps"].values())
        out = [(job, name, known[job]["generation"], known[job]["steps"][name]) for job in sorted(changed) for name in sorted(changed[job])]
        mark = state.getCurrentWatermarkMs()
        known = {j: k for j, k in known.items() if j in changed or until(k["steps"]) >= mark}
        if known:
            state.update((json.dumps(known),))
            state.setTimeoutTimestamp(max(min(until(k["steps"]) for k in known.values()), mark + 1))
        else:
            state.remove()
        if out:
            yield pd.DataFrame({
                "job_id": [o[0] for o in out], "step_name": [o[1] for o in out], "generation": [o[2] for o in out],
                **{f: pd.Series([o[3][f] for o in out], dtype=object) for f in _FIELDS},
            })

    # A call into Python costs some milliseconds: jobs share a state entry by their bucket.
    placed = partials(events, order).withWatermark("at", late).withColumn("bucket", F.pmod(F.xxhash64("job_id"), F.lit(buckets)))
    return placed.groupBy("bucket").applyInPandasWithState(step, ROLLUP_SCHEMA, "jobs string", "update", "EventTimeTimeout")


def whole_rollup(batches: DataFrame) -> DataFrame:
    """The report of all steps from what the micro-batches wrote: generations added up, and the last word of the latest."""
    values = [c for c in batches.columns if c not in ("job_id", "step_name", "generation", "batch")]
    newest = batches.groupBy("job_id", "step_name", "generation").agg(F.max_by(F.struct(*values), "batch").alias("r")).select("job_id", "step_name", "r.*")
    last = F.max_by(F.struct("status", "error", "artifact_path"), F.struct("last_ts", "last_seq"))
    summed = newest.groupBy("job_id", "step_name").agg(
        last.alias("last"), F.sum("writes").alias("writes"), F.sum("runs").alias("runs"),
        F.timestamp_micros(F.max("started")).alias("started_at"), F.timestamp_micros(F.max("finished")).alias("finished_at"),
    )
    return summed.select("job_id", "step_name", "last.status", "last.error", "last.artifact_path", "writes", "runs", "started_at", "finished_at")
