"""Keyed state: months from file arrivals, and live jobs that leave it."""

import json
from datetime import datetime

import pyarrow.parquet as pq

from rollbook.operators.ledger import EVENT_SCHEMA, step_rollup
from rollbook.streaming import arrivals as A
from rollbook.streaming import jobs as J
from rollbook.streaming.status import keep_latest
from tests.helpers import rows
from workload import loads


class Steps:
    """One stream over a folder that grows, run until it has read what is there."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema

    def add(self, values, run):
        self.spark.createDataFrame(values, self.schema).coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        query = run(self.spark.readStream.schema(self.schema).parquet(f"{self.path}/in"))
        query.awaitTermination()
        return query


def file(key, name, length, day, path=None):
    return (key, name, path or f"in/{name}", length, None, datetime(2026, 3, day))


def listing(key, day, **files):
    return (key, None, None, None, [(n, size) for n, size in files.items()], datetime(2026, 3, day))


def test_a_month_is_released_once_when_it_is_complete(spark, tmp_path):
    steps, seen = Steps(spark, tmp_path, A.ARRIVAL_SCHEMA), []

    def run(stream):
        return A.watch_arrivals(stream, str(tmp_path / "checkpoint"), lambda key, files: seen.append((key, {f["name"]: (f["path"], f["length"]) for f in files})))

    steps.add([file("2026-02", "a", 1, 1), file("2026-02", "b", 7, 1), listing("2026-01", 1, x=5), (None, "n", "p", 1, None, datetime(2026, 3, 1))], run)
    assert seen == []
    steps.add([listing("2026-02", 2, a=1, b=2), file("2026-01", "x", 5, 2)], run)
    assert seen == [("2026-01", {"x": ("in/x", 5)})]  # b has another size than listed
    steps.add([file("2026-02", "b", 2, 3, "again/b"), file("2026-01", "x", 5, 3)], run)
    assert seen[1:] == [("2026-02", {"a": ("in/a", 1), "b": ("again/b", 2)})]
    steps.add([file("2026-02", "a", 1, 4), listing("2026-02", 4, a=1, b=2)], run)
    assert len(seen) == 2  # repeats and the same list release nothing
    steps.add([listing("2026-02", 5, a=1, b=2, c=None)], run)
    steps.add([file("2026-02", "c", 9, 6), listing("2026-02", 3, a=1)], run)  # an older list does not count
    assert [k for k, _ in seen] == ["2026-01", "2026-02", "2026-02"] and set(seen[2][1]) == {"a", "b", "c"}


def test_months_nothing_is_heard_of_leave_the_state(spark, tmp_path):
    steps, seen = Steps(spark, tmp_path, A.ARRIVAL_SCHEMA), []

    def run(stream):
        return A.watch_arrivals(stream, str(tmp_path / "checkpoint"), lambda key, files: seen.append(key), keep="2 days")

    steps.add([file("old", "a", 1, 1)], run)
    steps.add([file("new", "a", 1, 20)], run)
    query = steps.add([file("new", "b", 1, 21), listing("old", 1, a=1)], run)  # the list is too late
    progress = [json.loads(p.json) for p in query.recentProgress]
    assert seen == [] and progress[-1]["stateOperators"][0]["numRowsTotal"] == 1


def test_months_that_share_a_state_entry_keep_their_own(spark, tmp_path):
    steps, seen = Steps(spark, tmp_path, A.ARRIVAL_SCHEMA), []

    def run(stream):
        months = A.complete_months(stream, "2 days", buckets=1)
        batch = lambda df, _: seen.extend((r["run_key"], r["bytes"], r["arrivals"]) for r in df.collect())
        return months.writeStream.foreachBatch(batch).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()

    steps.add([listing("a", 1, x=1), listing("b", 1, x=2), file("b", "x", 2, 1), listing("c", 1, x=3)], run)
    assert seen == [("b", 2, 1)]
    steps.add([file("a", "x", 1, 2), listing("d", 20, y=4)], run)
    assert seen == [("b", 2, 1), ("a", 1, 1)]
    query = steps.add([file("d", "y", 4, 21)], run)
    assert seen == [("b", 2, 1), ("a", 1, 1), ("d", 4, 1)]
    state = query.recentProgress[-1].stateOperators[0]
    assert state.numRowsTotal == 1
    states = spark.read.format("statestore").load(str(tmp_path / "checkpoint")).select("value.*").toJSON().collect()
    assert len(states) == 1 and '\\"d\\"' in states[0] and not any(f'\\"{k}\\":' in states[0] for k in "abc")


def event(job, step, status, day, seq, error=None):
    return (job, "2026-03", step, status, datetime(2026, 3, day), error, f"out/{seq}", seq)


def test_finished_jobs_leave_and_come_back(spark, tmp_path):
    steps, every = Steps(spark, tmp_path, EVENT_SCHEMA), []

    def run(stream):
        return keep_latest(J.live_jobs(stream, keep="1 day", idle="10 days"), str(tmp_path / "batches"), str(tmp_path / "checkpoint"))

    def add(*values):
        every.extend(values)
        return steps.add(list(values), run)

    add(event("j1", "load", "RUNNING", 1, 1), event("j1", "load", "FAILED", 1, 2, "no"), event("j1", "run", "RUNNING", 1, 3), event("j2", "run", "RUNNING", 1, 4))
    add(event("j1", "load", "SUCCESS", 2, 5), event("j1", "run", "SUCCESS", 2, 6))
    query = add(event("j3", "run", "RUNNING", 6, 7))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2  # j1 ended and left; j2 did not end
    query = add(event("j1", "load", "RUNNING", 7, 8), event("j2", "load", "SKIPPED", 7, 9))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3
    late = steps.add([event("j1", "load", "FAILED", 3, 10, "late")], run)  # dropped, and counted
    assert sum(json.loads(p.json)["stateOperators"][0]["numRowsDroppedByWatermark"] for p in late.recentProgress) == 1
    query = add(event("j4", "run", "RUNNING", 29, 11))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1  # idle ones go, too
    found = J.whole_rollup(spark.read.parquet(str(tmp_path / "batches")))
    want = step_rollup(spark.createDataFrame(every, EVENT_SCHEMA)).drop("first_write")
    assert rows(found, *want.columns) == rows(want) and found.count() == 6


def test_many_events_of_a_job_are_one_record(spark):
    events = spark.createDataFrame([event("hot", "load", "RUNNING" if k % 2 else "FAILED", 1 + k % 20, k) for k in range(3000)], EVENT_SCHEMA).coalesce(1)
    found = J.partials(events).collect()
    assert len(found) == 1 and (found[0]["writes"], found[0]["runs"]) == (3000, 1500)
    assert J.partials(events.limit(0)).count() == 0


def test_jobs_share_a_state_entry(spark, tmp_path):
    steps = Steps(spark, tmp_path, EVENT_SCHEMA)

    def run(stream):
        return keep_latest(J.live_jobs(stream, buckets=1), str(tmp_path / "batches"), str(tmp_path / "checkpoint"))

    query = steps.add([event(f"j{k}", "run", "RUNNING", 1, k) for k in range(5)], run)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
    report = J.whole_rollup(spark.read.parquet(str(tmp_path / "batches")))
    assert sorted(r["job_id"] for r in report.collect()) == [f"j{k}" for k in range(5)]


def test_a_micro_batch_of_the_rollup_has_many_files(spark, tmp_path, monkeypatch):
    found = []
    monkeypatch.setattr(loads, "work_dir", lambda _, purpose: str(tmp_path / purpose))
    monkeypatch.setattr(loads, "keep_latest", lambda *args: found.append(keep_latest(*args)) or found[0])
    loads.stream_rollup(spark, "/root/testdata/sf0.001")
    files = [len(pq.read_table(p)) for p in (tmp_path / "rollup/events").glob("*.parquet")]
    assert len(files) == 3 * loads.BATCH_FILES > 3 and max(files) < sum(files) / 3
    progress = [p.numInputRows for p in found[0].recentProgress if p.numInputRows]
    assert len(progress) == 3 and sum(progress) == sum(files)
