"""Drops put together from the arrivals of their files, in any order.

A merge deletes what a dump lacks, so a month must be complete before it is loaded. For each month a keyed state holds the files that
came and the list of those that belong to it; when all are there, with the sizes the list names, the month is released, once for
each list. A file that comes again replaces its earlier arrival, also after the release, without a second one; a new list that differs starts
the month over with the files known. A month nothing is heard of for ``keep`` leaves the state; arrivals later than that are dropped.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

# The functions below travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: An arrival has a path; a list of a month's files has no path and names them as ``expected``.
ARRIVAL_SCHEMA = "run_key string, name string, path string, length bigint, expected array<struct<name: string, length: bigint>>, at timestamp"
RELEASED_SCHEMA = "run_key string, files array<struct<name: string, path: string, length: bigint>>, bytes bigint, arrivals bigint"
#: Groups that months are put in; a group is one state entry.
BUCKETS = 1024
_FILES = "array<struct<name: string, path: string, length: bigint>>"
_FLAT_SCHEMA = "run_key string, files string, bytes bigint, arrivals bigint"
_STATE = "state string"


def _take(month: dict, name, path, length, expected, at: int) -> None:
    """Take one arrival, or one list, into the state of its month."""
    if path is None:
        if at >= month["listed_at"]:
            month["expected"], month["listed_at"] = {e["name"]: e.get("length") for e in json.loads(expected)}, at
        return
    month["arrivals"] += 1
    known = month["files"].get(name)
    if known is None or at >= known[2]:
        month["files"][name] = [path, None if pd.isna(length) else int(length), at]


def _released(month: dict) -> dict | None:
    """The files of the month, if it is complete now and was not released for this list."""
    wanted, files = month["expected"], month["files"]
    if wanted is None:
        return None
    digest = hashlib.sha256(json.dumps(sorted(wanted.items())).encode()).hexdigest()
    complete = all(n in files and size in (None, files[n][1]) for n, size in wanted.items())
    if not wanted or not complete or month["released"] == digest:
        return None
    month["released"] = digest
    return {n: files[n] for n in sorted(wanted)}


def complete_months(arrivals: DataFrame, keep: str = "60 days", buckets: int = BUCKETS) -> DataFrame:
    """(run_key, files, bytes, arrivals) of every month as its last file comes in. ``arrivals`` is a stream of :data:`ARRIVAL_SCHEMA`.

    A call into Python costs some milliseconds, so months share one by their bucket; each keeps a state and an end of its own. The number of
    buckets may not change while a stream lives.
    """
    keep_ms = pd.Timedelta(keep) // pd.Timedelta("1ms")

    def until(month: dict) -> int:
        return max([month["listed_at"], *(f[2] for f in month["files"].values())]) // 1000 + keep_ms

    def step(key, rows, state):
        months, touched = json.loads(state.get[0]) if state.exists else {}, set()
        if not state.hasTimedOut:
            for batch in rows:
                for run_key, *rest in zip(*(batch[c] for c in ("run_key", "name", "path", "length", "expected", "micros"))):
                    if run_key not in months:
                        months[run_key] = {"expected": None, "listed_at": -(1 << 62), "files": {}, "arrivals": 0, "released": None}
                    _take(months[run_key], *rest)
                    touched.add(run_key)
        done = [(k, files) for k in sorted(touched) if (files := _released(months[k]))]
        out = [(k, [{"name": n, "path": f[0], "length": f[1]} for n, f in files.items()], months[k]["arrivals"]) for k, files in done]
        mark = state.getCurrentWatermarkMs()
        months = {k: m for k, m in months.items() if k in touched or until(m) > mark}
        if months:
            state.update((json.dumps(months),))
            state.setTimeoutTimestamp(max(min(until(m) for m in months.values()), mark + 1))
        else:
            state.remove()
        if out:
            yield pd.DataFrame({
                "run_key": [k for k, _, _ in out], "files": [json.dumps(files) for _, files, _ in out],
                "bytes": [sum(f["length"] or 0 for f in files) for _, files, _ in out], "arrivals": [n for *_, n in out],
            })

    # The marks are short: what is known of a month crosses the shuffle once. Lists go to and from Python as text.
    marked = arrivals.withWatermark("at", keep).filter("run_key IS NOT NULL AND at IS NOT NULL")
    flat = marked.select(
        F.pmod(F.xxhash64("run_key"), F.lit(buckets)).alias("bucket"), "run_key", "name", "path", "length", F.to_json("expected").alias("expected"), "at", F.unix_micros("at").alias("micros"),
    )
    released = flat.groupBy("bucket").applyInPandasWithState(step, _FLAT_SCHEMA, _STATE, "append", "EventTimeTimeout")
    return released.withColumn("files", F.from_json("files", _FILES))


def watch_arrivals(arrivals: DataFrame, checkpoint: str, handle: Callable[[str, list], object], keep: str = "60 days", once: bool = True) -> StreamingQuery:
    """Call ``handle(run_key, files)`` for every month that is complete, in order of months within a batch.

    A batch that is repeated after a failure calls ``handle`` again; loads skip steps already done.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        # Months, not files; sorted here, since a sort in Spark would run the state twice.
        for row in sorted(df.collect(), key=lambda r: r["run_key"]):
            handle(row["run_key"], row["files"])

    writer = complete_months(arrivals, keep).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()
