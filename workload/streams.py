"""Streams with keyed state: months put together from file arrivals, and job status that finished jobs leave."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.session import work_dir
from rollbook.streaming import arrivals, jobs
from rollbook.streaming.status import keep_latest
from workload import roles
from workload.catalog import query
from workload.ledger import _ROLLUP, ORDER, times
from workload.oracle import sql
from workload.roles import table


@query(
    "stream_arrivals",
    "WITH files AS (SELECT o_custkey, o_orderkey % 2 AS early, length(o_orderpriority) + o_orderkey AS n, o_orderkey % 97 = 0 AS lost FROM orders) "
    "SELECT CAST(o_custkey AS VARCHAR) AS run_key, count(*) AS files, CAST(sum(n) AS BIGINT) AS bytes, "
    "CAST(CASE WHEN sum(early) = count(*) THEN count(*) ELSE sum(early) + count(*) END AS BIGINT) AS arrivals FROM files GROUP BY o_custkey HAVING NOT bool_or(lost)",
)
def stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as months and their orders as files: some come before the list, some after it, early ones twice, and some never."""
    root = work_dir(spark, "arrivals")
    orders = table(spark, sf_dir, "orders")
    length = (F.length("o_orderpriority") + F.col("o_orderkey")).alias("length")
    key, name = F.col("o_custkey").cast("string").alias("run_key"), F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("name")
    files = orders.select(key, name, F.concat(F.lit("in/"), name).alias("path"), length, F.lit(None).cast("array<struct<name: string, length: bigint>>").alias("expected"), "o_orderkey")
    lists = orders.select(key, F.struct(name, length).alias("f")).groupBy("run_key").agg(F.collect_list("f").alias("expected"))
    lists = lists.select("run_key", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("bigint").alias("length"), "expected")
    early, late = files.filter("o_orderkey % 2 = 1 AND o_orderkey % 97 <> 0").drop("o_orderkey"), files.filter("o_orderkey % 2 = 0 AND o_orderkey % 97 <> 0").drop("o_orderkey")
    for k, batch in enumerate((early, lists, late.unionByName(early))):
        batch.withColumn("at", F.to_timestamp(F.lit(f"2026-03-0{k + 1} 00:00:00"))).write.mode("append").parquet(f"{root}/arrivals")
        stream = spark.readStream.schema(arrivals.ARRIVAL_SCHEMA).parquet(f"{root}/arrivals")
        done = arrivals.complete_months(stream).writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
        done.trigger(availableNow=True).format("parquet").option("path", f"{root}/released").start().awaitTermination()
    released = spark.read.schema(arrivals.RELEASED_SCHEMA).parquet(f"{root}/released")
    return released.select("run_key", F.size("files").cast("bigint").alias("files"), "bytes", "arrivals")


@query("stream_live_jobs", sql("run_events", _ROLLUP.format(source="run_events")))
def stream_live_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step rollup from a stream in which jobs leave the state and come back: the events of a month in three parts."""
    root = work_dir(spark, "live-jobs")
    events = table(spark, sf_dir, "events")
    for first, last in ((1, 10), (11, 20), (21, 31)):
        events.filter(F.dayofmonth("ts").between(first, last)).write.mode("append").parquet(f"{root}/events")
        stream = roles.run_events(spark.readStream.schema(events.schema).parquet(f"{root}/events"))
        live = jobs.live_jobs(stream, finish_step="step_9", keep="1 day", idle="2 days", order=ORDER)
        keep_latest(live, f"{root}/batches", f"{root}/checkpoint").awaitTermination()
    return times(jobs.whole_rollup(spark.read.parquet(f"{root}/batches")))
