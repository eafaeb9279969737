"""Versioned Parquet tables below one root folder.

Every load writes a new folder ``<table>/version=<v>`` and, after its checks passed, appends one line to
``publications``. The line with the latest time names the current version, so readers keep the old rows
until the new ones are complete, and a job that dies half way leaves nothing visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

ARROW_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "timestamp": pa.timestamp("us", tz="UTC")}
PART_SCHEMA = "buckets int,bucket int,version string,digest string,filled int"
PUBLICATION_SCHEMA = "table string, version string, run_key string, published_at timestamp"


class Part(NamedTuple):
    """A bucket (of so many), the version in whose folder it lies, the digest of its rows, and whether it has any, deleted ones included."""

    buckets: int
    bucket: int
    version: str
    digest: str
    filled: int


def read_if_there(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of driver rows as a local relation; no Python worker is started for them."""
    names, types = zip(*(field.split() for field in schema.split(",")))
    columns = list(zip(*rows)) or [()] * len(names)
    arrow = pa.table([pa.array(values, ARROW_TYPES[t]) for t, values in zip(types, columns)], names=list(names))
    return spark.createDataFrame(arrow, schema)


def save_bucketed(df: DataFrame, table: str, path: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Keep a current table bucketed and sorted by its key, in the session's catalog.

    A merge on that key then shuffles the dump only. Worth it where the current table is large and the
    catalog outlives the session; ``buckets`` should be the number of shuffle partitions of the merge.
    """
    (
        df.repartition(buckets, *key).write.mode("overwrite").option("path", path)
        .bucketBy(buckets, *key).sortBy(*key).saveAsTable(table)
    )
    return df.sparkSession.table(table)


class TableFolder:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def new_version(self, run_key: str) -> str:
        return f"{run_key}-{uuid.uuid4().hex[:12]}"

    def path(self, table: str, version: str) -> str:
        return f"{self.root}/{table}/version={version}"

    def write(
        self, table: str, version: str, df: DataFrame, partition_by: Sequence[str] = (), options: Mapping[str, object] | None = None
    ) -> DataFrame:
        """Write one version and return it read back, so that later steps do not compute it again."""
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**(options or {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(table, version))
        return self.read(table, version, df.schema)

    def read(self, table: str, version: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(table, version))

    def publish(self, versions: Mapping[str, str], run_key: str) -> None:
        """Make versions (by table) current, all with one append."""
        if not versions:
            return
        now = datetime.now(timezone.utc)
        rows = [(table, version, run_key, now) for table, version in versions.items()]
        small_table(self.spark, rows, PUBLICATION_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.root}/publications"
        )

    def publications(self) -> DataFrame | None:
        return read_if_there(self.spark, f"{self.root}/publications", PUBLICATION_SCHEMA)

    def current_versions(self) -> dict[str, str]:
        """Current version by table: one short row per table."""
        log = self.publications()
        if log is None:
            return {}
        return {r[0]: r[1] for r in log.groupBy("table").agg(F.max_by("version", "published_at")).collect()}

    def current(
        self, table: str, schema: T.StructType | None = None, versions: Mapping[str, str] | None = None
    ) -> DataFrame | None:
        """The published rows, or None before the first load."""
        version = (self.current_versions() if versions is None else versions).get(table)
        if version is None:
            return None
        parts = self.parts(table, version)
        return self.read(table, version, schema) if parts is None else self.read_parts(table, version, schema, parts)

    # ---- tables in buckets, of which a version may take over those of an older one ----

    def write_parts(self, table: str, version: str, parts: Sequence[Part]) -> None:
        """Note in which version's folder each bucket of this version lies."""
        small_table(self.spark, [tuple(p) for p in parts], PART_SCHEMA).coalesce(1).write.mode("overwrite").parquet(self.path(f"{table}_parts", version))

    def parts(self, table: str, version: str) -> list[Part] | None:
        """One short entry per bucket; None for a table that is not in buckets."""
        found = read_if_there(self.spark, self.path(f"{table}_parts", version), PART_SCHEMA.replace(",", ", "))
        return None if found is None else [Part(*r) for r in found.collect()]

    def read_parts(self, table: str, version: str, schema: T.StructType, parts: Sequence[Part]) -> DataFrame:
        """Rows of the given buckets. What an older version's merge did is past: its rows are kept ones, its deleted rows are gone."""
        paths = [f"{self.path(table, p.version)}/bucket={p.bucket}" for p in parts if p.filled]
        if not paths:
            return self.spark.createDataFrame([], schema)
        placed = T.StructType([f for f in schema.fields if f.name not in ("version", "bucket")] + [T.StructField("version", T.StringType()), T.StructField("bucket", T.IntegerType())])
        df = self.spark.read.schema(placed).option("basePath", f"{self.root}/{table}").parquet(*paths)
        own = F.col("version") == version
        df = df.filter(own | (F.col("op") != "delete")).withColumn("op", F.when(own, F.col("op")).otherwise("keep"))
        return df.select(*[f.name for f in schema.fields])


def replace_partitions(df: DataFrame, path: str, by: str = "run_key") -> None:
    """Idempotent reload: only the partitions that occur in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
