"""Key buckets with digests that don't depend on the order of rows: which parts of a table a dump leaves as they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.keys import key_present

#: Buckets of a merged table. Another number makes every bucket a changed one, once.
BUCKETS = 64


def bucket_of(key: Sequence[str], buckets: int = BUCKETS) -> Column:
    """The bucket of a row. It follows the first key column: rows that change together lie together."""
    return F.pmod(F.xxhash64(F.col(key[0])), F.lit(buckets)).cast("int")


def row_digests(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two digests of a row's values. Null and empty differ; so do values that trade places."""
    absent = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(absent, *columns), F.xxhash64(F.lit("second"), *columns, absent)


def bucket_digests(df: DataFrame, key: Sequence[str], data: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, digest) of the rows with a complete key; sums, which combine before the shuffle."""
    one, two = row_digests([*key, *data])
    rows = df.filter(key_present(key)).select(bucket_of(key, buckets).alias("bucket"), one.alias("one"), two.alias("two"))
    summed = rows.groupBy("bucket").agg(
        F.count("*").alias("rows"), F.sum(F.col("one").cast("decimal(38,0)")).alias("one"), F.sum(F.col("two").cast("decimal(38,0)")).alias("two")
    )
    return summed.select("bucket", "rows", F.concat_ws("/", F.col("rows").cast("string"), F.col("one").cast("string"), F.col("two").cast("string")).alias("digest"))


def in_buckets(df: DataFrame, key: Sequence[str], wanted: Sequence[int], buckets: int = BUCKETS) -> DataFrame:
    """The rows of these buckets, and of no other."""
    return df if len(wanted) == buckets else df.filter(bucket_of(key, buckets).isin(list(wanted)))
