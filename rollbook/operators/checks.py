"""Checks that run before anything is published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rollbook.functions.keys import key_present
from rollbook.operators.cleaning import overlength


class CheckFailed(RuntimeError):
    """A load must not go on."""


# Fixed value: smallest allowed share of the current rows in a new drop.
MIN_RATIO = 0.5


def row_counts(main: DataFrame, staging: DataFrame) -> DataFrame:
    """One row with both counts. Only the two partial counts are brought together, no rows."""
    zero = F.lit(0).cast("bigint")
    m = main.agg(F.count("*").alias("main_rows")).withColumn("staging_rows", zero)
    s = staging.agg(F.count("*").alias("staging_rows")).withColumn("main_rows", zero)
    return m.unionByName(s).agg(F.sum("main_rows").alias("main_rows"), F.sum("staging_rows").alias("staging_rows"))


def volume_guard(main: DataFrame, staging: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """One row: both counts and whether the drop is large enough. All staging rows count."""
    ok = (F.col("main_rows") == 0) | (F.col("staging_rows") >= F.col("main_rows") * min_ratio)
    return row_counts(main, staging).withColumn("passed", ok)


def volume_failed(table: str, main_rows: int, staging_rows: int, min_ratio: float) -> CheckFailed:
    return CheckFailed(
        f"{table}: the drop has {staging_rows:,} rows, the current table {main_rows:,}; "
        f"less than {min_ratio:.0%} of it, nothing was changed"
    )


def require_volume(main: DataFrame, staging: DataFrame, table: str, min_ratio: float = MIN_RATIO) -> None:
    row = volume_guard(main, staging, min_ratio).first()
    if not row["passed"]:
        raise volume_failed(table, row["main_rows"], row["staging_rows"], min_ratio)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Rows are counted before the shuffle."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")


def require_unique(df: DataFrame, key: Sequence[str], table: str) -> None:
    found = duplicate_keys(df, key).limit(5).collect()
    if found:
        raise CheckFailed(f"{table}: duplicate key, e.g. {[tuple(r[c] for c in key) for r in found]}")


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order_by`` and then by the remaining columns.

    A minimum over structs is combined before the shuffle, so a key with very many copies sends one row
    per task; a row number would bring them all into one.
    """
    rest = [c for c in df.columns if c not in key]
    ordered = [*order_by, *[c for c in rest if c not in order_by]]
    ordered = [c for c in ordered if c not in key]
    if not ordered:
        return df.distinct()
    first = F.min(F.struct(*ordered)).alias("first")
    return df.groupBy(*key).agg(first).select(*key, *[F.col(f"first.{c}") for c in ordered]).select(*df.columns)


def require_lengths(df: DataFrame, lengths: dict[str, int], table: str) -> None:
    found = overlength(df, lengths).limit(5).collect()
    if found:
        raise CheckFailed(f"{table}: value too long, e.g. {[(r['field'], r['value']) for r in found]}")


def staging_report(
    main: DataFrame | None, staging: DataFrame, key: Sequence[str], lengths: dict[str, int]
) -> DataFrame:
    """One row from one pass: both row counts, keys with copies, rows with a value that is too long.

    Rows are counted per key before the shuffle; blank keys are counted but are no duplicates.
    """
    too_long = F.lit(False)
    for c, limit in lengths.items():
        too_long = too_long | F.coalesce(F.length(c) > limit, F.lit(False))
    none = F.lit(0).cast("bigint")
    if key:
        per_key = staging.groupBy(*key).agg(F.count("*").alias("n"), F.count_if(too_long).alias("long"))
        report = per_key.agg(
            F.coalesce(F.sum("n"), none).alias("staging_rows"),
            F.count_if((F.col("n") > 1) & key_present(key)).alias("duplicate_keys"),
            F.coalesce(F.sum("long"), none).alias("long_rows"),
        )
    else:
        report = staging.agg(
            F.count("*").alias("staging_rows"), none.alias("duplicate_keys"), F.count_if(too_long).alias("long_rows")
        )
    report = report.withColumn("main_rows", none)
    if main is not None:
        empty = [none.alias(c) for c in ("staging_rows", "duplicate_keys", "long_rows")]
        report = report.unionByName(main.agg(F.count("*").alias("main_rows")).select(*empty, "main_rows"))
    return report.agg(*[F.sum(c).alias(c) for c in ("main_rows", "staging_rows", "duplicate_keys", "long_rows")])


def too_small(main_rows: int, staging_rows: int, min_ratio: float = MIN_RATIO) -> bool:
    return main_rows > 0 and staging_rows < main_rows * min_ratio


def require_rows(df: DataFrame, table: str) -> None:
    if df.isEmpty():
        raise CheckFailed(f"{table} is empty")
