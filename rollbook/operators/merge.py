"""Three-way comparison of a full dump with the current table, and the replace policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.keys import differs, key_present

# What the merge did to a row. DELETE rows are kept in the output for counting and tracing.
INSERT, UPDATE, DELETE, KEEP = "insert", "update", "delete", "keep"


def stamp_literal(stamp: str | Column) -> Column:
    """One time for a whole load, so that repeating a query repeats its result."""
    return F.lit(stamp).cast("timestamp") if isinstance(stamp, str) else stamp


def three_way_merge(
    main: DataFrame, staging: DataFrame, key: Sequence[str], data: Sequence[str], run_key: str,
    stamp: str | Column,
) -> DataFrame:
    """Every row of either side with its ``op`` and its stamps, in one full outer join.

    Staging rows without a complete key are left out before the shuffle. Keys must be unique on both
    sides (see ``checks``). Inserted rows get all three stamps, updated rows ``run_key`` and
    ``updated_at``; kept and deleted rows keep what they had.
    """
    key = list(key)
    now = stamp_literal(stamp)
    s = staging.filter(key_present(key)).select(
        *key, F.struct(*data).alias("s")
    )
    m = main.select(
        *key, F.struct(*data).alias("m"), F.struct("run_key", "created_at", "updated_at").alias("stamps")
    )
    both = m.join(s, key, "full_outer")
    changed = differs([F.col(f"m.{c}") for c in data], [F.col(f"s.{c}") for c in data])
    op = (
        F.when(F.col("m").isNull(), INSERT)
        .when(F.col("s").isNull(), DELETE)
        .when(changed, UPDATE)
        .otherwise(KEEP)
    )
    tagged = both.withColumn("op", op)
    new_row, touched = F.col("op") == INSERT, F.col("op").isin(INSERT, UPDATE)
    return tagged.select(
        *key,
        *[F.when(F.col("s").isNull(), F.col(f"m.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in data],
        F.when(touched, F.lit(run_key)).otherwise(F.col("stamps.run_key")).alias("run_key"),
        F.when(new_row, now).otherwise(F.col("stamps.created_at")).alias("created_at"),
        F.when(touched, now).otherwise(F.col("stamps.updated_at")).alias("updated_at"),
        "op",
    )


def inserted_rows(main: DataFrame, staging: DataFrame, key: Sequence[str]) -> DataFrame:
    """Staging rows with a complete key that the current table does not have."""
    return staging.filter(key_present(key)).join(main.select(*key), list(key), "left_anti")


def deleted_rows(main: DataFrame, staging: DataFrame, key: Sequence[str]) -> DataFrame:
    """Current rows whose key the dump no longer has.

    Dump keys are made distinct first, which happens before the shuffle too: blank or repeated keys, however
    many, arrive as one row per task. Null keys match nothing and are left out.
    """
    return main.join(staging.select(*key).dropna().distinct(), list(key), "left_anti")


def updated_rows(main: DataFrame, staging: DataFrame, key: Sequence[str], data: Sequence[str]) -> DataFrame:
    """Staging rows that differ from the current row with the same key."""
    m = main.select(*key, F.struct(*data).alias("m"))
    s = staging.filter(key_present(key)).select(*key, F.struct(*data).alias("s"))
    changed = differs([F.col(f"m.{c}") for c in data], [F.col(f"s.{c}") for c in data])
    return m.join(s, list(key)).filter(changed).select(*key, "s.*")


def snapshot(merged: DataFrame) -> DataFrame:
    """The table after the merge."""
    return merged.filter(F.col("op") != DELETE).drop("op")


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated, deleted."""
    return merged.agg(
        F.count_if(F.col("op") == INSERT).alias("inserted"),
        F.count_if(F.col("op") == UPDATE).alias("updated"),
        F.count_if(F.col("op") == DELETE).alias("deleted"),
    )


def replace_all(
    staging: DataFrame, columns: Sequence[str], run_key: str, stamp: str | Column, id_column: str | None = None
) -> DataFrame:
    """The dump as the new table, all rows, with an optional surrogate id that only has to be unique."""
    now = stamp_literal(stamp)
    head = [F.monotonically_increasing_id().alias(id_column)] if id_column else []
    return staging.select(
        *head, *columns, F.lit(run_key).alias("run_key"), now.alias("created_at"), now.alias("updated_at")
    )


def replace_key_present(
    staging: DataFrame, key: Sequence[str], columns: Sequence[str], run_key: str, stamp: str | Column
) -> DataFrame:
    """The dump's rows with a complete key as the new table. No creation time: every load is new."""
    return staging.filter(key_present(key)).select(
        *columns, F.lit(run_key).alias("run_key"), stamp_literal(stamp).alias("updated_at")
    )


def replace_lookup(staging: DataFrame, columns: Sequence[str] = ("codigo", "descricao")) -> DataFrame:
    """A code table is taken over as it is."""
    return staging.select(*columns)
