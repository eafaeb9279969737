"""Cell cleaning, row acceptance, and the counters and reports that go with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.text import NULL_SENTINELS, is_present, null_if_marker, strip_whitespace
from rollbook.sources.registry import Layout

# Row states after cleaning.
KEPT, EMPTY, MISSING_REQUIRED = "kept", "empty", "missing_required"


def clean_cells(
    df: DataFrame, columns: Sequence[str] | None = None, null_exempt_columns: Sequence[str] = ()
) -> DataFrame:
    """Strip every cell and turn "no value" markers into nulls.

    The markers apply to every column, key columns too. Columns in ``null_exempt_columns`` keep them.
    """
    columns = set(df.columns if columns is None else columns)
    exempt = set(null_exempt_columns)
    # Two steps, so that a cell is stripped once although the second step looks at it twice.
    stripped = df.select(*[strip_whitespace(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])
    return stripped.select(
        *[
            null_if_marker(F.col(c), () if c in exempt else NULL_SENTINELS).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def row_state(columns: Sequence[str], required: Sequence[str]) -> Column:
    """State of a cleaned row; emptiness is looked at first."""
    state = F.when(F.coalesce(*[F.col(c) for c in columns]).isNull(), EMPTY)
    for name in required:
        state = state.when(F.col(name).isNull(), MISSING_REQUIRED)
    return state.otherwise(KEPT)


def classify_rows(df: DataFrame, columns: Sequence[str], required: Sequence[str]) -> DataFrame:
    return df.withColumn("row_state", row_state(columns, required))


def drop_empty(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = df.columns if columns is None else columns
    return df.filter(F.coalesce(*[F.col(c) for c in columns]).isNotNull())


def drop_missing_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    for name in required:
        df = df.filter(F.col(name).isNotNull())
    return df


def clean_table(df: DataFrame, layout: Layout, null_exempt_columns: Sequence[str] = ()) -> DataFrame:
    """Cleaned rows of a source table that are neither empty nor without their key."""
    cleaned = clean_cells(df, layout.columns, null_exempt_columns)
    return drop_missing_required(drop_empty(cleaned, layout.columns), layout.required)


def clean_metrics(classified: DataFrame, *by: str) -> DataFrame:
    """Rows kept, skipped as empty, skipped for a missing required field; one pass, partial sums first."""
    return classified.groupBy(*by).agg(
        F.count_if(F.col("row_state") == KEPT).alias("rows"),
        F.count_if(F.col("row_state") == EMPTY).alias("skipped_empty"),
        F.count_if(F.col("row_state") == MISSING_REQUIRED).alias("skipped_invalid_required"),
    )


def blank_key_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose key column is null or blank."""
    return df.filter(~is_present(F.col(column)))


def blank_key_count(df: DataFrame, column: str) -> DataFrame:
    """One row: how many such rows there are."""
    return blank_key_rows(df, column).agg(F.count("*").alias("bad_rows"))


def blank_key_samples(df: DataFrame, column: str, order_by: Sequence[str], samples: int = 5) -> DataFrame:
    """The first few of them, in an order that repeats."""
    return blank_key_rows(df, column).orderBy(*order_by).limit(samples)


def overlength(df: DataFrame, lengths: dict[str, int], key: Sequence[str] = ()) -> DataFrame:
    """One row per value longer than its declared length."""
    checks = F.array_compact(
        F.array(
            *[
                F.when(
                    F.length(c) > limit,
                    F.struct(F.lit(c).alias("field"), F.col(c).alias("value"), F.lit(limit).alias("max_length")),
                )
                for c, limit in lengths.items()
            ]
        )
    )
    return df.select(*key, F.explode(checks).alias("bad")).select(
        *key, "bad.field", "bad.value", F.length("bad.value").alias("length"), "bad.max_length"
    )
