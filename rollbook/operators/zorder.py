"""Rows arranged so that each of several code columns can be searched by file and row group statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Binary digits of a column's rank.
BITS = 10


def with_ranks(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``__rank_<column>``: the share of rows with smaller values, in 2 ** bits steps; nulls come first.

    Ranks by share, not by value, make cells of equal size from uneven codes. Columns are codes: their distinct values, one
    row each, are ordered in one task and joined back, by a broadcast where Spark finds them small enough.
    """
    for c in columns:
        known = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("__n"))
        before = F.coalesce(F.sum("__n").over(Window.orderBy(c).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        known = known.select(F.col(c).alias("__value"), before.alias("__before"), F.sum("__n").over(Window.partitionBy()).alias("__known"))
        step = F.floor(F.col("__before") * (1 << bits) / F.col("__known")).cast("long")
        known = known.select("__value", step.alias(f"__rank_{c}"))
        df = df.join(known, df[c] == known["__value"], "left").drop("__value").withColumn(f"__rank_{c}", F.coalesce(f"__rank_{c}", F.lit(0).cast("long")))
    return df


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The digits of all ranks by turns, the highest ones first."""
    n = len(ranks)
    digits = [F.shiftleft(F.shiftright(r, k).bitwiseAND(1), k * n + j) for j, r in enumerate(ranks) for k in range(bits)]
    return reduce(Column.bitwiseOR, digits)


def z_ordered(df: DataFrame, columns: Sequence[str], then: str, bits: int = BITS) -> DataFrame:
    """``df`` in ranges of the interleaved ranks of ``columns``, sorted within, ``then`` deciding between equals."""
    ranked = with_ranks(df, columns, bits)
    z = interleaved([F.col(f"__rank_{c}") for c in columns], bits)
    placed = ranked.withColumn("__z", z).repartitionByRange("__z", then).sortWithinPartitions("__z", then)
    return placed.select(*df.columns)
