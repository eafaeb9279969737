"""Keys and null-safe comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from rollbook.functions.text import is_present


def composite_key(*parts: str | Column) -> Column:
    """Parts joined without a separator; null if any part is null."""
    return F.concat(*parts)


def key_present(columns: Sequence[str]) -> Column:
    """True where no key column is null, empty or blank."""
    condition = is_present(F.col(columns[0]))
    for name in columns[1:]:
        condition = condition & is_present(F.col(name))
    return condition


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True where the two tuples differ; two nulls are equal, null and a value are not."""
    condition = F.lit(False)
    for a, b in zip(left, right, strict=True):
        condition = condition | ~a.eqNullSafe(b)
    return condition
