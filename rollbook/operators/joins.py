"""Joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Copies of a partner row in a salted join.
SALTS = 16


def join_unique(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner", salts: int = 1, merge: bool = False, hashed: bool = False) -> DataFrame:
    """Join many facts to a table that is unique on ``key`` (``how``: inner or left).

    Spark picks broadcast or sort-merge by size, and adaptive execution splits a key that is too frequent.
    It does not where an operator that needs the rows by the same key follows; ``salts`` above 1 is for those
    joins: facts of a key are dealt over that many tasks by their content, and ``dim`` is copied to each. A
    retried task deals alike. Which of the two is used depends on the caller, never on the data.

    ``merge`` is for a ``dim`` that grows with the facts: Spark knows its size from the bytes of its columns in the file, which may
    be a twentieth of what they take in memory, and would broadcast it through the driver. Salted copies, which it does
    not count at all, are always merged.

    ``hashed`` shuffles both sides and keeps a task's share of ``dim`` in a hash table: wide facts stream past it, so that no task sorts
    them, nor spills them, however many have one key. Such a key is split as in a merge. ``dim`` must be unique, and a share of it fit in a task.
    """
    if salts == 1:
        return facts.join(dim.hint("merge") if merge else dim.hint("shuffle_hash") if hashed else dim, key, how)
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    copies = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("__salt", salt).join(copies.hint("merge"), [key, "__salt"], how).drop("__salt")


def decode(df: DataFrame, code: str | Column, table: DataFrame, into: str) -> DataFrame:
    """Left join with a code table, adding its description as ``into``.

    No hint: Catalyst broadcasts the table while its size is below the threshold, and otherwise
    sort-merges, where adaptive execution splits a code that is too frequent.
    """
    code = F.col(code) if isinstance(code, str) else code
    side = table.select(F.col("codigo").alias("__code"), F.col("descricao").alias(into))
    return df.join(side, code == F.col("__code"), "left").drop("__code")
