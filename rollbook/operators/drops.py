"""Rules about drops: which files, which month, whether anything changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.status import RETRYABLE, SUCCESS
from rollbook.functions.text import is_month_folder, month_in_name
from rollbook.sources.registry import WANTED_ARCHIVES


def wanted(name: Column, is_dir: Column, keywords: Sequence[str] = WANTED_ARCHIVES, match: str = "contains") -> Column:
    """A ZIP file, not a folder, whose name holds (or starts with) one of the keywords, in any case."""
    lower = F.lower(name)
    test = {"contains": lower.contains, "prefix": lower.startswith}[match]
    return ~is_dir & lower.endswith(".zip") & reduce(lambda a, b: a | b, [test(k.lower()) for k in keywords])


def wanted_files(files: DataFrame, keywords: Sequence[str] = WANTED_ARCHIVES, match: str = "contains") -> DataFrame:
    is_dir = F.coalesce(F.col("is_dir"), F.lit(False)) if "is_dir" in files.columns else F.lit(False)
    return files.filter(wanted(F.col("name"), is_dir, keywords, match))


def months(files: DataFrame) -> DataFrame:
    """Distinct months found in file names."""
    return files.select(month_in_name(F.col("name")).alias("month")).filter("month is not null").distinct()


def latest_month(files: DataFrame) -> DataFrame:
    """One row: the latest month in the names, or the current UTC month if there is none."""
    current = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM")
    return files.agg(F.coalesce(F.max(month_in_name(F.col("name"))), current).alias("run_key"))


def latest_month_folder(folders: DataFrame) -> DataFrame:
    """One row: the latest name that is exactly a month; null if there is none."""
    return folders.agg(F.max(F.when(is_month_folder(F.col("name")), F.col("name"))).alias("run_key"))


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Files added, removed or changed (other tag) between two listings; names are unique in each."""
    o = old.select("name", F.col("etag").alias("old_etag"), F.lit(True).alias("in_old"))
    n = new.select("name", F.col("etag").alias("new_etag"), F.lit(True).alias("in_new"))
    change = (
        F.when(F.col("in_old").isNull(), "added")
        .when(F.col("in_new").isNull(), "removed")
        .when(~F.col("old_etag").eqNullSafe(F.col("new_etag")), "changed")
    )
    return (
        o.join(n, "name", "full_outer")
        .select("name", change.alias("change"), "old_etag", "new_etag")
        .filter("change is not null")
    )


def files_changed(old: DataFrame | None, new: DataFrame) -> bool:
    """True without an earlier listing, or if the two differ."""
    return old is None or not manifest_diff(old, new).isEmpty()


# What is done about a drop that was listed.
LOAD, RESUME, DONE, UNCHANGED = "load", "resume", "done", "unchanged"


def load_decisions(old: DataFrame, new: DataFrame, runs: DataFrame) -> DataFrame:
    """Per listed run key: its files, how many of them changed since the last listing, and what to do.

    ``old`` and ``new`` are listings with ``run_key``, ``name`` and ``etag``, ``runs`` has one row per run key. A
    run key that succeeded is done. One that was never listed, differs from its last listing, or has no run (a process may die
    after it saved the listing), is loaded; the same files again are resumed while their run may start again.
    """
    o = old.select("run_key", "name", F.col("etag").alias("old_etag"), F.lit(True).alias("in_old"))
    n = new.select("run_key", "name", F.col("etag").alias("new_etag"), F.lit(True).alias("in_new"))
    same = F.col("in_old").isNotNull() & F.col("in_new").isNotNull() & F.col("old_etag").eqNullSafe(F.col("new_etag"))
    status = F.col("status")
    return (
        o.join(n, ["run_key", "name"], "full_outer").groupBy("run_key")
        .agg(F.count("in_new").alias("files"), F.count_if(~same).alias("changes"))
        .filter("files > 0")
        .join(runs.select("run_key", "status"), "run_key", "left")
        .select(
            "run_key", "files", "changes",
            F.when(status == SUCCESS, DONE).when((F.col("changes") > 0) | status.isNull(), LOAD).when(status.isin(*RETRYABLE), RESUME)
            .otherwise(UNCHANGED).alias("decision"),
        )
    )


def manifest_check(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Files of a drop that are ``missing``, ``extra`` or of another size than its listing says."""
    e = expected.select("name", F.col("size").alias("listed_size"), F.lit(True).alias("listed"))
    f = found.select("name", F.col("size").alias("found_size"), F.lit(True).alias("found"))
    problem = (
        F.when(F.col("found").isNull(), "missing").when(F.col("listed").isNull(), "extra")
        .when(~F.col("listed_size").eqNullSafe(F.col("found_size")), "size differs")
    )
    checked = e.join(f, "name", "full_outer").select("name", problem.alias("problem"), "listed_size", "found_size")
    return checked.filter("problem is not null")


def smallest_files(files: DataFrame, k: int) -> DataFrame:
    """The k smallest files (at least one) by size, then name."""
    return files.orderBy("size", "name").limit(max(1, k))
