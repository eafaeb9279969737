import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rollbook.operators import checks, merge as M
from rollbook.sources.tables import save_bucketed
from tests.helpers import rows

KEY, DATA = ["k"], ["v", "w"]
MAIN = "k string, v string, w string, run_key string, created_at timestamp, updated_at timestamp"
OLD, NEW = datetime(2026, 2, 1), datetime(2026, 3, 1)


def main_table(spark, data):
    return spark.createDataFrame([(k, v, w, "2026-02", OLD, OLD) for k, v, w in data], MAIN)


def staged(spark, data):
    return spark.createDataFrame(data, "k string, v string, w string")


def merged(main, staging):
    return M.three_way_merge(main, staging, KEY, DATA, "2026-03", "2026-03-01 00:00:00")


def test_cases(spark):
    main = main_table(spark, [("k2", "a", None), ("k3", None, "z"), ("k4", None, None), ("k5", "a", "a")])
    staging = staged(
        spark, [("k1", "a", "b"), ("k2", "b", None), ("k3", None, "z"), ("k4", "x", None), ("  ", "a", "a"), (None, "a", "a")]
    )
    got = {r["k"]: (r["op"], r["v"], r["run_key"], r["created_at"], r["updated_at"]) for r in merged(main, staging).collect()}
    assert got == {
        "k1": ("insert", "a", "2026-03", NEW, NEW),
        "k2": ("update", "b", "2026-03", OLD, NEW),
        "k3": ("keep", None, "2026-02", OLD, OLD),
        "k4": ("update", "x", "2026-03", OLD, NEW),
        "k5": ("delete", "a", "2026-02", OLD, OLD),
    }
    assert rows(M.merge_counts(merged(main, staging))) == {(1, 2, 1)}
    assert rows(M.inserted_rows(main, staging, KEY), "k") == {("k1",)}
    assert rows(M.updated_rows(main, staging, KEY, DATA), "k") == {("k2",), ("k4",)}
    assert rows(M.deleted_rows(main, staging, KEY), "k") == {("k5",)}


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, seed):
    rng = random.Random(seed)

    def table(n):
        keys = rng.sample([f"k{i}" for i in range(80)], n)
        return [(k, rng.choice(["a", "b", None]), rng.choice(["x", None])) for k in keys]

    old, new = table(rng.randint(0, 60)), table(rng.randint(0, 60))
    main, staging = main_table(spark, old), staged(spark, new + [(None, "a", "a"), ("", "b", "b")])
    result = merged(main, staging)
    after = M.snapshot(result)
    assert rows(after, "k", "v", "w") == set(new)
    olds, news = {r[0]: r[1:] for r in old}, {r[0]: r[1:] for r in new}
    expected = (
        len(news.keys() - olds.keys()), sum(news[k] != olds[k] for k in news.keys() & olds.keys()),
        len(olds.keys() - news.keys()),
    )
    assert rows(M.merge_counts(result)) == {expected}
    again = M.three_way_merge(after, staging, KEY, DATA, "2026-04", "2026-04-01 00:00:00")
    assert rows(M.merge_counts(again)) == {(0, 0, 0)}
    assert rows(M.snapshot(again)) == rows(after)


def test_merge_is_one_join_with_one_shuffle_per_side(spark):
    main, staging = main_table(spark, [("a", "b", "c")]), staged(spark, [("a", "b", "c")])
    plan = merged(main, staging)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("FullOuter") == 1


def test_bucketed_table_is_not_shuffled(spark, tmp_path):
    main = main_table(spark, [(f"k{i}", "b", "c") for i in range(50)])
    bucketed = save_bucketed(main, "bucketed_main", str(tmp_path / "b"), KEY, 8)
    staging = staged(spark, [("k1", "b", "c"), ("x", "y", None)])
    result = merged(bucketed, staging)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert rows(M.merge_counts(result)) == {(1, 0, 49)}


@pytest.mark.parametrize(("main_n", "staging_n", "passes"), [(10, 5, True), (10, 4, False), (0, 0, True), (0, 3, True)])
def test_volume_guard(spark, main_n, staging_n, passes):
    main, staging = spark.range(main_n), spark.range(staging_n)
    assert checks.volume_guard(main, staging).first()["passed"] is passes
    if passes:
        checks.require_volume(main, staging, "t")
    else:
        with pytest.raises(checks.CheckFailed, match="nothing was changed"):
            checks.require_volume(main, staging, "t")


def test_staging_report(spark):
    staging = staged(spark, [("a", "x", None), ("a", "y", None), ("b", "long", None), ("  ", "", None), ("  ", "", None)])
    row = checks.staging_report(main_table(spark, [("a", "b", "c")]), staging, KEY, {"v": 3}).first()
    assert tuple(row) == (1, 5, 1, 1)
    assert tuple(checks.staging_report(None, staging, (), {"v": 3}).first()) == (0, 5, 0, 1)


def test_duplicates(spark):
    staging = staged(spark, [("k6", "b", "1"), ("k6", "a", None), ("k7", "a", None)])
    with pytest.raises(checks.CheckFailed, match="k6"):
        checks.require_unique(staging, KEY, "t")
    assert rows(checks.keep_first(staging, KEY, ["v"])) == {("k6", "a", None), ("k7", "a", None)}


def test_keep_first_on_one_heavy_key(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 977).cast("string").alias("v"), F.col("id").alias("w"),
    )
    got = checks.keep_first(df, ["k"], ["v", "w"])
    assert got.filter("k = 'hot'").collect()[0]["v"] == "0"
    assert got.count() == df.select("k").distinct().count()


def test_replace(spark):
    staging = staged(spark, [("a", "1", "2"), ("  ", "3", "4"), (None, "5", "6")])
    every = M.replace_all(staging, ["k", "v"], "2026-03", "2026-03-01 00:00:00", "id")
    assert every.count() == 3 and every.select("id").distinct().count() == 3
    assert every.columns == ["id", "k", "v", "run_key", "created_at", "updated_at"]
    present = M.replace_key_present(staging, ["k"], ["k", "v"], "2026-03", "2026-03-01 00:00:00")
    assert rows(present) == {("a", "1", "2026-03", NEW)}


def test_overlength_and_empty(spark):
    with pytest.raises(checks.CheckFailed, match="too long"):
        checks.require_lengths(staged(spark, [("abc", "x", None)]), {"k": 2}, "t")
    checks.require_lengths(staged(spark, [("ab", None, None)]), {"k": 2, "v": 1}, "t")
    with pytest.raises(checks.CheckFailed, match="empty"):
        checks.require_rows(staged(spark, []), "t")
