"""Merging only the buckets that a dump changes."""

import os

import pytest

from rollbook.operators import buckets as B
from rollbook.operators import merge
from rollbook.plans import monthly
from rollbook.sources.registry import EMPRESAS
from rollbook.sources.tables import TableFolder
from tests.helpers import rows

COLUMNS = ", ".join(f"{c} string" for c in EMPRESAS.columns)


def company(k, name=None, size="01"):
    return (f"{k:08d}", name or f"NAME {k}", "2062", "49", "1,00", size, None)


def load(spark, folder, run_key, companies):
    options = monthly.Options(run_key, f"{run_key}-01 00:00:00", layouts={EMPRESAS.name: EMPRESAS}, min_ratio=0.1)
    staging = spark.createDataFrame(companies, COLUMNS)
    versions = folder.current_versions()
    version, counts = monthly.load_table(folder, EMPRESAS, staging, options, versions)
    folder.publish({EMPRESAS.name: version}, run_key)
    return version, counts[1:]


def test_buckets_that_did_not_change_are_not_written(spark, tmp_path):
    folder = TableFolder(spark, str(tmp_path))
    first = [company(k) for k in range(1, 400)]
    v1, counts = load(spark, folder, "2026-01", first)
    assert counts == (399, 0, 0)
    changed = [company(k, "OTHER") if k == 7 else company(k) for k in range(1, 401) if k != 9]
    v2, counts = load(spark, folder, "2026-02", changed)
    assert counts == (1, 1, 1)
    parts = folder.parts(EMPRESAS.name, v2)
    touched = {r[0] for r in spark.createDataFrame([company(k) for k in (7, 9, 400)], COLUMNS).select(B.bucket_of(EMPRESAS.key)).collect()}
    assert {p.bucket for p in parts if p.version == v2} == touched and {p.version for p in parts if p.bucket not in touched} == {v1}
    assert {f for f in os.listdir(folder.path(EMPRESAS.name, v2)) if f.startswith("bucket=")} == {f"bucket={b}" for b in touched}
    # a third load over parts of two versions: same rows and stamps as one full merge
    v3, counts = load(spark, folder, "2026-03", [*changed, company(9), company(500)])
    assert counts == (2, 0, 0)
    current = monthly.current_rows(folder, EMPRESAS)
    assert current.count() == 401 and current.filter("run_key = '2026-01'").count() == 397
    assert {r["cnpj_basico"] for r in current.filter("run_key <> '2026-01'").collect()} == {f"{k:08d}" for k in (7, 400, 9, 500)}
    ops = folder.current(EMPRESAS.name, monthly.current_schema(EMPRESAS)).groupBy("op").count()
    assert rows(ops) == {("insert", 2), ("keep", 399)}


def test_a_repeated_dump_writes_no_bucket(spark, tmp_path):
    folder = TableFolder(spark, str(tmp_path))
    load(spark, folder, "2026-01", [company(k) for k in range(1, 50)])
    v2, counts = load(spark, folder, "2026-02", [company(k) for k in range(49, 0, -1)])
    assert counts == (0, 0, 0) and {p.version for p in folder.parts(EMPRESAS.name, v2)}.isdisjoint({v2})
    assert monthly.current_rows(folder, EMPRESAS).count() == 49


def test_a_table_without_buckets_is_taken_over(spark, tmp_path):
    folder = TableFolder(spark, str(tmp_path))
    old = spark.createDataFrame([company(k) for k in range(1, 30)], COLUMNS)
    written = merge.three_way_merge(spark.createDataFrame([], monthly.current_schema(EMPRESAS)), old, EMPRESAS.key, EMPRESAS.data_columns, "2025-12", "2025-12-01")
    folder.write(EMPRESAS.name, "old", written, ["op"])
    folder.publish({EMPRESAS.name: "old"}, "2025-12")
    _, counts = load(spark, folder, "2026-01", [company(k) for k in range(2, 31)])
    assert counts == (1, 0, 1) and monthly.current_rows(folder, EMPRESAS).filter("run_key = '2025-12'").count() == 28


@pytest.mark.parametrize("other", [[("a", None, "b")], [("a", "b", None)], [("a", "", "b")], [("ab", None, "b")], [("a", "x", "y"), ("a", "x", "y")]])
def test_digests_tell_rows_apart(spark, other):
    def digest(values):
        found = B.bucket_digests(spark.createDataFrame(values, "k string, v string, w string"), ["k"], ["v", "w"], 1).collect()
        return found[0]["digest"]

    assert digest([("a", "x", "y")]) != digest(other)
    assert digest([("a", "x", "y"), ("b", None, "z")]) == digest([("b", None, "z"), ("a", "x", "y")])
