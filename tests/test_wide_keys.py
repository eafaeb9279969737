"""Queries whose branch numbers outgrow the published four digits, as those of over a million orders do."""

import os

import duckdb
import pytest

from check_oracle import TABLES, compare, connect
from rollbook.operators import search as S


@pytest.fixture(scope="module")
def wide_dir(sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("wide")
    for name in set(TABLES) - {"orders"}:
        os.symlink(f"{sf_dir}/{name}.parquet", folder / f"{name}.parquet")
    duckdb.sql(f"COPY (SELECT * REPLACE (o_orderkey + 1500000 AS o_orderkey) FROM '{sf_dir}/orders.parquet') TO '{folder}/orders.parquet'")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["lookup_full", "merge_changed_buckets", "monthly_load", "monthly_load_events", "served_lookup_full", "stream_merge", "unknown_table", "bulk_lookup", "served_branches"],
)
def test_query_equals_sql(spark, wide_dir, name):
    good, text = compare(spark, connect(wide_dir), wide_dir, name)
    assert good, text


def test_other_lengths_are_still_refused():
    assert S.parse_key("00.000.000/15000-00", 15) == "000000001500000"
    for key, length in (("00.000.000/15000-00", 14), ("00.000.000/1500-00", 15)):
        with pytest.raises(S.InvalidKey):
            S.parse_key(key, length)
