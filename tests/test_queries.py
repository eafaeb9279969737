"""Every registered query against its SQL on the smallest data set."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect
from tests.helpers import plan_of


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, sf_dir, name):
    good, text = compare(spark, con, sf_dir, name)
    assert good, text


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert not entry(spark).isEmpty()


@pytest.mark.parametrize(
    "name", ["star_view", "merge_changes", "volume_guard", "bulk_lookup", "search_trigram", "health", "step_rollup_since_requeue"]
)
def test_no_pairwise_join(spark, sf_dir, name):
    plan = plan_of(queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_stages_read_only_what_they_need(spark, sf_dir):
    plan = plan_of(queries()["duplicate_keys"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
    assert "partial_count" in plan
