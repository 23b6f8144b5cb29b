"""Shapes of physical plans on the generated tables."""

import os

import pytest

from ambertill.registered import QUERIES
from conftest import plan_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")


@pytest.fixture
def plain_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(spark, name):
    return plan_of(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize(
    "name",
    ["longest_order_gap", "insert_not_exists", "key_resolution", "asof_price_events", "delete_by_semi", "row_filter_complement", "top5_parts_with_ties"],
)
def test_no_nested_loops(spark, plain_joins, name):
    text = plan(spark, name)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["topn_customers_per_channel", "cohort_top300_all_years", "insert_ignore", "distinct_on_customer"])
def test_groups_are_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize(
    "name, column",
    [("channel_share_yoy", "o_orderdate"), ("quarter_crosstab", "l_shipdate"), ("revenue_by_type_quarter", "l_shipdate"), ("customer_balances", "o_orderdate")],
)
def test_date_ranges_reach_the_scan(spark, name, column):
    text = plan(spark, name)
    assert f"LessThan({column}" in text or f"LessThanOrEqual({column}" in text


@pytest.mark.parametrize("name, columns", [("fk_orphans", "user_id"), ("key_duplicates", "l_orderkey:bigint,l_linenumber:int")])
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}" in plan(spark, name)
