"""Every registered query against its SQL oracle, and what their plans may contain."""

import re

import pytest

import __spark_entry__ as contract
from helpers import SF
from oracle_check import connect, differences
from tidegauge.plans.oracles import all_oracles
from tidegauge.plans.queries import REGISTRY

QUERIES = dict(REGISTRY)
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def database():
    con = connect(SF)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, database, name):
    df = QUERIES[name](spark, SF)
    assert differences(df, database, ORACLES[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "SinglePartition"):
        if forbidden == "SinglePartition" and name in ONE_ROW | GLOBAL_ORDER:
            continue
        assert forbidden not in plan, forbidden


# One result row in total, from partial aggregates.
ONE_ROW = {"bad_record_counts", "delay_summary_tolerant", "offset_range_scan"}
# One order over all rows; only block totals meet in one partition.
GLOBAL_ORDER = {"sequential_ids"}


@pytest.mark.parametrize(
    "name, columns",
    [
        ("route_counts", "event_type,props,user_id"),
        ("batch_word_count", "text"),
        ("block_floor_window", "event_id,ts"),
        ("sequential_ids", "event_id"),
        ("copy_lines", "props"),
    ],
)
def test_scans_read_needed_columns_only(spark, name, columns):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for schema in schemas:
        read = {part.split(":")[0] for part in schema.split(",")}
        assert read == set(columns.split(",")), schema


def test_purchase_filter_reaches_the_scan(spark):
    plan = QUERIES["store_lookup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan


def test_offset_range_reaches_the_scan(spark):
    plan = QUERIES["offset_range_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"GreaterThanOrEqual\(off,", plan)
    assert re.search(r"LessThanOrEqual\(off,", plan)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["start_time", "end_time", "type", "count"] and df.count() > 0
