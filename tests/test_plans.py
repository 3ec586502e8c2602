"""The physical plans: what reaches the scan, where rows are reduced, what is broadcast."""

import re
import time

import pytest
from compare import duck, spark_rows, sql_rows

from keyedflow.plans.oracle import ORACLE
from keyedflow.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
BATCH = [n for n in QUERIES if not re.search("stream|archive|replay|kv|namespaced|table|deleted|files|rejects|snapshot|stored|delete_then|late", n)]


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_in_the_hot_path(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert ("MapInPandas" in text) == (name == "each_word_count")
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", ["match_count", "profile_upsert_keep", "request_count", "key_count"])
def test_rows_are_reduced_before_the_only_shuffle(spark, name):
    text = plan(spark, name)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    below = text[text.index("Exchange hashpartitioning") :]
    assert "partial_" in below


def test_lines_are_split_once(spark):
    assert len(re.findall(r"split\(", plan(spark, "match_count"))) == 1


def test_range_scan_reaches_parquet(spark):
    text = plan(spark, "range_scan")
    pushed = re.search(r"PushedFilters: \[(.*?), ReadSchema: struct<(.*?)>", text)
    assert "GreaterThanOrEqual(o_orderdate" in pushed[1] and "LessThan(o_orderdate" in pushed[1]
    assert sorted(re.findall(r"(\w+):", pushed[2])) == ["o_orderdate", "o_orderkey", "o_orderpriority"]


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "counter_increment")
    assert re.search(r"ReadSchema: struct<user_id:bigint,event_type:string>", text)


def test_only_hot_keys_are_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(spark, "state_lookup")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") in (0, 2) and text.count("SortMergeJoin") == 1


def test_versions_of_cells_are_not_doubled(spark):
    text = plan(spark, "cell_lookup")
    assert not re.search(r"explode\(CASE WHEN \(ts#", text) and "LeftSemi" in text


def test_times_do_not_depend_on_the_zone_of_the_process(spark, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        con = duck(SF)
        for name in ("rollup_retention", "rollup_stream", "range_scan"):
            assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(con, ORACLE[name])
    finally:
        monkeypatch.undo()
        time.tzset()


def test_cells_are_looked_up_once(spark):
    """Newest and exact versions meet the requests in one join, whose hot keys are found in one pass."""
    text = plan(spark, "cell_lookup")
    assert len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join \[row_key.*LeftOuter", text)) == 1
    assert len(set(re.findall(r"Scan ExistingRDD\[_hash#\d+L?,_salts#\d+\]", text))) <= 2
