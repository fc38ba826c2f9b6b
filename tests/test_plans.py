"""What the physical plans must and must not contain."""

import pytest

from millrace.catalog import QUERIES
from millrace.plans.graphs import profile_plan
from millrace.session import scratch, settings, shared_root

DATA = "/root/testdata/sf0.001"
LAZY = [name for name, q in QUERIES.items() if q.subject != "streams"]
HEAVY = {"metrics_report_sink", "weather_ingest", "latest_log"}


def plan(spark, name):
    return profile_plan(QUERIES[name].run(spark, DATA), "simple")


@pytest.mark.parametrize("name", sorted(set(LAZY) - HEAVY))
def test_no_python_and_no_products(spark, name):
    text = plan(spark, name)
    for banned in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text


@pytest.mark.parametrize("name,column", [("time_range", "ts"), ("series_filter", "event_type"), ("retention", "ts")])
def test_filters_reach_the_scan(spark, name, column):
    text = profile_plan(QUERIES[name].run(spark, DATA))
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert f"({column}," in pushed


def test_anomaly_band_reaches_the_scan(spark):
    text = plan(spark, "two_sigma_anomalies")
    assert "GreaterThan(value," in text and "LessThan(value," in text and "Exchange" not in text


@pytest.mark.parametrize("name,columns", [
    ("sliding_mean", "struct<ts:timestamp_ntz,event_type:string,value:double>"),
    ("count_by_key", "struct<l_partkey:bigint>"),
    ("field_stats", "struct<event_type:string,value:double>"),
])
def test_scans_read_only_what_is_used(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan(spark, name)


@pytest.mark.parametrize("name", ["topk_indegree", "topk_indegree_zero", "first_n_in_order", "rank_rows"])
def test_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


@pytest.mark.parametrize("name", ["count_by_key", "node_union", "tumbling_sum", "merge_edges", "field_stats",
                                  "allocation_by_worker", "count_with_zero"])
def test_aggregates_reduce_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("HashAggregate") >= 2 and text.count("Exchange") == text.count("HashAggregate") // 2


def test_messages_are_parsed_once(spark):
    text = plan(spark, "json_strict_parse")
    assert text.count("parseJson") == 1


def test_scratch_paths_are_fresh_and_shared(spark):
    assert scratch(spark, "x") != scratch(spark, "x")
    assert scratch(spark, "x").startswith(shared_root(spark))


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with settings(spark, {"spark.sql.shuffle.partitions": "3", "millrace.none": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("millrace.none", None) is None
