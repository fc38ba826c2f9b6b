"""Lookup joins below and above the broadcast bound, with one key holding a third of the rows."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.anomalies import two_sigma_anomalies
from millrace.operators.joins import join_lookup
from millrace.plans.graphs import profile_plan


@pytest.fixture(scope="module")
def facts(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97)
    return spark.range(9000).select(key.alias("k"), "id")


@pytest.mark.parametrize("bound,operator", [(1000, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_lookup_join_is_whole_either_way(spark, facts, bound, operator):
    lookup = facts.groupBy("k").agg(F.max("id").alias("top"))
    with_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_lookup(facts, lookup, ["k"], broadcast_rows=bound)
        assert operator in profile_plan(joined, "simple")
        assert joined.count() == facts.count()
        assert joined.filter("id > top").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_threshold)


def test_left_lookup_keeps_unmatched(facts):
    lookup = facts.filter("k < 5").select("k").distinct().withColumn("hit", F.lit(1))
    joined = join_lookup(facts, lookup, ["k"], "left")
    assert joined.count() == facts.count()
    assert joined.filter("hit is null").count() == facts.filter("k >= 5").count()


def test_keyed_anomalies_with_a_hot_key(spark, facts):
    df = facts.withColumn("value", F.when(F.col("id") % 500 == 0, 1000.0).otherwise((F.col("id") % 7).cast("double")))
    got = {r["id"] for r in two_sigma_anomalies(df, "value", ["k"]).collect()}
    rows = {}
    for r in df.collect():
        rows.setdefault(r["k"], []).append((r["id"], r["value"]))
    expected = set()
    for group in rows.values():
        mean = sum(v for _, v in group) / len(group)
        deviation = (sum((v - mean) ** 2 for _, v in group) / len(group)) ** 0.5
        expected |= {i for i, v in group if v > mean + 2 * deviation or v < mean - 2 * deviation}
    assert got == expected
