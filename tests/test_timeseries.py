"""Windows, anomalies, upserts and retention on small series, and their properties."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.operators.anomalies import two_sigma_anomalies
from millrace.operators.points import latest_point, relative_range, retain, time_range, unpivot_fields
from millrace.operators.ranking import first_n, sequence_within
from millrace.operators.windows import sliding_mean, tumbling, tumbling_mean
from millrace.plans.graphs import profile_plan
from millrace.plans.timeseries import KEEP, downsample_task, ingest_weather, measured_write, read_downsampled
from millrace.sinks.points import compact_points, read_points, write_points, writes
from millrace.sources.points import read_bucket
from test_contracts import WEATHER_ROW, changed, weather_file

HOUR, QUARTER = timedelta(hours=1), timedelta(minutes=15)
DAY = datetime(2024, 1, 1)


def series(spark, *points, extra=""):
    rows = [(DAY + timedelta(minutes=m), float(v)) for m, v in points]
    return spark.createDataFrame(rows, "ts timestamp_ntz, value double")


def test_sliding_mean_labels_and_panes(spark):
    means = sliding_mean(series(spark, (0, 10), (10, 30), (60, 40)), "ts", "value", [], QUARTER, HOUR)
    got = {r["window_end"] - DAY: (r["window_end"] - r["window_start"], r["value"]) for r in means.collect()}
    ends = {timedelta(minutes=15 * n): (HOUR, 20.0 if n <= 4 else 40.0) for n in range(1, 9)}
    assert got == ends


def test_sliding_mean_uneven_period_matches_brute_force(spark):
    points = [(n * 7 % 300, n) for n in range(40)]
    df = series(spark, *points)
    for every, period in ((timedelta(minutes=20), timedelta(minutes=50)), (QUARTER, HOUR)):
        got = {r["window_end"]: r["value"] for r in sliding_mean(df, "ts", "value", [], every, period).collect()}
        expected = {}
        for n in range(-10, 30):  # windows start on whole steps
            end = DAY + every * n + period
            inside = [v for m, v in points if end - period <= DAY + timedelta(minutes=m) < end]
            if inside:
                expected[end] = sum(inside) / len(inside)
        assert got == pytest.approx(expected)


def test_every_reading_is_in_four_windows(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", F.lit(1.0).alias("value"))
    windows = events.groupBy(F.window("ts", "1 hour", "15 minutes")).count()
    assert windows.agg(F.sum("count")).first()[0] == 4 * events.count()
    assert sliding_mean(events, "ts", "value", [], QUARTER, HOUR).count() == windows.count()


def test_tumbling_ignores_nulls_and_empty_windows(spark):
    df = series(spark, (0, 1), (59, 3), (180, 5)).union(
        spark.createDataFrame([(DAY + timedelta(minutes=61), None)], "ts timestamp_ntz, value double"))
    got = tumbling_mean(df, "ts", "value", [], HOUR).orderBy("window_end").collect()
    assert [(r["window_end"] - DAY, r["value"]) for r in got] == [(HOUR, 2.0), (4 * HOUR, 5.0)]


def test_means_leave_out_nan(spark):
    df = series(spark, (0, 1), (30, float("nan")), (59, 3))
    assert [r["value"] for r in tumbling_mean(df, "ts", "value", [], HOUR).collect()] == [2.0]
    assert {r["value"] for r in sliding_mean(df, "ts", "value", [], HOUR, HOUR).collect()} == {2.0}


def test_two_sigma_is_strict(spark):
    at_limit = spark.createDataFrame([(float(v),) for v in (0, 0, 0, 0, 10)], "value double")
    assert two_sigma_anomalies(at_limit, "value").count() == 0
    beyond = spark.createDataFrame([(float(v),) for v in (0, 0, 0, 0, 0, 12)], "value double")
    row = two_sigma_anomalies(beyond, "value").first()
    assert (row["value"], row["mean"]) == (12.0, 2.0)
    assert row["deviation"] == pytest.approx(4.47213595499958)


def test_two_sigma_leaves_out_nan_and_handles_empty(spark):
    df = spark.createDataFrame(
        [("a", float(v)) for v in (0, 0, 0, 0, 0, 12)] + [("a", float("nan")), ("b", 1.0)], "k string, value double")
    assert [r["value"] for r in two_sigma_anomalies(df, "value").collect()] == [12.0]
    assert [r["value"] for r in two_sigma_anomalies(df, "value", ["k"]).collect()] == [12.0]
    assert two_sigma_anomalies(df.filter("k = 'z'"), "value").count() == 0


def test_ranges(spark):
    df = series(spark, (0, 1), (30, 2), (60, 3))
    kept = time_range(df, "ts", DAY, DAY + HOUR)
    assert sorted(r["value"] for r in kept.collect()) == [1.0, 2.0]
    assert [r["value"] for r in relative_range(df, "ts", HOUR, DAY + 2 * HOUR).collect()] == [3.0]


def test_latest_point_per_field(spark):
    df = spark.createDataFrame([("k", 1, 2.0, "rain"), ("k", 2, 3.0, None)], "id string, seq int, a double, b string")
    assert tuple(latest_point(df, ["id"], ["a", "b"], ["seq"]).first()) == ("k", 3.0, "rain")


def test_retention_edges(spark):
    as_of = datetime(2024, 2, 1)
    cut = as_of - timedelta(hours=720)
    df = spark.createDataFrame(
        [(cut, 1), (cut - timedelta(microseconds=1), 2), (as_of, 3)], "ts timestamp_ntz, n int")
    assert sorted(r["n"] for r in retain(df, "ts", timedelta(hours=720), as_of).collect()) == [1, 3]
    assert retain(df, "ts", timedelta(0), as_of).count() == 3


def test_upserts_are_idempotent_and_compact(spark, tmp_path):
    path, kept = str(tmp_path / "points"), str(tmp_path / "kept")
    first = spark.createDataFrame(
        [("s", DAY, 1.0, "x"), ("s", DAY + HOUR, 5.0, None)], "id string, ts timestamp_ntz, a double, b string")
    second = spark.createDataFrame([("s", DAY, 2.0, None)], first.schema)
    write_points(first, path, "ts", 0, F.lit(0))
    for _ in range(2):
        write_points(second, path, "ts", 1, F.lit(0))
    current = read_points(spark, path, ["id", "ts"], ["a", "b"])
    expected = {("s", DAY, 2.0, "x"), ("s", DAY + HOUR, 5.0, None)}
    assert {tuple(r) for r in current.collect()} == expected
    compact_points(spark, path, kept, "ts", ["id", "ts"], ["a", "b"], timedelta(hours=1), DAY + 2 * HOUR)
    assert {tuple(r) for r in read_points(spark, kept, ["id", "ts"], ["a", "b"]).collect()} == {
        ("s", DAY + HOUR, 5.0, None)}


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_stored_series_prune_partitions(spark, tmp_path, grain):
    path = str(tmp_path / "bucket")
    rows = [(DAY + timedelta(days=40 * n), float(n)) for n in range(20)]
    write_points(spark.createDataFrame(rows, "ts timestamp_ntz, value double"), path, "ts", 0, F.lit(0), grain)
    start, stop = datetime(2024, 12, 15), datetime(2025, 3, 10)
    got = read_bucket(spark, path, "ts", start, stop)
    assert sorted(r["value"] for r in got.collect()) == [v for t, v in rows if start <= t < stop]
    plan = profile_plan(got)
    assert f"span_{grain}" in plan.split("PartitionFilters")[1].split("\n")[0]


def test_downsampling_again_adds_nothing(spark, tmp_path):
    target = str(tmp_path / "hourly")
    df = series(spark, (0, 1), (59, 3), (60, 7))
    for _ in range(2):
        downsample_task(df, "ts", "value", [], DAY + HOUR, target)
    downsample_task(df, "ts", "value", [], DAY + 2 * HOUR, target)
    stored = read_points(spark, target, ["window_end"], ["value"]).orderBy("window_end").collect()
    assert [r["value"] for r in stored] == [2.0, 7.0]


def test_downsampling_ticks_keep_apart(spark, tmp_path):
    target = str(tmp_path / "hourly")
    df = series(spark, (0, 1), (59, 3))
    downsample_task(df, "ts", "value", [], DAY + HOUR, target)
    with pytest.raises(ValueError, match="multiple"):
        downsample_task(df, "ts", "value", [], DAY + HOUR + timedelta(minutes=50), target)
    # Two instants that share a clock time in a zone with daylight saving.
    for hour in (2, 3):
        downsample_task(df, "ts", "value", [], datetime(2024, 3, 31, hour), target)
    assert {w.batch for w in writes(spark, target)} == {
        int(m.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000
        for m in (DAY + HOUR, datetime(2024, 3, 31, 2), datetime(2024, 3, 31, 3))}
    kept = read_downsampled(spark, target, [], DAY + timedelta(hours=721), KEEP)
    assert [r["value"] for r in kept.collect()] == [2.0]
    assert read_downsampled(spark, target, [], DAY + timedelta(hours=722), KEEP).count() == 0


def test_compacted_store_survives_other_writers(spark, tmp_path):
    path, kept = str(tmp_path / "points"), str(tmp_path / "kept")
    rows = spark.createDataFrame([("s", DAY, 1.0), ("t", DAY, 2.0)], "id string, ts timestamp_ntz, a double")
    write_points(rows, path, "ts", 0, F.lit(0))
    compact_points(spark, path, kept, "ts", ["id", "ts"], ["a"], timedelta(0), DAY)
    write_points(rows.filter("id = 's'").withColumn("a", F.lit(5.0)), kept, "ts", 0, F.col("ts"))
    write_points(rows.filter("id = 'z'"), kept, "ts", 1, F.lit(0))  # nothing to store
    got = {tuple(r) for r in read_points(spark, kept, ["id", "ts"], ["a"]).collect()}
    assert got == {("s", DAY, 5.0), ("t", DAY, 2.0)}
    with pytest.raises(TypeError, match="whole number"):
        write_points(rows, kept, "ts", 2, F.col("id"))


def test_failed_retry_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "points")
    rows = spark.createDataFrame([("s", DAY, 1.0)], "id string, ts timestamp_ntz, a double")
    write_points(rows, path, "ts", 0, F.lit(0))
    broken = rows.withColumn("a", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_points(broken, path, "ts", 0, F.lit(0))
    assert [r["a"] for r in read_points(spark, path, ["id", "ts"], ["a"]).collect()] == [1.0]


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_zoned_bounds_agree_on_plain_and_stored_series(spark, tmp_path, grain):
    path = str(tmp_path / "bucket")
    midnight = datetime(2024, 1, 1)
    rows = [(midnight + timedelta(minutes=m), m) for m in (-180, -60, -1, 0, 1, 60, 150)]
    plain = spark.createDataFrame(rows, "ts timestamp_ntz, n int")
    write_points(plain, path, "ts", 0, F.lit(0), grain)
    zone = timezone(timedelta(hours=2))
    for start, stop in ((midnight.replace(tzinfo=zone), (midnight + timedelta(hours=3)).replace(tzinfo=zone)),
                        (midnight - timedelta(hours=1), midnight + timedelta(hours=1)),
                        (midnight.replace(tzinfo=zone), None), (None, (midnight + timedelta(hours=3)).replace(tzinfo=zone))):
        expected = sorted(r["n"] for r in time_range(plain, "ts", start, stop).collect())
        assert 0 < len(expected) < len(rows)
        assert sorted(r["n"] for r in read_bucket(spark, path, "ts", start, stop).collect()) == expected
    cut = (midnight + timedelta(hours=2)).replace(tzinfo=zone)
    for df in (plain, read_bucket(spark, path, "ts")):
        assert sorted(r["n"] for r in retain(df, "ts", timedelta(hours=1), cut).collect()) == [-60, -1, 0, 1, 60, 150]


def test_fixed_width_points_need_no_sort(spark, tmp_path):
    path = str(tmp_path / "points")
    rows = spark.createDataFrame([("s", DAY, 1.0)], "id string, ts timestamp_ntz, a double")
    write_points(rows, path, "ts", 0, F.lit(0))
    plan = profile_plan(read_points(spark, path, ["id", "ts"], ["a"], optional=()))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_weather_ingest_overwrites_identical_points(spark, tmp_path):
    later = changed(Precip_Type="")
    later[3] = "11"
    path = weather_file(tmp_path, WEATHER_ROW, later)
    bucket = str(tmp_path / "bucket")
    for _ in range(2):
        report = ingest_weather(spark, path, bucket, 0, expected=2)
    assert report["rows"] == 2 and report["rows_per_second"] > 0
    points = read_points(spark, bucket, ["location", "time"], ["temperature_c", "precip_type"]).collect()
    assert [(p["temperature_c"], p["precip_type"]) for p in points] == [(11.0, "rain")]
    with pytest.raises(RuntimeError, match="expected 3"):
        ingest_weather(spark, path, bucket, 1, expected=3)


def test_measured_write_counts(spark, tmp_path):
    report = measured_write(spark.range(100), lambda df: df.write.parquet(str(tmp_path / "out")))
    assert report["rows"] == 100


def test_unpivot_drops_absent_fields(spark):
    df = spark.createDataFrame([("t", 1.0, None)], "tag string, a double, b double")
    assert [tuple(r) for r in unpivot_fields(df, ["tag"], ["a", "b"]).collect()] == [("t", "a", 1.0)]


def test_first_n_in_groups_equals_plain(spark, monkeypatch):
    from millrace.operators import ranking

    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5003).alias("v"))
    plain = [r["v"] for r in first_n(df, ["v"], 37).collect()]
    monkeypatch.setattr(ranking, "SINGLE_TASK_ROWS", 0)
    grouped = first_n(df, ["v"], 37)
    assert "WindowGroupLimit" in profile_plan(grouped)
    assert [r["v"] for r in grouped.collect()] == plain == sorted(r["v"] for r in df.collect())[:37]


def test_sequence_within_spans_chunks(spark):
    rows = [("hot", c, n) for c in range(5) for n in range(10)] + [("cold", 3, 1), ("cold", 1, 9)]
    df = spark.createDataFrame(rows, "k string, chunk int, n int")
    got = sequence_within(df, ["k"], ["chunk"], ["n"], "place").collect()
    for key in ("hot", "cold"):
        mine = sorted((r for r in got if r["k"] == key), key=lambda r: (r["chunk"], r["n"]))
        assert [r["place"] for r in mine] == list(range(1, len(mine) + 1))


def test_tumbling_totals_keep_every_row(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    total = tumbling(events, "ts", ["user_id"], QUARTER, F.count(F.lit(1)).alias("n")).agg(F.sum("n")).first()[0]
    assert total == events.count()
