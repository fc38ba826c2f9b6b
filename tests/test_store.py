"""The commit log of stored points: clashes, merging in place, retention in place, redelivery; even replay chunks."""

import os
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.sinks import points, storelog
from millrace.sinks.points import merge_small_writes, read_points, retain_in_place, stored_points, write_points, writes
from millrace.sinks.storelog import StoreLog, Write
from millrace.streaming.run import write_replay

DAY = datetime(2024, 3, 1)
SCHEMA = "id string, ts timestamp_ntz, a double, b double"


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def one(spark, path, number, writer="w", name="x", a=None, b=None, ts=DAY):
    write_points(rows_of(spark, (name, ts, a, b)), path, "ts", number, F.lit(0), writer=writer)


def current(spark, path):
    return {r["id"]: (r["a"], r["b"]) for r in read_points(spark, path, ["id"], ["a", "b"]).collect()}


def folders(path):
    return {os.path.join(root, d) for root, names, _ in os.walk(path) for d in names if d.startswith("ingest_attempt=")}


def test_a_taken_version_is_tried_again(spark, tmp_path, monkeypatch):
    """Both writers read version 1; the second must not get the number the first has published."""
    path = str(tmp_path / "s")
    one(spark, path, 0)
    stale = StoreLog(spark, path).read()
    slow = StoreLog(spark, path)
    first = StoreLog(spark, path).begin("fast", 0)
    reads = iter([stale])
    honest = slow.read
    monkeypatch.setattr(slow, "read", lambda: next(reads, None) or honest())
    second = slow.begin("slow", 0)
    assert first != second
    assert set(StoreLog(spark, path).read().pending) == {first, second}
    assert not StoreLog(spark, path)._publish(stale)  # the number is taken


def test_writers_at_once_share_no_number(spark, tmp_path):
    path, failed = str(tmp_path / "s"), []

    def run(writer):
        try:
            for number in range(5):
                one(spark, path, number, writer, f"{writer}-{number}", a=float(number))
        except BaseException as error:
            failed.append(error)

    threads = [threading.Thread(target=run, args=(f"w{n}",)) for n in range(3)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failed
    found = writes(spark, path)
    assert len(found) == 15 and len({w.sequence for w in found}) == 15
    assert len(current(spark, path)) == 15
    assert StoreLog(spark, path).read().pending == {}


def test_many_small_writes_leave_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(points, "FANOUT", 3)
    monkeypatch.setattr(storelog, "GRACE", 0.0)
    monkeypatch.setattr(storelog, "KEPT_VERSIONS", 3)
    path, expected = str(tmp_path / "s"), {}
    for number in range(30):
        name, a, b = f"p{number % 4}", (float(number) if number % 3 else None), (float(-number) if number % 5 == 0 else None)
        one(spark, path, number, name=name, a=a, b=b)
        before = expected.get(name, (None, None))
        expected[name] = (before[0] if a is None else a, before[1] if b is None else b)
        merge_small_writes(spark, path, "ts", ["id"], ["ts", "a", "b"])
        assert len(writes(spark, path)) <= 2 * 4
    assert current(spark, path) == expected
    StoreLog(spark, path).change(lambda m: m)  # what the last merge replaced goes with the next version
    assert folders(path) == {w.path for w in writes(spark, path)}
    assert len([n for n in os.listdir(os.path.join(path, "_log")) if n.endswith(".json")]) <= 4
    assert max(w.level for w in writes(spark, path)) >= 2


def test_replaced_folders_stay_for_readers_of_the_version_before(spark, tmp_path):
    path = str(tmp_path / "s")
    one(spark, path, 0, a=1.0)
    reader = stored_points(spark, path)
    one(spark, path, 0, a=2.0)
    assert [r["a"] for r in reader.collect()] == [1.0]
    assert current(spark, path) == {"x": (2.0, None)}


def test_a_write_under_way_holds_back_merging(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(points, "FANOUT", 3)
    path = str(tmp_path / "s")
    one(spark, path, 0, a=0.0)
    log = StoreLog(spark, path)
    sequence = log.begin("slow", 0)
    for number in range(1, 6):
        one(spark, path, number, a=float(number))
    assert merge_small_writes(spark, path, "ts", ["id"], ["ts", "a", "b"]) == 0
    slow = points._store(rows_of(spark, ("x", DAY, 99.0, 99.0)), path, "ts", F.lit(0), "day",
                         Write("slow", 0, sequence, points._attempt(), ""))
    log.end(slow)
    assert current(spark, path) == {"x": (5.0, 99.0)}  # it came second, though it ended last
    assert merge_small_writes(spark, path, "ts", ["id"], ["ts", "a", "b"]) >= 2
    assert current(spark, path) == {"x": (5.0, 99.0)}


def test_a_failed_write_gives_its_place_up_and_an_abandoned_one_expires(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    one(spark, path, 0, a=1.0)
    broken = rows_of(spark, ("x", DAY, 1.0, 1.0)).withColumn("a", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        write_points(broken, path, "ts", 1, F.lit(0), writer="w")
    assert StoreLog(spark, path).read().pending == {}
    StoreLog(spark, path).begin("dead", 0)
    monkeypatch.setattr(storelog, "ABANDONED", 0.0)
    one(spark, path, 2, a=2.0)
    assert StoreLog(spark, path).read().pending == {} and current(spark, path) == {"x": (2.0, None)}


def test_a_merged_batch_sent_again_keeps_its_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(points, "FANOUT", 3)
    path = str(tmp_path / "s")
    one(spark, path, 7, "stream", a=1.0)
    one(spark, path, 0, "other", a=2.0)
    one(spark, path, 1, "other", b=3.0)
    assert merge_small_writes(spark, path, "ts", ["id"], ["ts", "a", "b"]) == 1
    one(spark, path, 7, "stream", a=1.0)  # a stream that was stopped before it noted the batch as done
    assert current(spark, path) == {"x": (2.0, 3.0)}


def test_retention_in_place_drops_spans_and_keeps_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storelog, "GRACE", 0.0)
    path = str(tmp_path / "s")
    days = [DAY + timedelta(days=n) for n in range(6)]
    write_points(rows_of(spark, *[("x", d, 1.0, None) for d in days[:3]]), path, "ts", 0, F.lit(0))
    write_points(rows_of(spark, *[("x", d, 2.0, None) for d in days[1:]]), path, "ts", 1, F.lit(0))
    write_points(rows_of(spark, ("y", days[5], 3.0, None)), path, "ts", 2, F.lit(0))
    before = writes(spark, path)
    assert retain_in_place(spark, path, "ts", timedelta(days=1), days[5]) == 2
    after = writes(spark, path)
    assert [w.sequence for w in after] == [1, 2] and after[1] == before[2]
    assert sorted((r["id"], r["ts"], r["a"]) for r in stored_points(spark, path).collect()) == [
        ("x", days[4], 2.0), ("x", days[5], 2.0), ("y", days[5], 3.0)]
    assert retain_in_place(spark, path, "ts", timedelta(days=1), days[5]) == 0
    assert retain_in_place(spark, path, "ts", timedelta(0), days[5]) == 0
    StoreLog(spark, path).change(lambda m: m)
    assert folders(path) == {w.path for w in writes(spark, path)}


def test_a_merge_yields_to_a_write_that_replaced_its_input(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(points, "FANOUT", 2)
    path = str(tmp_path / "s")
    one(spark, path, 0, a=1.0)
    one(spark, path, 1, b=1.0)
    store = points._store

    def meanwhile(*args):
        if args[-1].writer == points.COMPACTION:
            monkeypatch.setattr(points, "_store", store)
            one(spark, path, 0, a=5.0)
        return store(*args)

    monkeypatch.setattr(points, "_store", meanwhile)
    assert merge_small_writes(spark, path, "ts", ["id"], ["ts", "a", "b"]) == 0
    assert current(spark, path) == {"x": (5.0, 1.0)}


def test_replay_chunks_hold_equal_shares(spark, tmp_path):
    """Nine rows of ten lie in one hour of a month; no chunk has more than twice an even share."""
    busy = spark.range(9000).select((F.lit(1704100000) + F.col("id") % 3600).alias("s"))
    rest = spark.range(1000).select((F.lit(1704000000) + F.col("id") * 2500).alias("s"))
    events = busy.unionByName(rest).select(F.timestamp_seconds("s").alias("ts"))
    path = str(tmp_path / "replay")
    write_replay(events, "ts", path, 8, 1)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high")).orderBy("low").collect()
    assert sum(r["n"] for r in files) == 10_000 and max(r["n"] for r in files) <= 2 * 10_000 / 8
    assert all(a["high"] < b["low"] for a, b in zip(files, files[1:]))
