"""Watermarks, late records and window totals on a stream cut into known micro-batches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.sinks.points import read_points, stored_points, write_points, writes
from millrace.streaming.run import drain, file_writer, late_rows, print_writer, replay, upsert_writer, write_replay
from millrace.streaming.telemetry import (
    parse_messages, read_stream_messages, window_result_json, window_totals, with_watermark,
)

# (sensor, count, epoch ms) per file; one file per micro-batch.
BATCHES = [
    [("A", 5, 0), ("A", 7, 899999), ("B", 1, 100)],
    [("A", 1, 909999)],
    [("A", 100, 899999)],
    [("A", 1, 910000)],
    [("A", 1000, 5), ("B", 2, 910001)],
    [("A", 5000, 6)],
    [("B", 3, 1810001)],
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("messages")
    for number, batch in enumerate(BATCHES):
        file = path / f"batch-{number}.txt"
        file.write_text("".join(
            json.dumps({"sensor_id": s, "vehicle_count": c, "event_timestamp_ms": m}) + "\n" for s, c, m in batch))
        os.utime(file, (1000 + 10 * number, 1000 + 10 * number))
    return str(path)


def totals(df):
    rows = df.select(
        "sensor_id", F.unix_millis("window_start"), F.unix_millis("window_end"), "vehicle_count_total").collect()
    return sorted(tuple(r) for r in rows)


def test_watermark_closes_windows_and_drops_late_rows(spark, folder, tmp_path):
    texts = read_stream_messages(spark, "text", {"maxFilesPerTrigger": "1"}, folder)
    stream = window_totals(with_watermark(parse_messages(texts)))
    query = drain(file_writer(stream, str(tmp_path / "out"), str(tmp_path / "state")), spark)
    assert totals(spark.read.parquet(str(tmp_path / "out"))) == [
        ("A", 0, 900000, 1112), ("A", 900000, 1800000, 2), ("B", 0, 900000, 1), ("B", 900000, 1800000, 2)]
    assert late_rows(query) == 1


def test_batch_twin_keeps_everything(spark, folder):
    got = totals(window_totals(parse_messages(spark.read.text(folder))))
    assert got == [("A", 0, 900000, 6112), ("A", 900000, 1800000, 2), ("B", 0, 900000, 1),
                   ("B", 900000, 1800000, 2), ("B", 1800000, 2700000, 3)]


def test_result_json(spark, folder):
    lines = window_result_json(window_totals(parse_messages(spark.read.text(folder)))).collect()
    assert '{"sensor_id":"A","window_start_ms":900000,"window_end_ms":1800000,"vehicle_count_total":2}' in {
        r["value"] for r in lines}


def test_console_sink_runs(spark, folder, tmp_path):
    texts = read_stream_messages(spark, "text", {}, folder)
    lines = window_result_json(window_totals(with_watermark(parse_messages(texts))))
    query = drain(print_writer(lines, str(tmp_path / "state")), spark)
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == sum(len(b) for b in BATCHES)


def test_malformed_message_stops_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.txt").write_text("not json\n")
    texts = read_stream_messages(spark, "text", {}, str(tmp_path / "in"))
    writer = file_writer(parse_messages(texts), str(tmp_path / "out"), str(tmp_path / "state"))
    with pytest.raises(Exception, match="message is not JSON"):
        drain(writer, spark)


def test_replay_is_ordered_and_whole(spark, tmp_path):
    path = str(tmp_path / "replay")
    df = spark.range(1000).select("id", F.timestamp_seconds(F.col("id") * 61).alias("ts"))
    write_replay(df, "ts", path, chunks=4, files=2)
    spans = []

    def look(batch, number):
        low, high, rows = batch.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
        spans.append((low, high, rows))

    stream = replay(spark, path, df.schema, 2)
    drain(stream.writeStream.foreachBatch(look).option("checkpointLocation", str(tmp_path / "state")), spark)
    spans = [s for s in spans if s[2]]
    assert sum(s[2] for s in spans) == 1000
    assert all(before[1] < after[0] for before, after in zip(spans, spans[1:]))


def test_redelivered_batches_replace_themselves(spark, folder, tmp_path):
    """The same checkpoint's batches replace themselves; a new checkpoint is another writer and erases nothing."""
    target = str(tmp_path / "points")
    every = sum(len(b) for b in BATCHES)
    for run in ("state-0", "state-1"):
        texts = read_stream_messages(spark, "text", {"maxFilesPerTrigger": "1"}, folder)
        messages = parse_messages(texts)
        drain(upsert_writer(messages, target, "event_time", F.col("event_time"), str(tmp_path / run)), spark)
    assert stored_points(spark, target).count() == 2 * every
    current = read_points(spark, target, ["sensor_id", "event_time"], ["vehicle_count"])
    assert current.count() == len({(s, m) for b in BATCHES for s, _, m in b})
    # What Spark does after a failure: the last batch once more under the same checkpoint.
    last = parse_messages(spark.read.text(f"{folder}/batch-6.txt"))
    name = writes(spark, target)[0].writer
    write_points(last, target, "event_time", 6, F.col("event_time"), writer=name)
    assert stored_points(spark, target).count() == 2 * every


def test_late_rows_of_very_many_batches(spark, tmp_path):
    """More micro-batches than Spark remembers reports of by default."""
    folder = tmp_path / "many"
    folder.mkdir()
    for number in range(130):
        file = folder / f"batch-{number:03}.txt"
        file.write_text(json.dumps({"sensor_id": "A", "vehicle_count": 1, "event_timestamp_ms":
                                    90_000_000 if number == 0 else 1}) + "\n")
        os.utime(file, (1000 + 10 * number, 1000 + 10 * number))
    texts = read_stream_messages(spark, "text", {"maxFilesPerTrigger": "1"}, str(folder))
    writer = file_writer(window_totals(with_watermark(parse_messages(texts))), str(tmp_path / "o"), str(tmp_path / "s"))
    # The watermark moves between micro-batches, so the first record behind it is still summed.
    assert late_rows(drain(writer, spark, state_partitions=1)) == 128
