"""Parsers and gates on hand-made records."""

import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.clock import iso_timestamp_utc, offset_timestamp_utc
from millrace.functions.text import finite_double, optional_text, required_text, strip, whole_number
from millrace.operators.contracts import (
    ContractError, count_report, counted, duplicates, expect_count, expect_unique, fail_fast, judge, reject_split,
)
from millrace.sinks.tables import quarantine_sink
from millrace.session import settings
from millrace.sources.files import (
    EDGE_HEADER, judge_edge_csv, judge_edge_lines, latest_file, parse_edges, position, read_csv_contract, read_edge_csv,
    read_edge_text, read_lines, with_position_number,
)
from millrace.sources.weather import HEADER, judge_weather, read_weather, read_weather_cells
from millrace.streaming.telemetry import judge_messages, parse_messages, telemetry_messages, telemetry_projection

EDGE_TEXT = "# comment\n\n   \n1\t2\n  3 4  \n5 6 7\n8\nx y\n9 9\n\t# c\n"
WEATHER_ROW = ["2006-04-01 00:00:00.000 +0200", "Partly Cloudy", "rain", "9.47", "7.38", "0.89", "14.1197", "251.0",
               "15.8263", "0.0", "1015.13", "Partly cloudy all day."]


def values(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, s string")
    return [row[0] for row in df.orderBy("n").select(expression(F.col("s"))).collect()]


def utc_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")


def test_finite_double(spark):
    texts = ["1.5", " -2 ", "\t3e2\n", "1_000.5", ".5", "7.", "nan", "Infinity", "-inf", "", "  ", "warm", "1d",
             "0x1p3", "1e999", None]
    assert values(spark, texts, finite_double) == [1.5, -2.0, 300.0, 1000.5, 0.5, 7.0] + [None] * 10


def test_text_rules(spark):
    assert values(spark, ["  a b\t", " \t\r\n", " 　x ", None], required_text) == ["a b", None, "x", None]
    assert values(spark, ["null", "", "  "], optional_text) == ["null", None, None]
    assert values(spark, [" \x0b y \x1f"], strip) == ["y"]
    assert values(spark, [" 12 ", "+5", "-7", "3.7", "x", "", "9223372036854775808"], whole_number) == \
        [12, 5, -7, None, None, None, None]


def test_offset_timestamps(spark):
    texts = ["2006-04-01 00:00:00.000 +0200", "2006-4-1 1:02:03.5 -0130", "2006-04-01 00:00:00.000 +02:00",
             "2006-04-01 00:00:00.000 Z", "2006-04-01 00:00:00 +0200", "2006-13-01 00:00:00.000 +0200", "soon"]
    assert values(spark, texts, lambda c: utc_text(offset_timestamp_utc(c))) == [
        "2006-03-31 22:00:00.000", "2006-04-01 02:32:03.500", "2006-03-31 22:00:00.000", "2006-04-01 00:00:00.000",
        None, None, None]


def test_iso_timestamps(spark):
    texts = ["2017-06-01T00:15:00.000", "2017-06-01T00:15:00Z", "2017-06-01T02:15:00+02:00", "2017-06-01T02:15:00+0200",
             "2017-06-01", "2017-06-01 00:15", "not a date", "2017", "2017-06-31T00:00:00", None]
    assert values(spark, texts, lambda c: utc_text(iso_timestamp_utc(c))) == [
        "2017-06-01 00:15:00.000"] * 4 + ["2017-06-01 00:00:00.000", "2017-06-01 00:15:00.000"] + [None] * 4


def test_traffic_rows(spark):
    rows = spark.createDataFrame([
        ("a", "2017-06-01T00:15:00.000", "6171", "12"),
        ("b", "2017-06-01T00:15:00Z", "6171", "12.9"),
        ("c", "2017-06-01T02:15:00+02:00", "6171", "-1.9"),
        ("d", "not a date", "6171", "3"),
        ("e", None, "6171", "3"),
        ("f", "2017-06-01T00:15:00", "6171", "x"),
        ("g", "2017-06-01T00:15:00", "6171", None),
        ("h", "2017-06-01T00:15:00", "6171", "nan"),
    ], "record_id string, read_date string, atd_device_id string, volume string")
    valid, rejected = reject_split(telemetry_projection(rows))
    got = valid.orderBy("record_id").select("sensor_id", "event_timestamp_ms", "vehicle_count").collect()
    assert [tuple(r) for r in got] == [("6171", 1496276100000, n) for n in (12, 12, -1)]
    assert {r["record_id"] for r in rejected.collect()} == set("defgh")
    message = telemetry_messages(valid.filter("record_id = 'a'")).first()
    assert tuple(message) == (
        "6171", '{"sensor_id":"6171","event_timestamp_ms":1496276100000,"vehicle_count":12}')


MESSAGES = {
    '{"sensor_id":6171,"vehicle_count":12,"event_timestamp_ms":1}': None,
    '{"sensor_id":" 7 ","vehicle_count":-3,"event_timestamp_ms":1,"other":[1]}': None,
    '{"sensor_id":true,"vehicle_count":0,"event_timestamp_ms":1}': None,
    '{"sensor_id":"6171","vehicle_count":12.0,"event_timestamp_ms":1}': "vehicle_count is not an integral number",
    '{"sensor_id":"6171","vehicle_count":"12","event_timestamp_ms":1}': "vehicle_count is not an integral number",
    '{"sensor_id":"6171","vehicle_count":1e3,"event_timestamp_ms":1}': "vehicle_count is not an integral number",
    '{"sensor_id":"6171","vehicle_count":12345678901234567890,"event_timestamp_ms":1}':
        "vehicle_count is not an integral number",
    '{"sensor_id":"6171","vehicle_count":1,"event_timestamp_ms":1.5}': "event_timestamp_ms is not an integral number",
    '{"sensor_id":"6171","vehicle_count":null,"event_timestamp_ms":1}': "vehicle_count is missing",
    '{"sensor_id":"6171","event_timestamp_ms":1}': "vehicle_count is missing",
    '{"vehicle_count":1,"event_timestamp_ms":1}': "sensor_id is missing",
    '{"sensor_id":{"x":1},"vehicle_count":1,"event_timestamp_ms":1}': "sensor_id is empty",
    '{"sensor_id":["x"],"vehicle_count":1,"event_timestamp_ms":1}': "sensor_id is empty",
    '{"sensor_id":"  ","vehicle_count":1,"event_timestamp_ms":1}': "sensor_id is empty",
    "[1]": "sensor_id is missing",
    "not json": "message is not JSON",
    "": "message is not JSON",
}


def test_strict_messages(spark):
    texts = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    judged = judge_messages(texts).collect()
    assert {r["value"]: r["reject_reason"] for r in judged} == MESSAGES
    kept = parse_messages(texts, mode="drop").collect()
    assert {(r["sensor_id"], r["vehicle_count"]) for r in kept} == {("6171", 12), ("7", -3), ("true", 0)}
    valid, rejected = reject_split(judge_messages(texts))
    assert valid.count() + rejected.count() == texts.count()


def test_strict_messages_fail_fast(spark):
    texts = spark.createDataFrame([("not json",)], "value string")
    with pytest.raises(Exception, match="message is not JSON"):
        parse_messages(texts).collect()


def test_edge_lines(spark, tmp_path):
    path = tmp_path / "edges.txt"
    path.write_text(EDGE_TEXT)
    edges = read_edge_text(spark, str(path))
    assert sorted(map(tuple, edges.collect())) == [(1, 2), (3, 4), (9, 9)]
    _, rejected = reject_split(judge_edge_lines(read_lines(spark, str(path))))
    got = rejected.orderBy("line_position").select("value", "reject_reason").collect()
    assert [r["value"] for r in got] == ["5 6 7", "8", "x y"]
    assert [r["reject_reason"] for r in got] == [
        "expected 2 fields, found 3", "expected 2 fields, found 1", "source is not an integer"]
    with pytest.raises(Exception, match="malformed edge '5 6 7'"):
        read_edge_text(spark, str(path), mode="fail").collect()
    with pytest.raises(ValueError):
        parse_edges(spark.read.text(str(path)), mode="guess")


def test_edge_csv(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text("source,target\n10,11\n10,11\na,1\n")
    assert sorted(map(tuple, read_edge_csv(spark, str(path)).collect())) == [(10, 11), (10, 11)]
    wrong = tmp_path / "wrong.csv"
    wrong.write_text("target,source\n10,11\n")
    with pytest.raises(Exception):
        read_edge_csv(spark, str(wrong)).collect()


def test_edge_csv_rejects_with_reason_and_position(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text("source,target\n1,2\nx,6\n7\n1,2,3\n4,y\n")
    kept, rejected = reject_split(judge_edge_csv(spark, str(path)))
    assert [(r["source"], r["destination"]) for r in kept.collect()] == [(1, 2)]
    assert sorted((r["source_text"], r["reject_reason"]) for r in rejected.collect()) == [
        ("1", "row does not match the header"), ("4", "target is not an integer"),
        ("7", "row does not match the header"), ("x", "source is not an integer")]
    with pytest.raises(Exception, match="malformed edge at .*edges.csv.*source is not an integer"):
        read_edge_csv(spark, str(path), mode="fail").collect()
    text = tmp_path / "edges.txt"
    text.write_text("1 2\nx y\n")
    with pytest.raises(Exception, match="malformed edge 'x y' at .*edges.txt"):
        read_edge_text(spark, str(text), mode="fail").collect()
    target = str(tmp_path / "quarantine")
    for _ in range(2):
        quarantine_sink(rejected, target, "edges")
    assert spark.read.json(target).count() == 4


@pytest.mark.parametrize("text", ["SOURCE,Target\n1,2\n", "source,other\n1,2\n", "source\n1\n", ""])
def test_header_is_exact_whatever_is_read(spark, tmp_path, text):
    path = tmp_path / "edges.csv"
    path.write_text(text)
    with pytest.raises(ContractError, match="expected the header"):
        read_csv_contract(spark, str(path), ("source", "target")).select("source")
    good = tmp_path / "good.csv.gz"
    good.write_bytes(gzip.compress("\ufeff\"source\",target\n1,2\n".encode()))
    assert read_csv_contract(spark, str(good), ("source", "target")).count() == 1


def weather_file(tmp_path, *rows, header=HEADER, bom=""):
    path = tmp_path / "weather.csv"
    lines = [",".join(header), *[",".join(row) for row in rows]]
    path.write_text(bom + "\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def changed(**cells):
    named = dict(zip(HEADER, WEATHER_ROW))
    named.update({k.replace("_", " "): v for k, v in cells.items()})
    return list(named.values())


def test_weather_points(spark, tmp_path):
    path = weather_file(tmp_path, WEATHER_ROW, changed(Precip_Type=""), changed(Precip_Type="null"), bom="﻿")
    points = read_weather(spark, path).orderBy("line_position").collect()
    assert [p["precip_type"] for p in points] == ["rain", None, "null"]
    first = points[0]
    assert (first["location"], first["temperature_c"], first["summary"]) == ("Szeged", 9.47, "Partly Cloudy")
    assert first["time"] == datetime.fromtimestamp(1143842400)


@pytest.mark.parametrize("cell", ["nan", "Infinity", "", "warm"])
def test_weather_numbers_are_strict(spark, tmp_path, cell):
    bad = list(WEATHER_ROW)
    bad[3] = cell
    path = weather_file(tmp_path, WEATHER_ROW, bad)
    valid, rejected = reject_split(judge_weather(read_weather_cells(spark, path)))
    assert valid.count() == 1
    assert [r["reject_reason"] for r in rejected.collect()] == ["Temperature (C) is not a finite number"]
    with pytest.raises(Exception, match=r"Temperature \(C\) is not a finite number"):
        read_weather(spark, path).collect()


def test_weather_shape(spark, tmp_path):
    short = weather_file(tmp_path, WEATHER_ROW[:-1])
    _, rejected = reject_split(judge_weather(read_weather_cells(spark, short)))
    assert [r["reject_reason"] for r in rejected.collect()] == ["row does not match the header"]
    blank = weather_file(tmp_path, changed(Summary="\t "))
    _, rejected = reject_split(judge_weather(read_weather_cells(spark, blank)))
    assert [r["reject_reason"] for r in rejected.collect()] == ["Summary is empty"]


@pytest.mark.parametrize("header", [
    ("When", *HEADER[1:]), (HEADER[1], HEADER[0], *HEADER[2:]),
])
def test_weather_header_must_match(spark, tmp_path, header):
    path = weather_file(tmp_path, WEATHER_ROW, header=header)
    with pytest.raises(Exception):
        read_csv_contract(spark, path, HEADER).collect()


def test_gates(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 9)
    assert expect_count(df, 10) == 10
    with pytest.raises(ContractError, match="found 10 rows; expected 11"):
        expect_count(df, 11)
    assert tuple(count_report(df, 11, "rows").first()) == ("rows", 10, 11, False)
    assert [tuple(r) for r in duplicates(df, ["k"]).collect()] == [(0, 2)]
    expect_unique(df, ["id"])
    with pytest.raises(ContractError, match="not unique"):
        expect_unique(df, ["k"])
    watched, seen = counted(df, "gate")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 10


def test_fail_fast_names_the_record(spark):
    judged = judge(spark.range(5), [(F.col("id") < 4, "too large")])
    with pytest.raises(Exception, match="4: too large"):
        fail_fast(judged, F.col("id")).collect()
    valid, rejected = reject_split(judged)
    assert (valid.count(), rejected.count()) == (4, 1)


def test_latest_file(spark, tmp_path):
    import os

    for number, name in enumerate(["a", "b", "c"]):
        (tmp_path / name).mkdir()
        file = tmp_path / name / "log"
        file.write_text("" if name == "c" else "x\n")
        os.utime(file, (1000 + number, 1000 + number))
    (tmp_path / ".hidden").write_text("x\n")
    assert latest_file(spark, str(tmp_path)).first()["path"].endswith("/b/log")


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    """Files are counted by their first line; plain, quoted and marked headers pass, a wrong or empty file is named."""
    good = ["source,target\n1,2\n", '"source","target"\n3,4\n', "\ufeffsource,target\n5,6\n", 'source,"target"\n7,8\n']
    for number in range(40):
        (tmp_path / f"part-{number:03d}.csv").write_text(good[number % 4])
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    rows = read_csv_contract(spark, str(tmp_path), EDGE_HEADER)
    assert len(tracker.getJobIdsForGroup(None)) - before <= 5
    assert rows.count() == 40
    (tmp_path / "part-017.csv").write_text("source,Target\n1,2\n")
    with pytest.raises(ContractError, match="part-017.csv has the header"):
        read_csv_contract(spark, str(tmp_path), EDGE_HEADER)
    (tmp_path / "part-017.csv").write_text("")
    with pytest.raises(ContractError, match="1 of 40 files .* are empty"):
        read_csv_contract(spark, str(tmp_path), EDGE_HEADER)


def test_position_numbers_sort_like_positions(spark, tmp_path):
    for number in range(12):
        (tmp_path / f"part-{number:03d}.csv").write_text("source,target\n" + "".join(f"{number},{k}\n" for k in range(3000)))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "8k"}):
        cells = read_csv_contract(spark, str(tmp_path), EDGE_HEADER).select("source", "target", position())
        numbered = with_position_number(cells, str(tmp_path)).select("source", "target", "line_position").collect()
    assert len(numbered) == 12 * 3000
    ordered = [(int(r["source"]), int(r["target"])) for r in sorted(numbered, key=lambda r: r["line_position"])]
    assert ordered == [(n, k) for n in range(12) for k in range(3000)]
    assert len({r["line_position"] for r in numbered}) == len(numbered)
