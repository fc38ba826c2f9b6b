"""Parsing and contract queries. Table columns are rendered as text, some cells malformed by rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clock import iso_timestamp_utc, offset_timestamp_utc
from ..functions.messages import compact_json
from ..functions.text import finite_double, optional_text, required_text
from ..operators.contracts import (
    count_report, duplicates, fail_fast, judge, reject_split, shape_report,
)
from ..operators.graph import point_lookup
from ..operators.ranking import first_n, in_order
from ..plans.timeseries import ingest_weather
from ..session import scratch
from ..sinks.points import read_points
from ..sinks.tables import quarantine_sink, write_edge_csv, write_lines
from ..sources.files import (
    judge_edge_csv, judge_edge_lines, parse_edges, read_csv_contract, read_edge_csv, read_edge_text, read_lines,
)
from ..sources.joblog import judge_event_lines
from ..sources.weather import FIELDS, HEADER, IDENTITY, judge_weather, read_weather_cells
from ..streaming.telemetry import (
    COUNT, MILLIS, SENSOR, judge_messages, parse_messages, telemetry_messages, telemetry_projection,
)
from .registry import as_ntz, query, rounded, table


def _case(selector, *texts, otherwise):
    """The n-th text where ``selector`` is n."""
    chosen = F.when(selector == 0, texts[0])
    for number, text in enumerate(texts[1:], start=1):
        chosen = chosen.when(selector == number, text)
    return chosen.otherwise(otherwise)


# --- single values -------------------------------------------------------------------

@query("finite_double", """
    SELECT event_id, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL
                     ELSE value END AS number
    FROM events""")
def _finite_double(spark, sf):
    text = _case(
        F.col("event_id") % 7, F.lit("nan"), F.lit(" -Infinity "), F.lit(" \t "), F.lit("warm"),
        otherwise=F.concat(F.lit(" \t"), F.col("value").cast("string"), F.lit(" ")),
    )
    return table(spark, sf, "events").select("event_id", finite_double(text).alias("number"))


@query("required_text", """
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS text FROM events""")
def _required_text(spark, sf):
    text = F.when(F.col("event_id") % 5 == 0, F.lit(" \t\r\n")).otherwise(
        F.concat(F.lit("\t "), F.col("event_type"), F.lit(" \n")))
    return table(spark, sf, "events").select("event_id", required_text(text).alias("text"))


@query("optional_text", """
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'null' ELSE event_type END AS text FROM events""")
def _optional_text(spark, sf):
    text = _case(F.col("event_id") % 3, F.lit("   "), F.lit(" null "), otherwise=F.col("event_type"))
    return table(spark, sf, "events").select("event_id", optional_text(text).alias("text"))


@query("offset_timestamp_utc", """
    SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL
                          ELSE date_trunc('millisecond', ts) - INTERVAL 2 HOUR END AS time FROM events""")
def _offset_timestamp(spark, sf):
    text = F.when(F.col("event_id") % 11 == 0, F.lit("2006-13-01 00:00:00.000 +0200")).otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" +0200")))
    parsed = table(spark, sf, "events").select("event_id", offset_timestamp_utc(text).alias("time"))
    return as_ntz(parsed, "time")


@query("iso_timestamp_utc", """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('millisecond', ts)
        WHEN 1 THEN date_trunc('millisecond', ts) WHEN 2 THEN date_trunc('millisecond', ts) - INTERVAL 2 HOUR
        ELSE NULL END AS time FROM events""")
def _iso_timestamp(spark, sf):
    bare = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    text = _case(
        F.col("event_id") % 4, bare, F.concat(bare, F.lit("Z")), F.concat(bare, F.lit("+02:00")),
        otherwise=F.concat(F.lit("on "), bare),
    )
    return as_ntz(table(spark, sf, "events").select("event_id", iso_timestamp_utc(text).alias("time")), "time")


# --- traffic source rows and messages --------------------------------------------------

def _source_rows(spark, sf):
    """Traffic rows as text, as the source would deliver them."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("record_id"),
        F.when(F.col("event_id") % 13 == 0, F.lit("not a date"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")).alias("read_date"),
        F.col("user_id").cast("string").alias("atd_device_id"),
        F.when(F.col("event_id") % 17 == 0, F.lit("x")).otherwise(F.col("value").cast("string")).alias("volume"),
    )


_SOURCE_OK = "event_id % 13 <> 0 AND event_id % 17 <> 0"


@query("telemetry_projection", f"""
    SELECT CAST(user_id AS VARCHAR) AS sensor_id, epoch_us(ts) // 1000 AS event_timestamp_ms,
           CAST(trunc(value) AS BIGINT) AS vehicle_count
    FROM events WHERE {_SOURCE_OK}""")
def _telemetry_projection(spark, sf):
    valid, _ = reject_split(telemetry_projection(_source_rows(spark, sf)))
    return valid.select(SENSOR, MILLIS, COUNT)


@query("keyed_json_sink", f"""
    SELECT CAST(user_id AS VARCHAR) AS key,
           '{{"sensor_id":"' || user_id || '","event_timestamp_ms":' || (epoch_us(ts) // 1000)
           || ',"vehicle_count":' || CAST(trunc(value) AS BIGINT) || '}}' AS value
    FROM events WHERE {_SOURCE_OK}""")
def _keyed_json_sink(spark, sf):
    path = scratch(spark, "messages")
    valid, _ = reject_split(telemetry_projection(_source_rows(spark, sf)))
    telemetry_messages(valid).write.parquet(path)
    return spark.read.schema("key string, value string").parquet(path)


@query("source_rejects", """
    SELECT CASE WHEN event_id % 13 = 0 THEN 'read_date is not an ISO timestamp' ELSE 'volume is not a number' END
           AS reject_reason, count(*) AS records
    FROM events WHERE event_id % 13 = 0 OR event_id % 17 = 0 GROUP BY 1""")
def _source_rejects(spark, sf):
    _, rejected = reject_split(telemetry_projection(_source_rows(spark, sf)))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


def message_texts(spark, sf, malformed: bool = True):
    """Telemetry messages; with ``malformed``, nine of ten kinds of message break a rule."""
    events = table(spark, sf, "events")
    sensor, count, millis = F.col("user_id"), F.col("value").cast("bigint"), F.unix_millis(F.col("ts").cast("timestamp"))
    good = compact_json(sensor_id=sensor.cast("string"), vehicle_count=count, event_timestamp_ms=millis)
    if not malformed:
        return events.select("event_id", "ts", good.alias("value"))

    def text(template, *args):
        return F.format_string(template, *args)

    value = _case(
        F.col("event_id") % 12,
        text('{"sensor_id":%d,"vehicle_count":%d,"event_timestamp_ms":%d}', sensor, count, millis),
        text('{"sensor_id":"%d","vehicle_count":%d.0,"event_timestamp_ms":%d}', sensor, count, millis),
        text('{"sensor_id":"%d","vehicle_count":"%d","event_timestamp_ms":%d}', sensor, count, millis),
        text('{"sensor_id":"%d","event_timestamp_ms":%d}', sensor, millis),
        text('{"sensor_id":"%d","vehicle_count":%d,"event_timestamp_ms":null}', sensor, count),
        text('{"sensor_id":{"x":%d},"vehicle_count":%d,"event_timestamp_ms":%d}', sensor, count, millis),
        text('{"sensor_id":" \\t ","vehicle_count":%d,"event_timestamp_ms":%d}', count, millis),
        text("not json %d", sensor),
        text('{"sensor_id":"%d","vehicle_count":12345678901234567890,"event_timestamp_ms":%d}', sensor, millis),
        text('{"vehicle_count":%d,"event_timestamp_ms":%d}', count, millis),
        otherwise=good,
    )
    return events.select("event_id", "ts", value.alias("value"))


_GOOD_MESSAGE = "event_id % 12 IN (0, 10, 11)"


@query("json_strict_parse", f"""
    SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, CAST(trunc(value) AS BIGINT) AS vehicle_count,
           epoch_us(ts) // 1000 AS event_timestamp_ms
    FROM events WHERE {_GOOD_MESSAGE}""")
def _json_strict_parse(spark, sf):
    valid, _ = reject_split(judge_messages(message_texts(spark, sf)))
    return valid.select("event_id", SENSOR, COUNT, MILLIS)


@query("reject_split", f"""
    SELECT event_id, CASE event_id % 12
        WHEN 1 THEN 'vehicle_count is not an integral number' WHEN 2 THEN 'vehicle_count is not an integral number'
        WHEN 3 THEN 'vehicle_count is missing' WHEN 4 THEN 'event_timestamp_ms is missing'
        WHEN 5 THEN 'sensor_id is empty' WHEN 6 THEN 'sensor_id is empty' WHEN 7 THEN 'message is not JSON'
        WHEN 8 THEN 'vehicle_count is not an integral number' WHEN 9 THEN 'sensor_id is missing' END AS reject_reason
    FROM events WHERE NOT ({_GOOD_MESSAGE})""")
def _reject_split(spark, sf):
    _, rejected = reject_split(judge_messages(message_texts(spark, sf)))
    return rejected.select("event_id", "reject_reason")


@query("fail_fast", """
    SELECT CAST(user_id AS VARCHAR) AS sensor_id, CAST(trunc(value) AS BIGINT) AS vehicle_count,
           date_trunc('millisecond', ts) AS event_time FROM events""")
def _fail_fast(spark, sf):
    parsed = parse_messages(message_texts(spark, sf, malformed=False), mode="fail")
    return as_ntz(parsed.select(SENSOR, COUNT, "event_time"), "event_time")


@query("props_parse", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _props_parse(spark, sf):
    doc = F.try_parse_json("props")
    return table(spark, sf, "events").select("event_id", F.try_variant_get(doc, "$.k", "bigint").alias("k"))


# --- weather CSV -----------------------------------------------------------------------

def _write_weather(spark, sf, path, malformed):
    """Events as a weather CSV; times carry a +0200 offset, one kind of row lacks a temperature."""
    number = F.col("value").cast("string")
    warm = F.when(F.lit(malformed) & (F.col("event_id") % 19 == 0), F.lit("warm")).otherwise(number)
    cells = {
        "Formatted Date": F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" +0200")),
        "Summary": F.concat(F.lit(" "), F.col("event_type"), F.lit("\t")),
        "Precip Type": F.when(F.col("event_type") == "error", "").when(F.col("event_type") == "click", "null")
        .otherwise("rain"),
        "Temperature (C)": warm,
        "Apparent Temperature (C)": number,
        "Humidity": F.lit("0.5"),
        "Wind Speed (km/h)": F.lit("1e1"),
        "Wind Bearing (degrees)": F.col("user_id").cast("string"),
        "Visibility (km)": F.lit("-3.25"),
        "Loud Cover": F.lit("0"),
        "Pressure (millibars)": F.lit("1016.3"),
        "Daily Summary": F.concat(F.lit('"day", '), F.col("props")),
    }
    table(spark, sf, "events").select(*[cells[name].alias(name) for name in HEADER]).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


_WEATHER_SQL = """
    SELECT 'Szeged' AS location, date_trunc('millisecond', ts) - INTERVAL 2 HOUR AS time, {temperature},
           value AS apparent_temperature_c, 0.5::DOUBLE AS humidity, 10::DOUBLE AS wind_speed_kmh,
           user_id::DOUBLE AS wind_bearing_degrees, -3.25::DOUBLE AS visibility_km, 0::DOUBLE AS cloud_cover,
           1016.3::DOUBLE AS pressure_millibars, event_type AS summary, '"day", ' || props AS daily_summary,
           CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 'null' ELSE 'rain' END AS precip_type
    FROM events {where}"""


@query("read_csv_contract", """
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' +0200' AS formatted_date, ' ' || event_type || chr(9) AS summary,
           CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 'null' ELSE 'rain' END AS precip_type,
           '"day", ' || props AS daily_summary
    FROM events""")
def _read_csv_contract(spark, sf):
    path = scratch(spark, "weather-csv")
    _write_weather(spark, sf, path, malformed=False)
    return read_csv_contract(spark, path, HEADER).select(
        F.col("Formatted Date").alias("formatted_date"), F.col("Summary").alias("summary"),
        F.col("Precip Type").alias("precip_type"), F.col("Daily Summary").alias("daily_summary"),
    )


@query("project_rename_fields", _WEATHER_SQL.format(
    temperature="value AS temperature_c", where="WHERE event_id % 19 <> 0"))
def _project_rename_fields(spark, sf):
    path = scratch(spark, "weather-csv")
    _write_weather(spark, sf, path, malformed=True)
    valid, _ = reject_split(judge_weather(read_weather_cells(spark, path)))
    return as_ntz(valid.select(*IDENTITY, *FIELDS), "time")


@query("weather_rejects", """
    SELECT 'Temperature (C) is not a finite number' AS reject_reason, count(*) AS records
    FROM events WHERE event_id % 19 = 0""")
def _weather_rejects(spark, sf):
    path = scratch(spark, "weather-csv")
    _write_weather(spark, sf, path, malformed=True)
    _, rejected = reject_split(judge_weather(read_weather_cells(spark, path)))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


@query("weather_ingest", """
    SELECT count(*) AS points, min(time) AS first_time, max(time) AS last_time FROM (
        SELECT DISTINCT date_trunc('millisecond', ts) - INTERVAL 2 HOUR AS time FROM events)""")
def _weather_ingest(spark, sf):
    path, bucket = scratch(spark, "weather-csv"), scratch(spark, "weather-points")
    _write_weather(spark, sf, path, malformed=False)
    expected = table(spark, sf, "events").count()
    for _ in range(2):  # ingesting the file again must not add points
        ingest_weather(spark, path, bucket, 0, expected)
    points = as_ntz(read_points(spark, bucket, IDENTITY, ["temperature_c", "summary"]), "time")
    return points.agg(
        F.count(F.lit(1)).alias("points"), F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )


# --- edge text and CSV -----------------------------------------------------------------

def edge_texts(spark, sf):
    """Order lines as edge text, with comments, blank lines and malformed lines between them."""
    order, part = F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")
    text = _case(
        (F.col("l_orderkey") + F.col("l_partkey")) % 9,
        F.concat(F.lit("# "), order, F.lit(" "), part),
        F.lit(" \t "),
        F.concat(F.lit("  "), order, F.lit("  "), part, F.lit(" ")),
        F.concat_ws(" ", order, part, order),
        order,
        F.concat(order, F.lit("\tx"), part),
        F.concat(F.lit("\t# "), order),
        otherwise=F.concat_ws("\t", order, part),
    )
    return table(spark, sf, "lineitem").select(text.alias("value"))


_EDGE_OK = "(l_orderkey + l_partkey) % 9 IN (2, 7, 8)"
_EDGES_SQL = f"SELECT l_orderkey AS source, l_partkey AS destination FROM lineitem WHERE {_EDGE_OK}"


@query("edge_parse", _EDGES_SQL)
def _edge_parse(spark, sf):
    return parse_edges(edge_texts(spark, sf))


@query("read_edge_text", _EDGES_SQL)
def _read_edge_text(spark, sf):
    path = scratch(spark, "edge-text")
    write_lines(edge_texts(spark, sf), F.col("value"), path)
    return read_edge_text(spark, path)


@query("edge_validate", """
    SELECT reject_reason, count(*) AS lines FROM (
        SELECT CASE (l_orderkey + l_partkey) % 9 WHEN 3 THEN 'expected 2 fields, found 3'
               WHEN 4 THEN 'expected 2 fields, found 1' ELSE 'destination is not an integer' END AS reject_reason
        FROM lineitem WHERE (l_orderkey + l_partkey) % 9 IN (3, 4, 5))
    GROUP BY reject_reason""")
def _edge_validate(spark, sf):
    path = scratch(spark, "edge-text")
    write_lines(edge_texts(spark, sf), F.col("value"), path)
    _, rejected = reject_split(judge_edge_lines(read_lines(spark, path)))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("lines"))


@query("skip_comments_blanks", """
    SELECT count(*) AS data_lines FROM lineitem WHERE (l_orderkey + l_partkey) % 9 NOT IN (0, 1, 6)""")
def _skip_comments(spark, sf):
    return judge_edge_lines(edge_texts(spark, sf)).agg(F.count(F.lit(1)).alias("data_lines"))


@query("edge_csv_sink", "SELECT l_orderkey AS source, l_partkey AS target FROM lineitem")
def _edge_csv_sink(spark, sf):
    path = scratch(spark, "edge-csv")
    lines = table(spark, sf, "lineitem")
    write_edge_csv(lines.select(F.col("l_orderkey").alias("source"), F.col("l_partkey").alias("destination")), path)
    return spark.read.schema("source bigint, target bigint").option("header", True).csv(path)


@query("read_edge_csv", "SELECT l_orderkey AS source, l_partkey AS destination FROM lineitem WHERE l_linenumber <> 7")
def _read_edge_csv(spark, sf):
    path = scratch(spark, "edge-csv")
    broken = F.when(F.col("l_linenumber") == 7, F.lit("a")).otherwise(F.col("l_orderkey").cast("string"))
    write_edge_csv(
        table(spark, sf, "lineitem").select(broken.alias("source"), F.col("l_partkey").alias("destination")), path)
    return read_edge_csv(spark, path)


def _broken_edge_csv(spark, sf, path):
    """Order lines as an edge CSV; one line number has a word, one too many cells."""
    lines = table(spark, sf, "lineitem")
    source = F.when(F.col("l_linenumber") == 7, F.lit("a")).otherwise(F.col("l_orderkey").cast("string"))
    more = F.when(F.col("l_linenumber") == 6, F.lit(",1")).otherwise(F.lit(""))
    text = F.concat_ws(",", source, F.concat(F.col("l_partkey").cast("string"), more))
    # One column under both headings: with another separator, commas in it are not quoted.
    lines.select(text.alias("source,target")).write.options(header=True, sep="\u0001").csv(path)
    return path


@query("edge_csv_rejects", """
    SELECT CASE l_linenumber WHEN 7 THEN 'source is not an integer' ELSE 'row does not match the header' END
           AS reject_reason, count(*) AS records
    FROM lineitem WHERE l_linenumber IN (6, 7) GROUP BY ALL""")
def _edge_csv_rejects(spark, sf):
    _, rejected = reject_split(judge_edge_csv(spark, _broken_edge_csv(spark, sf, scratch(spark, "edge-csv"))))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


@query("quarantine_sink", """
    SELECT CASE l_linenumber WHEN 7 THEN 'source is not an integer' ELSE 'row does not match the header' END
           AS reject_reason, 'edges' AS rejected_from, CAST(l_partkey AS VARCHAR) AS part
    FROM lineitem WHERE l_linenumber IN (6, 7)""")
def _quarantine_sink(spark, sf):
    """Rejected rows kept by reason; sent twice, they replace themselves."""
    _, rejected = reject_split(judge_edge_csv(spark, _broken_edge_csv(spark, sf, scratch(spark, "edge-csv"))))
    path = scratch(spark, "quarantine")
    for _ in range(2):
        quarantine_sink(rejected, path, "edges")
    kept = spark.read.schema("record string, rejected_from string, reject_reason string").json(path)
    part = F.get_json_object("record", "$.target_text")
    return kept.select("reject_reason", "rejected_from", part.alias("part"))


@query("event_log_rejects", """
    SELECT reason AS reject_reason, count(*) AS records FROM (
        SELECT CASE event_id % 3 WHEN 0 THEN 'line is not JSON (truncated, or a compressed log read as text)'
               WHEN 1 THEN 'line has no event name' END AS reason FROM events)
    WHERE reason IS NOT NULL GROUP BY reason""")
def _event_log_rejects(spark, sf):
    """Events as log lines: truncated ones, ones without an event name, and good ones."""
    path = scratch(spark, "broken-log")
    kind = F.col("event_id") % 3
    line = F.when(kind == 0, '{"Event":"SparkListener').when(kind == 1, '{"x":1}').otherwise(
        '{"Event":"SparkListenerApplicationStart"}')
    write_lines(table(spark, sf, "events"), line, path)
    _, rejected = reject_split(judge_event_lines(spark, path))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


@query("expect_csv_shape", """
    SELECT 'csv_shape' AS check, count(*) AS observed, count(*) AS expected,
           count(*) FILTER (WHERE l_linenumber = 7) AS malformed, count(*) FILTER (WHERE l_linenumber = 7) = 0 AS ok
    FROM lineitem""")
def _expect_csv_shape(spark, sf):
    path = scratch(spark, "edge-csv")
    lines = table(spark, sf, "lineitem")
    broken = F.when(F.col("l_linenumber") == 7, F.lit("a")).otherwise(F.col("l_orderkey").cast("string"))
    write_edge_csv(lines.select(broken.alias("source"), F.col("l_partkey").alias("destination")), path)
    cells = read_csv_contract(spark, path, ("source", "target"))
    return shape_report(cells, ["source", "target"], lines.count())


# --- whole-table gates, orders and plain projections -----------------------------------

@query("expect_count", """
    SELECT 'lineitem' AS check, count(*) AS observed, (SELECT count(*) FROM orders) AS expected,
           count(*) = (SELECT count(*) FROM orders) AS ok
    FROM lineitem""")
def _expect_count(spark, sf):
    return count_report(table(spark, sf, "lineitem"), table(spark, sf, "orders").count(), "lineitem")


@query("expect_unique", """
    SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""")
def _expect_unique(spark, sf):
    return duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_TOTAL_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]


@query("first_n_in_order", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    ORDER BY {', '.join(_TOTAL_ORDER)} LIMIT 5000""")
def _first_n(spark, sf):
    return first_n(table(spark, sf, "lineitem"), _TOTAL_ORDER, 5000).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("ordered_source", "SELECT ts, event_id, user_id FROM events ORDER BY ts, event_id")
def _ordered_source(spark, sf):
    return in_order(table(spark, sf, "events").select("ts", "event_id", "user_id"), ["ts", "event_id"])


@query("rename", "SELECT o_orderkey AS id, o_totalprice AS observation FROM orders")
def _rename(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.withColumnsRenamed({"o_orderkey": "id", "o_totalprice": "observation"})


@query("drop", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def _drop(spark, sf):
    return table(spark, sf, "orders").drop("o_totalprice", "o_orderpriority")


@query("case_when", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderstatus = 'O' THEN 'open'
                       ELSE 'partial' END AS state FROM orders""")
def _case_when(spark, sf):
    state = F.when(F.col("o_orderstatus") == "F", "finished").when(F.col("o_orderstatus") == "O", "open")
    return table(spark, sf, "orders").select("o_orderkey", state.otherwise("partial").alias("state"))


@query("point_lookup", "SELECT c_custkey AS id, c_name FROM customer WHERE c_custkey = 42")
def _point_lookup(spark, sf):
    return point_lookup(table(spark, sf, "customer").withColumnRenamed("c_custkey", "id"), 42).select("id", "c_name")


@query("named_result", """
    SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders
    GROUP BY o_orderpriority""")
def _named_result(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("observed_orders")
    return rounded(spark.sql("""
        SELECT o_orderpriority, count(*) AS orders, sum(o_totalprice) AS total
        FROM observed_orders GROUP BY o_orderpriority"""), 2, "total")


def _held(spark, sf):
    return judge(table(spark, sf, "orders"), [(F.col("o_totalprice") >= 0, "negative total")])


@query("fail_fast_rules", "SELECT count(*) AS orders FROM orders")
def _fail_fast_rules(spark, sf):
    return fail_fast(_held(spark, sf), F.col("o_orderkey")).agg(F.count(F.lit(1)).alias("orders"))
