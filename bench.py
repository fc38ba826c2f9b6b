"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Every entry is run once on the
smallest tables first, so that timings leave out class loading; inputs an entry needs on
disk are written before its clock starts. Results are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from millrace.catalog import QUERIES
from millrace.catalog.contracts import _write_weather
from millrace.catalog.graphs import edges_of
from millrace.catalog.joblogs import event_log, raw_log
from millrace.catalog.timeseries import TICK
from millrace.plans.graphs import rank_edge_file
from millrace.plans.timeseries import downsample_task, ingest_weather
from millrace.session import build_session, scratch
from millrace.sinks.tables import write_lines
from millrace.sources.joblog import read_event_log
from millrace.sources.weather import read_weather

HEADLINE = [
    "sliding_mean", "sliding_mean_all", "tumbling_mean", "tumbling_sum", "two_sigma_anomalies", "two_sigma_by_type",
    "downsample", "downsample_task", "unpivot_fields", "latest_point", "upsert_sink", "json_strict_parse", "edge_parse",
    "count_by_key", "topk_indegree", "topk_indegree_zero", "rank_rows", "graph_build", "neighbors", "shortest_path",
    "skew_compare", "stage_worker_grid", "first_n_in_order", "stream_tumbling_sum", "log_stage_metrics",
    "plan_operators", "dag_summary",
]
WARM = os.path.join(os.path.dirname(os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")), "sf0.001")


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def entries(spark, sf):
    """``(name, prepare, run)``; ``run`` gets what ``prepare`` returned."""
    for name in HEADLINE:
        prepare = (lambda: event_log(spark, sf)) if QUERIES[name].subject == "joblogs" else (lambda: None)
        yield name, prepare, lambda _, name=name: discard(QUERIES[name].run(spark, sf))

    def weather():
        path = scratch(spark, "bench-weather")
        _write_weather(spark, sf, path, malformed=False)
        return path

    def parsed(path):
        discard(read_weather(spark, path))

    yield "weather_parse", weather, parsed

    def tick(target):
        downsample_task(spark.read.parquet(f"{sf}/events.parquet"), "ts", "value", ["event_type"], TICK, target)

    yield "downsample_one_tick", lambda: scratch(spark, "bench-hourly"), tick
    yield "read_event_log_parse", lambda: raw_log(spark, sf), lambda path: discard(read_event_log(spark, path))
    yield "weather_ingest_once", weather, lambda path: ingest_weather(spark, path, scratch(spark, "bench-points"), 0)

    def text():
        path = scratch(spark, "bench-edges")
        write_lines(edges_of(spark, sf), F.concat_ws("\t", "source", "destination"), path)
        return path

    yield "rank_edge_file", text, lambda path: rank_edge_file(spark, path, scratch(spark, "bench-rank"), 50)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    only = set(sys.argv[1:])
    times: dict[str, float] = {}
    if os.path.isdir(WARM):
        for name, prepare, run in entries(spark, WARM):
            if not only or name in only:
                run(prepare())
    for name, prepare, run in entries(spark, sf):
        if only and name not in only:
            continue
        ready = prepare()
        began = time.perf_counter()
        run(ready)
        times[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
