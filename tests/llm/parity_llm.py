"""``python tests/llm/parity_llm.py [sf] [name ...]``: the queries of this folder against their SQL on DuckDB."""

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), os.path.dirname(HERE)]

import parity  # noqa: E402


def main() -> int:
    from millrace.llm.queries import QUERIES
    from millrace.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session("parity-llm", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = parity.connect(sf), 0
    for name in sys.argv[2:] or QUERIES:
        began = time.time()
        df = QUERIES[name].run(spark, f"{parity.DATA}/sf{sf}")
        got = parity.spark_result(df)
        problem = None
        if QUERIES[name].sql:
            problem = parity.differences(got, parity.sql_result(con, QUERIES[name].sql)) or parity.type_differences(
                df, con, QUERIES[name].sql)
        failed += problem is not None
        print(name, len(got[1]), "rows", round(time.time() - began, 1), "s", problem or ("ok" if QUERIES[name].sql else
                                                                                        "no SQL"), flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
