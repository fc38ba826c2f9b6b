import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE))]

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from millrace.llm.common import ship_package

    ship_package(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="session")
def documents(spark):
    """Rows for every odd case: null columns, empty and blank texts, repeated rows, a very long text."""
    def make(*texts, langs=None):
        rows = [(n, t, (langs or {}).get(n, "en"), f"s{n % 3}", None if t is None else len(t)) for n, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make
