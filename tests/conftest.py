import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("FATAL")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def normal(frame):
    """Rows as sorted tuples, columns by name, floats rounded."""
    import pandas as pd

    def value(v):
        if pd.api.types.is_scalar(v) and pd.isna(v):
            return ""
        if hasattr(v, "isoformat"):
            return v.isoformat()[:19]
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        try:
            return format(round(float(v), 7) + 0.0, ".7g" if abs(float(v)) < 1e6 else ".12g")
        except (TypeError, ValueError):
            return str(v)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(value(v) for v in row) for row in frame[columns].itertuples(index=False))
