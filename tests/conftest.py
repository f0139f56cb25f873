import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SF_SMALL = os.environ.get("STOKEHOLD_TEST_SF", "/root/testdata/sf0.001")
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from stokehold.session import ensure_checkpoint_dir, ship_package

    s = (SparkSession.builder.master("local[*]").appName("stokehold-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    ship_package(s)
    yield s


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v, digits):
    import math

    if v is None:
        return "NULL"
    try:
        import pandas as pd

        if v is pd.NA or v is pd.NaT:
            return "NULL"
    except Exception:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v.is_integer() and abs(v) < 2 ** 53:
            return str(int(v))
        return repr(round(v, digits) + 0.0)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _cell(v.item(), digits)
        except Exception:
            pass
    return str(v)


def normalise(df, digits=4):
    """Order-insensitive, dtype-insensitive form of a result for comparison."""
    df = df[sorted(df.columns)].copy()
    for col in df.columns:
        df[col] = [_cell(v, digits) for v in df[col].tolist()]
    return df.sort_values(list(df.columns)).reset_index(drop=True)
