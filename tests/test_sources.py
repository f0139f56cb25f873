import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_MEDIUM
from stokehold.operators.quality import normalize_columns, normalize_name
from stokehold.plans.registry import table
from stokehold.sources import io as IO


def test_csv_round_trip_and_missing_input(spark):
    root = tempfile.mkdtemp(prefix="stokehold-io-")
    o = table(spark, SF_MEDIUM, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = IO.write_report(o, root, "orders_csv")
    back = IO.read_readings(spark, path, "csv")
    assert back.count() == o.count()
    assert dict(back.dtypes)["o_totalprice"] == "double"
    assert IO.read_readings(spark, os.path.join(root, "nope"), missing_ok=True) is None
    with pytest.raises(IO.MissingInput):
        IO.read_readings(spark, os.path.join(root, "nope"))


def test_splits_written_partitioned(spark):
    root = tempfile.mkdtemp(prefix="stokehold-io-")
    e = table(spark, SF_MEDIUM, "events").withColumn("split", F.when(F.col("event_id") < 7000, "train").otherwise("test"))
    IO.write_splits(e, root, "splits", features=["value"])
    back = IO.read_stage(spark, root, "splits").filter("split = 'test'")
    assert back.count() == e.filter("split = 'test'").count()
    assert IO.read_feature_list(spark, os.path.join(root, "splits_features")) == ["value"]


def test_fingerprint_is_order_independent(spark):
    li = table(spark, SF_MEDIUM, "lineitem")
    a = IO.dataset_fingerprint(li).first()
    b = IO.dataset_fingerprint(li.repartition(5).orderBy(F.rand(1))).first()
    assert a == b


def test_column_name_normalisation(spark):
    assert normalize_name(" ΔP aktual (KjKg) ") == "ΔP_aktual_KjKg"
    assert normalize_name("Main steam flow (t/h)") == "Main_steam_flow_th"
    df = spark.createDataFrame([(1, 2)], ["a b", "c-d"])
    assert normalize_columns(df).columns == ["a_b", "cd"]


def test_column_diff(spark):
    from stokehold.operators.quality import column_diff

    o = table(spark, SF_MEDIUM, "orders")
    d = column_diff(o, o.select("o_orderkey", "o_totalprice").withColumn("extra", F.lit(1)))
    assert d["common"] == ["o_orderkey", "o_totalprice"]
    assert d["only_b"] == ["extra"] and "o_custkey" in d["only_a"] and d["duplicated"] == []
