"""Numbers the reference publishes that follow from published counts alone."""

import math

import pytest
from pyspark.sql import functions as F

from stokehold.operators import evaluate as EV
from stokehold.operators import stats as ST

# fixed values: published confusion counts and the metrics derived from them
TEST_COUNTS = (7265, 122, 56, 71)
TRAIN_COUNTS = (34030, 490, 331, 212)
VAL_COUNTS = (7291, 110, 50, 36)


def _metrics(spark, counts):
    return EV.binary_metrics_from_counts(spark, *counts).first()


def test_test_split_metrics(spark):
    m = _metrics(spark, TEST_COUNTS)
    assert m["f1"] == pytest.approx(0.44375, abs=1e-6)
    assert m["precision"] == pytest.approx(0.367876, abs=1e-6)
    assert m["recall"] == pytest.approx(0.559055, abs=1e-6)
    assert m["accuracy"] == pytest.approx(0.976311, abs=1e-6)
    assert m["mcc"] == pytest.approx(0.442083, abs=1e-6)
    assert m["kappa"] == pytest.approx(0.432173, abs=1e-6)


def test_train_and_val_f1(spark):
    assert _metrics(spark, TRAIN_COUNTS)["f1"] == pytest.approx(0.340562, abs=1e-6)
    assert _metrics(spark, VAL_COUNTS)["f1"] == pytest.approx(0.310345, abs=1e-6)


def _rows_from_counts(spark, counts):
    tn, fp, fn, tp = counts
    n = tn + fp + fn + tp
    r = spark.range(n)
    y = F.when(F.col("id") < tn + fp, 0).otherwise(1)
    p = (F.when(F.col("id") < tn, 0).when(F.col("id") < tn + fp, 1)
         .when(F.col("id") < tn + fp + fn, 0).otherwise(1))
    return r.select(y.alias("y"), p.alias("p"))


def test_cramers_v_with_yates(spark):
    df = _rows_from_counts(spark, TRAIN_COUNTS)
    v = ST.chi2_stats(df, "y", "p").first()["cramers_v"]
    assert v == pytest.approx(0.330830, abs=1e-6)


def test_rank_biserial_from_published_u():
    n1, n2, u = 34520, 543, 640281.0
    assert 1 - 2 * u / (n1 * n2) == pytest.approx(0.931683, abs=1e-6)


# fixed values: published p-values and their adjusted versions
P = [0.0029728088943150864, 0.5393698160200336, 0.9132236856040936, 0.0, 0.0693862990766308, 7.179956929910409e-06]
BONF = [0.01783685336589052, 1.0, 1.0, 0.0, 0.4163177944597848, 4.3079741579462455e-05]
BH = [0.005945617788630173, 0.6472437792240403, 0.9132236856040936, 0.0, 0.1040794486149462, 2.1539870789731227e-05]
HOLM = [0.011891235577260345, 1.0, 1.0, 0.0, 0.2081588972298924, 3.589978464955204e-05]


def test_multiple_comparison(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(P)], "h int, p_value double")
    out = {r["h"]: r for r in ST.adjust_pvalues(df).collect()}
    for i in range(len(P)):
        assert out[i]["p_bonferroni"] == pytest.approx(BONF[i], rel=1e-9, abs=1e-15)
        assert out[i]["p_bh"] == pytest.approx(BH[i], rel=1e-9, abs=1e-15)
        assert out[i]["p_holm"] == pytest.approx(HOLM[i], rel=1e-9, abs=1e-15)


def test_fairness_range():
    f1 = [0.43956, 0.444444, 0.363636, 0.48951]
    assert max(f1) - min(f1) == pytest.approx(0.1259, abs=1e-4)


def test_label_comparison_counts(spark):
    from stokehold.operators.joins import compare_labels

    # old label fires on 726 keys, new on those plus 30 more, 49,335 neither
    old = spark.range(50091).select("id", (F.col("id") < 726).cast("int").alias("old"))
    new = spark.range(50091).select("id", (F.col("id") < 756).cast("int").alias("new"))
    r = compare_labels(old, new, "id", "old", "new").first()
    assert (r["both"], r["only_old"], r["only_new"], r["neither"]) == (726, 0, 30, 49335)


def test_imbalance_ratio(spark):
    df = spark.range(50091).select((F.col("id") < 756).cast("int").alias("label"))
    from stokehold.operators.quality import class_balance

    r = class_balance(df, "label").first()
    assert r["imbalance_ratio"] == pytest.approx(49335 / 756, rel=1e-9)
    assert round(r["imbalance_ratio"], 2) == 65.26
