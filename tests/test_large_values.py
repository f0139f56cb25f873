"""Statistics stay right on values around 1e9 and on millions of equal values."""

import pytest
from pyspark.sql import functions as F

from stokehold.models.supervised import dummy_predict
from stokehold.operators import evaluate as EV
from stokehold.operators import features as FE
from stokehold.operators import stats as ST


@pytest.fixture(scope="module")
def large(spark):
    return spark.range(30000).select((F.lit(1e9) + F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("y"), (F.col("id") % 3).alias("g"))


def test_anova_on_a_large_mean(large):
    x = large.toPandas()
    y = x.y - 1e9
    ssw = ((y - y.groupby(x.g).transform("mean")) ** 2).sum()
    ssb = ((y.groupby(x.g).transform("mean") - y.mean()) ** 2).sum()
    got = ST.anova_stats(large, "y", "g").first()
    sums = FE.anova_sums(large, ["y"], "g").first()
    assert abs(got.ssw / ssw - 1) < 1e-4 and abs(sums.ssw / ssw - 1) < 1e-4
    assert abs(got.ssb - ssb) < 1e-2 * max(ssb, 1) and abs(sums.ssb - ssb) < 1e-2 * max(ssb, 1)


def test_r2_on_a_large_mean(large):
    got = EV.regression_metrics(large.withColumn("p", F.col("y") + 0.01), "y", "p").first()
    assert abs(got.r2 - (1 - 1e-4 * 12)) < 1e-4


def test_counts_whose_products_pass_63_bits(spark):
    ties = spark.range(3_000_000).select(F.lit(1.0).alias("v"), (F.col("id") % 2).alias("l"))
    got = ST.mann_whitney_stats(ties, "v", "l").first()
    assert got.u == got.u1 == 1_500_000 ** 2 / 2 and abs(got.ties / 2.7e19 - 1) < 1e-6
    cells = spark.range(9_000_000).select((F.col("id") % 3).alias("a"), F.lit(0).alias("one"), (F.col("id") % 2).alias("b"))
    assert abs(ST.chi2_stats(cells, "a", "b").first().chi2) < 1e-3


def test_a_stratified_draw_needs_a_key(large):
    with pytest.raises(ValueError):
        dummy_predict(large, large, "g", "stratified")
