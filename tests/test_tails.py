import math

import pytest

from stokehold.functions import tails as T


def test_normal():
    assert T.norm_cdf(1.959963984540054) == pytest.approx(0.975, abs=1e-12)
    assert T.norm_ppf(0.975) == pytest.approx(1.959963984540054, abs=1e-9)
    assert T.norm_ppf(1e-10) == pytest.approx(-6.361340902404056, abs=1e-7)


def test_chi2():
    assert T.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-10)
    assert T.chi2_sf(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-10)


def test_t_and_f():
    assert T.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-10)
    assert T.f_sf(4.964602743730711, 1, 10) == pytest.approx(0.05, abs=1e-9)
    assert T.t_ppf(0.975, 10) == pytest.approx(2.2281388519649385, abs=1e-6)


def test_noncentral_t_reduces_to_central():
    assert T.nct_sf(2.0, 30, 0.0) == pytest.approx(T.t_sf(2.0, 30), abs=1e-4)


def test_normal_expressions_match_the_standard_library(spark):
    import math
    from statistics import NormalDist

    from pyspark.sql import functions as F

    from stokehold.functions import scalar as S

    xs = [i / 7 for i in range(-180, 181)] + [0.0, 0.46875, 4.0, -4.0, 26.0]
    for r in spark.createDataFrame([(float(x),) for x in xs], "x double").select("x", S.erfc("x").alias("e"), S.normal_cdf("x").alias("c")).collect():
        assert r.e == pytest.approx(math.erfc(r.x), rel=2e-13, abs=1e-300)
        assert r.c == pytest.approx(NormalDist().cdf(r.x), rel=1e-12, abs=1e-15)
    ps = [1e-300, 1e-20, 1e-9, .001, .0749, .075, .0751, .2, .5, .7, .925, .999, 1 - 1e-12]
    for r in spark.createDataFrame([(p,) for p in ps], "p double").select("p", S.normal_quantile("p").alias("z")).collect():
        assert r.z == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-13, abs=1e-15)
    assert spark.range(1).select(S.normal_quantile(F.lit(0.0))).first()[0] is None
