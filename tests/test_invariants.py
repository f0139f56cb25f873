"""Invariants of the scalable building blocks and the model (R-checked items)."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_MEDIUM
from stokehold.operators import core
from stokehold.operators import sampling as SP
from stokehold.operators import timeseries as TS
from stokehold.plans.registry import table

EV_ORDER = ["ts", "event_id"]


def test_row_index_is_dense_and_ordered(spark):
    e = table(spark, SF_MEDIUM, "events").repartition(7)
    idx, n = core.with_row_index(e, [F.col("ts"), F.col("event_id")])
    assert n == 10000
    pdf = idx.select("event_id", "ts", core.ROW_INDEX).toPandas().sort_values(core.ROW_INDEX)
    assert list(pdf[core.ROW_INDEX]) == list(range(n))
    assert pdf["ts"].is_monotonic_increasing


def test_halo_neighbours_equal_global_lag_lead(spark):
    e = table(spark, SF_MEDIUM, "events").select("event_id", "ts", "value")
    idx, n = core.with_row_index(e, [F.col("ts"), F.col("event_id")])
    assert core.block_size(n, 3, spark.sparkContext.defaultParallelism) < n  # several blocks → halos matter
    nb = core.with_neighbors(idx, n, ["value"], lags=3, leads=2).toPandas().sort_values(core.ROW_INDEX)
    v = nb["value"].to_numpy()
    for k in (1, 2, 3):
        assert (nb[f"value__lag{k}"].to_numpy()[k:] == v[:-k]).all()
        assert nb[f"value__lag{k}"].isna().sum() == k
    for k in (1, 2):
        assert (nb[f"value__lead{k}"].to_numpy()[:-k] == v[k:]).all()


def test_running_sums_match_cumsum(spark):
    e = table(spark, SF_MEDIUM, "events").select("event_id", "ts", "value")
    idx, n = core.with_row_index(e, [F.col("ts"), F.col("event_id")])
    pdf = core.running_sums(idx, n, ["value"]).toPandas().sort_values(core.ROW_INDEX)
    assert pdf["value__cum"].to_numpy() == pytest.approx(pdf["value"].cumsum().to_numpy(), rel=1e-9)
    mx = core.running_sums(idx, n, ["value"], op="max", suffix="__mx").toPandas().sort_values(core.ROW_INDEX)
    assert (mx["value__mx"].to_numpy() == mx["value"].cummax().to_numpy()).all()


def test_time_split_is_disjoint_complete_and_ordered(spark):
    e = table(spark, SF_MEDIUM, "events")
    s = TS.time_split(e, EV_ORDER)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 7000, "validation": 1500, "test": 1500}
    chk = {r["split"]: r["before_next"] for r in TS.check_temporal_order(s, "ts").collect()}
    assert all(chk.values())


@pytest.mark.parametrize("n,key", [(0, "id"), (1, "id"), (7, "id"), (5000, "id"), (5000, "case when id % 3 = 0 then 10 else id end"),
                                   (5000, "case when id % 5 > 0 then null else id end"), (5000, "string(id)"), (5000, "10"), (5000, "id / 7.0D")])
def test_time_split_by_boundary_keys_equals_positions(spark, n, key):
    df = spark.range(0, n, 1, 4).selectExpr(f"{key} AS k", "id AS i")
    for order in (["k", "i"], ["k"]):  # the second has ties
        got = TS.time_split(df, order)
        counts = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
        a, b = int(n * 0.70), int(n * 0.85)
        assert counts == {s: c for s, c in (("train", a), ("validation", b - a), ("test", n - b)) if c}
    rows = sorted(((r.k is not None, r.k, r.i), r.split) for r in TS.time_split(df, ["k", "i"]).collect())
    assert [s for _, s in rows] == ["train"] * a + ["validation"] * (b - a) + ["test"] * (n - b)
    folds = sorted(((r.k is not None, r.k, r.i), r.fold) for r in SP.kfold(df, 5, order=["k", "i"]).collect())
    assert [f for _, f in folds] == [min(4, x * 5 // n) for x in range(n)]


def test_time_split_reads_two_columns_and_sorts_nothing(spark):
    plan = TS.time_split(table(spark, SF_MEDIUM, "events"), EV_ORDER).select("event_id", "split")._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "props" not in plan and "hashpartitioning" not in plan


def test_stratified_split_keeps_class_shares(spark):
    e = table(spark, SF_MEDIUM, "events").withColumn("y", (F.col("event_type") == "error").cast("int"))
    s = SP.stratified_split(e, "y", ["event_id"])
    rates = {r["split"]: r["r"] for r in s.groupBy("split").agg(F.avg("y").alias("r")).collect()}
    overall = e.agg(F.avg("y")).first()[0]
    for r in rates.values():
        assert abs(r - overall) < 0.01
    assert s.select("event_id").distinct().count() == 10000


def test_hash_sample_is_deterministic_across_partitionings(spark):
    e = table(spark, SF_MEDIUM, "events")
    a = {r["event_id"] for r in SP.sample_n(e.repartition(3), 50, ["event_id"]).collect()}
    b = {r["event_id"] for r in SP.sample_n(e.repartition(11), 50, ["event_id"]).collect()}
    assert a == b and len(a) == 50


def test_winsorize_is_idempotent_on_bounds(spark):
    from stokehold.operators.quality import outlier_bounds, winsorize

    c = table(spark, SF_MEDIUM, "lineitem").select("l_extendedprice", "l_quantity")
    w = winsorize(c)
    b = outlier_bounds(w, ["l_extendedprice"]).first()
    lo, hi = w.agg(F.min("l_extendedprice"), F.max("l_extendedprice")).first()
    assert lo >= b["l_extendedprice__lower"] - 1e-9 or hi <= b["l_extendedprice__upper"] + 1e-9


def test_interpolation_fills_every_gap(spark):
    from stokehold.plans.profiling import gappy_events

    g = gappy_events(spark, SF_MEDIUM).select("event_id", "ts", "v_interp")
    out = TS.interpolate_linear(g, ["v_interp"], EV_ORDER)
    assert out.filter(F.col("v_interp").isNull()).count() == 0
    assert out.count() == 10000


def test_distributed_quantiles_equal_percentile(spark):
    li = table(spark, SF_MEDIUM, "lineitem")
    cols = ["l_extendedprice", "l_quantity", "l_discount"]
    probs = [0.0, 0.25, 0.33, 0.5, 0.75, 0.98, 1.0]
    got = core.quantile_values(li, cols, probs)
    row = li.agg(*[F.percentile(x, probs).alias(x) for x in cols]).first()
    for x in cols:
        for p, v in zip(probs, row[x]):
            assert got[(x, p)] == pytest.approx(v, rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])  # coarse sketches need many rounds
def test_order_statistics_in_many_rounds(spark, accuracy):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.pow(F.lit(10.0), (F.col("id") * 7919 % 5000) / 100.0 - 25)).alias("spread"),
        (F.col("id") % 2).cast("double").alias("two"), F.lit(4).alias("one"), F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") < 7, F.col("id").cast("double")).when(F.col("id") < 9, F.lit(float("nan"))).alias("few"))
    every = lambda n: [0, 1, n // 3 - 1, n // 3, n // 2 - 1, n // 2, n - 2, n - 1]
    got = core.order_statistics(df, {x: (F.col(x), every, [0, 1 / 3, .5, 1]) for x in df.columns}, accuracy)
    rows = df.collect()
    for x in df.columns:
        want = sorted(r[x] for r in rows if r[x] is not None and r[x] == r[x])
        assert got[x][0] == len(want)
        assert got[x][1] == {p: want[p] for p in (every(len(want)) if want else [])}


def test_grouped_quantiles_equal_percentile(spark):
    e = table(spark, SF_MEDIUM, "events")
    qt = {(r["event_type"], r["prob"]): r["value"]
          for r in core.quantile_table(e, ["value"], [0.25, 0.5], by=["event_type"]).collect()}
    want = e.groupBy("event_type").agg(F.percentile("value", [0.25, 0.5]).alias("q")).collect()
    for r in want:
        assert qt[(r["event_type"], 0.25)] == pytest.approx(r["q"][0])
        assert qt[(r["event_type"], 0.5)] == pytest.approx(r["q"][1])


def test_kendall_blocks_match_brute_force(spark):
    import numpy as np

    from stokehold.operators import stats as ST

    cu = table(spark, SF_MEDIUM, "customer").select("c_acctbal", "c_nationkey")
    pdf = cu.toPandas()
    x, y = pdf["c_acctbal"].to_numpy(), pdf["c_nationkey"].to_numpy().astype(float)
    s = float(np.sum(np.triu(np.sign(x[:, None] - x[None, :]) * np.sign(y[:, None] - y[None, :]), 1)))
    for block in (97, 1000, 200_000):  # many blocks, a few, one
        r = ST.kendall_stats(cu, "c_acctbal", "c_nationkey", block=block).first()
        assert r["s"] == pytest.approx(s)


def test_sorted_quantile_table_equals_percentile(spark):
    li = table(spark, SF_MEDIUM, "lineitem")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in core.quantile_table(li, ["l_extendedprice"], probs).collect()}
    want = li.agg(F.percentile("l_extendedprice", probs)).first()[0]
    for p, v in zip(probs, want):
        assert got[("l_extendedprice", p)] == pytest.approx(v, rel=1e-12)


def test_adf_and_kpss_separate_noise_from_random_walk(spark):
    from pyspark.sql import Window

    e = table(spark, SF_MEDIUM, "events").select("event_id", "ts", "value")
    centred = e.withColumn("noise", F.col("value") - F.lit(e.agg(F.avg("value")).first()[0]))
    walk = centred.withColumn("walk", F.sum("noise").over(Window.orderBy("ts", "event_id")))  # small test table
    a_noise = TS.adf(walk, "noise", EV_ORDER).first()
    a_walk = TS.adf(walk, "walk", EV_ORDER).first()
    assert a_noise["adf_pvalue"] < 0.05 < a_walk["adf_pvalue"]
    k_noise = TS.kpss(walk, "noise", EV_ORDER).first()
    k_walk = TS.kpss(walk, "walk", EV_ORDER).first()
    assert k_noise["kpss_pvalue"] > 0.05 > k_walk["kpss_pvalue"]


def test_yeo_johnson_finds_the_best_lambda(spark):
    import numpy as np

    from stokehold.operators import features as FE

    r = np.random.default_rng(3)
    skewed, left, wide = np.exp(r.normal(0, 1, 3000)), 50 - np.exp(r.normal(1, .5, 3000)), r.gamma(2, 3, 3000) ** 3 + 40
    df = spark.createDataFrame([(float(a), float(b), float(w), 7.0) for a, b, w in zip(skewed, left, wide)], "a double, b double, w double, k double")
    got = FE.fit_yeo_johnson(df, ["a", "b", "w", "k"])

    def loglik(x, lam):
        with np.errstate(all="ignore"):
            pos = np.log1p(x) if abs(lam) < 1e-12 else ((x + 1) ** lam - 1) / lam
            neg = -np.log1p(-x) if abs(lam - 2) < 1e-12 else -((1 - x) ** (2 - lam) - 1) / (2 - lam)
            y = np.where(x >= 0, pos, neg)
        return -len(x) / 2 * np.log(y.var()) + (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()

    for name, x in (("a", skewed), ("b", left), ("w", wide)):
        lo, hi = -20.0, 20.0
        while hi - lo > 1e-9:  # golden section
            m1, m2 = hi - (hi - lo) / 1.618033988749895, lo + (hi - lo) / 1.618033988749895
            lo, hi = (lo, m2) if loglik(x, m1) > loglik(x, m2) else (m1, hi)
        assert got[name] == pytest.approx((lo + hi) / 2, abs=1e-4), name
    assert got["k"] == 1.0


def test_adf_and_lagged_sums_over_blocks_equal_one_array(spark):
    """Blocks with a halo, nulls and many lags give the regressions of the whole array."""
    import numpy as np

    from stokehold.operators import timeseries as TS
    from stokehold.operators.core import ROW_INDEX

    rng = np.random.default_rng(3)
    y = np.cumsum(rng.normal(size=20_000)) * 0.1 + rng.normal(size=20_000)
    known = rng.random(20_000) > 0.01
    df = spark.createDataFrame([(i, float(v) if k else None) for i, (v, k) in enumerate(zip(y, known))], f"`{ROW_INDEX}` long, value double").repartition(5)
    lags, first = 120, 121
    filled = np.where(known, y, 0.0)
    dy = np.append(0.0, np.where(known[1:] & known[:-1], np.diff(y), 0.0))
    t = np.arange(first, len(y))
    x = np.stack([np.ones(len(t)), filled[t - 1], *[dy[t - j] for j in range(1, lags + 1)]])
    g, b, yy, n = TS._adf_gram(df, len(y), "value", lags, first)
    np.testing.assert_allclose(g, np.einsum("it,jt->ij", x, x), rtol=1e-9, atol=1e-7)
    np.testing.assert_allclose(b, np.einsum("it,t->i", x, dy[t]), rtol=1e-9, atol=1e-7)
    assert n == len(t) and yy == pytest.approx((dy[t] ** 2).sum())
    z = TS._eliminated(g, b[:, None])[:, 0]
    beta = TS._eliminated(g[:30, :30], np.eye(30)).T @ z[:30]
    np.testing.assert_allclose(np.einsum("ij,j->i", g[:30, :30], beta), b[:30], rtol=1e-8, atol=1e-6)
    sums, _ = TS._lagged_sums(df, "value", [], 7, True, (df, len(y)))
    e = np.where(known, y - y[known].mean(), 0.0)
    assert sums["n"] == known.sum() and all(sums[f"s{k}"] == pytest.approx((e[k:] * e[:len(e) - k]).sum()) for k in range(8))
    out = TS.adf(df, "value", [], maxlag=lags, indexed=(df, len(y))).first()
    assert out["nobs"] == len(y) - out["used_lag"] - 1 and math.isfinite(out["adf_stat"])


def test_multi_pass_statistics_read_their_input_once(spark):
    from stokehold.operators import features as FE
    from stokehold.operators import stats as ST

    n = 600
    base = spark.range(n).select((F.col("id") * 37 % 101).cast("double").alias("a"), F.sqrt("id").alias("b"), (F.col("id") % 2).cast("int").alias("y"))

    def reads(run):
        seen = spark.sparkContext.accumulator(0)

        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        run(base.mapInArrow(count, base.schema))
        return seen.value / n

    assert reads(lambda df: FE.mutual_info_binned(df, ["a", "b"], "y", bins=4).collect()) == 1
    assert reads(lambda df: ST.linearity(df, "b", ["a"]).collect()) == 1
    assert reads(lambda df: ST.homoscedasticity(df, "b", ["a"]).collect()) == 1
    # skewness, the fit's copy, the moments of the result
    assert reads(lambda df: FE.yeo_johnson(df, ["a", "b"], min_abs_skew=0.0)) <= 3


def test_split_readings_read_the_joined_rows_from_files(spark):
    from stokehold.plans.modelling import forest_readings, split_readings

    for frame in (split_readings(spark, SF_MEDIUM), forest_readings(spark, SF_MEDIUM)):
        files = frame.inputFiles()
        assert files and all("written-" in f for f in files)
        assert {r["split"]: r["count"] for r in frame.groupBy("split").count().collect()} == {"train": 42_000, "validation": 9_000, "test": 9_000}
    assert "o_totalprice" not in frame.columns


def test_data_dictionary_repeats_no_row(spark):
    from stokehold.operators import quality as Q

    df = spark.createDataFrame([(1, "a", None), (2, "a", 0.5), (2, None, 0.5)], "k int, s string, x double")
    out = Q.data_dictionary(df)
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["column"]: (r["non_null"], r["null_count"], r["unique"]) for r in out.collect()} == {"k": (3, 0, 2), "s": (2, 1, 1), "x": (2, 1, 1)}


def test_yeo_johnson_likelihood_is_that_of_the_transform(spark):
    """One pass over batches gives the likelihood of the transformed column for every λ, about 0 and 2 too; nulls, NaN, empty parts and constants included."""
    import math

    from stokehold.operators import features as FE

    df = spark.range(4000).selectExpr("if(id % 9 = 0, null, if(id % 17 = 0, double('NaN'), pow(double(id % 500), 1.7) - 3000)) as a", "double(id % 3) * 1e5 as b", "double(4) as c",
                                      "cast(null as double) as d").repartition(7)
    grids = {"a": [-2.0, -1.0, 0.0, 1.0, 2.0, 3.0], "b": [0.9, 0.95, 1.0], "c": [1.0, 2.0], "d": [1.0, 2.0]}
    got = FE._yj_loglik(df, grids)
    for x, lams in grids.items():
        v = F.nanvl(F.col(x), F.lit(None))
        for lam, ll in zip(lams, got[x]):
            r = df.agg(F.count(v), F.var_pop(FE.yj_expr(v, lam)), F.sum(F.signum(v) * F.log1p(F.abs(v)))).first()
            want = -r[0] / 2 * math.log(r[1]) + (lam - 1) * r[2] if r[1] else -math.inf
            assert ll == want or abs(ll - want) < 1e-9 * abs(want)


def test_yeo_johnson_joins_once(spark, monkeypatch):
    """The readings are written before the skews, the fit and the summary read them, and not again."""
    from stokehold.plans import series

    seen = []
    monkeypatch.setattr(series.FE, "yeo_johnson", lambda df, cols, **kw: seen.append((df, kw)) or (df.withColumns({x + "_yj": F.col(x) for x in cols}), dict.fromkeys(cols, 1.0)))
    series.yeo_johnson_orders(spark, SF_MEDIUM)
    assert "Join" not in seen[0][0]._jdf.queryExecution().optimizedPlan().toString() and seen[0][1]["stored"]
