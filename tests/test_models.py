"""Isolation forest and supervised wrappers (rows-only items): determinism, quality floors, persistence."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MEDIUM
from stokehold.models import iforest as IF
from stokehold.operators import evaluate as EV
from stokehold.plans.modelling import FEATURES, KEY, LABEL, split_readings


@pytest.fixture(scope="module")
def splits(spark):
    return split_readings(spark, SF_MEDIUM).cache()


def test_c_factor():
    assert IF.c_factor(1) == 0.0 and IF.c_factor(2) == 1.0
    assert IF.c_factor(256) == pytest.approx(2 * (np.log(255) + 0.5772156649015329) - 2 * 255 / 256)


def test_forest_is_partitioning_independent(spark, splits):
    p = IF.IsolationForestParams(FEATURES, KEY, n_estimators=20)
    train = splits.filter("split = 'train'")
    a = IF.fit(train.repartition(3), p).nodes.orderBy("tree", "node").toPandas()
    b = IF.fit(train.repartition(13), p).nodes.orderBy("tree", "node").toPandas()
    assert a.equals(b)


def test_scores_rank_planted_anomalies(spark, splits):
    p = IF.IsolationForestParams(["value"], ["event_id"], n_estimators=50)
    from stokehold.plans.registry import table

    e = table(spark, SF_MEDIUM, "events")
    # rows far outside the bulk of the data must score highest
    planted = e.withColumn("value", F.when(F.col("event_id") % 500 == 0, F.lit(5000.0)).otherwise(F.col("value"))) \
        .withColumn("y", (F.col("event_id") % 500 == 0).cast("int"))
    m = IF.fit(planted, p)
    auc = EV.roc_auc(m.transform(planted), "y", "score").first()["roc_auc"]
    assert auc > 0.99


def test_contamination_threshold_flags_share(spark, splits):
    p = IF.IsolationForestParams(FEATURES, KEY, n_estimators=30, contamination=0.05)
    train = splits.filter("split = 'train'")
    m = IF.fit(train, p)
    share = m.transform(train).agg(F.avg("pred")).first()[0]
    assert share == pytest.approx(0.05, abs=0.01)


def test_save_and_load(spark, splits):
    p = IF.IsolationForestParams(FEATURES, KEY, n_estimators=10)
    train = splits.filter("split = 'train'")
    m = IF.fit(train, p)
    d = tempfile.mkdtemp(prefix="stokehold-model-")
    m.save(os.path.join(d, "m"))
    m2 = IF.IsolationForestModel.load(spark, os.path.join(d, "m"))
    a = m.transform(train).select("score").toPandas()["score"].to_numpy()
    b = m2.transform(train).select("score").toPandas()["score"].to_numpy()
    assert np.allclose(a, b)


def test_split_importance_covers_features(spark, splits):
    m = IF.fit(splits.filter("split = 'train'"), IF.IsolationForestParams(FEATURES, KEY, n_estimators=10))
    imp = IF.split_importance(m).toPandas()
    assert set(imp["feature"]) <= set(FEATURES)
    assert imp["share"].sum() == pytest.approx(1.0)


def test_linear_recovers_coefficients(spark):
    from stokehold.models.supervised import fit_linear

    df = spark.range(2000).select(F.col("id").cast("double").alias("x"),
                                  (F.col("id") % 7).cast("double").alias("z"))
    df = df.withColumn("y", 3.0 * F.col("x") - 2.0 * F.col("z") + 5.0)
    m = fit_linear(df, ["x", "z"], "y")
    assert list(m.coefficients) == pytest.approx([3.0, -2.0], abs=1e-6)
    assert m.intercept == pytest.approx(5.0, abs=1e-4)


@pytest.mark.parametrize("bootstrap", [False, True])
def test_forest_grown_by_levels_equals_whole_trees(spark, splits, bootstrap):
    """Tops by levels and units in tasks give the trees that one task would grow."""
    train = splits.filter("split = 'train'")
    p = IF.IsolationForestParams(FEATURES, KEY, n_estimators=4, max_samples=0.5, max_features=0.5, bootstrap=bootstrap)
    whole, cut = (IF.grow_forests(train, [p], unit_rows=u) for u in (1 << 20, 3000))
    assert all(not s for s in whole.tops.splits) and any(cut.tops.splits)
    cols = ["tree", "node", "feature", "threshold", "leaf", "depth"]
    a, b = (g.model().nodes.select(*cols).orderBy("tree", "node").toPandas() for g in (whole, cut))
    assert a.equals(b)
    scores = [g.scores(train.limit(500), KEY).orderBy(*KEY).select(F.col("_scores")[0]).toPandas() for g in (whole, cut)]
    assert scores[0].equals(scores[1])


def test_samples_are_exact_and_sizes_add_up(spark, splits):
    df = spark.range(20_000).select("id", F.sqrt("id").alias("a"), (F.col("id") % 97).cast("double").alias("b"), (F.col("id") % 2).cast("int").alias("fold"))
    g = IF.grow_forests(df, [IF.IsolationForestParams(["a", "b"], ["id"], n_estimators=5, max_samples=0.9),
                             IF.IsolationForestParams(["a"], ["id"], n_estimators=3, max_samples=500),
                             IF.IsolationForestParams(["b"], ["id"], n_estimators=2, max_samples=0.5, fold=1)], fold="fold")
    assert g.psi == [18_000, 500, 5_000] and g.n_train == [20_000, 20_000, 10_000]
    for f, psi in enumerate(g.psi):
        nodes = g.model(f).nodes.toPandas()
        roots = nodes[nodes.node == 1]
        assert (roots["size"] == psi).all() and len(roots) == g.params[f].n_estimators
        # every split's rows are its children's
        kids = nodes.merge(nodes, left_on=["tree", "left"], right_on=["tree", "node"], suffixes=("", "_l")).merge(
            nodes, left_on=["tree", "right"], right_on=["tree", "node"], suffixes=("", "_r"))
        assert (kids["size"] == kids["size_l"] + kids["size_r"]).all() and len(kids) == (~nodes.leaf).sum()
    assert set(g.model(1).nodes.filter("not leaf").select("feature").distinct().toPandas()["feature"]) == {0}


def test_dealt_scores_equal_broadcast_scores(spark, splits, monkeypatch):
    train = splits.filter("split = 'train'")
    p = IF.IsolationForestParams(FEATURES, KEY, n_estimators=30, max_samples=0.2)
    g = IF.grow_forests(train, [p, IF.IsolationForestParams(FEATURES[:2], KEY, n_estimators=10, seed=7)], unit_rows=5000)
    cols = [F.col("_scores")[0].alias("a"), F.col("_scores")[1].alias("b")]
    one = g.scores(train, ["l_orderkey"]).select("l_orderkey", *cols).orderBy("l_orderkey", "a", "b").toPandas()
    two = g._dealt_scores(train, ["l_orderkey"], score_rows=7000).select("l_orderkey", *cols).orderBy("l_orderkey", "a", "b").toPandas()
    assert one.equals(two) and len(one) == train.count()


def test_scores_match_a_walk_of_the_nodes(spark):
    df = spark.range(300).select("id", (F.col("id") * 37 % 101).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    m = IF.fit(df, IF.IsolationForestParams(["a", "b"], ["id"], n_estimators=6, max_samples=64))
    nodes = {(r.tree, r.node): r for r in m.nodes.collect()}
    for r in m.transform(df).collect():
        total = 0.0
        for t in range(6):
            at = nodes[t, 1]
            while not at.leaf:
                at = nodes[t, at.right if r[["a", "b"][at.feature]] >= at.threshold else at.left]
            total += at.path
        assert r.score == pytest.approx(2 ** (-total / 6 / IF.c_factor(64)), rel=1e-12)


def test_adaboost_regression_beats_one_tree(spark):
    from stokehold.models.supervised import fit_adaboost_regressor, fit_tree
    from stokehold.operators.evaluate import regression_metrics
    from stokehold.operators.quality import assemble

    df = spark.range(3000).select((F.col("id") % 100 / 10).alias("x"), (F.col("id") % 37 / 5).alias("z")).withColumn("y", F.sin("x") * 3 + F.col("z"))
    boosted = regression_metrics(fit_adaboost_regressor(df, ["x", "z"], "y", rounds=15).transform(df), "y", "prediction").first()
    single = regression_metrics(fit_tree(df, ["x", "z"], "y", depth=3, classification=False).transform(assemble(df, ["x", "z"])), "y", "prediction").first()
    assert boosted["r2"] > single["r2"]


@pytest.fixture(scope="module")
def small_forest(spark):
    df = spark.range(400).select("id", (F.col("id") * 37 % 101).cast("double").alias("a"), F.sqrt("id").alias("b"), (F.col("id") % 7).cast("double").alias("c"),
                                 (F.col("id") % 50 == 3).cast("int").alias("y"))
    return df, IF.fit(df, IF.IsolationForestParams(["a", "b", "c"], ["id"], n_estimators=12, max_samples=64, contamination=0.1))


def _score_rows(model, spark, rows):
    frame = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "id long, a double, b double, c double")
    return np.array([r.score for r in model.transform(frame).orderBy("id").collect()])


def test_permutation_importance_equals_brute_force(spark, small_forest):
    import random

    from stokehold.functions.random import hash_uniform
    from stokehold.operators import explain as XP

    df, model = small_forest
    features = ["a", "b", "c"]
    got = {r.feature: (r.importance_mean, r.importance_std) for r in XP.permutation_importance(df.repartition(3), model, features, "y", ["id"], repeats=4).collect()}
    rows = df.withColumn("u", hash_uniform("id", seed=42)).orderBy("u", "id").collect()
    x, y = np.array([[r.a, r.b, r.c] for r in rows]), np.array([r.y for r in rows])
    f1 = lambda p: 2 * (p & (y == 1)).sum() / (p.sum() + y.sum())
    base, draw = f1(_score_rows(model, spark, x) > model.threshold), random.Random(42)
    steps = [draw.randrange(1, len(x)) for _ in range(4)]
    for j, f in enumerate(features):
        drops = []
        for s in steps:
            z = x.copy()
            z[:, j] = np.roll(x[:, j], -s)
            drops.append(base - f1(_score_rows(model, spark, z) > model.threshold))
        assert got[f] == pytest.approx((np.mean(drops), np.std(drops, ddof=1)), abs=1e-12)


def test_partial_dependence_and_shapley_equal_brute_force(spark, small_forest):
    import itertools

    from stokehold.operators import explain as XP
    from stokehold.operators.sampling import sample_n

    df, model = small_forest
    features, part = ["a", "b", "c"], df.filter("id < 40")
    x = np.array([[r.a, r.b, r.c] for r in part.collect()])
    for r in XP.partial_dependence(part, model, features, grid=3).collect():
        z = x.copy()
        z[:, features.index(r.feature)] = r.value
        assert r.mean_score == pytest.approx(_score_rows(model, spark, z).mean(), rel=1e-12)
    beside = np.array([[r.a, r.b, r.c] for r in sample_n(part, 5, ["id"]).collect()])

    def value(inside):
        z = np.concatenate([np.where(inside, row, beside) for row in x])
        return _score_rows(model, spark, z).reshape(len(x), len(beside)).mean(axis=1)

    v = {s: value(np.array(s)) for s in itertools.product([False, True], repeat=3)}
    want = {}
    for i, f in enumerate(features):
        phi = np.zeros(len(x))
        for order in itertools.permutations(range(3)):  # the mean gain over all orders of joining
            before = [order.index(k) < order.index(i) for k in range(3)]
            after = [b or k == i for k, b in enumerate(before)]
            phi += (v[tuple(after)] - v[tuple(before)]) / 6
        want[f] = np.abs(phi).mean()
    got = {r.feature: r.mean_abs_shap for r in XP.shapley_importance(part, model, features, ["id"], background=5).collect()}
    assert got == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("psi, depth, d", [(200, 8, 4), (2000, 11, 3), (50, 6, 1)])
def test_walks_for_many_points_equal_one_walk_a_point(psi, depth, d):
    """All points of a feature, and all background rows beside one or two own features, are
    met without a walk for each; values on thresholds, infinite and repeated ones included."""
    from types import SimpleNamespace

    from stokehold.operators import explain as XP

    rng = np.random.default_rng(psi)
    flat, at = {k: [] for k in ("feature", "value", "left", "roots")}, 0
    for t in range(6):
        x = np.round(rng.normal(size=(d, psi)), 1)
        f, v, _ = IF.grow(x, np.ones(psi, int), int(IF._mix(np.uint64(t))), 1, 0, depth, list(range(d)))
        kids, _, v = IF.unfold(f, v, 0)
        for k, a in zip(flat, (f, v, np.where(kids >= 0, kids + at, -1), [at])):
            flat[k].append(a)
        at += len(f)
    calls = []

    class Counted(IF.Walker):
        def __call__(self, x):
            calls.append(x.shape[1])
            return super().__call__(x)

    walk = Counted(SimpleNamespace(value={k: np.concatenate(a) for k, a in flat.items()}), list(range(d))[::-1], list(range(6)), IF.c_factor(psi))
    x = np.round(rng.normal(size=(d, 300)), 1)
    x[0, :3] = np.inf, -np.inf, flat["value"][0][0]
    points = np.array([0.3, -np.inf, np.inf, 0.3, -1.0, flat["value"][0][0], 2.0])
    for j in range(d):
        each = np.stack([walk(np.where(np.arange(d)[:, None] == j, p, x)) for p in points], axis=1)
        assert np.array_equal(walk.varied(x, j, points), each)
    background = np.round(rng.normal(size=(d, 9)), 1)
    plain = XP.shapley_values(x, background, lambda z: walk(z))
    calls.clear()
    assert np.allclose(XP.shapley_values(x, background, walk), plain, atol=1e-12)
    if psi == 200:  # all rows once, and the background beside no own feature
        assert len(calls) == 1 + 9


def test_trees_of_one_salt_share_draws(spark):
    """Forests that differ in fold, share or sample size draw each tree's rows once: samples are
    as each tree alone takes them, and blocks of many batches lose none."""
    p = [IF.IsolationForestParams(["v", "w"], ["id"], n_estimators=3, fold=f, share=s, max_samples=m)
         for f in (None, 0, 1) for s in (0.5, 1.0) for m in (40, 0.9)]
    p.append(IF.IsolationForestParams(["v", "w"], ["id"], n_estimators=3, bootstrap=True, max_samples=0.5))
    df = spark.range(1500).selectExpr("id", "double(id % 97) as v", "double((id * 31) % 41) as w", "int(id % 3) as k", "double((id * 7) % 10) / 10 as s").repartition(5)
    grown = IF.grow_forests(df, p, fold="k", share=F.col("s"))
    rows = IF._numbers(df, ["v", "w"], ["id"], "k", F.col("s")).toPandas()
    h, fold, share = rows["_h"].to_numpy().view(np.uint64), rows["_fold"].to_numpy(), rows["_share"].to_numpy()
    salted = IF._by_salt(grown.trees, range(len(grown.trees)))
    assert len(salted) == 3
    found = dict(IF._sampled(grown.trees, salted, h, fold, share))
    sizes = {r["tree"]: r["size"] for r in grown.units.collect()}
    for t, tree in enumerate(grown.trees):
        alone = tree.copies(h, fold, share)
        assert np.array_equal(np.sort(found[t]), np.flatnonzero(alone)) and sizes[t] == alone.sum()
        if tree.cut is not None:
            assert sizes[t] == grown.psi[t // 3]


def test_large_samples_need_no_more_bins_than_tasks(spark):
    """A row goes to every bin whose trees need it: a forest of large samples has as many bins as tasks run at once, not as a shuffle has parts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(8 * spark.sparkContext.defaultParallelism))
    try:
        df = spark.range(300).selectExpr("id", "double(id % 97) as v")
        grown = IF.grow_forests(df, [IF.IsolationForestParams(["v"], ["id"], n_estimators=10 * spark.sparkContext.defaultParallelism, max_samples=0.9)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(set(grown.bins.values())) == spark.sparkContext.defaultParallelism


def _search_rows(spark):
    df = spark.range(900).selectExpr("id", "double(pmod(hash(id), 97)) as v", "if(id % 50 = 7, cast(null as double), double(id % 41) * 1.5) as w",
                                     "double(pmod(hash(id, 3), 1000)) as x", "int(id % 23 = 0) as y")
    df = df.unionByName(df.filter("id < 60")).repartition(5)  # keys repeat
    return df.filter("id % 4 > 0"), df.filter("id % 4 = 0")


def _search_draws():
    from dataclasses import replace

    base = IF.IsolationForestParams(["v", "w", "x"], ["id"])
    grid = {"n_estimators": [3, 5], "max_samples": [0.5, "auto"], "contamination": [0.05, 0.1], "max_features": [0.4, 0.6, 1.0], "bootstrap": [True, False]}
    from stokehold.models.supervised import grid_draws

    draws = grid_draws(grid, 24)
    return base, grid, draws, [replace(base, **p) for p in draws]


def test_search_equals_forests_grown_alone(spark):
    """Every configuration of the search has the metrics of its own forest, fitted on the training rows alone."""
    from stokehold.models.supervised import iforest_search

    train, val = _search_rows(spark)
    base, grid, draws, params = _search_draws()
    found = {r["trial"]: r for r in iforest_search(spark, train, val, "y", base, grid, n=24).collect()}
    assert len(found) == 24
    for i in (0, 7, 15, 23):
        m = EV.binary_metrics(IF.fit(train, params[i]).transform(val), "y", "pred").first()
        assert found[i]["params"] == str(draws[i])
        assert tuple(found[i][k] for k in ("precision", "recall", "f1")) == tuple(m[k] for k in ("precision", "recall", "f1"))


def test_search_shares_trees_and_keeps_no_nodes(spark, monkeypatch):
    """Shares of features that come to as many have one forest, and trees are walked where they grow: no units are written."""
    from stokehold.models import supervised as SV

    train, val = _search_rows(spark)
    base, grid, _, params = _search_draws()
    seen, grow_and_score = [], IF.grow_and_score
    monkeypatch.setattr(IF, "grow_and_score", lambda *a, **k: seen.append(grow_and_score(*a, **k)) or seen[-1])
    SV.iforest_search(spark, train, val, "y", base, grid, n=24)
    forests, scored = seen[0]
    kinds = {(p.max_samples, IF.feature_count(p), p.bootstrap): 0 for p in params}
    assert len({(p.max_samples, p.max_features, p.bootstrap) for p in params}) > len(kinds)
    for p in params:
        k = (p.max_samples, IF.feature_count(p), p.bootstrap)
        kinds[k] = max(kinds[k], p.n_estimators)
    assert len(forests.trees) == sum(kinds.values()) and forests.units is None
    # more rows than a task holds: the written trees give the same scores
    rows = train.withColumn("_held", F.lit(0)).unionByName(val.withColumn("_held", F.lit(1)))
    p = [IF.IsolationForestParams(["v", "w", "x"], ["id"], n_estimators=4, max_samples=0.5, bootstrap=b, fold=1) for b in (True, False)]
    both = [IF.grow_and_score(rows, p, [(0, p[0]), (1, p[1])], ["id", "_held"], fold="_held", unit_rows=u) for u in (1 << 20, 200)]
    assert both[0][0].units is None and both[1][0].units is not None
    a, b = (sorted((r["id"], r["_held"], *r["_scores"]) for r in x.collect()) for _, x in both)
    assert a == b


def test_a_bin_is_a_task_of_its_own(spark):
    """Bins go to tasks one each, whatever the shuffle's number of parts and however small their blocks."""
    train, _ = _search_rows(spark)
    n = spark.sparkContext.defaultParallelism
    grown = IF.grow_forests(train, [IF.IsolationForestParams(["v", "w", "x"], ["id"], n_estimators=3 * n, max_samples=0.9)])
    bins, d = grown.bins, 3
    blocks = IF._deal(IF._numbers(train, ["v", "w", "x"], ["id"], None, None), grown.trees, grown.tops, bins, d, False)
    held = IF._by_bin(blocks, bins).withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count_distinct("bin").alias("bins")).collect()
    assert len(held) == len(set(bins.values())) == n and all(r["bins"] == 1 for r in held)


def test_forest_readings_shuffle_lineitem_once(spark):
    """Orders meet customers before lineitem, whose one shuffle is by order."""
    from stokehold.plans.profiling import labelled_readings

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = labelled_readings(spark, SF_MEDIUM, 8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # lineitem by order and by supplier; orders by customer and by order; customer; supplier
    assert plan.count("Exchange hashpartitioning") == 6
    assert plan.count("hashpartitioning(l_orderkey") == 1 and plan.count("hashpartitioning(o_custkey") == 1


def test_forest_importance_reads_dealt_rows(spark, monkeypatch):
    """The readings reach the importance forest in as many parts as tasks, though broadcast joins leave them in the parts of the file."""
    from stokehold.plans import series

    seen = []
    monkeypatch.setattr(series.FE, "rf_importance", lambda df, *a, **kw: seen.append(df) or df)
    series.rf_importance_readings(spark, SF_MEDIUM)
    assert len([f for f in seen[0].inputFiles()]) >= spark.sparkContext.defaultParallelism


def test_multiclass_metrics_read_the_predictions_once(spark):
    """Class, precision, recall and support come from one pass over the scored rows, nulls included."""
    seen = spark.sparkContext.accumulator(0)
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (None, 1), (2, None)]

    def score(p):
        seen.add(1)
        return p

    df = spark.createDataFrame(rows, "y int, p0 int").select("y", F.udf(score, "int")("p0").alias("p"))
    found = {r["class"]: r for r in EV.multiclass_metrics(df, "y", "p").collect()}
    assert seen.value == len(rows)
    assert set(found) == {None, "0", "1", "2", "macro avg", "weighted avg"}
    assert (found["0"]["support"], found["0"]["precision"], found["0"]["recall"]) == (2, 0.5, 0.5)
    assert (found["1"]["support"], found["1"]["precision"], found["1"]["recall"]) == (2, 0.5, 1.0)
    assert (found["2"]["support"], found["2"]["precision"]) == (2, 0.0)


def test_forests_keep_node_ids_between_levels(spark):
    """Rows aren't walked from the root at every level, and the trees are those of the walks."""
    from stokehold.models import supervised as SV

    df = spark.range(600).selectExpr("double(id % 37) as a", "double(id * 7 % 101) as b", "int(id % 37 > 20 and id * 7 % 101 > 30) as y")
    trees = {}
    for kept in (None, False):
        m = SV.fit_forest(df, ["a", "b"], "y", trees=8, depth=6, **({} if kept is None else {"cacheNodeIds": kept}))
        assert m.getOrDefault("cacheNodeIds") is (kept is None)
        trees[kept] = [t.toDebugString.split("\n", 1)[1] for t in m.trees]
    assert trees[None] == trees[False]


def _labelled(spark, n=3000, parts=3):
    return spark.range(n).selectExpr("id", "double(id % 37) as a", "double(id * 7 % 101) as b", "double(xxhash64(id) % 1000) as c",
                                     "int(id % 37 > 20 and id * 7 % 101 > 30) as y", "double(id % 37 + id % 5) as v").repartition(parts)


def _trees(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


@pytest.mark.parametrize("classification", [True, False])
def test_random_forests_do_not_depend_on_how_rows_are_dealt(spark, classification):
    """Bootstrap counts are drawn by row, not by partition, and nothing is kept for each row and tree."""
    from stokehold.models import supervised as SV

    label = "y" if classification else "v"
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    fits = [SV.fit_forest(_labelled(spark, parts=p), ["a", "b", "c"], label, trees=6, depth=5, classification=classification) for p in (2, 5)]
    assert _trees(fits[0]) == _trees(fits[1])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


@pytest.mark.parametrize("classification", [True, False])
def test_random_forests_by_levels_equal_those_grown_whole(spark, classification):
    from stokehold.models import forest

    df = _labelled(spark)
    packed = forest.pack(df, ["a", "b", "c"], "y" if classification else "v", classification)
    for rules in (forest.Rules(2, "gini" if classification else "variance", min_leaf=3, depth=6), forest.Rules(1, "gini" if classification else "variance", depth=None)):
        whole, levels = (forest.grow_trees(packed, 4, 7, rules, forest.Copies(True, 1.0), u) for u in (1 << 22, 100))
        for a, b in zip(whole, levels):
            assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and np.allclose(a.stats, b.stats)
            assert a.stats[a.feature < 0][:, -1].min() >= rules.min_leaf


def test_histogram_tree_is_the_trees_of_mllib(spark):
    """Without a bootstrap, on all features and few values, both have one answer."""
    from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier

    from stokehold.models import forest
    from stokehold.operators.quality import assemble

    df = _labelled(spark).withColumn("b", F.col("b") % 20).withColumn("w", F.when(F.col("y") == 1, 2.5).otherwise(0.5))
    theirs = DecisionTreeClassifier(labelCol="y", weightCol="w", maxDepth=6).fit(assemble(df, ["a", "b"]))
    ours = forest.fit(RandomForestClassifier(labelCol="y", weightCol="w", maxDepth=6, numTrees=1, bootstrap=False, featureSubsetStrategy="all"), df, ["a", "b"])
    a, b = (m.transform(assemble(df, ["a", "b"])).orderBy("id").select("probability", "prediction").collect() for m in (theirs, ours))
    assert a == b
    assert np.allclose(theirs.featureImportances.toArray(), ours.featureImportances.toArray())


def test_boosting_writes_no_weights(spark):
    """Weights are expressions of the trees before; members and votes are those of MLlib's trees."""
    import os

    from stokehold.models import supervised as SV
    from stokehold.operators.quality import assemble

    df = _labelled(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = {x for x in os.listdir(folder) if x.startswith("rdd-")}
    model = SV.fit_adaboost(df, ["a", "b", "c"], "y", rounds=4)
    SV.fit_adaboost_regressor(df, ["a", "b", "c"], "v", rounds=3)
    assert {x for x in os.listdir(folder) if x.startswith("rdd-")} == before
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    votes = {i: 0.0 for i in got}
    for m, a in zip(model.members, model.alphas):
        for r in m.transform(assemble(df, ["a", "b", "c"])).select("id", "prediction").collect():
            votes[r["id"]] += a if r["prediction"] == 1.0 else -a
    assert all(got[i] == float(v > 0) for i, v in votes.items())


def test_growing_gives_the_paths_of_its_rows(spark):
    """Rows of a sample needn't be walked: they end in the leaf that they grew, equal rows and copies included."""
    rng = np.random.default_rng(1)
    x = np.stack([rng.integers(0, 6, 4000).astype(float), rng.normal(size=4000), np.zeros(4000)])
    for copies, limit in ((np.ones(4000, np.int64), 12), (rng.integers(1, 4, 4000), 5)):
        ends = np.full(4000, -1.0)
        feature, value, _ = IF.grow(x, copies, 77, 1, 0, limit, [0, 1, 2], ends)
        left, _, value = IF.unfold(feature, value, 0)
        assert (ends == IF.paths(x, feature, value, left)).all()


@pytest.mark.parametrize("bootstrap", [False, True])
def test_large_forests_keep_no_nodes_and_score_the_same(spark, monkeypatch, bootstrap):
    train, val = _search_rows(spark)
    p = IF.IsolationForestParams(["v", "w", "x"], ["id"], n_estimators=9, max_samples=0.9, contamination=0.05, bootstrap=bootstrap)
    kept = IF.fit(train, p)
    monkeypatch.setattr(IF, "KEPT_ROWS", 10)
    monkeypatch.setattr(IF, "WHOLE_ROWS", train.count() + val.count())  # the training rows aren't held twice
    again = IF.fit(train, p)
    assert kept.forests.units is not None and again.forests.units is None
    a, b = (sorted((r["id"], r["score"], r["pred"]) for r in m.transform(val).collect()) for m in (kept, again))
    assert a == b and kept.threshold == again.threshold
    assert sorted(map(tuple, IF.split_importance(kept).collect())) == sorted(map(tuple, IF.split_importance(again).collect()))


def test_tasks_read_all_blocks_without_a_shuffle(spark):
    from stokehold.models.forest import every_block
    from stokehold.session import written

    whole = every_block(written(spark.range(100).repartition(4)), 5)
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    held = whole.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("id").alias("n"), F.count_distinct("task").alias("t")).collect()
    assert len(held) == 5 and all((r["n"], r["t"]) == (100, 1) for r in held)


def _forest_draws():
    from stokehold.models.supervised import grid_draws

    grid = {"trees": [3, 5], "depth": [2, 4, None], "minRowsToSplit": [2, 40], "minInstancesPerNode": [1, 4], "classWeight": ["balanced", "balanced_subsample", None]}
    return grid, grid_draws(grid, 20)


def test_forest_search_equals_forests_grown_alone(spark):
    """Each draw has the metrics of its own forest, also of more rows than a task holds; draws of other cuts share their trees."""
    from stokehold.models import forest, supervised as SV

    df = _labelled(spark).withColumn("y", F.when(F.col("id") % 11 == 0, 1 - F.col("y")).otherwise(F.col("y")))
    train, val = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    grid, draws = _forest_draws()
    kinds = [forest.Draw(**p) for p in draws]
    few, many = (sorted(map(tuple, forest.search(train, val, ["a", "b", "c"], "y", kinds, unit_rows=u).collect())) for u in (1 << 22, 200))
    assert few == many and len(few) == 20
    alone = [forest.search(train, val, ["a", "b", "c"], "y", [k]).drop("trial").first() for k in kinds[:6]]
    assert [tuple(r) for r in alone] == [r[1:] for r in few[:6]]
    # MLlib's model of the same forest
    model = SV.fit_forest(train, ["a", "b", "c"], "y", trees=5, depth=4, minInstancesPerNode=4)
    m = SV.evaluate_classifier(model, val, ["a", "b", "c"], "y")
    got = forest.search(train, val, ["a", "b", "c"], "y", [forest.Draw(5, 4, 4), forest.Draw(3, None, 4)]).filter("trial = 0").first()
    assert tuple(got[1:]) == tuple(m[k] for k in ("tn", "fp", "fn", "tp"))
    rows = SV.random_search(spark, train, val, ["a", "b", "c"], "y", grid, n=20).collect()
    assert [r["f1"] for r in rows] == sorted((r["f1"] for r in rows), reverse=True) and {r["params"] for r in rows} == {str(p) for p in draws}


def test_the_whole_forest_search_is_run(spark, monkeypatch):
    """30 draws of the published grid of 324 points."""
    from stokehold.models import supervised as SV
    from stokehold.plans import modelling

    seen = []
    monkeypatch.setattr(SV, "random_search", lambda *a, **k: seen.append((a, k)))
    modelling.forest_random_search(spark, SF_MEDIUM)
    grid = seen[0][0][-1]
    assert len(SV.grid_draws(grid, 1000)) == 324 and seen[0][1]["n"] == 30


def test_learning_curve_walks_only_rows_that_count(spark, monkeypatch):
    """Rows of other folds beyond a forest's share are not scored for it; the others have the scores of a walk of all."""
    df = _labelled(spark, 1200).withColumn("k", (F.col("id") % 3).cast("int")).withColumn("s", (F.col("id") % 10) / 10)
    params = [IF.IsolationForestParams(["a", "b"], ["id"], n_estimators=5, fold=f, share=s) for f in range(3) for s in (0.2, 0.7)]
    grown = IF.grow_forests(df, params, fold="k", share=F.col("s"))
    every, own = ({r["id"]: (r["k"], r["s"], r["_scores"]) for r in grown.scores(df, ["id", "k", "s"], o).collect()} for o in (None, ("k", "s")))
    skipped = 0
    for i, (k, s, scores) in every.items():
        for p, a, b in zip(params, scores, own[i][2]):
            if k == p.fold or s < p.share:
                assert a == b
            else:
                skipped += a != b
    assert skipped > 1000


def test_thresholds_are_exact_quantiles_of_each_forest(spark, monkeypatch):
    """Two passes over binned scores, ties, nulls and a bin with too many scores included."""
    from stokehold.operators.core import order_statistics

    df = spark.range(5000).selectExpr("array(double(pmod(xxhash64(id), 1000)) / 1000, if(id % 3 = 0, null, 0.5 + double(id % 7) * 1e-9), 1.0D) as _scores").repartition(4)
    want = []
    for i, share in enumerate((0.05, 0.3, 0.1)):
        v = np.sort(np.array([r[0] for r in df.select(F.col("_scores")[i]).collect() if r[0] is not None]))
        want.append(float(np.quantile(v, 1 - share)))
    from stokehold.operators import core

    slow = []
    monkeypatch.setattr(core, "order_statistics", lambda *a: slow.append(1) or order_statistics(*a))
    assert np.allclose(IF.thresholds(df, None, [0.05, 0.3, 0.1]), want, rtol=0, atol=1e-12) and not slow
    monkeypatch.setattr(IF, "SORTED_ROWS", 10)
    assert np.allclose(IF.thresholds(df, None, [0.05, 0.3, 0.1]), want, rtol=0, atol=1e-12) and slow
