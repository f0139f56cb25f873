"""Model plans. Models are fitted on the
chronological train split of the readings table; these plans have no SQL
oracle (rows-only check) and are covered by invariant tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import comparison as CM
from ..models import iforest as IF
from ..models import supervised as SV
from ..operators import evaluate as EV
from ..operators import explain as XP
from ..operators import sampling as SP
from ..operators import timeseries as TS
from ..session import written
from .profiling import READING_SOURCES, labelled_readings
from .registry import register

FEATURES = ["margin", "c_acctbal", "s_acctbal", "l_extendedprice"]
KEY = ["l_orderkey", "l_linenumber", "l_extendedprice", "margin"]
ORDER = ["ts", "l_orderkey", "l_linenumber", "l_extendedprice", "margin"]
LABEL = "anomaly_label"
DEFAULT = dict(n_estimators=100)
#: Contaminations of the sensitivity table (fixed values).
CONTAMINATIONS = [0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07, 0.08, 0.10]
TUNED = dict(n_estimators=300, max_samples=0.9, max_features=0.5, contamination=0.02)


def split_readings(spark, sf, columns=None):
    """The readings (their ``columns``) with their chronological split, joined and written once (the
    boundaries, fits and scorings read them many times) in as many parts as a shuffle has, dealt by key."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    r = labelled_readings(spark, sf)
    return TS.time_split(written(r.select(*columns or r.columns).repartition(parts, *KEY)), ORDER)


def forest_readings(spark, sf):
    """The columns that the isolation forests and their metrics read. Forests don't depend on how rows
    are dealt, so lineitem is dealt once, by order, before the joins, and not again after them."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    r = labelled_readings(spark, sf, parts)
    return TS.time_split(written(r.select(*dict.fromkeys([*ORDER, *FEATURES, LABEL]))), ORDER)


def _params(**kw):
    return IF.IsolationForestParams(FEATURES, KEY, **kw)


def _metrics(scored):
    """Score once: aggregate (split, score, label, pred) multiplicities, cut the
    lineage, then confusion metrics and AUC both read that table."""
    agg = scored.groupBy("split", "score", LABEL, "pred").agg(F.count(F.lit(1)).alias("_w")).checkpoint(eager=True)
    m = EV.binary_metrics(agg, LABEL, "pred", "split", weight="_w") \
        .select("split", "tn", "fp", "fn", "tp", "precision", "recall", "f1")
    auc = EV.roc_auc(agg, LABEL, "score", "split", weight="_w")
    return m.join(auc, "split")


@register("iforest_default_metrics")
def iforest_default_metrics(spark, sf):
    """ML8 + EV1 — default forest (100 trees, ψ = 256, threshold .5), metrics per split."""
    s = forest_readings(spark, sf)
    model = IF.fit(s.filter("split = 'train'"), _params(**DEFAULT))
    return _metrics(model.transform(s))


@register("iforest_tuned_metrics")
def iforest_tuned_metrics(spark, sf):
    """ML8 + EV1 — tuned forest (300 trees of .9 n rows, half the features, contamination .02)."""
    s = forest_readings(spark, sf)
    # all rows are scored once, other splits being a fold that no tree is grown from; the threshold and the metrics read the narrow result
    params = _params(fold=1, **TUNED)
    grown, scored = IF.grow_and_score(s.withColumn("_held", (F.col("split") != "train").cast("int")), [params], [(0, params)], ["split", LABEL], fold="_held")
    scored = IF.written(scored)
    limit = IF.thresholds(scored.filter("split = 'train'"), grown, [TUNED["contamination"]])[0]
    score = F.col("_scores")[0]
    return _metrics(scored.select("split", LABEL, score.alias("score"), (score > limit).cast("int").alias("pred")))


def _fitted(spark, sf, **kw):
    s = forest_readings(spark, sf)
    return s, IF.fit(s.filter("split = 'train'"), _params(**(kw or DEFAULT)))


@register("iforest_split_importance")
def iforest_split_importance(spark, sf):
    """XP1 — split counts per feature from the node table."""
    _, model = _fitted(spark, sf)
    return IF.split_importance(model)


@register("iforest_tree_convergence")
def iforest_tree_convergence(spark, sf):
    """XP8 — precision, recall and F1 on validation of the first 50 to 500 trees, contamination .05."""
    s, model = _fitted(spark, sf, n_estimators=500)
    return IF.tree_convergence(model, s.filter("split = 'train'"), s.filter("split = 'validation'"), LABEL, [50, 100, 150, 200, 300, 400, 500])


@register("iforest_contamination_sweep")
def iforest_contamination_sweep(spark, sf):
    """ML18 — contamination sweep on the forest's scores (thresholds from train)."""
    s, model = _fitted(spark, sf)
    scored = model.transform(s)
    return EV.sweep_contamination(scored.filter("split = 'validation'"), "score", LABEL, CONTAMINATIONS,
                                  fit_on=scored.filter("split = 'train'"))


@register("iforest_permutation_importance")
def iforest_permutation_importance(spark, sf):
    """XP2 — F1 drop under permutation, 10 repeats, on validation."""
    s, model = _fitted(spark, sf)
    return XP.permutation_importance(s.filter("split = 'validation'"), model, FEATURES, LABEL, KEY, repeats=10)


@register("iforest_partial_dependence")
def iforest_partial_dependence(spark, sf):
    """XP3 — partial dependence on 50 grid points between p5 and p95."""
    s, model = _fitted(spark, sf)
    return XP.partial_dependence(s.filter("split = 'validation'"), model, FEATURES, grid=50)


@register("iforest_shapley")
def iforest_shapley(spark, sf):
    """XP4 — exact interventional Shapley importance (mean |φ|, 25 background rows) on validation."""
    s, model = _fitted(spark, sf)
    return XP.shapley_importance(s.filter("split = 'validation'"), model, FEATURES, KEY)


@register("iforest_local_surrogate")
def iforest_local_surrogate(spark, sf):
    """XP5 — local linear surrogates for the five highest-scoring test rows (the top-k is the feature)."""
    s, model = _fitted(spark, sf)
    test = model.transform(s.filter("split = 'test'"))
    top = test.orderBy(F.desc("score"), *KEY).limit(5).drop("score", "pred")
    scale = s.agg(*[F.stddev_samp(f).alias(f) for f in FEATURES]).first().asDict()
    return XP.local_surrogate(top, model.transform, FEATURES, KEY, scale, n=1000)


@register("iforest_ablation")
def iforest_ablation(spark, sf):
    """XP6 — validation F1 with each feature dropped."""
    s = forest_readings(spark, sf)
    return XP.ablation(s.filter("split = 'train'"), s.filter("split = 'validation'"), FEATURES, LABEL,
                       _params(n_estimators=200, contamination=0.05))


@register("iforest_seed_stability")
def iforest_seed_stability(spark, sf):
    """XP7 — test F1 across 10 seeds (mean, std, min, max, status)."""
    s = forest_readings(spark, sf)
    return XP.seed_stability(s.filter("split = 'train'"), s.filter("split = 'test'"), LABEL, _params(**DEFAULT), list(range(10)))


@register("iforest_cross_split")
def iforest_cross_split(spark, sf):
    """XP7 — generalisation table (train / validation / test)."""
    s, model = _fitted(spark, sf)
    return XP.cross_split(model.transform(s), LABEL)


@register("iforest_noise_robustness")
def iforest_noise_robustness(spark, sf):
    """XP9 — F1 under Gaussian noise σ ∈ {.01, .05, .1, .2} and single-feature σ = .1, on test."""
    s, model = _fitted(spark, sf)
    return XP.noise_robustness(s.filter("split = 'test'"), model.transform, FEATURES, LABEL, KEY)


@register("iforest_search")
def iforest_search(spark, sf):
    """ML15 — 30 shuffled draws of the 288-point grid, validation F1."""
    s = forest_readings(spark, sf)
    grid = {"n_estimators": [100, 200, 300], "max_samples": [0.5, 0.7, 0.9, "auto"], "contamination": [0.01, 0.02, 0.03, 0.05],
            "max_features": [0.5, 0.7, 1.0], "bootstrap": [True, False]}
    return SV.iforest_search(spark, s.filter("split = 'train'"), s.filter("split = 'validation'"), LABEL, _params(), grid, n=30)


@register("iforest_learning_curve")
def iforest_learning_curve(spark, sf):
    """EV17 — ten training sizes by five stratified folds: F1 on the rows trained on and on the held-out fold."""
    s = forest_readings(spark, sf)
    return SV.learning_curve(s.filter("split = 'train'"), LABEL, _params(n_estimators=100, contamination=0.05), KEY)


# ---------------------------------------------------------------------------
# supervised models
# ---------------------------------------------------------------------------

SUP_FEATURES = ["l_quantity", "l_discount", "l_tax", "o_totalprice", "c_acctbal", "s_acctbal"]


def _train_val(spark, sf):
    s = split_readings(spark, sf)
    return s.filter("split = 'train'"), s.filter("split = 'validation'")


@register("classifier_comparison")
def classifier_comparison(spark, sf):
    """ML1, ML3–ML7, ML9, ML12 — times, validation and training metrics and their gap per classifier."""
    train, val = _train_val(spark, sf)
    wtrain = SP.with_class_weight(train, LABEL, "w")
    f = SUP_FEATURES

    class _Dummy:
        plain = True

        def __init__(self, tr):
            self.tr = tr

        def transform(self, df):
            return SV.dummy_predict(self.tr, df, LABEL, "most_frequent")

    models = {
        "dummy_most_frequent": lambda tr: _Dummy(tr),
        "logistic_balanced": lambda tr: SV.fit_logistic(wtrain, f, LABEL, weight_col="w"),
        "decision_tree": lambda tr: SV.fit_tree(tr, f, LABEL, depth=10),
        "random_forest": lambda tr: SV.fit_forest(wtrain, f, LABEL, trees=100, depth=10, weight_col="w"),
        "gradient_boosting": lambda tr: SV.fit_gbt(tr, f, LABEL, rounds=20),
        "adaboost": lambda tr: SV.fit_adaboost(tr, f, LABEL, rounds=10),
        "mlp": lambda tr: SV.fit_mlp(tr, f, LABEL, hidden=(16, 8), max_iter=50),
    }
    return CM.compare_classifiers(models, train, val, f, LABEL)


@register("model_table_readings")
def model_table_readings(spark, sf):
    """CMP1 — forests (tuned, default), random forest and AdaBoost with times, test metrics and leakage flag."""
    s = split_readings(spark, sf)
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    both = [*FEATURES, *[x for x in SUP_FEATURES if x not in FEATURES]]

    def weighted(tr, feats):
        return SV.fit_forest(SP.with_class_weight(tr, LABEL, "w"), feats, LABEL, trees=100, depth=10, weight_col="w")

    runs = [CM.ModelRun("Isolation Forest (Tuned)", "Unsupervised", "Raw_Only", FEATURES, lambda tr: IF.fit(tr, _params(**TUNED))),
            CM.ModelRun("Isolation Forest (Default)", "Unsupervised", "Raw_Only", FEATURES, lambda tr: IF.fit(tr, _params(**DEFAULT))),
            CM.ModelRun("Random Forest (Raw_Only)", "Supervised", "Raw_Only", FEATURES, lambda tr: weighted(tr, FEATURES)),
            CM.ModelRun("AdaBoost", "Supervised", "Main_Plus_Raw", both, lambda tr: SV.fit_adaboost(tr, both, LABEL, rounds=10))]
    return CM.model_table(runs, train, test, LABEL, READING_SOURCES)


@register("regressor_comparison")
def regressor_comparison(spark, sf):
    """ML1, ML2, ML4–ML7, ML12 — regressors of l_extendedprice: errors on both splits, gap and diagnosis."""
    train, val = _train_val(spark, sf)
    f = ["l_quantity", "l_discount", "l_tax", "o_totalprice"]
    t = "l_extendedprice"

    class _Mean:
        plain = True

        def __init__(self, tr):
            self.tr = tr

        def transform(self, df):
            return SV.dummy_predict(self.tr, df, t, "mean")

    models = {
        "dummy_mean": lambda tr: _Mean(tr),
        "linear": lambda tr: SV.fit_linear(tr, f, t),
        "ridge": lambda tr: SV.fit_linear(tr, f, t, l2=1.0),
        "lasso": lambda tr: SV.fit_linear(tr, f, t, l1=0.001),
        "decision_tree": lambda tr: SV.fit_tree(tr, f, t, depth=10, classification=False),
        "random_forest": lambda tr: SV.fit_forest(tr, f, t, trees=100, depth=10, classification=False),
        "gradient_boosting": lambda tr: SV.fit_gbt(tr, f, t, rounds=20, classification=False),
        "adaboost": lambda tr: SV.fit_adaboost_regressor(tr, f, t, rounds=10),
    }
    return CM.compare_regressors(models, train, val, f, t)


@register("linear_residuals")
def linear_residuals(spark, sf):
    """ML10 — residual summary of the linear fit."""
    train, val = _train_val(spark, sf)
    f = ["l_quantity", "l_discount", "l_tax"]
    m = SV.fit_linear(train, f, "l_extendedprice")
    r = SV.residuals(val, m, f, "l_extendedprice")
    return r.agg(F.count("residual").alias("n"), F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"))


@register("feature_set_comparison")
def feature_set_comparison(spark, sf):
    """ML13 — the same balanced forest on four feature sets, validation and test metrics."""
    s = split_readings(spark, sf)
    raw, main = ["l_quantity", "l_discount", "l_tax"], ["o_totalprice", "c_acctbal", "s_acctbal"]
    sets = {"Raw_Only": raw, "Main_Only": main, "Main_Plus_Raw": main + raw, "Top_Main_Plus_Raw": ["c_acctbal", "s_acctbal", *raw]}
    train = SP.with_class_weight(s.filter("split = 'train'"), LABEL, "w").checkpoint()
    return SV.compare_feature_sets(spark, sets, train, s.filter("split <> 'train'"), LABEL,
                                   lambda tr, feats: SV.fit_forest(tr, feats, LABEL, trees=100, depth=10, weight_col="w", minInstancesPerNode=2))


@register("forest_random_search")
def forest_random_search(spark, sf):
    """ML14 — 30 seeded draws of the 324-point grid, best validation F1 first."""
    train, val = _train_val(spark, sf)
    grid = {"trees": [100, 200, 300], "depth": [10, 15, 20, None], "minRowsToSplit": [2, 5, 10], "minInstancesPerNode": [1, 2, 4],
            "classWeight": ["balanced", "balanced_subsample", None]}
    return SV.random_search(spark, train, val, SUP_FEATURES, LABEL, grid, n=30)


@register("class_weight_sweep")
def class_weight_sweep(spark, sf):
    """ML17 — positive-class weight sweep on the logistic model."""
    train, val = _train_val(spark, sf)
    return SV.sweep_class_weight(spark, train, val, SUP_FEATURES, LABEL, [None, 3, 5, 10, 20])


@register("multiclass_gbt_orders")
def multiclass_gbt_orders(spark, sf):
    """ML6 (3 classes, one-vs-rest) + SC7 + EV6 — price class of orders from train quantiles."""
    from ..functions.scalar import quantile_class
    from ..plans.registry import table

    o = TS.time_split(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"])  # a scan: cheap to read again
    o = o.withColumn("days", F.datediff(F.col("o_orderdate"), F.lit("1992-01-01")).cast("double")) \
        .withColumn("prio", F.substring("o_orderpriority", 1, 1).cast("double"))
    from ..operators.core import quantile_values

    qv = quantile_values(o.filter("split = 'train'"), ["o_totalprice"], [0.33, 0.67])
    lo, hi = qv[("o_totalprice", 0.33)], qv[("o_totalprice", 0.67)]
    o = o.withColumn("price_class", quantile_class("o_totalprice", lo, hi).cast("double"))
    train, val = o.filter("split = 'train'"), o.filter("split = 'validation'")
    m = SV.fit_gbt(train, ["days", "prio", "o_custkey"], "price_class", rounds=10, classes=3)
    from ..operators.quality import assemble

    pred = m.transform(assemble(val, ["days", "prio", "o_custkey"])).withColumn("p", F.col("prediction").cast("int")) \
        .withColumn("y", F.col("price_class").cast("int"))
    return EV.multiclass_metrics(pred, "y", "p")
