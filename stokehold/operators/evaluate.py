"""Scoring evaluation (EV*, TK4–5, ML18) over a scored table
(key, ts, split, label, score, pred, features).

Counts are ``count_if`` aggregates; curve and rank metrics are computed on the
table of distinct scores per group (pre-aggregated), ordered with the
range-sorted row index — never a window over the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .core import ROW_INDEX, c, checked_broadcast, running_sums, with_row_index


def _group(by: str | None) -> list[Column]:
    return [c(by).alias(by)] if by else []


# ---------------------------------------------------------------------------
# score transforms (EV2, EV3)
# ---------------------------------------------------------------------------

def normalize_score(df: DataFrame, score: str, by: str | None = None, eps: float = 1e-10, name: str = "prob") -> DataFrame:
    """EV2 — min–max normalise the score per evaluated set, clipped to [eps, 1−eps]."""
    rng = df.groupBy(*_group(by)).agg(F.min(c(score)).alias("_lo"), F.max(c(score)).alias("_hi"))
    j = df.join(checked_broadcast(rng, 100_000), by) if by else df.crossJoin(F.broadcast(rng))
    p = (c(score) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    return j.withColumn(name, F.greatest(F.least(p, F.lit(1 - eps)), F.lit(eps))).drop("_lo", "_hi")


def threshold_residual(df: DataFrame, score: str, q: float = 0.98, name: str = "residual") -> DataFrame:
    """EV3 — threshold at the q-th percentile (linear), residual = score − threshold."""
    from .core import quantile_values

    t = quantile_values(df, [score], [q])[(score, float(q))]
    return df.withColumn("threshold", F.lit(t).cast("double")).withColumn(name, c(score) - F.col("threshold"))


# ---------------------------------------------------------------------------
# confusion-based metrics (EV4, EV5, EV9, EV19, EV20)
# ---------------------------------------------------------------------------

def confusion_counts(df: DataFrame, label: str, pred: str, by: str | Column | None = None, name: str | None = None,
                     weight: str | None = None) -> DataFrame:
    """tn/fp/fn/tp per group; ``weight`` sums a multiplicity column (pre-aggregated input)."""
    g = []
    if by is not None:
        g = [by.alias(name or "group")] if isinstance(by, Column) else [c(by).alias(by)]

    def cnt(cond):
        return F.count_if(cond) if weight is None else F.sum(F.when(cond, c(weight)).otherwise(0)).cast("long")

    return df.groupBy(*g).agg(
        cnt((c(label) == 0) & (c(pred) == 0)).alias("tn"), cnt((c(label) == 0) & (c(pred) == 1)).alias("fp"),
        cnt((c(label) == 1) & (c(pred) == 0)).alias("fn"), cnt((c(label) == 1) & (c(pred) == 1)).alias("tp"))


def _safe(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """EV5 + EV9 — accuracy, precision, recall, F1 (0 on zero division), specificity,
    FPR/FNR, MCC and Cohen κ from tn/fp/fn/tp columns."""
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    precision = _safe(tp, tp + fp)
    recall = _safe(tp, tp + fn)
    f1 = _safe(2 * tp, 2 * tp + fp + fn)
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    po = (tp + tn) / n
    pe = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    return counts.select(
        "*", _safe(tp + tn, n).alias("accuracy"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        _safe(tn, tn + fp).alias("specificity"), _safe(fp, fp + tn).alias("fpr"), _safe(fn, fn + tp).alias("fnr"),
        _safe(tp * tn - fp * fn, mcc_den).alias("mcc"), F.when(pe < 1, (po - pe) / (1 - pe)).otherwise(0.0).alias("kappa"))


def confusion(df: DataFrame, label: str, pred: str, by: str | None = None) -> DataFrame:
    """EV4 — confusion matrix with TPR/TNR/FPR/FNR."""
    cm = confusion_counts(df, label, pred, by)
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    return cm.select("*", _safe(tp, tp + fn).alias("tpr"), _safe(tn, tn + fp).alias("tnr"),
                     _safe(fp, fp + tn).alias("fpr"), _safe(fn, fn + tp).alias("fnr"))


def binary_metrics(df: DataFrame, label: str, pred: str, by: str | None = None, weight: str | None = None) -> DataFrame:
    """EV5 / EV9 — metrics per group (or overall)."""
    return metrics_from_counts(confusion_counts(df, label, pred, by, weight=weight))


def binary_metrics_from_counts(spark, tn: int, fp: int, fn: int, tp: int) -> DataFrame:
    """EV5 on published counts (used by the golden checks)."""
    return metrics_from_counts(spark.createDataFrame([(tn, fp, fn, tp)], "tn long, fp long, fn long, tp long"))


def multiclass_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """EV6 — per-class precision/recall/F1/support plus macro and weighted averages. The rows (often a
    model's predictions) are read once, to a written row per (label, prediction)."""
    per = written(df.groupBy(c(label).alias("y"), c(pred).alias("p")).agg(F.count(F.lit(1)).alias("n")))
    classes = per.select(F.col("y").alias("k")).union(per.select(F.col("p").alias("k"))).distinct()
    tp = per.filter("y = p").select(F.col("y").alias("k"), F.col("n").alias("tp"))
    sup = per.groupBy(F.col("y").alias("k")).agg(F.sum("n").alias("support"))
    prd = per.groupBy(F.col("p").alias("k")).agg(F.sum("n").alias("predicted"))
    t = classes.join(tp, "k", "left").join(sup, "k", "left").join(prd, "k", "left").na.fill(0, ["tp", "support", "predicted"])
    t = t.select(F.col("k").cast("string").alias("class"), "support",
                 _safe(F.col("tp"), F.col("predicted")).alias("precision"),
                 _safe(F.col("tp"), F.col("support")).alias("recall"),
                 _safe(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"))
    tot = F.sum("support")
    macro = t.agg(F.lit("macro avg").alias("class"), tot.alias("support"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"))
    weighted = t.agg(F.lit("weighted avg").alias("class"), tot.alias("support"),
                     *[(F.sum(F.col(m) * F.col("support")) / tot).alias(m) for m in ("precision", "recall", "f1")])
    return t.unionByName(macro).unionByName(weighted)


# ---------------------------------------------------------------------------
# rank metrics on distinct scores (EV7, EV8, EV11, EV12)
# ---------------------------------------------------------------------------

def score_table(df: DataFrame, label: str, score: str, by: str | None = None, descending: bool = False,
                weight: str | None = None) -> tuple[DataFrame, int]:
    """Distinct (group, score) with positives/negatives, indexed in score order,
    with running counts and per-group offsets removed: ``cp``/``cn`` are the
    counts of positives/negatives at or before this score inside the group."""
    g = by or "_all"
    base = df.withColumn("_all", F.lit("all")) if not by else df
    if weight is None:
        pos, neg = F.count_if(c(label) == 1), F.count_if(c(label) != 1)
    else:
        pos = F.sum(F.when(c(label) == 1, c(weight)).otherwise(0)).cast("long")
        neg = F.sum(F.when(c(label) != 1, c(weight)).otherwise(0)).cast("long")
    per = base.filter(c(score).isNotNull()).groupBy(c(g).alias("grp"), c(score).alias("s")).agg(pos.alias("pos"), neg.alias("neg"))
    order = [F.col("grp"), F.desc("s") if descending else F.asc("s")]
    idx, n = with_row_index(per, order)
    cum = running_sums(idx, n, ["pos", "neg"])
    start = cum.groupBy("grp").agg(F.min(F.col("pos__cum") - F.col("pos")).alias("_p0"),
                                   F.min(F.col("neg__cum") - F.col("neg")).alias("_n0"),
                                   F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    t = cum.join(checked_broadcast(start, 100_000), "grp")
    return t.select("grp", "s", "pos", "neg", (F.col("pos__cum") - F.col("_p0")).alias("cp"),
                    (F.col("neg__cum") - F.col("_n0")).alias("cn"), "P", "N", ROW_INDEX), n


def roc_auc(df: DataFrame, label: str, score: str, by: str | None = None, weight: str | None = None) -> DataFrame:
    """EV7 — ROC-AUC = (Σ midrank of positives − P(P+1)/2)/(P·N), ties averaged."""
    t, _ = score_table(df, label, score, by, weight=weight)
    rows_before = F.col("cp") + F.col("cn") - F.col("pos") - F.col("neg")
    mid = rows_before + (F.col("pos") + F.col("neg") + 1) / 2.0
    out = t.groupBy("grp").agg(F.sum(F.col("pos") * mid).alias("r1"),
                                F.first("P").cast("double").alias("P"), F.first("N").cast("double").alias("N"))
    auc = (F.col("r1") - F.col("P") * (F.col("P") + 1) / 2.0) / (F.col("P") * F.col("N"))
    return out.select(F.col("grp").alias(by or "group"), auc.alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, by: str | None = None, weight: str | None = None) -> DataFrame:
    """EV8 — AP = Σₙ (Rₙ − Rₙ₋₁)·Pₙ over distinct thresholds, high to low."""
    t, _ = score_table(df, label, score, by, descending=True, weight=weight)
    prec = F.col("cp") / (F.col("cp") + F.col("cn"))
    out = t.groupBy("grp").agg(F.sum(F.col("pos") / F.col("P") * prec).alias("ap"))
    return out.select(F.col("grp").alias(by or "group"), "ap")


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """EV11 — (threshold, fpr, tpr, youden) at every distinct score, high to low."""
    t, _ = score_table(df, label, score, None, descending=True)
    return t.select(F.col("s").alias("threshold"), (F.col("cn") / F.col("N")).alias("fpr"), (F.col("cp") / F.col("P")).alias("tpr"),
                    (F.col("cp") / F.col("P") - F.col("cn") / F.col("N")).alias("youden"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """EV11 — Youden J optimum (first max by threshold desc)."""
    return curve.agg(F.max_by(F.struct("threshold", "fpr", "tpr", "youden"),
                              F.struct(F.col("youden"), F.col("threshold"))).alias("b")).select("b.*")


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """EV12 — (threshold, precision, recall) at every distinct score, and the baseline rate."""
    t, _ = score_table(df, label, score, None, descending=True)
    return t.select(F.col("s").alias("threshold"), (F.col("cp") / (F.col("cp") + F.col("cn"))).alias("precision"),
                    (F.col("cp") / F.col("P")).alias("recall"), (F.col("P") / (F.col("P") + F.col("N"))).alias("baseline"))


# ---------------------------------------------------------------------------
# probability metrics (EV10, EV13, EV15)
# ---------------------------------------------------------------------------

def prob_metrics(df: DataFrame, label: str, prob: str, by: str | None = None, eps: float = 1e-15) -> DataFrame:
    """EV10 — Brier score and log loss."""
    p = F.greatest(F.least(c(prob), F.lit(1 - eps)), F.lit(eps))
    y = c(label).cast("double")
    return df.groupBy(*_group(by)).agg(F.avg((c(prob) - y) ** 2).alias("brier"),
                                       (-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def calibration(df: DataFrame, label: str, prob: str, bins: int = 10) -> DataFrame:
    """EV13 — uniform bins on [0, 1] (bin = number of inner edges ≤ p), mean
    predicted vs observed rate, empty bins dropped."""
    inner = [i / bins for i in range(1, bins)]
    b = sum((F.when(c(prob) >= F.lit(e), 1).otherwise(0) for e in inner), F.lit(0))
    return df.groupBy(b.cast("int").alias("bin")).agg(F.avg(c(prob)).alias("prob_pred"),
                                                      F.avg(c(label).cast("double")).alias("prob_true"),
                                                      F.count(F.lit(1)).alias("n"))


def weighted_bce(df: DataFrame, label: str, prob: str, pos_weight: float, eps: float = 1e-7) -> DataFrame:
    """EV15 — class-weighted binary cross-entropy."""
    p = F.greatest(F.least(c(prob), F.lit(1 - eps)), F.lit(eps))
    y = c(label).cast("double")
    return df.agg((-F.avg(F.lit(pos_weight) * y * F.log(p) + (1 - y) * F.log(1 - p))).alias("weighted_bce"))


def focal_loss(df: DataFrame, label: str, prob: str, alpha: float = 0.25, gamma: float = 2.0, eps: float = 1e-7) -> DataFrame:
    """EV15 — focal loss α·y·(1−p)^γ·(−ln p) + (1−α)(1−y)·p^γ·(−ln(1−p))."""
    p = F.greatest(F.least(c(prob), F.lit(1 - eps)), F.lit(eps))
    y = c(label).cast("double")
    term = F.lit(alpha) * y * F.pow(1 - p, F.lit(gamma)) * (-F.log(p)) + \
        F.lit(1 - alpha) * (1 - y) * F.pow(p, F.lit(gamma)) * (-F.log(1 - p))
    return df.agg(F.avg(term).alias("focal_loss"))


# ---------------------------------------------------------------------------
# regression, verdicts, slices (EV14, EV16, EV18–EV21)
# ---------------------------------------------------------------------------

def regression_metrics(df: DataFrame, label: str, pred: str, by: str | None = None) -> DataFrame:
    """EV14 — RMSE, MAE, R² = 1 − SSR/SST (one pass: residuals and the centred variance of y)."""
    y, p = c(label).cast("double"), c(pred).cast("double")
    out = df.groupBy(*_group(by)).agg(F.count(y).alias("n"), F.sum((y - p) ** 2).alias("ssr"), F.avg(F.abs(y - p)).alias("mae"),
                                      F.var_pop(y).alias("vy"))
    sst = F.col("n") * F.col("vy")
    return out.select(*([by] if by else []), "n", F.sqrt(F.col("ssr") / F.col("n")).alias("rmse"), "mae",
                      (1 - F.col("ssr") / sst).alias("r2"))


# fixed values: the gaps and the status texts of the fit verdicts
FIT_GAP = 0.1  # |train F1 − validation F1| above this is over-/underfitting
LOW_F1, SEVERE_F1 = 0.5, 0.3


def fit_verdict(results: DataFrame, model: str = "model", train: str = "train_f1", val: str = "val_f1",
                gap: float = FIT_GAP) -> DataFrame:
    """EV16 — over-/underfit verdict from the train/validation F1 gap."""
    g = c(train) - c(val)
    status = F.when(g > gap, "OVERFITTING").when(g < -gap, "UNDERFITTING (Val > Train)").otherwise("OK")
    return results.select(c(model).alias(model), c(train), c(val), g.alias("f1_gap"), status.alias("status"))


def loss_verdict(results: DataFrame, model: str = "model", gap: float = FIT_GAP) -> DataFrame:
    """EV16 — the full verdict of (train_f1, val_f1, train_loss, val_loss) rows: F1 and loss
    gaps, the overfitting status and the underfitting status (both F1 low, or the training F1 very low)."""
    g = F.col("train_f1") - F.col("val_f1")
    under = F.when((F.col("train_f1") < LOW_F1) & (F.col("val_f1") < LOW_F1), "UNDERFITTING") \
        .when(F.col("train_f1") < SEVERE_F1, "SEVERE UNDERFITTING").otherwise("OK")
    return fit_verdict(results, model, gap=gap).join(
        results.select(c(model).alias(model), "train_loss", "val_loss", (F.col("val_loss") - F.col("train_loss")).alias("loss_gap"), under.alias("underfitting")), model)


def outcome(label: str, pred: str) -> Column:
    return (F.when((c(label) == 0) & (c(pred) == 0), "TN").when((c(label) == 0) & (c(pred) == 1), "FP")
            .when((c(label) == 1) & (c(pred) == 0), "FN").otherwise("TP"))


def misclassification(df: DataFrame, label: str, pred: str, features: Sequence[str]) -> DataFrame:
    """EV18 — feature means per outcome (TN/FP/FN/TP)."""
    return df.groupBy(outcome(label, pred).alias("outcome")).agg(F.count(F.lit(1)).alias("n"),
                                                                 *[F.avg(c(x)).alias(f"mean_{x}") for x in features])


def slice_metrics(df: DataFrame, label: str, pred: str, part: Column, name: str, min_rows: int = 10) -> DataFrame:
    """EV19 — metrics per slice, slices with at least ``min_rows`` rows."""
    cm = confusion_counts(df, label, pred, part, name)
    m = metrics_from_counts(cm)
    return m.filter((F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")) >= min_rows) \
        .select(name, (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n"), "precision", "recall", "f1",
                "accuracy")


def fairness(df: DataFrame, label: str, pred: str, ts: str, min_rows: int = 10) -> tuple[DataFrame, DataFrame]:
    """EV20 — metrics by shift, plus F1 range and population std across shifts."""
    from ..functions.scalar import shift_of

    per = slice_metrics(df, label, pred, shift_of(ts), "shift", min_rows)
    summ = per.agg((F.max("f1") - F.min("f1")).alias("f1_range"), F.stddev_pop("f1").alias("f1_std"),
                   F.count(F.lit(1)).alias("groups"))
    return per, summ


def score_separation(df: DataFrame, score: str, label: str) -> DataFrame:
    """EV21 — score mean/std/min/max overall and by class, and the class difference."""
    s = c(score)
    return df.agg(F.avg(s).alias("mean"), F.stddev_samp(s).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"),
                  F.avg(F.when(c(label) == 0, s)).alias("mean_normal"), F.avg(F.when(c(label) == 1, s)).alias("mean_anomaly"),
                  F.stddev_samp(F.when(c(label) == 0, s)).alias("std_normal"),
                  F.stddev_samp(F.when(c(label) == 1, s)).alias("std_anomaly")) \
        .withColumn("difference", F.col("mean_anomaly") - F.col("mean_normal"))


# ---------------------------------------------------------------------------
# failure cases (TK3–TK5) and contamination sweep (ML18)
# ---------------------------------------------------------------------------

def failure_cases(df: DataFrame, score: str, label: str, pred: str, key: Sequence[str], k: int = 5) -> DataFrame:
    """TK4 — the k "hardest" false negatives (score desc) and false positives
    (score asc); the limit is the feature (a bounded top-k per partition)."""
    fn = df.filter((c(label) == 1) & (c(pred) == 0)).orderBy(F.desc(score), *key).limit(k).withColumn("kind", F.lit("FN"))
    fp = df.filter((c(label) == 0) & (c(pred) == 1)).orderBy(F.asc(score), *key).limit(k).withColumn("kind", F.lit("FP"))
    return fn.unionByName(fp)


def edge_cases(df: DataFrame, score: str, label: str, pred: str, key: str) -> DataFrame:
    """TK5 — lowest-score false negative and highest-score false positive (min_by / max_by)."""
    fn = df.filter((c(label) == 1) & (c(pred) == 0)).agg(F.lit("worst_FN").alias("kind"),
                                                         F.min_by(c(key), F.struct(c(score), c(key))).alias(key),
                                                         F.min(c(score)).alias(score))
    fp = df.filter((c(label) == 0) & (c(pred) == 1)).agg(F.lit("worst_FP").alias("kind"),
                                                         F.max_by(c(key), F.struct(c(score), F.lit(0) - c(key))).alias(key),
                                                         F.max(c(score)).alias(score))
    return fn.unionByName(fp)


def best_row(df: DataFrame, metric: str, mode: str = "max", tiebreak: str | None = None) -> DataFrame:
    """TK3 — the row with the best metric (``min_by`` over the struct of all
    columns; ties go to the smallest ``tiebreak``)."""
    row = F.struct(*[c(x) for x in df.columns])
    key = -c(metric) if mode == "max" else c(metric)
    order = F.struct(key, c(tiebreak)) if tiebreak else key
    return df.agg(F.min_by(row, order).alias("_b")).select("_b.*")


def _counts_of(y: Column, hit: Column, i: int) -> list[Column]:
    """tn, fp, fn, tp of one predicate among many in an aggregate."""
    return [F.count_if(cond).alias(f"{k}{i}") for k, cond in (("tn", (y == 0) & ~hit), ("fp", (y == 0) & hit), ("fn", (y == 1) & ~hit), ("tp", (y == 1) & hit))]


def confusion_of_rules(df: DataFrame, label: str, rules: dict[str, Column], by: str) -> DataFrame:
    """EV4 for many predicates in one aggregate: (rule, by, tn, fp, fn, tp)."""
    hits = {k: F.coalesce(h, F.lit(False)) for k, h in rules.items()}
    row = df.groupBy(c(by).alias(by)).agg(*[a for i, h in enumerate(hits.values()) for a in _counts_of(c(label), h, i)])
    return row.select(by, F.inline(F.array(*[F.struct(F.lit(k).alias("rule"), *[F.col(f"{x}{i}").alias(x) for x in ("tn", "fp", "fn", "tp")]) for i, k in enumerate(hits)])))


def sweep_contamination(scored: DataFrame, score: str, label: str, values: Sequence[float], fit_on: DataFrame | None = None) -> DataFrame:
    """ML18 — for each contamination c: threshold = percentile(score, 1 − c) on the
    fitting set, pred = score > threshold; metrics for all c in one aggregate."""
    fit_on = fit_on if fit_on is not None else scored
    from ..session import ensure_checkpoint_dir
    from .core import quantile_values

    ensure_checkpoint_dir(scored.sparkSession)
    # one score column, materialised once: the quantile passes must not recompute a model score
    fit_scores = fit_on.select(c(score).alias(score)).checkpoint(eager=True)
    qv = quantile_values(fit_scores, [score], [1 - v for v in values])
    qs = [qv[(score, float(1 - v))] for v in values]
    row = scored.agg(*[a for i, q in enumerate(qs) for a in _counts_of(c(label), c(score) > F.lit(float(q)), i)])
    cm = row.select(F.inline(F.array(*[F.struct(F.lit(float(v)).alias("contamination"), F.lit(float(q)).alias("threshold"), *[F.col(f"{k}{i}").alias(k) for k in ("tn", "fp", "fn", "tp")])
                                       for i, (v, q) in enumerate(zip(values, qs))])))
    return metrics_from_counts(cm).select("contamination", "threshold", "tn", "fp", "fn", "tp", "precision", "recall", "f1")
