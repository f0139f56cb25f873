"""Evaluation and comparison plans.

The scored table is ``events``: score = value, label = event_type is 'error',
split = chronological 70/15/15, pred = score above a threshold."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import report as RP
from ..operators import timeseries as TS
from ..operators.core import round_cols
from .registry import register, table
from .series import ERR_SQL, EV_ORDER, SHIFT_SQL, SPLIT_SQL, events_labelled

THRESHOLD = 400.0


def scored_events(spark, sf):
    e = events_labelled(spark, sf).withColumn("pred", (F.col("value") > THRESHOLD).cast("int"))
    return TS.time_split(e, EV_ORDER)


SCORED_SQL = "WITH " + SPLIT_SQL + f""",
sc AS (SELECT event_id, ts, user_id, event_type, value, split, {ERR_SQL} AS is_error,
              CAST(value > {THRESHOLD} AS INTEGER) AS pred FROM sp)"""

COUNTS_SQL = """count_if(is_error = 0 AND pred = 0) AS tn, count_if(is_error = 0 AND pred = 1) AS fp,
       count_if(is_error = 1 AND pred = 0) AS fn, count_if(is_error = 1 AND pred = 1) AS tp"""


def _metrics_sql(src):
    return f"""SELECT *, round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0 END, 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1,
  round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END, 6) AS specificity,
  round(CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END, 6) AS fpr,
  round(CASE WHEN fn + tp > 0 THEN fn / (fn + tp) ELSE 0 END, 6) AS fnr,
  round(CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) > 0
             THEN (tp * tn - fp * fn) / sqrt(CAST((tp + fp) AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0 END, 6) AS mcc,
  round(CASE WHEN ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n) < 1
             THEN ((tp + tn) / n - ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n))
                  / (1 - ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)) ELSE 0 END, 6) AS kappa
FROM (SELECT *, CAST(tn + fp + fn + tp AS DOUBLE) AS n FROM {src})"""


def _drop_n(sql):
    return f"SELECT * EXCLUDE (n) FROM ({sql})"


# ---------------------------------------------------------------------------
# EV2–EV5, EV9
# ---------------------------------------------------------------------------

@register("normalized_scores_events", SCORED_SQL + """
SELECT event_id, split, round(greatest(least((value - lo) / (hi - lo), 1 - 1e-10), 1e-10), 6) AS prob
FROM sc JOIN (SELECT split AS s2, min(value) AS lo, max(value) AS hi FROM sc GROUP BY 1) r ON sc.split = r.s2""")
def normalized_scores_events(spark, sf):
    """EV2 — per-split min–max normalised score, clipped at 1e-10."""
    out = EV.normalize_score(scored_events(spark, sf), "value", by="split")
    return round_cols(out.select("event_id", "split", "prob"))


@register("threshold_residual_events", """
SELECT event_id, round(t, 6) AS threshold, round(value - t, 6) AS residual
FROM events, (SELECT quantile_cont(value, 0.98) AS t FROM events)""")
def threshold_residual_events(spark, sf):
    """EV3 — 98th-percentile threshold and residual."""
    out = EV.threshold_residual(table(spark, sf, "events"), "value", 0.98)
    return round_cols(out.select("event_id", "threshold", "residual"))


@register("confusion_by_split", SCORED_SQL + f"""
SELECT split, tn, fp, fn, tp, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS tpr,
       round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END, 6) AS tnr,
       round(CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END, 6) AS fpr,
       round(CASE WHEN fn + tp > 0 THEN fn / (fn + tp) ELSE 0 END, 6) AS fnr
FROM (SELECT split, {COUNTS_SQL} FROM sc GROUP BY split)""")
def confusion_by_split(spark, sf):
    """EV4 — confusion matrix and rates per split."""
    return round_cols(EV.confusion(scored_events(spark, sf), "is_error", "pred", "split"))


@register("binary_metrics_by_split", SCORED_SQL + ",\ncm AS (SELECT split, " + COUNTS_SQL + " FROM sc GROUP BY split)\n"
          + _drop_n(_metrics_sql("cm")))
def binary_metrics_by_split(spark, sf):
    """EV5 / EV9 — accuracy, precision, recall, F1, specificity, MCC, κ per split."""
    return round_cols(EV.binary_metrics(scored_events(spark, sf), "is_error", "pred", "split"))


@register("multiclass_metrics_orders", """
WITH o AS (SELECT o_orderstatus AS y, CASE WHEN year(o_orderdate) < 1995 THEN 'F' WHEN year(o_orderdate) > 1996 THEN 'O' ELSE 'P' END AS p
           FROM orders),
k AS (SELECT y AS k FROM o UNION SELECT p FROM o),
per AS (SELECT k.k, count(*) FILTER (WHERE o.y = k.k AND o.p = k.k) AS tp, count(*) FILTER (WHERE o.y = k.k) AS support,
               count(*) FILTER (WHERE o.p = k.k) AS predicted FROM k, o GROUP BY k.k),
t AS (SELECT k AS class, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
             CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1 FROM per)
SELECT class, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM t
UNION ALL SELECT 'macro avg', CAST(sum(support) AS BIGINT), round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6) FROM t
UNION ALL SELECT 'weighted avg', CAST(sum(support) AS BIGINT), round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6) FROM t""")
def multiclass_metrics_orders(spark, sf):
    """EV6 — per-class and macro/weighted precision, recall, F1."""
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("y"),
                                          F.when(F.year("o_orderdate") < 1995, "F").when(F.year("o_orderdate") > 1996, "O")
                                          .otherwise("P").alias("p"))
    return round_cols(EV.multiclass_metrics(o, "y", "p"))


# ---------------------------------------------------------------------------
# EV7, EV8, EV10–EV13, EV15
# ---------------------------------------------------------------------------

@register("roc_auc_by_split", SCORED_SQL + """,
r AS (SELECT split, is_error, rank() OVER (PARTITION BY split ORDER BY value)
             + (count(*) OVER (PARTITION BY split, value) - 1) / 2.0 AS rk FROM sc WHERE value IS NOT NULL)
SELECT split, round((sum(rk) FILTER (WHERE is_error = 1) - count_if(is_error = 1) * (count_if(is_error = 1) + 1) / 2.0)
                    / (count_if(is_error = 1) * count_if(is_error <> 1)), 6) AS roc_auc FROM r GROUP BY split""")
def roc_auc_by_split(spark, sf):
    """EV7 — ROC-AUC per split by the rank-sum form."""
    return round_cols(EV.roc_auc(scored_events(spark, sf), "is_error", "value", "split"))


@register("average_precision_by_split", SCORED_SQL + """,
d AS (SELECT split, value, count_if(is_error = 1) AS pos, count_if(is_error <> 1) AS neg FROM sc WHERE value IS NOT NULL GROUP BY 1, 2),
c AS (SELECT split, pos, sum(pos) OVER (PARTITION BY split ORDER BY value DESC) AS cp,
             sum(neg) OVER (PARTITION BY split ORDER BY value DESC) AS cn, sum(pos) OVER (PARTITION BY split) AS "P" FROM d)
SELECT split, round(sum(pos / "P" * cp / (cp + cn)), 6) AS ap FROM c GROUP BY split""")
def average_precision_by_split(spark, sf):
    """EV8 — average precision Σ(Rₙ−Rₙ₋₁)Pₙ per split."""
    return round_cols(EV.average_precision(scored_events(spark, sf), "is_error", "value", "split"))


PROB_SQL = SCORED_SQL + """,
pr AS (SELECT sc.*, greatest(least((value - lo) / (hi - lo), 1 - 1e-10), 1e-10) AS prob
       FROM sc JOIN (SELECT split AS s2, min(value) AS lo, max(value) AS hi FROM sc GROUP BY 1) r ON sc.split = r.s2)"""


@register("prob_metrics_by_split", PROB_SQL + """
SELECT split, round(avg((prob - is_error) * (prob - is_error)), 6) AS brier,
       round(-avg(is_error * ln(greatest(least(prob, 1 - 1e-15), 1e-15)) + (1 - is_error) * ln(1 - greatest(least(prob, 1 - 1e-15), 1e-15))), 6) AS log_loss
FROM pr GROUP BY split""")
def prob_metrics_by_split(spark, sf):
    """EV10 — Brier score and log loss of the normalised score."""
    p = EV.normalize_score(scored_events(spark, sf), "value", by="split")
    return round_cols(EV.prob_metrics(p, "is_error", "prob", "split"))


ROC_SQL = f"""WITH d AS (SELECT value AS s, count_if({ERR_SQL} = 1) AS pos, count_if({ERR_SQL} <> 1) AS neg
           FROM events WHERE value IS NOT NULL GROUP BY 1),
c AS (SELECT s, sum(pos) OVER (ORDER BY s DESC) AS cp, sum(neg) OVER (ORDER BY s DESC) AS cn,
             sum(pos) OVER () AS "P", sum(neg) OVER () AS "N" FROM d)"""


@register("roc_curve_events", ROC_SQL + """
SELECT s AS threshold, round(cn / "N", 6) + 0.0 AS fpr, round(cp / "P", 6) + 0.0 AS tpr, round(cp / "P" - cn / "N", 6) + 0.0 AS youden FROM c""")
def roc_curve_events(spark, sf):
    """EV11 — ROC points at every distinct score."""
    return round_cols(EV.roc_curve(events_labelled(spark, sf), "is_error", "value"), cols=["fpr", "tpr", "youden"])


@register("best_threshold_events", ROC_SQL + """
SELECT s AS threshold, round(cn / "N", 6) AS fpr, round(cp / "P", 6) AS tpr, round(cp / "P" - cn / "N", 6) AS youden
FROM c ORDER BY cp / "P" - cn / "N" DESC, s DESC LIMIT 1""")
def best_threshold_events(spark, sf):
    """EV11 — Youden J best threshold."""
    return round_cols(EV.best_threshold(EV.roc_curve(events_labelled(spark, sf), "is_error", "value")),
                      cols=["fpr", "tpr", "youden"])


@register("pr_curve_events", ROC_SQL + """
SELECT s AS threshold, round(cp / (cp + cn), 6) AS precision, round(cp / "P", 6) AS recall, round("P" / ("P" + "N"), 6) AS baseline FROM c""")
def pr_curve_events(spark, sf):
    """EV12 — precision/recall at every distinct score with the baseline rate."""
    return round_cols(EV.pr_curve(events_labelled(spark, sf), "is_error", "value"), cols=["precision", "recall", "baseline"])


@register("calibration_events", PROB_SQL + """
SELECT CAST(""" + " + ".join(f"(prob >= {i / 10})::INT" for i in range(1, 10)) + """ AS INTEGER) AS bin,
       round(avg(prob), 6) AS prob_pred, round(avg(CAST(is_error AS DOUBLE)), 6) AS prob_true, count(*) AS n
FROM pr GROUP BY 1""")
def calibration_events(spark, sf):
    """EV13 — 10-bin calibration table (empty bins absent)."""
    p = EV.normalize_score(scored_events(spark, sf), "value", by="split")
    return round_cols(EV.calibration(p, "is_error", "prob", 10))


@register("loss_aggregates_events", PROB_SQL + """,
q AS (SELECT is_error AS y, greatest(least(prob, 1 - 1e-7), 1e-7) AS p FROM pr)
SELECT round(-avg(4.0 * y * ln(p) + (1 - y) * ln(1 - p)), 6) AS weighted_bce,
       round(avg(0.25 * y * power(1 - p, 2.0) * -ln(p) + 0.75 * (1 - y) * power(p, 2.0) * -ln(1 - p)), 6) AS focal_loss FROM q""")
def loss_aggregates_events(spark, sf):
    """EV15 — weighted BCE (pos weight 4) and focal loss (α .25, γ 2)."""
    p = EV.normalize_score(scored_events(spark, sf), "value", by="split")
    return round_cols(EV.weighted_bce(p, "is_error", "prob", 4.0).crossJoin(EV.focal_loss(p, "is_error", "prob")))


# ---------------------------------------------------------------------------
# EV14, EV16, EV18–EV21
# ---------------------------------------------------------------------------

@register("regression_metrics_orders", """
WITH p AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS pred FROM lineitem GROUP BY 1),
j AS (SELECT o.o_totalprice AS y, p.pred AS p FROM orders o JOIN p ON o.o_orderkey = p.l_orderkey)
SELECT count(y) AS n, round(sqrt(sum((y - p) * (y - p)) / count(y)), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
       round(1 - sum((y - p) * (y - p)) / (count(y) * var_pop(y)), 6) AS r2 FROM j""")
def regression_metrics_orders(spark, sf):
    """EV14 — RMSE, MAE, R² of order totals predicted from their lines."""
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("pred"))
    o = table(spark, sf, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    out = EV.regression_metrics(o, "o_totalprice", "pred")
    return out.select("n", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


MODELS = (("thr_100", "value > 100"), ("thr_200", "value > 200"), ("thr_300", "value > 300"),
          ("thr_400", "value > 400"), ("label_copy", "event_type = 'error'"), ("dummy", "false"))
LEAKY = ("label_copy",)


def model_results(spark, sf):
    """A results table (model × split) of threshold detectors on the scored events;
    ``label_copy`` reads the label itself and is flagged as leaky."""
    s = TS.time_split(events_labelled(spark, sf), EV_ORDER)
    counts = EV.confusion_of_rules(s, "is_error", {name: F.expr(cond) for name, cond in MODELS}, "split").withColumnRenamed("rule", "model")
    return EV.metrics_from_counts(counts).select("model", "split", "tn", "fp", "fn", "tp", "precision", "recall", "f1", F.col("model").isin(*LEAKY).alias("leakage"))


MODEL_RESULTS_SQL = "WITH " + SPLIT_SQL + f""",
l AS (SELECT *, {ERR_SQL} AS is_error FROM sp),
preds AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS model, split, is_error, CAST({c} AS INTEGER) AS pred FROM l" for n, c in MODELS) + f"""),
cm AS (SELECT model, split, {COUNTS_SQL} FROM preds GROUP BY model, split),
mr AS (SELECT model, split, tn, fp, fn, tp,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
  model IN ({", ".join(f"'{m}'" for m in LEAKY)}) AS leakage FROM cm)"""


@register("fit_verdict_models", MODEL_RESULTS_SQL + """,
tv AS (SELECT model, max(f1) FILTER (WHERE split = 'train') AS train_f1, max(f1) FILTER (WHERE split = 'validation') AS val_f1
       FROM mr GROUP BY model)
SELECT model, round(train_f1, 6) AS train_f1, round(val_f1, 6) AS val_f1, round(train_f1 - val_f1, 6) AS f1_gap,
       CASE WHEN train_f1 - val_f1 > 0.1 THEN 'OVERFITTING' WHEN train_f1 - val_f1 < -0.1 THEN 'UNDERFITTING (Val > Train)'
            ELSE 'OK' END AS status FROM tv""")
def fit_verdict_models(spark, sf):
    """EV16 — over-/underfit verdict from train vs validation F1 (pivot by split)."""
    r = model_results(spark, sf)
    tv = r.groupBy("model").agg(F.max(F.when(F.col("split") == "train", F.col("f1"))).alias("train_f1"),
                                F.max(F.when(F.col("split") == "validation", F.col("f1"))).alias("val_f1"))
    return round_cols(EV.fit_verdict(tv))


@register("loss_verdict_models", MODEL_RESULTS_SQL + """,
tv AS (SELECT model, max(f1) FILTER (WHERE split = 'train') AS train_f1, max(f1) FILTER (WHERE split = 'validation') AS val_f1,
              max((fp + fn) / (tn + fp + fn + tp)) FILTER (WHERE split = 'train') AS train_loss,
              max((fp + fn) / (tn + fp + fn + tp)) FILTER (WHERE split = 'validation') AS val_loss FROM mr GROUP BY model)
SELECT model, round(train_f1, 6) AS train_f1, round(val_f1, 6) AS val_f1, round(train_f1 - val_f1, 6) AS f1_gap,
       CASE WHEN train_f1 - val_f1 > 0.1 THEN 'OVERFITTING' WHEN train_f1 - val_f1 < -0.1 THEN 'UNDERFITTING (Val > Train)' ELSE 'OK' END AS status,
       round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss, round(val_loss - train_loss, 6) AS loss_gap,
       CASE WHEN train_f1 < 0.5 AND val_f1 < 0.5 THEN 'UNDERFITTING' WHEN train_f1 < 0.3 THEN 'SEVERE UNDERFITTING' ELSE 'OK' END AS underfitting FROM tv""")
def loss_verdict_models(spark, sf):
    """EV16 — F1 and loss gaps (loss: share of wrong rows) with the over- and underfitting verdicts."""
    r = model_results(spark, sf).withColumn("loss", (F.col("fp") + F.col("fn")) / (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")))
    of = lambda split, x: F.max(F.when(F.col("split") == split, F.col(x)))
    return round_cols(EV.loss_verdict(r.groupBy("model").agg(of("train", "f1").alias("train_f1"), of("validation", "f1").alias("val_f1"),
                                                             of("train", "loss").alias("train_loss"), of("validation", "loss").alias("val_loss"))))


@register("misclassification_events", SCORED_SQL + """
SELECT CASE WHEN is_error = 0 AND pred = 0 THEN 'TN' WHEN is_error = 0 AND pred = 1 THEN 'FP'
            WHEN is_error = 1 AND pred = 0 THEN 'FN' ELSE 'TP' END AS outcome, count(*) AS n,
       round(avg(value), 6) AS mean_value, round(avg(user_id), 6) AS mean_user_id FROM sc GROUP BY 1""")
def misclassification_events(spark, sf):
    """EV18 — feature means per confusion outcome."""
    return round_cols(EV.misclassification(scored_events(spark, sf), "is_error", "pred", ["value", "user_id"]))


def _slice_sql(part_expr, name):
    return SCORED_SQL + f""",
cm AS (SELECT {part_expr} AS {name}, {COUNTS_SQL} FROM sc GROUP BY 1)
SELECT {name}, CAST(n AS BIGINT) AS n, precision, recall, f1, accuracy FROM ({_metrics_sql("cm")}) WHERE n >= 10"""


@register("slice_metrics_by_hour", _slice_sql("CAST(hour(ts) AS INTEGER)", "hour"))
def slice_metrics_by_hour(spark, sf):
    """EV19 — metrics per hour slice (≥ 10 rows)."""
    return round_cols(EV.slice_metrics(scored_events(spark, sf), "is_error", "pred", F.hour("ts"), "hour"))


@register("slice_metrics_by_weekday", _slice_sql("CAST(isodow(ts) - 1 AS INTEGER)", "weekday"))
def slice_metrics_by_weekday(spark, sf):
    """EV19 — metrics per weekday slice (≥ 10 rows)."""
    return round_cols(EV.slice_metrics(scored_events(spark, sf), "is_error", "pred", F.weekday("ts"), "weekday"))


@register("fairness_by_shift", _slice_sql(SHIFT_SQL, "shift"))
def fairness_by_shift(spark, sf):
    """EV20 — metrics per shift."""
    per, _ = EV.fairness(scored_events(spark, sf), "is_error", "pred", "ts")
    return round_cols(per)


@register("fairness_summary", SCORED_SQL + f""",
cm AS (SELECT {SHIFT_SQL} AS shift, {COUNTS_SQL} FROM sc GROUP BY 1),
m AS (SELECT CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM cm WHERE tn + fp + fn + tp >= 10)
SELECT round(max(f1) - min(f1), 6) AS f1_range, round(stddev_pop(f1), 6) AS f1_std, count(*) AS groups FROM m""")
def fairness_summary(spark, sf):
    """EV20 — F1 range and population std across shifts."""
    _, summ = EV.fairness(scored_events(spark, sf), "is_error", "pred", "ts")
    return round_cols(summ)


@register("score_separation_events", f"""
SELECT round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max,
  round(avg(value) FILTER (WHERE {ERR_SQL} = 0), 6) AS mean_normal, round(avg(value) FILTER (WHERE {ERR_SQL} = 1), 6) AS mean_anomaly,
  round(stddev_samp(value) FILTER (WHERE {ERR_SQL} = 0), 6) AS std_normal, round(stddev_samp(value) FILTER (WHERE {ERR_SQL} = 1), 6) AS std_anomaly,
  round(avg(value) FILTER (WHERE {ERR_SQL} = 1) - avg(value) FILTER (WHERE {ERR_SQL} = 0), 6) AS difference FROM events""")
def score_separation_events(spark, sf):
    """EV21 — score summary overall and by class."""
    return round_cols(EV.score_separation(events_labelled(spark, sf), "value", "is_error"))


# ---------------------------------------------------------------------------
# TK3–TK5, ML18
# ---------------------------------------------------------------------------

@register("failure_cases_events", SCORED_SQL + """
SELECT * FROM (SELECT event_id, value, 'FN' AS kind FROM sc WHERE is_error = 1 AND pred = 0 ORDER BY value DESC, event_id LIMIT 5)
UNION ALL
SELECT * FROM (SELECT event_id, value, 'FP' AS kind FROM sc WHERE is_error = 0 AND pred = 1 ORDER BY value ASC, event_id LIMIT 5)""")
def failure_cases_events(spark, sf):
    """TK4 — five hardest FN (score desc) and FP (score asc); the limit is the feature."""
    return EV.failure_cases(scored_events(spark, sf), "value", "is_error", "pred", ["event_id"]).select("event_id", "value", "kind")


@register("edge_cases_events", SCORED_SQL + """
SELECT 'worst_FN' AS kind, arg_min(event_id, (value, event_id)) AS event_id, min(value) AS value FROM sc WHERE is_error = 1 AND pred = 0
UNION ALL
SELECT 'worst_FP', arg_max(event_id, (value, -event_id)), max(value) FROM sc WHERE is_error = 0 AND pred = 1""")
def edge_cases_events(spark, sf):
    """TK5 — lowest-score FN and highest-score FP."""
    return EV.edge_cases(scored_events(spark, sf), "value", "is_error", "pred", "event_id")


@register("best_model_row", MODEL_RESULTS_SQL + """
SELECT model, split, tn, fp, fn, tp, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, leakage
FROM mr WHERE split = 'test' AND NOT leakage ORDER BY f1 DESC, model LIMIT 1""")
def best_model_row(spark, sf):
    """TK3 — best non-leaky model on test by F1 (``min_by`` with a name tiebreak)."""
    r = model_results(spark, sf).filter((F.col("split") == "test") & ~F.col("leakage"))
    return round_cols(EV.best_row(r, "f1", "max", tiebreak="model"))


CONTAMINATION = (0.01, 0.02, 0.05, 0.1, 0.2)


@register("contamination_sweep_events", SCORED_SQL + ",\nth AS (" + "\nUNION ALL\n".join(
    f"SELECT {v} AS contamination, (SELECT quantile_cont(value, {1 - v}) FROM sc WHERE split = 'train') AS threshold"
    for v in CONTAMINATION) + f"""),
cm AS (SELECT contamination, threshold, count_if(is_error = 0 AND value <= threshold) AS tn, count_if(is_error = 0 AND value > threshold) AS fp,
              count_if(is_error = 1 AND value <= threshold) AS fn, count_if(is_error = 1 AND value > threshold) AS tp
       FROM sc, th GROUP BY 1, 2)
SELECT contamination, round(threshold, 6) AS threshold, tn, fp, fn, tp,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM cm""")
def contamination_sweep_events(spark, sf):
    """ML18 — thresholds at train percentiles for several contaminations, metrics in one pass."""
    s = scored_events(spark, sf)
    out = EV.sweep_contamination(s, "value", "is_error", CONTAMINATION, fit_on=s.filter("split = 'train'"))
    return round_cols(out)


# ---------------------------------------------------------------------------
# CMP*
# ---------------------------------------------------------------------------

@register("model_vs_baseline", MODEL_RESULTS_SQL + """,
b AS (SELECT split AS bs, f1 AS bf1, recall AS brec FROM mr WHERE model = 'thr_100')
SELECT model, split, round(f1, 6) AS f1, round(recall, 6) AS recall,
       round(CASE WHEN bf1 <> 0 THEN (f1 - bf1) / bf1 * 100 ELSE 0 END, 6) AS f1_vs_baseline_pct,
       round(CASE WHEN brec <> 0 THEN (recall - brec) / brec * 100 ELSE 0 END, 6) AS recall_vs_baseline_pct
FROM mr JOIN b ON mr.split = b.bs""")
def model_vs_baseline(spark, sf):
    """CMP2 — improvement over the baseline model per split."""
    r = model_results(spark, sf).select("model", "split", "f1", "recall")
    return round_cols(RP.vs_baseline(r, "thr_100", ["f1", "recall"], by=["split"]))


@register("model_band_status", MODEL_RESULTS_SQL + """
SELECT model, split, round(f1, 6) AS f1, leakage,
       CASE WHEN leakage THEN 'LEAKAGE (not comparable)' WHEN f1 > 0.5 THEN 'Above SOTA' WHEN f1 > 0.3 THEN 'Within SOTA'
            ELSE 'Below SOTA' END AS status FROM mr""")
def model_band_status(spark, sf):
    """CMP3 — status band per model and split."""
    r = model_results(spark, sf).select("model", "split", "f1", "leakage")
    return round_cols(RP.band_status(r))


@register("model_f1_summary", MODEL_RESULTS_SQL + """
SELECT count(f1) AS models, round(avg(f1), 6) AS f1_mean, round(stddev_pop(f1), 6) AS f1_std, round(min(f1), 6) AS f1_min,
       round(max(f1), 6) AS f1_max FROM mr WHERE split = 'test'""")
def model_f1_summary(spark, sf):
    """CMP3 — F1 descriptive statistics on test."""
    return round_cols(RP.f1_summary(model_results(spark, sf).filter("split = 'test'")))


@register("model_ranking", MODEL_RESULTS_SQL + """
SELECT model, round(f1, 6) AS f1, CAST(row_number() OVER (ORDER BY f1 DESC, model) AS INTEGER) AS rank
FROM mr WHERE split = 'test' AND NOT leakage""")
def model_ranking(spark, sf):
    """CMP4 / FLT5 — ranking on test without leaky models."""
    r = model_results(spark, sf).filter("split = 'test'").select("model", "f1", "leakage")
    return round_cols(RP.rank_models(r).select("model", "f1", "rank"))


@register("model_costs", MODEL_RESULTS_SQL + """
SELECT model, fp, fn, round(recall, 6) AS recall, round(1000.0 * (1 - recall) * (tp + fn), 4) AS fn_cost_est,
       round(100.0 * fp + 1000.0 * fn, 4) AS total_cost FROM mr WHERE split = 'test'""")
def model_costs(spark, sf):
    """CMP5 — FN cost estimate and full FP/FN cost on test."""
    r = model_results(spark, sf).filter("split = 'test'")
    n_anom = r.select((F.col("tp") + F.col("fn")).alias("a")).first()["a"]  # one number, equal for every model
    out = RP.cost_table(r.select("model", "fp", "fn", "recall"), n_anomalies=n_anom)
    return out.select("model", "fp", "fn", F.round("recall", 6).alias("recall"), F.round("fn_cost_est", 4).alias("fn_cost_est"),
                      F.round(F.col("total_cost").cast("double"), 4).alias("total_cost"))


@register("fastest_detector", MODEL_RESULTS_SQL + """
SELECT arg_min(model, (fp + fn, model)) AS fastest_model, min(fp + fn) AS errors FROM mr WHERE split = 'test'""")
def fastest_detector(spark, sf):
    """CMP6 — ``min_by`` pick over a cost column (here the error count)."""
    r = model_results(spark, sf).filter("split = 'test'").withColumn("errors", F.col("fp") + F.col("fn"))
    return RP.fastest(r, "errors")


INSIGHT_RULES = (
    ("leakage", "leakage", "{model} reads the label (F1 {f1})"),
    ("low_recall", "NOT leakage AND recall < 0.3", "{model} misses most anomalies (recall {recall})"),
    ("good", "NOT leakage AND f1 >= 0.3", "{model} is usable (F1 {f1})"),
)


@register("model_insights", MODEL_RESULTS_SQL + """
SELECT 'leakage' AS category, model || ' reads the label (F1 ' || CAST(round(f1, 4) AS VARCHAR) || ')' AS message FROM mr
 WHERE split = 'test' AND leakage
UNION ALL
SELECT 'low_recall', model || ' misses most anomalies (recall ' || CAST(round(recall, 4) AS VARCHAR) || ')' FROM mr
 WHERE split = 'test' AND NOT leakage AND recall < 0.3
UNION ALL
SELECT 'good', model || ' is usable (F1 ' || CAST(round(f1, 4) AS VARCHAR) || ')' FROM mr WHERE split = 'test' AND NOT leakage AND f1 >= 0.3""")
def model_insights(spark, sf):
    """CMP7 — insight rows from threshold rules over the metric table."""
    r = model_results(spark, sf).filter("split = 'test'")
    return RP.insights(r, INSIGHT_RULES)


def _report_stages(spark, sf):
    from ..operators import quality as Q

    e = events_labelled(spark, sf)
    s = scored_events(spark, sf)
    _, fair = EV.fairness(s, "is_error", "pred", "ts")
    return {"overview": Q.overview(e, "ts", "is_error").drop("start", "end"),
            "score_separation": EV.score_separation(e, "value", "is_error"),
            "test_metrics": EV.binary_metrics(s.filter("split = 'test'"), "is_error", "pred"),
            "fairness": fair}


@register("final_report_events")
def final_report_events(spark, sf):
    """CMP8 — one (stage, metric, value) table collected from the stage results."""
    return round_cols(RP.final_report(_report_stages(spark, sf)))


@register("final_report_json")
def final_report_json(spark, sf):
    """SNK4 — the final report as nested JSON records, one per stage."""
    return RP.to_json_records(round_cols(RP.final_report(_report_stages(spark, sf))), "stage")
