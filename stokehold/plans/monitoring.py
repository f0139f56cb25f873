"""Monitoring plans in batch mode — the same functions run on
``readStream`` frames — plus dataset fingerprints/versions (SNK6, SNK7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.core import round_cols
from ..sources import io as IO
from ..streaming import monitors as M
from .registry import register, table
from .series import ERR_SQL, events_labelled


@register("hourly_error_windows", f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS rows, CAST(sum({ERR_SQL}) AS BIGINT) AS anomalies, round(avg({ERR_SQL}), 6) AS anomaly_rate
FROM events GROUP BY 1, 2""")
def hourly_error_windows(spark, sf):
    """STR2 — tumbling 1-hour windows with a watermark (batch = stream)."""
    return round_cols(M.anomaly_rate_windows(events_labelled(spark, sf), "ts", "is_error"))


@register("weekly_quality_windows", f"""
WITH w AS (SELECT make_timestamp(CAST(floor(epoch_us(ts) / 604800000000) * 604800000000 AS BIGINT)) AS ws,
                  {ERR_SQL} AS y, CAST(value > 400 AS INTEGER) AS p FROM events),
a AS (SELECT ws, count_if(y = 1 AND p = 1) AS tp, count_if(y = 0 AND p = 1) AS fp, count_if(y = 1 AND p = 0) AS fn,
             count(*) AS rows FROM w GROUP BY ws)
SELECT ws AS window_start, ws + INTERVAL 7 DAY AS window_end, tp, fp, fn, rows,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM a""")
def weekly_quality_windows(spark, sf):
    """STR3 — weekly precision/recall/F1 of a threshold detector."""
    e = events_labelled(spark, sf).withColumn("pred", (F.col("value") > 400).cast("int"))
    return round_cols(M.weekly_quality(e, "ts", "is_error", "pred"))


@register("sliding_mean_windows", """
WITH b AS (SELECT ts, value, CAST(floor(epoch_us(ts) / 600000000) * 600000000 AS BIGINT) AS slot FROM events),
x AS (SELECT make_timestamp(slot - k * 600000000) AS ws, value FROM b, (SELECT unnest([0, 1, 2]) AS k))
SELECT ws AS window_start, ws + INTERVAL 30 MINUTE AS window_end, count(value) AS n, round(avg(value), 6) AS mean
FROM x GROUP BY ws""")
def sliding_mean_windows(spark, sf):
    """STR4 — 30-minute windows sliding by 10 minutes."""
    return round_cols(M.sliding_mean(table(spark, sf, "events"), "ts", "value"))


@register("labelled_stream_batch", """
SELECT event_id, CAST(coalesce(value - 250 < 0, false) AS INTEGER) AS anomaly_label FROM
  (SELECT event_id, value FROM events)""")
def labelled_stream_batch(spark, sf):
    """STR1 — the arriving-readings labeller in batch mode (no model)."""
    e = table(spark, sf, "events").select("event_id", (F.col("value") - 250).alias("value_minus_250"))
    return M.label_and_score(e, ["value_minus_250"]).select("event_id", "anomaly_label")


@register("dataset_fingerprint_lineitem")
def dataset_fingerprint_lineitem(spark, sf):
    """SNK6 — order-independent content fingerprint of a whole table."""
    return IO.dataset_fingerprint(table(spark, sf, "lineitem"))


@register("dataset_version_orders")
def dataset_version_orders(spark, sf):
    """SNK7 — version record of a dataset (shape, fingerprint, timestamp)."""
    return IO.dataset_version(table(spark, sf, "orders"), "orders", "v1").drop("created_at")
