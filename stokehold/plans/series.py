"""Joins, time-series, scalar, feature and sampling plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import features as FE
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import sampling as SP
from ..operators import timeseries as TS
from ..operators.core import round_cols, unpivot_metrics
from .profiling import (GAPPY_SQL, INTERP_EXPR, INTERP_SQL, LABELLED_SQL, READINGS_SQL, WINSOR_COLS, _union,
                        gappy_events, labelled_readings, readings)
from ..session import written
from .registry import register, table

EV_ORDER = ["ts", "event_id"]
ERR_SQL = "CAST(event_type = 'error' AS INTEGER)"


def events_labelled(spark, sf):
    return table(spark, sf, "events").withColumn("is_error", (F.col("event_type") == "error").cast("int"))


# ---------------------------------------------------------------------------
# JN*
# ---------------------------------------------------------------------------

@register("attach_customer_to_orders", """
SELECT o.*, c.c_acctbal AS c_acctbal_raw, c.c_mktsegment AS c_mktsegment_raw
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def attach_customer_to_orders(spark, sf):
    """JN1 — left join of raw columns by a key checked to be unique."""
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    out = J.attach_raw(o, table(spark, sf, "customer"), "c_custkey", ["c_acctbal", "c_mktsegment"])
    return out.withColumnRenamed("c_custkey", "o_custkey")


@register("join_coverage_doc_labels", """
SELECT "column", nulls, round(nulls / n * 100, 6) AS null_pct FROM (
  SELECT 'quality' AS "column", count_if(l.quality IS NULL) AS nulls, count(*) AS n
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL
  SELECT 'toxic', count_if(l.toxic IS NULL), count(*) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def join_coverage_doc_labels(spark, sf):
    """JN5 — nulls per attached column after documents ⟕ labels."""
    d = table(spark, sf, "documents").select("doc_id")
    j = d.join(table(spark, sf, "labels"), "doc_id", "left")
    return round_cols(J.join_coverage(j, ["quality", "toxic"]))


@register("compare_labels_events", """
WITH b AS (SELECT quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi FROM events),
a AS (SELECT event_id, CAST(value > hi AS INTEGER) AS old, """ + ERR_SQL + """ AS new FROM events, b)
SELECT count_if(old = 1) AS old_total, count_if(new = 1) AS new_total, count_if(old = 1 AND new = 1) AS both,
       count_if(old = 1 AND new = 0) AS only_old, count_if(old = 0 AND new = 1) AS only_new,
       count_if(old = 0 AND new = 0) AS neither FROM a""")
def compare_labels_events(spark, sf):
    """JN2 — label from an upper IQR fence vs the error label, by key (full outer join)."""
    e = table(spark, sf, "events")
    b = Q.outlier_bounds(e, ["value"]).select("value__upper")
    old = e.crossJoin(F.broadcast(b)).select("event_id", (F.col("value") > F.col("value__upper")).cast("int").alias("old"))
    new = e.select("event_id", (F.col("event_type") == "error").cast("int").alias("new"))
    return J.compare_labels(old, new, "event_id", "old", "new")


def _winsor_frame_sql():
    cols = []
    for x in WINSOR_COLS:
        cols.append(f"""CASE WHEN (SELECT count_if({x} < lo OR {x} > hi) FROM readings, f_{x}) / (SELECT n FROM f_{x}) > 0
                        AND (SELECT count_if({x} < lo OR {x} > hi) FROM readings, f_{x}) / (SELECT n FROM f_{x}) < 0.05
                   THEN greatest(least({x}, (SELECT hi FROM f_{x})), (SELECT lo FROM f_{x})) ELSE {x} END AS {x}""")
    fences = ",\n".join(f"""f_{x} AS (SELECT quantile_cont({x}, 0.25) - 1.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)) AS lo,
       quantile_cont({x}, 0.75) + 1.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)) AS hi, count({x}) AS n FROM readings)"""
                        for x in WINSOR_COLS)
    return fences, ",\n".join(cols)


_F, _C = _winsor_frame_sql()


@register("treatment_effect_readings", "WITH " + READINGS_SQL + ",\n" + _F + ",\nclean AS (SELECT " + _C + " FROM readings)\n" + _union(
    [f"""SELECT '{x}' AS "column", round((SELECT CAST(min({x}) AS DOUBLE) FROM readings), 6) AS raw_min,
       round((SELECT CAST(max({x}) AS DOUBLE) FROM readings), 6) AS raw_max, round((SELECT stddev_samp({x}) FROM readings), 6) AS raw_std,
       round(CAST(min({x}) AS DOUBLE), 6) AS clean_min, round(CAST(max({x}) AS DOUBLE), 6) AS clean_max, round(stddev_samp({x}), 6) AS clean_std,
       round(CASE WHEN (SELECT max({x}) - min({x}) FROM readings) <> 0
             THEN ((max({x}) - min({x})) / (SELECT max({x}) - min({x}) FROM readings) - 1) * 100 END, 6) AS range_change_pct
       FROM clean""" for x in WINSOR_COLS]))
def treatment_effect_readings(spark, sf):
    """JN3 — raw vs winsorised range per column, joined on the column name."""
    r = readings(spark, sf)
    return round_cols(J.treatment_effect(r, Q.winsorize(r, WINSOR_COLS, materialize=True), WINSOR_COLS))


IMP_COLS = ["l_quantity", "l_discount", "l_tax", "o_totalprice", "c_acctbal"]


@register("combined_importance_readings", "WITH " + READINGS_SQL + ",\nk AS (" + _union(
    [f"""SELECT '{x}' AS feature, corr({x}, l_extendedprice) AS r, count(*) FILTER (WHERE {x} IS NOT NULL AND l_extendedprice IS NOT NULL) AS n
       FROM readings""" for x in IMP_COLS]) + """)
SELECT feature, round(r, 6) AS correlation, round(abs(r), 6) AS abs_correlation, round(r * r / (1 - r * r) * (n - 2), 6) AS f_score
FROM k""")
def combined_importance_readings(spark, sf):
    """JN4 — two rankings (|r| and F) joined by feature."""
    r = readings(spark, sf)
    a = FE.corr_with(r, "l_extendedprice", IMP_COLS)
    b = FE.f_regression_stats(r, IMP_COLS, "l_extendedprice").select("feature", "f_score")
    return round_cols(J.combine_importance(a, b, "feature"))


# ---------------------------------------------------------------------------
# WN*
# ---------------------------------------------------------------------------

@register("smoothed_events", """
SELECT event_id, ts, value,
       round(avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS value_smooth3
FROM events""")
def smoothed_events(spark, sf):
    """WN1 — centred 3-row moving average (block windows with a halo)."""
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    return round_cols(TS.smooth(e, EV_ORDER, ["value"]), cols=["value_smooth3"])


@register("smooth_correlation_events", """
SELECT 'value' AS "column", 'value_smooth3' AS smoothed, round(corr(value, s), 6) AS correlation FROM (
  SELECT value, avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS s FROM events)""")
def smooth_correlation_events(spark, sf):
    """WN2 — correlation of the series with its smoothed version."""
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    return round_cols(TS.smooth_correlation(TS.smooth(e, EV_ORDER, ["value"]), [("value", "value_smooth3")]))


@register("interpolated_events", "WITH " + GAPPY_SQL + ",\n" + INTERP_SQL + f"""
SELECT event_id, round({INTERP_EXPR}, 6) AS v_interp FROM p""")
def interpolated_events(spark, sf):
    """WN3 — linear interpolation by position with both-end fill."""
    g = gappy_events(spark, sf).select("event_id", "ts", "v_interp")
    return round_cols(TS.interpolate_linear(g, ["v_interp"], EV_ORDER).select("event_id", "v_interp"))


SPLIT_SQL = """sp AS (SELECT *, CASE WHEN rn < CAST(floor(n * 0.70) AS BIGINT) THEN 'train'
                                WHEN rn < CAST(floor(n * 0.85) AS BIGINT) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS rn, count(*) OVER () AS n FROM events))"""


@register("time_split_events", "WITH " + SPLIT_SQL + "\nSELECT event_id, split FROM sp")
def time_split_events(spark, sf):
    """WN4 — chronological 70/15/15 split by position."""
    return TS.time_split(table(spark, sf, "events"), EV_ORDER).select("event_id", "split")


@register("temporal_order_events", "WITH " + SPLIT_SQL + """,
r AS (SELECT split, count(*) AS rows, min(ts) AS start, max(ts) AS "end",
             CAST(CASE split WHEN 'train' THEN 1 WHEN 'validation' THEN 2 ELSE 3 END AS INTEGER) AS position FROM sp GROUP BY split)
SELECT a.split, a.position, a.rows, a.start, a."end",
       CASE WHEN b.start IS NULL THEN true ELSE a."end" < b.start END AS before_next
FROM r a LEFT JOIN r b ON b.position = a.position + 1""")
def temporal_order_events(spark, sf):
    """WN5 — leakage check: each split ends before the next starts."""
    return TS.check_temporal_order(TS.time_split(table(spark, sf, "events"), EV_ORDER), "ts")


@register("durbin_watson_events", """
SELECT 'value' AS "column", count(value) AS n,
       round(sum((value - lv) * (value - lv)) / sum(value * value), 6) AS durbin_watson
FROM (SELECT value, lag(value) OVER (ORDER BY ts, event_id) AS lv FROM events)""")
def durbin_watson_events(spark, sf):
    """WN6 — Durbin–Watson on the raw series."""
    return round_cols(TS.durbin_watson(table(spark, sf, "events"), "value", EV_ORDER))


def _acf_sql(nlags):
    lags = ", ".join(f"lag(x, {k}) OVER (ORDER BY ts, event_id) AS l{k}" for k in range(1, nlags + 1))
    sums = ", ".join(f"sum(x * l{k}) AS s{k}" for k in range(1, nlags + 1))
    return f"""c AS (SELECT ts, event_id, value - (SELECT avg(value) FROM events) AS x FROM events),
l AS (SELECT x, {lags} FROM c),
s AS (SELECT count(x) AS n, sum(x * x) AS s0, {sums} FROM l),
a AS (SELECT n, unnest(range(0, {nlags + 1})) AS lag, unnest([s0, {", ".join(f"s{k}" for k in range(1, nlags + 1))}]) / s0 AS r FROM s)"""


@register("acf_events", "WITH " + _acf_sql(40) + "\nSELECT CAST(lag AS INTEGER) AS lag, round(r, 6) AS acf FROM a")
def acf_events(spark, sf):
    """WN7 — autocorrelation to 40 lags in one aggregate over halo blocks."""
    return round_cols(TS.acf(table(spark, sf, "events"), "value", EV_ORDER, 40))


@register("ljung_box_events", "WITH " + _acf_sql(30) + """
SELECT CAST(h AS INTEGER) AS lag, round(max(n) * (max(n) + 2) * sum(CASE WHEN lag BETWEEN 1 AND h THEN r * r / (n - lag) ELSE 0 END), 4) AS lb_stat
FROM a, (SELECT unnest([10, 20, 30]) AS h) GROUP BY h""")
def ljung_box_events(spark, sf):
    """WN8 — Ljung–Box Q at lags 10, 20, 30 (the p-values come with ``TS.ljung_box``)."""
    out = TS.ljung_box(table(spark, sf, "events"), "value", EV_ORDER, [10, 20, 30])
    return out.select("lag", F.round("lb_stat", 4).alias("lb_stat"))


@register("kpss_events", """
WITH s AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS i, value - avg(value) OVER () AS e, count(*) OVER () AS n FROM events),
q AS (SELECT sum(p * p) AS s2 FROM (SELECT sum(e) OVER (ORDER BY i) AS p FROM s)),
g AS (SELECT k, sum(a.e * b.e) AS g FROM range(0, 200) r(k) JOIN s a ON true JOIN s b ON b.i = a.i - k GROUP BY k),
c AS (SELECT max(n) AS n, CAST(floor(power(max(n), 2.0 / 9)) AS INTEGER) AS cover FROM s),
l AS (SELECT CAST(floor(least(1.1447 * power(power(2 * sum(k * g) / (sum(CASE WHEN k = 0 THEN g ELSE 2 * g END)), 2), 1.0 / 3) * power(any_value(n), 1.0 / 3), any_value(n) - 1)) AS INTEGER) AS lags
      FROM g, c WHERE k <= cover),
v AS (SELECT sum(CASE WHEN k = 0 THEN 1 ELSE 2 * (1 - k / (lags + 1.0)) END * g) / any_value(n) AS lrv, any_value(n) AS n, any_value(lags) AS lags FROM g, l, c WHERE k <= lags),
r AS (SELECT s2 / (n * n) / lrv AS eta, lags FROM q, v)
SELECT 'value' AS "column", round(eta, 6) AS kpss_stat, round(CASE WHEN eta <= 0.347 THEN 0.10 WHEN eta >= 0.739 THEN 0.01
    WHEN eta <= 0.463 THEN 0.10 - 0.05 * (eta - 0.347) / 0.116 WHEN eta <= 0.574 THEN 0.05 - 0.025 * (eta - 0.463) / 0.111
    ELSE 0.025 - 0.015 * (eta - 0.574) / 0.165 END, 6) AS kpss_pvalue, lags FROM r""")
def kpss_events(spark, sf):
    """WN10 — KPSS level-stationarity statistic and interpolated p-value."""
    return round_cols(TS.kpss(table(spark, sf, "events"), "value", EV_ORDER))


@register("avg_rank_quantity", """
SELECT l_quantity AS value, count(*) AS cnt,
       round(sum(count(*)) OVER (ORDER BY l_quantity) - count(*) + (count(*) + 1) / 2.0, 6) AS midrank
FROM lineitem GROUP BY l_quantity""")
def avg_rank_quantity(spark, sf):
    """WN13 — tie-averaged ranks, computed on the distinct-value table."""
    from ..operators.core import distinct_value_ranks

    counts = table(spark, sf, "lineitem").groupBy(F.col("l_quantity").alias("value")).agg(F.count(F.lit(1)).alias("cnt"))
    return round_cols(distinct_value_ranks(counts, "value"))


# ---------------------------------------------------------------------------
# SC* / FE7–FE9
# ---------------------------------------------------------------------------

@register("temporal_features_events", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(day(ts) AS INTEGER) AS day_of_month, CAST(month(ts) AS INTEGER) AS month, CAST(quarter(ts) AS INTEGER) AS quarter,
  CAST(weekofyear(ts) AS INTEGER) AS week_of_year,
  round(sin(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_cos,
  round(sin(2 * pi() * (isodow(ts) - 1) / 7), 6) + 0.0 AS dow_sin, round(cos(2 * pi() * (isodow(ts) - 1) / 7), 6) + 0.0 AS dow_cos,
  round(sin(2 * pi() * month(ts) / 12), 6) + 0.0 AS month_sin, round(cos(2 * pi() * month(ts) / 12), 6) + 0.0 AS month_cos
FROM events""")
def temporal_features_events(spark, sf):
    """FE7 / SC1 / SC2 — calendar parts and cyclical encodings."""
    e = table(spark, sf, "events").select("event_id", "ts")
    return round_cols(FE.temporal_features(e, "ts").drop("ts"))


@register("scalar_functions_lineitem", """
SELECT l_orderkey, l_linenumber,
  round(l_extendedprice / (l_quantity + 1e-6), 6) AS price_per_qty,
  round(l_discount / (abs(l_tax - 0.04) + 1e-6), 6) AS disc_over_tax_dev,
  round(greatest(least(l_discount, 0.08), 0.02), 6) AS discount_clipped,
  round(ln(1 + l_extendedprice), 6) AS log_price,
  round(l_extendedprice, 1) AS price_1dp,
  round(greatest(least(l_discount * 10, 1 - 1e-10), 1e-10), 6) AS discount_prob
FROM lineitem""")
def scalar_functions_lineitem(spark, sf):
    """SC3/SC4/SC5/SC9/SC10 — safe ratios, clip, log1p, round, probability clip."""
    li = table(spark, sf, "lineitem")
    out = li.select("l_orderkey", "l_linenumber",
                    S.safe_ratio("l_extendedprice", "l_quantity").alias("price_per_qty"),
                    S.safe_ratio(F.col("l_discount"), F.col("l_tax") - 0.04, absolute=True).alias("disc_over_tax_dev"),
                    S.clip("l_discount", 0.02, 0.08).alias("discount_clipped"),
                    S.log1p("l_extendedprice").alias("log_price"),
                    S.round_to("l_extendedprice", 1).alias("price_1dp"),
                    S.clip_prob(F.col("l_discount") * 10).alias("discount_prob"))
    return round_cols(out, cols=["price_per_qty", "disc_over_tax_dev", "discount_clipped", "log_price", "discount_prob"])


SHIFT_SQL = """CASE WHEN hour(ts) > -1 AND hour(ts) <= 6 THEN 'Night' WHEN hour(ts) > 6 AND hour(ts) <= 14 THEN 'Morning'
                    WHEN hour(ts) > 14 AND hour(ts) <= 22 THEN 'Evening' WHEN hour(ts) > 22 AND hour(ts) <= 24 THEN 'Late' END"""


@register("shift_counts_events", f"""
SELECT {SHIFT_SQL} AS shift, count(*) AS rows, round(avg({ERR_SQL}), 6) AS error_rate FROM events GROUP BY 1""")
def shift_counts_events(spark, sf):
    """SC6 — right-closed hour buckets into shifts."""
    e = events_labelled(spark, sf)
    return round_cols(e.groupBy(S.shift_of("ts").alias("shift")).agg(F.count(F.lit(1)).alias("rows"),
                                                                     F.avg("is_error").alias("error_rate")))


ORDERS_SPLIT_SQL = """os AS (SELECT *, CASE WHEN rn < CAST(floor(n * 0.70) AS BIGINT) THEN 'train'
                                WHEN rn < CAST(floor(n * 0.85) AS BIGINT) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders))"""


@register("quantile_class_orders", "WITH " + ORDERS_SPLIT_SQL + """,
q AS (SELECT quantile_cont(o_totalprice, 0.33) AS lo, quantile_cont(o_totalprice, 0.67) AS hi FROM os WHERE split = 'train')
SELECT split, CAST(CASE WHEN o_totalprice <= lo THEN 0 WHEN o_totalprice <= hi THEN 1 ELSE 2 END AS INTEGER) AS price_class,
       count(*) AS rows
FROM os, q GROUP BY 1, 2""")
def quantile_class_orders(spark, sf):
    """SC7 — 3 classes from train-split quantiles .33/.67, applied to every split."""
    o = TS.time_split(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"])
    from ..operators.core import quantile_values

    qv = quantile_values(o.filter("split = 'train'"), ["o_totalprice"], [0.33, 0.67])
    lo, hi = qv[("o_totalprice", 0.33)], qv[("o_totalprice", 0.67)]
    return o.groupBy("split", S.quantile_class("o_totalprice", lo, hi).alias("price_class")).agg(F.count(F.lit(1)).alias("rows"))


@register("clean_names_customer", r"""
SELECT c_custkey, regexp_replace(regexp_replace(trim(c_name), '[^A-Za-z0-9_\s]', '', 'g'), '\s+', '_', 'g') AS c_name_clean,
       lower(c_mktsegment) AS segment, ends_with(c_mktsegment, 'URE') AS ends_ure, contains(c_mktsegment, 'HOLD') AS has_hold
FROM customer""")
def clean_names_customer(spark, sf):
    """SC8 — regex replace / trim / lower / endswith / contains."""
    cu = table(spark, sf, "customer")
    return cu.select("c_custkey", S.clean_text("c_name").alias("c_name_clean"), F.lower("c_mktsegment").alias("segment"),
                     F.col("c_mktsegment").endswith("URE").alias("ends_ure"),
                     F.col("c_mktsegment").contains("HOLD").alias("has_hold"))


READING_SPECS = (
    ("price_per_qty", "ratio", "l_extendedprice", "l_quantity"),
    ("disc_tax_diff", "diff", "l_discount", "l_tax"),
    ("balance_ratio", "abs_ratio", "c_acctbal", "s_acctbal"),
    ("missing_input", "ratio", "not_a_column", "l_tax"),
)


@register("constructed_features_readings", "WITH " + READINGS_SQL + """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / (l_quantity + 1e-6), 6) AS price_per_qty,
       round(l_discount - l_tax, 6) AS disc_tax_diff, round(c_acctbal / (abs(s_acctbal) + 1e-6), 6) AS balance_ratio
FROM readings""")
def constructed_features_readings(spark, sf):
    """FE8 — declarative ratio/difference specs, each only if both inputs exist."""
    df, made = FE.constructed_features(readings(spark, sf), READING_SPECS)
    return round_cols(df.select("l_orderkey", "l_linenumber", *made), cols=made)


LOG_CANDIDATES = ["l_quantity", "l_extendedprice", "o_totalprice", "price_per_qty"]


@register("log_skewed_readings", "WITH " + READINGS_SQL + ",\nr2 AS (SELECT *, l_extendedprice / (l_quantity + 1e-6) AS price_per_qty FROM readings)\n" + _union(
    [f"""SELECT '{x}' AS feature, round(skewness({x}), 6) AS skewness, bool_and({x} > 0) AS all_positive,
       abs(skewness({x})) > 2 AND bool_and({x} > 0) AS log_applied FROM r2""" for x in LOG_CANDIDATES]))
def log_skewed_readings(spark, sf):
    """FE9 — which columns get log1p (|skew| > 2 and all positive)."""
    df, _ = FE.constructed_features(readings(spark, sf), READING_SPECS[:1])
    row = df.agg(*[a for x in LOG_CANDIDATES for a in (Q.bias_corrected_skew(F.col(x)).alias(f"{x}__skewness"),
                                                       F.bool_and(F.col(x) > 0).alias(f"{x}__all_positive"))])
    out = unpivot_metrics(row, LOG_CANDIDATES, ["skewness", "all_positive"], key="feature")
    _, made = FE.log_skewed(df, LOG_CANDIDATES)
    return round_cols(out.withColumn("log_applied", F.concat("feature", F.lit("_log")).isin(made)))


SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("scaled_lineitem", """
SELECT l_orderkey, l_linenumber,
  round((l_quantity - (SELECT min(l_quantity) FROM lineitem)) / ((SELECT max(l_quantity) FROM lineitem) - (SELECT min(l_quantity) FROM lineitem)), 6) AS mm_quantity,
  round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_pop(l_extendedprice) FROM lineitem), 6) AS z_price,
  round((l_discount - (SELECT median(l_discount) FROM lineitem)) /
        ((SELECT quantile_cont(l_discount, 0.75) FROM lineitem) - (SELECT quantile_cont(l_discount, 0.25) FROM lineitem)), 6) AS robust_discount
FROM lineitem""")
def scaled_lineitem(spark, sf):
    """FE2/FE3/FE4 — min–max, population z-score, median/IQR scaling."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    li = FE.minmax(li, ["l_quantity"])
    li = FE.standardize(li, ["l_extendedprice"])
    li = FE.robust_scale(li, ["l_discount"])
    return round_cols(li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("mm_quantity"),
                                F.col("l_extendedprice").alias("z_price"), F.col("l_discount").alias("robust_discount")))


@register("quantile_bins_orders", """
WITH e AS (SELECT quantile_cont(o_totalprice, [0.2, 0.4, 0.6, 0.8]) AS q FROM orders)
SELECT CAST((o_totalprice >= q[1])::INT + (o_totalprice >= q[2])::INT + (o_totalprice >= q[3])::INT
            + (o_totalprice >= q[4])::INT AS INTEGER) AS o_totalprice_bin, count(*) AS rows
FROM orders, e GROUP BY 1""")
def quantile_bins_orders(spark, sf):
    """FE5 — 5-quantile ordinal bins ([a, b), last closed)."""
    b = FE.quantile_bins(table(spark, sf, "orders"), "o_totalprice", 5)
    return b.groupBy("o_totalprice_bin").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------------------
# FE10–FE19 scores
# ---------------------------------------------------------------------------

@register("f_regression_readings", "WITH " + READINGS_SQL + ",\nk AS (" + _union(
    [f"""SELECT '{x}' AS feature, corr({x}, l_extendedprice) AS r,
       count(*) FILTER (WHERE {x} IS NOT NULL AND l_extendedprice IS NOT NULL) AS n FROM readings""" for x in IMP_COLS]) + """)
SELECT feature, round(r, 6) AS r, n, round(r * r / (1 - r * r) * (n - 2), 6) AS f_score FROM k""")
def f_regression_readings(spark, sf):
    """FE10 — univariate regression F per feature (p-values via ``FE.f_regression``)."""
    return round_cols(FE.f_regression_stats(readings(spark, sf), IMP_COLS, "l_extendedprice"))


ANOVA_COLS = ["l_quantity", "l_extendedprice", "o_totalprice"]


@register("f_classif_readings", "WITH " + LABELLED_SQL + ",\ng AS (SELECT anomaly_label, " + ", ".join(
    f"count({x}) AS n_{x}, avg({x}) AS m_{x}" for x in ANOVA_COLS) + " FROM labelled GROUP BY 1),\nt AS (" + _union(
    [f"""SELECT '{x}' AS feature, (SELECT sum(n_{x}) FROM g) AS "N", (SELECT count(*) FILTER (WHERE n_{x} > 0) FROM g) AS k,
       (SELECT sum(n_{x} * (m_{x} - a) * (m_{x} - a)) FROM g, (SELECT avg({x}) AS a FROM labelled)) AS ssb,
       (SELECT sum(({x} - m_{x}) * ({x} - m_{x})) FROM labelled JOIN g USING (anomaly_label)) AS ssw"""
     for x in ANOVA_COLS]) + """)
SELECT feature, CAST("N" AS BIGINT) AS "N", k, round(ssb / "N", 4) AS ssb, round(ssw / "N", 4) AS ssw,
       round((ssb / (k - 1)) / (ssw / ("N" - k)), 4) AS f_score FROM t""")
def f_classif_readings(spark, sf):
    """FE11 — one-way ANOVA F per feature across label classes."""
    out = FE.anova_sums(labelled_readings(spark, sf), ANOVA_COLS, "anomaly_label")
    return out.select("feature", F.col("N").cast("long").alias("N"), "k", F.round(F.col("ssb") / F.col("N"), 4).alias("ssb"),
                      F.round(F.col("ssw") / F.col("N"), 4).alias("ssw"), F.round("f_score", 4).alias("f_score"))


@register("select_k_best_readings", "WITH " + READINGS_SQL + ",\nk AS (" + _union(
    [f"""SELECT '{x}' AS feature, corr({x}, l_extendedprice) AS r,
       count(*) FILTER (WHERE {x} IS NOT NULL AND l_extendedprice IS NOT NULL) AS n FROM readings""" for x in IMP_COLS]) + """)
SELECT feature, round(r * r / (1 - r * r) * (n - 2), 6) AS f_score FROM k ORDER BY f_score DESC, feature LIMIT 3""")
def select_k_best_readings(spark, sf):
    """FE12 / TK2 — top-3 features by F (the limit is the feature)."""
    s = FE.f_regression_stats(readings(spark, sf), IMP_COLS, "l_extendedprice").select("feature", "f_score")
    return round_cols(FE.select_k_best(s, 3))


@register("mutual_info_quantity_returnflag", """
WITH j AS (SELECT l_quantity AS x, l_returnflag AS y, count(*) AS nxy FROM lineitem GROUP BY 1, 2),
t AS (SELECT nxy, sum(nxy) OVER (PARTITION BY x) AS nx, sum(nxy) OVER (PARTITION BY y) AS ny, sum(nxy) OVER () AS n FROM j)
SELECT 'l_quantity' AS feature, round(sum(nxy / n * ln(nxy * n / (nx * ny))), 6) AS mutual_info FROM t""")
def mutual_info_quantity_returnflag(spark, sf):
    """FE14 — plug-in mutual information, every distinct value a category."""
    return round_cols(FE.mutual_info_discrete(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag"))


@register("mutual_info_binned_readings")
def mutual_info_binned_readings(spark, sf):
    """FE13 (re-aimed) — equal-frequency binned MI with the negative-value label."""
    return FE.mutual_info_binned(labelled_readings(spark, sf), ["l_quantity", "l_extendedprice", "o_totalprice"],
                                 "anomaly_label", bins=10)


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]


@register("corr_with_price_readings", "WITH " + READINGS_SQL + "\n" + _union(
    [f"""SELECT '{x}' AS feature, round(corr({x}, l_extendedprice), 6) AS correlation,
       round(abs(corr({x}, l_extendedprice)), 6) AS abs_correlation FROM readings""" for x in CORR_COLS if x != "l_extendedprice"]))
def corr_with_price_readings(spark, sf):
    """FE17 — correlation of every feature with the target (target excluded)."""
    return round_cols(FE.corr_with(readings(spark, sf), "l_extendedprice", CORR_COLS))


@register("corr_matrix_readings", "WITH " + READINGS_SQL + "\n" + _union(
    [f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM readings"""
     for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]))
def corr_matrix_readings(spark, sf):
    """FE18 — pairwise correlations in one aggregate."""
    return round_cols(FE.corr_matrix(readings(spark, sf), CORR_COLS))


@register("high_corr_pairs_readings", "WITH " + READINGS_SQL + "\nSELECT * FROM (" + _union(
    [f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM readings"""
     for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]) + ") WHERE abs(correlation) > 0.5")
def high_corr_pairs_readings(spark, sf):
    """FE18 — pairs above a |r| threshold."""
    return round_cols(FE.high_corr_pairs(readings(spark, sf), CORR_COLS, 0.5))


@register("vif_lineitem")
def vif_lineitem(spark, sf):
    """FE19 — uncentred VIF from one XᵀX aggregate."""
    return FE.vif(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register("yeo_johnson_orders")
def yeo_johnson_orders(spark, sf):
    """FE1 — Yeo–Johnson λ by maximum likelihood in aggregates; summary of the transformed column."""
    # joined once: the skews, the fit, the means and the summary read the written columns
    r = written(readings(spark, sf).select("o_totalprice", "l_extendedprice", "c_acctbal"))
    out, lams = FE.yeo_johnson(r, ["o_totalprice", "l_extendedprice", "c_acctbal"], min_abs_skew=0.0, stored=True)
    return out.agg(*[a for x in lams for a in (F.lit(lams[x]).alias(f"{x}__lambda"), F.avg(x + "_yj").alias(f"{x}__mean"),
                                               F.stddev_pop(x + "_yj").alias(f"{x}__std"))]) \
        .transform(lambda row: unpivot_metrics(row, list(lams), ["lambda", "mean", "std"], key="feature"))


@register("rf_importance_readings")
def rf_importance_readings(spark, sf):
    """FE15 — forest importances for the negative-value label (balanced weights). The readings are
    joined and written once, dealt to all tasks: the forest reads them twice, and broadcast joins leave them in the parts of the file.
    Their keys tell equal rows apart, which the bootstrap draws one by one."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    features = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]
    lab = SP.with_class_weight(written(labelled_readings(spark, sf, parts).select("l_orderkey", "l_linenumber", *features, "anomaly_label")), "anomaly_label")
    return FE.rf_importance(lab, features, "anomaly_label", trees=100, weight_col="weight", max_depth=10)


@register("pca_variance_lineitem")
def pca_variance_lineitem(spark, sf):
    """FE16 + WN12 — explained variance and its cumulative sum."""
    return FE.pca_variance(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], k=4)


# ---------------------------------------------------------------------------
# SP*
# ---------------------------------------------------------------------------

@register("hash_sample_events")
def hash_sample_events(spark, sf):
    """SP1 — deterministic 500-row sample by key hash (the limit is the feature)."""
    return SP.sample_n(table(spark, sf, "events"), 500, ["event_id"])


@register("stratified_split_counts_events", f"""
WITH c AS (SELECT {ERR_SQL} AS is_error, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT is_error, 'train' AS split, CAST(floor(n * 0.70) AS BIGINT) AS rows FROM c
      UNION ALL SELECT is_error, 'validation', CAST(floor(n * 0.85) - floor(n * 0.70) AS BIGINT) FROM c
      UNION ALL SELECT is_error, 'test', CAST(n - floor(n * 0.85) AS BIGINT) FROM c)
SELECT split, is_error, rows FROM s WHERE rows > 0""")
def stratified_split_counts_events(spark, sf):
    """SP2 — per-class 70/15/15 split in hash order; class counts per split."""
    s = SP.stratified_split(events_labelled(spark, sf), "is_error", ["event_id"])
    return s.groupBy("split", "is_error").agg(F.count(F.lit(1)).alias("rows"))


@register("split_rates_events", "WITH " + SPLIT_SQL + f""",
l AS (SELECT split, {ERR_SQL} AS is_error FROM sp),
o AS (SELECT avg(is_error) AS overall_rate FROM l)
SELECT split, count(*) AS rows, round(avg(is_error), 6) AS rate, round(min(overall_rate), 6) AS overall_rate,
       round(abs(avg(is_error) - min(overall_rate)) / min(overall_rate) * 100, 6) AS deviation_pct,
       abs(avg(is_error) - min(overall_rate)) / min(overall_rate) * 100 > 20 AS adjust
FROM l, o GROUP BY split""")
def split_rates_events(spark, sf):
    """SP3 — label rate per split vs overall."""
    s = TS.time_split(events_labelled(spark, sf), EV_ORDER)
    return round_cols(SP.split_rates(s, "is_error"))


@register("resampled_split_counts_events", "WITH " + SPLIT_SQL + f""",
l AS (SELECT split, {ERR_SQL} AS is_error FROM sp),
o AS (SELECT avg(is_error) AS rate FROM l),
per AS (SELECT split, count(*) AS n, abs(avg(is_error) - min(rate)) / min(rate) * 100 > 20 AS adj,
               CAST(floor(count(*) * min(rate)) AS BIGINT) AS ta FROM l, o GROUP BY split),
cls AS (SELECT split, is_error, count(*) AS have FROM l GROUP BY 1, 2)
SELECT c.split, c.is_error, CASE WHEN p.adj THEN least(c.have, CASE WHEN c.is_error = 1 THEN p.ta ELSE p.n - p.ta END)
                                 ELSE c.have END AS rows
FROM cls c JOIN per p ON c.split = p.split""")
def resampled_split_counts_events(spark, sf):
    """SP4 — within-split resampling to the overall rate (only where it deviates > 20 %)."""
    s = TS.time_split(events_labelled(spark, sf), EV_ORDER)
    r = SP.resample_to_rate(s, "is_error", ["event_id"], order=EV_ORDER)
    return r.groupBy("split", "is_error").agg(F.count(F.lit(1)).alias("rows"))


@register("class_weights_readings", "WITH " + LABELLED_SQL + """,
c AS (SELECT anomaly_label AS class, count(*) AS count FROM labelled GROUP BY 1)
SELECT class, count, round((SELECT sum(count) FROM c) / ((SELECT count(*) FROM c) * count), 6) AS weight,
       round((SELECT count FROM c WHERE class = 0) / (SELECT count FROM c WHERE class = 1), 6) AS pos_weight FROM c""")
def class_weights_readings(spark, sf):
    """SP6 — balanced class weights and n₀/n₁."""
    return round_cols(SP.class_weights(labelled_readings(spark, sf), "anomaly_label"))


@register("time_folds_events", """
SELECT CAST(least(floor(rn * 5 / n), 4) AS INTEGER) AS fold, count(*) AS rows, min(ts) AS start, max(ts) AS "end"
FROM (SELECT ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS rn, count(*) OVER () AS n FROM events) GROUP BY 1""")
def time_folds_events(spark, sf):
    """SP7 — time-ordered folds: contiguous position ranges."""
    f = SP.kfold(table(spark, sf, "events"), 5, order=EV_ORDER)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), F.min("ts").alias("start"), F.max("ts").alias("end"))


@register("stratified_folds_events", f"""
WITH c AS (SELECT {ERR_SQL} AS is_error, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(f AS INTEGER) AS fold, is_error, CAST((n - f + 4) // 5 AS BIGINT) AS rows
FROM c, (SELECT unnest(range(0, 5)) AS f) WHERE (n - f + 4) // 5 > 0""")
def stratified_folds_events(spark, sf):
    """SP7 — stratified shuffled folds: even ranges of each class's hash order."""
    f = SP.kfold(events_labelled(spark, sf), 5, label="is_error", key=["event_id"])
    return f.groupBy("fold", "is_error").agg(F.count(F.lit(1)).alias("rows"))


@register("split_summary_events", "WITH " + SPLIT_SQL + f"""
SELECT split, count(*) AS rows, CAST(sum({ERR_SQL}) AS BIGINT) AS anomalies, round(avg({ERR_SQL}), 6) AS anomaly_rate,
       min(ts) AS start, max(ts) AS "end", round(count(*) / (SELECT count(*) FROM events), 6) AS share
FROM sp GROUP BY split""")
def split_summary_events(spark, sf):
    """SP8 — sizes, rates and time ranges per split."""
    s = TS.time_split(events_labelled(spark, sf), EV_ORDER)
    return round_cols(SP.split_summary(s, "is_error", "ts"))


@register("leakage_check_readings", "WITH " + READINGS_SQL + "\n" + _union(
    [f"""SELECT '{x}' AS feature, round(corr({x}, l_extendedprice), 6) AS correlation,
       round(abs(corr({x}, l_extendedprice)), 6) AS abs_correlation, abs(corr({x}, l_extendedprice)) > 0.99 AS leaky
       FROM readings""" for x in ["l_quantity", "l_discount", "o_totalprice", "l_extendedprice_copy"]]).replace(
    "l_extendedprice_copy", "(l_extendedprice * 1.0)").replace("'(l_extendedprice * 1.0)'", "'price_copy'"))
def leakage_check_readings(spark, sf):
    """SP9 — |corr| with the target above .99 flags a leaky feature."""
    r = readings(spark, sf).withColumn("price_copy", F.col("l_extendedprice") * 1.0)
    return round_cols(SP.leakage_check(r, "l_extendedprice", ["l_quantity", "l_discount", "o_totalprice", "price_copy"]))
