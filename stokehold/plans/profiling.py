"""Profiling and cleaning plans on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.core import round_cols
from .registry import register, table

LINEITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _iqr_label(events):
    b = Q.outlier_bounds(events, ["value"]).select("value__lower", "value__upper")
    lab = events.crossJoin(F.broadcast(b))  # one-row frame of fences
    return lab.withColumn("is_outlier", ((F.col("value") < F.col("value__lower")) |
                                         (F.col("value") > F.col("value__upper"))).cast("int"))


@register("anomaly_rate_by_hour", """
WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
lab AS (SELECT CAST(hour(ts) AS INTEGER) AS bucket,
               CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END AS is_outlier
        FROM events, b)
SELECT bucket, CAST(sum(is_outlier) AS BIGINT) AS anomalies, count(*) AS rows,
       round(avg(is_outlier), 6) AS anomaly_rate
FROM lab GROUP BY bucket
""")
def anomaly_rate_by_hour(spark, sf):
    """Flagship: IQR-fence outlier label on events.value → anomaly rate per hour (CL2 + AG11)."""
    lab = _iqr_label(table(spark, sf, "events"))
    return round_cols(Q.anomaly_rate_by(lab, F.hour("ts"), "is_outlier"))


# ---------------------------------------------------------------------------
# shared derived frames (and the same frames in SQL)
# ---------------------------------------------------------------------------

READING_SOURCES = ["margin", "c_acctbal", "s_acctbal"]


def readings(spark, sf, parts=None):
    """Wide numeric table: lineitem with its order, customer and supplier
    (JN1 left joins). ``margin = l_discount - l_tax`` is the third source that
    can go negative. Orders meet their customers before lineitem, which is thus not shuffled
    for them; ``parts``: lineitem is dealt to as many by order, which also serves the join."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cu = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    su = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    if parts:
        li = li.repartition(parts, "l_orderkey")
    o = o.join(cu, o.o_custkey == cu.c_custkey, "left")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left").join(su, li.l_suppkey == su.s_suppkey, "left")
    return j.select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("ts"), "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax", (F.col("l_discount") - F.col("l_tax")).alias("margin"),
                    "o_totalprice", "c_acctbal", "s_acctbal")


READINGS_SQL = """readings AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate AS ts, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_discount - l.l_tax AS margin, o.o_totalprice, c.c_acctbal, s.s_acctbal
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
       LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

NEG_SQL = "(coalesce(margin < 0, false) OR coalesce(c_acctbal < 0, false) OR coalesce(s_acctbal < 0, false))"
LABELLED_SQL = READINGS_SQL + f""",
labelled AS (SELECT *, CAST({NEG_SQL} AS INTEGER) AS anomaly_label FROM readings)"""


def labelled_readings(spark, sf, parts=None):
    return Q.label_negative(readings(spark, sf, parts), READING_SOURCES, label="anomaly_label")


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------------------
# AG* profiles
# ---------------------------------------------------------------------------

def _validation_sql(cols, tbl):
    return _union([f"""SELECT '{x}' AS "column", count({x}) AS count, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS std, round(CAST(min({x}) AS DOUBLE), 6) AS min,
  round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50,
  round(quantile_cont({x}, 0.75), 6) AS q75, round(CAST(max({x}) AS DOUBLE), 6) AS max,
  count(*) - count({x}) AS missing, round((count(*) - count({x})) / count(*) * 100, 6) AS missing_pct,
  count_if({x} < 0) AS negative_count, count_if({x} = 0) AS zero_count FROM {tbl}""" for x in cols])


@register("validation_stats_lineitem", _validation_sql(LINEITEM_NUM, "lineitem"))
def validation_stats_lineitem(spark, sf):
    """AG1 — describe + missing/negative/zero counts, one scan for all columns."""
    return round_cols(Q.validation_stats(table(spark, sf, "lineitem"), LINEITEM_NUM))


DOC_LABEL_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


def doc_labels(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf, "labels")
    return d.join(lab, "doc_id", "left")


DOC_LABELS_SQL = """dl AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


@register("missing_report_doc_labels", "WITH " + DOC_LABELS_SQL + "\nSELECT * FROM (" + _union(
    [f"""SELECT '{x}' AS "column", count(*) - count({x}) AS missing_count,
       round((count(*) - count({x})) / count(*) * 100, 6) AS missing_pct FROM dl""" for x in DOC_LABEL_COLS])
    + ") WHERE missing_count > 0")
def missing_report_doc_labels(spark, sf):
    """AG2 — columns with nulls after documents ⟕ labels."""
    return round_cols(Q.missing_report(doc_labels(spark, sf), DOC_LABEL_COLS))


CUSTOMER_TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                  "c_mktsegment": "string"}


def _dictionary_sql():
    parts = []
    for x, t in CUSTOMER_TYPES.items():
        numeric = t in ("bigint", "int", "double")
        stats = (f"round(CAST(min({x}) AS DOUBLE), 6) AS min, round(CAST(max({x}) AS DOUBLE), 6) AS max, "
                 f"round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std") if numeric else \
            "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std"
        parts.append(f"""SELECT '{x}' AS "column", '{t}' AS dtype, count({x}) AS non_null, count(*) - count({x}) AS null_count,
  CAST(count(DISTINCT {x}) AS BIGINT) AS "unique", {stats} FROM customer""")
    return _union(parts)


@register("data_dictionary_customer", _dictionary_sql())
def data_dictionary_customer(spark, sf):
    """AG3 — dtype, non-null, null, unique, min, max, mean, std."""
    return round_cols(Q.data_dictionary(table(spark, sf, "customer")))


@register("quality_report_orders", """
WITH b AS (SELECT count(*) AS r, sum((o_orderkey IS NULL)::INT + (o_custkey IS NULL)::INT + (o_orderstatus IS NULL)::INT
                 + (o_totalprice IS NULL)::INT + (o_orderdate IS NULL)::INT + (o_orderpriority IS NULL)::INT) AS m,
                 (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS d FROM orders),
a AS (SELECT count(*) AS r, sum((o_orderkey IS NULL)::INT + (o_custkey IS NULL)::INT + (o_totalprice IS NULL)::INT
                 + (o_orderdate IS NULL)::INT) AS m,
                 (SELECT count(*) FROM (SELECT DISTINCT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders)) AS d FROM orders)
SELECT * FROM (VALUES
 ('rows', (SELECT CAST(r AS DOUBLE) FROM b), (SELECT CAST(r AS DOUBLE) FROM a)),
 ('columns', 6.0, 4.0),
 ('missing_cells', (SELECT CAST(m AS DOUBLE) FROM b), (SELECT CAST(m AS DOUBLE) FROM a)),
 ('numeric_columns', 3.0, 3.0),
 ('non_numeric_columns', 3.0, 1.0),
 ('duplicate_rows', (SELECT CAST(r - d AS DOUBLE) FROM b), (SELECT CAST(r - d AS DOUBLE) FROM a))
) t(metric, before, after)
""")
def quality_report_orders(spark, sf):
    """AG4 — before/after quality report around a column selection."""
    o = table(spark, sf, "orders")
    return Q.quality_report(o, o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))


@register("overview_events", """
SELECT count(*) AS rows, 7 AS columns,
       (SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) FROM (SELECT count(*) AS k FROM e GROUP BY ALL_COLS)) AS duplicate_rows,
       min(ts) AS start, max(ts) AS "end", CAST(sum(is_error) AS BIGINT) AS anomaly_count,
       round(avg(is_error) * 100, 6) AS anomaly_pct
FROM e
""".replace("FROM e GROUP BY ALL_COLS", "FROM events GROUP BY event_id, ts, user_id, event_type, value, props")
    .replace("\nFROM e\n", "\nFROM (SELECT *, CAST(event_type = 'error' AS INTEGER) AS is_error FROM events)\n"))
def overview_events(spark, sf):
    """AG5 — rows, columns, duplicates, time range and label rate in one row."""
    e = table(spark, sf, "events").withColumn("is_error", (F.col("event_type") == "error").cast("int"))
    return round_cols(Q.overview(e, "ts", "is_error"))


def _univariate_sql(cols, tbl):
    return _union([f"""SELECT '{x}' AS "column", count({x}) AS count, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS std, round(CAST(min({x}) AS DOUBLE), 6) AS min,
  round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50,
  round(quantile_cont({x}, 0.75), 6) AS q75, round(CAST(max({x}) AS DOUBLE), 6) AS max,
  round(skewness({x}), 6) AS skewness, round(kurtosis({x}), 6) AS kurtosis,
  round(abs(stddev_samp({x}) / avg({x})), 6) AS cv FROM {tbl}""" for x in cols])


@register("univariate_stats_lineitem", _univariate_sql(LINEITEM_NUM, "lineitem"))
def univariate_stats_lineitem(spark, sf):
    """AG6 — describe + bias-corrected skewness and kurtosis + cv."""
    return round_cols(Q.univariate_stats(table(spark, sf, "lineitem"), LINEITEM_NUM))


READING_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "margin", "o_totalprice", "c_acctbal", "s_acctbal"]


@register("classify_negatives_readings", "WITH " + READINGS_SQL + ",\nneg AS (" + _union(
    [f"""SELECT '{x}' AS "column", count_if({x} < 0) AS negative_count, count_if({x} < 0) / count(*) * 100 AS p,
       round(CAST(min({x}) AS DOUBLE), 6) AS min, round(CAST(max({x}) AS DOUBLE), 6) AS max,
       round(avg({x}), 6) AS mean FROM readings""" for x in READING_NUM]) + """)
SELECT "column", negative_count, round(p, 6) AS negative_pct, min, max, mean,
  CASE WHEN p > 99 THEN 'BY_DESIGN (always negative)' WHEN p > 10 THEN 'HIGH_NEGATIVE (investigate)'
       WHEN p > 1 THEN 'MODERATE_NEGATIVE (likely anomaly)' ELSE 'RARE_NEGATIVE (sensor anomaly)' END AS category
FROM neg WHERE negative_count > 0""")
def classify_negatives_readings(spark, sf):
    """AG7 — columns with negatives, their share and band."""
    return round_cols(Q.classify_negatives(readings(spark, sf), READING_NUM))


@register("class_balance_readings", "WITH " + LABELLED_SQL + """,
cnt AS (SELECT anomaly_label AS class, count(*) AS count FROM labelled GROUP BY 1)
SELECT class, count, round(count / (SELECT sum(count) FROM cnt) * 100, 6) AS pct,
       round((SELECT max(count) FROM cnt) / (SELECT min(count) FROM cnt), 6) AS imbalance_ratio FROM cnt""")
def class_balance_readings(spark, sf):
    """AG9 — class counts, shares and imbalance ratio of the negative-value label."""
    return round_cols(Q.class_balance(labelled_readings(spark, sf), "anomaly_label"))


@register("temporal_profile_events", """
SELECT 'hour' AS part, CAST(hour(ts) AS INTEGER) AS bucket, round(avg(value), 6) AS mean, count(value) AS n FROM events GROUP BY 2
UNION ALL
SELECT 'weekday' AS part, CAST(isodow(ts) - 1 AS INTEGER) AS bucket, round(avg(value), 6) AS mean, count(value) AS n FROM events GROUP BY 2
""")
def temporal_profile_events(spark, sf):
    """AG10 — mean value by hour and by weekday (Monday = 0)."""
    return round_cols(Q.temporal_profile(table(spark, sf, "events"), "ts", "value"))


@register("error_rate_by_weekday", """
SELECT CAST(isodow(ts) - 1 AS INTEGER) AS bucket, CAST(sum(is_error) AS BIGINT) AS anomalies, count(*) AS rows,
       round(avg(is_error), 6) AS anomaly_rate
FROM (SELECT ts, CAST(event_type = 'error' AS INTEGER) AS is_error FROM events) GROUP BY 1
""")
def error_rate_by_weekday(spark, sf):
    """AG11 — label sum/count/mean per weekday."""
    e = table(spark, sf, "events").withColumn("is_error", (F.col("event_type") == "error").cast("int"))
    return round_cols(Q.anomaly_rate_by(e, F.weekday("ts"), "is_error"))


COMPARE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]


@register("compare_groups_readings", "WITH " + LABELLED_SQL + ",\nm AS (" + _union(
    [f"""SELECT '{x}' AS "column", avg({x}) FILTER (WHERE anomaly_label = 0) AS nm,
       avg({x}) FILTER (WHERE anomaly_label = 1) AS am FROM labelled""" for x in COMPARE_COLS]) + """)
SELECT "column", round(nm, 6) AS normal_mean, round(am, 6) AS anomaly_mean, round(am - nm, 6) AS difference,
       round(abs((am - nm) / nm) * 100, 6) AS diff_pct FROM m""")
def compare_groups_readings(spark, sf):
    """AG12 — class means, difference and |diff/normal| %."""
    return round_cols(Q.compare_groups(labelled_readings(spark, sf), "anomaly_label", COMPARE_COLS))


@register("source_breakdown_readings", "WITH " + READINGS_SQL + "\n" + _union(
    [f"""SELECT '{x}' AS source, count_if({x} < 0) AS negative_count, round(count_if({x} < 0) / count(*) * 100, 6) AS negative_pct,
       count_if({x} > 0) AS positive_count, round(count_if({x} > 0) / count(*) * 100, 6) AS positive_pct FROM readings"""
     for x in READING_SOURCES]))
def source_breakdown_readings(spark, sf):
    """AG13 — per-source negative/positive counts and shares."""
    return round_cols(Q.source_breakdown(readings(spark, sf), READING_SOURCES))


OVERLAP_COLS = ["l_quantity", "l_extendedprice", "o_totalprice"]


@register("range_overlap_readings", "WITH " + LABELLED_SQL + ",\nr AS (" + _union(
    [f"""SELECT '{x}' AS "column",
       CAST(min({x}) FILTER (WHERE anomaly_label = 0) AS DOUBLE) AS normal_min, CAST(max({x}) FILTER (WHERE anomaly_label = 0) AS DOUBLE) AS normal_max,
       CAST(min({x}) FILTER (WHERE anomaly_label = 1) AS DOUBLE) AS anomaly_min, CAST(max({x}) FILTER (WHERE anomaly_label = 1) AS DOUBLE) AS anomaly_max
       FROM labelled""" for x in OVERLAP_COLS]) + """)
SELECT "column", round(normal_min, 6) AS normal_min, round(normal_max, 6) AS normal_max, round(anomaly_min, 6) AS anomaly_min,
       round(anomaly_max, 6) AS anomaly_max,
       round(greatest(least(normal_max, anomaly_max) - greatest(normal_min, anomaly_min), 0.0), 6) AS overlap,
       least(normal_max, anomaly_max) >= greatest(normal_min, anomaly_min) AS has_overlap FROM r""")
def range_overlap_readings(spark, sf):
    """AG14 — class value ranges and their overlap."""
    return round_cols(Q.range_overlap(labelled_readings(spark, sf), "anomaly_label", OVERLAP_COLS))


@register("label_leakage_readings", "WITH " + LABELLED_SQL + ",\nk AS (" + _union(
    [f"""SELECT '{x}' AS source, corr({x}, CAST(anomaly_label AS DOUBLE)) AS r,
       count_if(coalesce({x} < 0, false) AND anomaly_label = 1) AS tp, count_if(coalesce({x} < 0, false)) AS flagged,
       count_if(anomaly_label = 1) AS pos FROM labelled""" for x in READING_SOURCES]) + """)
SELECT source, round(r, 6) AS corr, round(CASE WHEN flagged > 0 THEN tp / flagged ELSE 0 END, 6) AS precision,
       round(CASE WHEN pos > 0 THEN tp / pos ELSE 0 END, 6) AS recall FROM k""")
def label_leakage_readings(spark, sf):
    """AG15 — can the label be derived from each source?"""
    return round_cols(Q.label_leakage(labelled_readings(spark, sf), READING_SOURCES, "anomaly_label"))


@register("crosstab_returnflag_linestatus", """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2
""")
def crosstab_returnflag_linestatus(spark, sf):
    """AG16 — contingency table (long form)."""
    return Q.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@register("histogram_events_value", """
WITH r AS (SELECT CAST(min(value) AS DOUBLE) AS lo, CAST(max(value) AS DOUBLE) AS hi FROM events),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) AS bin, lo, hi
      FROM events, r WHERE value IS NOT NULL)
SELECT bin, round(min(lo) + bin * (min(hi) - min(lo)) / 50, 6) AS "left",
       round(min(lo) + (bin + 1) * (min(hi) - min(lo)) / 50, 6) AS "right", count(*) AS count
FROM b GROUP BY bin
""")
def histogram_events_value(spark, sf):
    """AG17 — 50 equal-width bins of events.value."""
    return round_cols(Q.histogram(table(spark, sf, "events"), "value", 50))


@register("box_stats_by_event_type", """
SELECT event_type, count(value) AS n, round(CAST(min(value) AS DOUBLE), 6) AS min,
  round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS q3, round(CAST(max(value) AS DOUBLE), 6) AS max,
  round(quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)), 6) AS lower_fence,
  round(quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)), 6) AS upper_fence
FROM events GROUP BY event_type
""")
def box_stats_by_event_type(spark, sf):
    """AG18 — five numbers and fences per group."""
    return round_cols(Q.box_stats(table(spark, sf, "events"), "value", "event_type"))


@register("search_effects_orders", """
SELECT o_orderpriority, o_orderstatus, round(avg(o_totalprice), 6) AS mean_o_totalprice, count(*) AS runs
FROM orders GROUP BY 1, 2
""")
def search_effects_orders(spark, sf):
    """AG19 — multi-key group mean, best first."""
    return round_cols(Q.search_effects(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], "o_totalprice"))


@register("duplicate_keys_lineitem", """
SELECT CAST(sum(k) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(k) - count(*) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS k FROM lineitem GROUP BY l_orderkey, l_linenumber)
""")
def duplicate_keys_lineitem(spark, sf):
    """AG20 — distinct and duplicate counts on (l_orderkey, l_linenumber)."""
    return Q.duplicate_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------------------
# PRJ* / FLT*
# ---------------------------------------------------------------------------

ORDERS_NUM = ["o_orderkey", "o_custkey", "o_totalprice"]


@register("constant_columns_readings", "WITH " + READINGS_SQL + "\n" + _union(
    [f"""SELECT '{x}' AS "column", CAST(count(DISTINCT {x}) + max(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_values,
       count(DISTINCT {x}) + max(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) <= 1 AS is_constant FROM readings""" for x in READING_NUM]))
def constant_columns_readings(spark, sf):
    """PRJ3 — nunique(dropna=False) per numeric column and the constant flag
    (``drop_constant_columns`` drops the flagged ones)."""
    r = readings(spark, sf)
    row = r.agg(*[(F.count_distinct(x) + F.max(F.when(F.col(x).isNull(), 1).otherwise(0))).cast("long").alias(f"{x}__n_values")
                  for x in READING_NUM])
    from ..operators.core import unpivot_metrics
    kept = Q.drop_constant_columns(r, READING_NUM).columns
    return unpivot_metrics(row, READING_NUM, ["n_values"]).withColumn("is_constant", ~F.col("column").isin(kept))


@register("time_sorted_orders", "SELECT * FROM orders")
def time_sorted_orders(spark, sf):
    """PRJ2 — detect the time column by name, parse, sort."""
    df, _ = Q.detect_time_column(table(spark, sf, "orders"), order_tiebreak=["o_orderkey"])
    return df


@register("projected_readings", "WITH " + READINGS_SQL + """
SELECT l_orderkey, l_linenumber, ts, l_quantity, l_extendedprice AS l_extendedprice_raw, l_discount, l_tax,
       o_totalprice, c_acctbal, s_acctbal FROM readings""")
def projected_readings(spark, sf):
    """PRJ5/PRJ6/PRJ7 — drop by suffix, rename with ``_raw``, drop leaky columns."""
    r = readings(spark, sf).withColumnRenamed("margin", "margin_smooth3")
    r = Q.drop_by_suffix(r, "_smooth3")
    r = Q.suffix_columns(r, ["l_extendedprice"], "_raw")
    return Q.drop_leaky(r.withColumn("price_copy", F.col("l_extendedprice_raw")), ["not_present", "price_copy"])


@register("negative_label_counts", "WITH " + LABELLED_SQL + """
SELECT anomaly_label, count(*) AS rows FROM labelled GROUP BY 1""")
def negative_label_counts(spark, sf):
    """FLT2 — OR over the negative-value predicates of all sources."""
    return labelled_readings(spark, sf).groupBy("anomaly_label").agg(F.count(F.lit(1)).alias("rows"))


@register("source_overlap_readings", "WITH " + READINGS_SQL + """
SELECT CAST(coalesce(margin < 0, false) AS INTEGER) + CAST(coalesce(c_acctbal < 0, false) AS INTEGER)
       + CAST(coalesce(s_acctbal < 0, false) AS INTEGER) AS n_sources, count(*) AS rows FROM readings GROUP BY 1""")
def source_overlap_readings(spark, sf):
    """FLT3 — how many sources fire per row."""
    return Q.source_overlap(readings(spark, sf), READING_SOURCES)


@register("any_source_readings", "WITH " + READINGS_SQL + f"""
SELECT count_if({NEG_SQL}) AS any_source_rows, count(*) AS rows FROM readings""")
def any_source_readings(spark, sf):
    """FLT4 — rows where any source fires."""
    return Q.any_source_count(readings(spark, sf), READING_SOURCES)


@register("anomalous_rows_readings", "WITH " + LABELLED_SQL + """
SELECT l_orderkey, l_linenumber, ts, margin, c_acctbal, s_acctbal FROM labelled WHERE anomaly_label = 1""")
def anomalous_rows_readings(spark, sf):
    """FLT1 — boolean row filter on the label."""
    return labelled_readings(spark, sf).filter(F.col("anomaly_label") == 1) \
        .select("l_orderkey", "l_linenumber", "ts", "margin", "c_acctbal", "s_acctbal")


# ---------------------------------------------------------------------------
# CL* cleaning
# ---------------------------------------------------------------------------

def _outlier_sql(cols, tbl):
    parts = []
    for x in cols:
        parts.append(f"""SELECT '{x}' AS "column", q1, q3, mu, sd, med, n,
  (SELECT quantile_cont(abs({x} - med), 0.5) FROM {tbl}) AS mad,
  (SELECT count_if({x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1)) FROM {tbl}) AS iqr_o,
  (SELECT count_if(abs(({x} - mu) / sd) > 3) FROM {tbl}) AS z_o,
  (SELECT count_if(abs(0.6745 * ({x} - med) / (SELECT quantile_cont(abs({x} - med), 0.5) FROM {tbl})) > 3.5) FROM {tbl}) AS mad_o
  FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3, avg({x}) AS mu, stddev_pop({x}) AS sd,
               quantile_cont({x}, 0.5) AS med, count({x}) AS n FROM {tbl})""")
    return "WITH s AS (" + _union(parts) + """)
SELECT "column", iqr_o AS iqr_outliers, z_o AS zscore_outliers, CASE WHEN mad > 0 THEN mad_o ELSE 0 END AS mad_outliers,
       n AS total, round(round(iqr_o / n * 100, 3), 6) AS iqr_pct FROM s WHERE n >= 10"""


@register("outlier_counts_lineitem", _outlier_sql(LINEITEM_NUM, "lineitem"))
def outlier_counts_lineitem(spark, sf):
    """CL2 — IQR / z-score / MAD outlier counts per column."""
    return round_cols(Q.detect_outliers(table(spark, sf, "lineitem"), LINEITEM_NUM))


WINSOR_COLS = ["l_quantity", "l_extendedprice", "o_totalprice", "c_acctbal"]


def _winsor_sql():
    parts = []
    for x in WINSOR_COLS:
        parts.append(f"""SELECT '{x}' AS "column", count({x}) AS n,
  round(sum(w), 4) AS total, round(CAST(min(w) AS DOUBLE), 6) AS min, round(CAST(max(w) AS DOUBLE), 6) AS max
  FROM (SELECT CASE WHEN sh > 0 AND sh < 0.05 AND n >= 10 THEN greatest(least({x}, hi), lo) ELSE {x} END AS w, {x}
        FROM readings, (SELECT lo, hi, n, count_if({x} < lo OR {x} > hi) / n AS sh
                        FROM readings, (SELECT quantile_cont({x}, 0.25) - 1.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)) AS lo,
                                               quantile_cont({x}, 0.75) + 1.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)) AS hi,
                                               count({x}) AS n FROM readings) GROUP BY lo, hi, n))""")
    return "WITH " + READINGS_SQL + "\n" + _union(parts)


@register("winsorized_readings", _winsor_sql())
def winsorized_readings(spark, sf):
    """CL3 — IQR-fence clipping only where 0 < outlier share < 5 %; summarised per column."""
    w = Q.winsorize(readings(spark, sf), WINSOR_COLS, materialize=True)
    row = w.agg(*[a for x in WINSOR_COLS for a in (
        F.count(x).alias(f"{x}__n"), F.round(F.sum(x), 4).alias(f"{x}__total"),
        F.min(x).cast("double").alias(f"{x}__min"), F.max(x).cast("double").alias(f"{x}__max"))])
    from ..operators.core import unpivot_metrics
    return round_cols(unpivot_metrics(row, WINSOR_COLS, ["n", "total", "min", "max"]), cols=["min", "max"])


def gappy_events(spark, sf):
    """events with derived gaps: 1 in 7 values missing (→ interpolate), 1 in 50
    (→ median), 1 in 40 types (→ mode), 2 in 3 (→ drop)."""
    e = table(spark, sf, "events")
    return e.select(
        "event_id", "ts",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v_interp"),
        F.when(F.col("event_id") % 50 != 0, F.col("value")).alias("v_median"),
        F.when(F.col("event_id") % 40 != 3, F.col("event_type")).alias("type_mode"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v_sparse"))


GAPPY_SQL = """g AS (SELECT event_id, ts,
  CASE WHEN event_id % 7 <> 0 THEN value END AS v_interp,
  CASE WHEN event_id % 50 <> 0 THEN value END AS v_median,
  CASE WHEN event_id % 40 <> 3 THEN event_type END AS type_mode,
  CASE WHEN event_id % 3 = 0 THEN value END AS v_sparse FROM events)"""

INTERP_SQL = """o AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS rn FROM g),
p AS (SELECT *,
  last_value(CASE WHEN v_interp IS NOT NULL THEN rn END IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi,
  last_value(v_interp IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN v_interp IS NOT NULL THEN rn END IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni,
  first_value(v_interp IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv FROM o)"""

INTERP_EXPR = """CASE WHEN v_interp IS NOT NULL THEN v_interp
       WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (rn - pi) / (ni - pi)
       WHEN pv IS NOT NULL THEN pv ELSE nv END"""


@register("imputed_events", "WITH " + GAPPY_SQL + ",\n" + INTERP_SQL + f"""
SELECT event_id, ts, round({INTERP_EXPR}, 6) AS v_interp,
       round(coalesce(v_median, (SELECT quantile_cont(v_median, 0.5) FROM g)), 6) AS v_median,
       coalesce(type_mode, (SELECT type_mode FROM g WHERE type_mode IS NOT NULL GROUP BY type_mode
                            ORDER BY count(*) DESC, type_mode LIMIT 1)) AS type_mode
FROM p""")
def imputed_events(spark, sf):
    """CL1 — drop > 50 % missing, interpolate numeric > 5 %, median otherwise, mode for strings."""
    return round_cols(Q.impute(gappy_events(spark, sf), order=["ts", "event_id"]))


@register("column_catalog_readings")
def column_catalog_readings(spark, sf):
    """AG8 / PRJ1 / FE6 — catalogue of the (name-normalised) columns: position, dtype, flags."""
    r = Q.normalize_columns(readings(spark, sf).withColumnRenamed("margin", "margin (net) smooth3"))
    cat = Q.column_catalog(r, ts="ts", smooth_suffix="smooth3")
    filled = Q.missing_report(r).select("column", "missing_count")  # one aggregate over the data
    return cat.join(filled, "column", "left").na.fill(0, ["missing_count"])


@register("assembled_readings", "WITH " + READINGS_SQL + """
SELECT count(*) AS rows, 3 AS width,
       round(sum(abs(coalesce(l_quantity, 0)) + abs(coalesce(c_acctbal, 0)) + abs(coalesce(s_acctbal, 0))), 2) AS l1_total FROM readings""")
def assembled_readings(spark, sf):
    """PRJ8 — null → 0 on the features and one vector column (summarised by its size and L1 norm)."""
    from pyspark.ml.functions import vector_to_array

    a = Q.assemble(readings(spark, sf), ["l_quantity", "c_acctbal", "s_acctbal"])
    arr = vector_to_array(F.col("features"))
    return a.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size(arr)).alias("width"),
                 F.round(F.sum(F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + F.abs(v))), 2).alias("l1_total"))
