"""Statistical-test plans. SQL oracles check the statistics;
p-values come from driver tails and are covered by unit tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as ST
from ..operators.core import round_cols
from .profiling import READINGS_SQL, readings
from .registry import register, table
from .series import ERR_SQL, EV_ORDER, events_labelled

EVL_SQL = f"evl AS (SELECT *, {ERR_SQL} AS is_error FROM events)"


@register("pearson_readings", "WITH " + READINGS_SQL + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{x}' AS x, 'l_extendedprice' AS y, count(*) FILTER (WHERE {x} IS NOT NULL AND l_extendedprice IS NOT NULL) AS n,
       round(corr({x}, l_extendedprice), 6) AS r,
       round(corr({x}, l_extendedprice) * sqrt((count(*) FILTER (WHERE {x} IS NOT NULL AND l_extendedprice IS NOT NULL) - 2)
             / (1 - corr({x}, l_extendedprice) * corr({x}, l_extendedprice))), 4) AS t FROM readings"""
    for x in ["l_quantity", "o_totalprice", "l_discount"]))
def pearson_readings(spark, sf):
    """ST1 — Pearson r, n, t for several pairs in one aggregate."""
    out = ST.pearson_stats(readings(spark, sf), [(x, "l_extendedprice") for x in ["l_quantity", "o_totalprice", "l_discount"]])
    return out.select("x", "y", "n", F.round("r", 6).alias("r"), F.round("t", 4).alias("t"))


@register("spearman_quantity_price", """
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM d)
SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM r""")
def spearman_quantity_price(spark, sf):
    """ST2 — Spearman ρ from tie-averaged ranks computed on distinct values."""
    return round_cols(ST.spearman_stats(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


@register("linearity_readings")
def linearity_readings(spark, sf):
    """ST4 — Pearson, Spearman and Kendall (with p-values) of features vs the target."""
    return ST.linearity(readings(spark, sf), "l_extendedprice", ["l_quantity", "l_discount"])


LINEAR_COLS = ["c_nationkey", "c_custkey"]


@register("linearity_statistics_customer", "\nUNION ALL\n".join(f"""
SELECT '{x}' AS feature, n, round(pr, 6) AS pearson_r, round(rho, 6) AS spearman_rho, round(s / sqrt((n * (n - 1) / 2 - n1) * (n * (n - 1) / 2 - n2)), 6) AS kendall_tau,
       round(abs(pr), 6) AS abs_pearson
FROM (SELECT count(*) AS n, corr({x}, c_acctbal) AS pr FROM customer WHERE {x} IS NOT NULL AND c_acctbal IS NOT NULL),
     (SELECT corr(rx, ry) AS rho FROM (SELECT rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2.0 AS ry FROM customer)),
     (SELECT sum(sign(a.{x} - b.{x}) * sign(a.c_acctbal - b.c_acctbal)) AS s FROM customer a JOIN customer b ON a.c_custkey < b.c_custkey),
     (SELECT coalesce(sum(k * (k - 1) / 2), 0) AS n1 FROM (SELECT count(*) AS k FROM customer GROUP BY {x})),
     (SELECT coalesce(sum(k * (k - 1) / 2), 0) AS n2 FROM (SELECT count(*) AS k FROM customer GROUP BY c_acctbal))""" for x in LINEAR_COLS))
def linearity_statistics_customer(spark, sf):
    """ST4 — the three correlations of the linearity table (the oracle enumerates pairs on this small table)."""
    out = ST.linearity(table(spark, sf, "customer"), "c_acctbal", LINEAR_COLS)
    return round_cols(out.select("feature", "n", "pearson_r", "spearman_rho", "kendall_tau", "abs_pearson"))


@register("ks_2samp_events", "WITH " + EVL_SQL + """,
v AS (SELECT value, count(*) FILTER (WHERE is_error = 0) AS c0, count(*) FILTER (WHERE is_error = 1) AS c1
      FROM evl WHERE value IS NOT NULL GROUP BY value),
cu AS (SELECT sum(c0) OVER (ORDER BY value) AS k0, sum(c1) OVER (ORDER BY value) AS k1,
              sum(c0) OVER () AS n0, sum(c1) OVER () AS n1 FROM v)
SELECT 'value' AS feature, CAST(max(n0) AS BIGINT) AS n0, CAST(max(n1) AS BIGINT) AS n1,
       round(max(abs(k0 / n0 - k1 / n1)), 6) AS ks_stat FROM cu""")
def ks_2samp_events(spark, sf):
    """ST8 — two-sample KS statistic over distinct values."""
    return round_cols(ST.ks_2samp_stats(events_labelled(spark, sf), "value", "is_error"))


@register("ttest_events", "WITH " + EVL_SQL + """,
m AS (SELECT count(value) FILTER (WHERE is_error = 0) AS n0, count(value) FILTER (WHERE is_error = 1) AS n1,
             avg(value) FILTER (WHERE is_error = 0) AS mean0, avg(value) FILTER (WHERE is_error = 1) AS mean1,
             var_samp(value) FILTER (WHERE is_error = 0) AS v0, var_samp(value) FILTER (WHERE is_error = 1) AS v1 FROM evl)
SELECT 'value' AS feature, n0, n1, round(mean0, 6) AS mean0, round(mean1, 6) AS mean1,
       round((mean1 - mean0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)), 6) AS t,
       n0 + n1 - 2 AS dof FROM m""")
def ttest_events(spark, sf):
    """ST12 — pooled two-sample t statistic."""
    return round_cols(ST.ttest_stats(events_labelled(spark, sf), "value", "is_error"))


MW_SQL = """r AS (SELECT is_error, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS rk
      FROM evl WHERE value IS NOT NULL),
u AS (SELECT count(*) FILTER (WHERE is_error = 0) AS n0, count(*) FILTER (WHERE is_error = 1) AS n1,
             sum(rk) FILTER (WHERE is_error = 0) AS r0 FROM r)"""


@register("mann_whitney_events", "WITH " + EVL_SQL + ",\n" + MW_SQL + """,
t AS (SELECT sum(k * k * k - k) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS k FROM evl WHERE value IS NOT NULL GROUP BY value))
SELECT 'value' AS feature, n0, n1, round(r0 - n0 * (n0 + 1) / 2.0, 4) AS u, round(n0 * n1 - (r0 - n0 * (n0 + 1) / 2.0), 4) AS u1,
       round(ties, 4) AS ties FROM u, t""")
def mann_whitney_events(spark, sf):
    """ST13 — Mann–Whitney U from rank sums on distinct values."""
    out = ST.mann_whitney_stats(events_labelled(spark, sf), "value", "is_error")
    return out.select("feature", "n0", "n1", F.round("u", 4).alias("u"), F.round("u1", 4).alias("u1"),
                      F.round(F.col("ties").cast("double"), 4).alias("ties"))


@register("f_variance_events", "WITH " + EVL_SQL + """
SELECT 'value' AS feature, count(value) FILTER (WHERE is_error = 0) AS n0, count(value) FILTER (WHERE is_error = 1) AS n1,
       round(var_pop(value) FILTER (WHERE is_error = 1), 6) AS var1, round(var_pop(value) FILTER (WHERE is_error = 0), 6) AS var0,
       round(var_pop(value) FILTER (WHERE is_error = 1) / var_pop(value) FILTER (WHERE is_error = 0), 6) AS f_stat FROM evl""")
def f_variance_events(spark, sf):
    """ST16 — variance-ratio F statistic (population variances)."""
    return round_cols(ST.f_var_stats(events_labelled(spark, sf), "value", "is_error"))


@register("anova_value_by_type", """
WITH r AS (SELECT event_type, value, avg(value) OVER (PARTITION BY event_type) AS gm, count(*) OVER (PARTITION BY event_type) AS gn
           FROM events WHERE value IS NOT NULL),
q AS (SELECT *, avg(value) OVER () AS m FROM r WHERE gn > 10),
t AS (SELECT count(*) AS "N", count(DISTINCT event_type) AS k, sum((gm - m) * (gm - m)) AS ssb, sum((value - gm) * (value - gm)) AS ssw FROM q)
SELECT 'value' AS feature, CAST("N" AS BIGINT) AS "N", k, round(ssb, 2) AS ssb, round(ssw, 2) AS ssw,
       round((ssb / (k - 1)) / (ssw / ("N" - k)), 6) AS f_stat FROM t""")
def anova_value_by_type(spark, sf):
    """ST14 — one-way ANOVA F over event types."""
    out = ST.anova_stats(table(spark, sf, "events"), "value", "event_type")
    return out.select("feature", F.col("N").cast("long").alias("N"), "k", F.round("ssb", 2).alias("ssb"),
                      F.round("ssw", 2).alias("ssw"), F.round("f_stat", 6).alias("f_stat"))


@register("levene_value_by_type", """
WITH m AS (SELECT event_type, median(value) AS med FROM events WHERE value IS NOT NULL GROUP BY 1),
z AS (SELECT e.event_type, abs(e.value - m.med) AS z FROM events e JOIN m ON e.event_type = m.event_type WHERE e.value IS NOT NULL),
g AS (SELECT event_type, count(*) AS ni, avg(z) AS zi FROM z GROUP BY 1),
a AS (SELECT avg(z) AS zbar, count(*) AS "N" FROM z),
num AS (SELECT sum(ni * (zi - zbar) * (zi - zbar)) AS num, count(*) AS k FROM g, a),
den AS (SELECT sum((z.z - g.zi) * (z.z - g.zi)) AS den FROM z JOIN g ON z.event_type = g.event_type)
SELECT 'value' AS feature, "N", k, round(("N" - k) / (k - 1) * num / den, 6) AS levene_stat FROM num, den, a""")
def levene_value_by_type(spark, sf):
    """ST11 — Levene (median-centred) statistic across event types."""
    return round_cols(ST.levene_stats(table(spark, sf, "events"), "value", "event_type"))


@register("bartlett_value_by_type", """
WITH g AS (SELECT event_type, count(value) AS ni, var_samp(value) AS vi FROM events WHERE value IS NOT NULL GROUP BY 1),
t AS (SELECT sum(ni) AS "N", count(*) AS k, sum((ni - 1) * vi) AS sv, sum((ni - 1) * ln(vi)) AS slv, sum(1.0 / (ni - 1)) AS sinv FROM g)
SELECT 'value' AS feature, CAST("N" AS BIGINT) AS "N", k,
       round((("N" - k) * ln(sv / ("N" - k)) - slv) / (1 + (sinv - 1.0 / ("N" - k)) / (3 * (k - 1))), 6) AS bartlett_stat FROM t""")
def bartlett_value_by_type(spark, sf):
    """ST11 — Bartlett statistic across event types."""
    out = ST.bartlett_stats(table(spark, sf, "events"), "value", "event_type")
    return round_cols(out.withColumn("N", F.col("N").cast("long")))


@register("homoscedasticity_readings")
def homoscedasticity_readings(spark, sf):
    """ST11 — Levene, Bartlett and Fligner–Killeen (with p) per feature across the target-median halves."""
    return ST.homoscedasticity(readings(spark, sf), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])


def _chi2_sql(a_expr, b_expr, src):
    return f"""WITH cells AS (SELECT {a_expr} AS a, {b_expr} AS b, count(*) AS o FROM {src} GROUP BY 1, 2),
ra AS (SELECT a, sum(o) AS ra FROM cells GROUP BY a), rb AS (SELECT b, sum(o) AS rb FROM cells GROUP BY b),
d AS (SELECT sum(o) AS n, count(DISTINCT a) AS ka, count(DISTINCT b) AS kb FROM cells),
g AS (SELECT ra.a, rb.b, ra.ra, rb.rb, coalesce(c.o, 0) AS o FROM ra CROSS JOIN rb LEFT JOIN cells c ON c.a = ra.a AND c.b = rb.b),
t AS (SELECT sum(power(abs(o - ra * rb / n) - CASE WHEN (ka - 1) * (kb - 1) = 1 THEN least(abs(o - ra * rb / n), 0.5) ELSE 0 END, 2)
                 / (ra * rb / n)) AS chi2, min((ka - 1) * (kb - 1)) AS dof, CAST(min(n) AS BIGINT) AS n, min(least(ka, kb) - 1) AS md FROM g, d)"""


@register("chi2_returnflag_linestatus", _chi2_sql("l_returnflag", "l_linestatus", "lineitem") + """
SELECT 'l_returnflag' AS a, 'l_linestatus' AS b, n, dof, round(chi2, 6) AS chi2,
       round(CASE WHEN md > 0 THEN sqrt(chi2 / (n * md)) ELSE 0 END, 6) AS cramers_v FROM t""")
def chi2_returnflag_linestatus(spark, sf):
    """ST15 — χ² independence on a 3×2 table (no Yates)."""
    return round_cols(ST.chi2_stats(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"))


@register("chi2_error_high_value", _chi2_sql(ERR_SQL, "CAST(value > 250 AS INTEGER)", "events") + """
SELECT 'is_error' AS a, 'high_value' AS b, n, dof, round(chi2, 6) AS chi2,
       round(CASE WHEN md > 0 THEN sqrt(chi2 / (n * md)) ELSE 0 END, 6) AS cramers_v FROM t""")
def chi2_error_high_value(spark, sf):
    """ST15 — χ² on a 2×2 table with the Yates correction."""
    e = events_labelled(spark, sf).withColumn("high_value", (F.col("value") > 250).cast("int"))
    return round_cols(ST.chi2_stats(e, "is_error", "high_value"))


EFFECT_SQL = "WITH " + EVL_SQL.replace("FROM events)", ", CAST(value > 250 AS INTEGER) AS pred FROM events)") + ",\n" + MW_SQL + """,
m AS (SELECT count(value) FILTER (WHERE is_error = 0) AS n0, count(value) FILTER (WHERE is_error = 1) AS n1,
             avg(value) FILTER (WHERE is_error = 0) AS m0, avg(value) FILTER (WHERE is_error = 1) AS m1,
             var_pop(value) FILTER (WHERE is_error = 0) AS v0, var_pop(value) FILTER (WHERE is_error = 1) AS v1 FROM evl),
cd AS (SELECT (m1 - m0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2)) AS cohens_d FROM m),
""" + _chi2_sql("is_error", "pred", "evl").replace("WITH cells", "cells") + """,
v AS (SELECT CASE WHEN md > 0 THEN sqrt(chi2 / (n * md)) ELSE 0 END AS cramers_v FROM t)
SELECT round(cohens_d, 6) + 0.0 AS cohens_d,
       CASE WHEN abs(cohens_d) >= 0.8 THEN 'LARGE' WHEN abs(cohens_d) >= 0.5 THEN 'MEDIUM' WHEN abs(cohens_d) >= 0.2 THEN 'SMALL' ELSE 'NEGLIGIBLE' END AS cohens_d_band,
       round(1 - 2 * (r0 - u.n0 * (u.n0 + 1) / 2.0) / (u.n0 * u.n1), 6) AS rank_biserial, round(cramers_v, 6) AS cramers_v,
       CASE WHEN cramers_v >= 0.5 THEN 'LARGE' WHEN cramers_v >= 0.3 THEN 'MEDIUM' WHEN cramers_v >= 0.1 THEN 'SMALL' ELSE 'NEGLIGIBLE' END AS cramers_v_band
FROM cd, u, v"""


@register("effect_size_events", EFFECT_SQL)
def effect_size_events(spark, sf):
    """ST17 — Cohen d, rank-biserial and Cramér V with bands."""
    e = events_labelled(spark, sf).withColumn("pred", (F.col("value") > 250).cast("int"))
    return round_cols(ST.effect_size(e, "value", "is_error", "pred"))


@register("power_analysis_events")
def power_analysis_events(spark, sf):
    """ST18 — observed power and required n per group."""
    return ST.power_analysis(events_labelled(spark, sf), "value", "is_error")


def _phi_sql(z: str, terms: int = 60) -> str:
    """Φ(z) in SQL another way than the rational approximations of ``functions.scalar``: the power series about 0,
    .5 + φ(z)(z + z³/3 + z⁵/15 + …), up to |z| = 3, and the continued fraction φ(z)/(z + 1/(z + 2/(z + …))) of the tail beyond."""
    series, tail = "1.0", "0.0"
    for k in range(terms, 0, -1):
        series = f"(1 + {z} * {z} / {2 * k + 1} * {series})"
        tail = f"({k} / (abs({z}) + {tail}))"
    phi = f"(exp(-{z} * {z} / 2) / sqrt(2 * pi()))"
    upper = f"({phi} / (abs({z}) + {tail}))"
    return f"(CASE WHEN {z} < -3 THEN {upper} WHEN {z} > 3 THEN 1 - {upper} ELSE 0.5 + {z} * {phi} * {series} END)"


def _ppf_sql(p: str) -> str:
    """Φ⁻¹(p) in SQL, from the coefficients of ``functions.scalar``."""
    from ..functions import scalar as S

    def ratio(num, den, x):
        horner = lambda c: "(" * (len(c) - 1) + f"{c[-1]!r}" + "".join(f" * {x} + {a!r})" for a in reversed(c[:-1]))
        return f"{horner(num)} / {horner(den)}"

    q, tail = f"(({p}) - 0.5)", f"sqrt(-ln(least(({p}), 1 - ({p}))))"
    middle = f"{q} * {ratio(S._MIDDLE_NUM, S._MIDDLE_DEN, f'(0.180625 - {q} * {q})')}"
    outer = (f"CASE WHEN {tail} <= 5 THEN {ratio(S._FLANK_NUM, S._FLANK_DEN, f'({tail} - 1.6)')} "
             f"ELSE {ratio(S._TAIL_NUM, S._TAIL_DEN, f'({tail} - 5.0)')} END")
    return f"(CASE WHEN abs({q}) <= 0.425 THEN {middle} ELSE sign({q}) * ({outer}) END)"


def _ranked_sql(values: str) -> str:
    """Ranked standardised values of a subquery (feature, x): feature, i, n, z, F(z), F(-z) and Blom's score m."""
    return f"""v AS ({values}),
s AS (SELECT feature, row_number() OVER (PARTITION BY feature ORDER BY x) AS i, count(*) OVER (PARTITION BY feature) AS n,
             (x - avg(x) OVER (PARTITION BY feature)) / stddev_samp(x) OVER (PARTITION BY feature) AS z FROM v WHERE x IS NOT NULL),
f AS (SELECT feature, i, n, z, {_phi_sql("z")} AS fz, {_phi_sql("(-z)")} AS sz, {_ppf_sql("(i - 0.375) / (n + 0.25)")} AS m FROM s),
st AS (SELECT feature, max(n) AS n, power(sum(m * z), 2) / (sum(m * m) * sum(z * z)) AS w,
              -max(n) - sum((2 * i - 1) * ln(greatest(fz, 1e-300)) + (2 * n - 2 * i + 1) * ln(greatest(sz, 1e-300))) / max(n) AS ad_stat,
              max(greatest(i / n - fz, fz - (i - 1.0) / n)) AS ks_stat FROM f GROUP BY feature),
pv AS (SELECT *, (ln(1 - w) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n)))) / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))) AS sfz,
              (sqrt(n) + 0.12 + 0.11 / sqrt(n)) * ks_stat AS lam FROM st),
tests AS (SELECT *, {_phi_sql("(-sfz)")} AS shapiro_p,
                 least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 200), lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * j * j * lam * lam))))) AS ks_p FROM pv)"""


RANKED_SQL = _ranked_sql("SELECT 'value' AS feature, value AS x FROM events")


@register("anderson_events", "WITH " + RANKED_SQL + """
SELECT feature, n, round(ad_stat, 6) AS ad_stat FROM st""")
def anderson_events(spark, sf):
    """ST6 — Anderson–Darling A² over runs of equal values (no single-partition window)."""
    return round_cols(ST.anderson(table(spark, sf, "events"), "value"))


@register("ks_normal_events", "WITH " + RANKED_SQL + """
SELECT feature, n, round(ks_stat, 6) AS ks_stat, round(ks_p, 6) AS p_value FROM tests""")
def ks_normal_events(spark, sf):
    """ST7 — one-sample KS statistic vs the fitted normal, with its asymptotic p."""
    return round_cols(ST.ks_normal(table(spark, sf, "events"), "value"))


@register("normaltest_events")
def normaltest_events(spark, sf):
    """ST9 — D'Agostino–Pearson K²."""
    return ST.normaltest(table(spark, sf, "events"), "value")


NORMAL_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("normality_lineitem", "WITH " + _ranked_sql(" UNION ALL ".join(f"SELECT '{x}' AS feature, {x} AS x FROM lineitem" for x in NORMAL_COLS)) + """,
mo AS (SELECT feature, skewness(x) AS skewness, kurtosis(x) AS kurtosis FROM v GROUP BY feature)
SELECT feature, n, round(w, 6) AS shapiro_stat, round(shapiro_p, 6) AS shapiro_p, round(ad_stat, 3) AS ad_stat,
       round(0.787 / (1 + 4.0 / n - 25.0 / (n * n)), 3) AS ad_critical_5pct, round(ks_stat, 6) AS ks_stat, round(ks_p, 6) AS ks_p,
       round(skewness, 6) + 0.0 AS skewness, round(kurtosis, 6) + 0.0 AS kurtosis, shapiro_p > 0.05 AS is_normal FROM tests JOIN mo USING (feature)""")
def normality_lineitem(spark, sf):
    """ST10 — normality table: Shapiro–Francia, Anderson–Darling, KS, skewness, kurtosis and the verdict, over all rows."""
    out = ST.normality(table(spark, sf, "lineitem"), NORMAL_COLS)
    return round_cols(out.withColumn("ad_stat", F.round("ad_stat", 3)))


@register("qq_points_events")
def qq_points_events(spark, sf):
    """ST23 — QQ data: exact sample percentiles vs normal quantiles."""
    return ST.qq_points(table(spark, sf, "events"), "value", 100)


@register("bootstrap_f1_events")
def bootstrap_f1_events(spark, sf):
    """ST19 — bootstrap F1 interval per weekday split, 1,000 replicates."""
    e = events_labelled(spark, sf).withColumn("pred", (F.col("value") > 250).cast("int")) \
        .withColumn("part", F.weekday("ts").cast("string"))
    return ST.bootstrap_f1(e, "is_error", "pred", reps=1000, by="part")


@register("adjusted_error_shares", """
WITH p AS (SELECT user_id, avg(CAST(event_type = 'error' AS INTEGER)) AS p_value FROM events GROUP BY user_id),
o AS (SELECT *, row_number() OVER (ORDER BY p_value, user_id) AS i, count(*) OVER () AS m FROM p),
h AS (SELECT *, max(least(1.0, (m - i + 1) * p_value)) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS holm,
              min(least(1.0, p_value * m / i)) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bh FROM o)
SELECT user_id, round(p_value, 6) AS p_value, round(least(1.0, p_value * m), 6) AS p_bonferroni, round(holm, 6) AS p_holm,
       round(bh, 6) AS p_bh, least(1.0, p_value * m) < 0.05 AS reject_bonferroni, holm < 0.05 AS reject_holm, bh < 0.05 AS reject_bh
FROM h""")
def adjusted_error_shares(spark, sf):
    """ST20 — Bonferroni / Holm / BH over one test per user (error share as p)."""
    p = table(spark, sf, "events").groupBy("user_id").agg(F.avg((F.col("event_type") == "error").cast("int")).alias("p_value"))
    return round_cols(ST.adjust_pvalues(p, "p_value"))


@register("hypothesis_table_events")
def hypothesis_table_events(spark, sf):
    """ST21 — the hypothesis tests of ``HYPOTHESES`` with p-values and conclusions."""
    return ST.hypothesis_table(_hypothesis_events(spark, sf), HYPOTHESES)


def _hypothesis_events(spark, sf):
    e = events_labelled(spark, sf).withColumn("high_value", (F.col("value") > 250).cast("int"))
    return e.withColumn("hour", F.hour("ts")).withColumn("weekday", F.weekday("ts").cast("string"))


HYPOTHESES = [ST.Hypothesis("H1", "value follows the hour", "pearson", "hour", "value"),
              ST.Hypothesis("H2", "value follows the user", "pearson", "user_id", "value"),
              ST.Hypothesis("H3", "high values go with errors", "chi2", "is_error", "high_value"),
              ST.Hypothesis("H4", "value differs across event types", "anova", "value", "event_type"),
              ST.Hypothesis("H5", "value differs across weekdays", "anova", "value", "weekday"),
              ST.Hypothesis("H6", "errors have other values (mean)", "t_test", "value", "is_error"),
              ST.Hypothesis("H7", "errors have other values (ranks)", "mann_whitney", "value", "is_error"),
              ST.Hypothesis("H8", "errors have other values (distribution)", "ks_2samp", "value", "is_error"),
              ST.Hypothesis("H9", "errors vary more", "f_variance", "value", "is_error")]


def _anova_sql(group):
    return f"""(SELECT (sum((gm - m) * (gm - m)) / (count(DISTINCT g) - 1)) / (sum((value - gm) * (value - gm)) / (count(*) - count(DISTINCT g)))
      FROM (SELECT *, avg(value) OVER () AS m FROM (SELECT {group} AS g, value, avg(value) OVER (PARTITION BY {group}) AS gm, count(*) OVER (PARTITION BY {group}) AS gn
            FROM evl WHERE value IS NOT NULL) WHERE gn > 10))"""


@register("hypothesis_statistics_events", "WITH " + EVL_SQL.replace("FROM events)", ", CAST(value > 250 AS INTEGER) AS high_value FROM events)") + ",\n" + MW_SQL + ",\n"
          + _chi2_sql("is_error", "high_value", "evl").replace("WITH cells", "cells") + """,
m AS (SELECT count(value) FILTER (WHERE is_error = 0) AS n0, count(value) FILTER (WHERE is_error = 1) AS n1, avg(value) FILTER (WHERE is_error = 0) AS m0,
             avg(value) FILTER (WHERE is_error = 1) AS m1, var_samp(value) FILTER (WHERE is_error = 0) AS v0, var_samp(value) FILTER (WHERE is_error = 1) AS v1,
             var_pop(value) FILTER (WHERE is_error = 1) / var_pop(value) FILTER (WHERE is_error = 0) AS fv, corr(hour(ts), value) AS r1, corr(user_id, value) AS r2 FROM evl),
ks AS (SELECT max(abs(k0 / n0 - k1 / n1)) AS d FROM (SELECT sum(c0) OVER (ORDER BY value) AS k0, sum(c1) OVER (ORDER BY value) AS k1, sum(c0) OVER () AS n0, sum(c1) OVER () AS n1
       FROM (SELECT value, count(*) FILTER (WHERE is_error = 0) AS c0, count(*) FILTER (WHERE is_error = 1) AS c1 FROM evl WHERE value IS NOT NULL GROUP BY value)))
SELECT h AS hypothesis, test, round(x, 6) + 0.0 AS statistic FROM (
  SELECT 'H1' AS h, 'pearson' AS test, r1 AS x FROM m UNION ALL SELECT 'H2', 'pearson', r2 FROM m UNION ALL SELECT 'H3', 'chi2', chi2 FROM t
  UNION ALL SELECT 'H4', 'anova', """ + _anova_sql("event_type") + """ UNION ALL SELECT 'H5', 'anova', """ + _anova_sql("isodow(ts)") + """
  UNION ALL SELECT 'H6', 't_test', (m1 - m0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)) FROM m
  UNION ALL SELECT 'H7', 'mann_whitney', r0 - n0 * (n0 + 1) / 2.0 FROM u UNION ALL SELECT 'H8', 'ks_2samp', d FROM ks UNION ALL SELECT 'H9', 'f_variance', fv FROM m)""")
def hypothesis_statistics_events(spark, sf):
    """ST21 — the statistics of the hypothesis table."""
    return round_cols(ST.hypothesis_table(_hypothesis_events(spark, sf), HYPOTHESES).select("hypothesis", "test", "statistic"))


@register("assumption_table_readings")
def assumption_table_readings(spark, sf):
    """ST22 — the six assumption verdicts: linearity, normality, independence, homoscedasticity, collinearity, stationarity."""
    r = readings(spark, sf).select("ts", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount")
    return ST.assumption_table(r, "l_extendedprice", ["l_quantity", "l_discount"], r.columns)


SHAPIRO_COLS = ["l_quantity", "l_extendedprice", "o_totalprice"]


@register("shapiro_readings", "WITH " + READINGS_SQL + ",\n" + _ranked_sql(
    " UNION ALL ".join(f"SELECT '{x}' AS feature, CAST({x} AS DOUBLE) AS x FROM readings" for x in SHAPIRO_COLS)) + """
SELECT feature, n, round(w, 6) AS w, round(shapiro_p, 6) AS p_value, shapiro_p > 0.05 AS is_normal FROM tests""")
def shapiro_readings(spark, sf):
    """ST5 — Shapiro–Francia W′ of three columns over all readings, with p and verdict."""
    return round_cols(ST.shapiro(readings(spark, sf), SHAPIRO_COLS))


@register("fligner_value_by_type", """
WITH m AS (SELECT event_type, median(value) AS med FROM events WHERE value IS NOT NULL GROUP BY 1),
z AS (SELECT e.event_type, abs(e.value - m.med) AS z FROM events e JOIN m ON e.event_type = m.event_type WHERE e.value IS NOT NULL),
r AS (SELECT event_type, rank() OVER (ORDER BY z) + (count(*) OVER (PARTITION BY z) - 1) / 2.0 AS r, count(*) OVER () AS n FROM z),
a AS (SELECT event_type, """ + _ppf_sql("0.5 + r / (2 * (n + 1))") + """ AS a FROM r),
t AS (SELECT avg(a) AS m, var_samp(a) AS v, count(*) AS "N" FROM a),
g AS (SELECT event_type, avg(a) AS ga, count(*) AS ni FROM a GROUP BY 1)
SELECT 'value' AS feature, any_value("N") AS "N", count(*) AS k, round(sum(ni * (ga - m) * (ga - m)) / any_value(v), 6) AS fligner_stat FROM g, t""")
def fligner_value_by_type(spark, sf):
    """ST11 — Fligner–Killeen statistic across event types."""
    return round_cols(ST.fligner_stats(table(spark, sf, "events"), "value", "event_type"))


@register("adf_events")
def adf_events(spark, sf):
    """WN9 — augmented Dickey–Fuller on the event value series."""
    from ..operators import timeseries as TS

    return TS.adf(table(spark, sf, "events"), "value", EV_ORDER)


@register("stationarity_events")
def stationarity_events(spark, sf):
    """WN11 — ADF + KPSS stationarity verdict."""
    from ..operators import timeseries as TS

    return TS.stationarity(table(spark, sf, "events"), ["value"], EV_ORDER)


@register("kendall_customer", """
WITH c AS (SELECT c_custkey AS id, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer
           WHERE c_acctbal IS NOT NULL AND c_nationkey IS NOT NULL),
p AS (SELECT sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s FROM c a JOIN c b ON a.id < b.id),
t AS (SELECT count(*) AS n FROM c),
tx AS (SELECT coalesce(sum(k * (k - 1) / 2), 0) AS n1 FROM (SELECT count(*) AS k FROM c GROUP BY x)),
ty AS (SELECT coalesce(sum(k * (k - 1) / 2), 0) AS n2 FROM (SELECT count(*) AS k FROM c GROUP BY y))
SELECT 'c_acctbal' AS x, 'c_nationkey' AS y, n, CAST(s AS DOUBLE) AS s,
       round(s / sqrt((n * (n - 1) / 2 - n1) * (n * (n - 1) / 2 - n2)), 6) AS tau_b FROM p, t, tx, ty""")
def kendall_customer(spark, sf):
    """ST3 — Kendall τ-b by distributed inversion counting (the oracle enumerates pairs on this small table)."""
    out = ST.kendall_stats(table(spark, sf, "customer"), "c_acctbal", "c_nationkey")
    return out.select("x", "y", "n", "s", F.round("tau_b", 6).alias("tau_b"))


@register("normaltest_stat_events", """
WITH m AS (SELECT count(value) AS n, avg(value) AS mu FROM events),
c AS (SELECT any_value(n) AS n, avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3,
             avg(power(value - mu, 4)) AS m4 FROM events, m WHERE value IS NOT NULL),
b AS (SELECT n, m3 / power(m2, 1.5) AS b1, m4 / (m2 * m2) AS b2 FROM c),
s1 AS (SELECT n, b2, b1 * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS y,
              3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) AS beta2 FROM b),
s2 AS (SELECT *, -1 + sqrt(2 * (beta2 - 1)) AS w2 FROM s1),
s3 AS (SELECT *, 1 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2.0 / (w2 - 1)) AS alpha FROM s2),
zs AS (SELECT *, delta * ln(y / alpha + sqrt((y / alpha) * (y / alpha) + 1)) AS zs,
              (b2 - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
              6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt((6.0 * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3))) AS sb1
       FROM s3),
k AS (SELECT *, 6.0 + 8.0 / sb1 * (2.0 / sb1 + sqrt(1 + 4.0 / (sb1 * sb1))) AS a FROM zs),
t AS (SELECT *, 1 + x * sqrt(2 / (a - 4.0)) AS denom FROM k),
z AS (SELECT n, zs, ((1 - 2 / (9.0 * a)) - sign(denom) * power((1 - 2.0 / a) / abs(denom), 1 / 3.0)) / sqrt(2 / (9.0 * a)) AS zk FROM t)
SELECT 'value' AS feature, n, round(zs * zs + zk * zk, 4) AS k2 FROM z""")
def normaltest_stat_events(spark, sf):
    """ST9 — D'Agostino–Pearson K² statistic (the p-value is the χ²(2) tail, see ``normaltest_events``)."""
    return ST.normaltest(table(spark, sf, "events"), "value").select("feature", "n", F.round("k2", 4).alias("k2"))
