"""Statistical tests (ST*) as distributed aggregates plus O(1) driver tails.

Each test has a Spark-side statistic (one or two aggregate passes, rank work
only on distinct-value tables) and a p-value from ``functions.tails``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tails
from ..functions.scalar import normal_cdf, normal_density, normal_quantile
from ..session import written
from .core import ROW_INDEX, c, distinct_value_ranks, quantile_table, quantile_values, running_sums, with_row_index


def _frame(df: DataFrame, rows, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


# ---------------------------------------------------------------------------
# correlation tests (ST1, ST2, ST4)
# ---------------------------------------------------------------------------

def pearson_stats(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """ST1 statistic — r, n and t = r·√((n−2)/(1−r²)) for many pairs in one pass."""
    row = df.agg(*[a for x, y in pairs for a in (
        F.corr(c(x), c(y)).alias(f"{x}|{y}__r"),
        F.count(F.when(c(x).isNotNull() & c(y).isNotNull(), 1)).alias(f"{x}|{y}__n"))])
    structs = [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), c(f"{x}|{y}__n").alias("n"), c(f"{x}|{y}__r").alias("r"))
               for x, y in pairs]
    out = row.select(F.inline(F.array(*structs)))
    return out.withColumn("t", F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") * F.col("r"))))


def pearson_test(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """ST1 — Pearson r with two-sided p (t with n−2 df)."""
    rows = [(r["x"], r["y"], r["n"], r["r"], tails.t_two_sided(r["t"], r["n"] - 2) if r["t"] is not None else None)
            for r in pearson_stats(df, pairs).collect()]
    return _frame(df, rows, "x string, y string, n long, r double, p_value double")


def spearman_stats(df: DataFrame, x: str, y: str) -> DataFrame:
    """ST2 statistic — Pearson r of the average ranks (pairwise complete rows). Rows
    become distinct (x, y) cells first; ranks join the cells, never the rows, and deviate
    from their exact mean (n + 1)/2."""
    d = df.select(c(x).cast("double").alias("_x"), c(y).cast("double").alias("_y")).filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    cells = written(d.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("w")))
    n = cells.agg(F.sum("w").alias("n"))

    def ranks(v: str) -> DataFrame:
        return distinct_value_ranks(cells.groupBy(v).agg(F.sum("w").alias("cnt")), v).select(v, F.col("midrank").alias(f"_r{v}"))

    t = cells.join(ranks("_x"), "_x").join(ranks("_y"), "_y").crossJoin(F.broadcast(n))  # one row
    a, b = F.col("_r_x") - (F.col("n") + 1) / 2, F.col("_r_y") - (F.col("n") + 1) / 2
    return t.agg(F.sum("w").alias("n"), (F.sum(F.col("w") * a * b) / F.sqrt(F.sum(F.col("w") * a * a) * F.sum(F.col("w") * b * b))).alias("rho")) \
        .select(F.lit(x).alias("x"), F.lit(y).alias("y"), "n", "rho")


def spearman_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """ST2 — Spearman ρ with the t-approximation p-value."""
    r = spearman_stats(df, x, y).first()
    n, rho = r["n"], r["rho"]
    t = rho * math.sqrt((n - 2) / (1 - rho * rho)) if rho is not None and abs(rho) < 1 else math.inf
    return _frame(df, [(x, y, n, rho, tails.t_two_sided(t, n - 2))], "x string, y string, n long, rho double, p_value double")


def linearity(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """ST4 — Pearson, Spearman and Kendall of every feature with the target, with
    p-values, strongest |Pearson r| first. Features with fewer than ten rows or one value are left out."""
    df = written(df.select(*[c(x) for x in dict.fromkeys([target, *cols])]))  # every test reads it several times
    p = {r["x"]: r for r in pearson_test(df, [(x, target) for x in cols]).collect()}
    rows = []
    for x in cols:
        if p[x]["n"] < 10 or p[x]["r"] is None or p[x]["r"] != p[x]["r"]:
            continue
        s, k = spearman_test(df, x, target).first(), kendall_stats(df, x, target).first()
        rows.append((x, p[x]["n"], p[x]["r"], p[x]["p_value"], s["rho"], s["p_value"], k["tau_b"], k["p_value"], abs(p[x]["r"])))
    return _frame(df, rows, "feature string, n long, pearson_r double, pearson_p double, spearman_rho double, spearman_p double, "
                            "kendall_tau double, kendall_p double, abs_pearson double").orderBy(F.desc("abs_pearson"), "feature")


# ---------------------------------------------------------------------------
# two-group tests (ST8, ST12, ST13, ST16, ST17)
# ---------------------------------------------------------------------------

def group_moments(df: DataFrame, value: str, label: str) -> DataFrame:
    """n, mean, sample and population variance for label 0 and 1, one pass."""
    aggs = []
    for g in (0, 1):
        v = F.when(c(label) == g, c(value))
        aggs += [F.count(v).alias(f"n{g}"), F.avg(v).alias(f"mean{g}"), F.var_samp(v).alias(f"var{g}"),
                 F.var_pop(v).alias(f"varpop{g}")]
    return df.agg(*aggs)


def ttest_stats(df: DataFrame, value: str, label: str) -> DataFrame:
    """ST12 statistic — pooled-variance t for group 1 vs group 0."""
    m = group_moments(df, value, label)
    sp2 = ((F.col("n0") - 1) * F.col("var0") + (F.col("n1") - 1) * F.col("var1")) / (F.col("n0") + F.col("n1") - 2)
    t = (F.col("mean1") - F.col("mean0")) / F.sqrt(sp2 * (1 / F.col("n0") + 1 / F.col("n1")))
    return m.select(F.lit(value).alias("feature"), "n0", "n1", "mean0", "mean1", t.alias("t"),
                    (F.col("n0") + F.col("n1") - 2).alias("dof"))


def ttest(df: DataFrame, value: str, label: str) -> DataFrame:
    """ST12 — two-sample t test (pooled variance) with two-sided p."""
    r = ttest_stats(df, value, label).first()
    return _frame(df, [(value, r["n0"], r["n1"], r["t"], tails.t_two_sided(r["t"], r["dof"]))],
                  "feature string, n0 long, n1 long, t double, p_value double")


def rank_sums(df: DataFrame, value: str, label: str) -> DataFrame:
    """Rank sum of group 1 and the tie term Σ(t³−t), from the (value, label)
    count table: midranks are computed on distinct values only."""
    per = df.filter(c(value).isNotNull()).groupBy(c(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("cnt"), F.count(F.when(c(label) == 1, 1)).alias("c1"))
    ranks = distinct_value_ranks(per.select("_v", "cnt"), "_v")
    j = per.join(ranks.select("_v", "midrank"), "_v")
    return j.agg(F.sum("cnt").alias("n"), F.sum("c1").alias("n1"), F.sum(F.col("c1") * F.col("midrank")).alias("r1"),
                 F.sum(F.col("cnt").cast("double") * F.col("cnt") * F.col("cnt") - F.col("cnt")).alias("ties"))


def mann_whitney_stats(df: DataFrame, value: str, label: str) -> DataFrame:
    """ST13 statistic — U of group 0 (the first sample, as the reference passes
    normal then anomaly) = R₀ − n₀(n₀+1)/2, and U₁ = n₀n₁ − U₀."""
    s = rank_sums(df, value, label)
    # counts in double: their products pass 63 bits near 3e9 rows
    n0, n = F.col("n") - F.col("n1"), F.col("n").cast("double")
    r0 = n * (n + 1) / 2 - F.col("r1")
    u0 = r0 - n0.cast("double") * (n0 + 1) / 2
    return s.select(F.lit(value).alias("feature"), n0.alias("n0"), "n1", u0.alias("u"), (n0.cast("double") * F.col("n1") - u0).alias("u1"),
                    "ties")


def mann_whitney(df: DataFrame, value: str, label: str) -> DataFrame:
    """ST13 — U with the tie-corrected normal approximation and continuity correction."""
    r = mann_whitney_stats(df, value, label).first()
    n0, n1, u, ties = r["n0"], r["n1"], r["u"], r["ties"]
    n = n0 + n1
    mu = n0 * n1 / 2.0
    sigma = math.sqrt(n0 * n1 / 12.0 * ((n + 1) - ties / (n * (n - 1)))) if n > 1 else 0.0
    z = (abs(u - mu) - 0.5) / sigma if sigma > 0 else 0.0
    p = min(1.0, 2.0 * tails.norm_sf(z)) if sigma > 0 else 1.0
    return _frame(df, [(value, n0, n1, float(u), p)], "feature string, n0 long, n1 long, u double, p_value double")


def ks_2samp_stats(df: DataFrame, value: str, label: str) -> DataFrame:
    """ST8 statistic — D = max |F₀(v) − F₁(v)| over distinct values (class
    counts per value, running sums over the distinct-value order)."""
    per = df.filter(c(value).isNotNull()).groupBy(c(value).alias("_v")).agg(
        F.count(F.when(c(label) == 0, 1)).alias("c0"), F.count(F.when(c(label) == 1, 1)).alias("c1"))
    idx, n = with_row_index(per, [F.col("_v")])
    cum = running_sums(idx, n, ["c0", "c1"])
    tot = per.agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"))
    d = cum.crossJoin(F.broadcast(tot)).agg(
        F.max(F.abs(F.col("c0__cum") / F.col("n0") - F.col("c1__cum") / F.col("n1"))).alias("d"),
        F.first("n0").alias("n0"), F.first("n1").alias("n1"))
    return d.select(F.lit(value).alias("feature"), "n0", "n1", F.col("d").alias("ks_stat"))


def ks_2samp(df: DataFrame, value: str, label: str) -> DataFrame:
    """ST8 — two-sample KS with the asymptotic p-value."""
    r = ks_2samp_stats(df, value, label).first()
    en = r["n0"] * r["n1"] / (r["n0"] + r["n1"])
    return _frame(df, [(value, r["ks_stat"], tails.kolmogorov_sf(r["ks_stat"], en))],
                  "feature string, ks_stat double, p_value double")


def f_var_stats(df: DataFrame, value: str, label: str) -> DataFrame:
    """ST16 statistic — F = var_pop(group 1) / var_pop(group 0)."""
    m = group_moments(df, value, label)
    return m.select(F.lit(value).alias("feature"), "n0", "n1", F.col("varpop1").alias("var1"), F.col("varpop0").alias("var0"),
                    (F.col("varpop1") / F.col("varpop0")).alias("f_stat"))


def f_var_test(df: DataFrame, value: str, label: str) -> DataFrame:
    """ST16 — two-sided variance-ratio F test."""
    r = f_var_stats(df, value, label).first()
    d1, d2 = r["n1"] - 1, r["n0"] - 1
    cdf = tails.f_cdf(r["f_stat"], d1, d2)
    return _frame(df, [(value, r["f_stat"], min(1.0, 2 * min(cdf, 1 - cdf)))], "feature string, f_stat double, p_value double")


# ---------------------------------------------------------------------------
# several groups (ST11, ST14)
# ---------------------------------------------------------------------------

def anova_stats(df: DataFrame, value: str, group: str, min_rows: int = 10) -> DataFrame:
    """ST14 statistic — one-way ANOVA F over groups with more than ``min_rows`` rows."""
    per = df.filter(c(value).isNotNull()).groupBy(c(group).alias("_g")).agg(
        F.count(c(value)).alias("n"), F.avg(c(value)).alias("m"), F.var_pop(c(value)).alias("v"))
    per = per.filter(F.col("n") > min_rows)
    # centred sums: group means around the grand mean, one row per group
    grand = per.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    t = per.crossJoin(F.broadcast(grand)).agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"))
    ssb, ssw = F.col("ssb"), F.col("ssw")
    return t.select(F.lit(value).alias("feature"), "N", "k", ssb.alias("ssb"), ssw.alias("ssw"),
                    ((ssb / (F.col("k") - 1)) / (ssw / (F.col("N") - F.col("k")))).alias("f_stat"))


def anova(df: DataFrame, value: str, group: str, min_rows: int = 10) -> DataFrame:
    """ST14 — one-way ANOVA with p from F(k−1, N−k)."""
    r = anova_stats(df, value, group, min_rows).first()
    p = tails.f_sf(r["f_stat"], r["k"] - 1, r["N"] - r["k"]) if r["f_stat"] is not None else None
    return _frame(df, [(value, r["k"], r["N"], r["f_stat"], p)], "feature string, groups long, n long, f_stat double, p_value double")


def _deviations(df: DataFrame, value: str, group: str) -> DataFrame:
    """(group, |value - group median|, rows), one row a distinct deviation: values
    are counted first, so the medians join a table of distinct values."""
    v = c(value).cast("double")
    d = df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(c(group).alias("_g"), v.alias("_x")).agg(F.count(F.lit(1)).alias("w"))
    raw = df.filter(v.isNotNull() & ~F.isnan(v)).select(v.alias("_x"), c(group).alias("_g"))
    med = quantile_table(raw, ["_x"], [0.5], by=["_g"]).select("_g", F.col("value").alias("_m"))
    return d.join(med, "_g").groupBy("_g", F.abs(F.col("_x") - F.col("_m")).alias("_z")).agg(F.sum("w").alias("w"))


def levene_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """ST11 statistic — Levene with median centring (Brown–Forsythe), from the
    moments of the deviations of each group (centred, merged pairwise by the aggregate's own means)."""
    z = _deviations(df, value, group)
    z = z.join(z.groupBy("_g").agg(F.sum("w").alias("ni"), (F.sum(F.col("_z") * F.col("w")) / F.sum("w")).alias("zi")), "_g")
    per = z.groupBy("_g").agg(F.first("ni").alias("ni"), F.first("zi").alias("zi"), F.sum(F.col("w") * (F.col("_z") - F.col("zi")) ** 2).alias("ss"))
    zall = per.agg((F.sum(F.col("ni") * F.col("zi")) / F.sum("ni")).alias("zbar"))
    j = per.crossJoin(F.broadcast(zall)).agg(F.sum("ni").alias("N"), F.count(F.lit(1)).alias("k"), F.sum("ss").alias("den"),  # one row
                                             F.sum(F.col("ni") * (F.col("zi") - F.col("zbar")) ** 2).alias("num"))
    w = (F.col("N") - F.col("k")) / (F.col("k") - 1) * F.col("num") / F.col("den")
    return j.select(F.lit(value).alias("feature"), "N", "k", w.alias("levene_stat"))


def fligner_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """ST11 statistic — Fligner–Killeen: the deviations from the group medians get
    pooled mid-ranks r, these the half-normal scores Φ⁻¹(1/2 + r / (2 (N + 1))), and
    the statistic compares the groups' mean scores with the variance of all scores."""
    z = _deviations(df, value, group)
    ranks = distinct_value_ranks(z.groupBy("_z").agg(F.sum("w").alias("cnt")), "_z").select("_z", "midrank")
    n = z.agg(F.sum("w").alias("N"))
    scored = z.join(ranks, "_z").crossJoin(F.broadcast(n)) \
        .withColumn("a", normal_quantile(F.lit(0.5) + F.col("midrank") / (2 * (F.col("N") + 1))))  # one row
    per = scored.groupBy("_g").agg(F.sum("w").alias("ni"), F.sum(F.col("w") * F.col("a")).alias("sa"), F.sum(F.col("w") * F.col("a") ** 2).alias("sq"))
    t = per.agg(F.sum("ni").alias("N"), F.count(F.lit(1)).alias("k"), F.sum("sa").alias("sa"), F.sum("sq").alias("sq"),
                F.sum(F.col("sa") ** 2 / F.col("ni")).alias("between"))
    mean2 = F.col("sa") ** 2 / F.col("N")
    stat = (F.col("between") - mean2) / ((F.col("sq") - mean2) / (F.col("N") - 1))
    return t.select(F.lit(value).alias("feature"), "N", "k", stat.alias("fligner_stat"))


def bartlett_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """ST11 statistic — Bartlett's T from group sample variances (one pass + a tiny agg)."""
    per = df.filter(c(value).isNotNull()).groupBy(c(group).alias("_g")).agg(
        F.count(c(value)).alias("ni"), F.var_samp(c(value)).alias("vi"))
    t = per.agg(F.sum("ni").alias("N"), F.count(F.lit(1)).alias("k"), F.sum((F.col("ni") - 1) * F.col("vi")).alias("sv"),
                F.sum((F.col("ni") - 1) * F.log(F.col("vi"))).alias("slv"), F.sum(1 / (F.col("ni") - 1)).alias("sinv"))
    sp = F.col("sv") / (F.col("N") - F.col("k"))
    num = (F.col("N") - F.col("k")) * F.log(sp) - F.col("slv")
    den = 1 + (F.col("sinv") - 1 / (F.col("N") - F.col("k"))) / (3 * (F.col("k") - 1))
    return t.select(F.lit(value).alias("feature"), "N", "k", (num / den).alias("bartlett_stat"))


def homoscedasticity(df: DataFrame, target: str, cols: Sequence[str], min_rows: int = 10) -> DataFrame:
    """ST11 — Levene, Bartlett and Fligner–Killeen of each feature between the halves
    split at the target median (rows without a target are in neither half; a feature needs ``min_rows`` in both)."""
    df = written(df.select(*[c(x) for x in dict.fromkeys([target, *cols])]))  # every test reads it several times
    med = quantile_values(df, [target], [0.5])[(target, 0.5)]
    g = df.filter(c(target).isNotNull()).withColumn("_half", F.when(c(target) > F.lit(med), "high").otherwise("low"))
    sizes = {r["_half"]: r for r in g.groupBy("_half").agg(*[F.count(c(x)).alias(x) for x in cols]).collect()}
    rows = []
    for x in cols:
        if len(sizes) < 2 or min(r[x] for r in sizes.values()) < min_rows:
            continue
        lev, bar, fli = levene_stats(g, x, "_half").first(), bartlett_stats(g, x, "_half").first(), fligner_stats(g, x, "_half").first()
        lp = tails.f_sf(lev["levene_stat"], lev["k"] - 1, lev["N"] - lev["k"])
        rows.append((x, lev["levene_stat"], lp, bar["bartlett_stat"], tails.chi2_sf(bar["bartlett_stat"], bar["k"] - 1),
                     fli["fligner_stat"], tails.chi2_sf(fli["fligner_stat"], fli["k"] - 1), lp > 0.05))
    return _frame(df, rows, "feature string, levene_stat double, levene_p double, bartlett_stat double, bartlett_p double, "
                            "fligner_stat double, fligner_p double, homoscedastic boolean")


# ---------------------------------------------------------------------------
# contingency (ST15) and effect sizes (ST17)
# ---------------------------------------------------------------------------

def chi2_stats(df: DataFrame, a: str, b: str, yates: bool = True) -> DataFrame:
    """ST15 statistic — χ² of independence from the contingency table (long
    form), Yates-corrected when dof = 1, and Cramér's V."""
    cells = df.groupBy(c(a).alias("_a"), c(b).alias("_b")).agg(F.count(F.lit(1)).alias("o"))
    ra = cells.groupBy("_a").agg(F.sum("o").alias("ra"))
    rb = cells.groupBy("_b").agg(F.sum("o").alias("rb"))
    dims = cells.agg(F.sum("o").alias("n"), F.count_distinct("_a").alias("ka"), F.count_distinct("_b").alias("kb")).first()
    ka, kb, n = dims["ka"], dims["kb"], dims["n"]
    dof = (ka - 1) * (kb - 1)
    if yates and dof == 1:
        # 2 × 2: the four cells (empty ones included) with |O − E| − min(|O − E|, .5)
        grid = ra.crossJoin(rb).join(cells, ["_a", "_b"], "left")  # exactly 4 cells
        e = F.col("ra").cast("double") * F.col("rb") / F.lit(n)
        diff = F.abs(F.coalesce(F.col("o"), F.lit(0)) - e)
        stat = grid.agg(F.sum((diff - F.least(diff, F.lit(0.5))) ** 2 / e).alias("chi2"))
    else:
        # Σ (O − E)²/E = Σ_observed O²/E − n: only the observed cells are needed
        j = cells.join(ra, "_a").join(rb, "_b")
        stat = j.agg((F.sum(F.col("o").cast("double") / F.col("ra") * F.col("o") / F.col("rb") * F.lit(n)) - F.lit(n)).alias("chi2"))
    out = stat.select("chi2", F.lit(dof).cast("long").alias("dof"), F.lit(n).cast("long").alias("n"),
                      F.lit(min(ka, kb) - 1).cast("long").alias("min_dim"))
    v = F.when(F.col("min_dim") > 0, F.sqrt(F.col("chi2") / (F.col("n") * F.col("min_dim")))).otherwise(0.0)
    return out.select(F.lit(a).alias("a"), F.lit(b).alias("b"), "n", "dof", "chi2", v.alias("cramers_v"))


def chi2(df: DataFrame, a: str, b: str, yates: bool = True) -> DataFrame:
    """ST15 — χ² independence test with p-value."""
    r = chi2_stats(df, a, b, yates).first()
    return _frame(df, [(a, b, r["n"], r["dof"], r["chi2"], tails.chi2_sf(r["chi2"], r["dof"]), r["cramers_v"])],
                  "a string, b string, n long, dof long, chi2 double, p_value double, cramers_v double")


# fixed values: conventional effect-size bands
COHEN_D_BANDS = ((0.8, "LARGE"), (0.5, "MEDIUM"), (0.2, "SMALL"))
CRAMER_V_BANDS = ((0.5, "LARGE"), (0.3, "MEDIUM"), (0.1, "SMALL"))


def _band(col: Column, bands) -> Column:
    out = None
    for thr, name in bands:
        out = F.when(col >= thr, name) if out is None else out.when(col >= thr, name)
    return out.otherwise("NEGLIGIBLE")


def effect_size(df: DataFrame, score: str, label: str, pred: str) -> DataFrame:
    """ST17 — Cohen d (population stds, (n−1)-weighted pool), rank-biserial
    1 − 2U/(n₀n₁) and Cramér V of label × prediction, with bands."""
    m = group_moments(df, score, label)
    pooled = F.sqrt(((F.col("n0") - 1) * F.col("varpop0") + (F.col("n1") - 1) * F.col("varpop1")) /
                    (F.col("n0") + F.col("n1") - 2))
    d = m.select(((F.col("mean1") - F.col("mean0")) / pooled).alias("cohens_d"))
    u = mann_whitney_stats(df, score, label).select((1 - 2 * F.col("u") / (F.col("n0") * F.col("n1"))).alias("rank_biserial"))
    v = chi2_stats(df, label, pred).select("cramers_v")
    j = d.crossJoin(u).crossJoin(v)  # three one-row frames
    return j.select("cohens_d", _band(F.abs("cohens_d"), COHEN_D_BANDS).alias("cohens_d_band"), "rank_biserial",
                    "cramers_v", _band(F.col("cramers_v"), CRAMER_V_BANDS).alias("cramers_v_band"))


def power_analysis(df: DataFrame, value: str, label: str, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """ST18 — observed power of the two-sample t test at the observed Cohen d, and
    the per-group n needed for ``power`` (equal groups)."""
    r = group_moments(df, value, label).first()
    n0, n1 = r["n0"], r["n1"]
    pooled = math.sqrt(((n0 - 1) * r["varpop0"] + (n1 - 1) * r["varpop1"]) / (n0 + n1 - 2))
    d = abs((r["mean1"] - r["mean0"]) / pooled) if pooled > 0 else 0.0

    def pw(na, nb):
        dof = na + nb - 2
        nc = d * math.sqrt(na * nb / (na + nb))
        crit = tails.t_ppf(1 - alpha / 2, dof)
        return tails.nct_sf(crit, dof, nc) + (1 - tails.nct_sf(-crit, dof, nc))

    observed = pw(n0, n1)
    lo, hi = 2, 2
    while pw(hi, hi) < power and hi < 10 ** 9:
        lo, hi = hi, hi * 2
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if pw(mid, mid) < power else (lo, mid)
    return _frame(df, [(value, d, observed, int(hi), alpha, power)],
                  "feature string, effect_size double, observed_power double, required_n_per_group long, alpha double, target_power double")


# ---------------------------------------------------------------------------
# normality (ST5–ST7, ST9, ST10, ST23)
# ---------------------------------------------------------------------------

def value_runs(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, dict]]:
    """(feature, z, cnt, before, n): the distinct standardised values of each
    column with their rows and the rows below, and the moments {feature: n, mu, sd}.
    Values are counted before they are ordered, so a hot value is one row."""
    value = {x: F.nanvl(c(x).cast("double"), F.lit(None).cast("double")) for x in cols}
    mom = df.agg(*[a for x in cols for a in (F.count(value[x]).alias(f"{x}__n"), F.avg(value[x]).alias(f"{x}__mu"), F.stddev_samp(value[x]).alias(f"{x}__sd"))]).first()
    stat = {x: {k: mom[f"{x}__{k}"] for k in ("n", "mu", "sd")} for x in cols}
    cols = [x for x in cols if stat[x]["sd"]]  # constant columns have no scale
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), value[x].alias("x")) for i, x in enumerate(cols)]) if cols else F.array().cast("array<struct<f:int,x:double>>")
    counts = df.select(F.explode(pairs).alias("p")).select("p.f", "p.x").filter("x is not null").groupBy("f", "x").agg(F.count(F.lit(1)).alias("cnt"))
    idx, m = with_row_index(counts, [F.col("f"), F.col("x")])
    cum = running_sums(idx, m, ["cnt"])
    start, total = [], 0
    for x in cols:
        start.append(total)
        total += stat[x]["n"]
    lookup = lambda v: F.element_at(F.array(*[F.lit(a) for a in v] or [F.lit(None)]), F.col("f") + 1)
    z = (F.col("x") - lookup([stat[x]["mu"] for x in cols])) / lookup([stat[x]["sd"] for x in cols])
    return cum.select(lookup(cols).alias("feature"), z.alias("z"), "cnt", (F.col("cnt__cum") - F.col("cnt") - lookup(start)).alias("before"),
                      lookup([stat[x]["n"] for x in cols]).alias("n")), stat


def _tail_logs(runs: DataFrame) -> DataFrame:
    # the survival function is kept apart: exact in the tail
    return runs.withColumns({"_F": normal_cdf(F.col("z")), "_S": normal_cdf(-F.col("z"))})


def anderson_stats(runs: DataFrame) -> DataFrame:
    """ST6 statistic from ``value_runs``: A² = −n − (1/n) Σₖ [(2k−1) ln F(x₍ₖ₎) +
    (2n−2k+1) ln(1 − F(x₍ₖ₎))], the ranks k of a run of equal values summed at once."""
    f, sv = F.greatest(F.col("_F"), F.lit(1e-300)), F.greatest(F.col("_S"), F.lit(1e-300))
    w, s, n = F.col("cnt").cast("double"), F.col("before").cast("double"), F.col("n").cast("double")
    terms = w * (2 * s + w) * F.log(f) + w * (2 * n - 2 * s - w) * F.log(sv)
    t = _tail_logs(runs).groupBy("feature", "n").agg(F.sum(terms).alias("s"))
    return t.select("feature", "n", (-F.col("n") - F.col("s") / F.col("n")).alias("ad_stat"))


def ks_normal_stats(runs: DataFrame) -> DataFrame:
    """ST7 statistic from ``value_runs``: D = max(k/n − F, F − (k−1)/n), which a run of
    equal values takes at its last and first rank."""
    d = F.greatest((F.col("before") + F.col("cnt")) / F.col("n") - F.col("_F"), F.col("_F") - F.col("before") / F.col("n"))
    return _tail_logs(runs).groupBy("feature", "n").agg(F.max(d).alias("ks_stat"))


#: Ranks at either end of a run of equal values whose normal scores are added one by one.
RUN_ENDS = 64


def shapiro_francia_stats(runs: DataFrame) -> DataFrame:
    """ST5 statistic over all rows — Shapiro–Francia W′ = (Σ mₖ x₍ₖ₎)² / (Σ mₖ² · Σ (x − x̄)²)
    with Blom's scores mₖ = Φ⁻¹((k − 3/8) / (n + 1/4)). Equal values share the sum of the
    scores of their ranks: a run is taken rank by rank, of a long one only ``RUN_ENDS``
    ranks at either end, and its inside by the Euler–Maclaurin formula between half
    ranks (∫ Φ⁻¹ = −φ(Φ⁻¹), ∫ (Φ⁻¹)² = u − z φ(z), two terms of correction). So a hot value is a few rows."""
    lo, hi = F.col("before") + 1, F.col("before") + F.col("cnt")
    ranks = lambda a, z: F.transform(F.sequence(a, z), lambda k: F.struct(k.cast("double").alias("t"), F.lit(0).alias("side")))
    half = lambda t, side: F.struct(t.cast("double").alias("t"), F.lit(side).alias("side"))
    points = F.when(F.col("cnt") == 1, F.array(half(lo, 0))).when(F.col("cnt") <= 4 * RUN_ENDS, ranks(lo, hi)).otherwise(F.concat(
        ranks(lo, lo + RUN_ENDS - 1), ranks(hi - RUN_ENDS + 1, hi), F.array(half(lo + RUN_ENDS - 0.5, -1), half(hi - RUN_ENDS + 0.5, 1))))
    t = runs.select("feature", "n", "z", "cnt", F.posexplode(points).alias("i", "p"))
    scale = F.col("n") + F.lit(0.25)
    t = t.withColumn("u", (F.col("p.t") - F.lit(0.375)) / scale).withColumn("m", normal_quantile("u")).withColumn("d", scale * normal_density("m"))
    m, d, side = F.col("m"), F.col("d"), F.col("p.side")
    one = side * (-d - 1 / (24 * d) + 7 * (1 + 2 * m * m) / (5760 * d ** 3))
    two = side * (scale * F.col("u") - m * d - m / (12 * d) + 7 * (8 * m + 4 * m ** 3) / (5760 * d ** 3))
    t = t.groupBy("feature", "n").agg(
        F.sum(F.when(side == 0, m).otherwise(one) * F.col("z")).alias("mx"), F.sum(F.when(side == 0, m * m).otherwise(two)).alias("mm"),
        F.sum(F.when(F.col("i") == 0, F.col("cnt") * F.col("z") ** 2)).alias("ss"))
    return t.select("feature", "n", (F.col("mx") ** 2 / F.col("mm") / F.col("ss")).alias("w"))


def shapiro_francia_p(w: float, n: int) -> float:
    """Upper tail of the normalised ln(1 − W′) (Royston, 1993; calibrated for n to 5,000, its trend carried on beyond)."""
    if n < 5:
        return float("nan")
    if w >= 1:
        return 1.0
    u = math.log(n)
    v = math.log(u)
    # fixed values: Royston's fit of the mean and deviation
    mu, sigma = -1.2725 + 1.0521 * (v - u), 1.0308 - 0.26758 * (v + 2 / u)
    return tails.norm_sf((math.log1p(-w) - mu) / sigma)


def shapiro(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ST5 — normality of every feature over all its rows (Shapiro–Francia), with its p-value."""
    rows = [(r["feature"], r["n"], r["w"], shapiro_francia_p(r["w"], r["n"])) for r in shapiro_francia_stats(value_runs(df, cols)[0]).collect()]
    return _frame(df, [(*r, bool(r[3] > 0.05)) for r in rows], "feature string, n long, w double, p_value double, is_normal boolean")


def anderson(df: DataFrame, value: str) -> DataFrame:
    """ST6 — Anderson–Darling A² against N(mean, sample std)."""
    return anderson_stats(value_runs(df, [value])[0])


def ks_normal(df: DataFrame, value: str) -> DataFrame:
    """ST7 — one-sample KS against N(mean, sample std), asymptotic p."""
    rows = [(r["feature"], r["n"], r["ks_stat"], tails.kolmogorov_sf(r["ks_stat"], r["n"])) for r in ks_normal_stats(value_runs(df, [value])[0]).collect()]
    return _frame(df, rows, "feature string, n long, ks_stat double, p_value double")


def skewness_z(b1: float, n: int) -> float:
    """Normal score of a sample skewness: a Johnson S_U curve with matched moments
    (D'Agostino, Biometrika 57, 1970)."""
    spread = 6.0 * (n - 2) / ((n + 1.0) * (n + 3))
    kurt = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    width2 = math.sqrt(2 * kurt - 2) - 1
    return math.asinh(b1 / math.sqrt(spread) * math.sqrt((width2 - 1) / 2)) / math.sqrt(math.log(width2) / 2)


def kurtosis_z(b2: float, n: int) -> float:
    """Normal score of a sample kurtosis: a cube root of a scaled, shifted inverse chi-square
    with matched moments (Anscombe & Glynn, Biometrika 70, 1983)."""
    mean = 3.0 * (n - 1) / (n + 1)
    variance = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3.0) * (n + 5))
    skew = 6.0 * (n * n - 5 * n + 2) / ((n + 7.0) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3)))
    dof = 6 + 8 / skew * (2 / skew + math.sqrt(1 + 4 / skew ** 2))
    ratio = (1 - 2 / dof) / (1 + (b2 - mean) / math.sqrt(variance) * math.sqrt(2 / (dof - 4)))
    return (1 - 2 / (9 * dof) - math.cbrt(ratio)) / math.sqrt(2 / (9 * dof))


def normaltest(df: DataFrame, value: str) -> DataFrame:
    """ST9 — D'Agostino–Pearson K²: the squared scores of skewness and kurtosis."""
    r = df.agg(F.count(c(value)).alias("n"), F.skewness(c(value)).alias("b1"), F.kurtosis(c(value)).alias("g2")).first()
    k2 = skewness_z(r["b1"], r["n"]) ** 2 + kurtosis_z(r["g2"] + 3.0, r["n"]) ** 2
    return _frame(df, [(value, r["n"], k2, tails.chi2_sf(k2, 2))], "feature string, n long, k2 double, p_value double")


def qq_points(df: DataFrame, value: str, points: int = 100) -> DataFrame:
    """ST23 — sample quantiles (exact percentiles) against standard normal quantiles."""
    probs = [(i + 0.5) / points for i in range(points)]
    qv = quantile_values(df, [value], probs)
    qs = [qv[(value, float(p))] for p in probs]
    rows = [(float(p), tails.norm_ppf(p), float(q)) for p, q in zip(probs, qs)]
    return _frame(df, rows, "prob double, theoretical double, sample double")


# fixed value: 5 % point of A² for an estimated normal, before the correction for n
AD_5PCT = 0.787


def normality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ST10 — per feature, over all rows: Shapiro–Francia W′ and p, Anderson–Darling with its 5 %
    point, KS with p, bias-corrected skewness and kurtosis; normal if the Shapiro p exceeds .05."""
    from .quality import bias_corrected_kurtosis, bias_corrected_skew

    mom = df.agg(*[a for x in cols for a in (bias_corrected_skew(c(x)).alias(f"{x}__skew"),
                                             bias_corrected_kurtosis(c(x)).alias(f"{x}__kurt"))]).first()
    runs = written(value_runs(df, cols)[0])  # three statistics read the counts
    table = shapiro_francia_stats(runs).join(anderson_stats(runs).drop("n"), "feature").join(ks_normal_stats(runs).drop("n"), "feature")
    rows = []
    for r in table.collect():  # one row a column
        x, n = r["feature"], r["n"]
        p = shapiro_francia_p(r["w"], n)
        rows.append((x, n, r["w"], p, r["ad_stat"], round(AD_5PCT / (1 + 4 / n - 25 / n ** 2), 3), r["ks_stat"],
                     tails.kolmogorov_sf(r["ks_stat"], n), mom[f"{x}__skew"], mom[f"{x}__kurt"], bool(p > 0.05)))
    return _frame(df, rows, "feature string, n long, shapiro_stat double, shapiro_p double, ad_stat double, ad_critical_5pct double, "
                            "ks_stat double, ks_p double, skewness double, kurtosis double, is_normal boolean")


# ---------------------------------------------------------------------------
# resampling and multiple comparisons (ST19, ST20)
# ---------------------------------------------------------------------------

def bootstrap_f1(df: DataFrame, label: str, pred: str, reps: int = 1000, seed: int = 42,
                 by: str | None = None) -> DataFrame:
    """ST19 — F1 bootstrap 95 % interval.

    F1 depends on the rows only through the confusion counts, and resampling n
    rows with replacement draws those counts from Multinomial(n, counts/n).
    So Spark aggregates the four counts per group (one pass, map-side combined)
    and the replicates are drawn from them: exact in distribution, O(reps)
    work whatever the data size."""
    import numpy as np

    g = c(by) if by else F.lit("all")
    cnt = df.groupBy(g.alias("group")).agg(
        *[F.count_if((c(label) == y) & (c(pred) == p)).alias(n) for y, p, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    rows = []
    for i, r in enumerate(sorted(cnt.collect(), key=lambda r: str(r["group"]))):  # one row per group
        counts = np.array([r["tn"], r["fp"], r["fn"], r["tp"]], dtype=float)
        n = int(counts.sum())
        rng = np.random.default_rng(seed + i)
        draws = rng.multinomial(n, counts / n, size=reps)
        tp, fp, fn = draws[:, 3], draws[:, 1], draws[:, 2]
        den = 2 * tp + fp + fn
        f1 = np.where(den > 0, 2 * tp / np.maximum(den, 1), 0.0)
        rows.append((str(r["group"]), float(f1.mean()), float(f1.std(ddof=1)), float(np.percentile(f1, 2.5)),
                     float(np.percentile(f1, 97.5)), int(reps)))
    return _frame(df, rows, "group string, f1_mean double, f1_std double, ci_low double, ci_high double, replicates long")


def adjust_pvalues(df: DataFrame, p: str = "p_value", alpha: float = 0.05) -> DataFrame:
    """ST20 — Bonferroni, Holm (step-down running max) and Benjamini–Hochberg
    (step-up reverse running min), all clipped at 1, over any number of tests."""
    idx, m = with_row_index(df, [c(p)] + [c(x) for x in df.columns if x != p])
    i = F.col(ROW_INDEX) + 1
    t = idx.withColumn("_holm_raw", F.least(F.lit(1.0), (F.lit(m) - i + 1) * c(p))) \
        .withColumn("_bh_raw", F.least(F.lit(1.0), c(p) * F.lit(m) / i))
    t = running_sums(t, m, ["_holm_raw"], op="max")
    t = running_sums(t, m, ["_bh_raw"], op="min", reverse=True)
    return t.select(*[c(x) for x in df.columns],
                    F.least(F.lit(1.0), c(p) * F.lit(m)).alias("p_bonferroni"),
                    F.col("_holm_raw__cum").alias("p_holm"), F.col("_bh_raw__cum").alias("p_bh"),
                    (F.least(F.lit(1.0), c(p) * F.lit(m)) < alpha).alias("reject_bonferroni"),
                    (F.col("_holm_raw__cum") < alpha).alias("reject_holm"), (F.col("_bh_raw__cum") < alpha).alias("reject_bh"))


# ---------------------------------------------------------------------------
# tables of tests (ST21, ST22)
# ---------------------------------------------------------------------------

@dataclass
class Hypothesis:
    """A test to run: ``test`` is pearson (x, y), chi2 (x, y), anova (x by y), t_test,
    mann_whitney, ks_2samp or f_variance (x by the 0/1 column y)."""

    name: str
    description: str
    test: str
    x: str
    y: str


def hypothesis_table(df: DataFrame, specs: Sequence[Hypothesis], alpha: float = 0.05) -> DataFrame:
    """ST21 — one row per hypothesis: test, statistic, p-value, ``reject_null`` and
    conclusion. All correlations are one aggregate; a test without enough data has null results."""
    run = {"chi2": lambda h: (chi2(df, h.x, h.y), "chi2"), "anova": lambda h: (anova(df, h.x, h.y), "f_stat"), "t_test": lambda h: (ttest(df, h.x, h.y), "t"),
           "mann_whitney": lambda h: (mann_whitney(df, h.x, h.y), "u"), "ks_2samp": lambda h: (ks_2samp(df, h.x, h.y), "ks_stat"),
           "f_variance": lambda h: (f_var_test(df, h.x, h.y), "f_stat")}
    pairs = [(h.x, h.y) for h in specs if h.test == "pearson"]
    pearson = {(r["x"], r["y"]): (r["r"], r["p_value"]) for r in pearson_test(df, pairs).collect()} if pairs else {}
    rows = []
    for h in specs:
        if h.test == "pearson":
            statistic, p = pearson[h.x, h.y]
        else:
            frame, column = run[h.test](h)
            r = frame.first()
            statistic, p = r[column], r["p_value"]
        reject = None if p is None else bool(p < alpha)
        rows.append((h.name, h.description, h.test, None if statistic is None else float(statistic), None if p is None else float(p), reject,
                     None if reject is None else "REJECTED" if reject else "FAIL TO REJECT"))
    return _frame(df, rows, "hypothesis string, description string, test string, statistic double, p_value double, reject_null boolean, conclusion string")


# fixed values: thresholds and texts of the assumption summary
STRONG_R = 0.5
DW_RANGE = (1.5, 2.5)
VIF_HIGH = 10.0


def assumption_summary(strong_linear: int, normal_share: float, durbin_watson: float, homo_share: float, high_vif: int,
                       stationary_share: float | None = None) -> list[tuple]:
    """ST22 — (assumption, value, status, implication) rows from test outputs."""
    said = lambda ok: "SATISFIED" if ok else "NOT SATISFIED"
    free = DW_RANGE[0] < durbin_watson < DW_RANGE[1]
    rows = [
        ("Linearity", float(strong_linear), "NOT SATISFIED" if strong_linear == 0 else f"PARTIAL ({strong_linear} features)", "Use non-linear models (RF, XGBoost)"),
        ("Normality", normal_share, said(normal_share > 0.5), "Use non-parametric tests"),
        ("Independence", durbin_watson, said(free), "No autocorrelation" if free else "Autocorrelation present"),
        ("Homoscedasticity", homo_share, said(homo_share > 0.5), "Use robust standard errors"),
        ("Multicollinearity", float(high_vif), "SATISFIED" if high_vif == 0 else f"NOT SATISFIED ({high_vif} features)",
         "Remove high-VIF features" if high_vif > 0 else "No action needed"),
    ]
    if stationary_share is not None:
        rows.append(("Stationarity", stationary_share, said(stationary_share > 0.5), "Apply differencing if needed"))
    return rows


def assumption_table(df: DataFrame, target: str, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """ST22 — runs the assumption tests and returns (assumption, value, status, implication)."""
    from .features import vif
    from .timeseries import durbin_watson, stationarity

    df = written(df)  # a dozen tests read it
    strong = sum(abs(r["r"] or 0.0) > STRONG_R for r in pearson_stats(df, [(x, target) for x in cols]).collect())
    norm = normality(df, [*cols, target]).agg(F.avg(F.col("is_normal").cast("double"))).first()[0] or 0.0
    dw = durbin_watson(df, target, order).first()["durbin_watson"]
    homo = homoscedasticity(df, target, cols).agg(F.avg(F.col("homoscedastic").cast("double"))).first()[0] or 0.0
    high = vif(df, cols).filter(F.col("vif") > VIF_HIGH).count()
    still = stationarity(df, list(cols), order).agg(F.avg(F.col("stationary").cast("double"))).first()[0]
    return _frame(df, assumption_summary(strong, norm, dw, homo, high, still), "assumption string, value double, status string, implication string")


# ---------------------------------------------------------------------------
# Kendall τ-b (ST3) by a distributed inversion count
# ---------------------------------------------------------------------------

def _weighted_inversions(order_rank, weights) -> float:
    """Σ over pairs i before j with rank_i > rank_j of wᵢ·wⱼ, by merging halves of
    growing size, all of one size at once."""
    import numpy as np

    _, rank = np.unique(np.asarray(order_rank), return_inverse=True)
    w, at, size, total = np.asarray(weights, dtype=float), np.arange(len(rank)), 1, 0.0
    while size < len(rank):
        pair, right = at // (2 * size), at // size % 2
        # by pair of halves, then rank; of equal ranks the left ones first, as they are no inversion
        order = np.argsort((pair * (len(rank) + 1) + rank) * 2 + right, kind="stable")
        left = np.where(right[order] == 0, w[order], 0.0)
        seen, pairs = np.cumsum(left), pair[order]
        last = np.flatnonzero(np.append(pairs[1:] != pairs[:-1], True))
        # left weights of the pair that come after, that is have a larger rank
        total += float((np.where(right[order] == 1, w[order], 0.0) * (seen[last][pairs] - seen)).sum())
        size *= 2
    return total


def kendall_stats(df: DataFrame, x: str, y: str, block: int = 200_000) -> DataFrame:
    """ST3 — Kendall τ-b and its tie-corrected z, with no pair enumeration.

    Rows aggregate to distinct (x, y) cells. Cells get two dense ranks: rx in
    (x, y) order and ry in (y, x) order, cut into fixed-size blocks. The
    discordant count D (pairs with xᵢ < xⱼ and yᵢ > yⱼ) is split into pairs in
    the same x-block (inversions of ry inside each x-block group), pairs in the
    same y-block but different x-blocks (inversions inside each y-block group
    minus their same-x-block part), and pairs in different blocks of both
    (from the grid of block counts, in Spark windows). S = n₀ − n₁ − n₂ + n₃ − 2D."""
    import pandas as pd

    d = df.select(c(x).cast("double").alias("_x"), c(y).cast("double").alias("_y")) \
        .filter(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))
    cells = d.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("w"))
    ix, m = with_row_index(cells, [F.col("_x"), F.col("_y")], name="rx")
    iy, _ = with_row_index(cells, [F.col("_y"), F.col("_x")], name="ry")
    t = ix.join(iy.select("_x", "_y", "ry"), ["_x", "_y"]) \
        .withColumn("xb", F.floor(F.col("rx") / block).cast("long")).withColumn("yb", F.floor(F.col("ry") / block).cast("long"))

    def same_x(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("rx")
        return pd.DataFrame({"d": [_weighted_inversions(p["ry"], p["w"])]})

    def same_y(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("rx")
        total = _weighted_inversions(p["ry"], p["w"])
        within = sum(_weighted_inversions(g["ry"], g["w"]) for _, g in p.groupby("xb", sort=False))
        return pd.DataFrame({"d": [total - within]})

    d1 = t.groupBy("xb").applyInPandas(same_x, "d double").agg(F.sum("d")).first()[0] or 0.0
    d2 = t.groupBy("yb").applyInPandas(same_y, "d double").agg(F.sum("d")).first()[0] or 0.0
    # pairs (a, b) with xb_a < xb_b and yb_a > yb_b, from the whole grid of blocks: sums over the
    # blocks above in each column, then over the columns before, both in windows of one column or row
    blocks = (m + block - 1) // block
    held = t.groupBy("xb", "yb").agg(F.sum("w").cast("double").alias("w"))
    every = df.sparkSession.range(blocks * blocks).select(F.floor(F.col("id") / F.lit(max(blocks, 1))).alias("xb"), F.pmod("id", F.lit(max(blocks, 1))).alias("yb"))
    grid = every.join(held, ["xb", "yb"], "left").na.fill(0.0, ["w"])
    above = F.sum("w").over(Window.partitionBy("xb").orderBy(F.desc("yb")).rowsBetween(Window.unboundedPreceding, -1))
    grid = grid.withColumn("above", F.coalesce(above, F.lit(0.0)))
    before = F.sum("above").over(Window.partitionBy("yb").orderBy("xb").rowsBetween(Window.unboundedPreceding, -1))
    d3 = float(grid.withColumn("before", F.coalesce(before, F.lit(0.0))).agg(F.sum(F.col("w") * F.col("before"))).first()[0] or 0.0)
    dcount = d1 + d2 + d3
    n_rows = d.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    tx = d.groupBy("_x").count().select(F.col("count").cast("double").alias("t"))
    ty = d.groupBy("_y").count().select(F.col("count").cast("double").alias("t"))

    def tie_sums(tt):
        tt = tt.withColumn("t", F.col("t").cast("double"))  # cubes of counts
        return tt.agg(F.sum(F.col("t") * (F.col("t") - 1) / 2).alias("p"),
                      F.sum(F.col("t") * (F.col("t") - 1) * (2 * F.col("t") + 5)).alias("v1"),
                      F.sum(F.col("t") * (F.col("t") - 1) * (F.col("t") - 2)).alias("v2"),
                      F.sum(F.col("t") * (F.col("t") - 1)).alias("v3")).first()

    ax, ay = tie_sums(tx), tie_sums(ty)
    n3 = cells.agg(F.sum(F.col("w").cast("double") * (F.col("w") - 1) / 2)).first()[0] or 0.0
    n = float(n_rows)
    n0 = n * (n - 1) / 2
    s = n0 - ax["p"] - ay["p"] + n3 - 2 * dcount
    tau = s / math.sqrt((n0 - ax["p"]) * (n0 - ay["p"])) if (n0 - ax["p"]) > 0 and (n0 - ay["p"]) > 0 else float("nan")
    var = ((n * (n - 1) * (2 * n + 5) - ax["v1"] - ay["v1"]) / 18.0
           + (ax["v2"] * ay["v2"]) / (9.0 * n * (n - 1) * (n - 2)) + (ax["v3"] * ay["v3"]) / (2.0 * n * (n - 1)))
    z = s / math.sqrt(var) if var > 0 else float("nan")
    return df.sparkSession.createDataFrame([(x, y, int(n), float(s), float(tau), float(z), min(1.0, 2 * tails.norm_sf(abs(z))))],
                                           "x string, y string, n long, s double, tau_b double, z double, p_value double")
