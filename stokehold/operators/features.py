"""Feature transformers, scores and selection (FE*).

Fitting is always an aggregate (one row of parameters); applying is a column
expression with the fitted numbers as literals, so the transform stays inside
whole-stage codegen and needs no join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tails
from ..functions.scalar import cyclical, date_parts, safe_ratio
from ..session import written
from .core import c, numeric_columns, unpivot_metrics
from .quality import bias_corrected_skew


# ---------------------------------------------------------------------------
# scalers (FE2–FE5)
# ---------------------------------------------------------------------------

def minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE2 — (x − min)/(max − min); a constant column maps to 0."""
    row = df.agg(*[a for x in cols for a in (F.min(c(x)).alias(f"{x}__lo"), F.max(c(x)).alias(f"{x}__hi"))]).first()
    out = {}
    for x in cols:
        lo, hi = row[f"{x}__lo"], row[f"{x}__hi"]
        rng = (hi - lo) if (lo is not None and hi is not None and hi != lo) else 1.0
        out[x] = (c(x) - F.lit(lo if lo is not None else 0.0)) / F.lit(float(rng))
    return df.withColumns(out)


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE3 — (x − mean)/population std (std 0 → 1)."""
    row = df.agg(*[a for x in cols for a in (F.avg(c(x)).alias(f"{x}__m"), F.stddev_pop(c(x)).alias(f"{x}__s"))]).first()
    return df.withColumns({x: (c(x) - F.lit(row[f"{x}__m"])) / F.lit(row[f"{x}__s"] or 1.0) for x in cols})


def robust_scale(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """FE4 — (x − median)/IQR (IQR 0 → 1)."""
    from .quality import column_quantiles

    q = column_quantiles(df, cols, exact=exact)
    out = {}
    for x in cols:
        q1, med, q3 = (q[(x, p)] for p in (0.25, 0.5, 0.75))
        out[x] = (c(x) - F.lit(med)) / F.lit((q3 - q1) or 1.0)
    return df.withColumns(out)


def quantile_edges(df: DataFrame, col: str, k: int = 5, exact: bool = True) -> list[float]:
    from .quality import column_quantiles

    probs = [i / k for i in range(k + 1)]
    q = column_quantiles(df, [col], probs, exact=exact)
    edges = [q[(col, float(p))] for p in probs]
    keep = [edges[0]]
    for e in edges[1:]:
        if e - keep[-1] > 1e-8:  # zero-width bins are dropped
            keep.append(e)
    return keep


def quantile_bins(df: DataFrame, col: str, k: int = 5, name: str | None = None, exact: bool = True) -> DataFrame:
    """FE5 — k-quantile ordinal bins: edges at exact percentiles, bins ``[a, b)``,
    the last closed (the count of inner edges ≤ x)."""
    edges = quantile_edges(df, col, k, exact)
    inner = edges[1:-1]
    b = sum((F.when(c(col) >= F.lit(e), 1).otherwise(0) for e in inner), F.lit(0)) if inner else F.lit(0)
    return df.withColumn(name or f"{col}_bin", F.when(c(col).isNull(), F.lit(None)).otherwise(b).cast("int"))


def categorical_columns(df: DataFrame) -> list[str]:
    """FE6 — non-numeric, non-temporal columns."""
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("string", "boolean") and f.name not in ()]


# ---------------------------------------------------------------------------
# constructed features (FE7–FE9)
# ---------------------------------------------------------------------------

def temporal_features(df: DataFrame, ts: str) -> DataFrame:
    """FE7 — 6 calendar parts and 6 cyclical encodings."""
    parts = date_parts(ts)
    cols = {"hour": parts["hour"], "day_of_week": parts["day_of_week"], "day_of_month": parts["day"],
            "month": parts["month"], "quarter": parts["quarter"], "week_of_year": parts["week_of_year"]}
    df = df.withColumns(cols)
    hs, hc = cyclical("hour", 24)
    ds, dc = cyclical("day_of_week", 7)
    ms, mc = cyclical("month", 12)
    return df.withColumns({"hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc, "month_sin": ms, "month_cos": mc})


# Declarative specs: (output, kind, a, b); kind ratio = a/(b+eps), abs_ratio = a/(|b|+eps), diff = a − b.
# fixed values: the reference's domain features over its sensor names
BOILER_FEATURES = (
    ("steam_to_fuel_ratio", "ratio", "Main_steam_flow_th", "Coal_Flow_th"),
    ("air_to_fuel_ratio", "ratio", "Boiler_oxygen_level_", "Coal_Flow_th"),
    ("heat_rate_deviation", "diff", "NTHR_KcalKwh", "NPHR_KcalKwh"),
    ("aph_effect_leak_ratio", "abs_ratio", "APH_Effectiveness_", "APH_Leakage_"),
    ("flue_gas_temp_diff", "diff", "Corrected_Flue_Gas_Out_Temperature_C", "Flue_Gas_in_Temperature_C"),
    ("feedwater_temp_rise", "diff", "Feedwater_temperature_", "Refference_Temperature_C"),
    ("turbine_to_boiler_eff", "ratio", "HP_Turbine_eff_", "Boiler_Eff_"),
    ("net_to_gross_load", "ratio", "Nett_Load_MW", "Gross_Load_MW"),
    ("o2_aph_diff", "diff", "O2_Out_APH_", "O2_in_APH_"),
    ("energy_per_coal", "ratio", "Energy_Input_From_Boiler_Kcalh", "Coal_Flow_th"),
    ("enthalpy_drop", "diff", "Entalphy_inlet_MS_kjkg", "Entalphy_Cold_Reheat_kjkg"),
    ("deltaP_ratio", "abs_ratio", "ΔP_aktual_KjKg", "ΔHP_isentropis_KjKg"),
)


def feature_expr(kind: str, a: str, b: str, eps: float = 1e-6) -> Column:
    if kind == "ratio":
        return safe_ratio(a, b, eps)
    if kind == "abs_ratio":
        return safe_ratio(a, b, eps, absolute=True)
    if kind == "diff":
        return c(a) - c(b)
    raise ValueError(kind)


def constructed_features(df: DataFrame, specs=BOILER_FEATURES, eps: float = 1e-6) -> tuple[DataFrame, list[str]]:
    """FE8 — each spec only when both inputs exist; returns the frame and the new names."""
    made = {name: feature_expr(kind, a, b, eps) for name, kind, a, b in specs if a in df.columns and b in df.columns}
    return df.withColumns(made), list(made)


def lineage(specs=BOILER_FEATURES) -> dict[str, tuple[str, str]]:
    """Inputs of each constructed feature (used by leakage checks)."""
    return {name: (a, b) for name, _, a, b in specs}


def log_skewed(df: DataFrame, cols: Sequence[str], min_abs_skew: float = 2.0, suffix: str = "_log") -> tuple[DataFrame, list[str]]:
    """FE9 — log1p for columns with |bias-corrected skew| > 2 whose values are all > 0."""
    row = df.agg(*[a for x in cols for a in (bias_corrected_skew(c(x)).alias(f"{x}__sk"),
                                             F.bool_and(c(x) > 0).alias(f"{x}__pos"))]).first()
    chosen = [x for x in cols if row[f"{x}__sk"] is not None and abs(row[f"{x}__sk"]) > min_abs_skew and row[f"{x}__pos"]]
    return df.withColumns({x + suffix: F.log1p(c(x)) for x in chosen}), [x + suffix for x in chosen]


# ---------------------------------------------------------------------------
# univariate scores and selection (FE10–FE14, FE17, FE18)
# ---------------------------------------------------------------------------

def _scores_frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def f_regression_stats(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """FE10 (distributed part) — r and n per feature in one pass, F = r²/(1−r²)·(n−2)."""
    row = df.agg(*[a for x in cols for a in (
        F.corr(c(x), c(target)).alias(f"{x}__r"),
        F.count(F.when(c(x).isNotNull() & c(target).isNotNull(), 1)).alias(f"{x}__n"))])
    out = unpivot_metrics(row, cols, ["r", "n"], key="feature")
    return out.withColumn("f_score", F.col("r") * F.col("r") / (1 - F.col("r") * F.col("r")) * (F.col("n") - 2))


def f_regression(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """FE10 — univariate regression F and its p-value (F(1, n−2) tail on the driver)."""
    st = f_regression_stats(df, cols, target).collect()
    rows = [(r["feature"], r["f_score"], tails.f_sf(r["f_score"], 1, r["n"] - 2) if r["f_score"] is not None else None)
            for r in st]
    return _scores_frame(df.sparkSession, rows, "feature string, f_score double, p_value double")


def anova_sums(df: DataFrame, cols: Sequence[str], group: str) -> DataFrame:
    """Per feature: total n, k groups, between- and within-group sums of squares.

    Pass 1: per (group) count/sum/sum² for all features at once; pass 2 is on
    that small (groups × features) table."""
    per = df.groupBy(c(group).alias("_g")).agg(*[a for x in cols for a in (
        F.count(c(x)).alias(f"{x}__n"), F.avg(c(x)).alias(f"{x}__m"), F.var_pop(c(x)).alias(f"{x}__v"))])
    # centred sums: group means around the grand mean
    grand = per.agg(*[(F.sum(c(f"{x}__n") * c(f"{x}__m")) / F.sum(f"`{x}__n`")).alias(f"{x}__grand") for x in cols])
    per = per.crossJoin(F.broadcast(grand))
    aggs = []
    for x in cols:
        n, m, v = c(f"{x}__n"), c(f"{x}__m"), c(f"{x}__v")
        aggs += [F.sum(n).alias(f"{x}__N"), F.count(F.when(n > 0, 1)).alias(f"{x}__k"),
                 F.sum(n * (m - c(f"{x}__grand")) ** 2).alias(f"{x}__ssb"), F.sum(n * v).alias(f"{x}__ssw")]
    row = per.agg(*aggs)
    out = unpivot_metrics(row, cols, ["N", "k", "ssb", "ssw"], key="feature")
    return out.withColumn("f_score", (F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("N") - F.col("k"))))


def f_classif(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """FE11 — one-way ANOVA F per feature across classes, with p-values."""
    st = anova_sums(df, cols, label).collect()
    rows = [(r["feature"], r["f_score"], tails.f_sf(r["f_score"], r["k"] - 1, r["N"] - r["k"])
             if r["f_score"] is not None else None) for r in st]
    return _scores_frame(df.sparkSession, rows, "feature string, f_score double, p_value double")


def select_k_best(scores: DataFrame, k: int, by: str = "f_score", name: str = "feature") -> DataFrame:
    """FE12 / TK2 — top-k rows by score (ties by name)."""
    return scores.orderBy(F.desc_nulls_last(by), F.asc(name)).limit(k)


def mutual_info_discrete(df: DataFrame, x: str, y: str) -> DataFrame:
    """FE14 — plug-in mutual information (nats) treating every distinct x as a category."""
    from .core import checked_broadcast

    joint = df.groupBy(c(x).alias("_x"), c(y).alias("_y")).agg(F.count(F.lit(1)).alias("nxy"))
    # marginals by aggregation + join (a window partitioned by the label would
    # put the whole joint table into one partition per class)
    mx = joint.groupBy("_x").agg(F.sum("nxy").alias("nx"))
    my = joint.groupBy("_y").agg(F.sum("nxy").alias("ny"))
    t = joint.join(mx, "_x").join(checked_broadcast(my, 100_000), "_y")
    tot = joint.agg(F.sum("nxy").alias("n"))
    return t.crossJoin(F.broadcast(tot)).agg(  # one-row total
        F.sum(F.col("nxy") / F.col("n") * F.log(F.col("nxy").cast("double") / F.col("nx") * F.col("n") / F.col("ny"))).alias("mutual_info")
    ).select(F.lit(x).alias("feature"), "mutual_info")


def mutual_info_binned(df: DataFrame, cols: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """FE13 (re-aimed) — equal-frequency binned MI of each feature with the label. The columns are
    written once: each feature's quantiles take several passes."""
    out, held = None, written(df.select(*[c(x) for x in dict.fromkeys([*cols, label])]))
    for x in cols:
        binned = quantile_bins(held.select(c(x).alias(x), c(label).alias(label)), x, bins, name="_bin")
        part = mutual_info_discrete(binned, "_bin", label).select(F.lit(x).alias("feature"), "mutual_info")
        out = part if out is None else out.unionByName(part)
    return out


def corr_with(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """FE17 — Pearson r of every column with the target (target excluded), one pass."""
    cols = [x for x in (cols if cols is not None else numeric_columns(df)) if x != target]
    row = df.agg(*[F.corr(c(x), c(target)).alias(f"{x}__r") for x in cols])
    out = unpivot_metrics(row, cols, ["r"], key="feature")
    return out.select("feature", F.col("r").alias("correlation"), F.abs("r").alias("abs_correlation"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE18 — all pairwise correlations (long form), one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(c(a), c(b)).alias(f"{a}|{b}") for a, b in pairs])
    structs = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), c(f"{a}|{b}").alias("correlation"))
               for a, b in pairs]
    return row.select(F.inline(F.array(*structs)))


def high_corr_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.9) -> DataFrame:
    """FE18 — pairs with |r| above the threshold."""
    return corr_matrix(df, cols).filter(F.abs("correlation") > threshold)


def gram(df: DataFrame, cols: Sequence[str], intercept: bool = False) -> tuple[np.ndarray, int]:
    """XᵀX (uncentred) in one aggregate; nulls are filled with 0 (PRJ8)."""
    terms = [F.lit(1.0)] * intercept + [F.coalesce(c(x).cast("double"), F.lit(0.0)) for x in cols]
    k = len(terms)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(k):
        for j in range(i, k):
            aggs.append(F.sum(terms[i] * terms[j]).alias(f"g{i}_{j}"))
    row = df.agg(*aggs).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = row[f"g{i}_{j}"] or 0.0
    return g, int(row["n"])


VIF_BANDS = (5.0, 10.0)  # fixed values: OK below 5, MEDIUM up to 10, HIGH above


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE19 — VIF without intercept: VIFⱼ = (XᵀX)ⱼⱼ·((XᵀX)⁻¹)ⱼⱼ; singular → inf."""
    g, _ = gram(df, cols)
    try:
        inv = np.linalg.inv(g)
        vals = [float(g[j, j] * inv[j, j]) for j in range(len(cols))]
    except np.linalg.LinAlgError:
        vals = [math.inf] * len(cols)
    rows = [(x, v, "OK" if v < VIF_BANDS[0] else ("MEDIUM" if v < VIF_BANDS[1] else "HIGH")) for x, v in zip(cols, vals)]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double, status string")


def vif_gram_sql_terms(cols: Sequence[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]


# ---------------------------------------------------------------------------
# Yeo–Johnson (FE1)
# ---------------------------------------------------------------------------

def yj_expr(x: Column, lam) -> Column:
    """Yeo–Johnson transform of x; ``lam`` is a number or a column."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    pos = (F.when(F.abs(lam) < 1e-12, F.log1p(x))
           .otherwise((F.pow(x + 1, lam) - 1) / lam))
    neg = (F.when(F.abs(lam - 2) < 1e-12, -F.log1p(-x))
           .otherwise(-(F.pow(-x + 1, 2 - lam) - 1) / (2 - lam)))
    return F.when(x >= 0, pos).otherwise(neg)


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(rows, mean, sum of squared deviations) of two parts together, on the last axis."""
    n = a[..., 0] + b[..., 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(n > 0, b[..., 0] / n, 0.0)
        delta = np.where(b[..., 0] > 0, b[..., 1], a[..., 1]) - np.where(a[..., 0] > 0, a[..., 1], b[..., 1])
        mean = np.where(a[..., 0] > 0, a[..., 1], b[..., 1]) + delta * np.where(a[..., 0] > 0, share, 0.0)
        square = a[..., 2] + b[..., 2] + delta * delta * a[..., 0] * share
    return np.stack([n, mean, square], axis=-1)


def _yj_parts(v: np.ndarray, lams: Sequence[float]) -> np.ndarray:
    """(λ, 3): rows, mean and sum of squared deviations of the transformed values. Steps of λ are even, so each
    power is the one before times |x| + 1 to the step: two exponentials a value, however many λ."""
    out, n = np.zeros((len(lams), 3)), len(v)
    if not n:
        return out
    # up: λ of values from 0 on, down: 2 - λ of those below
    pos, held = v >= 0, np.log1p(np.abs(v))
    step = lams[1] - lams[0] if len(lams) > 1 else 0.0
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        # from the middle outwards, where the powers are exact to a few ulps
        mid = len(lams) // 2
        base, by = np.exp(np.where(pos, lams[mid], 2 - lams[mid]) * held), np.exp(np.where(pos, step, -step) * held)
        for order in (range(mid, len(lams)), range(mid - 1, -1, -1)):
            power = base if order.step > 0 else base / by
            for k in order:
                up, down = lams[k], 2 - lams[k]
                y = np.where(pos, held if abs(up) < 1e-12 else (power - 1) / up, -held if abs(down) < 1e-12 else -(power - 1) / down)
                mean = y.mean()
                y -= mean
                out[k] = n, mean, y @ y
                power = power * by if order.step > 0 else power / by
    return out


def _yj_loglik(df: DataFrame, grids: dict[str, Sequence[float]]) -> dict[str, list[float]]:
    """Log-likelihood of every (column, λ) pair, from one pass: tasks transform batches of rows for all λ and
    send counts, means and squared deviations."""
    cols, lams = list(grids), [list(g) for g in grids.values()]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends, signed = [np.zeros((len(g), 3)) for g in lams], [[math.inf, -math.inf] for _ in lams], [0.0] * len(lams)
        for batch in batches:
            for i, grid in enumerate(lams):
                v = batch.column(i).to_numpy(zero_copy_only=False)
                v = v[~np.isnan(v)]
                for lo in range(0, len(v), 1 << 13):  # what a step works on stays in the cache
                    w = v[lo:lo + (1 << 13)]
                    held[i] = _merged(held[i], _yj_parts(w, grid))
                    ends[i] = [min(ends[i][0], w.min()), max(ends[i][1], w.max())]
                    signed[i] += float((np.sign(w) * np.log1p(np.abs(w))).sum())
        yield pa.RecordBatch.from_pydict({"parts": pa.array([h.tobytes() for h in held], pa.binary()), "i": pa.array(range(len(lams)), pa.int32()),
                                          "lo": pa.array([e[0] for e in ends], pa.float64()), "hi": pa.array([e[1] for e in ends], pa.float64()), "s": pa.array(signed, pa.float64())})

    rows = df.select(*[c(x).cast("double").alias(f"c{i}") for i, x in enumerate(cols)]).mapInArrow(parts, "parts binary, i int, lo double, hi double, s double")
    found = rows.groupBy("i").agg(F.sort_array(F.collect_list("parts")).alias("parts"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("s").alias("s")).collect()  # a row a column
    by = {r["i"]: r for r in found}
    out = {}
    for i, x in enumerate(cols):
        total = np.zeros((len(lams[i]), 3))
        for p in by[i]["parts"] if i in by else ():
            total = _merged(total, np.frombuffer(p, np.float64).reshape(-1, 3))
        differ = i in by and by[i]["lo"] < by[i]["hi"]
        with np.errstate(divide="ignore", invalid="ignore"):
            var = total[:, 2] / total[:, 0]
        # a far λ may overflow
        out[x] = [float(-n / 2 * math.log(v) + (lam - 1) * by[i]["s"]) if differ and 0 < v < math.inf else -math.inf for lam, n, v in zip(lams[i], total[:, 0], var)]
    return out


def fit_yeo_johnson(df: DataFrame, cols: Sequence[str], start: float = 1.0, step: float = 1.0, around: int = 4, tolerance: float = 1e-6) -> dict[str, float]:
    """λ by maximum likelihood, unbounded. Each round is one aggregate over all columns
    that tries 2·``around`` + 1 values about each column's best: if the best is at an end, the
    bracket moves there and doubles its step, else it shrinks to the neighbours of the best. Ends with a parabola through the last three."""
    centre, width, out = {x: start for x in cols}, {x: step for x in cols}, {}
    while centre:
        grids = {x: [centre[x] + k * width[x] for k in range(-around, around + 1)] for x in centre}
        for x, ll in _yj_loglik(df, grids).items():
            best = int(np.argmax(ll))
            centre[x] = grids[x][best]
            if not math.isfinite(ll[best]):  # constant or empty
                out[x] = start
            elif best in (0, 2 * around) and abs(centre[x]) < 1e3:
                width[x] *= 2
            elif width[x] > tolerance and best not in (0, 2 * around):
                a, b, z = ll[best - 1:best + 2]
                curve = a - 2 * b + z
                if width[x] < 1e-3 and math.isfinite(a) and math.isfinite(z) and curve < 0:
                    # near the top the likelihood is a parabola; further rounds would only meet rounding
                    out[x] = centre[x] + width[x] * (a - z) / (2 * curve)
                else:
                    width[x] /= around
            else:
                out[x] = centre[x]
        centre = {x: v for x, v in centre.items() if x not in out}
    return {x: out[x] for x in cols}


def yeo_johnson(df: DataFrame, cols: Sequence[str] | None = None, min_abs_skew: float = 1.0,
                standardize_output: bool = True, suffix: str = "_yj", stored: bool = False) -> tuple[DataFrame, dict[str, float]]:
    """FE1 — Yeo–Johnson on columns with |skew| > 1, λ by MLE, then standardised. ``stored``: reading ``df`` again costs a scan."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    sk = df.agg(*[bias_corrected_skew(c(x)).alias(x) for x in cols]).first()
    chosen = [x for x in cols if sk[x] is not None and abs(sk[x]) > min_abs_skew]
    # each round of the fit reads these columns again: they are written once
    kept = df.select(*[c(x) for x in chosen])
    lambdas = fit_yeo_johnson(kept if stored else written(kept), chosen) if chosen else {}
    out = df.withColumns({x + suffix: yj_expr(c(x).cast("double"), lam) for x, lam in lambdas.items()})
    if standardize_output and lambdas:
        out = standardize(out, [x + suffix for x in lambdas])
    return out, lambdas


# ---------------------------------------------------------------------------
# MLlib-backed importance and PCA (FE15, FE16, WN12)
# ---------------------------------------------------------------------------

def rf_importance(df: DataFrame, features: Sequence[str], label: str, trees: int = 100, classification: bool = True,
                  seed: int = 42, weight_col: str | None = None, max_depth: int = 10) -> DataFrame:
    """FE15 — random-forest feature importances (MLlib's, of a forest grown from packed rows)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.regression import RandomForestRegressor

    from ..models import forest

    kw = dict(featuresCol="features", labelCol=label, numTrees=trees, seed=seed, maxDepth=max_depth)
    if weight_col:
        kw["weightCol"] = weight_col
    est = RandomForestClassifier(**kw) if classification else RandomForestRegressor(**kw)
    model = forest.fit(est, df, features)
    imp = model.featureImportances.toArray()
    rows = sorted(((f, float(v)) for f, v in zip(features, imp)), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def pca_variance(df: DataFrame, cols: Sequence[str], k: int = 20, threshold: float = 0.95) -> DataFrame:
    """FE16 + WN12 — explained variance ratio per component of the standardised
    data, its cumulative sum and the first component reaching ``threshold``."""
    from pyspark.ml.feature import PCA

    from .quality import assemble

    k = min(k, len(cols))
    z = assemble(standardize(df, cols), cols)
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(z)
    ev = [float(v) for v in model.explainedVariance.toArray()]
    cum = list(np.cumsum(ev))
    first = next((i + 1 for i, v in enumerate(cum) if v >= threshold), None)
    rows = [(i + 1, ev[i], float(cum[i]), first == i + 1) for i in range(k)]
    return df.sparkSession.createDataFrame(rows, "component int, explained_variance double, cumulative double, reaches_threshold boolean")


def pca_project(df: DataFrame, cols: Sequence[str], k: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """FE16 — projection on the first k components (standardised input)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    from .quality import assemble

    z = assemble(standardize(df, cols), cols)
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(z)
    arr = vector_to_array(F.col("pcs"))
    return model.transform(z).select(*[c(x) for x in keep], *[arr[i].alias(f"pc{i + 1}") for i in range(k)])
