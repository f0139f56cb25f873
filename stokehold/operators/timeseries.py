"""Order-dependent operators over one timestamped series (WN*).

All of them rest on a dense global row index (``core.with_row_index``) and on
block windows with a halo (``core.with_neighbors``), so a window never spans
the whole, unpartitioned table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tails
from .core import (ROW_INDEX, before_boundary, block_size, boundary_keys, c, checked_broadcast, with_neighbors,
                   with_row_index)


def _order_cols(order: Sequence[str]) -> list:
    return [c(x) for x in order]


def smooth(df: DataFrame, order: Sequence[str], cols: Sequence[str] | None = None, window: int = 3,
           min_distinct: int = 100, suffix: str | None = None) -> DataFrame:
    """WN1 — centred moving average over ``window`` rows (odd), ``min_periods=1``,
    written to ``{col}_smooth{window}`` for columns with more than ``min_distinct``
    distinct values."""
    if window % 2 != 1:
        raise ValueError("centred smoothing needs an odd window")
    suffix = suffix or f"_smooth{window}"
    from .core import numeric_columns

    cols = list(cols) if cols is not None else numeric_columns(df, exclude=order)
    if min_distinct:
        row = df.agg(*[F.count_distinct(c(x)).alias(x) for x in cols]).first()
        cols = [x for x in cols if row[x] > min_distinct]
    if not cols:
        return df
    half = window // 2
    indexed, n = with_row_index(df, _order_cols(order))
    others = [x for x in df.columns if x not in cols]
    nb = with_neighbors(indexed, n, cols, lags=half, leads=half, keep=others)
    new = {}
    for x in cols:
        members = [c(x)] + [c(f"{x}__lag{j}") for j in range(1, half + 1)] + [c(f"{x}__lead{j}") for j in range(1, half + 1)]
        total = sum((F.coalesce(m.cast("double"), F.lit(0.0)) for m in members[1:]), F.coalesce(members[0].cast("double"), F.lit(0.0)))
        count = sum((F.when(m.isNotNull(), 1).otherwise(0) for m in members[1:]), F.when(members[0].isNotNull(), 1).otherwise(0))
        new[x + suffix] = F.when(count > 0, total / count)
    return nb.withColumns(new).select(*[c(x) for x in df.columns], *[c(x) for x in new])


def smooth_correlation(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """WN2 — Pearson correlation between each original and its smoothed column (one pass)."""
    row = df.agg(*[F.corr(c(a), c(b)).alias(f"{a}__corr") for a, b in pairs])
    structs = [F.struct(F.lit(a).alias("column"), F.lit(b).alias("smoothed"), c(f"{a}__corr").alias("correlation"))
               for a, b in pairs]
    return row.select(F.inline(F.array(*structs)))


def interpolate_linear(df: DataFrame, cols: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """WN3 — linear interpolation by position; leading/trailing gaps take the
    nearest value (``limit_direction='both'``).

    Previous/next non-null values come from block windows; gaps that cross a
    block edge are bridged by carrying the last/first non-null of each block
    over the (one row per block) block table.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    indexed, n = with_row_index(df, _order_cols(order))
    b = block_size(n, 1, df.sparkSession.sparkContext.defaultParallelism)
    blk = F.floor(c(ROW_INDEX) / F.lit(b)).cast("long")
    t = indexed.withColumn("_blk", blk)
    back = Window.partitionBy("_blk").orderBy(ROW_INDEX).rowsBetween(Window.unboundedPreceding, 0)
    # "next non-null" as a running frame over the reversed order: an
    # unbounded-following frame would be re-aggregated for every row
    fwd = Window.partitionBy("_blk").orderBy(F.desc(ROW_INDEX)).rowsBetween(Window.unboundedPreceding, 0)
    point = {x: F.when(c(x).isNotNull(), F.struct(c(ROW_INDEX).alias("i"), c(x).cast("double").alias("v"))) for x in cols}
    t = t.withColumns({f"{x}__prev": F.last(point[x], ignorenulls=True).over(back) for x in cols}) \
         .withColumns({f"{x}__next": F.last(point[x], ignorenulls=True).over(fwd) for x in cols})
    # block table: last and first non-null point of each block, carried across blocks
    blocks = t.groupBy("_blk").agg(*[F.max(point[x]).alias(f"{x}__blast") for x in cols],
                                   *[F.min(point[x]).alias(f"{x}__bfirst") for x in cols])
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.desc("_blk")).rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select("_blk", *[F.last(c(f"{x}__blast"), ignorenulls=True).over(before).alias(f"{x}__cprev") for x in cols],
                          *[F.last(c(f"{x}__bfirst"), ignorenulls=True).over(after).alias(f"{x}__cnext") for x in cols])
    carry = checked_broadcast(carry, 1_000_000, known_rows=(n + b - 1) // b)
    t = t.join(carry, "_blk", "left")
    out = {}
    for x in cols:
        p = F.coalesce(c(f"{x}__prev"), c(f"{x}__cprev"))
        q = F.coalesce(c(f"{x}__next"), c(f"{x}__cnext"))
        between = p["v"] + (q["v"] - p["v"]) * (c(ROW_INDEX) - p["i"]) / (q["i"] - p["i"])
        filled = (F.when(c(x).isNotNull(), c(x).cast("double"))
                  .when(p.isNotNull() & q.isNotNull(), between)
                  .when(p.isNotNull(), p["v"]).otherwise(q["v"]))
        out[x] = filled.cast(df.schema[x].dataType)
    return t.withColumns(out).select(*[c(x) for x in df.columns])


SPLIT_NAMES = ("train", "validation", "test")


def time_split(df: DataFrame, order: Sequence[str], fractions: tuple[float, float] = (0.70, 0.85),
               split_col: str = "split", keep_index: bool = False) -> DataFrame:
    """WN4 — chronological split by position: [0, ⌊.70n⌋) train, [⌊.70n⌋, ⌊.85n⌋)
    validation, rest test.

    Only the two boundary keys are looked up (``core.boundary_keys``); rows are
    labelled by comparing their key with them, so no row is sorted or written.
    Where rows with one key lie on both sides of a boundary, or the index is
    wanted, positions come from a row index."""
    bounds = None if keep_index else boundary_keys(df, order, fractions, lambda n: [int(n * f) for f in fractions])
    if bounds is not None:
        train, validation = (before_boundary(order, i) for i in range(2))
        return df.crossJoin(F.broadcast(bounds)).select(  # one row
            *[c(x) for x in df.columns],
            F.when(train, SPLIT_NAMES[0]).when(validation, SPLIT_NAMES[1]).otherwise(SPLIT_NAMES[2]).alias(split_col))
    indexed, n = with_row_index(df, _order_cols(order))
    a, b = int(n * fractions[0]), int(n * fractions[1])
    out = indexed.withColumn(split_col, F.when(c(ROW_INDEX) < a, SPLIT_NAMES[0])
                             .when(c(ROW_INDEX) < b, SPLIT_NAMES[1]).otherwise(SPLIT_NAMES[2]))
    return out if keep_index else out.drop(ROW_INDEX)


def check_temporal_order(df: DataFrame, ts: str, split_col: str = "split",
                         order: Sequence[str] = SPLIT_NAMES) -> DataFrame:
    """WN5 — per split time range, and whether it ends before the next split starts."""
    ranges = df.groupBy(c(split_col).alias("split")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(c(ts)).alias("start"), F.max(c(ts)).alias("end"))
    pos = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("split"))
    ranges = ranges.withColumn("position", pos.cast("int"))
    nxt = ranges.select((F.col("position") - 1).alias("position"), F.col("start").alias("next_start"))
    return ranges.join(nxt, "position", "left").select(
        "split", "position", "rows", "start", "end",
        F.when(F.col("next_start").isNull(), F.lit(True)).otherwise(F.col("end") < F.col("next_start")).alias("before_next"))


def series_index(df: DataFrame, cols: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, int]:
    """The columns of a series in their order, sorted and written once for all tests on it."""
    return with_row_index(df.select(*[c(x) for x in dict.fromkeys([*order, *cols])]), _order_cols(order))


def _block_sums(series: DataFrame, n: int, x: Column, lags: int, work) -> list[float]:
    """Σ over the blocks of an indexed series of the vectors ``work(y, known, s, t)``: ``y`` holds a
    block's values behind the ``lags`` values before it (0.0 where not ``known``), ``s`` the place of its
    first own row and ``t`` that row's index. Each row travels once, with the halo of the next block."""
    b = block_size(n, lags, series.sparkSession.sparkContext.defaultParallelism)
    own = series.select(c(ROW_INDEX).alias("t"), x.cast("double").alias("x"), F.floor(c(ROW_INDEX) / F.lit(b)).cast("long").alias("block"))
    halo = own.filter(F.col("t") - F.col("block") * b >= b - lags).withColumn("block", F.col("block") + 1)

    def run(group: pa.Table) -> pa.Table:
        t, held = group.column("t").to_numpy(), group.column("x")
        order, first = np.argsort(t), group.column("block")[0].as_py() * b
        known = held.is_valid().to_numpy()[order]
        y = np.where(known, held.to_numpy()[order], 0.0)
        s = int(np.searchsorted(t[order], first))
        if s < lags:  # the start of the series
            y, known, s = np.append(np.zeros(lags - s), y), np.append(np.zeros(lags - s, bool), known), lags
        v = work(y, known, s, first) if s < len(y) else np.zeros(0)
        return pa.table({"e": pa.array(np.arange(len(v)), pa.int32()), "v": pa.array(v, pa.float64())})

    sums = own.unionByName(halo).groupBy("block").applyInArrow(run, "e int, v double").groupBy("e").agg(F.sum("v").alias("v"))
    return [r["v"] for r in sorted(sums.collect())]  # one row a sum


def _lagged_sums(df: DataFrame, col: str, order: Sequence[str], lags: int, center: bool, indexed: tuple[DataFrame, int] | None = None) -> tuple[dict, int]:
    """Sums of products at lags 0..lags; ``indexed`` is the series with its row index, if there already."""
    indexed, n = indexed or series_index(df, [col], order)
    x = c(col).cast("double")
    mean = indexed.agg(F.avg(x)).first()[0] if center else 0.0

    def work(y, known, s, t):
        both = known[s:] & known[s - 1:-1]
        d = np.where(both, y[s:] - y[s - 1:-1], 0.0)
        return np.array([known[s:].sum(), d @ d, *[y[s:] @ y[s - k:len(y) - k] for k in range(lags + 1)]])

    count, d1, *s = _block_sums(indexed, n, x - F.lit(mean or 0.0), max(lags, 1), work) or [0.0] * (lags + 3)
    return {"n": int(count) if count == count else 0, "d1": d1} | {f"s{k}": v for k, v in enumerate(s)}, n


def durbin_watson(df: DataFrame, col: str, order: Sequence[str], center: bool = False) -> DataFrame:
    """WN6 — Σ(xₜ−xₜ₋₁)² / Σxₜ²; the reference applies it to the raw series (``center=False``)."""
    s, n = _lagged_sums(df, col, order, 1, center)
    dw = s["d1"] / s["s0"] if s["s0"] else None
    return df.sparkSession.createDataFrame([(col, int(s["n"]), dw)], "column string, n long, durbin_watson double")


def acf_values(df: DataFrame, col: str, order: Sequence[str], nlags: int = 40) -> tuple[list[float], int]:
    s, n = _lagged_sums(df, col, order, nlags, center=True)
    return [1.0] + [s[f"s{k}"] / s["s0"] for k in range(1, nlags + 1)], int(s["n"])


def acf(df: DataFrame, col: str, order: Sequence[str], nlags: int = 40) -> DataFrame:
    """WN7 — autocorrelation rₖ = Σ(xₜ−x̄)(xₜ₋ₖ−x̄)/Σ(xₜ−x̄)², k = 0..nlags, one aggregate pass."""
    r, _ = acf_values(df, col, order, nlags)
    return df.sparkSession.createDataFrame([(k, float(v)) for k, v in enumerate(r)], "lag int, acf double")


def ljung_box(df: DataFrame, col: str, order: Sequence[str], lags: Sequence[int] = (10,)) -> DataFrame:
    """WN8 — Q = n(n+2) Σₖ rₖ²/(n−k) and its χ² tail, for each requested horizon."""
    h = max(lags)
    r, n = acf_values(df, col, order, h)
    rows = []
    for lag in lags:
        q = n * (n + 2) * sum(r[k] ** 2 / (n - k) for k in range(1, lag + 1))
        rows.append((int(lag), float(q), tails.chi2_sf(q, lag)))
    return df.sparkSession.createDataFrame(rows, "lag int, lb_stat double, lb_pvalue double")


def avg_rank(df: DataFrame, col: str, name: str = "rank") -> DataFrame:
    """WN13 — rank with ties averaged; only the distinct values are ordered,
    the ranks come back by an equi-join on the value (AQE splits hot values)."""
    from .core import distinct_value_ranks

    counts = df.groupBy(c(col).alias("_v")).agg(F.count(F.lit(1)).alias("cnt")).filter(c("_v").isNotNull())
    ranks = distinct_value_ranks(counts, "_v").select(c("_v"), c("midrank").alias(name))
    return df.join(ranks, df[col] == ranks["_v"], "left").drop("_v")


def kpss(df: DataFrame, col: str, order: Sequence[str], nlags: int | None = None, indexed: tuple[DataFrame, int] | None = None) -> DataFrame:
    """WN10 — KPSS level-stationarity statistic η = Σ Sₜ² / (n² σ̂²), with a
    Newey–West long-run variance (Bartlett weights, "auto" lag of Hobijn et al.),
    p-value interpolated in the published critical table (level case)."""
    from .core import running_sums

    series, n = indexed = indexed or series_index(df, [col], order)
    mean = series.agg(F.avg(c(col).cast("double"))).first()[0]
    e = series.withColumn("_e", c(col).cast("double") - F.lit(mean))
    cum = running_sums(e, n, ["_e"])
    s2 = cum.agg(F.sum(c("_e__cum") * c("_e__cum"))).first()[0]
    # autocovariances of the residuals for the long-run variance
    if nlags is None:
        # Hobijn, Franses & Ooms (1998) automatic bandwidth
        nlags = _kpss_autolag(df, col, order, n, indexed)
    sums, _ = _lagged_sums(df, col, order, max(nlags, 1), True, indexed)
    gamma0 = sums["s0"] / n
    lrv = gamma0 + 2.0 * sum((1.0 - k / (nlags + 1.0)) * sums[f"s{k}"] / n for k in range(1, nlags + 1))
    eta = s2 / (n * n) / lrv
    p = _kpss_p(eta)
    return df.sparkSession.createDataFrame([(col, float(eta), float(p), int(nlags))],
                                           "column string, kpss_stat double, kpss_pvalue double, lags int")


KPSS_LEVEL_CRIT = (  # fixed values: KPSS (1992) level-case critical values and their tail probabilities
    (0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01),
)


def _kpss_p(eta: float) -> float:
    crit = KPSS_LEVEL_CRIT
    if eta <= crit[0][0]:
        return crit[0][1]
    if eta >= crit[-1][0]:
        return crit[-1][1]
    for (c0, p0), (c1, p1) in zip(crit, crit[1:]):
        if c0 <= eta <= c1:
            return p0 + (p1 - p0) * (eta - c0) / (c1 - c0)
    return crit[-1][1]


def _kpss_autolag(df: DataFrame, col: str, order: Sequence[str], n: int, indexed: tuple[DataFrame, int]) -> int:
    cover = int(n ** (2.0 / 9.0))
    sums, _ = _lagged_sums(df, col, order, cover, True, indexed)
    s0 = sums["s0"] + 2.0 * sum(sums[f"s{k}"] for k in range(1, cover + 1))
    s1 = 2.0 * sum(k * sums[f"s{k}"] for k in range(1, cover + 1))
    if s0 == 0:
        return 0
    gamma_hat = 1.1447 * ((s1 / s0) ** 2) ** (1.0 / 3.0)
    return int(min(gamma_hat * n ** (1.0 / 3.0), n - 1))


# ---------------------------------------------------------------------------
# ADF unit-root test (WN9) and the stationarity verdict (WN11)
# ---------------------------------------------------------------------------

# fixed values: MacKinnon (1994) approximate p-value surface, constant-only
# regression, one variable: bounds, switch point and the two polynomials
ADF_TAU_MAX, ADF_TAU_MIN, ADF_TAU_STAR = 2.74, -18.86, -1.61
ADF_SMALLP = (2.1659, 1.4412, 0.038269)
ADF_LARGEP = (1.7339, 0.93202 * 1e-1, -0.12745 * 1e-1, -0.010368 * 1e-2)
#: Rows that one matrix product of the Gram sums takes.
GRAM_ROWS = 1 << 13


def adf_pvalue(stat: float) -> float:
    if stat > ADF_TAU_MAX:
        return 1.0
    if stat < ADF_TAU_MIN:
        return 0.0
    coef = ADF_SMALLP if stat <= ADF_TAU_STAR else ADF_LARGEP
    return tails.norm_cdf(sum(c_ * stat ** i for i, c_ in enumerate(coef)))


def _adf_gram(series: DataFrame, n: int, col: str, lags: int, first: int):
    """XᵀX, Xᵀy, yᵀy, n for Δyₜ on [1, yₜ₋₁, Δyₜ₋₁…Δyₜ₋lags] over rows t ≥ first: matrix
    products of a few thousand rows at a time inside the blocks (terms with a null count nothing)."""
    k = lags + 2
    upper = np.triu_indices(k + 1)

    def work(y, known, s, t):
        s += max(0, first - t)
        dy = np.append(0.0, np.where(known[1:] & known[:-1], y[1:] - y[:-1], 0.0))
        total = np.zeros((k + 1, k + 1))
        for at in range(s, len(y), GRAM_ROWS):
            to = min(at + GRAM_ROWS, len(y))
            x = np.empty((k + 1, to - at))  # 1, yₜ₋₁, the lagged differences, Δyₜ
            x[0], x[1], x[k] = 1.0, y[at - 1:to - 1], dy[at:to]
            for j in range(1, lags + 1):
                x[j + 1] = dy[at - j:to - j]
            total += x @ x.T
        return total[upper]

    g = np.zeros((k + 1, k + 1))
    g[upper] = _block_sums(series, n, c(col), lags + 1, work)
    g = np.triu(g) + np.triu(g, 1).T
    return g[:k, :k], g[:k, k], float(g[k, k]), int(g[0, 0])


def _eliminated(g: np.ndarray, right: np.ndarray) -> np.ndarray:
    """L⁻¹·right of g = LLᵀ, in which the first k rows solve the first k equations. Array steps
    only: on the driver, LAPACK's threads were seen to hang beside the JVM from about 100 equations on."""
    m, k = np.hstack([g, right]), len(g)
    for j in range(k):
        if not m[j, j] > 0:
            raise np.linalg.LinAlgError("Singular matrix")
        m[j] /= math.sqrt(m[j, j])
        m[j + 1:] -= m[j, j + 1:k, None] * m[j]
    return m[:, k:]


def adf(df: DataFrame, col: str, order: Sequence[str], maxlag: int | None = None, indexed: tuple[DataFrame, int] | None = None) -> DataFrame:
    """WN9 — augmented Dickey–Fuller with a constant, lag order by AIC on a
    common sample, statistic = t of yₜ₋₁, MacKinnon p-value. All regressions
    come from two passes of Gram sums over blocks with a halo."""
    indexed, n = indexed or series_index(df, [col], order)
    if maxlag is None:
        maxlag = int(math.ceil(12.0 * (n / 100.0) ** 0.25))
        maxlag = max(0, min(n // 2 - 2 - 1, maxlag))
    g, b, yy, m = _adf_gram(indexed, n, col, maxlag, maxlag + 1)
    z = _eliminated(g, b[:, None])[:, 0]
    ssr = yy - np.cumsum(z * z)[1:]  # of the regressions with 0 to maxlag lags
    best = int(np.argmin([m * (math.log(2 * math.pi) + math.log(r / m) + 1) + 2 * (k + 2) for k, r in enumerate(ssr)]))
    g2, b2, yy2, m2 = _adf_gram(indexed, n, col, best, best + 1)
    z, w = _eliminated(g2, np.stack([b2, np.eye(best + 2)[1]], axis=1)).T
    sigma2 = (yy2 - float((z * z).sum())) / (m2 - (best + 2))
    stat = float((w * z).sum() / math.sqrt(sigma2 * (w * w).sum()))
    return df.sparkSession.createDataFrame([(col, stat, adf_pvalue(stat), best, m2)],
                                           "column string, adf_stat double, adf_pvalue double, used_lag int, nobs long")


def stationarity(df: DataFrame, cols: Sequence[str], order: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """WN11 — stationary when ADF rejects a unit root and KPSS does not reject stationarity."""
    rows, indexed = [], series_index(df, cols, order)  # one sort for all columns and tests
    for x in cols:
        a = adf(df, x, order, indexed=indexed).first()
        k = kpss(df, x, order, indexed=indexed).first()
        rows.append((x, a["adf_stat"], a["adf_pvalue"], k["kpss_stat"], k["kpss_pvalue"],
                     bool(a["adf_pvalue"] < alpha and k["kpss_pvalue"] > alpha)))
    return df.sparkSession.createDataFrame(rows, "column string, adf_stat double, adf_pvalue double, kpss_stat double, "
                                                 "kpss_pvalue double, stationary boolean")
