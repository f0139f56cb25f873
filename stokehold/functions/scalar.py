"""Column functions (SC*). All are built-in Spark expressions (codegen'd)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col("`" + x + "`")


def date_parts(ts) -> dict[str, Column]:
    """SC1 — hour, weekday (Monday = 0), day, month, quarter, ISO week."""
    t = _col(ts)
    return {"hour": F.hour(t), "day_of_week": F.weekday(t), "day": F.dayofmonth(t), "month": F.month(t),
            "quarter": F.quarter(t), "week_of_year": F.weekofyear(t)}


def cyclical(x, period: float) -> tuple[Column, Column]:
    """SC2 — (sin, cos) of 2π·x/period."""
    a = F.lit(2 * math.pi) * _col(x) / F.lit(float(period))
    return F.sin(a), F.cos(a)


def safe_ratio(a, b, eps: float = 1e-6, absolute: bool = False) -> Column:
    """SC3 — a / (b + eps), or a / (|b| + eps)."""
    den = F.abs(_col(b)) if absolute else _col(b)
    return _col(a) / (den + F.lit(eps))


def clip(x, lo=None, hi=None) -> Column:
    """SC4 — clip to [lo, hi]; NULL stays NULL."""
    out = _col(x)
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return F.when(_col(x).isNull(), F.lit(None)).otherwise(out)


def log1p(x) -> Column:
    """SC5."""
    return F.log1p(_col(x))


def cut(x, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """SC6 — right-closed buckets (e₀, e₁], (e₁, e₂], …; outside → NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(edges) - 1 labels")
    v = _col(x)
    out = None
    for lo, hi, name in zip(edges, edges[1:], labels):
        cond = (v > F.lit(lo)) & (v <= F.lit(hi))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


SHIFT_EDGES = (-1, 6, 14, 22, 24)  # fixed values: shift boundaries on the hour of day
SHIFT_LABELS = ("Night", "Morning", "Evening", "Late")


def shift_of(ts) -> Column:
    """SC6 — shift of the hour: Night 0–6, Morning 7–14, Evening 15–22, Late 23."""
    return cut(F.hour(_col(ts)), SHIFT_EDGES, SHIFT_LABELS)


def quantile_class(x, q_low: float, q_high: float) -> Column:
    """SC7 — 0 for (−∞, q₃₃], 1 for (q₃₃, q₆₇], 2 above (thresholds fitted on train)."""
    v = _col(x)
    return F.when(v.isNull(), F.lit(None)).when(v <= F.lit(q_low), 0).when(v <= F.lit(q_high), 1).otherwise(2).cast("int")


def clean_text(x) -> Column:
    """SC8 — strip, drop non-word/non-space characters, whitespace runs → ``_``."""
    return F.regexp_replace(F.regexp_replace(F.trim(_col(x)), r"[^\p{L}\p{N}_\s]", ""), r"\s+", "_")


def round_to(x, digits: int) -> Column:
    """SC9."""
    return F.round(_col(x), digits)


def clip_prob(p, eps: float = 1e-10) -> Column:
    """SC10 — clip a probability into [eps, 1 − eps] before taking logs."""
    return F.greatest(F.least(_col(p), F.lit(1.0 - eps)), F.lit(eps))


# fixed values: rational approximations of erf and erfc (Cody, Mathematics of Computation 23, 1969), relative error below 1e-15:
# numerators and denominators for |x| <= 0.46875, up to 4 and beyond, highest power first
_ERF_NUM = (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3)
_ERF_DEN = (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3)
_MID_NUM = (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2,
            8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3)
_MID_DEN = (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
            3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3)
_FAR_NUM = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1,
            1.60837851487422766e-2, 6.58749161529837803e-4)
_FAR_DEN = (1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3)

# fixed values: normal quantiles (Wichura, algorithm AS 241 of Applied Statistics 37, 1988), relative error about 1e-16:
# numerators and denominators for the middle, the flanks and the tails, lowest power first
_MIDDLE_NUM = (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
               4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3)
_MIDDLE_DEN = (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
               2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3)
_FLANK_NUM = (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
              1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4)
_FLANK_DEN = (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
              1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)
_TAIL_NUM = (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
             2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7)
_TAIL_DEN = (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
             7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)


def _poly(coef, x: Column) -> Column:
    """Horner's rule, highest power first."""
    out = F.lit(coef[0])
    for a in coef[1:]:
        out = out * x + F.lit(a)
    return out


def erfc(x) -> Column:
    """erfc as a JVM expression (no Python in the hot path)."""
    x = _col(x)
    z, sq = F.abs(x), x * x
    near = F.lit(1.0) - x * _poly(_ERF_NUM, sq) / _poly(_ERF_DEN, sq)
    mid = F.exp(-sq) * _poly(_MID_NUM, z) / _poly(_MID_DEN, z)
    inv = F.lit(1.0) / sq
    far = F.exp(-sq) / z * (F.lit(1.0 / math.sqrt(math.pi)) - inv * _poly(_FAR_NUM, inv) / _poly(_FAR_DEN, inv))
    upper = F.when(z <= 4.0, mid).otherwise(far)
    return F.when(z <= 0.46875, near).when(x > 0, upper).otherwise(F.lit(2.0) - upper)


def normal_cdf(x) -> Column:
    """Φ(x) = erfc(−x/√2)/2 as a column expression."""
    return F.lit(0.5) * erfc(-_col(x) / F.lit(math.sqrt(2.0)))


def normal_density(z) -> Column:
    z = _col(z)
    return F.exp(-z * z / 2) / F.lit(math.sqrt(2 * math.pi))


def normal_quantile(p) -> Column:
    """Φ⁻¹(p) for 0 < p < 1 as a column expression (null outside)."""
    p = _col(p)
    q = p - F.lit(0.5)
    r = F.lit(0.180625) - q * q
    middle = q * _poly(_MIDDLE_NUM[::-1], r) / _poly(_MIDDLE_DEN[::-1], r)
    s = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    flank = _poly(_FLANK_NUM[::-1], s - 1.6) / _poly(_FLANK_DEN[::-1], s - 1.6)
    tail = _poly(_TAIL_NUM[::-1], s - 5.0) / _poly(_TAIL_DEN[::-1], s - 5.0)
    outer = F.when(s <= 5.0, flank).otherwise(tail)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, middle).when(q < 0, -outer).otherwise(outer))
