"""Scalar distribution functions used on the driver after a distributed aggregate.

scipy is not available, so the tails are computed from the regularised
incomplete beta / gamma functions (continued fractions, Lentz's method) and
``math.erfc``. Inputs are O(1) scalars: the data never reaches this module.
"""

from __future__ import annotations

import math

_EPS = 1e-15
_TINY = 1e-300


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def norm_sf(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def norm_pdf(x: float) -> float:
    return math.exp(-0.5 * x * x) / math.sqrt(2.0 * math.pi)


def norm_ppf(p: float) -> float:
    """Inverse normal CDF: rational start, then Newton steps on erfc."""
    if p <= 0.0:
        return -math.inf
    if p >= 1.0:
        return math.inf
    # start from a logistic-type approximation, refine with Newton (Halley) steps
    t = math.sqrt(-2.0 * math.log(min(p, 1.0 - p)))
    x = t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1.0 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t ** 3)
    x = -x if p < 0.5 else x
    for _ in range(50):
        err = norm_cdf(x) - p
        d = norm_pdf(x)
        if d == 0:
            break
        step = err / d
        step = step / (1.0 + 0.5 * x * step)
        x -= step
        if abs(step) < 1e-15 * max(1.0, abs(x)):
            break
    return x


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(lbeta)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def gammainc_lower(a: float, x: float) -> float:
    """Regularised lower incomplete gamma P(a, x)."""
    if x <= 0.0:
        return 0.0
    if x < a + 1.0:
        term = s = 1.0 / a
        ap = a
        for _ in range(100000):
            ap += 1.0
            term *= x / ap
            s += term
            if abs(term) < abs(s) * _EPS:
                break
        return s * math.exp(-x + a * math.log(x) - math.lgamma(a))
    return 1.0 - gammainc_upper(a, x)


def gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0.0:
        return 1.0
    if x < a + 1.0:
        return 1.0 - gammainc_lower(a, x)
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, 100000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = d if abs(d) > _TINY else _TINY
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, k: float) -> float:
    if x is None or k <= 0 or math.isnan(x):
        return float("nan")
    return gammainc_upper(k / 2.0, x / 2.0)


def t_sf(t: float, df: float) -> float:
    """One-sided upper tail of Student's t."""
    if t is None or math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0 if t > 0 else 1.0
    x = df / (df + t * t)
    tail = 0.5 * betainc(df / 2.0, 0.5, x)
    return tail if t > 0 else 1.0 - tail


def t_two_sided(t: float, df: float) -> float:
    if t is None or math.isnan(t):
        return float("nan")
    return min(1.0, 2.0 * t_sf(abs(t), df))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def f_cdf(f: float, d1: float, d2: float) -> float:
    return 1.0 - f_sf(f, d1, d2)


def t_ppf(p: float, df: float) -> float:
    """Inverse of the t CDF by bisection on ``t_sf`` (driver scalar)."""
    lo, hi = -1e3, 1e3
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if 1.0 - t_sf(mid, df) < p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def nct_sf(x: float, df: float, nc: float, steps: int = 4000) -> float:
    """Upper tail of the noncentral t, by integrating over the chi variable.

    P(T > x) = E_V[ Φ(nc − x·sqrt(V/df)) ] with V ~ χ²(df): Gauss–Laguerre-like
    midpoint integration on the chi density, adequate for power analysis.
    """
    if df > 1e5:
        return norm_sf(x - nc)
    # integrate over v in (0, vmax) with the chi-square density
    k = df / 2.0
    vmax = df + 40.0 * math.sqrt(2.0 * df) + 100.0
    h = vmax / steps
    total = 0.0
    log_norm = -math.lgamma(k) - k * math.log(2.0)
    for i in range(steps):
        v = (i + 0.5) * h
        dens = math.exp(log_norm + (k - 1.0) * math.log(v) - v / 2.0)
        total += dens * norm_cdf(nc - x * math.sqrt(v / df))
    return min(max(total * h, 0.0), 1.0)


def kolmogorov_sf(d: float, n_eff: float) -> float:
    """Asymptotic Kolmogorov tail for statistic ``d`` at effective size ``n_eff``."""
    if d <= 0:
        return 1.0
    lam = (math.sqrt(n_eff) + 0.12 + 0.11 / math.sqrt(n_eff)) * d
    s = 0.0
    for j in range(1, 200):
        term = 2.0 * (-1) ** (j - 1) * math.exp(-2.0 * j * j * lam * lam)
        s += term
        if abs(term) < 1e-16:
            break
    return min(max(s, 0.0), 1.0)
