"""Deterministic pseudo-random columns derived from row keys.

``rand()`` depends on partitioning and task retries; these depend only on the
key and the seed, so a recomputed partition (lost executor) or a different
layout gives the same draw.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_MANTISSA = (1 << 53) - 1


def hash_uniform(*keys, seed: int = 42) -> Column:
    """U[0, 1) from ``xxhash64(seed, keys…)``."""
    cols = [k if isinstance(k, Column) else F.col(k) for k in keys]
    h = F.xxhash64(F.lit(int(seed)), *cols)
    return (F.abs(h % F.lit(1 << 53)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def hash_normal(*keys, seed: int = 42) -> Column:
    """N(0, 1) by Box–Muller on two independent hash uniforms."""
    u1 = hash_uniform(*keys, seed=seed)
    u2 = hash_uniform(*keys, seed=seed + 7919)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def poisson1_from_uniform(u: Column, kmax: int = 12) -> Column:
    """Poisson(1) draw by inverse CDF (bootstrap multiplicity)."""
    cdf, p, expr = 0.0, math.exp(-1.0), None
    for k in range(kmax + 1):
        cdf += p
        cond = u < F.lit(cdf)
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
        p = p / (k + 1)
    return expr.otherwise(F.lit(kmax + 1))
