"""Explanation, ablation and robustness as Spark jobs (XP2–XP7, XP9).

A "scorer" is any ``DataFrame -> DataFrame`` adding ``score`` and ``pred``
(e.g. ``IsolationForestModel.transform``). Where many variants of each row are
scored (XP2–XP4), the isolation forest is walked inside the tasks instead.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.random import hash_normal, hash_uniform
from .core import ROW_INDEX, c, with_row_index
from .evaluate import binary_metrics, metrics_from_counts

Scorer = Callable[[DataFrame], DataFrame]
#: Rows walked at once for all points of a feature.
GRID_ROWS = 1 << 13
#: Rows for which a task makes its Shapley tables once.
TABLE_ROWS = 1 << 17


def _f1(df: DataFrame, label: str, pred: str = "pred", by: str | None = None) -> DataFrame:
    return binary_metrics(df, label, pred, by)


def _batch(batch: pa.RecordBatch, column: str, d: int) -> np.ndarray:
    """An array column of ``d`` (or a multiple of ``d``) values a row: (values, rows)."""
    flat = batch.column(batch.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1).T if batch.num_rows else np.zeros((d, 0))


def _vector(features: Sequence[str]) -> Column:
    return F.array(*[F.nanvl(F.coalesce(c(f).cast("double"), F.lit(0.0)), F.lit(0.0)) for f in features])


def permutation_importance(df: DataFrame, model, features: Sequence[str], label: str, key: Sequence[str],
                           repeats: int = 10, seed: int = 42) -> DataFrame:
    """XP2 — F1 drop of an isolation forest when one feature is permuted. Rows get one
    index in the order of a key hash; repeat r gives each row the values of the row a random
    step further on (a cyclic permutation), so all repeats are lookups in one ordering.
    Tasks score the variants of their rows and send counts."""
    ensure = df.select(c(label).cast("int").alias("_y"), _vector(features).alias("_x"), hash_uniform(*key, seed=seed).alias("_u"), *[c(k).alias(f"_k{i}") for i, k in enumerate(key)])
    indexed, n = with_row_index(ensure, [F.col("_u"), *[F.col(f"_k{i}") for i in range(len(key))]])
    spark, d, score, limit = df.sparkSession, len(features), model.scorer(features), model.threshold
    draw = random.Random(seed)
    steps = [0] + [draw.randrange(1, n) if n > 1 else 0 for _ in range(repeats)]  # first: the row itself
    sent = indexed.select(F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.pmod(F.col(ROW_INDEX) - F.lit(s), F.lit(max(n, 1))).alias("to")) for r, s in enumerate(steps)])).alias("e"), "_x", "_y")
    met = sent.select("e.to", F.struct("e.r", "_x").alias("v"), F.when(F.col("e.r") == 0, F.col("_y")).alias("_y"))
    rows = met.groupBy("to").agg(F.flatten(F.transform(F.array_sort(F.collect_list("v")), lambda v: v["_x"])).alias("_v"), F.max("_y").alias("_y"))  # repeats + 1 entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros((repeats * d + 1, 2, 2), np.int64)  # by variant, label, prediction
        for batch in batches:
            v = _batch(batch, "_v", d * (repeats + 1)).reshape(repeats + 1, d, batch.num_rows)
            y = batch.column(batch.schema.get_field_index("_y")).to_numpy(zero_copy_only=False).astype(np.int64)
            for k in range(repeats * d + 1):
                x = v[0]
                if k:
                    r, j = divmod(k - 1, d)
                    x = x.copy()
                    x[j] = v[r + 1, j]
                hits[k] += np.bincount(2 * y + (score(x) > limit), minlength=4).reshape(2, 2)
        yield pa.RecordBatch.from_pydict({"k": pa.array(range(len(hits)), pa.int32()), "tn": pa.array(hits[:, 0, 0]), "fp": pa.array(hits[:, 0, 1]),
                                          "fn": pa.array(hits[:, 1, 0]), "tp": pa.array(hits[:, 1, 1])})

    counts = rows.mapInArrow(run, "k int, tn long, fp long, fn long, tp long").groupBy("k").agg(*[F.sum(x).alias(x) for x in ("tn", "fp", "fn", "tp")])
    f1 = metrics_from_counts(counts).select("k", "f1")
    base = f1.filter("k = 0").select(F.col("f1").alias("base"))
    names = F.element_at(F.array(*[F.lit(f) for f in features]), ((F.col("k") - 1) % d + 1).cast("int"))
    return f1.filter("k > 0").crossJoin(F.broadcast(base)).withColumn("drop", F.col("base") - F.col("f1")).groupBy(names.alias("feature")) \
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_samp("drop").alias("importance_std"))  # base is one row


def partial_dependence(df: DataFrame, model, features: Sequence[str], grid: int = 50, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """XP3 — mean score over all rows with one feature set to each of ``grid`` points
    between its p5 and p95. Tasks walk each tree once for all points of a feature
    (``Walker.varied``): no row is repeated, and sums are all that is sent."""
    from .core import quantile_values

    qv = quantile_values(df, features, [lo, hi])
    ends = [(qv[(f, float(lo))], qv[(f, float(hi))]) for f in features]
    points = [[a + (b - a) * i / (grid - 1) for i in range(grid)] if grid > 1 else [a] for a, b in ends if a is not None]
    d, score, names = len(features), model.scorer(features), [f for f, (a, _) in zip(features, ends) if a is not None]
    at = [list(features).index(f) for f in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((len(names), grid)), 0
        for batch in batches:
            x = _batch(batch, "_x", d)
            rows += batch.num_rows
            for lo in range(0, batch.num_rows, GRID_ROWS):
                for k, j in enumerate(at):
                    total[k] += score.varied(x[:, lo:lo + GRID_ROWS], j, points[k]).sum(axis=0)
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array([f for f in names for _ in range(grid)], pa.string()), "value": pa.array([float(p) for ps in points for p in ps], pa.float64()),
            "total": pa.array(total.ravel()), "n": pa.array([rows] * total.size, pa.int64())})

    sums = df.select(_vector(features).alias("_x")).mapInArrow(run, "feature string, value double, total double, n long")
    return sums.groupBy("feature", "value").agg((F.sum("total") / F.sum("n")).alias("mean_score"))


def coalition_weights(k: int) -> np.ndarray:
    """(features, coalitions): what each coalition's value counts in each feature's Shapley value, Σ |S|!(k−|S|−1)!/k!·(v(S∪i) − v(S))."""
    w, fact = np.zeros((k, 1 << k)), math.factorial
    for i in range(k):
        for m in range(1 << k):
            if not m >> i & 1:
                s = bin(m).count("1")
                share = fact(s) * fact(k - s - 1) / fact(k)
                w[i, m | 1 << i] += share
                w[i, m] -= share
    return w


def shapley_values(x: np.ndarray, background: np.ndarray, score) -> np.ndarray:
    """Interventional Shapley values (features, rows) of ``score`` at the columns of ``x``: a
    coalition's value is the mean score with the other features from each background row."""
    k, n = x.shape
    values = np.zeros((1 << k, n))
    walker = hasattr(score, "varied")
    for m in range(1 << k):
        inside = np.array([bool(m >> i & 1) for i in range(k)])
        if inside.all():
            values[m] = score(x)
            continue
        if walker and inside.sum() == k - 1:
            j = int(np.flatnonzero(~inside)[0])
            for lo in range(0, n, GRID_ROWS):
                values[m, lo:lo + GRID_ROWS] = score.varied(x[:, lo:lo + GRID_ROWS], j, background[j]).mean(axis=1)
            continue
        if walker and 1 <= inside.sum() <= 2:
            found = score.beside(x, np.flatnonzero(inside).tolist(), background)
            if found is not None:
                values[m] = found.mean(axis=1)
                continue
        for b in background.T:
            mixed = np.where(inside[:, None], x, b[:, None])
            values[m] += score(mixed) / background.shape[1] if inside.any() else score(mixed[:, :1])[0] / background.shape[1]
    return coalition_weights(k) @ values


def shapley_importance(df: DataFrame, model, features: Sequence[str], key: Sequence[str], background: int = 25, seed: int = 42) -> DataFrame:
    """XP4 — mean |φ| per feature over all rows of ``df``: exact interventional Shapley
    values against ``background`` rows drawn by key hash, worked out inside the tasks. For few features (coalitions are 2^k)."""
    from .sampling import sample_n

    d = len(features)
    if d > 12:
        raise ValueError("exact coalitions need few features")
    drawn = sample_n(df, background, key, seed).select(_vector(features).alias("x")).collect()  # ``background`` rows
    if not drawn:
        return df.sparkSession.createDataFrame([], "feature string, mean_abs_shap double")
    beside, score = np.array([r["x"] for r in drawn], float).T, model.scorer(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows, held, waiting = np.zeros(d), 0, [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(_batch(batch, "_x", d))
                waiting += batch.num_rows
            if waiting and (batch is None or waiting >= TABLE_ROWS):
                total += np.abs(shapley_values(np.concatenate(held, axis=1), beside, score)).sum(axis=1)
                rows, held, waiting = rows + waiting, [], 0
        yield pa.RecordBatch.from_pydict({"feature": pa.array(list(features), pa.string()), "total": pa.array(total), "n": pa.array([rows] * d, pa.int64())})

    sums = df.select(_vector(features).alias("_x")).mapInArrow(run, "feature string, total double, n long")
    return sums.groupBy("feature").agg((F.sum("total") / F.sum("n")).alias("mean_abs_shap"))


def local_surrogate(rows: DataFrame, scorer: Scorer, features: Sequence[str], key: Sequence[str], scale: dict[str, float],
                    n: int = 1000, seed: int = 42) -> DataFrame:
    """XP5 (re-aimed) — LIME-style local linear surrogate for every given row:
    ``n`` Gaussian perturbations per row (hash-seeded), kernel weights on the
    standardised distance, weighted least squares per row (``applyInPandas``
    on groups of n rows)."""
    import pandas as pd

    k = len(features)
    width = 0.75 * math.sqrt(k)
    ids = [F.col(f"`{x}`").alias(f"_key{i}") for i, x in enumerate(key)]
    ex = rows.select("*", *ids).withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    kcols = [f"_key{i}" for i in range(len(key))]
    for i, f in enumerate(features):
        ex = ex.withColumn(f"_z{i}", F.when(F.col("_j") == 0, F.lit(0.0)).otherwise(hash_normal(*kcols, "_j", seed=seed + i)))
        ex = ex.withColumn(f, c(f) + F.col(f"_z{i}") * F.lit(float(scale.get(f, 1.0))))
    d2 = sum((F.col(f"_z{i}") ** 2 for i in range(k)), F.lit(0.0))
    ex = ex.withColumn("_w", F.exp(-d2 / F.lit(width * width)))
    scored = scorer(ex).select(*[F.col(kc).alias(x) for kc, x in zip(kcols, key)], *[F.col(f"_z{i}") for i in range(k)],
                               "_w", "score")
    key_cols = list(key)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        z = np.column_stack([np.ones(len(pdf))] + [pdf[f"_z{i}"].to_numpy() for i in range(k)])
        w = np.sqrt(pdf["_w"].to_numpy())
        coef, *_ = np.linalg.lstsq(z * w[:, None], pdf["score"].to_numpy() * w, rcond=None)
        out = pd.DataFrame({"feature": list(features), "weight": coef[1:]})
        for kc in key_cols:
            out.insert(0, kc, pdf[kc].iloc[0])
        return out

    schema = ", ".join(f"`{kc}` {rows.schema[kc].dataType.simpleString()}" for kc in key_cols) + ", feature string, weight double"
    return scored.groupBy(*[c(x) for x in key]).applyInPandas(fit, schema)


def ablation(train: DataFrame, val: DataFrame, features: Sequence[str], label: str, base) -> DataFrame:
    """XP6 — validation F1 with all features and with each one dropped; ``base`` are
    isolation-forest parameters. All forests grow in one job and score a row at once."""
    from dataclasses import replace

    from ..models import iforest as IF

    names = ["none", *features]
    grown = IF.grow_forests(train, [replace(base, features=[x for x in features if x != f]) for f in names])
    limits = IF.thresholds(IF.written(grown.scores(train, [])), grown, [base.contamination] * len(names)) if base.contamination != "auto" else [0.5] * len(names)
    table = grown.f1_table(grown.scores(val.withColumn("_all", F.lit("all")), [label, "_all"]), label, "_all", limits)
    full = F.max(F.when(F.col("forest") == 0, F.col("f1"))).over(Window.partitionBy("_all"))  # one row a forest
    dropped = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("forest") + 1)
    return table.select(dropped.alias("dropped"), "precision", "recall", "f1", (full - F.col("f1")).alias("f1_drop"))


def seed_stability(train: DataFrame, evaluate_on: DataFrame, label: str, base, seeds: Sequence[int],
                   max_std: float = 0.05) -> DataFrame:
    """XP7 — F1 over seeds: mean, std, min, max and a stability status; the forests
    of all seeds grow in one job."""
    from dataclasses import replace

    from ..models import iforest as IF

    grown = IF.grow_forests(train, [replace(base, seed=s) for s in seeds])
    limits = IF.thresholds(IF.written(grown.scores(train, [])), grown, [base.contamination] * len(seeds)) if base.contamination != "auto" else [0.5] * len(seeds)
    t = grown.f1_table(grown.scores(evaluate_on.withColumn("_all", F.lit("all")), [label, "_all"]), label, "_all", limits)
    return t.agg(F.avg("f1").alias("f1_mean"), F.stddev_samp("f1").alias("f1_std"), F.min("f1").alias("f1_min"),
                 F.max("f1").alias("f1_max"), F.count(F.lit(1)).alias("seeds")) \
        .withColumn("status", F.when(F.col("f1_std") < max_std, "STABLE").otherwise("UNSTABLE"))


def cross_split(scored: DataFrame, label: str, split: str = "split") -> DataFrame:
    """XP7 — generalisation table: metrics per split of one scored table."""
    return _f1(scored, label, "pred", split)


def noise_robustness(df: DataFrame, scorer: Scorer, features: Sequence[str], label: str, key: Sequence[str],
                     sigmas: Sequence[float] = (0.01, 0.05, 0.1, 0.2), seed: int = 42,
                     single_sigma: float | None = 0.1, relative: bool = False) -> DataFrame:
    """XP9 — F1 when every feature gets N(0, σ²) noise (``relative``: σ times its
    standard deviation), for each σ (rows
    exploded per σ, hash-seeded noise), and with noise on one feature at a time."""
    stds = df.agg(*[F.stddev_samp(c(f)).alias(f) for f in features]).first() if relative else {f: 1.0 for f in features}
    scen = [(f"all@{s}", s, list(features)) for s in sigmas]
    if single_sigma is not None:
        scen += [(f"{f}@{single_sigma}", single_sigma, [f]) for f in features]
    ex = df.withColumn("_rk", F.xxhash64(*[c(x) for x in key])) \
        .withColumn("_sc", F.explode(F.array(*[F.lit(i) for i in range(len(scen))])))
    for j, f in enumerate(features):
        amp = None
        for i, (_, s, fs) in enumerate(scen):
            if f in fs:
                cond = F.col("_sc") == i
                amp = F.when(cond, F.lit(float(s) * float(stds[f] or 0.0))) if amp is None else amp.when(cond, F.lit(float(s) * float(stds[f] or 0.0)))
        if amp is not None:
            ex = ex.withColumn(f, c(f) + amp.otherwise(0.0) * hash_normal("_rk", "_sc", seed=seed + j))
    scored = scorer(ex)
    m = _f1(scored, label, "pred", "_sc")
    names = df.sparkSession.createDataFrame([(i, n, float(s)) for i, (n, s, _) in enumerate(scen)], "_sc int, scenario string, sigma double")
    return m.join(F.broadcast(names), "_sc").select("scenario", "sigma", "precision", "recall", "f1")
