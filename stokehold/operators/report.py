"""Comparison and reporting tables (CMP*, SNK4). Inputs are result tables
(one row per model/split), so these are small DataFrame transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .core import c

# fixed values: F1 bands of the model table (leakage first)
F1_BANDS = ((0.5, "Above SOTA"), (0.3, "Within SOTA"))


def vs_baseline(results: DataFrame, baseline_model: str, metrics: Sequence[str], model: str = "model",
                by: Sequence[str] = ()) -> DataFrame:
    """CMP2 — relative improvement (%) of each model over the baseline row (0 when the baseline is 0)."""
    base = results.filter(c(model) == baseline_model).select(*[c(b) for b in by], *[c(m).alias(f"_b_{m}") for m in metrics])
    j = results.join(F.broadcast(base), list(by), "left") if by else results.crossJoin(F.broadcast(base))  # one baseline row
    return j.select(*[c(x) for x in results.columns],
                    *[F.when(c(f"_b_{m}") != 0, (c(m) - c(f"_b_{m}")) / c(f"_b_{m}") * 100).otherwise(0.0).alias(f"{m}_vs_baseline_pct")
                      for m in metrics])


def band_status(results: DataFrame, f1: str = "f1", leakage: str = "leakage") -> DataFrame:
    """CMP3 — status band per model."""
    st = F.when(c(leakage), "LEAKAGE (not comparable)")
    for thr, name in F1_BANDS:
        st = st.when(c(f1) > thr, name)
    return results.withColumn("status", st.otherwise("Below SOTA"))


def f1_summary(results: DataFrame, f1: str = "f1") -> DataFrame:
    """CMP3 — descriptive statistics of F1 across models (population std)."""
    return results.agg(F.count(c(f1)).alias("models"), F.avg(c(f1)).alias("f1_mean"), F.stddev_pop(c(f1)).alias("f1_std"),
                       F.min(c(f1)).alias("f1_min"), F.max(c(f1)).alias("f1_max"))


def rank_models(results: DataFrame, f1: str = "f1", leakage: str = "leakage", model: str = "model") -> DataFrame:
    """CMP4 — ranking without leaky models (rank 1 = best pick)."""
    valid = results.filter(~c(leakage))
    w = Window.orderBy(F.desc(f1), F.asc(model))  # result tables hold one row per model
    return valid.withColumn("rank", F.row_number().over(w))


def cost_table(results: DataFrame, n_anomalies: int | None = None, fp_cost: float = 100.0, fn_cost: float = 1000.0,
               recall: str = "recall", fp: str | None = "fp", fn: str | None = "fn") -> DataFrame:
    """CMP5 — FN cost as the reference estimates it, fn_cost·(1 − recall)·anomalies,
    and the full cost fp_cost·FP + fn_cost·FN when counts are present."""
    out = results
    if n_anomalies is not None:
        out = out.withColumn("fn_cost_est", F.lit(fn_cost) * (1 - c(recall)) * F.lit(n_anomalies))
    if fp and fn and fp in results.columns and fn in results.columns:
        out = out.withColumn("total_cost", F.lit(fp_cost) * c(fp) + F.lit(fn_cost) * c(fn))
    return out


def fastest(results: DataFrame, time_col: str, model: str = "model") -> DataFrame:
    """CMP6 — the model with the smallest time (ties by name)."""
    return results.agg(F.min_by(c(model), F.struct(c(time_col), c(model))).alias("fastest_model"),
                       F.min(c(time_col)).alias(time_col))


def insights(metrics: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """CMP7 — (category, message) rows for every rule whose SQL condition holds;
    the message is a template with ``{col}`` placeholders filled from the row."""
    import re

    parts = []
    for category, condition, template in rules:
        pieces = re.split(r"\{(\w+)\}", template)
        msg = F.concat(*[F.lit(p) if i % 2 == 0 else F.round(c(p), 4).cast("string") if
                         metrics.schema[p].dataType.typeName() in ("double", "float") else c(p).cast("string")
                         for i, p in enumerate(pieces) if p != "" or i % 2])
        parts.append(metrics.filter(F.expr(condition)).select(F.lit(category).alias("category"), msg.alias("message")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def final_report(stages: dict[str, DataFrame]) -> DataFrame:
    """CMP8 — (stage, metric, value) union of one-row metric tables."""
    out = None
    for stage, df in stages.items():
        cols = [x for x in df.columns if df.schema[x].dataType.typeName() in ("double", "float", "long", "integer")]
        part = df.select(F.inline(F.array(*[F.struct(F.lit(stage).alias("stage"), F.lit(x).alias("metric"),
                                                     c(x).cast("double").alias("value")) for x in cols])))
        out = part if out is None else out.unionByName(part)
    return out


def to_json_records(df: DataFrame, group: str) -> DataFrame:
    """SNK4 — nested JSON: one record per group with its rows as an array."""
    rest = [x for x in df.columns if x != group]
    return df.groupBy(c(group).alias(group)).agg(F.collect_list(F.struct(*[c(x) for x in rest])).alias("rows")) \
        .select(F.to_json(F.struct(group, "rows")).alias("json"))
