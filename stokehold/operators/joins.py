"""Key joins (JN*). Only left equi-joins appear in the reference; everything is
a plain Spark join so Catalyst/AQE choose broadcast vs sort-merge at runtime."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import c, unpivot_metrics


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, key: Sequence[str] | str) -> None:
    """Fail fast when ``key`` repeats: a left join on it would fan rows out."""
    keys = [key] if isinstance(key, str) else list(key)
    dup = df.groupBy(*[c(k) for k in keys]).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").limit(1).count()
    if dup:
        raise DuplicateKeyError(f"join key {keys} is not unique")


def attach_raw(df: DataFrame, raw: DataFrame, key: Sequence[str] | str, cols: Sequence[str],
               suffix: str = "_raw", check_unique: bool = True) -> DataFrame:
    """JN1 — left join ``cols`` of ``raw`` (renamed with ``suffix``) onto ``df`` by ``key``."""
    keys = [key] if isinstance(key, str) else list(key)
    right = raw.select(*[c(k) for k in keys], *[c(x).alias(x + suffix) for x in cols])
    if check_unique:
        assert_unique(right, keys)
    return df.join(right, keys, "left")


def join_coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """JN5 — null count and share per attached column after a left join."""
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(c(x).isNull()).alias(f"{x}__nulls") for x in cols])
    row = row.select("*", *[(c(f"{x}__nulls") / c("__n") * 100).alias(f"{x}__null_pct") for x in cols])
    return unpivot_metrics(row, cols, ["nulls", "null_pct"])


def compare_labels(a: DataFrame, b: DataFrame, key: Sequence[str] | str, label_a: str, label_b: str) -> DataFrame:
    """JN2 — old vs new label by key (full outer join): both / only-old / only-new / neither."""
    keys = [key] if isinstance(key, str) else list(key)
    left = a.select(*[c(k) for k in keys], c(label_a).alias("_old"))
    right = b.select(*[c(k) for k in keys], c(label_b).alias("_new"))
    j = left.join(right, keys, "full_outer")
    old = F.coalesce(F.col("_old"), F.lit(0)) == 1
    new = F.coalesce(F.col("_new"), F.lit(0)) == 1
    return j.agg(F.count_if(old).alias("old_total"), F.count_if(new).alias("new_total"),
                 F.count_if(old & new).alias("both"), F.count_if(old & ~new).alias("only_old"),
                 F.count_if(~old & new).alias("only_new"), F.count_if(~old & ~new).alias("neither"))


def treatment_effect(raw: DataFrame, clean: DataFrame, cols: Sequence[str]) -> DataFrame:
    """JN3 — per column raw vs clean min/max/std, joined on the column name."""
    def prof(df, tag):
        row = df.agg(*[a for x in cols for a in (F.min(c(x)).cast("double").alias(f"{x}__min"),
                                                 F.max(c(x)).cast("double").alias(f"{x}__max"),
                                                 F.stddev_samp(c(x)).alias(f"{x}__std"))])
        return unpivot_metrics(row, cols, ["min", "max", "std"]).select(
            "column", *[F.col(m).alias(f"{tag}_{m}") for m in ("min", "max", "std")])

    j = prof(raw, "raw").join(prof(clean, "clean"), "column")
    return j.withColumn("range_change_pct",
                        F.when((F.col("raw_max") - F.col("raw_min")) != 0,
                               ((F.col("clean_max") - F.col("clean_min")) / (F.col("raw_max") - F.col("raw_min")) - 1) * 100))


def combine_importance(a: DataFrame, b: DataFrame, on: str = "feature") -> DataFrame:
    """JN4 — join two importance rankings by feature."""
    return a.join(b, on, "full_outer")
