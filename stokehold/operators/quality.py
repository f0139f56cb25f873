"""Profiling, cleaning and labelling of wide timestamped tables.

Every profile is a single ``agg`` over all requested columns (one scan), the
per-column rows are produced by unpivoting that one aggregated row.
Quantiles are exact (linear interpolation, the reference's definition) through
``core.quantile_values``: a bounded-map ``percentile`` for low-cardinality
columns, a distributed sort for the rest; ``exact=False`` uses
``percentile_approx``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import c, numeric_columns, quantile_table, quantile_values, unpivot_metrics

# ---------------------------------------------------------------------------
# projections (PRJ*)
# ---------------------------------------------------------------------------

_NON_WORD = re.compile(r"[^\w\s]")
_SPACES = re.compile(r"\s+")


def normalize_name(name: str) -> str:
    """strip, drop characters that are neither word nor space (Unicode letters
    such as the Greek delta stay), whitespace runs become ``_``."""
    return _SPACES.sub("_", _NON_WORD.sub("", str(name).strip()))


def normalize_columns(df: DataFrame) -> DataFrame:
    """PRJ1 — metadata only, no data is touched."""
    return df.toDF(*[normalize_name(x) for x in df.columns])


TIME_HINTS = ("time", "date", "timestamp")


def detect_time_column(df: DataFrame, order_tiebreak: Sequence[str] = ()) -> tuple[DataFrame, str | None]:
    """PRJ2 — first column whose name contains time/date/timestamp, parsed
    (unparseable → null) and used as the sort key."""
    hits = [x for x in df.columns if any(h in x.lower() for h in TIME_HINTS)]
    if not hits:
        return df, None
    tcol = hits[0]
    dtype = df.schema[tcol].dataType.typeName()
    if dtype not in ("timestamp", "timestamp_ntz", "date"):
        df = df.withColumn(tcol, F.try_to_timestamp(c(tcol).cast("string")))
    return df.orderBy(c(tcol), *[c(x) for x in order_tiebreak]), tcol


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Numeric columns with ``nunique(dropna=False) <= 1`` (null counts as a value)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if not cols:
        return []
    row = df.agg(*[
        # one value (or none) when least and greatest agree; a null beside a value counts as another
        (F.coalesce(F.min(c(x)).eqNullSafe(F.max(c(x))), F.lit(True)) & ((F.count(c(x)) == 0) | (F.count(c(x)) == F.count(F.lit(1))))).alias(x) for x in cols
    ]).first()
    return [x for x in cols if row[x]]


def drop_constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ3 — one aggregate pass, then a projection."""
    return df.drop(*constant_columns(df, cols))


def drop_by_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """PRJ5."""
    return df.drop(*[x for x in df.columns if x.endswith(suffix)])


def suffix_columns(df: DataFrame, cols: Sequence[str], suffix: str) -> DataFrame:
    """PRJ6 — rename ``cols`` to ``col + suffix``."""
    return df.withColumnsRenamed({x: x + suffix for x in cols})


def drop_leaky(df: DataFrame, leaky: Sequence[str]) -> DataFrame:
    """PRJ7 — remove leaky columns that exist."""
    return df.drop(*[x for x in leaky if x in df.columns])


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """PRJ8 — nulls to 0 on the feature columns, then one vector column."""
    from pyspark.ml.feature import VectorAssembler

    filled = df.na.fill(0, subset=list(features))
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep").transform(filled)


# ---------------------------------------------------------------------------
# row predicates (FLT*)
# ---------------------------------------------------------------------------

def negative_flag(col: str) -> Column:
    """``col < 0`` with NULL/NaN treated as not negative."""
    return F.coalesce((c(col) < 0) & ~F.isnan(c(col)), F.lit(False))


def label_negative(df: DataFrame, cols: Sequence[str], label: str = "Anomaly_Label") -> DataFrame:
    """FLT2 — 1 when any source column is negative."""
    return df.withColumn(label, reduce(lambda a, b: a | b, [negative_flag(x) for x in cols]).cast("int"))


def source_overlap(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT3 — histogram of the number of firing sources per row."""
    n = reduce(lambda a, b: a + b, [negative_flag(x).cast("int") for x in cols])
    return df.groupBy(n.alias("n_sources")).agg(F.count(F.lit(1)).alias("rows"))


def any_source_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT4 — rows where at least one source fires."""
    anyf = reduce(lambda a, b: a | b, [negative_flag(x) for x in cols])
    return df.agg(F.count_if(anyf).alias("any_source_rows"), F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------------------
# profiles (AG*)
# ---------------------------------------------------------------------------

def _pct(col: Column, probs, exact: bool) -> Column:
    return F.percentile(col, probs) if exact else F.percentile_approx(col, probs, 10000)


QUARTILES = (0.25, 0.5, 0.75)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs=QUARTILES, exact: bool = True) -> dict:
    """{(column, p): value}: exact via ``quantile_values`` (no single-task value
    map for high-cardinality columns), or ``percentile_approx`` when not exact."""
    if exact:
        return quantile_values(df, cols, probs)
    row = df.agg(*[F.percentile_approx(c(x), list(probs), 10000).alias(x) for x in cols]).first()
    return {(x, float(p)): (row[x][i] if row[x] else None) for x in cols for i, p in enumerate(probs)}


def _quartile_fields(q: dict, cols: Sequence[str], names=("q25", "q50", "q75"), probs=QUARTILES) -> list[Column]:
    return [F.lit(q[(x, float(p))]).cast("double").alias(f"{x}__{n}") for x in cols for n, p in zip(names, probs)]


def validation_stats(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """AG1 — describe() plus missing, missing %, negatives and zeros per column."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for x in cols:
        aggs += [
            F.count(c(x)).alias(f"{x}__count"), F.avg(c(x)).alias(f"{x}__mean"),
            F.stddev_samp(c(x)).alias(f"{x}__std"), F.min(c(x)).cast("double").alias(f"{x}__min"),
            F.max(c(x)).cast("double").alias(f"{x}__max"),
            F.count_if(c(x).isNull()).alias(f"{x}__missing"),
            F.count_if(c(x) < 0).alias(f"{x}__negative_count"), F.count_if(c(x) == 0).alias(f"{x}__zero_count"),
        ]
    row = df.agg(*aggs)
    q = column_quantiles(df, cols, exact=exact)
    row = row.select("*", *_quartile_fields(q, cols),
                     *[(c(f"{x}__missing") / c("__n") * 100).alias(f"{x}__missing_pct") for x in cols])
    metrics = ["count", "mean", "std", "min", "q25", "q50", "q75", "max", "missing", "missing_pct",
               "negative_count", "zero_count"]
    return unpivot_metrics(row, cols, metrics, types={"count": "long", "missing": "long",
                                                     "negative_count": "long", "zero_count": "long"})


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AG2 — only columns with nulls, with count and percentage."""
    cols = list(cols) if cols is not None else df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(c(x).isNull()).alias(f"{x}__missing_count") for x in cols])
    row = row.select("*", *[(c(f"{x}__missing_count") / c("__n") * 100).alias(f"{x}__missing_pct") for x in cols])
    out = unpivot_metrics(row, cols, ["missing_count", "missing_pct"])
    return out.filter(F.col("missing_count") > 0)


def data_dictionary(df: DataFrame, cols: Sequence[str] | None = None, exact_distinct: bool = True) -> DataFrame:
    """AG3 — dtype, non-null, null, unique, min, max, mean, std per column."""
    cols = list(cols) if cols is not None else df.columns
    numeric = set(numeric_columns(df))
    aggs = []
    for x in cols:
        aggs += [F.count(c(x)).alias(f"{x}__non_null"), F.count_if(c(x).isNull()).alias(f"{x}__null_count")]
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(c(x)).alias(f"{x}__unique"))
        if x in numeric:
            aggs += [F.min(c(x)).cast("double").alias(f"{x}__min"), F.max(c(x)).cast("double").alias(f"{x}__max"),
                     F.avg(c(x)).alias(f"{x}__mean"), F.stddev_samp(c(x)).alias(f"{x}__std")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"{x}__{m}") for m in ("min", "max", "mean", "std")]
    row = df.agg(*aggs)
    if exact_distinct:
        # one narrow aggregate a column: several distinct counts in one would repeat each row for each column
        for x in cols:
            row = row.crossJoin(F.broadcast(df.agg(F.count_distinct(c(x)).alias(f"{x}__unique"))))  # one row
    row = row.select("*", *[F.lit(df.schema[x].dataType.simpleString()).alias(f"{x}__dtype") for x in cols])
    return unpivot_metrics(row, cols, ["dtype", "non_null", "null_count", "unique", "min", "max", "mean", "std"],
                           types={"unique": "long"})


def quality_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """AG4 — (metric, before, after) for shape, missing cells, column kinds and duplicate rows."""

    def profile(df: DataFrame) -> Column:
        numeric = numeric_columns(df)
        missing = reduce(lambda a, b: a + b, [F.count_if(c(x).isNull()) for x in df.columns])
        distinct_rows = df.distinct().agg(F.count(F.lit(1)).alias("d"))
        base = df.agg(F.count(F.lit(1)).alias("rows"), missing.alias("missing_cells"))
        return (base.crossJoin(distinct_rows)  # two one-row frames
                .select(F.col("rows").cast("double").alias("rows"), F.lit(float(len(df.columns))).alias("columns"),
                        F.col("missing_cells").cast("double").alias("missing_cells"),
                        F.lit(float(len(numeric))).alias("numeric_columns"),
                        F.lit(float(len(df.columns) - len(numeric))).alias("non_numeric_columns"),
                        (F.col("rows") - F.col("d")).cast("double").alias("duplicate_rows")))

    metrics = ["rows", "columns", "missing_cells", "numeric_columns", "non_numeric_columns", "duplicate_rows"]
    b = profile(before).select([F.col(m).alias(f"{m}__before") for m in metrics])
    a = profile(after).select([F.col(m).alias(f"{m}__after") for m in metrics])
    return unpivot_metrics(b.crossJoin(a), metrics, ["before", "after"], key="metric")


def overview(df: DataFrame, ts: str, label: str) -> DataFrame:
    """AG5 — one row: rows, columns, duplicate rows, time range, anomaly count and rate."""
    dups = df.groupBy(*[c(x) for x in df.columns]).agg(F.count(F.lit(1)).alias("k")) \
        .agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))
    base = df.agg(F.count(F.lit(1)).alias("rows"), F.min(c(ts)).alias("start"), F.max(c(ts)).alias("end"),
                  F.sum(c(label)).cast("long").alias("anomaly_count"), F.avg(c(label)).alias("anomaly_rate"))
    return base.crossJoin(dups).select("rows", F.lit(len(df.columns)).alias("columns"), "duplicate_rows",
                                       "start", "end", "anomaly_count", (F.col("anomaly_rate") * 100).alias("anomaly_pct"))


def bias_corrected_skew(x: Column) -> Column:
    """pandas ``skew``: G1 = g1·√(n(n−1))/(n−2), from Spark's population g1."""
    n = F.count(x)
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def bias_corrected_kurtosis(x: Column) -> Column:
    """pandas ``kurtosis``: G2 = (n−1)/((n−2)(n−3))·((n+1)g2+6)."""
    n = F.count(x)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def univariate_stats(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """AG6 — describe + bias-corrected skewness/kurtosis + cv = |std/mean|."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for x in cols:
        aggs += [F.count(c(x)).alias(f"{x}__count"), F.avg(c(x)).alias(f"{x}__mean"), F.stddev_samp(c(x)).alias(f"{x}__std"),
                 F.min(c(x)).cast("double").alias(f"{x}__min"),
                 F.max(c(x)).cast("double").alias(f"{x}__max"), bias_corrected_skew(c(x)).alias(f"{x}__skewness"),
                 bias_corrected_kurtosis(c(x)).alias(f"{x}__kurtosis")]
    row = df.agg(*aggs)
    q = column_quantiles(df, cols, exact=exact)
    row = row.select("*", *_quartile_fields(q, cols),
                     *[F.abs(c(f"{x}__std") / c(f"{x}__mean")).alias(f"{x}__cv") for x in cols])
    return unpivot_metrics(row, cols, ["count", "mean", "std", "min", "q25", "q50", "q75", "max", "skewness", "kurtosis", "cv"],
                           types={"count": "long"})


NEGATIVE_BANDS = (  # fixed values: share of negative rows (percent) → category
    (99.0, "BY_DESIGN (always negative)"),
    (10.0, "HIGH_NEGATIVE (investigate)"),
    (1.0, "MODERATE_NEGATIVE (likely anomaly)"),
    (None, "RARE_NEGATIVE (sensor anomaly)"),
)


def classify_negatives(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AG7 — columns with negative values, their share and band."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for x in cols:
        aggs += [F.count_if(c(x) < 0).alias(f"{x}__negative_count"), F.min(c(x)).cast("double").alias(f"{x}__min"),
                 F.max(c(x)).cast("double").alias(f"{x}__max"), F.avg(c(x)).alias(f"{x}__mean")]
    row = df.agg(*aggs)
    row = row.select("*", *[(c(f"{x}__negative_count") / c("__n") * 100).alias(f"{x}__negative_pct") for x in cols])
    out = unpivot_metrics(row, cols, ["negative_count", "negative_pct", "min", "max", "mean"]).filter("negative_count > 0")
    band = None
    for thr, name in NEGATIVE_BANDS:
        if thr is None:
            band = band.otherwise(F.lit(name))
        else:
            cond = F.col("negative_pct") > thr
            band = F.when(cond, F.lit(name)) if band is None else band.when(cond, F.lit(name))
    return out.withColumn("category", band)


def column_catalog(df: DataFrame, ts: str | None = None, smooth_suffix: str = "_smooth3") -> DataFrame:
    """AG8 — position, dtype, numeric/categorical/smooth/timestamp flags (built from the schema)."""
    from .features import categorical_columns

    spark, numeric, categorical = df.sparkSession, set(numeric_columns(df)), set(categorical_columns(df))
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.name in numeric, f.name in categorical, f.name.endswith(smooth_suffix), f.name == ts)
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, dtype string, is_numeric boolean, is_categorical boolean, "
                                       "is_smooth boolean, is_timestamp boolean")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """AG9 — per-class count and share, with the max/min imbalance ratio."""
    counts = df.groupBy(c(label).alias("class")).agg(F.count(F.lit(1)).alias("count"))
    tot = counts.agg(F.sum("count").alias("total"), F.max("count").alias("mx"), F.min("count").alias("mn"))
    return counts.crossJoin(F.broadcast(tot)).select(
        "class", "count", (F.col("count") / F.col("total") * 100).alias("pct"),
        (F.col("mx") / F.col("mn")).alias("imbalance_ratio"))


def temporal_profile(df: DataFrame, ts: str, value: str) -> DataFrame:
    """AG10 — mean of ``value`` by hour of day and by weekday (Monday = 0)."""
    by_hour = df.groupBy(F.lit("hour").alias("part"), F.hour(c(ts)).alias("bucket")).agg(F.avg(c(value)).alias("mean"),
                                                                                   F.count(c(value)).alias("n"))
    by_dow = df.groupBy(F.lit("weekday").alias("part"), F.weekday(c(ts)).alias("bucket")).agg(F.avg(c(value)).alias("mean"),
                                                                                     F.count(c(value)).alias("n"))
    return by_hour.unionByName(by_dow)


def anomaly_rate_by(df: DataFrame, part: Column, label: str, name: str = "bucket") -> DataFrame:
    """AG11 — sum, count and mean of the label per time part."""
    return df.groupBy(part.alias(name)).agg(F.sum(c(label)).cast("long").alias("anomalies"),
                                            F.count(F.lit(1)).alias("rows"),
                                            F.avg(c(label)).alias("anomaly_rate"))


def compare_groups(df: DataFrame, label: str, cols: Sequence[str] | None = None) -> DataFrame:
    """AG12 — per column mean for label 0 / 1, difference and |diff / normal| %."""
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=[label])
    aggs = []
    for x in cols:
        aggs += [F.avg(F.when(c(label) == 0, c(x))).alias(f"{x}__normal_mean"),
                 F.avg(F.when(c(label) == 1, c(x))).alias(f"{x}__anomaly_mean")]
    row = df.agg(*aggs)
    out = unpivot_metrics(row, cols, ["normal_mean", "anomaly_mean"])
    return out.withColumn("difference", F.col("anomaly_mean") - F.col("normal_mean")) \
        .withColumn("diff_pct", F.abs(F.col("difference") / F.col("normal_mean")) * 100)


def source_breakdown(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG13 — per source column: negative and positive counts and percentages."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for x in cols:
        aggs += [F.count_if(negative_flag(x)).alias(f"{x}__negative_count"), F.count_if(c(x) > 0).alias(f"{x}__positive_count")]
    row = df.agg(*aggs)
    row = row.select("*", *[(c(f"{x}__negative_count") / c("__n") * 100).alias(f"{x}__negative_pct") for x in cols],
                     *[(c(f"{x}__positive_count") / c("__n") * 100).alias(f"{x}__positive_pct") for x in cols])
    return unpivot_metrics(row, cols, ["negative_count", "negative_pct", "positive_count", "positive_pct"], key="source")


def range_overlap(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """AG14 — per column min/max by class and the width of the overlapping range."""
    aggs = []
    for x in cols:
        for k, v in (("normal", 0), ("anomaly", 1)):
            aggs += [F.min(F.when(c(label) == v, c(x))).cast("double").alias(f"{x}__{k}_min"),
                     F.max(F.when(c(label) == v, c(x))).cast("double").alias(f"{x}__{k}_max")]
    out = unpivot_metrics(df.agg(*aggs), cols, ["normal_min", "normal_max", "anomaly_min", "anomaly_max"])
    lo = F.greatest("normal_min", "anomaly_min")
    hi = F.least("normal_max", "anomaly_max")
    return out.withColumn("overlap", F.greatest(hi - lo, F.lit(0.0))) \
        .withColumn("has_overlap", hi >= lo)


def label_leakage(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """AG15 — can the label be derived from a column? correlation and the
    precision/recall of the rule ``col < 0`` against the label."""
    aggs = []
    for x in cols:
        neg = negative_flag(x)
        aggs += [F.corr(c(x), c(label).cast("double")).alias(f"{x}__corr"),
                 F.count_if(neg & (c(label) == 1)).alias(f"{x}__tp"), F.count_if(neg).alias(f"{x}__flagged"),
                 F.count_if(c(label) == 1).alias(f"{x}__positives")]
    out = unpivot_metrics(df.agg(*aggs), cols, ["corr", "tp", "flagged", "positives"], key="source")
    return out.select("source", "corr",
                      F.when(F.col("flagged") > 0, F.col("tp") / F.col("flagged")).otherwise(0.0).alias("precision"),
                      F.when(F.col("positives") > 0, F.col("tp") / F.col("positives")).otherwise(0.0).alias("recall"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """AG16 — contingency table in long form (a, b, count).

    The long form keeps the schema independent of the data; ``.groupBy(a)
    .pivot(b)`` turns it wide when the b-levels are known.
    """
    return df.groupBy(c(a).alias(a), c(b).alias(b)).agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """AG17 — equal-width bins between min and max (last bin closed), the data behind a plot."""
    rng = df.agg(F.min(c(col)).cast("double").alias("lo"), F.max(c(col)).cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.floor((c(col) - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    j = df.select(c(col)).filter(c(col).isNotNull()).crossJoin(F.broadcast(rng))  # one-row frame
    return j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"),
                                         F.min("lo").alias("lo"), F.min("hi").alias("hi")) \
        .select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("left"),
                (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("right"), "count")


def box_stats(df: DataFrame, col: str, by: str | None = None, exact: bool = True) -> DataFrame:
    """AG18 — min, q1, median, q3, max (and whisker fences) per group; grouped
    quantiles come from the distributed ``quantile_table`` (a hot group is not one task's map)."""
    g = df.groupBy(c(by).alias(by)) if by else df.groupBy()
    out = g.agg(F.min(c(col)).cast("double").alias("min"), F.max(c(col)).cast("double").alias("max"),
                F.count(c(col)).alias("n"))
    if by:
        qt = quantile_table(df, [col], QUARTILES, by=[by]) if exact else \
            df.groupBy(c(by).alias(by)).agg(F.percentile_approx(c(col), list(QUARTILES), 10000).alias("_q")) \
            .select(by, F.inline(F.arrays_zip(F.array(*[F.lit(p) for p in QUARTILES]).alias("prob"), F.col("_q").alias("value"))))
        piv = qt.groupBy(by).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                   for n, p in zip(("q1", "median", "q3"), QUARTILES)])
        out = out.join(piv, by)
    else:
        q = column_quantiles(df, [col], exact=exact)
        out = out.select("*", *[F.lit(q[(col, p)]).cast("double").alias(n) for n, p in zip(("q1", "median", "q3"), QUARTILES)])
    iqr = F.col("q3") - F.col("q1")
    return out.select(*([by] if by else []), "n", "min", "q1", "median", "q3", "max",
                      (F.col("q1") - 1.5 * iqr).alias("lower_fence"), (F.col("q3") + 1.5 * iqr).alias("upper_fence"))


def search_effects(results: DataFrame, by: Sequence[str], metric: str) -> DataFrame:
    """AG19 — mean metric per configuration group, best first."""
    return results.groupBy(*[c(x) for x in by]).agg(F.avg(c(metric)).alias(f"mean_{metric}"),
                                                     F.count(F.lit(1)).alias("runs")) \
        .orderBy(F.desc(f"mean_{metric}"), *by)


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """AG20 — rows, distinct rows and duplicates (pre-aggregated per row key)."""
    keys = [c(x) for x in (subset or df.columns)]
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"))
    return per.agg(F.sum("k").cast("long").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"),
                   (F.sum("k") - F.count(F.lit(1))).cast("long").alias("duplicate_rows"))


# ---------------------------------------------------------------------------
# cleaning (CL*)
# ---------------------------------------------------------------------------

def outlier_bounds(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Pass 1: quartiles, IQR fences, mean, population std, median, count per column (one row)."""
    row = df.agg(*[a for x in cols for a in (F.avg(c(x)).alias(f"{x}__mean"), F.stddev_pop(c(x)).alias(f"{x}__std_pop"),
                                             F.count(c(x)).alias(f"{x}__n"))])
    q = column_quantiles(df, cols, exact=exact)
    extra = []
    for x in cols:
        q1, med, q3 = (q[(x, p)] for p in QUARTILES)
        lower = None if q1 is None else q1 - 1.5 * (q3 - q1)
        upper = None if q3 is None else q3 + 1.5 * (q3 - q1)
        extra += [F.lit(v).cast("double").alias(f"{x}__{n}") for n, v in
                  (("q1", q1), ("median", med), ("q3", q3), ("lower", lower), ("upper", upper))]
    return row.select("*", *extra)


def detect_outliers(df: DataFrame, cols: Sequence[str] | None = None, min_rows: int = 10, exact: bool = True) -> DataFrame:
    """CL2 — IQR (1.5), z-score (|z|>3, population std) and MAD (|0.6745(x−med)/MAD|>3.5,
    0 when MAD = 0) outlier counts; columns with fewer than ``min_rows`` values skipped.

    Three passes: quantiles/moments, MAD (needs the medians), counts."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    b = outlier_bounds(df, cols, exact)
    med = b.select(*[c(f"{x}__median") for x in cols]).first()
    dev = df.select(*[F.abs(c(x) - F.lit(med[f"{x}__median"])).alias(x) for x in cols])
    mad = column_quantiles(dev, cols, (0.5,), exact=exact)
    bounds = b.select("*", *[F.lit(mad[(x, 0.5)]).cast("double").alias(f"{x}__mad") for x in cols])
    counted = df.crossJoin(F.broadcast(bounds))  # one-row frame of thresholds
    aggs = []
    for x in cols:
        z = F.abs((c(x) - c(f"{x}__mean")) / c(f"{x}__std_pop"))
        mz = F.abs(F.lit(0.6745) * (c(x) - c(f"{x}__median")) / c(f"{x}__mad"))
        aggs += [F.count_if((c(x) < c(f"{x}__lower")) | (c(x) > c(f"{x}__upper"))).alias(f"{x}__iqr_outliers"),
                 F.count_if(z > 3).alias(f"{x}__zscore_outliers"),
                 F.count_if((c(f"{x}__mad") > 0) & (mz > 3.5)).alias(f"{x}__mad_outliers"),
                 F.first(c(f"{x}__n")).alias(f"{x}__total")]
    row = counted.agg(*aggs)
    row = row.select("*", *[F.round(c(f"{x}__iqr_outliers") / c(f"{x}__total") * 100, 3).alias(f"{x}__iqr_pct") for x in cols])
    out = unpivot_metrics(row, cols, ["iqr_outliers", "zscore_outliers", "mad_outliers", "total", "iqr_pct"])
    return out.filter(F.col("total") >= min_rows)


def winsorize(df: DataFrame, cols: Sequence[str] | None = None, max_share: float = 0.05, min_rows: int = 10,
              exact: bool = True, materialize: bool = False) -> DataFrame:
    """CL3 — clip to the IQR fences, only for columns with 0 < outlier share < ``max_share``.

    The fences take several statistics passes; with ``materialize`` the numeric
    projection is checkpointed once, so an expensive input (joins, UDFs) is not
    recomputed for every pass. The clipped result is still built from ``df``."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    stats_in = df
    if materialize:
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        stats_in = df.select(*[c(x) for x in cols]).checkpoint(eager=True)
    b = outlier_bounds(stats_in, cols, exact)
    shares = stats_in.crossJoin(F.broadcast(b.select(*[c(f"{x}__{k}") for x in cols for k in ("lower", "upper")]))).agg(
        *[F.count_if((c(x) < c(f"{x}__lower")) | (c(x) > c(f"{x}__upper"))).alias(f"{x}__out") for x in cols])
    params = b.crossJoin(shares).first()  # one row of thresholds
    out = df
    for x in cols:
        n = params[f"{x}__n"]
        if n is None or n < min_rows:
            continue
        share = params[f"{x}__out"] / n
        if 0 < share < max_share:
            lo, hi = params[f"{x}__lower"], params[f"{x}__upper"]
            out = out.withColumn(x, F.when(c(x).isNull(), c(x)).otherwise(F.greatest(F.least(c(x), F.lit(hi)), F.lit(lo))))
    return out


def impute(df: DataFrame, order: Sequence[str], cols: Sequence[str] | None = None, drop_over: float = 50.0,
           interpolate_over: float = 5.0) -> DataFrame:
    """CL1 — > ``drop_over`` % missing: drop; numeric > ``interpolate_over`` %: linear
    interpolation by position (ends take the nearest value); numeric otherwise: median;
    other types: mode (smallest among ties)."""
    from .timeseries import interpolate_linear

    cols = list(cols) if cols is not None else df.columns
    numeric = set(numeric_columns(df))
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(c(x).isNull()).alias(x) for x in cols]).first()
    n = row["__n"] or 1
    pct = {x: row[x] / n * 100 for x in cols if row[x] > 0}
    drop = [x for x, p in pct.items() if p > drop_over]
    interp = [x for x, p in pct.items() if p <= drop_over and x in numeric and p > interpolate_over]
    median = [x for x, p in pct.items() if p <= drop_over and x in numeric and p <= interpolate_over]
    mode = [x for x, p in pct.items() if p <= drop_over and x not in numeric]
    out = df.drop(*drop)
    fills: dict = {}
    if median:
        q = column_quantiles(out, median, (0.5,))
        fills.update({x: q[(x, 0.5)] for x in median if q[(x, 0.5)] is not None})
    for x in mode:  # counts of the values, combined map-side: no task holds them all
        top = out.filter(c(x).isNotNull()).groupBy(c(x)).agg(F.count(F.lit(1)).alias("__cnt")).orderBy(F.desc("__cnt"), c(x)).first()
        if top is not None:
            fills[x] = top[x]
    if fills:
        out = out.withColumns({x: F.coalesce(c(x), F.lit(v)) for x, v in fills.items()})
    return interpolate_linear(out, interp, order) if interp else out


def column_diff(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """SO3 — column-set arithmetic between two frames (metadata only):
    common names, names only in ``a`` / only in ``b``, and duplicated names."""
    ca, cb = list(a.columns), list(b.columns)
    dup = sorted({x for x in ca + cb if ca.count(x) > 1 or cb.count(x) > 1})
    return {"common": [x for x in ca if x in cb], "only_a": [x for x in ca if x not in cb],
            "only_b": [x for x in cb if x not in ca], "duplicated": dup}
