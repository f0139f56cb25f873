"""Sources and sinks (SRC*, SNK*): thin, explicit wrappers over Spark's readers and writers."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.core import c


class MissingInput(FileNotFoundError):
    pass


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) or bool(fs.globStatus(p))


def read_readings(spark: SparkSession, path: str, fmt: str = "csv", schema: StructType | str | None = None,
                  infer: bool = True, missing_ok: bool = False) -> DataFrame | None:
    """SRC1/SRC2 — header CSV (types inferred unless a schema is given) or any
    other Spark format; a missing input returns None when ``missing_ok``."""
    if not _exists(spark, path):
        if missing_ok:
            return None
        raise MissingInput(path)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", infer)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def stage_path(root: str, name: str) -> str:
    return os.path.join(root, name)


def write_stage(df: DataFrame, root: str, name: str, partition_by: Sequence[str] = ()) -> str:
    """SNK1 — write a stage result as Parquet (overwrite)."""
    path = stage_path(root, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_stage(spark: SparkSession, root: str, name: str) -> DataFrame:
    """SRC3 — read an earlier stage's result."""
    return spark.read.parquet(stage_path(root, name))


def write_splits(df: DataFrame, root: str, name: str = "splits", split_col: str = "split",
                 features: Sequence[str] | None = None) -> str:
    """SNK2 — the split table partitioned by split (so each split is a pruned
    scan) plus the feature list."""
    path = write_stage(df, root, name, [split_col])
    if features is not None:
        spark = df.sparkSession
        spark.createDataFrame([(f,) for f in features], "feature string").coalesce(1).write.mode("overwrite") \
            .parquet(stage_path(root, name + "_features"))
    return path


def read_feature_list(spark: SparkSession, path: str, column: str = "feature") -> list[str]:
    """SRC4 — the feature list (a tiny table) as a Python list."""
    return [r[0] for r in spark.read.parquet(path).select(column).collect()]


#: Rows up to which a report is one file.
REPORT_ROWS = 100_000


def write_report(df: DataFrame, root: str, name: str) -> str:
    """SNK3 — a metric table as header CSV: one file while its rows, counted, are a
    report's (``REPORT_ROWS``), else one a partition."""
    path = stage_path(root, name)
    small = df.limit(REPORT_ROWS + 1).count() <= REPORT_ROWS
    (df.coalesce(1) if small else df).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json_report(df: DataFrame, root: str, name: str) -> str:
    """SNK4 — nested records as JSON lines."""
    path = stage_path(root, name)
    df.write.mode("overwrite").json(path)
    return path


def file_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """SNK6 — SHA-256 of every file under ``path`` (binaryFile source)."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """SNK6 (re-aimed to any dataset) — order-independent content hash:
    the sum of per-row xxhash64 (mod 2^64) and the row count, one aggregate."""
    h = F.xxhash64(*[c(x) for x in df.columns]).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.pmod(F.sum(h), F.lit(str(2 ** 64)).cast("decimal(20,0)")).cast("string").alias("fingerprint"))


def dataset_version(df: DataFrame, name: str, version: str) -> DataFrame:
    """SNK7 — one-row version/annotation record: name, version, shape, fingerprint, time."""
    fp = dataset_fingerprint(df)
    return fp.select(F.lit(name).alias("dataset"), F.lit(version).alias("version"), "rows",
                     F.lit(len(df.columns)).alias("columns"), "fingerprint", F.current_timestamp().alias("created_at"))
