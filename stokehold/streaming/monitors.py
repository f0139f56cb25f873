"""Structured Streaming monitors (STR1–STR4).

Each monitor is one function over a DataFrame that is either a batch or a
streaming frame: the same plan runs in both modes (watermarks are ignored in
batch), which is how the stream results are checked against the batch/SQL
results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import label_negative


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _event_time(df: DataFrame, ts: str) -> tuple[DataFrame, bool]:
    """Watermarks need TIMESTAMP: a TIMESTAMP_NTZ event time becomes the
    instant whose UTC wall time it is (micros since the epoch, independent of
    the session time zone), and the window bounds are turned back the same way."""
    ntz = df.schema[ts].dataType.typeName() == "timestamp_ntz"
    if not ntz:
        return df, False
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), F.col(ts))
    return df.withColumn(ts, F.timestamp_micros(micros)), True


def _bound(col, ntz: bool):
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), F.expr(_EPOCH_NTZ)) if ntz else col


def _flat_window(df: DataFrame, ntz: bool = False) -> DataFrame:
    return df.select(_bound(F.col("window.start"), ntz).alias("window_start"),
                     _bound(F.col("window.end"), ntz).alias("window_end"),
                     *[c for c in df.columns if c != "window"])


def label_and_score(df: DataFrame, sources: Sequence[str], model=None, label: str = "anomaly_label") -> DataFrame:
    """STR1 — label arriving readings from their negative sources and, given a
    fitted model, add its score and prediction (Arrow pandas UDF, stream-safe)."""
    out = label_negative(df, sources, label=label)
    return model.transform(out) if model is not None else out


def score_stream_to(stream: DataFrame, model, sources: Sequence[str], path: str, checkpoint: str, label: str = "anomaly_label") -> None:
    """STR1 — labels and scores a stream with a fitted (or loaded) model and appends the
    rows below ``path``, one folder a micro-batch. A batch that is repeated after a failure overwrites its own
    folder, and ``checkpoint`` holds the progress, so each row is written once. Takes what is there and returns."""
    def write(batch: DataFrame, number: int) -> None:
        label_and_score(batch, sources, model, label).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def anomaly_rate_windows(df: DataFrame, ts: str, label: str, window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """STR2 — tumbling-window anomaly count/rate; late rows beyond the watermark are dropped in streaming."""
    df, ntz = _event_time(df, ts)
    return _flat_window(df.withWatermark(ts, watermark).groupBy(F.window(ts, window)).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label)).cast("long").alias("anomalies"),
        F.avg(F.col(label)).alias("anomaly_rate")), ntz)


def weekly_quality(df: DataFrame, ts: str, label: str, pred: str, watermark: str = "1 day") -> DataFrame:
    """STR3 — weekly confusion counts and F1/precision/recall from joined labels."""
    df, ntz = _event_time(df, ts)
    agg = df.withWatermark(ts, watermark).groupBy(F.window(ts, "7 days")).agg(
        F.count_if((F.col(label) == 1) & (F.col(pred) == 1)).alias("tp"),
        F.count_if((F.col(label) == 0) & (F.col(pred) == 1)).alias("fp"),
        F.count_if((F.col(label) == 1) & (F.col(pred) == 0)).alias("fn"),
        F.count(F.lit(1)).alias("rows"))
    tp, fp, fn = (F.col(x).cast("double") for x in ("tp", "fp", "fn"))
    out = agg.select("*", F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
                     F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("recall"),
                     F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0).alias("f1"))
    return _flat_window(out, ntz)


def sliding_mean(df: DataFrame, ts: str, value: str, length: str = "30 minutes", slide: str = "10 minutes",
                 watermark: str = "1 hour") -> DataFrame:
    """STR4 — trailing sliding-window mean (the streaming stand-in for the centred smoother)."""
    df, ntz = _event_time(df, ts)
    return _flat_window(df.withWatermark(ts, watermark).groupBy(F.window(ts, length, slide)).agg(
        F.count(F.col(value)).alias("n"), F.avg(F.col(value)).alias("mean")), ntz)


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file source stream (new files in ``path`` become micro-batches)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Drive a stream to completion into a memory table (tests / smoke runs);
    production jobs use a durable sink with the same ``checkpointLocation``."""
    q = (stream.writeStream.outputMode(mode).format("memory").queryName(name)
         .option("checkpointLocation", checkpoint).start())
    q.processAllAvailable()
    q.stop()
    return stream.sparkSession.table(name)
