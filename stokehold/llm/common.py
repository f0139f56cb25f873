"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stokehold.session import ensure_checkpoint_dir, ship_package

#: A-Z to a-z on UTF-8 bytes; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Bytes of text handled at once by the vectorised Python stages.
SLICE_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder and package for the workers of this session."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(frame: DataFrame) -> DataFrame:
    """``frame`` written below the shared checkpoint folder and read again: lineage
    ends here, and size estimates start anew from the files (a checkpoint keeps the
    estimate of its plan, which joins multiply round after round)."""
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/written-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a record batch with at most ``limit`` bytes of ``column`` each
    (one row at least), so that memory follows bytes instead of rows."""
    sizes = [len(b) if b is not None else 0 for b in blobs(batch, column)]
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def blobs(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A string column as bytes objects."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).to_pylist()


def int_ids(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under column names that no helper uses, and the new name of each: columns
    of the input may have any names."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def text_hash(text: str = "text") -> Column:
    """64-bit hash of the whole text; with the id it names a distinct row."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("\0null")))


def hot_keys(rows: DataFrame, keys: list[str], share: int = 1000, weight: str | None = None) -> DataFrame:
    """Keys holding more than 1/``share`` of all rows. At most ``share`` keys can
    do so, whatever the data: this table may be broadcast."""
    counts = rows.groupBy(*keys).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n")).filter("_n > 1")
    total = rows.agg(F.coalesce(F.sum(weight) if weight else F.count(F.lit(1)), F.lit(0)).alias("_total"))
    return counts.join(F.broadcast(total)).filter(F.col("_n") * share > F.col("_total")).select(*keys)


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, spread: list[str],
                how: str = "left", salts: int = 64) -> DataFrame:
    """Equi-join (null-safe) in which the rows of ``left`` with a hot key are dealt
    over ``salts`` tasks by a hash of ``spread``; the rows of ``right`` with such
    a key are repeated ``salts`` times. ``hot`` has at most 1,000 rows (``hot_keys``)."""
    flag = F.broadcast(hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.lit(True).alias("_hot")))

    def flagged(frame: DataFrame) -> DataFrame:
        return frame.join(flag, [frame[k].eqNullSafe(F.col(f"_h_{k}")) for k in keys], "left").drop(*[f"_h_{k}" for k in keys])

    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    a = flagged(left).withColumn("_salt", salt).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    b = flagged(right).withColumn("_salt", F.explode(every)).drop("_hot")
    b = b.select(*[F.col(c).alias(f"_r_{c}") if c in keys or c == "_salt" else F.col(c) for c in b.columns])
    on = [a[k].eqNullSafe(b[f"_r_{k}"]) for k in keys] + [a["_salt"] == b["_r__salt"]]
    return a.join(b, on, how).drop("_salt", "_r__salt", *[f"_r_{k}" for k in keys])


def count_floor(counts: DataFrame, column: str, limit: int) -> int:
    """Smallest t >= 1 such that at most ``limit`` rows have ``column`` >= t, read
    off a histogram with 32 steps an octave (a few hundred rows)."""
    step = F.floor(F.log2(F.col(column).cast("double")) * 32).cast("int")
    bins = counts.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.max(column).alias("most")).collect()
    held = 0
    for r in sorted(bins, key=lambda r: -r.b):
        if held + r.n > limit:
            return int(r.most) + 1
        held += r.n
    return 1


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``lengths``, end to end."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
