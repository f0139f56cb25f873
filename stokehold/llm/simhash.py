"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit for each of 64 positions that more than half
of its shingle hashes set. For radius r, every position gets a non-zero
vector of r+1 bits; each non-zero vector v of r+1 bits gives a mask of the
positions whose vector has odd product with v (2^(r+1)-1 masks). Any r
positions have some v orthogonal to all of their vectors, so two
fingerprints that differ in at most r places agree on every bit of that
mask: each such pair collides in some table, without exception.

Only distinct fingerprints enter the tables (copies meet in an aggregate
first). A bucket of several fingerprints is not searched by pairs: each
member reports the points at distance 0 or 1 (half the radius, 2) that keep the
masked bits, and members with a common point are exactly those within two
bits that differ outside the mask. A point has at most 65 members, however
large the bucket, so links stay linear in the fingerprints.

Null and wordless texts have fingerprint zero, linked like any other. Null ids
are kept and never the smallest of a group unless all are null. Repeated
rows and ties stay as rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, blobs, hot_keys, renamed, salted_join, slices, text_hash
from .graph import components

BITS = 64


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1)-1 masks of the covering family, as 64-bit patterns."""
    top = 1 << (radius + 1)
    vectors = [1 + i % (top - 1) for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") % 2) for v in range(1, top)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, summed in blocks of rows."""
    held = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.ascontiguousarray(hashes[at:at + 4096].astype("<u8")).view(np.uint8).reshape(-1, 8)
        held += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * held > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``row_hash`` (of the text) and ``fp`` (signed 64-bit)."""
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, row_hash bigint, fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                fps = [signed(fingerprint(t, shingle, seed)) if t else 0 for t in blobs(batch, "_text")]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=[id_col, "row_hash", "fp"])

    return docs.select(F.col(id_col), text_hash(text_col).alias("row_hash"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(src, dst) links that connect all distinct fingerprints (column ``fp``) within
    ``radius`` bits of each other; every link is within the radius."""
    if radius != 2:
        raise ValueError("common points are those of radius 2; masks exist for any radius")
    masks = covering_masks(radius)

    def masked(k: int) -> Column:
        return F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(masks[k]))).alias("key"))

    entries = fps.select("fp", F.explode(F.array(*[masked(k) for k in range(len(masks))])).alias("e")).select("fp", "e.mask", "e.key")
    full = entries.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").checkpoint()
    total = full.agg(F.sum("n").alias("t"))
    hot = full.join(F.broadcast(total)).filter("n * 1000 > t").select("mask", "key")  # 1,000 buckets at most
    members = salted_join(entries, full.select("mask", "key"), ["mask", "key"], hot, ["fp"], "inner")
    free = F.element_at(F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << i)) for i in range(BITS) if not m >> i & 1]) for m in masks]), F.col("mask") + 1)
    points = members.select("fp", F.explode(F.transform(free, lambda b: F.col("fp").bitwiseXOR(b))).alias("point")).distinct()
    groups = points.groupBy("point").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)  # 65 members at most
    return groups.select(F.explode("fps").alias("src"), F.array_min("fps").alias("dst")).filter("src != dst").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``row_hash``, ``fp``, and ``component_id``, the smallest
    id in its group; ``first_hash`` is that row's text hash."""
    rows = fingerprints(docs, shingle, seed, id_col, text_col).checkpoint()
    first = F.min(F.struct(F.col(id_col).isNull().alias("x"), F.col(id_col).alias("id"), F.col("row_hash").alias("h")))
    classes = rows.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).checkpoint()
    roots = components(links(classes.select("fp"), radius))
    grouped = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("first").alias("least"))
    of = salted_join(grouped.select("fp", "root"), least, ["root"], hot_keys(grouped, ["root"]), ["fp"], "inner").select("fp", "least")
    total = classes.agg(F.sum("n").alias("t"))
    hot = classes.join(F.broadcast(total)).filter("n * 1000 > t").select("fp")  # 1,000 fingerprints at most
    return salted_join(rows, of, ["fp"], hot, [id_col, "row_hash"], "inner").select(
        id_col, "row_hash", "fp", F.col("least.id").alias("component_id"), F.col("least.h").alias("first_hash"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id, of equal
    ids the smallest text hash, of equal rows one."""
    inner, names = renamed(docs)
    key, text = names[id_col], names[text_col]
    groups = near_duplicates(inner, id_col=key, text_col=text, **options)
    own = F.col(key).eqNullSafe(F.col("component_id")) & (F.col("row_hash") == F.col("first_hash"))
    winners = groups.filter(own).select(F.col(key).alias("_id"), F.col("row_hash").alias("_hash")).distinct()
    same = F.col(key).eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_hash"))
    kept = inner.withColumn("_row", text_hash(text)).join(winners, same, "inner").dropDuplicates(["_id", "_row"])
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
