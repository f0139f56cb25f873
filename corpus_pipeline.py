"""Corpus preparation: quality rules, line dedup, near-duplicates, benchmark
decontamination, packing. Each stage takes (spark, docs, sf_dir), is written as Parquet and
read again as the next one's documents; all but the last keep the columns of ``documents``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stokehold.llm import decontam, linededup, quality, simhash
from stokehold.llm.common import prepare, table
from stokehold.llm.queries import packed, trusted_ids


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, trusted_ids(table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = linededup.drop_repeats(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(out.schema["n_chars"].dataType))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.keep_one(docs, shingle=3, radius=2, seed=42)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"), size=10)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packed(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]

#: Tokenising, fingerprints and the search for a packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each returns is written below the shared
    checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
