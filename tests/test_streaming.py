"""Monitors give the same windows on a stream as in batch."""

import os
import shutil
import tempfile

from conftest import SF_MEDIUM, normalise
from stokehold.streaming import monitors as M


def test_batch_equals_stream(spark):
    src = tempfile.mkdtemp(prefix="stokehold-stream-src-")
    shutil.copy(os.path.join(SF_MEDIUM, "events.parquet"), os.path.join(src, "part-0.parquet"))
    batch = spark.read.parquet(src)
    stream = M.file_stream(spark, src, batch.schema, max_files_per_trigger=1)
    ck = tempfile.mkdtemp(prefix="stokehold-stream-ck-")
    got = M.run_to_table(M.sliding_mean(stream, "ts", "value", watermark="3650 days"), "sliding_out", ck,
                         mode="complete").toPandas()
    want = M.sliding_mean(batch, "ts", "value").toPandas()
    assert normalise(got).equals(normalise(want))


def test_labeller_runs_on_a_stream(spark):
    from pyspark.sql import functions as F

    src = tempfile.mkdtemp(prefix="stokehold-stream-src-")
    shutil.copy(os.path.join(SF_MEDIUM, "events.parquet"), os.path.join(src, "part-0.parquet"))
    schema = spark.read.parquet(src).schema
    s = M.file_stream(spark, src, schema).withColumn("shifted", F.col("value") - 250)
    out = M.run_to_table(M.label_and_score(s, ["shifted"]).select("event_id", "anomaly_label"), "label_out",
                         tempfile.mkdtemp(prefix="stokehold-stream-ck-"))
    assert out.count() == 10000


def test_windows_do_not_depend_on_session_time_zone(spark):
    from conftest import SF_MEDIUM as sf
    from stokehold.plans.registry import table

    e = table(spark, sf, "events")
    utc = M.sliding_mean(e, "ts", "value").toPandas()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        other = M.sliding_mean(e, "ts", "value").toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert normalise(utc).equals(normalise(other))


def test_a_saved_model_scores_a_stream_as_in_batch(spark):
    from stokehold.models import iforest as IF

    src, out, ck, saved = (tempfile.mkdtemp(prefix=f"stokehold-stream-{x}-") for x in ("src", "out", "ck", "model"))
    events = spark.read.parquet(os.path.join(SF_MEDIUM, "events.parquet")).selectExpr("event_id", "value", "value - 250 AS shifted")
    IF.fit(events, IF.IsolationForestParams(["value", "shifted"], ["event_id"], n_estimators=15, contamination=0.05)).save(saved)
    model = IF.IsolationForestModel.load(spark, saved)

    def arrive(low, high):
        events.filter(f"event_id % 10 >= {low} and event_id % 10 < {high}").coalesce(1).write.mode("append").parquet(src)
        M.score_stream_to(M.file_stream(spark, src, events.schema, max_files_per_trigger=1), model, ["shifted"], out, ck)

    arrive(0, 4)
    arrive(4, 10)  # a second run goes on from the checkpoint
    want = M.label_and_score(events, ["shifted"], model)
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 2
    assert normalise(got.select(*want.columns).toPandas(), 9).equals(normalise(want.toPandas(), 9))
