"""State from a stream of events, whatever the batches."""

from pyspark.sql import functions as F

from veilwright.session import scratch_path
from veilwright.streaming.changes import StateTable, run_available


def test_stream_equals_batch_and_replay_changes_nothing(spark):
    df = spark.range(500).select((F.col("id") % 17).alias("k"), F.col("id").alias("seq"), (F.col("id") * 3).alias("v"))
    base = scratch_path(spark, "stream")
    df.repartition(6).write.parquet(f"{base}/in")
    t = StateTable(spark, f"{base}/state", "k", ["v"], ["seq"])
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
    run_available(stream, t, f"{base}/progress")
    want = {(r["k"], r["v"]) for r in df.groupBy("k").agg(F.max_by("v", "seq").alias("v")).collect()}
    got = {(r["k"], r["v"]) for r in t.read().collect()}
    assert got == want
    t.merge(df, 999)  # all events again
    assert {(r["k"], r["v"]) for r in t.read().collect()} == want


def test_empty_state(spark):
    t = StateTable(spark, scratch_path(spark, "stream"), "k", ["v"], ["seq"])
    assert t.read() is None
    t.merge(spark.createDataFrame([], "k bigint, seq bigint, v bigint"), 0)
    assert t.read().count() == 0
