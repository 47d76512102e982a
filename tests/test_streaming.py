import os

import pytest
from pyspark.sql import functions as F

from millrace.streaming import events

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.read.parquet(f"{FOLDER}/events.parquet").orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 400).parquet(path)
    return path


def test_a_stream_counts_as_a_batch_does(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    events.into(events.counts(events.stream(spark, folder)), out, str(tmp_path / "check")).awaitTermination()
    got = {(r.day, r.event_type): r.n for r in spark.read.parquet(out).collect()}
    want = {(r.day, r.event_type): r.n for r in events.counts(spark.read.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))).collect()}
    assert got and all(want[k] == v for k, v in got.items())
    assert len(want) - len(got) <= 3 * 5  # the days that the watermark has not passed


def test_keyed_state_keeps_the_newest(spark, folder, tmp_path):
    rows = events.newest(events.stream(spark, folder))
    rows.writeStream.format("memory").queryName("newest").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = {r.user_id: (round(r.value, 6), r.n) for r in spark.table("newest").groupBy("user_id").agg(F.max_by("value", "n").alias("value"), F.max("n").alias("n")).collect()}
    batch = spark.read.parquet(folder).groupBy("user_id").agg(F.max_by("value", "ts").alias("value"), F.count(F.lit(1)).alias("n")).collect()
    assert got == {r.user_id: (round(r.value, 6), r.n) for r in batch}


def test_repeats_are_dropped(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    events.into(events.once(events.stream(spark, folder), ["user_id"], "60 days"), out, str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(out).count() == spark.read.parquet(folder).select("user_id").distinct().count()
