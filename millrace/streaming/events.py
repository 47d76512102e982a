"""Streams of events: daily counts, keyed upserts, idempotent intake and attempts. Every function takes a batch or a streaming DataFrame where that is possible, so that a batch run checks the stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = T.StructType([T.StructField(n, t) for n, t in (("event_id", T.LongType()), ("ts", T.TimestampNTZType()), ("user_id", T.LongType()), ("event_type", T.StringType()), ("value", T.DoubleType()), ("props", T.StringType()))])


def stream(spark: SparkSession, folder: str, files: int | None = 1) -> DataFrame:
    """A folder of Parquet files as a stream, so many files at a time. None: all that are there are one batch; files that are not written in order of time need that, as an event is late once a batch with a later one has moved the watermark."""
    rows = spark.readStream.schema(EVENTS)
    rows = rows if files is None else rows.option("maxFilesPerTrigger", files)
    return rows.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Tumbling days: events and their sum by type. On a stream, days end when the watermark has passed them."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")


def sliding(events: DataFrame, length: str = "7 days", step: str = "1 day", late: str = "1 day") -> DataFrame:
    """Sliding look-backs: events and different users."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", length, step).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("user_id").alias("users")).select(F.col("w.end").alias("until"), "n", "users")


def once(events: DataFrame, key: list[str], late: str = "1 day") -> DataFrame:
    """The first event of each key; later ones with that key are dropped while the watermark keeps it."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key) if events.isStreaming else events.dropDuplicates(key)


NEWEST = "user_id long, at timestamp, value double, first_value double, n long"


def newest(events: DataFrame, keep: str = "30 days") -> DataFrame:
    """Keyed state: the newest event of each user, the first one's value, and how many there were; whichever order they come in. State that saw no event within `keep` of the watermark is dropped."""
    width = int(pd.Timedelta(keep).total_seconds() * 1000)

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        at, value, start, first, n = state.get if state.exists else (0, 0.0, 2**62, 0.0, 0)
        for batch in batches:
            for ts, v in zip(batch["ts"].astype("datetime64[us]").astype("int64"), batch["value"], strict=True):
                at, value = max((at, value), (int(ts), float(v)))
                start, first = min((start, first), (int(ts), float(v)))
                n += 1
        state.update((at, value, start, first, n))
        state.setTimeoutTimestamp(max(at // 1000, state.getCurrentWatermarkMs()) + width)
        yield pd.DataFrame({"user_id": [key[0]], "at": [pd.Timestamp(at, unit="us")], "value": [value], "first_value": [first], "n": [n]})

    rows = events.withWatermark("ts", "1 day").select("user_id", "ts", "value")
    return rows.groupBy("user_id").applyInPandasWithState(update, NEWEST, "at long, value double, start long, first double, n long", "update", GroupStateTimeout.EventTimeTimeout)


def into(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """All that is there now, written as Parquet; a later call goes on where this one ended."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
