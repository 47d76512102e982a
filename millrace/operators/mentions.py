"""Time-decayed ranking of mentions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scores import decay, rounded
from millrace.functions.times import elapsed_days


@dataclass(frozen=True)
class Radar:
    """Days of look-back and half-life, weights of the sources, the discount of a repeating author, mentions that count for a key, and the bonus for each further source up to a number."""

    days: int = 7
    half_life: float = 3.0
    weights: dict[str, float] = field(default_factory=dict)
    repeat: float = 0.25
    counted: int = 5
    bonus: float = 0.25
    sources: int = 3


def contributions(mentions: DataFrame, as_of: str, radar: Radar) -> DataFrame:
    """mentions: item, source, author, at, points, key. Those in the look-back, with their contribution and whether they count for their key."""
    end = F.lit(as_of).cast("timestamp")
    age = elapsed_days(F.col("at"), end)
    weight = F.coalesce(*[F.when(F.col("source") == s, F.lit(float(w))) for s, w in sorted(radar.weights.items())], F.lit(1.0))
    inside = mentions.where((F.col("at") <= end) & (age < radar.days))
    inside = inside.withColumn("raw", rounded(weight * F.log1p(F.greatest(F.col("points"), F.lit(0.0))) * decay(age, radar.half_life), 6))
    order = [F.desc("raw"), F.col("item")]
    repeated = F.row_number().over(Window.partitionBy("key", "source", "author").orderBy(*order)) > 1
    inside = inside.withColumn("contribution", F.when(repeated, rounded(F.col("raw") * radar.repeat, 6)).otherwise(F.col("raw")))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("contribution"), "item"))
    return inside.withColumn("counted", place <= radar.counted)


def ranked(contributed: DataFrame, radar: Radar) -> DataFrame:
    """Keys by score: the counted contributions, times a bonus for several sources."""
    sums = contributed.groupBy("key").agg(F.sum(F.when(F.col("counted"), F.col("contribution"))).alias("base"), F.countDistinct("source").alias("n_sources"), F.count(F.lit(1)).alias("n_mentions"))
    return sums.withColumn("score", rounded(F.col("base") * (1 + radar.bonus * (F.least("n_sources", F.lit(radar.sources)) - 1))))


def by_source(contributed: DataFrame) -> DataFrame:
    return contributed.groupBy("key", "source").agg(F.count(F.lit(1)).alias("n_mentions"), rounded(F.sum("points")).alias("points"), rounded(F.max("contribution")).alias("best"))


def velocity(observations: DataFrame, key: str) -> DataFrame:
    """Points a day between the first and the last observation, a day at least, never below zero; and the trend of that."""
    ends = observations.groupBy(key).agg(F.min_by("points", F.struct("at", "item")).alias("first"), F.max_by("points", F.struct("at", "item")).alias("last"), F.min("at").alias("start"), F.max("at").alias("stop"))
    days = F.greatest(elapsed_days(F.col("start"), F.col("stop")), F.lit(1.0))
    return ends.select(key, rounded(F.greatest((F.col("last") - F.col("first")) / days, F.lit(0.0))).alias("velocity"), F.when(F.col("last") > F.col("first"), "up").when(F.col("last") < F.col("first"), "down").otherwise("level").alias("trend"))


def upsert(before: DataFrame, new: DataFrame, key: str, keep: int) -> DataFrame:
    """The newest observation of each key and its first and latest `keep` - 1 observed values; the order of arrival does not matter."""
    seen = before.select(key, "at", "points").unionByName(new.select(key, "at", "points")).distinct()
    first = F.row_number().over(Window.partitionBy(key).orderBy("at", "points"))
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("at"), F.desc("points")))
    kept = seen.withColumn("first", first).withColumn("last", last).where((F.col("first") == 1) | (F.col("last") < keep))
    return kept.groupBy(key).agg(F.max("at").alias("at"), F.max_by("points", F.struct("at", "points")).alias("points"), F.array_sort(F.collect_list(F.struct("at", "points"))).alias("observed"))
