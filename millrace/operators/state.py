"""State between runs: change classification, pools, idempotent submission, queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def classify(before: DataFrame, now: DataFrame, key: str, value: str, absolute: float, relative: float) -> DataFrame:
    """new, failed (was there, is not now), changed (by at least the larger of two thresholds) or unchanged."""
    joined = before.select(key, F.col(value).alias("was")).join(now.select(key, F.col(value).alias("now")), key, "full_outer")
    moved = F.abs(F.col("now") - F.col("was")) >= F.greatest(F.lit(absolute), F.abs("was") * relative)
    return joined.withColumn("class", F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "failed").when(moved, "changed").otherwise("unchanged"))


def pool(known: DataFrame, found: DataFrame, key: str, provider: str, at: str) -> DataFrame:
    """A keyed pool after a run: providers united, first and last seen, and whether the key is new, refreshed or only known."""
    old = known.groupBy(key).agg(F.collect_set(provider).alias("old"), F.min(at).alias("old_first"), F.max(at).alias("old_last"))
    new = found.groupBy(key).agg(F.collect_set(provider).alias("new"), F.min(at).alias("new_first"), F.max(at).alias("new_last"))
    joined = old.join(new, key, "full_outer")
    status = F.when(F.col("old").isNull(), "new").when(F.col("new").isNotNull(), "refreshed").otherwise("known")
    providers = F.array_join(F.array_sort(F.array_union(F.coalesce("old", F.array().cast("array<string>")), F.coalesce("new", F.array().cast("array<string>")))), "|")
    return joined.select(key, status.alias("status"), providers.alias("providers"), F.least("old_first", "new_first").alias("first_seen"), F.greatest("old_last", "new_last").alias("last_seen"))


def submit(submissions: DataFrame, producer: str, key: str, digest: str, order: list[str]) -> DataFrame:
    """outcome of each submission: the first of its producer and key is accepted, one with the same digest is a replay, any other a conflict."""
    window = Window.partitionBy(producer, key).orderBy(*order)
    first = F.first(digest).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    place = F.row_number().over(window)
    return submissions.withColumn("outcome", F.when(place == 1, "accepted").when(first.eqNullSafe(F.col(digest)), "replay").otherwise("conflict"))


def rate(submissions: DataFrame, producer: str, at: str, seconds: int, most: int) -> DataFrame:
    """Submissions of a producer in the time before each one, and whether that is above the limit."""
    window = Window.partitionBy(producer).orderBy(F.col(at).cast("long")).rangeBetween(-seconds, 0)
    return submissions.withColumn("recent", F.count(F.lit(1)).over(window)).withColumn("limited", F.col("recent") > most)


def sealed(entities: DataFrame, day: str, order: list[str], most: int) -> DataFrame:
    """The first `most` of each day in order of arrival, numbered."""
    return entities.withColumn("slot", F.row_number().over(Window.partitionBy(day).orderBy(*order))).where(F.col("slot") <= most)


def attempts(outcomes: DataFrame, key: str, order: list[str], failed, most: int = 3) -> DataFrame:
    """Attempts and failures of each key since its last success; after `most` failures in a row it is dead."""
    last = F.max(F.when(~failed, F.struct(*order))).over(Window.partitionBy(key))
    since = outcomes.withColumn("last_success", last).where(failed & (F.col("last_success").isNull() | (F.struct(*order) > F.col("last_success"))))
    return since.groupBy(key).agg(F.count(F.lit(1)).alias("failures")).withColumn("state", F.when(F.col("failures") >= most, "dead").otherwise("retry"))


def stale_by_fingerprint(before: DataFrame, now: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Keys whose fingerprint of facts and settings is not the one that they were computed with."""
    return now.join(before.select(key, F.col(fingerprint).alias("was")), key, "left").where(~F.col(fingerprint).eqNullSafe(F.col("was"))).drop("was")
