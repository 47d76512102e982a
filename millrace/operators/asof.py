"""Dated snapshots: daily buckets, backward as-of bases with tolerance, growth, acceleration and jumps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scores import rounded


@dataclass(frozen=True)
class Momentum:
    """Windows in days with their tolerance, and the thresholds of the labels."""

    windows: tuple[tuple[int, int], ...] = ((1, 0), (7, 1), (30, 3), (90, 7))
    floor: float = 100.0
    flat: float = 3.0
    surging: float = 10.0
    rising: float = 1.0
    declining: float = -0.5
    acceleration: float = 0.5
    share: float = 0.25


def daily(events: DataFrame, key: str, at: str, value: Column) -> DataFrame:
    """key, day and the running total up to the day's end."""
    days = events.groupBy(key, F.to_date(at).alias("day")).agg(F.sum(value).alias("added"))
    return days.select(key, "day", F.sum("added").over(Window.partitionBy(key).orderBy("day")).alias("total"))


def summed_in_order(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The keys and total: the sum of value, added row by row in the given order, so that the last bit of a double does not hang on how rows were dealt to tasks. A sum that streams, and no list of a key's rows."""
    rising = Window.partitionBy(*keys).orderBy(*order, value)
    running = F.sum(value).over(rising.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(*keys, running.alias("total"), F.lead(F.lit(1)).over(rising).alias("next")).where("next is null").drop("next")


def as_of_days(history: DataFrame, as_of: str, windows: Sequence[tuple[int, int]]) -> DataFrame:
    """For each window the newest day that is not after as_of minus the window, within its tolerance: the base, one for all keys. Later history is ignored."""
    days = history.where(F.col("day") <= F.lit(as_of).cast("date")).select("day").distinct()
    wanted = F.explode(F.array(*[F.struct(F.lit(w).alias("window"), F.lit(t).alias("tolerance")) for w, t in windows])).alias("w")
    target = F.date_sub(F.lit(as_of).cast("date"), F.col("w.window"))
    fit = days.select("day", wanted).where((F.col("day") <= target) & (F.datediff(target, F.col("day")) <= F.col("w.tolerance")))
    return fit.groupBy(F.col("w.window").alias("window")).agg(F.max("day").alias("base"))


def as_of_value(history: DataFrame, points: DataFrame, key: str, at: str, tolerance: int) -> DataFrame:
    """Each point with its own key's newest row at or before it, within the tolerance. History and points are merged and carried forward in one window over the key, so there is no range join."""
    rows = history.select(key, F.col("day").alias("at"), F.struct("day", "total").alias("seen"), F.lit(None).cast(points.schema[at].dataType).alias("point"))
    rows = rows.unionByName(points.select(key, F.col(at).alias("at"), F.lit(None).cast(rows.schema["seen"].dataType).alias("seen"), F.col(at).alias("point")))
    carried = Window.partitionBy(key).orderBy("at", F.col("point").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("last", F.last("seen", ignorenulls=True).over(carried)).where(F.col("point").isNotNull())
    near = F.datediff("point", F.col("last.day")) <= tolerance
    return found.select(key, F.col("point").alias(at), F.when(near, F.col("last.day")).alias("base_day"), F.when(near, F.col("last.total")).alias("base"))


def growth(history: DataFrame, key: str, as_of: str, settings: Momentum = Momentum()) -> DataFrame:
    """For each key and window: status, change, change a day, monthly percentage and label."""
    now = history.where(F.col("day") == F.lit(as_of).cast("date")).select(key, F.col("total").alias("now"))
    bases = as_of_days(history, as_of, settings.windows)
    windows = history.sparkSession.createDataFrame([(w,) for w, _ in settings.windows], "window int").join(F.broadcast(bases), "window", "left")
    wide = now.select(key, "now", F.lit(1).alias("one")).join(F.broadcast(windows.withColumn("one", F.lit(1))), "one").drop("one")
    before = history.select(key, F.col("day").alias("base"), F.col("total").alias("then"))
    wide = wide.join(before, [key, "base"], "left")
    status = F.when(F.col("base").isNull(), "insufficient_history").when(F.col("then").isNull(), "no_baseline").otherwise("measured")
    change = F.col("now") - F.col("then")
    per_day = change / F.datediff(F.lit(as_of).cast("date"), F.col("base"))
    percent = per_day * 30 / F.greatest(F.col("then"), F.lit(settings.floor)) * 100
    label = F.when(F.abs(change) < settings.flat, "flat").when(percent >= settings.surging, "surging").when(percent >= settings.rising, "rising").when(percent <= settings.declining, "declining").otherwise("steady")
    return wide.select(key, "window", status.alias("status"), rounded(change).alias("change"), rounded(per_day).alias("per_day"), rounded(percent).alias("percent"), F.when(status == "measured", label).otherwise("none").alias("label"))


def acceleration(history: DataFrame, key: str, as_of: str, window: int, settings: Momentum = Momentum()) -> DataFrame:
    """The last window's change against that of the window before it; both bases are exact days."""
    at = lambda days: F.max(F.when(F.col("day") == F.date_sub(F.lit(as_of).cast("date"), days), F.col("total")))
    three = history.groupBy(key).agg(at(0).alias("now"), at(window).alias("mid"), at(2 * window).alias("old")).where("now is not null and mid is not null and old is not null")
    recent, prior = (F.col("now") - F.col("mid")) / window, (F.col("mid") - F.col("old")) / window
    least = F.greatest(F.lit(settings.acceleration), F.lit(settings.share) * F.abs(prior))
    small = (F.abs(recent * window) < settings.flat) & (F.abs(prior * window) < settings.flat)
    label = F.when(small, "steady").when(recent - prior >= least, "accelerating").when(recent - prior <= -least, "decelerating").otherwise("steady")
    return three.select(key, rounded(recent).alias("recent"), rounded(prior).alias("prior"), label.alias("label"))


def jumps(history: DataFrame, key: str, least: float, relative: float = 0.0, floor: float = 100.0, keep: float = 0.5) -> DataFrame:
    """Steps between following observations that are at or above the threshold (the greater of `least` and a share of the former value, which counts as `floor` at least), and what the observations strictly after them say:
    unconfirmed if there is none, confirmed if each keeps enough of the step, else transient. kept: the least share of the step that a later one keeps; null if there is none."""
    order = Window.partitionBy(key).orderBy(F.asc_nulls_last("day"))
    later = order.rowsBetween(1, Window.unboundedFollowing)
    steps = history.select(key, "day", "total", F.lag("total").over(order).alias("before"), F.min("total").over(later).alias("low"), F.max("total").over(later).alias("high"))
    step = F.col("total") - F.col("before")
    found = steps.where(F.abs(step) >= F.greatest(F.lit(float(least)), relative * F.greatest(F.col("before"), F.lit(float(floor)))))
    kept = F.when(step > 0, (F.col("low") - F.col("before")) / step).otherwise((F.col("high") - F.col("before")) / step)
    outcome = F.when(kept.isNull(), "unconfirmed").when(kept < keep, "transient").otherwise("confirmed")
    return found.select(key, "day", rounded(step).alias("step"), rounded(kept).alias("kept"), outcome.alias("outcome"))


def comparable(now: Column, then: Column, same: Column) -> Column:
    """Outcome of a comparability test of two observations."""
    return F.when(now.isNull() & then.isNull(), "neither").when(now.isNull(), "no_current").when(then.isNull(), "no_baseline").when(~same, "different_identity").otherwise("comparable")
