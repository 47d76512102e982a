"""Quality, observability and disclosure: recall and precision, streaks, fingerprints, suppression, quantiles of buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scores import rounded


def at_k(ranked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """ranked: query, doc, rank; relevant: query, doc. Recall and precision at k of each query; undefined ones are null."""
    hits = ranked.where(F.col("rank") <= k).join(relevant.withColumn("hit", F.lit(1)), ["query", "doc"], "left")
    got = hits.groupBy("query").agg(F.count(F.lit(1)).alias("n_returned"), F.coalesce(F.sum("hit"), F.lit(0)).alias("n_hit"))
    wanted = relevant.groupBy("query").agg(F.count(F.lit(1)).alias("n_relevant"))
    joined = wanted.join(got, "query", "full_outer").fillna(0, ["n_returned", "n_hit", "n_relevant"])
    return joined.select("query", "n_returned", "n_hit", "n_relevant", rounded(F.try_divide("n_hit", "n_relevant")).alias("recall"), rounded(F.try_divide("n_hit", "n_returned")).alias("precision"))


def suppressed(n: Column, k: int = 5) -> Column:
    """A count as text; one between zero and k is only said to be below k."""
    return F.when((n == 0) | (n >= k), n.cast("string")).otherwise(F.lit(f"<{k}"))


def bucket_quantile(counts: DataFrame, by: str, bucket: str, n: str, q: float) -> DataFrame:
    """The first bucket at which the running count reaches a share q of the group's total."""
    running = F.sum(n).over(Window.partitionBy(by).orderBy(bucket))
    total = F.sum(n).over(Window.partitionBy(by))
    return counts.withColumn("running", running).withColumn("total", total).where(F.col("running") >= q * F.col("total")).groupBy(by).agg(F.min(bucket).alias("bucket"), F.max("total").alias("total"))


def streaks(rows: DataFrame, by: str, order: list[str], holds: Column) -> DataFrame:
    """Runs of consecutive rows for which `holds` is true: gaps and islands by the difference of two numberings."""
    all_rows = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    kept = rows.withColumn("holds", F.coalesce(holds, F.lit(False))).withColumn("i", all_rows)
    island = kept.where("holds").withColumn("island", F.col("i") - F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return island.groupBy(by, "island").agg(F.count(F.lit(1)).alias("length"), F.min("i").alias("start"))


def previous_where(by: str, order: list[str], holds: Column, value: Column) -> Column:
    """The value of the last earlier row for which `holds` is true."""
    return F.last(F.when(holds, value), ignorenulls=True).over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))


def history(failures: DataFrame, fingerprint: str, at: str, kind: str) -> DataFrame:
    """First and last time, occurrences and kinds of each fingerprint."""
    return failures.groupBy(fingerprint).agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("occurrences"), F.array_join(F.array_sort(F.collect_set(kind)), "|").alias("kinds"))


def shrunk(before: DataFrame, after: DataFrame, key: str, n: str, least: int, share: float) -> DataFrame:
    """Keys whose count fell by at least a number and a share."""
    joined = before.select(key, F.col(n).alias("was")).join(after.select(key, F.col(n).alias("now")), key, "left").fillna(0, ["now"])
    lost = F.col("was") - F.col("now")
    return joined.where((lost >= least) & (lost >= share * F.col("was"))).select(key, "was", "now")


def agreement(a: DataFrame, b: DataFrame, key: str, value: str, absolute: float, relative: float) -> DataFrame:
    """Pairs of observations, and whether they agree within the larger of two tolerances."""
    joined = a.select(key, F.col(value).alias("ours")).join(b.select(key, F.col(value).alias("theirs")), key)
    return joined.withColumn("agrees", F.abs(F.col("ours") - F.col("theirs")) <= F.greatest(F.lit(absolute), F.abs("theirs") * relative))
