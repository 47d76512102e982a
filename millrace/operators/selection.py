"""Ranking by total orders, limits, budgets and caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(rows: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k of each group, their rank, and how many more there are."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    more = rows.groupBy(*by).agg(F.greatest(F.count(F.lit(1)) - k, F.lit(0)).alias("more_available"))
    return ranked.where(F.col("rank") <= k).join(more, list(by))


def budget(rows: DataFrame, must: Column, order: Sequence[Column], limit: int) -> DataFrame:
    """taken: all that must be, and the first of the others while the budget lasts. The first rows of the others are found by a limit, not by numbering all of them in one task."""
    marked = rows.withColumn("must", F.coalesce(must, F.lit(False)))
    room = max(0, limit - marked.where("must").count())
    return marked.where("must").unionByName(marked.where("not must").orderBy(*order).limit(room)).drop("must")


def demoted(rows: DataFrame, flag: Column, order: Sequence[Column], k: int) -> DataFrame:
    """The first k, flagged rows after all others."""
    return rows.withColumn("demoted", F.coalesce(flag, F.lit(False))).orderBy("demoted", *order).limit(k)


def largest_cap(sizes: DataFrame, n: str, most: int, highest: int) -> DataFrame:
    """The largest cap at which the capped group sizes sum to at most `most`; zero if none. Groups of one size are summed together first."""
    kinds = sizes.groupBy(n).agg(F.count(F.lit(1)).alias("groups"))
    caps = kinds.select(F.explode(F.sequence(F.lit(1), F.lit(highest))).alias("cap"), F.col(n).alias("n"), "groups")
    sums = caps.groupBy("cap").agg(F.sum(F.least("n", "cap") * F.col("groups")).alias("total"))
    return sums.where(F.col("total") <= most).agg(F.coalesce(F.max("cap"), F.lit(0)).alias("cap"), F.coalesce(F.max("total"), F.lit(0)).alias("total"))


def hash_sample(rows: DataFrame, seed: str, key: Column, n: int) -> DataFrame:
    """n rows in the order of a hash of seed and key: another seed, another sample; the same seed, the same sample."""
    return rows.withColumn("draw", F.sha2(F.concat(F.lit(f"{seed}|"), key.cast("string")), 256)).orderBy("draw").limit(n).drop("draw")


def capped_serving(rows: DataFrame, group: Sequence[str], served: Column, order: Sequence[Column], cap: int) -> DataFrame:
    """Rows within a cap for each group; those served before stay first."""
    window = Window.partitionBy(*group).orderBy(F.coalesce(served, F.lit(False)).desc(), *order)
    return rows.withColumn("place", F.row_number().over(window)).where(F.col("place") <= cap)


def page_and_beyond(rows: DataFrame, order: Sequence[Column], page: int, beyond: int) -> DataFrame:
    """The first page, marked, and the rows that follow it."""
    first = rows.orderBy(*order).limit(page + beyond)
    return first.withColumn("place", F.row_number().over(Window.orderBy(*order))).withColumn("part", F.when(F.col("place") <= page, "page").otherwise("beyond"))


def after_cursor(rows: DataFrame, key: str, cursor, chunk: int) -> DataFrame:
    """The next chunk of a resumable pass over sorted keys."""
    left = rows if cursor is None else rows.where(F.col(key) > F.lit(cursor))
    return left.orderBy(key).limit(chunk)
