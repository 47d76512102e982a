"""Evidence: the newest of each kind, validation checks, tiers, quotas and version chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_by_kind(rows: DataFrame, key: str, kind: str, at: str, ref: str) -> DataFrame:
    """For each key the newest evidence of every kind and overall, the reference deciding ties."""
    kinds = rows.groupBy(key, kind).agg(F.max(F.struct(at, ref)).alias("best"))
    return kinds.groupBy(key).agg(F.max("best").alias("newest"), F.array_sort(F.collect_list(F.struct(F.col(kind).alias("kind"), F.col(f"best.{at}").alias("at"), F.col(f"best.{ref}").alias("ref")))).alias("by_kind"))


def validated(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """status, failed (sorted names of the checks that do not hold) and unknown (those without an answer)."""
    failed = F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in sorted(checks.items())]))
    unknown = F.array_compact(F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in sorted(checks.items())]))
    rows = rows.withColumn("failed", failed).withColumn("unknown", unknown)
    return rows.withColumn("status", F.when(F.size("failed") > 0, "failed").when(F.size("unknown") > 0, "flagged").otherwise("valid"))


def strongest(kinds: Column, order: Sequence[str]) -> Column:
    """The first kind of an order that is present."""
    return F.coalesce(*[F.when(F.array_contains(kinds, k), F.lit(k)) for k in order])


def quotas(rows: DataFrame, route: str, family: str, order: Sequence[str], per_route: int, per_family: int) -> DataFrame:
    """Rows with one route each, admitted in order while neither their route's nor their family's quota is full: what a full route refuses takes nothing from the family, so two ranks tell."""
    names = rows.columns
    placed = rows.withColumn("_in_route", F.row_number().over(Window.partitionBy(family, route).orderBy(*order))).where(F.col("_in_route") <= per_route)
    return placed.withColumn("_in_family", F.row_number().over(Window.partitionBy(family).orderBy(*order))).where(F.col("_in_family") <= per_family).select(*names)


def routed(rows: DataFrame, id: str, routes: str, order: Sequence[str], per_route: int, per_family: int, family_of: Column) -> DataFrame:
    """Candidates with several routes (an array of strings), in order: each is charged to the least used of its routes that is open, ties by name; a route is open while it and its family are below their quotas. family_of: the family of the column `route`. Result: id, route.

    Each charge depends on those before. A route that is open refuses nobody, so before its last charge come no more of its candidates than all routes can take: only so many of each route are looked at, in one task
    bounded by the quotas and the number of routes, whatever the number of candidates."""
    each = rows.select(id, *[c for c in order if c != id], F.explode(F.array_distinct(F.col(routes))).alias("route")).withColumn("family", family_of)
    most = per_route * max(1, each.select("route").distinct().count())
    near = each.withColumn("_place", F.row_number().over(Window.partitionBy("route").orderBy(*order))).where(F.col("_place") <= most)
    wanted = near.groupBy(id, *[c for c in order if c != id]).agg(F.array_sort(F.collect_list(F.struct("route", "family"))).alias("open"))
    key = rows.schema[id].dataType.simpleString()

    def charge(group: pd.DataFrame) -> pd.DataFrame:
        by_route: dict = {}
        by_family: dict = {}
        out = []
        for found, open_ in group.sort_values(list(order), kind="stable")[[id, "open"]].itertuples(index=False):
            fit = [(by_route.get(x["route"], 0), x["route"], x["family"]) for x in open_ if by_route.get(x["route"], 0) < per_route and by_family.get(x["family"], 0) < per_family]
            if fit:
                _, r, f = min(fit)
                by_route[r], by_family[f] = by_route.get(r, 0) + 1, by_family.get(f, 0) + 1
                out.append((found, r))
        return pd.DataFrame(out, columns=[id, "route"])

    return wanted.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(charge, f"`{id}` {key}, route string")


def chain(rows: DataFrame, key: str, order: Sequence[str], version: str) -> DataFrame:
    """Each version with the one before it, its place, and whether it changed."""
    window = Window.partitionBy(key).orderBy(*order)
    linked = rows.withColumn("place", F.row_number().over(window)).withColumn("before", F.lag(version).over(window))
    return linked.withColumn("changed", ~F.col(version).eqNullSafe(F.col("before")))


def range_split(rows: DataFrame, at: str, most: int, depth: int = 8) -> DataFrame:
    """Halves of the column's range, split again while they hold more than `most` rows: lower and upper bound, rows. All levels are counted in one pass over the finest cells."""
    low, high = rows.agg(F.min(at), F.max(at)).first()
    if low is None:
        return rows.sparkSession.createDataFrame([], "level int, cell long, n long")
    width = max(1.0, float(high - low))
    cell = F.least(F.floor((F.col(at) - F.lit(low)) / F.lit(width) * 2**depth), F.lit(2**depth - 1)).cast("long")
    fine = rows.groupBy(cell.alias("fine")).agg(F.count(F.lit(1)).alias("n"))
    levels = fine.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"), "fine", "n")
    cells = levels.groupBy("level", F.floor(F.col("fine") / F.pow(F.lit(2), depth - F.col("level"))).cast("long").alias("cell")).agg(F.sum("n").alias("n"))
    parent = cells.select((F.col("level") + 1).alias("level"), F.col("cell").alias("up"), F.col("n").alias("above"))
    joined = cells.withColumn("up", F.floor(F.col("cell") / 2).cast("long")).join(parent, ["level", "up"], "left")
    split = F.col("above").isNull() | (F.col("above") > most)
    return joined.where(split & ((F.col("n") <= most) | (F.col("level") == depth))).select("level", "cell", "n")


def regressions(before: DataFrame, after: DataFrame, key: str, value: str, most_drop: float) -> DataFrame:
    """Metrics that fell by more than a limit, or are gone."""
    joined = before.select(key, F.col(value).alias("was")).join(after.select(key, F.col(value).alias("now")), key, "left")
    return joined.where(F.col("now").isNull() | (F.col("was") - F.col("now") > most_drop))
