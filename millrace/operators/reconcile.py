"""Claims of many sources become relationships with their provenance; what cannot be resolved becomes a coded rejection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def relationships(claims: DataFrame, keys: Sequence[str], source: str = "source", at: str = "at") -> DataFrame:
    """One row for each key with its sources (sorted), their number, whether there are several, claims and the latest instant. Sums are partial before the shuffle, so a hot key costs no more than its sources."""
    grouped = claims.groupBy(*keys).agg(F.array_sort(F.collect_set(source)).alias("source_ids"), F.count(F.lit(1)).alias("n_claims"), F.max(at).alias("last_at"))
    return grouped.withColumn("source_count", F.size("source_ids").cast("long")).withColumn("corroborated", F.size("source_ids") >= 2)


def provenance(claims: DataFrame, keys: Sequence[str], order: Sequence[str], most: int) -> DataFrame:
    """The first claims of each key by a total order, as a list of at most `most`. Ranking precedes the list, so that no list is unbounded."""
    ranked = claims.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= most)
    return ranked.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", *order))), lambda x: F.concat_ws("|", *[x[c].cast("string") for c in order])).alias("provenance"))


def resolve(claims: DataFrame, aliases: DataFrame, key: str, into: str) -> tuple[DataFrame, DataFrame]:
    """Claims whose key is a known alias, with what it stands for; and the others. aliases: key, into; the first of several meanings holds."""
    known = aliases.groupBy(key).agg(F.min(into).alias(into))
    joined = claims.join(known, key, "left")
    return joined.where(F.col(into).isNotNull()), joined.where(F.col(into).isNull()).drop(into)


def unresolved(claims: DataFrame, name: str, source: str) -> DataFrame:
    """Names without a meaning: claims, spellings and sources, most claimed first."""
    spelled = claims.withColumn("key", F.lower(F.btrim(name)))
    return spelled.groupBy("key").agg(F.count(F.lit(1)).alias("n_claims"), F.array_join(F.array_sort(F.collect_set(name)), "|").alias("spellings"), F.array_join(F.array_sort(F.collect_set(source)), "|").alias("sources"))


def merged(rows: DataFrame, canonical: str, lists: Sequence[str], firsts: Mapping[str, str]) -> DataFrame:
    """Rows collapsed by their canonical name: lists united and sorted, other columns taken from the row that is first by its order column. Only different lists are gathered, and those of a task are merged before the shuffle."""
    united = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in lists]
    taken = [F.min_by(c, order).alias(c) for c, order in firsts.items()]
    return rows.groupBy(canonical).agg(*united, *taken)


def rejection_code(reason: Column, codes: Mapping[str, str]) -> Column:
    """The code of the first known part of a reason such as `a;b`, in the codes' order of precedence; an unknown reason is an error."""
    parts = F.transform(F.split(reason, ";"), lambda p: F.btrim(p))
    found = F.coalesce(*[F.when(F.array_contains(parts, k), F.lit(v)) for k, v in codes.items()])
    return F.when(reason.isNull(), F.lit(None)).otherwise(F.coalesce(found, F.raise_error(F.concat(F.lit("unknown reason: "), reason))))


def present(before: DataFrame, after: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """What became of each key: new, dropped, changed or same, and the columns that differ."""
    a, b = before.select(key, F.struct(*compare).alias("was")), after.select(key, F.struct(*compare).alias("now"))
    both = a.join(b, key, "full_outer")
    differs = F.array_compact(F.array(*[F.when(~F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}")), F.lit(c)) for c in compare]))
    change = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "dropped").when(F.size(differs) > 0, "changed").otherwise("same")
    return both.select(key, change.alias("change"), F.when(change == "changed", F.array_join(differs, "|")).otherwise("").alias("columns"))


def contradictions(claims: DataFrame, key: str, value: str, source: str, least_sources: int = 3) -> DataFrame:
    """Keys with different values, told by at least so many sources. Different claims first, then the sets of a key: two distinct counts at once would make every row twice."""
    told = claims.select(key, F.col(value).alias("value"), F.col(source).alias("source")).distinct()
    counted = told.groupBy(key).agg(F.size(F.collect_set("value")).cast("long").alias("n_values"), F.size(F.collect_set("source")).cast("long").alias("n_sources"))
    return counted.where((F.col("n_values") > 1) & (F.col("n_sources") >= least_sources))


def dangling(rows: DataFrame, others: DataFrame, key: str, other: str) -> DataFrame:
    """Rows whose reference resolves to nothing."""
    return rows.join(others.select(F.col(other).alias(key)).distinct(), key, "left_anti")


def supersede(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row of each key."""
    columns = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("newest")).select(*key, "newest.*")


def append_once(history: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """History and the rows whose key it does not have; never rewritten."""
    return history.unionByName(rows.join(history.select(*key), list(key), "left_anti"))
