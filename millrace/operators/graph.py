"""A graph is two DataFrames: nodes (id, type, attributes) and edges (src, rel, dst, confidence)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.rules import small
from millrace.session import checkpointed

#: Names of members up to which they are broadcast, so that pairs are not shuffled to be named.
MOST_NAMES = 1_000_000


def upsert_edges(edges: DataFrame) -> DataFrame:
    """One edge for each (src, rel, dst): the greatest confidence, all evidence."""
    return edges.groupBy("src", "rel", "dst").agg(F.max("confidence").alias("confidence"), F.array_sort(F.collect_set("evidence")).alias("evidence"))


def step(rows: DataFrame, edges: DataFrame, rel: str, way: str = "out", symmetric: bool = False) -> DataFrame:
    """From each id over one relation: origin, id, confidence (the least on the way, and of several ways the best)."""
    used = edges.where(F.col("rel") == rel)
    out = used.select(F.col("src").alias("id"), F.col("dst").alias("next"), "confidence")
    back = used.select(F.col("dst").alias("id"), F.col("src").alias("next"), "confidence")
    hop = (out.unionByName(back) if symmetric else out if way == "out" else back).withColumnRenamed("confidence", "c")
    if "origin" not in rows.columns:
        rows = rows.withColumn("origin", F.col("id")).withColumn("confidence", F.lit(1.0))
    return rows.join(hop, "id").groupBy("origin", F.col("next").alias("id")).agg(F.max(F.least("confidence", "c")).alias("confidence"))


def walk(rows: DataFrame, edges: DataFrame, path: list[tuple[str, str]]) -> DataFrame:
    for rel, way in path:
        rows = step(rows, edges, rel, way)
    return rows


def require(rows: DataFrame, edges: DataFrame, path: list[tuple[str, str]]) -> DataFrame:
    """Rows from which the path leads somewhere."""
    return rows.join(walk(rows.select("id").distinct(), edges, path).select(F.col("origin").alias("id")).distinct(), "id", "left_semi")


def exclude(rows: DataFrame, edges: DataFrame, path: list[tuple[str, str]]) -> DataFrame:
    """Rows from which it does not."""
    return rows.join(walk(rows.select("id").distinct(), edges, path).select(F.col("origin").alias("id")).distinct(), "id", "left_anti")


def group_by_neighbour(rows: DataFrame, edges: DataFrame, rel: str, way: str, least: int, members: int = 3) -> DataFrame:
    """Neighbours that at least so many rows share, with the first few of them."""
    met = step(rows.select("id").distinct(), edges, rel, way)
    sized = met.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    first = met.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("confidence"), "origin"))).where(F.col("place") <= members)
    listed = first.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "origin"))), lambda x: x["origin"].cast("string")), "|").alias("members"))
    return sized.join(listed, "id")


def co_members(edges: DataFrame, rel: str, most_confidence: float, block: int = 256) -> DataFrame:
    """Pairs a < b that point at the same node, with how many nodes they share.

    Members are numbered in their order, so that pairs are of numbers and not of names. A node's members are lists of about `block` of them; each member meets each list, and what it meets is dealt by the member as one row, not as a row
    for each pair. A node with very many members is many tasks' work.
    """
    used = edges.where(F.col("rel") == rel).select("src", "dst", "confidence").distinct()
    named = checkpointed(used.select("src").distinct().orderBy("src").select("src", F.monotonically_increasing_id().alias("id")))  # written, so that the numbers stay
    parts = used.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("dst", F.ceil(F.col("n") / block).alias("parts"))
    fit = used.join(small(named, MOST_NAMES), "src").select("id", "dst", "confidence").join(parts, "dst")
    lists = fit.groupBy("dst", F.pmod(F.xxhash64("id"), "parts").alias("part")).agg(F.collect_list(F.struct(F.col("id").alias("b"), F.col("confidence").alias("c"))).alias("all"))
    met = fit.select("dst", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("id").alias("a"), "confidence").join(lists, ["dst", "part"])
    others = F.filter("all", lambda x: x["b"] > F.col("a"))
    confidence = F.transform("others", lambda x: F.least(F.lit(most_confidence), "confidence", x["c"]))
    met = met.select("a", "confidence", others.alias("others")).where(F.size("others") > 0).select("a", F.col("others.b").alias("b"), confidence.alias("c"))
    pairs = met.repartition("a").select("a", F.explode(F.arrays_zip("b", "c")).alias("x")).select("a", "x.b", "x.c")
    found = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_shared"), F.max("c").alias("confidence"))
    name = lambda x: small(named, MOST_NAMES).select(F.col("id").alias(x), F.col("src").alias(f"name_{x}"))
    return found.join(name("a"), "a").join(name("b"), "b").select(F.col("name_a").alias("a"), F.col("name_b").alias("b"), "n_shared", "confidence")


def frontier(seeds: DataFrame, routes: DataFrame, depth: int, least: int = 2, bound: int = 1000) -> DataFrame:
    """What can be reached from seeds in rounds: id, depth, n_routes (different routes by which the round reached it), status.

    seeds: id; routes: src, route, dst. In each round all that the last one admitted is expanded; an id seen before is not seen again. Those that at least so many routes reach are admitted to the next round, the first `bound`
    of them by routes and id; others stay as `few_routes` or `over_bound`: they are in the result, and are not expanded. Rounds end at the depth, or when none is admitted. A round's rows are written, so that plans do not grow.
    """
    seen = checkpointed(seeds.select("id").distinct().select("id", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("n_routes"), F.lit("seed").alias("status")))
    rounds, admitted = [seen], seen.select("id")
    for n in range(1, depth + 1):
        met = admitted.join(routes.withColumnRenamed("src", "id"), "id").groupBy(F.col("dst").alias("id")).agg(F.countDistinct("route").alias("n_routes"))
        fresh = checkpointed(met.join(seen.select("id"), "id", "left_anti"))
        first = fresh.where(F.col("n_routes") >= least).orderBy(F.desc("n_routes"), "id").limit(bound).select("id", F.lit("admitted").alias("first"))
        other = F.when(F.col("n_routes") < least, "few_routes").otherwise("over_bound")
        found = checkpointed(fresh.join(first, "id", "left").select("id", F.lit(n).alias("depth"), "n_routes", F.coalesce("first", other).alias("status")))
        rounds.append(found)
        admitted = found.where("status = 'admitted'").select("id")
        if not admitted.limit(1).count():
            break
        seen = seen.select("id").unionByName(found.select("id"))
    whole = rounds[0]
    for found in rounds[1:]:
        whole = whole.unionByName(found)
    return whole
