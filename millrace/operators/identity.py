"""Which rows are the same entity: fallback keys, connected components, siblings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import checkpointed


def fallback(rows: DataFrame, known: DataFrame, keys: Sequence[tuple[str, str, str]], id: str) -> DataFrame:
    """rows with the known id found by the first of the keys that finds one, and which key that was. keys: label, column of rows, column of known."""
    found, hits = rows, []
    for label, left, right in keys:
        side = known.where(F.col(right).isNotNull()).groupBy(F.col(right).alias(f"_{label}_key")).agg(F.min(id).alias(f"_{label}"))
        found = found.join(side, F.col(left) == F.col(f"_{label}_key"), "left").drop(f"_{label}_key")
        hits.append((label, F.col(f"_{label}")))
    by = F.coalesce(*[F.when(c.isNotNull(), F.lit(label)) for label, c in hits], F.lit("none"))
    return found.withColumn("known_id", F.coalesce(*[c for _, c in hits])).withColumn("by", by).drop(*[f"_{label}" for label, _ in hits])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node). Each round every node points at its smallest neighbour, or at what that one points at; edges are then drawn between what their ends point at, and those within one node are gone, so that each round has fewer. Nothing but a flag comes to the driver."""
    links, named = edges.select(F.col(a).alias("x"), F.col(b).alias("y")), None
    while True:
        ends = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = ends.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("component"))
        to = least.select(F.col("node").alias("component"), F.col("component").alias("to"))
        least = checkpointed(least.join(to, "component").select("node", F.col("to").alias("component")))
        to = least.select(F.col("node").alias("component"), F.col("component").alias("to"))
        named = least if named is None else named.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        p, q = least.select(F.col("node").alias("x"), F.col("component").alias("p")), least.select(F.col("node").alias("y"), F.col("component").alias("q"))
        links = checkpointed(links.join(p, "x").join(q, "y").where("p <> q").select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct())
        if links.isEmpty():
            return checkpointed(named)


def siblings(rows: DataFrame, owner: str, stem: Column, id: str) -> DataFrame:
    """Groups of several rows with one owner and stem, and their primary: the shortest name, then the smallest."""
    grouped = rows.withColumn("stem", stem).groupBy(owner, "stem").agg(F.count(F.lit(1)).alias("n"), F.min_by(id, F.struct(F.length(F.col(id).cast("string")), id)).alias("primary"))
    return grouped.where("n > 1")
