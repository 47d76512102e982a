"""A retrieval plan whose rows carry what led to them: the edges walked, the attributes tested, the words matched.

Every step is one lazy DataFrame with narrow rows (an id and its evidence). Where several ways lead to a row the best edge stays (the greatest confidence, then the smaller id), chosen by
partial aggregation, so that a node with very many neighbours is never gathered. `require` does not enumerate paths: from the last hop backwards each node keeps its best continuation, which is
one aggregation over a relation for each hop. Row counts of the steps are observed while the plan runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from millrace.operators import retrieval
from millrace.plans.plan import predicate

EDGE = "struct<src:string,rel:string,dst:string,confidence:double>"
NONE = {"edges": f"array<{EDGE}>", "facets": "array<struct<entity:string,field:string,value:string>>", "semantic": "array<struct<score:double,terms:array<string>>>", "members": "array<string>"}

#: Parts of a node's neighbours that meet before it does.
PARTS = 32


def empty(name: str) -> Column:
    return F.array().cast(NONE[name]).alias(name)


@dataclass(frozen=True)
class Hop:
    """One relation of a path. to: ids it may end at; to_type, where: what must hold for the node it ends at; least: the least confidence."""

    rel: str
    way: str = "out"
    to: Sequence[str] | None = None
    to_type: str | None = None
    least: float = 0.0
    where: Mapping[str, dict] = field(default_factory=dict)


@dataclass(frozen=True)
class Found:
    """Found(nodes, edges).start(...)...result(). nodes: id, type, name and attributes; edges: src, rel, dst, confidence; symmetric: relations that are walked both ways; members: how many a row lists."""

    nodes: DataFrame
    edges: DataFrame
    symmetric: frozenset[str] = frozenset()
    members: int = 20
    rows: DataFrame | None = None
    order: str = "id"
    steps: tuple[tuple[str, Observation], ...] = ()

    def _then(self, said: str, rows: DataFrame) -> Found:
        seen = Observation()
        return replace(self, rows=rows.observe(seen, F.count(F.lit(1)).alias("rows")), steps=(*self.steps, (said, seen)))

    def _hop(self, hop: Hop) -> DataFrame:
        """id, next, c, edge: the edges of a hop that may be walked."""
        used = self.edges.where((F.col("rel") == hop.rel) & (F.col("confidence") >= hop.least))
        edge = F.struct("src", "rel", "dst", F.col("confidence").cast("double").alias("confidence")).cast(EDGE).alias("edge")
        out = used.select(F.col("src").alias("id"), F.col("dst").alias("next"), F.col("confidence").alias("c"), edge)
        back = used.select(F.col("dst").alias("id"), F.col("src").alias("next"), F.col("confidence").alias("c"), edge)
        both = out.unionByName(back.where("id <> next")) if hop.rel in self.symmetric else out if hop.way == "out" else back
        if hop.to is not None:
            both = both.where(F.col("next").isin(list(hop.to)))
        if hop.to_type is not None or hop.where:
            fit = self.nodes if hop.to_type is None else self.nodes.where(F.col("type") == hop.to_type)
            for name, tests in hop.where.items():
                fit = fit.where(predicate(F.col(name), tests))
            both = both.join(fit.select(F.col("id").alias("next")), "next", "left_semi")
        return both

    def start(self, type: str | None = None, ids: Sequence[str] | None = None) -> Found:
        rows = self.nodes.where(F.col("type") == type) if ids is None else self.nodes.where(F.col("id").isin(list(ids)))
        return self._then("start", rows.select("id", F.lit(0.0).alias("score"), *map(empty, NONE), F.lit(0).cast("long").alias("n_members")))

    def where(self, name: str, **tests: object) -> Found:
        """Rows whose node passes; the value tested is noted."""
        value = self.nodes.where(predicate(F.col(name), tests)).select("id", F.col(name).cast("string").alias("_value"))
        note = F.struct(F.col("id").alias("entity"), F.lit(name).alias("field"), F.col("_value").alias("value"))
        return self._then("where", self.rows.join(value, "id").withColumn("facets", F.concat("facets", F.array(note).cast(NONE["facets"]))).drop("_value"))

    def chains(self, path: Sequence[Hop]) -> DataFrame:
        """id, chain: the edges of the best walk along a path from each node that has one; at each hop the edge with the greatest confidence, then the smaller id, from which the rest can be walked."""
        rest = None
        for hop in reversed(path):
            ways = self._hop(hop)
            if rest is None:
                ways = ways.withColumn("chain", F.array("edge"))
            else:
                ways = ways.join(rest.select(F.col("id").alias("next"), F.col("chain").alias("after")), "next").withColumn("chain", F.concat(F.array("edge"), "after"))
            rest = ways.groupBy("id").agg(F.min_by("chain", F.struct(-F.col("c"), F.col("next"), F.col("edge"))).alias("chain"))
        return rest

    def require(self, *path: Hop) -> Found:
        """Rows from which a path leads on; its edges are noted."""
        rows = self.rows.join(self.chains(path), "id").withColumn("edges", F.concat("edges", "chain"))
        return self._then("require", rows.drop("chain"))

    def exclude(self, *path: Hop) -> Found:
        return self._then("exclude", self.rows.join(self.chains(path).select("id"), "id", "left_anti"))

    def _met(self, met: DataFrame, carried: Column, by: Column, listed: int, what: Column) -> DataFrame:
        """For each next: the carried value of the least `by`, how many there are, and the first `listed` of `what`. Parts of a node meet first, so that one which all rows lead to is many tasks' work; the rows
        of `met` are read once, as steps are counted where they are read."""
        parts = met.select("next", F.pmod(F.xxhash64("id"), F.lit(PARTS)).alias("part"), F.struct(by.alias("by"), carried.alias("x")).alias("first"), what.alias("w"))
        parts = parts.withColumn("place", F.row_number().over(Window.partitionBy("next", "part").orderBy("w")))
        some = parts.groupBy("next", "part").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n"), F.collect_list(F.when(F.col("place") <= listed, F.col("w"))).alias("ws"))
        whole = some.groupBy("next").agg(F.min("first").alias("first"), F.sum("n").alias("n_members"), F.slice(F.sort_array(F.flatten(F.collect_list("ws"))), 1, listed).alias("listed"))
        return whole.select(F.col("next").alias("id"), "first.x", "n_members", "listed")

    def traverse(self, hop: Hop, exclude_ids: Sequence[str] = ()) -> Found:
        """The nodes that rows lead to, each by its best edge, with how many rows lead there and the first of them."""
        met = self.rows.select("id", "score", "edges", "facets").join(self._hop(hop), "id")
        if exclude_ids:
            met = met.where(~F.col("next").isin(list(exclude_ids)))
        carried = F.struct("score", F.concat("edges", F.array("edge")).alias("edges"), "facets")
        best = self._met(met, carried, F.struct(-F.col("c"), F.col("id"), F.col("edge")), self.members, F.col("id"))
        return self._then("traverse", best.select("id", "x.score", "x.edges", "x.facets", empty("semantic"), F.col("listed").alias("members"), "n_members"))

    def text(self, at: retrieval.Index, terms: Sequence[str], least: float = 0.0, shown: int = 12) -> Found:
        """Scores the rows by the cosine of their documents in an index (doc is the node's id) with a query's terms; the words that they share are noted."""
        asked = self.nodes.sparkSession.createDataFrame([("q", t) for t in terms], "query string, term string")
        scored = retrieval.explained(at, asked, shown).select(F.col("doc").alias("id"), F.col("score").alias("s"), "matched")
        note = F.array(F.struct(F.col("s").alias("score"), F.col("matched").alias("terms"))).cast(NONE["semantic"])
        rows = self.rows.join(scored, "id", "left").withColumn("s", F.coalesce("s", F.lit(0.0))).withColumn("matched", F.coalesce("matched", F.array().cast("array<string>"))).where(F.col("s") >= least)
        return self._then("text", rows.withColumn("semantic", F.concat("semantic", note)).withColumn("score", F.col("s")).drop("s", "matched"))

    def group(self, hop: Hop, least: int = 1, evidence: int = 5) -> Found:
        """Neighbours that at least so many rows share, with the first members and the edges of some of them."""
        met = self.rows.select("id").join(self._hop(hop), "id")
        shared = self._met(met, F.lit(0), F.lit(0), max(evidence, self.members), F.struct("id", "edge")).where(F.col("n_members") >= least)
        edges, members = F.transform(F.slice("listed", 1, evidence), lambda x: x["edge"]), F.transform(F.slice("listed", 1, self.members), lambda x: x["id"])
        rows = shared.select("id", F.col("n_members").cast("double").alias("score"), edges.alias("edges"), empty("facets"), empty("semantic"), members.alias("members"), "n_members")
        return self._then("group", rows)

    def rank(self, by: str = "score") -> Found:
        """By falling score, by id or name, or by a falling attribute whose nulls are zero; then by id. The order is that of the result."""
        return replace(self._then("rank", self.rows), order=by)

    def result(self, limit: int | None = 10) -> DataFrame:
        """id, type, name, score, edges, facets, semantic, members, n_members: the first rows in order, or all without one."""
        about = self.nodes.select("id", "type", "name", *([F.col(self.order).alias("_by")] if self.order not in ("score", "id") else []))
        rows = self.rows.join(about, "id", "left")
        if limit is not None:
            order = {"score": [F.desc("score")], "id": [], "name": ["name"]}.get(self.order)
            rows = rows.orderBy(*(order if order is not None else [F.coalesce(F.col("_by"), F.lit(0)).desc()]), "id").limit(limit)
        return rows.select("id", "type", "name", "score", *NONE, "n_members")

    def trace(self) -> list[tuple[str, int]]:
        """Steps and the rows that each gave, once the result has been read."""
        return [(said, seen.get["rows"]) for said, seen in self.steps]
