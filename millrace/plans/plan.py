"""A retrieval plan: steps that each turn the current rows into new ones, compiled to one lazy DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import graph

KINDS = ("eq", "ne", "in", "gte", "lte", "exists", "contains")


def predicate(column: Column, tests: dict) -> Column:
    """All tests must hold. Null fails gte, lte, in and contains; it passes ne."""
    made = []
    for kind, value in tests.items():
        if kind not in KINDS:
            raise ValueError(f"unknown test {kind!r}; known: {', '.join(KINDS)}")
        if kind == "eq":
            made.append(column.eqNullSafe(F.lit(value)))
        elif kind == "ne":
            made.append(~column.eqNullSafe(F.lit(value)))
        elif kind == "in":
            made.append(F.coalesce(column.isin(list(value)), F.lit(False)))
        elif kind == "exists":
            made.append(column.isNotNull() if value else column.isNull())
        elif kind == "contains":
            made.append(F.coalesce(F.array_contains(column, value), F.lit(False)))
        else:
            made.append(F.coalesce(column >= value if kind == "gte" else column <= value, F.lit(False)))
    return reduce(lambda a, b: a & b, made, F.lit(True))


@dataclass(frozen=True)
class Plan:
    """Plan(nodes, edges).start(...).where(...).require(...).traverse(...).group(...).rank(...).limit(...).frame()"""

    nodes: DataFrame  # id, type and attributes
    edges: DataFrame  # src, rel, dst, confidence
    rows: DataFrame | None = None
    trace: tuple[str, ...] = field(default=())

    def _then(self, rows: DataFrame, said: str) -> Plan:
        return replace(self, rows=rows, trace=(*self.trace, said))

    def _current(self) -> DataFrame:
        if self.rows is None:
            raise ValueError("a plan begins with start()")
        return self.rows

    def start(self, type: str, **tests: dict) -> Plan:
        rows = self.nodes.where(F.col("type") == type)
        for name, test in tests.items():
            rows = rows.where(predicate(F.col(name), test))
        return self._then(rows, f"start {type}")

    def where(self, **tests: dict) -> Plan:
        rows = self._current()
        for name, test in tests.items():
            rows = rows.where(predicate(F.col(name), test))
        return self._then(rows, f"where {', '.join(tests)}")

    def require(self, *path: tuple[str, str]) -> Plan:
        return self._then(graph.require(self._current(), self.edges, list(path)), f"require {path}")

    def exclude(self, *path: tuple[str, str]) -> Plan:
        return self._then(graph.exclude(self._current(), self.edges, list(path)), f"exclude {path}")

    def traverse(self, rel: str, way: str = "out") -> Plan:
        """The neighbours, with the best confidence by which any row reaches them."""
        met = graph.step(self._current().select("id").distinct(), self.edges, rel, way).groupBy("id").agg(F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("n_from"))
        return self._then(self.nodes.join(met, "id"), f"traverse {rel} {way}")

    def group(self, rel: str, way: str, least: int) -> Plan:
        return self._then(self.nodes.join(graph.group_by_neighbour(self._current(), self.edges, rel, way, least), "id"), f"group {rel} {way}")

    def rank(self, by: str) -> Plan:
        """Falling, null as zero, then by id."""
        return self._then(self._current().orderBy(F.coalesce(F.col(by), F.lit(0)).desc(), "id"), f"rank {by}")

    def limit(self, n: int) -> Plan:
        return self._then(self._current().limit(n), f"limit {n}")

    def frame(self) -> DataFrame:
        return self._current()
