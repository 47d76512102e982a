"""Approximate nearest neighbours by learned partitions: a balanced partitioning of a neighbour graph, a classifier that routes, exact reranking.

1. Different vectors are kept once, with the smallest ids of their rows: no more of them than a result has can ever be among a query's nearest.
2. On a bounded sample (the vectors with the smallest hashes) the graph of nearest neighbours is built by Spark; it is halved again and again into cells of equal
   size (the second eigenvector of a part's graph, then swaps as long as fewer edges are cut).
3. A softmax classifier learns, from a vector, in which cells its neighbours lie. It gives every vector of the table its cell, and each query
   the order of its cells.
4. A query visits cells, most probable first, until their probabilities add up to a given mass. The mass is measured, not guessed: for a bounded set of queries the true
   neighbours are found among all rows, and the mass is the least with which `recall` of them lie in visited cells. Where vectors have no structure, it makes queries
   visit most cells: that is slower, never less complete. Cells are also visited until they hold enough rows to fill a result.
5. In a cell all vectors are scored in double precision. Queries and vectors of a cell are dealt into blocks of bounded size, so that a large cell is
   many tasks; nothing in a cell is left out.

Driver and broadcasts hold the sample, the classifier and the measured queries, each bounded by a parameter.

Defined results: vectors that are null, empty, zero, or hold null or non-finite entries take no part, as do those whose length is not the most
common one (ties: the longer); rows with a null id take no part; rows with equal ids and vectors are one row, and a query's own id is never its neighbour; equal scores go by the smaller id;
with fewer candidates than a result has, all are given; an empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.llm.common import fields, stored, table
from millrace.llm.op12_whitening import finite, usual_length


@dataclass(frozen=True)
class Partitions:
    """nearest: rows of a result. sample: vectors of the graph. degree: neighbours of each in it. cell_rows: vectors of a cell, about; most_cells bounds the classifier.
    recall: share of true neighbours in visited cells, over `measured` queries. block: vectors, and queries, that are scored together."""

    nearest: int = 20
    sample: int = 8192
    degree: int = 10
    cell_rows: int = 4096
    most_cells: int = 256
    recall: float = 0.96
    measured: int = 512
    block: int = 4096
    seed: int = 13


def vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v of the rows that take part."""
    rows = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v")).where(F.col("id").isNotNull() & finite(F.col("v")) & F.exists("v", lambda c: c != 0))
    return rows.where(F.size("v") == usual_length(rows, "v"))


def different(rows: DataFrame, nearest: int) -> DataFrame:
    """v, ids: each vector once, with the smallest ids of its rows; one more than a result has, as one may be the query's own."""
    rank = lambda *by: F.dense_rank().over(Window.partitionBy("v", *by).orderBy("id"))
    some = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(32))).withColumn("r", rank("salt")).where(F.col("r") <= nearest + 1).dropDuplicates(["v", "id"])
    some = some.withColumn("r", rank()).where(F.col("r") <= nearest + 1)
    return some.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def stacked(batch: pd.Series) -> np.ndarray:
    return np.stack(batch.to_numpy()).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, even where squares leave the range of doubles."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(spark: SparkSession, x: np.ndarray, degree: int) -> np.ndarray:
    """Edges of a sample, as pairs of numbers: each vector and its nearest others. Tasks take slices of the sample."""
    shared, degree = spark.sparkContext.broadcast(x.astype(np.float32)), min(degree, len(x) - 1)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = shared.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                i = batch["id"].to_numpy()[at : at + 256]
                score = x[i] @ x.T
                score[np.arange(len(i)), i] = -np.inf
                best = np.argpartition(-score, degree - 1, axis=1)[:, :degree]
                yield pd.DataFrame({"i": np.repeat(i, degree), "j": best.ravel()})

    if degree < 1:
        return np.zeros((0, 2), np.int64)
    return spark.range(len(x)).repartition(16).mapInPandas(near, fields("i long, j long")).toPandas().sort_values(["i", "j"]).to_numpy()


def halves(edges: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """The side of each of n nodes: sides of equal size with few edges between them."""
    a, b = edges[:, 0], edges[:, 1]
    degree = np.maximum(1, np.bincount(a, minlength=n) + np.bincount(b, minlength=n))
    v = rng.standard_normal(n)
    for _ in range(40):  # towards the second eigenvector of the walk on the graph
        v = (v + (np.bincount(a, v[b], n) + np.bincount(b, v[a], n)) / degree) / 2
        v -= (v * degree).sum() / degree.sum()
        v /= np.abs(v).max() or 1
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2 :]] = True
    cut = int((side[a] != side[b]).sum())
    share = 1.0
    while share > 0.01:
        apart = (side[a] != side[b]) * 2.0 - 1
        gain = np.bincount(a, apart, n) + np.bincount(b, apart, n)  # edges fewer between the sides if a node changes over
        one, two = (np.flatnonzero(side == s) for s in (False, True))
        one, two = one[np.argsort(-gain[one], kind="stable")], two[np.argsort(-gain[two], kind="stable")]
        m = min(len(one), len(two))
        m = int(((gain[one[:m]] + gain[two[:m]]) > 0).sum() * share)
        if not m:
            break
        tried = side.copy()
        tried[one[:m]], tried[two[:m]] = True, False
        if (now := int((tried[a] != tried[b]).sum())) < cut:
            side, cut = tried, now
        else:
            share /= 2
    return side


def partitioned(edges: np.ndarray, n: int, cells: int, seed: int) -> np.ndarray:
    """A cell for each node of the graph: halved until there are so many (a power of two)."""
    rng, label = np.random.default_rng(seed), np.zeros(n, np.int64)
    parts = 1
    while parts < cells:
        for part in range(parts):
            own = np.flatnonzero(label == part)
            place = np.full(n, -1)
            place[own] = np.arange(len(own))
            inside = place[edges]
            side = halves(inside[(inside >= 0).all(axis=1)], len(own), rng)
            label[own[side]] += parts
        parts *= 2
    return label


@dataclass(frozen=True)
class Router:
    """A softmax over cells of a vector's direction."""

    weights: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = unit(x) @ self.weights[:-1] + self.weights[-1]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def learned(x: np.ndarray, edges: np.ndarray, label: np.ndarray, cells: int, seed: int, rounds: int = 30) -> Router:
    """Learns the share of each cell among a vector and its neighbours."""
    n = len(x)
    want = np.zeros((n, cells))
    np.add.at(want, (edges[:, 0], label[edges[:, 1]]), 1.0)
    want[np.arange(n), label] += 1
    want /= want.sum(axis=1, keepdims=True)
    inputs = np.concatenate([unit(x), np.ones((n, 1))], axis=1)
    rng, w = np.random.default_rng(seed), np.zeros((inputs.shape[1], cells))
    m, s, step = np.zeros_like(w), np.zeros_like(w), 0
    for r in range(rounds):
        for some in np.array_split(rng.permutation(n), max(1, n // 512)):
            z = inputs[some] @ w
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = inputs[some].T @ (z / z.sum(axis=1, keepdims=True) - want[some]) / len(some)
            step += 1
            m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
            w -= 0.1 * (1 - r / rounds) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
    return Router(w)


def best(queries: np.ndarray, own: np.ndarray, x: np.ndarray, ids: list[np.ndarray], nearest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of some vectors the nearest to each query: their ids, scores and numbers. Equal scores go by id; a query's own id is left out."""
    sizes = np.array([len(i) for i in ids])
    flat, first = np.concatenate(ids), np.concatenate([[0], np.cumsum(sizes)])
    for at in range(0, len(queries), 256):
        score = queries[at : at + 256] @ x.T
        keep = nearest + 1
        least = np.partition(score, -keep, axis=1)[:, -keep] if score.shape[1] > keep else np.full(len(score), -np.inf)
        for row, bound, me in zip(score, least, own[at : at + 256], strict=True):
            some = np.flatnonzero(row >= bound)
            number = np.repeat(some, sizes[some])
            some = np.concatenate([flat[first[i] : first[i + 1]] for i in some.tolist()])
            number, some = number[some != me], some[some != me]
            order = np.lexsort((some, -row[number]))[:nearest]
            yield some[order], row[number[order]], number[order]


def index(entries: DataFrame, router: Router) -> DataFrame:
    """cell, v, ids: the most probable cell of each vector."""
    shared = entries.sparkSession.sparkContext.broadcast(router)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cells = np.concatenate([shared.value.probabilities(stacked(batch["v"].iloc[i : i + 4096])).argmax(axis=1) for i in range(0, len(batch), 4096)])
                yield pd.DataFrame({"cell": cells.astype(np.int32), "v": batch["v"], "ids": batch["ids"]})

    return entries.mapInPandas(place, T.StructType([T.StructField("cell", T.IntegerType()), *entries.select("v", "ids").schema]))


def mass(indexed: DataFrame, queries: DataFrame, router: Router, settings: Partitions) -> float:
    """The least probability to be visited with which `recall` of the measured queries' true neighbours are found."""
    some = queries.orderBy(F.xxhash64("id"), "id").limit(settings.measured).toPandas()
    if not len(some):
        return 1.0
    x, own, nearest = stacked(some["v"]), some["id"].to_numpy(), settings.nearest
    shared = indexed.sparkSession.sparkContext.broadcast((x, own))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (x, own), held = shared.value, {}
        for batch in batches:
            for at in range(0, len(batch), settings.block):
                part = batch.iloc[at : at + settings.block]
                cells = part["cell"].to_numpy()
                for q, (ids, score, number) in enumerate(best(x, own, stacked(part["v"]), part["ids"].tolist(), nearest)):
                    a, b, c = held.get(q, (ids[:0], score[:0], cells[:0]))
                    a, b, c = np.concatenate([a, ids]), np.concatenate([b, score]), np.concatenate([c, cells[number]])
                    order = np.lexsort((a, -b))[:nearest]
                    held[q] = a[order], b[order], c[order]
        for q, (ids, score, cells) in held.items():
            yield pd.DataFrame({"q": q, "id": ids, "score": score, "cell": cells})

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    true = indexed.mapInPandas(scan, fields("q long, id long, score double, cell int")).withColumn("r", rank).where(F.col("r") <= nearest).select("q", "cell").toPandas()
    if not len(true):
        return 1.0
    p = router.probabilities(x)[true["q"].to_numpy()]
    before = np.sort(np.where(p > p[np.arange(len(p)), true["cell"].to_numpy()][:, None], p, 0).sum(axis=1))
    return float(before[min(len(before) - 1, int(np.ceil(settings.recall * len(before))) - 1)]) + 1e-9


def routed(queries: DataFrame, router: Router, least: float, held: np.ndarray, nearest: int) -> DataFrame:
    """id, v, cells: the cells that each query visits. held: rows of each cell."""
    shared = queries.sparkSession.sparkContext.broadcast(router)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at : at + 4096]
                p = shared.value.probabilities(stacked(part["v"]))
                order = np.argsort(-p, axis=1, kind="stable")
                sorted_p, rows = np.take_along_axis(p, order, axis=1), held[order]
                go = (np.cumsum(sorted_p, axis=1) - sorted_p < least) | (np.cumsum(rows, axis=1) - rows <= nearest)
                yield pd.DataFrame({"id": part["id"], "v": part["v"], "cells": [o[g & (held[o] > 0)].tolist() for o, g in zip(order, go, strict=True)]})

    return queries.mapInPandas(visit, T.StructType([*queries.select("id", "v").schema, T.StructField("cells", T.ArrayType(T.IntegerType()))]))


def dealt(counts: dict[int, int], size: int) -> Column:
    """The number of blocks of a cell."""
    return F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, max(1, -(-n // size)))])[F.col("cell")] if counts else F.lit(1)


def searched(indexed: DataFrame, visits: DataFrame, settings: Partitions) -> DataFrame:
    """id, near (id and score): a query's nearest in each block of each cell that it visits."""
    tally = lambda frame: {r["cell"]: r["count"] for r in frame.groupBy("cell").count().collect()}  # noqa: E731  one number for each cell
    visits = visits.select("id", "v", F.explode("cells").alias("cell"))
    of_rows, of_queries = dealt(tally(indexed), settings.block), dealt(tally(visits), settings.block)
    deal = lambda own, n, name, other, m, other_name: own.withColumn(name, F.pmod(F.xxhash64("v"), n)).withColumn(other_name, F.explode(F.sequence(F.lit(0), (m - 1).cast("int"))))
    rows = deal(indexed.select("cell", "v", "ids"), of_rows, "rb", indexed, of_queries, "qb")
    asks = visits.withColumn("qb", F.pmod(F.xxhash64("id"), of_queries)).withColumn("rb", F.explode(F.sequence(F.lit(0), (of_rows - 1).cast("int"))))
    by = ["cell", F.col("qb").cast("long").alias("qb"), F.col("rb").cast("long").alias("rb")]

    def score(asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asks) or not len(rows):
            return pd.DataFrame({"id": [], "ids": [], "scores": []})
        found = best(stacked(asks["v"]), asks["id"].to_numpy(), stacked(rows["v"]), rows["ids"].tolist(), settings.nearest)
        made = [(me, ids, scores) for me, (ids, scores, _) in zip(asks["id"], found, strict=True)]
        return pd.DataFrame(made, columns=["id", "ids", "scores"])

    out = T.StructType([*fields("id long, ids longs"), T.StructField("scores", T.ArrayType(T.DoubleType()))])
    return asks.select("id", "v", *by).groupBy("cell", "qb", "rb").cogroup(rows.select("v", "ids", *by).groupBy("cell", "qb", "rb")).applyInPandas(score, out)


def neighbours(rows: DataFrame, chosen: Column, key: str = "vec_id", vector: str = "embedding", settings: Partitions = Partitions()) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of the rows for which chosen (a condition on `id`) holds, among all rows."""
    spark = rows.sparkSession
    rows = vectors(rows, key, vector)
    entries = stored(different(rows, settings.nearest), "entries")
    queries = rows.where(chosen).dropDuplicates(["id", "v"])
    n = entries.count()
    sample = entries.select("v").orderBy(F.xxhash64("v"), F.hash("v"), "v").limit(settings.sample).toPandas()["v"]
    cells = 1
    while cells * settings.cell_rows < max(n, 4 * settings.cell_rows) and cells < settings.most_cells and cells * 32 <= len(sample):
        cells *= 2
    if n:
        x = stacked(sample)
        edges = neighbour_graph(spark, x / np.abs(x).max(), settings.degree)
        router = learned(x, edges, partitioned(edges, len(x), cells, settings.seed), cells, settings.seed)
    else:
        router = Router(np.zeros((2, 1)))
    indexed = stored(index(entries, router), "cells")
    held = np.zeros(cells, np.int64)
    for r in indexed.groupBy("cell").agg(F.sum(F.size("ids")).alias("n")).collect():
        held[r["cell"]] = r["n"]
    visits = stored(routed(queries, router, mass(indexed, queries, router, settings), held, settings.nearest), "visits")
    found = searched(indexed, visits, settings).select("id", F.explode(F.arrays_zip("ids", "scores")).alias("near")).select("id", F.col("near.ids").alias("vec_id"), F.col("near.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= settings.nearest).select(F.col("id").alias("query_id"), "rank", "vec_id", "score")


def op13_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
