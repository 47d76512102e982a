"""Embedding whitening by a distributed singular value decomposition.

Entries become whole numbers, x = floor(scale c). The fit list has each different x once (equal vectors meet in partial sums, so that a hot vector is one
row for each task). Per-dimension sums over it are exact; MLlib's computeSVD gets its rows centred, and a singular value s belongs to the eigenvalue s*s/n of
the covariance with divisor n. The total variance does not come from the decomposition: it is the sum of exact whole-number deviations
(n x - S)^2, divided once. Every row is then projected on the first components and divided by the roots of their eigenvalues.

What comes to the driver has the size of a vector, of a square of it (the decomposition of d dimensions is one d by d matrix), or is one number for each task.

Defined results: vectors that are null or hold null or non-finite entries are dropped, as are those whose length is not the table's most common one (ties: the longer), such as
empty ones; other rows are all returned, repeated rows and null ids as they are. A component whose eigenvalue is under `least` of the first one is
noise and is not returned: fewer than `components` rows for each vector, and none where all vectors are equal or the table is empty. A deviation that does not fit a long
is null. x beyond a long is the nearest long. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import fields, stored, table


@dataclass(frozen=True)
class Whitening:
    """components: how many are returned. scale: units of an entry. least: share of the first eigenvalue under which one counts as zero."""

    components: int = 4
    scale: float = 256.0
    least: float = 1e-10


def finite(vector: Column) -> Column:
    """Whether a vector is there and has only finite entries."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The most common length of a vector, 0 without any."""
    found = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return found[0]["d"] if found else 0


def whole(rows: DataFrame, key: str, vector: str, scale: float) -> tuple[DataFrame, int]:
    """key and x of the rows that count, and their dimensions."""
    rows = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("v")).where(finite(F.col("v")) & (F.size("v") > 0))
    d = usual_length(rows, "v")
    return rows.where(F.size("v") == d).select("key", F.transform("v", lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("x")), d


@dataclass(frozen=True)
class Fit:
    """Of the fit list: its rows, the exact sums of each dimension, and the exact sum of all deviations."""

    n: int
    sums: list[int]
    deviations: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: longs where they and their squares' sums fit, else Python's whole numbers."""
        bound = self.n * max(1, int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + max(map(abs, self.sums))
        if len(self.sums) * bound * bound < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.raw(x) / self.n).astype(np.float64)

    @property
    def trace(self) -> float:
        """The total variance: deviations are n*n times too large for each of n rows."""
        return self.deviations / self.n**3


def fitted(fit: DataFrame, d: int) -> Fit:
    """Exact sums in the tasks, then over tasks."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                safe = int(np.abs(x.astype(np.float64)).max()) * len(x) < 1 << 62
                total = total + (x if safe else x.astype(object)).sum(axis=0).astype(object)
                n += len(x)
        yield pd.DataFrame({"i": range(d + 1), "s": [str(v) for v in [*total, n]]})

    kind = "decimal(38,0)"
    parts = fit.mapInPandas(add, fields("i int, s string")).groupBy("i").agg(F.sum(F.col("s").cast(kind)).cast(kind).alias("s"))
    found = {r["i"]: int(r["s"]) for r in parts.collect()}
    known = Fit(found.get(d, 0), [found.get(i, 0) for i in range(d)], 0)
    if not known.n:
        return known

    def deviate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = sum(int((known.raw(np.stack(batch["x"].to_numpy())).astype(object) ** 2).sum()) for batch in batches if len(batch))
        yield pd.DataFrame({"s": [str(total)]})

    return Fit(known.n, known.sums, sum(int(r["s"]) for r in fit.mapInPandas(deviate, fields("s string")).toLocalIterator()))


def decomposed(fit: DataFrame, known: Fit, whitening: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the covariance, falling, and their unit vectors as columns: MLlib's decomposition of the centred rows, in the JVM throughout."""
    mean = F.array(*[F.lit(s / known.n) for s in known.sums])
    rows = fit.select(array_to_vector(F.zip_with("x", mean, lambda x, m: x.cast("double") - m)).alias("row"))
    svd = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "row"), known.n, len(known.sums)).computeSVD(len(known.sums), False, whitening.least**0.5)
    e = svd.s.toArray() ** 2 / known.n
    kept = (e > 0) & (np.arange(len(e)) < whitening.components)
    return e[kept], svd.V.toArray()[:, : len(e)][:, kept]


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", whitening: Whitening = Whitening()) -> DataFrame:
    """The key column, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    kind = rows.select(F.col(f"`{key}`")).schema[0].dataType
    out = T.StructType([T.StructField(key, kind), *fields("component int, n long, deviation long, whitened double, explained double, identity_error double")])
    x, d = whole(rows, key, vector, whitening.scale)
    fit = stored(x.select("x").distinct(), "fit")
    known = fitted(fit, d)
    if not known.deviations:
        return rows.sparkSession.createDataFrame([], out)
    e, v = decomposed(fit, known, whitening)
    turn = v / np.sqrt(e)
    k = len(e)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if len(batch):
                w = known.centred(np.stack(batch["x"].to_numpy())) @ turn
                total += np.concatenate([w.sum(axis=0)[None], w.T @ w])
        yield pd.DataFrame({"i": range(total.size), "s": total.ravel()})

    found = {r["i"]: r["s"] for r in fit.mapInPandas(moments, fields("i int, s double")).groupBy("i").agg(F.sum("s").alias("s")).collect()}
    total = np.array([found[i] for i in range((k + 1) * k)]).reshape(k + 1, k) / known.n
    error = float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())
    share = e / known.trace

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch.iloc[at : at + 1000]
                raw = known.raw(np.stack(some["x"].to_numpy()))
                deviation = pd.array([n if n < 1 << 63 else None for n in (raw**2).sum(axis=1).tolist()], "Int64")
                w = (raw / known.n).astype(np.float64) @ turn
                for i in range(k):
                    yield pd.DataFrame({key: some["key"], "component": i + 1, "n": known.n, "deviation": deviation, "whitened": w[:, i], "explained": share[i], "identity_error": error})

    return x.mapInPandas(project, out)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
