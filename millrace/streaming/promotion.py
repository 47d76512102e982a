"""Batches merged into a versioned table: a version is written whole, checked, and only then becomes the current one.

A table is a folder with `versions`, one folder for each attempt to write one, and `log`, a small table with a row for each promotion. A row of the log is added by one committed write after
the version is complete, so that readers see the former version or the new one, and a run that stops in between leaves a folder that nothing points to. A batch id that is in the log
is not applied again. Going back is a promotion of an earlier version.

One writer at a time, as a streaming query is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

LOG = "version long, batch long, path string, rows long, status string"


class CheckFailed(Exception):
    """A version that a check refuses."""


@dataclass(frozen=True)
class Versioned:
    """A table of one schema under a folder that the driver and all executors share."""

    spark: SparkSession
    folder: str
    schema: T.StructType

    def log(self) -> DataFrame:
        """version, batch, path, rows, status of every promotion; empty before the first."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/log")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(LOG).parquet(f"{self.folder}/log") if there else self.spark.createDataFrame([], LOG)

    def version(self, number: int | None = None) -> T.Row | None:
        rows = self.log() if number is None else self.log().where(F.col("version") == number)
        return next(iter(rows.orderBy(F.desc("version")).limit(1).collect()), None)

    def current(self, number: int | None = None) -> DataFrame:
        """The rows of the current or of a named version; none before the first."""
        at = self.version(number)
        return self.spark.read.schema(self.schema).parquet(at["path"]) if at else self.spark.createDataFrame([], self.schema)

    def _promote(self, batch: int, path: str, rows: int, status: str) -> None:
        number = (at["version"] if (at := self.version()) else 0) + 1
        self.spark.createDataFrame([(number, batch, path, rows, status)], LOG).coalesce(1).write.mode("append").parquet(f"{self.folder}/log")

    def apply(self, batch: DataFrame, batch_id: int, step: Callable[[DataFrame, DataFrame], DataFrame], check: Callable[[DataFrame], Column] | None = None) -> str:
        """Makes a version of step(batch, current) and promotes it: promoted, or replayed for a batch that is in the log. check: a condition that all rows must meet; else CheckFailed, and nothing is promoted."""
        if self.log().where((F.col("batch") == batch_id) & (F.col("status") == "promoted")).limit(1).count():
            return "replayed"
        path = f"{self.folder}/versions/batch={batch_id}-{uuid.uuid4().hex}"
        made = step(batch, self.current()).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema])
        made.write.parquet(path)
        written = self.spark.read.schema(self.schema).parquet(path)
        rows, bad = written.agg(F.count(F.lit(1)), F.count_if(~F.coalesce(check(written), F.lit(False))) if check else F.lit(0)).first()
        if bad:
            raise CheckFailed(f"batch {batch_id}: {bad} of {rows} rows of {path} fail their check")
        self._promote(batch_id, path, rows, "promoted")
        return "promoted"

    def restore(self, number: int) -> None:
        """Makes an earlier version the current one."""
        at = self.version(number)
        if at is None:
            raise ValueError(f"no version {number}")
        self._promote(at["batch"], at["path"], at["rows"], "restored")

    def superseded(self, keep: int) -> list[str]:
        """Folders of versions that none of the last `keep` promotions points to."""
        kept = self.log().orderBy(F.desc("version")).limit(keep).select("path")
        return [r["path"] for r in self.log().select("path").distinct().join(kept, "path", "left_anti").orderBy("path").collect()]

    def stream(self, rows: DataFrame, checkpoint: str, step: Callable[[DataFrame, DataFrame], DataFrame], check: Callable[[DataFrame], Column] | None = None) -> StreamingQuery:
        """Every batch of a stream, as apply(): a batch that is run again after a failure is applied once."""
        return rows.writeStream.foreachBatch(lambda batch, id: self.apply(batch, id, step, check) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def assessed(batch: DataFrame, well_formed: Column, assess: Callable[[dict], dict], out: T.StructType) -> DataFrame:
    """The batch's columns, outcome, reason, and out (a struct; null unless the outcome is `done`): an item that is not well formed is skipped, one whose assessment fails gets the error's name, and no item stops another."""
    kept, names = batch.columns, [f.name for f in out]
    schema = T.StructType([*batch.schema, T.StructField("outcome", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("out", out)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            made = []
            for item, good in zip(part[kept].to_dict("records"), part["_good"], strict=True):
                if not good:
                    made.append(("skipped", "item_malformed", None))
                    continue
                try:
                    found = assess(item)
                    made.append(("done", None, {n: found.get(n) for n in names}))
                except Exception as error:  # isolation: the row says what went wrong, and the item can be tried again
                    made.append(("error", type(error).__name__, None))
            part = part[kept].reset_index(drop=True)
            yield pd.concat([part, pd.DataFrame(made, columns=["outcome", "reason", "out"])], axis=1)

    return batch.withColumn("_good", F.coalesce(well_formed, F.lit(False))).mapInPandas(run, schema)


def newest_by(keys: Sequence[str], order: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A step: rows of the batch and the current ones, for each key the one with the greatest order. In whatever order batches come, the outcome is the same."""

    def step(batch: DataFrame, current: DataFrame) -> DataFrame:
        both = current.unionByName(batch.select(*current.columns))
        whole = F.struct(*order, *[c for c in both.columns if c not in order and c not in keys])
        return both.groupBy(*keys).agg(F.max(whole).alias("x")).select(*keys, "x.*").select(*current.columns)

    return step
