"""Keyed state of streams by transformWithState: mentions with their readings, and entities that are tried until they end.

State is kept so that the outcome does not depend on the order in which records arrive: readings are a set of which the first and the latest stay, and an entity's outcomes are folded in the order of their own times. Each
processor has a batch twin over a plain DataFrame, which says the same of all records at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: transformWithState needs this store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

MENTION = "source string, item long, at long, points double, n_readings int, readings array<struct<at:bigint,points:double>>"


class Mentions(StatefulProcessor):
    """For each source and item: the newest reading, and the first and the latest `keep` - 1 of all. A mention that the watermark has left behind by `retain` days is forgotten."""

    def __init__(self, keep: int = 8, retain: float = 30.0) -> None:
        self.keep, self.retain = keep, int(retain * 86_400_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = handle.getMapState("readings", "at long", "points double")
        self.timer = handle.getValueState("timer", "ms long")

    def handleInputRows(self, key: tuple, rows: Iterable[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        held = {k[0]: v[0] for k, v in self.readings.iterator()} if self.readings.exists() else {}
        before = dict(held)
        for batch in rows:
            for at, points in zip(batch["at"], batch["points"], strict=True):
                held[int(at)] = max(held.get(int(at), float("-inf")), float(points))
        order = sorted(held)
        # what is neither the first nor among the latest now will not be later
        kept = order if len(order) <= self.keep else [order[0], *order[len(order) - self.keep + 1 :]]
        for at in set(before) - set(kept):
            self.readings.removeKey((at,))
        for at in kept:
            if before.get(at) != held[at]:
                self.readings.updateValue((at,), (held[at],))
        ms = kept[-1] // 1000 + self.retain
        if not self.timer.exists() or self.timer.get()[0] < ms:
            if self.timer.exists():
                self.handle.deleteTimer(self.timer.get()[0])
            self.timer.update((ms,))
            self.handle.registerTimer(ms)
        newest = kept[-1]
        yield pd.DataFrame([(key[0], key[1], newest, held[newest], len(kept), [{"at": a, "points": held[a]} for a in kept])], columns=["source", "item", "at", "points", "n_readings", "readings"])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        self.readings.clear()
        self.timer.clear()
        yield pd.DataFrame(columns=["source", "item", "at", "points", "n_readings", "readings"])

    def close(self) -> None:
        pass


def mentions_of(rows: DataFrame, keep: int = 8) -> DataFrame:
    """The batch twin: rows of source, item, at (microseconds), points."""
    once = rows.groupBy("source", "item", "at").agg(F.max("points").alias("points"))
    listed = once.groupBy("source", "item").agg(F.array_sort(F.collect_list(F.struct("at", "points"))).alias("all"))
    kept = F.when(F.size("all") <= keep, F.col("all")).otherwise(F.concat(F.slice("all", 1, 1), F.slice("all", -(keep - 1), keep - 1)))
    last = F.element_at("readings", -1)
    return listed.withColumn("readings", kept).select("source", "item", last["at"].alias("at"), last["points"].alias("points"), F.size("readings").alias("n_readings"), "readings")


ENTITY = "id long, state string, attempts int, n_outcomes int, at long"
#: What an outcome makes of an entity; `failed` is tried again, up to the number of attempts.
STATE_OF = {"queued": "queued", "accepted": "accepted", "canonical": "canonical", "rejected": "rejected", "held": "held", "known": "already_known"}
ENDS = frozenset(("canonical", "rejected", "held", "already_known", "dead_letter"))


def folded(outcomes: Iterable[tuple[int, str]], attempts: int = 3) -> tuple[str, int, int, int]:
    """state, attempts, outcomes read, time of the last one: outcomes in the order of their times, up to the one that ends the entity."""
    state, tried, n, last = "received", 0, 0, 0
    for at, outcome in sorted(outcomes):
        n, last = n + 1, at
        if outcome == "failed":
            tried += 1
            state = "dead_letter" if tried >= attempts else "failed_retry"
        else:
            state = STATE_OF.get(outcome, state)
        if state in ENDS:
            break
    return state, tried, n, last


class Entities(StatefulProcessor):
    """An entity's outcomes up to the one that ends it, and what they make of it."""

    def __init__(self, attempts: int = 3) -> None:
        self.attempts = attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.outcomes = handle.getListState("outcomes", "at long, outcome string")

    def handleInputRows(self, key: tuple, rows: Iterable[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        held = [(int(a), o) for a, o in self.outcomes.get()] if self.outcomes.exists() else []
        for batch in rows:
            held += [(int(a), o) for a, o in zip(batch["at"], batch["outcome"], strict=True)]
        state, tried, n, last = folded(held, self.attempts)
        # later outcomes than the one that ends an entity will never be read
        self.outcomes.put(sorted(held)[:n] if state in ENDS else sorted(held))
        yield pd.DataFrame([(key[0], state, tried, n, last)], columns=["id", "state", "attempts", "n_outcomes", "at"])

    def close(self) -> None:
        pass


def entities_of(rows: DataFrame, attempts: int = 3) -> DataFrame:
    """The batch twin: rows of id, at, outcome, folded by expressions."""
    ends = F.col("outcome").isin([o for o, s in STATE_OF.items() if s in ENDS])
    order = Window.partitionBy("id").orderBy("at", "outcome")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = rows.withColumn("tried", F.count_if(F.col("outcome") == "failed").over(so_far)).withColumn("end", ends | ((F.col("outcome") == "failed") & (F.col("tried") >= attempts)))
    known = known.withColumn("ended", F.coalesce(F.count_if("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("ended = 0")
    made = F.when(F.col("outcome") == "failed", F.when(F.col("tried") >= attempts, "dead_letter").otherwise("failed_retry"))
    for outcome, state in STATE_OF.items():
        made = made.when(F.col("outcome") == outcome, state)
    last = F.max_by(F.struct(made.alias("state"), "at"), F.struct("at", "outcome")).alias("x")
    return known.groupBy("id").agg(last, F.max("tried").cast("int").alias("attempts"), F.count(F.lit(1)).cast("int").alias("n_outcomes")).select("id", "x.state", "attempts", "n_outcomes", "x.at")


@contextmanager
def store(spark: SparkSession) -> Iterator[None]:
    """The state store that these processors need, for queries that begin inside the block."""
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        yield
    finally:
        spark.conf.unset(STORE[0]) if before is None else spark.conf.set(STORE[0], before)


def transformed(rows: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str | T.StructType, event_time: bool = False) -> DataFrame:
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "Update", "EventTime" if event_time else "None")


def mentions(rows: DataFrame, keep: int = 8, retain: float = 30.0, late: str = "1 day") -> DataFrame:
    """The updates of a stream of source, item, at (microseconds after 1970), points."""
    timed = rows.withColumn("ts", F.timestamp_micros("at")).withWatermark("ts", late)
    return transformed(timed, ["source", "item"], Mentions(keep, retain), MENTION, True)


def entities(rows: DataFrame, attempts: int = 3) -> DataFrame:
    """The updates of a stream of id, at, outcome."""
    return transformed(rows, ["id"], Entities(attempts), ENTITY)


def into(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Every update as Parquet, in a folder for each batch; the newest of a key is its state."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")  # a batch that is run again replaces its own folder

    with store(rows.sparkSession):
        return rows.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest(spark: SparkSession, path: str, keys: list[str], schema: str) -> DataFrame:
    """The last update of each key."""
    rows = spark.read.schema(f"{schema}, batch int").option("basePath", path).parquet(f"{path}/batch=*")
    names = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*names), "batch").alias("x")).select(*keys, "x.*")
