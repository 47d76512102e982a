"""Recomputing what has changed, within a budget: rows whose facts and settings are those of the former run are read back, others are worked on, most urgent first, and what the budget does not reach keeps its
former result, marked and dated.

A row's fingerprint is a digest of its canonical facts and of the settings. Rows that were never worked on are always done, as there is nothing to keep; they count against the budget. The most urgent are found by a
bounded top of the due rows, so that no task sees them all.

Defined results: a key that is no longer among the facts leaves; a null fact differs from any other; repeated keys must be resolved before; an empty former state means that all is done; a budget of 0 keeps all that has a former result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.canonical import digest, facts
from millrace.session import checkpointed


def fingerprinted(rows: DataFrame, columns: Sequence[str], settings: str) -> DataFrame:
    return rows.withColumn("fingerprint", digest(F.concat(facts(rows, columns), F.lit("|" + settings)), 24))


def recompute(rows: DataFrame, former: DataFrame, key: str, columns: Sequence[str], settings: str, score: Callable[[DataFrame], DataFrame], now: Column, budget: int) -> DataFrame:
    """The new state: key, what score() adds to the key, fingerprint, evaluated_at, status (new, rescored, unchanged, deferred).

    rows: key and facts. former: the state of the run before, or a frame without rows. score: from rows of facts to rows with the key and results; it sees only rows that are worked on. Most urgent is what was evaluated longest
    ago, then the smaller key."""
    current = fingerprinted(rows, columns, settings)
    known = former.select(F.col(key), F.col("fingerprint").alias("_was"), F.col("evaluated_at").alias("_at"))
    state = checkpointed(current.join(known, key, "left").withColumn("_due", ~F.col("fingerprint").eqNullSafe(F.col("_was"))))
    first = state.where("_due").orderBy(F.col("_at").asc_nulls_first(), key).limit(max(0, budget)).select(key, F.lit(True).alias("_reached"))
    # few rows of keys, but as many as the budget: Spark decides whether they are sent to all
    state = checkpointed(state.join(first, key, "left").withColumn("_status", F.when(F.col("_was").isNull(), "new").when(~F.col("_due"), "unchanged").when(F.col("_reached"), "rescored").otherwise("deferred")))
    worked = state.where(F.col("_status").isin("new", "rescored"))
    facts_of = [c for c in rows.columns if c != key]
    done = score(worked.select(key, *[f"`{c}`" for c in facts_of])).join(worked.select(key, "fingerprint", F.col("_status").alias("status")), key)
    results = [c for c in done.columns if c not in (key, "fingerprint", "status")]
    done = done.select(key, *results, "fingerprint", now.alias("evaluated_at"), "status")
    if not former.columns or set(results) - set(former.columns):
        kept = state.where(F.col("_status").isin("unchanged", "deferred")).limit(0)
        former = kept.select(key, *[F.lit(None).cast(done.schema[c].dataType).alias(c) for c in results], "fingerprint", F.lit(None).cast(done.schema["evaluated_at"].dataType).alias("evaluated_at"))
    rest = state.where(F.col("_status").isin("unchanged", "deferred")).select(key, F.col("_status").alias("status"))
    kept = rest.join(former.drop("status"), key).select(key, *results, "fingerprint", "evaluated_at", "status")
    return done.unionByName(kept)


def tally(state: DataFrame, former: DataFrame, key: str) -> DataFrame:
    """status, n: how many rows of each, and how many keys have left."""
    left = former.join(state, key, "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("removed").alias("status"), "n")
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("n")).unionByName(left)
