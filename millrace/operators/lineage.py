"""A chain of versions that can be checked: each version's digest is made anew from its rows, links are held against the version before, and changes between versions get a cause.

A part's digest is the number of its rows and the sum of whole numbers cut from their hashes. It does not depend on the order of rows, is summed in the tasks, and differs if a row is added, lost or altered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.canonical import facts


def row_number_of(text: Column) -> Column:
    """60 bits of a text's SHA-256 as a number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(20,0)")


def parts(rows: DataFrame, version: str, part: str, text: Column | None = None) -> DataFrame:
    """version, part, n, digest: of each part of each version. text: what a row says; all its other columns in canonical form, if not given."""
    if text is None:
        text = facts(rows, [c for c in rows.columns if c not in (version, part)])
    summed = rows.select(F.col(version).alias("version"), F.col(part).alias("part"), row_number_of(text).alias("x")).groupBy("version", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("x").cast("decimal(38,0)").alias("x"))
    return summed.select("version", "part", "n", F.sha2(F.concat_ws(":", "n", F.col("x").cast("string")), 256).alias("digest"))


def versions(of_parts: DataFrame) -> DataFrame:
    """version, n, digest of whole versions, from their parts' names and digests in order."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("part", "digest"))), lambda p: F.concat_ws("=", p["part"], p["digest"]))
    return of_parts.groupBy("version").agg(F.sum("n").alias("n"), F.sha2(F.array_join(lines, "\n"), 256).alias("digest"))


def verified(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """recorded: seq, version, replaces, n, digest as each version says; found: versions() of the rows. seq, version, ok, problems, and sound: whether no version up to this one has a problem."""
    before = recorded.select((F.col("seq") + 1).alias("seq"), F.col("version").alias("before"))
    held = recorded.join(found.select("version", F.col("n").alias("n_found"), F.col("digest").alias("digest_found")), "version", "left").join(before, "seq", "left")
    tests = [
        ("rows are missing", F.col("digest_found").isNull()),
        ("digest is not that of the rows", F.col("digest") != F.col("digest_found")),
        ("count is not that of the rows", F.col("n") != F.col("n_found")),
        ("replaces another version than the one before", ~F.col("replaces").eqNullSafe(F.col("before"))),
    ]
    held = held.withColumn("problems", F.array_compact(F.array(*[F.when(wrong, F.lit(name)) for name, wrong in tests]))).withColumn("ok", F.size("problems") == 0)
    first = held.where("not ok").agg(F.min("seq").alias("first_break"))
    return held.crossJoin(F.broadcast(first)).select("seq", "version", "ok", "problems", (F.col("first_break").isNull() | (F.col("seq") < F.col("first_break"))).alias("sound"))


def altered(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """version, part: the parts that are not what was recorded. Both: parts()."""
    both = recorded.select("version", "part", F.col("digest").alias("was")).join(found.select("version", "part", F.col("digest").alias("now")), ["version", "part"], "full_outer")
    kind = F.when(F.col("now").isNull(), "lost").when(F.col("was").isNull(), "added").when(F.col("was") != F.col("now"), "altered")
    return both.withColumn("what", kind).where("what is not null").select("version", "part", "what")


def reconciled(before: DataFrame, after: DataFrame, key: str, member: str, left: Sequence[tuple[str, Column]], joined: Sequence[tuple[str, Column]]) -> DataFrame:
    """key, change (removed or added) and cause of each key that only one of two states has as a member. Both: key, member (a boolean), and what causes speak of; conditions name columns of the states as `before.x` and
    `after.x`; the first that holds is the cause, and `other` if none does. A key that a state does not know has nulls there."""
    both = before.alias("before").join(after.alias("after"), F.col(f"before.{key}") == F.col(f"after.{key}"), "full_outer")
    was, now = (F.coalesce(F.col(f"{side}.{member}"), F.lit(False)) for side in ("before", "after"))

    def first(causes: Sequence[tuple[str, Column]]) -> Column:
        return F.coalesce(*[F.when(when, F.lit(name)) for name, when in causes], F.lit("other"))

    change = F.when(was & ~now, "removed").when(~was & now, "added")
    return both.where(was != now).select(F.coalesce(f"before.{key}", f"after.{key}").alias(key), change.alias("change"), F.when(was, first(left)).otherwise(first(joined)).alias("cause"))
