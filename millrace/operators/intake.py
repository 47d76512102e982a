"""Intake: what qualifies, what is known already, whose licence holds, and what a run brought."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_family(value: Column, families: Mapping[str, Sequence[str]], wanted: str) -> Column:
    """Whether a value, in any case, belongs to the wanted family. A family that is not listed, and an unknown value, never match."""
    members = [x.lower() for name, xs in families.items() if name.lower() == wanted.lower() for x in xs]
    return F.coalesce(F.lower(value).isin(*members), F.lit(False)) if members else F.lit(False)


def drifted(known: Column, mine: Column, least: int = 3) -> Column:
    """Whether none of the present names is part of a known one, or a known one of it. Names shorter than `least` tell nothing."""
    long = lambda xs: F.filter(xs, lambda x: F.length(x) >= least)
    return ~F.exists(long(mine), lambda m: F.exists(long(known), lambda k: F.contains(m, k) | F.contains(k, m)))


@dataclass(frozen=True)
class Activity:
    """Regular expressions: of automatic authors, documentation, housekeeping, paths that are code in any case, and versions."""

    bots: str
    documents: str
    housekeeping: str
    code: str
    version: str

    def is_code(self, path: Column) -> Column:
        return path.rlike(self.code) | ~(path.rlike(self.documents) | path.rlike(self.housekeeping))

    def is_document(self, path: Column) -> Column:
        return ~path.rlike(self.code) & path.rlike(self.documents)

    def change(self, author: Column, paths: Column) -> Column:
        """Why a change counts as activity or does not."""
        none = paths.isNull() | (F.size(paths) == 0)
        return (
            F.when(F.coalesce(author.rlike(self.bots), F.lit(False)), "automation_author")
            .when(none, "no_paths_observed")
            .when(~F.exists(paths, self.is_code), "documentation_or_housekeeping_only")
            .otherwise("touches_code")
        )

    def release(self, draft: Column, ref: Column, paths: Column) -> Column:
        """Why a release counts or does not: housekeeping may be released, documentation alone not."""
        none = paths.isNull() | (F.size(paths) == 0)
        return (
            F.when(draft, "draft")
            .when(~F.coalesce(F.btrim(ref).rlike(self.version), F.lit(False)), "not_a_version_tag")
            .when(none, "tagged_commit_not_inspected")
            .when(F.forall(paths, self.is_document), "tagged_commit_documentation_only")
            .otherwise("version_release")
        )


def verdict(readings: Sequence[tuple[str, Column]], allowed: Sequence[str], excepted: Column) -> tuple[Column, Column, Column]:
    """licence, method and whether it is usable: the first reading that is allowed decides; else the first reading stands as reported, and only an exception makes it usable."""
    ok = [(name, c, F.coalesce(c.isin(*allowed), F.lit(False))) for name, c in readings]
    licence = F.coalesce(*[F.when(fits, c) for _, c, fits in ok], readings[0][1])
    method = F.coalesce(*[F.when(fits, F.lit(name)) for name, _, fits in ok], F.lit("unrecognised"))
    recognised = ok[0][2]
    for _, _, fits in ok[1:]:
        recognised = recognised | fits
    return licence, method, recognised | excepted


def issue(read: Column, n_files: Column, reported: Column, source_available: Column, open_core: Column, n_markers: Column, claims_open: Column) -> Column:
    """What is wrong with a licence that is not recognised, by precedence."""
    silent = reported.isNull() | (reported == "NOASSERTION")
    return (
        F.when(~read, "undetermined")
        .when((n_files == 0) & silent, "missing")
        .when(source_available, "source_available")
        .when(open_core, "open_core")
        .when(n_markers > 0, "restricted")
        .when(~silent, "non_osi")
        .when(claims_open, "conflicting")
        .otherwise("unrecognised")
    )


def known_before(candidates: DataFrame, corpus: DataFrame, key: str, aliases: str, host: str, host_id: str, id: str) -> DataFrame:
    """candidates with known_id and by (key_or_alias, host_repo_id, or null): the corpus row whose key is the candidate's key or first alias that has one, else the one with its id at its host."""
    names = candidates.select(key, F.posexplode(F.concat(F.array(F.col(key)), F.coalesce(F.col(aliases), F.array().cast("array<string>")))).alias("place", "name"))
    by_key = corpus.groupBy(F.col(key).alias("name")).agg(F.min(id).alias("found"))
    named = names.join(by_key, "name").groupBy(key).agg(F.min_by("found", "place").alias("by_name"))
    by_host = corpus.where(F.col(host_id).isNotNull()).groupBy(host, host_id).agg(F.min(id).alias("by_host"))
    joined = candidates.join(named, key, "left").join(by_host, [host, host_id], "left")
    by = F.when(F.col("by_name").isNotNull(), "key_or_alias").when(F.col("by_host").isNotNull(), "host_repo_id")
    return joined.select(*candidates.columns, F.coalesce("by_name", "by_host").alias("known_id"), by.alias("by"))


def cross_host(rows: DataFrame, slug: str, host: str, id: str, preferred: str) -> DataFrame:
    """alias, primary: rows with the same owner and name on several hosts are one; the primary is that of the preferred host, then the least id."""
    first = F.min(F.struct((F.col(host) != preferred).alias("other"), F.col(id).alias("id"))).alias("first")
    groups = rows.groupBy(slug).agg(F.countDistinct(host).alias("hosts"), first).where("hosts > 1").select(slug, F.col("first.id").alias("primary"))
    return rows.join(groups, slug).where(F.col(id) != F.col("primary")).select(F.col(id).alias("alias"), "primary")


def overlay(previous: DataFrame, light: DataFrame, deep: DataFrame, key: str, whole: Sequence[str], fresh: Sequence[str]) -> DataFrame:
    """One row for each key with a deep or a previous row: the deep row; else the previous one with the light row's fresh columns laid over it, if both were found. Keys that only the light rows have are left out."""
    side = lambda df, name: df.select(key, F.struct(*[c for c in df.columns if c != key]).alias(name))
    both = side(previous, "p").join(side(deep, "d"), key, "full_outer").join(side(light, "l"), key, "left")
    over = F.col("d").isNull() & F.coalesce(F.col("p.found"), F.lit(False)) & F.coalesce(F.col("l.found"), F.lit(False))
    kept = lambda c: F.when(F.col("d").isNotNull(), F.col(f"d.{c}")).otherwise(F.col(f"p.{c}"))
    columns = [F.when(over, F.col(f"l.{c}")).otherwise(kept(c)).alias(c) if c in fresh else kept(c).alias(c) for c in whole]
    return both.select(key, *columns, F.when(F.col("d").isNotNull(), "deep").when(over, "light_over_previous").otherwise("previous").alias("origin"))


def resolved(names: DataFrame, name: str, steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """name, id, step, status. steps: label and a table (name, id). The first step that knows a name decides: found if it has one id for it, ambiguous if several."""
    out, hits = names.select(name).distinct(), []
    for label, table in steps:
        known = table.groupBy(name).agg(F.min("id").alias(f"id_{label}"), (F.min("id") != F.max("id")).alias(f"many_{label}"))
        out = out.join(known, name, "left")
        hits.append(label)
    first = F.coalesce(*[F.when(F.col(f"id_{x}").isNotNull(), F.lit(x)) for x in hits])
    many = F.coalesce(*[F.when(F.col(f"id_{x}").isNotNull(), F.col(f"many_{x}")) for x in hits])
    id = F.coalesce(*[F.col(f"id_{x}") for x in hits])
    status = F.when(many.isNull(), "unknown").when(many, "ambiguous").otherwise("found")
    return out.select(name, F.when(~many, id).alias("id"), first.alias("step"), status.alias("status"))


def floor_then_extend(rows: DataFrame, rank: str, group: str, floor: int, least_groups: int, most_rows: int) -> DataFrame:
    """rank, n_rows and groups so far, chosen: the first `floor` ranks, then further ones in order while fewer than `least_groups` different groups are chosen and the rows stay within `most_rows`."""
    new = rows.groupBy(group).agg(F.min(rank).alias(rank)).groupBy(rank).agg(F.count(F.lit(1)).alias("new"))
    each = rows.groupBy(rank).agg(F.count(F.lit(1)).alias("n")).join(new, rank, "left")
    so_far = Window.orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)  # one row for each rank
    sums = each.select(rank, "n", F.sum("n").over(so_far).alias("n_rows"), F.sum(F.coalesce("new", F.lit(0))).over(so_far).alias("n_groups"))
    before = F.coalesce(F.lag("n_groups").over(Window.orderBy(rank)), F.lit(0))
    chosen = (F.col(rank) <= floor) | ((before < least_groups) & (F.col("n_rows") <= most_rows))
    return sums.select(rank, "n_rows", "n_groups", chosen.alias("chosen"))


def filled(rows: DataFrame, must: Column, order: Sequence[Column], target: int) -> DataFrame:
    """rows with selected_by: must, rank (the best others, until the target is full) or null."""
    n_must = rows.where(must).count()
    if n_must > target:
        raise ValueError(f"{n_must} rows must be included, more than the target of {target}")
    best = rows.where(~must).orderBy(*order).limit(target - n_must).withColumn("selected_by", F.lit("rank"))
    return rows.where(must).withColumn("selected_by", F.lit("must")).unionByName(best)


def served(rows: DataFrame, product: str, group: str, order: Sequence[Column], per_product: int, budget: int) -> DataFrame:
    """Rows in order: the best of each product's group, then as many a product as its cap, then as many in all as the budget."""
    best = rows.withColumn("_g", F.row_number().over(Window.partitionBy(product, group).orderBy(*order))).where("_g = 1")
    capped = best.withColumn("_p", F.row_number().over(Window.partitionBy(product).orderBy(*order))).where(F.col("_p") <= per_product)
    return capped.drop("_g", "_p").orderBy(*order).limit(budget)


def agrees(seen: Column, live: Column, seen_id: Column, live_id: Column, least: float, relative: float) -> Column:
    """Whether an observation agrees with the live record: nothing to compare is no fault of it, a missing or another record is, and so is a difference above the greater of two tolerances."""
    far = F.abs(seen - live) > F.greatest(F.lit(float(least)), relative * live)
    return (
        F.when(seen.isNull(), "not_measured")
        .when(live.isNull(), "live_disagreement")
        .when(seen_id.isNotNull() & live_id.isNotNull() & (seen_id != live_id), "live_identity_mismatch")
        .when(far, "live_disagreement")
        .otherwise("ok")
    )


def end_state(events: DataFrame, key: str, order: str, state: str, terminal: Sequence[str]) -> DataFrame:
    """The state that each entity ends in: events set it in order, until one sets a terminal state, which stays. No entity's events are gathered: the first terminal event is a minimum, and the last one up to it a maximum."""
    ended = events.where(F.col(state).isin(*terminal)).groupBy(key).agg(F.min(order).alias("ended"))
    live = events.join(ended, key, "left").where(F.col("ended").isNull() | (F.col(order) <= F.col("ended")))
    return live.groupBy(key).agg(F.max_by(state, order).alias(state), F.max(order).alias(order), F.count(F.lit(1)).alias("n_events"))


def table_rows(text: Column) -> Column:
    """Rows of Markdown tables: the cells of each line between bars that is neither a ruler nor directly above one; escaped bars stay in their cell."""
    lines = F.split(text, "\n")
    ruler = r"^\s*\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?\s*$"
    # side by side with the lines from the second on: an expression named inside a function of an array is made again for each element
    numbered = F.zip_with(lines, F.slice(lines, 2, F.size(lines)), lambda x, y: F.struct(x.alias("line"), F.coalesce(y, F.lit("")).alias("next")))
    rows = F.filter(numbered, lambda x: x["line"].rlike(r"^\s*\|.*\|\s*$") & ~x["line"].rlike(ruler) & ~x["next"].rlike(ruler))
    cells = lambda line: F.split(F.regexp_replace(line, r"^\s*\||\|\s*$", ""), r"(?<!\\)\|")
    return F.transform(rows, lambda x: F.transform(cells(x["line"]), lambda c: F.replace(F.btrim(c), F.lit("\\|"), F.lit("|"))))
