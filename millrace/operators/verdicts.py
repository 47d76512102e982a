"""Statuses with their reasons: flags with evidence, catalogue states, what a link stands for, demand, names, notes, lookups that are due, calibration, and answers that are checked again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text


def flags(rules: Sequence[tuple[str, Column, Column, Column]]) -> Column:
    """id, detail and evidence of each rule (id, whether it holds, detail, evidence) that holds, in the order of the rules. Unknown facts hold for none."""
    made = [F.when(when, F.struct(F.lit(id).alias("id"), detail.cast("string").alias("detail"), evidence.cast("string").alias("evidence"))) for id, when, detail, evidence in rules]
    return F.array_compact(F.array(*made))


#: Evidence that explains a missing recommendation, in the order in which it is given.
EVIDENCE = (("awaiting", "awaiting_full_evaluation"), ("not_recommended", "evaluated_not_recommended"), ("outside_launch", "outside_launch_selection"), ("share_alike_only", "share_alike_only"), ("licence_review", "licence_review"))


def catalogue_status(recommended: Column, minimum: int, evidence: dict[str, Column], candidates: Column, job_defined: Column) -> tuple[Column, Column]:
    """ok, partial or none_yet, and the ordered reasons. evidence: counts by the names in EVIDENCE; null counts as none."""
    has = {k: F.coalesce(evidence[k] > 0, F.lit(False)) for k, _ in EVIDENCE}
    enough, some = recommended >= minimum, recommended > 0
    nothing = reduce(lambda a, b: a & b, [~h for h in has.values()])
    reasons = F.array_compact(
        F.array(
            F.when(some, "fewer_than_minimum"), *[F.when(has[k], code) for k, code in EVIDENCE], F.when(~F.coalesce(job_defined, F.lit(False)), "no_job_definition"),
            F.when(~some & F.coalesce(candidates > 0, F.lit(False)) & nothing, "corpus_candidates_only"),
        )
    )
    reasons = F.when(enough, F.array(F.lit("full_evaluation"))).when(F.size(reasons) == 0, F.array(F.lit("no_relationship_evidence"))).otherwise(reasons)
    return F.when(enough, "ok").when(some, "partial").otherwise("none_yet"), reasons


def resolved(links: DataFrame, lookups: DataFrame, corpus: DataFrame, pool: DataFrame) -> DataFrame:
    """link, key, status, reason: the one entity behind each link. A corpus entry by the link, by the name it was resolved to or by the host's number of it; else one of the pool in the same ways; else what the lookup said.

    links: link (host/owner/name). lookups: link, found, name, number, answer. corpus: name, host, number, id, canonical (boolean). pool: name, host, number, id."""

    def known(of: DataFrame, extra: list[str]) -> tuple[DataFrame, DataFrame]:
        value = F.struct("id", *extra)
        by_name = of.where("name is not null").groupBy("name").agg(F.min(value).alias("v"))
        return by_name, of.where("number is not null").groupBy("host", "number").agg(F.min(value).alias("v"))

    host = F.substring_index("link", "/", 1)
    rows = links.select("link").distinct().join(lookups.select("link", "found", F.lower("name").alias("said"), "number", "answer"), "link", "left").withColumn("host", host).withColumn("full", F.concat("host", F.lit("/"), "said"))
    for side, of, extra in (("c", corpus, ["canonical"]), ("p", pool, [])):
        by_name, by_number = known(of, extra)
        rows = rows.join(by_name.select(F.col("name").alias("link"), F.col("v").alias(f"{side}1")), "link", "left").join(by_name.select(F.col("name").alias("full"), F.col("v").alias(f"{side}2")), "full", "left")
        rows = rows.join(by_number.withColumnRenamed("v", f"{side}3"), ["host", "number"], "left").withColumn(side, F.coalesce(f"{side}1", f"{side}2", f"{side}3"))
    held, pooled, looked = F.col("c").isNotNull(), F.col("p").isNotNull(), F.col("found").isNotNull()
    status = F.when(held, F.when(F.col("c.canonical"), "canonical").otherwise("corpus")).when(pooled, "candidate").when(~F.coalesce("found", F.lit(True)), "not_found").otherwise("unresolved")
    reason = (
        F.when(held, F.when(F.col("c.canonical"), "in the canonical dataset").otherwise("in the corpus, not in the canonical dataset")).when(pooled, "in the discovery pool")
        .when(~F.coalesce("found", F.lit(True)), F.concat(F.lit("the host answered "), F.col("answer").cast("string"))).when(looked, "resolved, not admitted to the pool").otherwise("not yet resolved")
    )
    key = F.coalesce("c.id", "p.id", F.when(F.coalesce("found", F.lit(False)), F.col("full")), "link")
    return rows.select("link", key.alias("key"), status.alias("status"), reason.alias("reason"))


def phrase_key(x: Column) -> Column:
    """Lower case without what stands in brackets, hyphens as spaces."""
    x = F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"\([^)]*\)", " ")
    return F.btrim(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "[^a-z0-9.+&!' -]", " "), "-", " "), r"\s+", " "))


def demand(keywords: DataFrame, names: DataFrame, modifiers: Sequence[str]) -> DataFrame:
    """id, volume, n_keywords: demand of each name by the keywords of one report that are about it. A keyword counts if it has a modifier and volume, and the longest name in it, as whole words, is one id's alone; a keyword given twice
    counts with its greatest volume. keywords: keyword, volume; names: id, name. Names meet keywords by runs of words, not by containment."""
    said = keywords.select(phrase_key(F.col("keyword")).alias("k"), "volume").where("volume >= 0")
    padded = F.concat(F.lit(" "), "k", F.lit(" "))
    said = said.where(reduce(lambda a, b: a | b, [F.contains(padded, F.lit(f" {m.lower().replace('-', ' ')} ")) for m in modifiers])).groupBy("k").agg(F.max("volume").alias("volume"))
    keys = names.select("id", phrase_key(F.col("name")).alias("name")).where(F.length(F.regexp_replace("name", "[^a-z0-9]", "")) >= 3).groupBy("name").agg(F.min("id").alias("id"), F.countDistinct("id").alias("n"))
    words = said.withColumn("w", F.split("k", " "))
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.transform(F.sequence(i, F.size("w")), lambda j: F.array_join(F.slice("w", i, j - i + 1), " "))))
    met = words.select("k", "volume", F.explode(F.array_distinct(runs)).alias("name")).join(keys, "name")
    longest = met.withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy(F.desc(F.length("name")), "name"))).where("place = 1 and n = 1")
    return longest.groupBy("id").agg(F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("n_keywords"))


def total_demand(reports: DataFrame, covered: DataFrame, ids: DataFrame) -> DataFrame:
    """id, volume: reports of different markets add up. An id that no report could have found has no figure (null); one that was covered and not asked for has 0. reports: id, volume; covered, ids: id."""
    sums = reports.groupBy("id").agg(F.sum("volume").alias("volume"))
    seen = covered.select("id").unionByName(reports.select("id")).distinct().withColumn("seen", F.lit(True))
    return ids.select("id").distinct().join(seen, "id", "left").join(sums, "id", "left").select("id", F.when(F.col("seen"), F.coalesce("volume", F.lit(0))).alias("volume"))


def display_names(names: DataFrame) -> DataFrame:
    """id, name: for each id (host/owner/repository) the spelling that is the repository's or owner's own name, else one without brackets, slashes and plus signs, else any; each by source priority. names: id, priority, name."""
    parts = F.split("id", "/")
    own = text.name_key(F.col("name")).isin(text.name_key(F.element_at(parts, -1)), text.name_key(F.element_at(parts, 2)))
    kind = F.when(own, 0).when(~F.col("name").rlike(r"[+(/]"), 1).otherwise(2)
    return names.groupBy("id").agg(F.min_by("name", F.struct(kind, F.col("priority"), F.col("name"))).alias("name"))


def note(dimensions: Sequence[tuple[str, str, Column]], strong: float, weak: float) -> tuple[Column, Column, Column]:
    """The two strongest dimensions at `strong` or above, the two weakest below `weak`, and a sentence of them; null if there are none. dimensions: key, label, value (null where it is unknown)."""
    held = F.array(*[F.struct(v.cast("double").alias("v"), F.lit(k).alias("k"), F.lit(label).alias("label")) for k, label, v in dimensions])
    top = F.slice(F.array_sort(F.transform(F.filter(held, lambda x: x["v"] >= strong), lambda x: F.struct((-x["v"]).alias("v"), x["k"].alias("k"), x["label"].alias("label")))), 1, 2)
    low = F.slice(F.array_sort(F.filter(held, lambda x: x["v"] < weak)), 1, 2)
    top, low = F.transform(top, lambda x: x["label"]), F.transform(low, lambda x: x["label"])
    best = F.when(F.size(top) > 0, F.concat(F.lit("strongest on "), F.array_join(top, " and ")))
    worst = F.when(F.size(low) > 0, F.concat(F.lit("weakest on "), F.array_join(low, " and ")))
    said = F.concat_ws("; ", best, worst)
    return top, low, F.when(said != "", F.concat(F.upper(F.substring(said, 1, 1)), F.substr(said, F.lit(2)), F.lit(".")))


def due(rows: DataFrame, readings: DataFrame, now: Column, most_days: float, budget: int) -> DataFrame:
    """key, observed_at, state (fresh, asked, deferred): keys without a reading younger than `most_days` are asked for in order of strength, as many as the budget allows. rows: key, strength; readings: key, observed_at."""
    last = readings.groupBy("key").agg(F.max("observed_at").alias("observed_at"))
    ranked = rows.groupBy("key").agg(F.max("strength").alias("strength")).join(last, "key", "left")
    age = (F.unix_micros(now) - F.unix_micros(F.col("observed_at").cast("timestamp"))) / 86_400_000_000.0
    stale = ranked.withColumn("stale", F.col("observed_at").isNull() | (age > most_days))
    first = stale.where("stale").orderBy(F.desc("strength"), "key").limit(budget).select("key", F.lit("asked").alias("asked"))
    return stale.join(first, "key", "left").select("key", "observed_at", F.when(~F.col("stale"), "fresh").otherwise(F.coalesce("asked", F.lit("deferred"))).alias("state"))


def calibrated(rows: DataFrame, groups: Sequence[tuple[str, Column, Column, bool]]) -> DataFrame:
    """group, members, failures, ok of each group (name, who belongs to it, what must hold for each, whether it may be empty). What is unknown does not hold. One pass over the rows."""
    held = F.array(*[F.struct(F.lit(name).alias("group"), F.coalesce(member, F.lit(False)).alias("member"), F.coalesce(expected, F.lit(False)).alias("good"), F.lit(empty).alias("empty")) for name, member, expected, empty in groups])
    each = rows.select(F.explode(held).alias("x")).select("x.*").groupBy("group", "empty").agg(F.count_if("member").alias("members"), F.count_if(F.col("member") & ~F.col("good")).alias("failures"))
    return each.select("group", "members", "failures", ((F.col("failures") == 0) & (F.col("empty") | (F.col("members") > 0))).alias("ok"))


def violations(answers: DataFrame, facts: DataFrame, constraints: Sequence[tuple[str, Column]], limit: int) -> DataFrame:
    """query, id, broken of answers that do not meet what was asked, from the facts and not from what ranked them; and rows of a query beyond its limit (id null). constraints: name, whether an answer is good, over the columns of both."""
    both = answers.join(facts.withColumn("_known", F.lit(True)), "id", "left")
    bad = [F.when(F.col("_known").isNotNull() & ~F.coalesce(good, F.lit(False)), F.lit(name)) for name, good in constraints]
    broken = both.select("query", "id", F.explode(F.array_compact(F.array(F.when(F.col("_known").isNull(), F.lit("not_in_facts")), *bad))).alias("broken"))
    many = answers.groupBy("query").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    return broken.unionByName(many.select("query", F.lit(None).cast(answers.schema["id"].dataType).alias("id"), F.lit("over_limit").alias("broken")))
