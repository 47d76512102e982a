"""Phrases in texts: one automaton of all phrases, hits with places, tests on windows between them, and names in "alternative to" statements.

A phrase matches where no letter or digit stands directly before or after it. Texts and phrases are plain: lower case, hyphens as spaces. Up to `most` phrases (counted before anything is sent) are one
automaton that every task holds; beyond that, phrases and texts meet by the first run of letters and digits of a phrase, a join that Spark deals. Both give the same hits; no text meets every phrase.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST = 200_000
RUN = re.compile("[a-z0-9]+")


def plain(text: Column) -> Column:
    return F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("-"), F.lit(" "))


def hits(texts: DataFrame, phrases: DataFrame, most: int = MOST) -> DataFrame:
    """id, phrase, at (characters before it), n (its length) of every occurrence, overlapping ones included. texts: id, t (plain); phrases: phrase (plain). Phrases without a letter or digit match nothing; a null text has no hits."""
    wanted = phrases.select(F.btrim("phrase").alias("phrase")).where(F.col("phrase").rlike("[a-z0-9]")).distinct()
    texts = texts.select("id", "t").where("t is not null")
    few = wanted.limit(most + 1).collect()
    return by_automaton(texts, [r["phrase"] for r in few]) if len(few) <= most else by_first_run(texts, wanted)


def free(text: str, a: int, b: int) -> bool:
    """Whether no letter or digit stands directly before a or at b."""
    return not (a and RUN.match(text[a - 1])) and not (b < len(text) and RUN.match(text[b]))


def by_automaton(texts: DataFrame, phrases: list[str]) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(sorted(phrases))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for p in shared.value:
            automaton.add_word(p, p)
        if shared.value:
            automaton.make_automaton()
        for batch in batches:
            for id, t in zip(batch["id"], batch["t"], strict=True):
                found = [(id, p, end + 1 - len(p), len(p)) for end, p in (automaton.iter(t) if shared.value else ()) if free(t, end + 1 - len(p), end + 1)]
                if found:
                    yield pd.DataFrame(found, columns=["id", "phrase", "at", "n"])

    return texts.mapInPandas(scan, f"id {texts.schema['id'].dataType.simpleString()}, phrase string, at long, n long")


def by_first_run(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    keyed = phrases.select("phrase", F.regexp_extract("phrase", "[a-z0-9]+", 0).alias("run"), (F.position(F.regexp_extract("phrase", "[a-z0-9]+", 0), F.col("phrase")) - 1).alias("lead"))
    lead, reach = keyed.agg(F.coalesce(F.max("lead"), F.lit(0)), F.coalesce(F.max(F.length("phrase")), F.lit(0))).first()

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for id, t in zip(batch["id"], batch["t"], strict=True):
                spans = [m.span() for m in RUN.finditer(t)]
                for i in range(0, len(spans), 5000):
                    some = spans[i : i + 5000]
                    yield pd.DataFrame({"id": id, "at": [a for a, _ in some], "run": [t[a:b] for a, b in some], "before": [t[max(0, a - lead - 1) : a] for a, _ in some], "after": [t[a : a + reach + 1] for a, _ in some]})

    placed = texts.mapInPandas(runs, f"id {texts.schema['id'].dataType.simpleString()}, at long, run string, before string, after string")
    around = F.concat("before", "after")
    begin = F.length("before") - F.col("lead") + 1
    met = placed.join(keyed, "run").where((F.length("before") >= F.col("lead")) & (F.substr(around, begin, F.length("phrase")) == F.col("phrase")))
    open_ = lambda c: ~F.coalesce(c.rlike("^[a-z0-9]"), F.lit(False))
    met = met.where(open_(F.when(begin > 1, F.substr(around, begin - 1, F.lit(1))).otherwise("")) & open_(F.substr(around, begin + F.length("phrase"), F.lit(1))))
    return met.select("id", "phrase", (F.col("at") - F.col("lead")).alias("at"), F.length("phrase").cast("long").alias("n"))


def leftmost(found: DataFrame) -> DataFrame:
    """Of overlapping hits of a text the leftmost, and of those at one place the longest."""
    listed = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", (-F.col("n")).alias("less"), "phrase"))).alias("all"))
    kind = "struct<end:bigint,kept:array<struct<at:bigint,less:bigint,phrase:string>>>"
    empty = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast("array<struct<at:bigint,less:bigint,phrase:string>>").alias("kept")).cast(kind)
    step = lambda x, h: F.when(h["at"] >= x["end"], F.struct((h["at"] - h["less"]).alias("end"), F.concat(x["kept"], F.array(h)).alias("kept")).cast(kind)).otherwise(x)
    chosen = listed.select("id", F.explode(F.aggregate("all", empty, step)["kept"]).alias("h"))
    return chosen.select("id", "h.phrase", "h.at", (-F.col("h.less")).alias("n"))


def nearest(found: DataFrame, group: str) -> DataFrame:
    """found: hits with a group of 0 or 1 in the named column. For each hit of group 0: gap, the characters between it and the nearest hit of group 1 in its text (0 if they touch or overlap), null without one. Hits meet
    in one pass over a text's hits in order, not pair by pair."""
    end = F.col("at") + F.col("n")
    other = F.col(group) == 1
    order = Window.partitionBy("id").orderBy("at", "n", "phrase")
    before = F.max(F.when(other, end)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(other, F.col("at"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    known = lambda gap: F.when(gap.isNotNull(), F.greatest(gap, F.lit(0)))
    gap = F.least(known(F.col("at") - before), known(after - end))
    return found.withColumn("gap", gap).where(F.col(group) == 0)


#: "alternatives to A, B and C" up to the end of a clause, "A alternative", and what parts the items of a list.
LIST_AFTER = r"\b(?:alternatives?|replacements?) (?:to|for) ([^.;:!?\n]{1,120})"
NAME_BEFORE = r"([a-z0-9][a-z0-9.+ -]{0,40}?)[ -]alternatives?\b"
PARTS = r",|/|&|\bor\b|\band\b|\bvs\.?\b"


def item_key(x: Column) -> Column:
    """An item of a list without an article before it and filler after it."""
    x = F.regexp_replace(F.btrim(x), r"^(?:the|a|an)\s+", "")
    x = F.regexp_replace(x, r"\s+(?:etc\.?|and more|and others|and co\.?)$", "")
    return F.btrim(F.regexp_replace(F.regexp_replace(x, r"[^a-z0-9.+ -]", " "), r"\s+", " "), F.lit(" .-"))


def stated(texts: DataFrame, names: DataFrame) -> DataFrame:
    """id, name, matched: what a text says that it replaces. texts: id, t; names: name, key (as item_key() makes it).

    Counted are items of a list after "alternative to" that equal a name, and the longest name that ends right before "alternative". An item that only begins with a name is none."""
    low = texts.select("id", F.lower("t").alias("t"))
    after = low.select("id", F.explode(F.regexp_extract_all("t", F.lit(LIST_AFTER), F.lit(1))).alias("list")).select("id", F.explode(F.split("list", PARTS)).alias("item"))
    after = after.select("id", item_key(F.col("item")).alias("key")).where("key <> ''").join(names, "key").select("id", "name", F.col("key").alias("matched"))
    before = low.select("id", F.posexplode(F.regexp_extract_all("t", F.lit(NAME_BEFORE), F.lit(1))).alias("k", "said")).select("id", "k", F.split(item_key(F.col("said")), " ").alias("w"))
    ends = before.select("id", "k", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.array_join(F.slice("w", i, F.size("w")), " "))).alias("cut", "key"))
    longest = ends.join(names, "key").withColumn("place", F.rank().over(Window.partitionBy("id", "k").orderBy("cut"))).where("place = 1")
    return after.unionByName(longest.select("id", "name", F.concat("key", F.lit(" alternative")).alias("matched"))).groupBy("id", "name").agg(F.min("matched").alias("matched"))
