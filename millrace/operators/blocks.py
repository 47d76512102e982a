"""Word-level block matching: how much of a reference text stands in another text, word for word, and what else the text says.

Texts and references meet by hashes of runs of `block` words (seeds). Seeds of a pair on one diagonal, side by side, are one maximal common block, so that no text is compared with a reference word by
word. Of the maximal blocks the longest is taken first (ties: earlier in the reference, then in the text), then the longest of what is left before and after it in both, and so on. Only references
that share most with a text are matched (`shortlist` of them). References are texts of bounded length; texts may be of any.

Defined results: a null text or one shorter than a block matches nothing; ties between references go by id; repeated rows of one id must be told apart by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as words_of
from millrace.operators.rules import small
from millrace.session import checkpointed


def words(text: Column) -> Column:
    """Folded runs of letters and digits."""
    return F.filter(F.split(F.regexp_replace(words_of.fold(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "), " "), lambda w: w != "")


def seeds(rows: DataFrame, id: str, block: int) -> DataFrame:
    """id, at (from 0), gram: the hash of each run of words of `w`."""
    runs = F.when(F.size("w") >= block, F.sequence(F.lit(1), F.size("w") - block + 1)).otherwise(F.array().cast("array<int>"))
    return rows.select(id, F.posexplode(F.transform(runs, lambda i: F.xxhash64(F.slice("w", i, block)))).alias("at", "gram"))


def maximal(texts: DataFrame, refs: DataFrame, block: int = 4, shortlist: int = 3) -> DataFrame:
    """text, ref, i, j, n: the maximal common blocks of each text and its shortlisted references; they begin at word i of the reference and j of the text. texts, refs: text or ref, w."""
    known = checkpointed(seeds(refs, "ref", block).withColumnRenamed("at", "i"))
    met = checkpointed(seeds(texts, "text", block).withColumnRenamed("at", "j").join(small(known.select("gram").distinct()), "gram"))
    sizes = known.groupBy("ref").agg(F.countDistinct("gram").alias("n_grams"))
    shared = met.select("text", "gram").distinct().join(small(known.select("ref", "gram").distinct()), "gram").groupBy("text", "ref").agg(F.count(F.lit(1)).alias("n"))
    share = F.row_number().over(Window.partitionBy("text").orderBy(F.desc(F.col("n") / F.col("n_grams")), "ref"))
    listed = shared.join(small(sizes), "ref").withColumn("place", share).where(F.col("place") <= shortlist).select("text", "ref")
    dots = met.join(small(known), "gram").join(listed, ["text", "ref"], "left_semi")
    # on a diagonal, seeds that follow each other have one difference of place and number
    line = Window.partitionBy("text", "ref", F.col("j") - F.col("i")).orderBy("i")
    runs = dots.withColumn("run", F.col("i") - F.row_number().over(line))
    return runs.groupBy("text", "ref", (F.col("j") - F.col("i")).alias("d"), "run").agg(F.min("i").alias("i"), F.min("j").alias("j"), (F.count(F.lit(1)) + block - 1).cast("int").alias("n")).drop("d", "run")


def longest_first(found: Sequence[tuple[int, int, int]], block: int) -> list[tuple[int, int, int]]:
    """Blocks (i, j, n) that keep their order in both texts: the longest, then the longest before it and after it, clipped to what is left there."""
    out, regions = [], [(list(found), 0, float("inf"), 0, float("inf"))]
    while regions:
        some, i0, i1, j0, j1 = regions.pop()
        clipped = []
        for i, j, n in some:
            cut = max(i0 - i, j0 - j, 0)
            i, j = i + cut, j + cut
            n = min(n - cut, i1 - i, j1 - j)
            if n >= block:
                clipped.append((i, j, int(n)))
        if clipped:
            i, j, n = min(clipped, key=lambda b: (-b[2], b[0], b[1]))
            out.append((i, j, n))
            regions += [(clipped, i0, i, j0, j), (clipped, i + n, i1, j + n, j1)]
    return sorted(out)


def matched(texts: DataFrame, refs: DataFrame, markers: Sequence[str] = (), block: int = 4, shortlist: int = 3) -> DataFrame:
    """text, ref, coverage (the share of the reference's words in blocks), n_blocks, leftover (the text's other words), found (those of the markers, phrases of plain words, that are in it).

    texts, refs: id (text or ref), t."""
    texts, refs = texts.select("text", words(F.col("t")).alias("w")), checkpointed(refs.select("ref", words(F.col("t")).alias("w")))

    def chain(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        blocks = longest_first(list(some[["i", "j", "n"]].itertuples(index=False, name=None)), block)
        return pd.DataFrame([(*key, [b[1] for b in blocks], [b[2] for b in blocks])], columns=["text", "ref", "starts", "lengths"])

    kinds = [texts.schema["text"].dataType.simpleString(), refs.schema["ref"].dataType.simpleString()]
    pairs = maximal(texts, refs, block, shortlist)
    chained = pairs.groupBy("text", "ref").applyInPandas(chain, f"text {kinds[0]}, ref {kinds[1]}, starts array<int>, lengths array<int>")
    total = F.aggregate("lengths", F.lit(0), lambda a, n: a + n)
    whole = chained.join(small(refs.select("ref", F.size("w").alias("size"))), "ref").join(texts, "text")
    ranges = F.arrays_zip("starts", "lengths")
    rest = F.filter("w", lambda w, at: ~F.exists(ranges, lambda r: (at >= r["starts"]) & (at < r["starts"] + r["lengths"])))
    whole = whole.select("text", "ref", (total / F.col("size")).alias("coverage"), F.size("starts").alias("n_blocks"), F.array_join(rest, " ").alias("leftover"))
    padded = F.concat(F.lit(" "), F.col("leftover"), F.lit(" "))
    said = [F.when(F.contains(padded, F.lit(f" {m} ")), F.lit(m)) for m in sorted(markers)]
    return whole.withColumn("found", F.array_compact(F.array(*said)) if said else F.array().cast("array<string>"))


def closest(found: DataFrame) -> DataFrame:
    """Of each text the reference with the greatest coverage (to two places), then the least left over, then by id: a reference that holds another's text covers as much, but leaves less."""
    order = Window.partitionBy("text").orderBy(F.desc(F.round("coverage", 2)), F.length("leftover"), "ref")
    return found.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")
