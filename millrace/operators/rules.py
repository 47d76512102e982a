"""Rules that are joined by prefix, suffix or containment. A rule set has a checked size; text is cut into keys, so that no rule meets every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rules up to which a rule table is broadcast.
BROADCAST_RULES = 100_000


def small(rules: DataFrame, most: int = BROADCAST_RULES) -> DataFrame:
    """rules, with a hint to broadcast them if they are few enough."""
    return F.broadcast(rules) if rules.limit(most + 1).count() <= most else rules


def suffixes(host: Column) -> Column:
    """A host and all domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))


def match_urls(urls: DataFrame, rules: DataFrame, id: str, host: str, path: str) -> DataFrame:
    """rules: rule, domain, prefix. The most specific rule of each row: the longest domain, then the longest prefix, then by name. Domains meet by equality on the host's suffixes."""
    keyed = urls.select(id, host, path, F.explode(suffixes(F.col(host))).alias("domain"))
    hits = keyed.join(small(rules), "domain").where(F.expr(f"startswith({path}, prefix)"))
    order = F.struct(F.length("domain").alias("d"), F.length("prefix").alias("p"), F.col("rule"))
    return hits.groupBy(id).agg(F.max_by("rule", order).alias("rule"), F.count(F.lit(1)).alias("n_fitting"))


def run_hashes(words: Column, k: int) -> Column:
    """A 64-bit hash of each run of k words in an array of word hashes; one of all words if there are fewer."""
    places = F.sequence(F.lit(1), F.greatest(F.size(words) - k + 1, F.lit(1)))
    return F.transform(places, lambda i: F.xxhash64(F.lit(k), *[F.try_element_at(words, (i + j).cast("int")) for j in range(k)]))


def longest_name(texts: DataFrame, names: DataFrame, id: str, tokens: Column) -> DataFrame:
    """names: name (its words joined by blanks), n_words. The longest name that a text's words contain in a row; none if two are as long. Runs of words, of the lengths that names have, meet names by a 64-bit hash."""
    lengths = sorted(r[0] for r in names.select("n_words").distinct().collect())  # as many as names have lengths
    if not lengths:
        return texts.select(id, F.lit(None).cast("string").alias("name")).limit(0)
    hashed = lambda words: F.transform(words, lambda w: F.xxhash64(w))
    of_name = F.split("name", " ")
    keyed = names.select("name", F.coalesce(*[F.when(F.col("n_words") == k, F.element_at(run_hashes(hashed(of_name), k), 1)) for k in lengths]).alias("run"))
    words = texts.select(id, hashed(tokens).alias("w"))
    runs = F.concat(*[F.when(F.size("w") >= k, run_hashes(F.col("w"), k)).otherwise(F.array().cast("array<bigint>")) for k in lengths])
    hits = words.select(id, F.explode(F.array_distinct(runs)).alias("run")).join(small(keyed), "run")
    length = F.length("name")
    best = hits.withColumn("place", F.rank().over(Window.partitionBy(id).orderBy(F.desc(length)))).where("place = 1")
    return best.groupBy(id).agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name")).where("n = 1").drop("n")


def contained(texts: DataFrame, passages: DataFrame, k: int = 8, share: float = 0.9) -> DataFrame:
    """texts: doc, words; passages: item, words (arrays). Which texts hold at least a share of a passage's k-word runs. Runs meet by equality of hashes; the most common runs of texts are not dropped, but only runs of passages get into the join."""
    hashed = lambda df, id: df.where(F.size("words") > 0).select(id, F.transform("words", lambda w: F.xxhash64(w)).alias("words"))
    runs = lambda: F.array_distinct(run_hashes(F.col("words"), k))
    wanted = hashed(passages, "item").select("item", F.explode(runs()).alias("run"))
    sizes = wanted.groupBy("item").agg(F.count(F.lit(1)).alias("n_runs"))
    found = hashed(texts, "doc").select("doc", F.explode(runs()).alias("run")).join(small(wanted, 1_000_000), "run").groupBy("doc", "item").agg(F.count(F.lit(1)).alias("n_found"))
    return found.join(sizes, "item").withColumn("coverage", F.round(F.col("n_found") / F.col("n_runs"), 4)).where(F.col("n_found") >= share * F.col("n_runs")).select("doc", "item", "n_found", "coverage")
