"""URL filtering: given host and path rules first, then association rules that FP-growth mines from labelled URLs.

A URL becomes a set of items: scheme, top domain, domain, every host label, the first label, how many there are, depth, every path part, the first and
the last one, extension, every query key, every key with its value, all keys joined, presence of a fragment, and every token of a
label, part or value that is made of several; digits of parts and values are masked. Two exact steps keep the transactions small however long
URLs are. An item that too few bad URLs have is in no rule and goes. Items that the same labelled URLs have form a class, of which
one item stands for all: a rule with two of a class is implied by the one without the second, and a rule that is found holds for
each item of its classes in turn. Transactions of labelled URLs carry one more item if the URL is bad. FP-growth's item sets that
contain it give rules, pruned by support (a share and a count), confidence, lift over the base rate, a bound on chance, and by any more general rule
that is as confident. Before they are used, rules are mined on four fifths of the labelled URLs and judged on the others: if what they
block there is not bad more often than the rest, the labels say nothing about URLs and no mined rule is used. Rules match by
an inverted index from item to rule: a rule applies if all its items are found.

Only DataFrame operations and Spark's own FP-growth are used. Defined results: a null URL, or one without `://`, has an empty
host and path and no items, and is allowed; repeated URLs are judged alike; of rules as confident that apply, the one that is last by its items is named; very long URLs
are read whole; an empty table of pages gives an empty result; with no labelled URLs there is no mined rule; a column that pages
already has gets the name with underscores.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, table, wide_hash

BAD = "label=bad"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Verdict, host and path of the fixed rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


@dataclass(frozen=True)
class Mining:
    """min_support, min_count: share and number of the labelled URLs that are bad and have an item set. min_lift: confidence by base rate. margin: natural logarithm by which a rule must beat chance over all that are counted; None: not asked for.
    held_out: one labelled URL in so many is kept to judge the rules; 0: none. broadcast_rules: index rows, and matched item sets, up to which they are broadcast; more are joined by a shuffle. salts: parts that a frequent item set is split into there."""

    min_support: float = 0.002
    min_confidence: float = 0.5
    min_count: int = 10
    min_lift: float = 1.2
    margin: float | None = 3.0
    held_out: int = 5
    broadcast_rules: int = 100_000
    salts: int = 16


def host_of(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)


def items_of(url: Column) -> Column:
    host, path = host_of(url), path_of(url)
    labels, parts = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda x: x != "")
    mask = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    item = lambda name, x: F.when(x != "", F.concat(F.lit(f"{name}="), x))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    pairs = F.split(query, "&")
    keys = F.array_sort(F.array_distinct(F.transform(pairs, lambda x: F.regexp_extract(x, r"^([^=]*)", 1))))
    each = lambda name, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(f"{name}="), x))
    last = F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))
    found = F.array(
        item("scheme", F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))), item("top", F.try_element_at(labels, F.lit(-1))),
        item("domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")), item("first_label", F.try_element_at(labels, F.lit(1))),
        item("labels", F.size(labels).cast("string")), item("depth", F.size(parts).cast("string")),
        item("first_part", mask(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")))), item("last_part", mask(last)), item("extension", F.lower(F.regexp_extract(last, r"\.([A-Za-z0-9]{1,8})$", 1))),
        item("query", F.array_join(keys, "&")), F.when(url.contains("#"), F.lit("fragment")),
    )
    below = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0)))
    values = F.transform(pairs, lambda x: F.regexp_extract(x, r"^[^=]*=(.*)$", 1))
    # what several are made of; one alone is an item already
    tokens = F.flatten(F.transform(F.concat(below, parts, values), lambda x: F.filter(F.split(mask(x), r"[^\p{L}\p{N}]+"), lambda t: (t != "") & (t != mask(x)))))
    found = F.concat(found, each("host_label", below), each("part", F.transform(parts, mask)), each("key", keys), each("pair", F.transform(pairs, mask)), each("bit", tokens))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.array_compact(found)))


def classes_of(kinds: DataFrame, least: int) -> DataFrame:
    """kinds: items, bad, n, kind (a key). rep, members: the items that at least so many bad URLs have, together if the same kinds have them."""
    each = kinds.select("kind", "bad", "n", F.explode("items").alias("item"))
    # two unlike 64-bit sums over the kinds and their number tell equal sets of kinds
    seen = each.groupBy("item").agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("n_bad"), F.count(F.lit(1)).alias("n_kinds"), F.bit_xor("kind.a").alias("a"), F.bit_xor(F.xxhash64("kind.b", "kind.a")).alias("b"))
    return seen.where(F.col("n_bad") >= least).groupBy("a", "b", "n_kinds").agg(F.min("item").alias("rep"), F.array_sort(F.collect_list("item")).alias("members")).select("rep", "members")


def with_members(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """A rule for each choice of one item from each of its classes."""
    parts = rules.select("items", "confidence", "n", F.explode("items").alias("rep")).join(classes, "rep").groupBy("items", "confidence", "n").agg(F.collect_list("members").alias("lists"))
    chosen = F.aggregate("lists", F.array(F.array().cast("array<string>")), lambda done, xs: F.flatten(F.transform(done, lambda d: F.transform(xs, lambda x: F.array_append(d, x)))))
    return parts.select(F.explode(chosen).alias("items"), "confidence", "n").withColumn("items", F.array_sort("items")).select(F.xxhash64("items").alias("rule"), "items", "confidence", "n")


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """labelled: url, bad (boolean). The rules: rule (long), items, confidence, support (as counted); none is implied by a more general one that is as confident."""
    spark = labelled.sparkSession
    baskets = labelled.where(F.col("bad").isNotNull()).select(F.array_sort(items_of(F.col("url"))).alias("items"), "bad").where(F.size("items") > 0)
    kinds = cut(baskets.groupBy("items", "bad").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", wide_hash("items", "bad")))
    total, bad = (x or 0 for x in kinds.agg(F.sum("n"), F.sum(F.when(F.col("bad"), F.col("n")))).first())
    least = max(1, mining.min_count, math.ceil(mining.min_support * total))
    classes = cut(classes_of(kinds, least))
    size = classes.count()
    if not size:
        return spark.createDataFrame([], "rule long, items array<string>, confidence double, n long")
    reps = F.broadcast(classes.select("rep")) if size <= mining.broadcast_rules else classes.select("rep")
    kept = kinds.select("kind", "bad", "n", F.explode("items").alias("rep")).join(reps, "rep").groupBy("kind", "bad", "n").agg(F.collect_list("rep").alias("items"))
    rows = kept.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items"), F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select("items")
    rows = cut(rows)
    # the share that makes FP-growth count to `least`, which is of all labelled URLs
    found = FPGrowth(minSupport=(least - 0.5) / rows.count(), minConfidence=mining.min_confidence).fit(rows).freqItemsets
    split = cut(found.select(F.array_sort(F.array_remove("items", BAD)).alias("items"), F.array_contains("items", BAD).alias("bad"), "freq"))
    both = split.where("bad").select("items", F.col("freq").alias("n")).where(F.size("items") > 0)
    rules = both.join(split.where("not bad").select("items", "freq"), "items").select("items", (F.col("n") / F.col("freq")).alias("confidence"), "n", "freq")
    base = bad / total
    rules = rules.where((F.col("confidence") >= mining.min_confidence) & (F.col("confidence") >= mining.min_lift * base))
    if mining.margin is not None and base < 1:
        # by the Chernoff bound, the number of URLs times the divergence of the confidence from the base rate is the logarithm of how unlikely chance is
        c = F.col("confidence")
        beyond = F.col("freq") * (c * F.log(c / base) + F.when(c < 1, (1 - c) * F.log((1 - c) / (1 - base))).otherwise(0.0))
        rules = rules.where(beyond > math.log(max(1, both.count())) + mining.margin)
    rules = rules.select("items", "confidence", "n")
    rules = cut(rules.withColumn("rule", F.xxhash64("items")))

    def general(rules: DataFrame, subsets: Column) -> DataFrame:
        """Without the rules of which such a subset is as confident."""
        some = rules.where(F.size("items") > 1).select("rule", F.col("confidence").alias("c"), F.explode(subsets).alias("items"))
        implied = some.join(rules.select("items", "confidence"), "items").where(F.col("confidence") >= F.col("c")).select("rule").distinct()
        return cut(rules.join(implied, "rule", "left_anti").select("rule", "items", "confidence", "n"))

    # most rules go by a subset of one item less; the few that are left are held against all their proper subsets, found by key
    masks = F.transform(F.expr("sequence(1L, shiftleft(1L, size(items)) - 2)"), lambda m: F.filter(F.col("items"), lambda x, i: F.pmod(F.floor(m / F.pow(F.lit(2), i)), F.lit(2)) == 1))
    rules = general(rules, F.transform("items", lambda x: F.array_remove(F.col("items"), x)))
    return with_members(general(rules, masks), classes)


def match(urls: DataFrame, rules: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """urls with a column `items`: adds mined (the items of the most confident rule that applies, joined; else null) and confidence."""
    rules = cut(rules)
    index = rules.select("rule", "confidence", F.size("items").alias("needed"), F.array_join("items", " & ").alias("mined"), F.explode("items").alias("item"))
    n = index.count()
    if not n:
        return urls.select("*", F.lit(None).cast("string").alias("mined"), F.lit(None).cast("double").alias("confidence"))
    if n <= mining.broadcast_rules:
        index = F.broadcast(index)
    kinds = urls.select("items").distinct()
    hits = kinds.select("items", F.explode("items").alias("item")).join(index, "item").groupBy("items", "rule", "needed", "mined", "confidence").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == F.col("needed"))
    best = cut(hits.groupBy("items").agg(F.max(F.struct("confidence", "mined")).alias("best")).select("items", "best.confidence", "best.mined"))
    if best.count() <= mining.broadcast_rules:
        return urls.join(F.broadcast(best), "items", "left")
    # a host's URLs may all have the same items: they are dealt to several parts by their place in the input
    salted = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(mining.salts - 1))))
    return urls.withColumn("salt", (F.monotonically_increasing_id() % mining.salts).cast("int")).join(salted, ["items", "salt"], "left").drop("salt")


def useful(labelled: DataFrame, mining: Mining = Mining()) -> bool:
    """Whether rules mined on a part of the labelled URLs block, among the others, URLs that are bad more often than those that they leave."""
    part = F.pmod(F.xxhash64("url"), F.lit(mining.held_out))
    held = labelled.where((part == 0) & F.col("bad").isNotNull()).select(items_of(F.col("url")).alias("items"), "bad")
    found = match(held, mine(labelled.where(part != 0), mining), mining)
    hit, bad = F.col("mined").isNotNull(), F.col("bad")
    found = found.agg(F.count_if(hit), F.count_if(hit & bad), F.count_if(~hit), F.count_if(~hit & bad)).first()
    blocked, hits, others, misses = found
    return blocked > 0 and hits * max(1, others) > misses * blocked


def mined_rules(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """The rules of mine() if they hold beyond what they were mined from; else none."""
    labelled = cut(labelled)
    rules = mine(labelled, mining)
    return rules if not mining.held_out or rules.isEmpty() or useful(labelled, mining) else rules.limit(0)


def judge(pages: DataFrame, labelled: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, mining: Mining = Mining(), url: str = "url") -> DataFrame:
    """pages with host, path, rule (of the given ones, else null), mined, confidence and verdict."""
    free = lambda name: name if name not in pages.columns else free(f"{name}_")
    at = {name: free(name) for name in ("host", "path", "rule", "mined", "confidence", "verdict")}
    whole = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"))
    source = F.col("page").getField(url)
    whole = match(whole.withColumn("items", items_of(F.coalesce(source, F.lit("")))), mined_rules(labelled, mining), mining)
    whole = whole.withColumn("host", host_of(source)).withColumn("path", path_of(source))
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    ruled = lambda value: F.coalesce(*[F.when(fits(F.col("host"), F.col("path"), h, p), F.lit(value(v, h, p))) for v, h, p in ordered], F.lit(None).cast("string"))
    return whole.select(
        "page.*", F.col("host").alias(at["host"]), F.col("path").alias(at["path"]), ruled(lambda v, h, p: h + p).alias(at["rule"]), F.col("mined").alias(at["mined"]), F.col("confidence").alias(at["confidence"]),
        F.coalesce(ruled(lambda v, h, p: v), F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias(at["verdict"]),
    )


def labels_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """A page's URL ends in the number of the document that it shows: its label says whether that document is toxic or of low quality."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})[^/0-9]*/?$", 1)
    shown = pages.select("url", number.try_cast("long").alias("doc_id"))
    known = labels.groupBy("doc_id").agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return shown.join(known, "doc_id").select("url", "bad")


def op5_url_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    judged = judge(pages.select("page_id", "url"), labels_of(pages.select("url"), labels))
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined", F.round("confidence", 6).alias("confidence"))
