"""Evidence by kind, validation, quotas, chains and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import scores as s
from millrace.functions import times
from millrace.operators import evidence
from millrace.queries.evidence import CLAIMS, SCORED, scored
from millrace.queries.registry import query
from millrace.sources.tables import AS_OF, claims, read


@query(f"""WITH {CLAIMS}, k AS (SELECT part, status, max((seen, locator)) AS best FROM claims GROUP BY part, status)
SELECT part, CAST(struct_extract(max(best), 1) AS VARCHAR) AS newest, string_agg(concat(status, '@', CAST(struct_extract(best, 1) AS VARCHAR)), ',' ORDER BY status) AS by_kind, CASE WHEN datediff('day', struct_extract(max(best), 1), DATE '{AS_OF}') <= 90 THEN 'active' WHEN datediff('day', struct_extract(max(best), 1), DATE '{AS_OF}') <= 365 THEN 'maintained' ELSE 'stale' END AS maintenance FROM k GROUP BY part""")
def maintenance_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evidence.newest_by_kind(claims(spark, sf_dir), "part", "status", "at", "locator")
    age = times.age_days(F.col("newest.at"), AS_OF)
    kinds = F.array_join(F.transform("by_kind", lambda x: F.concat(x["kind"], F.lit("@"), x["at"].cast("string"))), ",")
    return found.select("part", F.col("newest.at").cast("string").alias("newest"), kinds.alias("by_kind"), F.when(age <= 90, "active").when(age <= 365, "maintained").otherwise("stale").alias("maintenance"))


@query("""SELECT o_orderkey, CASE WHEN len(failed) > 0 THEN 'failed' ELSE 'valid' END AS status, array_to_string(failed, '|') AS failed FROM (SELECT o_orderkey, list_filter([CASE WHEN NOT (o_orderdate >= TIMESTAMP '1996-01-01') THEN 'dated' END, CASE WHEN NOT (o_totalprice > 1000) THEN 'priced' END, CASE WHEN NOT (o_orderstatus IN ('F', 'O')) THEN 'settled' END], lambda x: x IS NOT NULL) AS failed FROM orders)""")
def validation_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {"settled": F.col("o_orderstatus").isin("F", "O"), "priced": F.col("o_totalprice") > 1000, "dated": F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")}
    return evidence.validated(read(spark, sf_dir, "orders"), checks).select("o_orderkey", "status", F.array_join("failed", "|").alias("failed"))


@query(f"""WITH {CLAIMS} SELECT part, supp, CASE WHEN bool_or(source = '1-URGENT') THEN 'urgent' WHEN bool_or(source = '2-HIGH') THEN 'high' ELSE 'other' END AS evidence_class FROM claims GROUP BY part, supp""")
def evidence_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = claims(spark, sf_dir).groupBy("part", "supp").agg(F.collect_set("source").alias("kinds"))
    best = evidence.strongest(F.col("kinds"), ["1-URGENT", "2-HIGH"])
    return rows.select("part", "supp", F.when(best == "1-URGENT", "urgent").when(best == "2-HIGH", "high").otherwise("other").alias("evidence_class"))


@query("""WITH p AS (SELECT p_partkey, p_brand AS route, p_type AS family, row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_retailprice, p_partkey) AS place FROM part),
a AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY price, p_partkey) AS n FROM (SELECT p.*, p_retailprice AS price FROM p JOIN part USING (p_partkey)) WHERE place <= 3) SELECT p_partkey, route, family FROM a WHERE n <= 40""")
def quota_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("route"), F.col("p_type").alias("family"), "p_retailprice")
    return evidence.quotas(rows, "route", "family", ["p_retailprice", "p_partkey"], 3, 40).select("p_partkey", "route", "family")


@query("""SELECT o_custkey, o_orderkey, row_number() OVER w AS place, coalesce(lag(o_orderstatus) OVER w, '') AS before, o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER w AS changed FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def version_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evidence.chain(read(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderstatus")
    return found.select("o_custkey", "o_orderkey", "place", F.coalesce("before", F.lit("")).alias("before"), "changed")


@query("""WITH b AS (SELECT min(o_orderkey) AS low, greatest(1.0, CAST(max(o_orderkey) - min(o_orderkey) AS DOUBLE)) AS width FROM orders), f AS (SELECT CAST(least(floor((o_orderkey - low) / width * 256), 255) AS BIGINT) AS fine FROM orders, b),
c AS (SELECT level, CAST(floor(fine / pow(2, 8 - level)) AS BIGINT) AS cell, count(*) AS n FROM f, (SELECT unnest(range(0, 9)) AS level) GROUP BY 1, 2)
SELECT CAST(c.level AS INTEGER) AS level, c.cell, c.n FROM c LEFT JOIN c u ON u.level = c.level - 1 AND u.cell = c.cell // 2 WHERE (u.n IS NULL OR u.n > 1000) AND (c.n <= 1000 OR c.level = 8)""")
def range_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.range_split(read(spark, sf_dir, "orders"), "o_orderkey", 1000)


@query("""WITH a AS (SELECT source, avg(quality) AS q FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' GROUP BY source), b AS (SELECT source, avg(quality) AS q FROM documents JOIN labels USING (doc_id) WHERE lang <> 'en' GROUP BY source)
SELECT a.source, round(a.q, 4) AS was, coalesce(round(b.q, 4), -1) AS now FROM a LEFT JOIN b ON a.source = b.source WHERE b.q IS NULL OR a.q - b.q > 0.05""")
def quality_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    mean = lambda c: rows.where(c).groupBy("source").agg(F.avg("quality").alias("q"))
    return evidence.regressions(mean("lang = 'en'"), mean("lang <> 'en'"), "source", "q", 0.05).select("source", F.round("was", 4).alias("was"), F.coalesce(F.round("now", 4), F.lit(-1.0)).alias("now"))


@query("""SELECT coalesce(l_returnflag, 'all') AS flag, coalesce(l_linestatus, 'all') AS status, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return rows.select(F.coalesce("l_returnflag", F.lit("all")).alias("flag"), F.coalesce("l_linestatus", F.lit("all")).alias("status"), "n", "quantity")


@query("""WITH o AS (SELECT o_custkey, datediff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS gap FROM orders) SELECT o_custkey, CASE WHEN count(gap) >= 3 THEN round(median(gap), 2) ELSE -1 END AS median_gap FROM o GROUP BY o_custkey""")
def median_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    gaps = read(spark, sf_dir, "orders").select("o_custkey", F.datediff(F.to_date("o_orderdate"), F.to_date(F.lag("o_orderdate").over(order))).alias("gap"))
    return gaps.groupBy("o_custkey").agg(F.when(F.count("gap") >= 3, F.round(F.median("gap"), 2)).otherwise(-1.0).alias("median_gap"))


@query(f"""WITH {SCORED} SELECT part, CASE WHEN bool_or(reasons = '') THEN 'recommended' WHEN bool_or(score >= 30) THEN 'scored' ELSE 'discovery' END AS tier, count(*) AS n FROM gated GROUP BY part""")
def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.when(F.bool_or(F.col("reasons") == ""), "recommended").when(F.bool_or(F.col("score") >= 30), "scored").otherwise("discovery")
    return scored(spark, sf_dir).groupBy("part").agg(tier.alias("tier"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {CLAIMS} SELECT part, count(DISTINCT (source, status)) AS n_routes, min(CAST(left(source, 1) AS INTEGER)) AS depth FROM claims GROUP BY part""")
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims(spark, sf_dir).groupBy("part").agg(F.countDistinct("source", "status").alias("n_routes"), F.min(F.substring("source", 1, 1).cast("int")).alias("depth"))


@query(f"""WITH {SCORED} SELECT part, supp, round(0.4 * CASE WHEN source_count >= 3 THEN 100.0 WHEN source_count = 2 THEN 85.0 ELSE 80.0 END + 0.2 * least(100.0, n_claims * 25.0) + 0.3 * score + 0.1 * CASE WHEN maintenance = 'stale' THEN 0.0 ELSE 100.0 END, 3) AS quick,
CASE WHEN round(0.4 * CASE WHEN source_count >= 3 THEN 100.0 WHEN source_count = 2 THEN 85.0 ELSE 80.0 END + 0.2 * least(100.0, n_claims * 25.0) + 0.3 * score + 0.1 * CASE WHEN maintenance = 'stale' THEN 0.0 ELSE 100.0 END, 3) >= 75 THEN 'high' WHEN
round(0.4 * CASE WHEN source_count >= 3 THEN 100.0 WHEN source_count = 2 THEN 85.0 ELSE 80.0 END + 0.2 * least(100.0, n_claims * 25.0) + 0.3 * score + 0.1 * CASE WHEN maintenance = 'stale' THEN 0.0 ELSE 100.0 END, 3) >= 55 THEN 'fair' ELSE 'low' END AS band FROM gated""")
def fit_score_quick(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = F.when(F.col("source_count") >= 3, 100.0).when(F.col("source_count") == 2, 85.0).otherwise(80.0)
    quick = s.rounded(0.4 * weight + 0.2 * F.least(F.lit(100.0), F.col("n_claims") * 25.0) + 0.3 * F.col("score") + 0.1 * F.when(F.col("maintenance") == "stale", 0.0).otherwise(100.0), 3)
    return scored(spark, sf_dir).select("part", "supp", quick.alias("quick")).withColumn("band", s.band(F.col("quick"), [(75, "high"), (55, "fair"), (0, "low")]))


@query(f"""WITH {SCORED}, r AS (SELECT g.part, supp, score, p_brand, row_number() OVER (PARTITION BY supp, p_brand ORDER BY score DESC, g.part) AS place FROM gated g JOIN part ON g.part = p_partkey WHERE reasons = '') SELECT supp, p_brand AS brand, part, score FROM r WHERE place = 1""")
def distinct_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).where("reasons = ''").join(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("brand")), "part")
    place = F.row_number().over(Window.partitionBy("supp", "brand").orderBy(F.desc("score"), "part"))
    return rows.withColumn("place", place).where("place = 1").select("supp", "brand", "part", "score")


@query("""SELECT word, count(*) AS n_docs, count(DISTINCT source) AS n_sources FROM (SELECT DISTINCT doc_id, source, unnest(string_split(lower(text), ' ')) AS word FROM documents) WHERE length(word) >= 5 AND word NOT IN ('which', 'there') GROUP BY word ORDER BY n_docs DESC, word LIMIT 50""")
def topic_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = read(spark, sf_dir, "documents").select("source", F.explode(F.array_distinct(F.split(F.lower("text"), " "))).alias("word")).where((F.length("word") >= 5) & ~F.col("word").isin("which", "there"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"), F.countDistinct("source").alias("n_sources")).orderBy(F.desc("n_docs"), "word").limit(50)


@query("""WITH o AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, o_orderdate FROM orders) SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'material' WHEN o_orderpriority = '1-URGENT' AND datediff('day', o_orderdate, DATE '2001-12-31') >= 7 THEN 'release' END AS why FROM o WHERE o_orderstatus = 'P' OR (o_orderpriority = '1-URGENT' AND datediff('day', o_orderdate, DATE '2001-12-31') >= 7)""")
def rescore_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    waited = times.age_days(F.col("o_orderdate"), AS_OF) >= 7
    why = s.first_failing(("material", F.col("o_orderstatus") == "P"), ("release", (F.col("o_orderpriority") == "1-URGENT") & waited))
    return read(spark, sf_dir, "orders").select("o_orderkey", why.alias("why")).where("why is not null")


@query(f"""WITH {SCORED}, n AS (SELECT part, count(*) AS n FROM gated WHERE reasons = '' GROUP BY part), c AS (SELECT unnest(range(1, 21)) AS cap), t AS (SELECT cap, sum(least(n, cap)) AS total FROM n, c GROUP BY cap) SELECT cap, CAST(total AS BIGINT) AS total, total <= 6000 AS fits FROM t""")
def serving_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = scored(spark, sf_dir).where("reasons = ''").groupBy("part").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("groups"))
    caps = sizes.select(F.explode(F.sequence(F.lit(1).cast("long"), F.lit(20).cast("long"))).alias("cap"), "n", "groups")
    return caps.groupBy("cap").agg(F.sum(F.least("n", "cap") * F.col("groups")).alias("total")).withColumn("fits", F.col("total") <= 6000)
