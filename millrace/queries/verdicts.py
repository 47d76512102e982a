"""Queries on statuses, demand, names, notes, lookups, calibration and answers checked again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import verdicts
from millrace.queries.registry import query
from millrace.sources.tables import read

c = F.col


@query("""
WITH f AS (SELECT c_custkey, c_acctbal, c_mktsegment, count(o_orderkey) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f, CAST(max(o_orderdate) AS DATE) AS last FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_custkey,
  array_to_string(list_filter([
    CASE WHEN c_acctbal < 0 THEN 'overdrawn:' || CAST(round(c_acctbal, 2) AS VARCHAR) || ':customer#' || c_custkey END, CASE WHEN n = 0 THEN 'no_orders:none:orders' END,
    CASE WHEN last < DATE '2000-01-01' THEN 'dead:' || last || ':orders' END], lambda x: x IS NOT NULL), '|') AS disqualifiers,
  array_to_string(list_filter([
    CASE WHEN n >= 5 AND n_f >= 0.5 * n THEN 'mostly_final:' || n_f || ' of ' || n || ':orders' END, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'segment:' || c_mktsegment || ':customer#' || c_custkey END], lambda x: x IS NOT NULL), '|') AS watch_outs
FROM f""")
def flags_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("o_orderstatus") == "F").alias("n_f"), F.to_date(F.max("o_orderdate")).alias("last"))
    rows = read(spark, sf_dir, "customer").join(orders, c("o_custkey") == c("c_custkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    own = F.concat(F.lit("customer#"), c("c_custkey").cast("string"))
    bad = verdicts.flags([("overdrawn", c("c_acctbal") < 0, F.round("c_acctbal", 2), own), ("no_orders", c("n") == 0, F.lit("none"), F.lit("orders")), ("dead", c("last") < F.lit("2000-01-01").cast("date"), c("last"), F.lit("orders"))])
    watch = verdicts.flags([("mostly_final", (c("n") >= 5) & (c("n_f") >= 0.5 * c("n")), F.concat("n_f", F.lit(" of "), "n"), F.lit("orders")), ("segment", c("c_mktsegment") == "MACHINERY", c("c_mktsegment"), own)])
    said = lambda x: F.array_join(F.transform(x, lambda f: F.concat_ws(":", f["id"], f["detail"], f["evidence"])), "|")
    return rows.select("c_custkey", said(bad).alias("disqualifiers"), said(watch).alias("watch_outs"))


@query("""
WITH e AS (SELECT p_brand, count(*) FILTER (WHERE p_size > 46) AS ok, count(*) FILTER (WHERE p_type = 'PROMO' AND p_size < 3) AS awaiting, count(*) FILTER (WHERE p_type = 'LARGE' AND p_size = 7) AS bad, count(*) FILTER (WHERE p_size = 8) AS outside,
  count(*) FILTER (WHERE p_type = 'SMALL' AND p_size = 9) AS share, count(*) FILTER (WHERE p_size = 10 AND p_type = 'ECONOMY') AS review, count(*) FILTER (WHERE p_size > 20) AS cand, bool_or(p_type = 'STANDARD' OR p_size = 1) AS job FROM part GROUP BY p_brand)
SELECT p_brand, CASE WHEN ok >= 3 THEN 'ok' WHEN ok > 0 THEN 'partial' ELSE 'none_yet' END AS status, CASE WHEN ok >= 3 THEN 'full_evaluation' ELSE coalesce(nullif(concat_ws('|',
  CASE WHEN ok > 0 THEN 'fewer_than_minimum' END, CASE WHEN awaiting > 0 THEN 'awaiting_full_evaluation' END, CASE WHEN bad > 0 THEN 'evaluated_not_recommended' END, CASE WHEN outside > 0 THEN 'outside_launch_selection' END,
  CASE WHEN share > 0 THEN 'share_alike_only' END, CASE WHEN review > 0 THEN 'licence_review' END, CASE WHEN NOT job THEN 'no_job_definition' END,
  CASE WHEN ok = 0 AND cand > 0 AND awaiting + bad + outside + share + review = 0 THEN 'corpus_candidates_only' END), ''), 'no_relationship_evidence') END AS reasons FROM e""")
def catalogue_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, size = c("p_type"), c("p_size")
    counts = {"ok": size > 46, "awaiting": (kind == "PROMO") & (size < 3), "not_recommended": (kind == "LARGE") & (size == 7), "outside_launch": size == 8, "share_alike_only": (kind == "SMALL") & (size == 9), "licence_review": (size == 10) & (kind == "ECONOMY"), "cand": size > 20}
    rows = read(spark, sf_dir, "part").groupBy("p_brand").agg(*[F.count_if(w).alias(n) for n, w in counts.items()], F.bool_or((kind == "STANDARD") | (size == 1)).alias("job"))
    status, reasons = verdicts.catalogue_status(c("ok"), 3, {k: c(k) for k, _ in verdicts.EVIDENCE}, c("cand"), c("job"))
    return rows.select("p_brand", status.alias("status"), F.array_join(reasons, "|").alias("reasons"))


@query("""
WITH links AS (SELECT DISTINCT 'host' || o_custkey % 3 || '/n' || o_custkey % 40 || '/r' || o_custkey AS link, o_custkey AS k FROM orders),
looked AS (SELECT link, k, k % 7 = 0 AS looked, k % 7 = 0 AND k % 2 = 1 AS found, k % 9 AS n, 'host' || k % 3 AS host, 'host' || k % 3 || '/was' || k AS fullname FROM links),
named AS (SELECT *, CASE WHEN k % 5 = 0 THEN 'C' || k WHEN found AND k % 3 = 0 THEN 'D' || k WHEN looked AND n = 4 THEN 'N' || host END AS corpus, k % 10 = 0 AND k % 5 = 0 OR (k % 5 <> 0 AND NOT (found AND k % 3 = 0) AND looked AND n = 4) AS canonical,
  CASE WHEN k % 4 = 0 THEN 'P' || k WHEN looked AND n = 5 THEN 'Q' || host END AS pool FROM looked)
SELECT link, coalesce(corpus, pool, CASE WHEN found THEN fullname END, link) AS key,
  CASE WHEN corpus IS NOT NULL THEN CASE WHEN canonical THEN 'canonical' ELSE 'corpus' END WHEN pool IS NOT NULL THEN 'candidate' WHEN looked AND NOT found THEN 'not_found' ELSE 'unresolved' END AS status,
  CASE WHEN corpus IS NOT NULL THEN CASE WHEN canonical THEN 'in the canonical dataset' ELSE 'in the corpus, not in the canonical dataset' END WHEN pool IS NOT NULL THEN 'in the discovery pool'
       WHEN looked AND NOT found THEN 'the host answered 404' WHEN looked THEN 'resolved, not admitted to the pool' ELSE 'not yet resolved' END AS reason
FROM named""")
def links_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses made from orders' customers, some looked up, held against a corpus and a pool by address, by the name that the lookup gave, and by the host's number."""
    k = c("k")
    host = F.concat(F.lit("host"), k % 3)
    rows = read(spark, sf_dir, "orders").select(c("o_custkey").alias("k")).distinct().withColumn("host", host).withColumn("link", F.concat("host", F.lit("/n"), k % 40, F.lit("/r"), "k"))
    lookups = rows.where("k % 7 = 0").select("link", (k % 2 == 1).alias("found"), F.when(k % 2 == 1, F.concat(F.lit("Was"), "k")).alias("name"), (k % 9).alias("number"), F.lit(404).alias("answer"))
    by_link = rows.where("k % 5 = 0").select(c("link").alias("name"), "host", F.lit(None).cast("long").alias("number"), F.concat(F.lit("C"), "k").alias("id"), (k % 10 == 0).alias("canonical"))
    by_name = rows.where("k % 7 = 0 and k % 2 = 1 and k % 3 = 0").select(F.concat("host", F.lit("/was"), "k").alias("name"), "host", F.lit(None).cast("long").alias("number"), F.concat(F.lit("D"), "k").alias("id"), F.lit(False).alias("canonical"))
    numbered = lambda n, letter: rows.select("host").distinct().select(F.lit(None).cast("string").alias("name"), "host", F.lit(n).cast("long").alias("number"), F.concat(F.lit(letter), "host").alias("id"))
    corpus = by_link.unionByName(by_name).unionByName(numbered(4, "N").withColumn("canonical", F.lit(True)))
    pool = rows.where("k % 4 = 0").select(c("link").alias("name"), "host", F.lit(None).cast("long").alias("number"), F.concat(F.lit("P"), "k").alias("id")).unionByName(numbered(5, "Q"))
    return verdicts.resolved(rows, lookups, corpus, pool)


@query("""
WITH names AS (SELECT min(p_partkey) AS id, p_name AS name FROM part GROUP BY p_name),
asked AS (SELECT p_name || CASE p_size % 4 WHEN 0 THEN ' alternative' WHEN 1 THEN ' (best) Alternatives' WHEN 2 THEN ' price' ELSE '-like replacement for ' || p_name || ' sets' END AS keyword, p_size % 4 AS kind, p_name, p_partkey % 50 AS volume FROM part),
counted AS (SELECT p_name, kind, max(volume) AS volume FROM asked WHERE kind <> 2 GROUP BY p_name, kind),
sums AS (SELECT id, CAST(sum(volume) AS BIGINT) AS volume FROM counted JOIN names ON name = p_name GROUP BY id)
SELECT id, CASE WHEN s.id IS NOT NULL OR n.id % 2 = 0 THEN 2 * coalesce(volume, 0) END AS volume FROM names n LEFT JOIN sums s USING (id)""")
def demand_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand of parts' names in two markets' reports of keywords; a name that no report could find has no figure."""
    part = read(spark, sf_dir, "part")
    names = part.groupBy(c("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    kind = c("p_size") % 4
    ending = F.when(kind == 0, " alternative").when(kind == 1, " (best) Alternatives").when(kind == 2, " price").otherwise(F.concat(F.lit("-like replacement for "), "p_name", F.lit(" sets")))
    asked = part.select(F.concat("p_name", ending).alias("keyword"), (c("p_partkey") % 50).alias("volume"))
    report = verdicts.demand(asked, names, ["alternative", "alternatives", "replacement for"]).select("id", "volume")
    return verdicts.total_demand(report.unionByName(report), names.where("id % 2 = 0").select("id"), names.select("id"))


@query("""
WITH n AS (
  SELECT 'host/' || lower(replace(p_brand, '#', '')) || '/' || replace(p_name, ' ', '-') AS id, p_partkey,
         CASE p_size % 4 WHEN 0 THEN p_name || ' stack (' || p_type || ')' WHEN 1 THEN p_type || '/' || p_name WHEN 2 THEN upper(p_name) ELSE 'The ' || p_name END AS name, p_size % 4 AS kind FROM part)
SELECT id, arg_min(name, (CASE kind WHEN 2 THEN 0 WHEN 3 THEN 1 ELSE 2 END, p_partkey)) AS name FROM n GROUP BY id""")
def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = c("p_size") % 4
    name = F.when(kind == 0, F.concat("p_name", F.lit(" stack ("), "p_type", F.lit(")"))).when(kind == 1, F.concat("p_type", F.lit("/"), "p_name")).when(kind == 2, F.upper("p_name")).otherwise(F.concat(F.lit("The "), "p_name"))
    id = F.concat(F.lit("host/"), F.lower(F.replace(c("p_brand"), F.lit("#"), F.lit(""))), F.lit("/"), F.replace(c("p_name"), F.lit(" "), F.lit("-")))
    return verdicts.display_names(read(spark, sf_dir, "part").select(id.alias("id"), c("p_partkey").alias("priority"), name.alias("name")))


@query("""
WITH d AS (
  SELECT s_suppkey, ['balance', 'breadth', 'price'] AS labels, [CASE WHEN s_acctbal >= 0 THEN s_acctbal / 100 END, CAST(n AS DOUBLE), CAST(q AS DOUBLE)] AS v
  FROM supplier LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS n, max(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey),
e AS (SELECT s_suppkey, unnest(labels) AS label, unnest(v) AS v FROM d),
s AS (SELECT s_suppkey, string_agg(label, ' and ' ORDER BY v DESC, label) AS strong FROM (SELECT * FROM e WHERE v >= 60 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY v DESC, label) <= 2) GROUP BY 1),
w AS (SELECT s_suppkey, string_agg(label, ' and ' ORDER BY v, label) AS weak FROM (SELECT * FROM e WHERE v < 50 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY v, label) <= 2) GROUP BY 1)
SELECT s_suppkey, CASE WHEN strong IS NULL AND weak IS NULL THEN NULL WHEN strong IS NULL THEN 'Weakest on ' || weak || '.' WHEN weak IS NULL THEN 'Strongest on ' || strong || '.' ELSE 'Strongest on ' || strong || '; weakest on ' || weak || '.' END AS note
FROM supplier LEFT JOIN s USING (s_suppkey) LEFT JOIN w USING (s_suppkey)""")
def derived_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n"), F.max("l_quantity").alias("q"))
    rows = read(spark, sf_dir, "supplier").join(lines, c("l_suppkey") == c("s_suppkey"), "left")
    _, _, said = verdicts.note([("balance", "balance", F.when(c("s_acctbal") >= 0, c("s_acctbal") / 100)), ("breadth", "breadth", c("n")), ("price", "price", c("q"))], 60, 50)
    return rows.select("s_suppkey", said.alias("note"))


@query("""
WITH r AS (SELECT c_custkey AS key, max(c_acctbal) AS strength, max(o_orderdate) AS observed FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1),
s AS (SELECT *, observed IS NULL OR epoch_us(TIMESTAMP '2001-12-31') - epoch_us(observed) > 400 * 86400000000 AS stale FROM r)
SELECT key, CASE WHEN NOT stale THEN 'fresh' WHEN row_number() OVER (PARTITION BY stale ORDER BY strength DESC, key) <= 25 THEN 'asked' ELSE 'deferred' END AS state FROM s""")
def lookups_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select(c("c_custkey").alias("key"), c("c_acctbal").alias("strength"))
    readings = read(spark, sf_dir, "orders").select(c("o_custkey").alias("key"), c("o_orderdate").alias("observed_at"))
    return verdicts.due(rows, readings, F.lit("2001-12-31").cast("timestamp"), 400, 25).select("key", "state")


@query("""
SELECT 'rich' AS "group", count(*) FILTER (WHERE s_acctbal > 9000) AS members, count(*) FILTER (WHERE s_acctbal > 9000 AND s_nationkey >= 20) AS failures, count(*) FILTER (WHERE s_acctbal > 9000 AND s_nationkey >= 20) = 0 AND count(*) FILTER (WHERE s_acctbal > 9000) > 0 AS ok FROM supplier
UNION ALL SELECT 'negative', count(*) FILTER (WHERE s_acctbal < 0), 0, count(*) FILTER (WHERE s_acctbal < 0) > 0 FROM supplier
UNION ALL SELECT 'none', 0, 0, true UNION ALL SELECT 'none_expected', 0, 0, false""")
def calibration_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = [("rich", c("s_acctbal") > 9000, c("s_nationkey") < 20, False), ("negative", c("s_acctbal") < 0, c("s_acctbal") < 9000, False), ("none", c("s_acctbal") > 1e9, F.lit(False), True), ("none_expected", c("s_acctbal") > 1e9, F.lit(True), False)]
    return verdicts.calibrated(read(spark, sf_dir, "supplier"), groups)


@query("""
WITH answers AS (SELECT c_mktsegment AS query, c_custkey + CASE WHEN c_custkey % 50 = 0 THEN 1000000000 ELSE 0 END AS id FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) <= CASE WHEN c_mktsegment < 'C' THEN 31 ELSE 30 END)
SELECT query, CAST(id AS VARCHAR) AS id, b AS broken FROM (
  SELECT query, id, unnest(list_filter([CASE WHEN c_custkey IS NULL THEN 'not_in_facts' END, CASE WHEN c_custkey IS NOT NULL AND NOT c_acctbal >= 9300 THEN 'min_balance' END,
    CASE WHEN c_custkey IS NOT NULL AND c_nationkey IN (3, 4) THEN 'nation' END], lambda x: x IS NOT NULL)) AS b FROM answers LEFT JOIN customer ON c_custkey = id)
UNION ALL SELECT query, '', 'over_limit' FROM answers GROUP BY query HAVING count(*) > 30""")
def answers_rechecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a ranking gave, held against the facts: some are not known, some break a constraint, some queries have too many."""
    customer = read(spark, sf_dir, "customer")
    place = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey"))
    chosen = customer.withColumn("place", place).where(c("place") <= F.when(c("c_mktsegment") < "C", 31).otherwise(30))
    answers = chosen.select(c("c_mktsegment").alias("query"), (c("c_custkey") + F.when(c("c_custkey") % 50 == 0, 1_000_000_000).otherwise(0)).alias("id"))
    facts = customer.select(c("c_custkey").alias("id"), "c_acctbal", "c_nationkey")
    found = verdicts.violations(answers, facts, [("min_balance", c("c_acctbal") >= 9300), ("nation", ~c("c_nationkey").isin(3, 4))], 30)
    return found.select("query", F.coalesce(c("id").cast("string"), F.lit("")).alias("id"), "broken")
