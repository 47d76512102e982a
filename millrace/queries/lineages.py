"""Answers cut down by their schema, chains of versions, and bounded rounds of discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import compact
from millrace.operators import graph, lineage
from millrace.queries.graphs import EDGES
from millrace.queries.registry import query
from millrace.sources.tables import edges, read

BLOCKS = compact.Blocks({"history": "history", "raw": "raw", "offers": "offers", "note": "notes"}, "^(as_of|licence|seen_.*)$", whole=frozenset({"raw"}), top=frozenset({"note"}))


@query("""
WITH lines AS (
  SELECT l_partkey, l_suppkey, count(*) AS n, CAST(max(l_shipdate) AS DATE)::VARCHAR AS as_of, CAST(sum(l_linenumber) AS BIGINT) AS raw
  FROM lineitem GROUP BY l_partkey, l_suppkey),
offers AS (
  SELECT l_partkey, count(*) AS n_offers,
         list({'supp': l_suppkey, 'history': {'as_of': as_of}, 'note': 'n' || n} ORDER BY l_suppkey) AS kept
  FROM lines GROUP BY l_partkey)
SELECT p_partkey, p_name AS name, CASE WHEN p_size > 10 THEN 'licence ' || p_size END AS licence,
       array_to_string(list_transform(kept, lambda o: o.supp || '@' || o.history.as_of || '/' || o.note), '|') AS offers, 'history|notes|raw' AS left_out
FROM part JOIN offers ON l_partkey = p_partkey""")
def compact_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with their offers, of which histories are cut to their dates and raw counts are left out; a note of an offer is no note of the product."""
    lines = read(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.to_date(F.max("l_shipdate")).cast("string").alias("as_of"), F.sum("l_linenumber").alias("raw"))
    history = F.struct("n", "as_of", F.array(F.struct("raw")).alias("rows")).alias("history")
    offer = F.struct(F.col("l_suppkey").alias("supp"), history, "raw", F.concat(F.lit("n"), "n").alias("note"))
    offers = lines.groupBy("l_partkey").agg(F.array_sort(F.collect_list(offer)).alias("list"))
    part = read(spark, sf_dir, "part").join(offers, F.col("l_partkey") == F.col("p_partkey"))
    licence = F.when(F.col("p_size") > 10, F.concat(F.lit("licence "), "p_size"))
    answer = F.struct(F.col("p_name").alias("name"), licence.alias("licence"), F.lit("of the product").alias("note"), F.struct("list").alias("result"))
    cut = compact.compact(part.select("p_partkey", answer.alias("answer")), "answer", BLOCKS, frozenset({"offers"}))
    said = F.transform("answer.result.list", lambda o: F.concat(o["supp"].cast("string"), F.lit("@"), o["history"]["as_of"], F.lit("/"), o["note"]))
    return cut.select("p_partkey", "answer.name", "answer.licence", F.array_join(said, "|").alias("offers"), F.array_join("left_out", "|").alias("left_out"))


YEARS = (1996, 1997, 1998, 1999, 2000)


def snapshots(spark: SparkSession, sf_dir: str, altered: int | None = None) -> DataFrame:
    """Version y has the orders up to that year, in parts by priority. altered: a year whose version has one part's rows changed."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year"))
    years = spark.createDataFrame([(y,) for y in YEARS], "version int")
    status = F.when((F.col("version") == F.lit(altered)) & (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderkey") % 100 == 0), "X").otherwise(F.col("o_orderstatus"))
    return orders.join(F.broadcast(years), F.col("year") <= F.col("version")).select("version", F.col("o_orderpriority").alias("part"), F.concat_ws(":", "o_orderkey", status).alias("said"))


@query(f"""
WITH years AS (SELECT unnest({list(YEARS)}) AS version),
rows AS (
  SELECT version, o_orderpriority AS part, o_orderkey, o_orderstatus,
         CASE WHEN version = 1998 AND o_orderpriority = '2-HIGH' AND o_orderkey % 100 = 0 THEN 'X' ELSE o_orderstatus END AS now
  FROM orders JOIN years ON year(o_orderdate) <= version),
summed AS (
  SELECT version, part, count(*) AS n, sum(CAST(('0x' || substr(sha256(o_orderkey || ':' || o_orderstatus), 1, 15)) AS HUGEINT)) AS was,
         sum(CAST(('0x' || substr(sha256(o_orderkey || ':' || now), 1, 15)) AS HUGEINT)) AS now
  FROM rows GROUP BY version, part),
digests AS (
  SELECT version, sum(n) AS n, sha256(string_agg(part || '=' || sha256(n || ':' || was), chr(10) ORDER BY part)) AS was,
         sha256(string_agg(part || '=' || sha256(n || ':' || now), chr(10) ORDER BY part)) AS now, string_agg(CASE WHEN was <> now THEN part END, '|') AS parts
  FROM summed GROUP BY version)
SELECT version, substr(was, 1, 16) AS digest, was = now AS ok, was = now AND version < coalesce((SELECT min(version) FROM digests WHERE was <> now), 9999) AS sound, coalesce(parts, '') AS parts FROM digests""")
def version_chain_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of yearly versions, of which one was altered after it was recorded: from there on the chain is not sound, and the part is named."""
    was, now = (lineage.parts(snapshots(spark, sf_dir, year), "version", "part", F.col("said")) for year in (None, 1998))
    recorded = lineage.versions(was).select((F.col("version") - YEARS[0]).alias("seq"), "version", F.when(F.col("version") > YEARS[0], F.col("version") - 1).alias("replaces"), "n", "digest")
    checked = lineage.verified(recorded, lineage.versions(now))
    parts = lineage.altered(was, now).groupBy("version").agg(F.array_join(F.array_sort(F.collect_list("part")), "|").alias("parts"))
    out = checked.join(recorded.select("version", "digest"), "version").join(parts, "version", "left")
    return out.select("version", F.substring("digest", 1, 16).alias("digest"), "ok", "sound", F.coalesce("parts", F.lit("")).alias("parts"))


@query(f"""
WITH {EDGES},
routes AS (
  SELECT src, rel || '>' || src AS route, dst FROM edges WHERE rel IN ('OFFERS', 'BOUGHT')
  UNION ALL SELECT dst, rel || '<' || dst, src FROM edges WHERE rel IN ('OFFERS', 'BOUGHT')),
r0 AS (SELECT id FROM nodes WHERE type = 'supplier' AND size >= 8000),
m1 AS (SELECT dst AS id, count(DISTINCT route) AS n_routes FROM routes JOIN r0 ON src = r0.id GROUP BY dst),
f1 AS (SELECT *, row_number() OVER (PARTITION BY n_routes >= 2 ORDER BY n_routes DESC, id) AS place FROM m1 WHERE id NOT IN (SELECT id FROM r0)),
r1 AS (SELECT id, n_routes, CASE WHEN n_routes < 2 THEN 'few_routes' WHEN place <= 40 THEN 'admitted' ELSE 'over_bound' END AS status FROM f1),
m2 AS (SELECT dst AS id, count(DISTINCT route) AS n_routes FROM routes JOIN r1 ON src = r1.id WHERE r1.status = 'admitted' GROUP BY dst),
f2 AS (SELECT *, row_number() OVER (PARTITION BY n_routes >= 2 ORDER BY n_routes DESC, id) AS place FROM m2 WHERE id NOT IN (SELECT id FROM r0) AND id NOT IN (SELECT id FROM r1)),
r2 AS (SELECT id, n_routes, CASE WHEN n_routes < 2 THEN 'few_routes' WHEN place <= 40 THEN 'admitted' ELSE 'over_bound' END AS status FROM f2)
SELECT id, 0 AS depth, 0 AS n_routes, 'seed' AS status FROM r0 UNION ALL SELECT id, 1, n_routes, status FROM r1 UNION ALL SELECT id, 2, n_routes, status FROM r2""")
def bounded_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and then buyers and suppliers that at least two routes reach from rich suppliers, forty a round."""
    used = edges(spark, sf_dir).where("rel in ('OFFERS', 'BOUGHT')")
    forth = used.select("src", F.concat("rel", F.lit(">"), "src").alias("route"), "dst")
    back = used.select(F.col("dst").alias("src"), F.concat("rel", F.lit("<"), "dst").alias("route"), F.col("src").alias("dst"))
    seeds = read(spark, sf_dir, "supplier").where("s_acctbal >= 8000").select(F.concat(F.lit("supplier:"), "s_suppkey").alias("id"))
    return graph.frontier(seeds, forth.unionByName(back), 2, 2, 40)
