"""Ranking, budgets, caps, samples and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import selection
from millrace.queries.evidence import SCORED, scored
from millrace.queries.registry import query
from millrace.sources.tables import read


@query(f"""WITH {SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY supp ORDER BY score DESC, part) AS rank, count(*) OVER (PARTITION BY supp) AS n FROM gated WHERE reasons = '')
SELECT supp, part, score, rank, greatest(n - 5, 0) AS more_available FROM r WHERE rank <= 5""")
def top_k_per_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).where("reasons = ''").select("supp", "part", "score")
    return selection.top_k(rows, ["supp"], [F.desc("score"), F.col("part")], 5).select("supp", "part", "score", "rank", "more_available")


@query("""WITH o AS (SELECT o_orderkey, o_orderpriority = '1-URGENT' AND o_totalprice > 450000 AS must, o_orderdate FROM orders)
SELECT o_orderkey FROM o WHERE must UNION ALL (SELECT o_orderkey FROM o WHERE NOT must ORDER BY o_orderdate, o_orderkey LIMIT greatest(0, (SELECT 400 - count(*) FROM o WHERE must)))""")
def budget_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    must = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 450000)
    return selection.budget(read(spark, sf_dir, "orders"), must, [F.col("o_orderdate"), F.col("o_orderkey")], 400).select("o_orderkey")


@query("""WITH s AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1), c AS (SELECT unnest(range(1, 101)) AS cap), t AS (SELECT cap, sum(least(n, cap)) AS total FROM s, c GROUP BY cap)
SELECT coalesce(max(cap), 0) AS cap, CAST(coalesce(max(total), 0) AS BIGINT) AS total FROM t WHERE total <= 20000""")
def cap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return selection.largest_cap(sizes, "n", 20000, 100).select(F.col("cap").cast("long").alias("cap"), "total")


@query(f"""WITH {SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY coalesce(n_claims >= 2, false) DESC, score DESC, supp) AS place FROM gated WHERE reasons = '') SELECT part, supp, place FROM r WHERE place <= 8""")
def launch_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).where("reasons = ''")
    return selection.capped_serving(rows, ["part"], F.col("n_claims") >= 2, [F.desc("score"), F.col("supp")], 8).select("part", "supp", "place")


@query("SELECT c_custkey, c_name FROM customer ORDER BY sha256(concat('2024-06-01|', c_custkey)) LIMIT 60")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.hash_sample(read(spark, sf_dir, "customer"), "2024-06-01", F.col("c_custkey"), 60).select("c_custkey", "c_name")


@query("SELECT s_suppkey, s_acctbal < 0 AS demoted FROM supplier ORDER BY s_acctbal < 0, s_acctbal, s_suppkey LIMIT 40")
def demote_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.demoted(read(spark, sf_dir, "supplier"), F.col("s_acctbal") < 0, [F.col("s_acctbal"), F.col("s_suppkey")], 40).select("s_suppkey", "demoted")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS place, CASE WHEN row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) <= 20 THEN 'page' ELSE 'beyond' END AS part FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 50")
def page_then_beyond(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.page_and_beyond(read(spark, sf_dir, "part"), [F.desc("p_retailprice"), F.col("p_partkey")], 20, 30).select("p_partkey", "place", "part")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 250")
def cursor_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.after_cursor(read(spark, sf_dir, "orders"), "o_orderkey", 5000, 250).select("o_orderkey")


@query("""SELECT l_partkey AS part FROM lineitem WHERE l_suppkey IN (1, 2, 3) GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) = 3""")
def compare_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").where(F.col("l_suppkey").isin(1, 2, 3))
    return rows.groupBy(F.col("l_partkey").alias("part")).agg(F.countDistinct("l_suppkey").alias("n")).where("n = 3").select("part")


@query("""SELECT l_partkey AS part FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_discount >= 0.1 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 49""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = lambda c: read(spark, sf_dir, "lineitem").where(c).select(F.col("l_partkey").alias("part"))
    return parts("l_returnflag = 'R'").intersect(parts("l_discount >= 0.1")).subtract(parts("l_quantity > 49"))


@query("""(SELECT l_suppkey, 'first' AS side FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY l_suppkey HAVING count(*) > 105)
UNION ALL (SELECT s_suppkey, 'second' FROM supplier WHERE s_acctbal > 9000)""")
def heterogeneous_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_suppkey", "l_partkey").distinct().groupBy("l_suppkey").count().where("count > 105").select("l_suppkey", F.lit("first").alias("side"))
    second = read(spark, sf_dir, "supplier").where("s_acctbal > 9000").select(F.col("s_suppkey").alias("l_suppkey"), F.lit("second").alias("side"))
    return first.unionByName(second, allowMissingColumns=True)
