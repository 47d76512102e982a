"""The driver tables as the engine's inputs: claims, snapshots, mentions, documents, graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-12-31"
EVENTS_AS_OF = "2024-01-30"
#: Lines that a text made of a table's rows has at most, about; more rows are more texts.
TEXT_LINES = 20_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of an order claims that a supplier stands for a part; the order's priority is the claim's source."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("status"),
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("locator"), F.to_date("l_shipdate").alias("at"), F.col("l_quantity").alias("quantity"),
    )


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event mentions the key in its properties."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("item"), F.col("event_type").alias("source"), F.col("user_id").alias("author"), F.col("ts").alias("at"), F.col("value").alias("points"), F.get_json_object("props", "$.k").cast("long").alias("key")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed edges with confidences: customer PLACED order's part, supplier OFFERS part, supplier and customer IN nation, nation PART_OF region."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_discount")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    node = lambda kind, column: F.concat(F.lit(f"{kind}:"), F.col(column))
    offers = line.groupBy("l_suppkey", "l_partkey").agg(F.max("l_discount").alias("d")).select(node("supplier", "l_suppkey").alias("src"), F.lit("OFFERS").alias("rel"), node("part", "l_partkey").alias("dst"), F.round(1 - F.col("d"), 2).alias("confidence"))
    bought = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(node("customer", "o_custkey").alias("src"), F.lit("BOUGHT").alias("rel"), node("part", "l_partkey").alias("dst"), F.lit(1.0).alias("confidence")).distinct()
    in_nation = lambda table, key, nation, kind: read(spark, sf_dir, table).select(node(kind, key).alias("src"), F.lit("IN").alias("rel"), node("nation", nation).alias("dst"), F.lit(1.0).alias("confidence"))
    part_of = read(spark, sf_dir, "nation").select(node("nation", "n_nationkey").alias("src"), F.lit("PART_OF").alias("rel"), node("region", "n_regionkey").alias("dst"), F.lit(1.0).alias("confidence"))
    return offers.unionByName(bought).unionByName(in_nation("supplier", "s_suppkey", "s_nationkey", "supplier")).unionByName(in_nation("customer", "c_custkey", "c_nationkey", "customer")).unionByName(part_of)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select(F.concat(F.lit("part:"), "p_partkey").alias("id"), F.lit("part").alias("type"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_size").cast("double").alias("size"))
    supp = read(spark, sf_dir, "supplier").select(F.concat(F.lit("supplier:"), "s_suppkey").alias("id"), F.lit("supplier").alias("type"), F.col("s_name").alias("name"), F.lit(None).cast("string").alias("kind"), F.col("s_acctbal").alias("size"))
    cust = read(spark, sf_dir, "customer").select(F.concat(F.lit("customer:"), "c_custkey").alias("id"), F.lit("customer").alias("type"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("kind"), F.col("c_acctbal").alias("size"))
    place = read(spark, sf_dir, "nation").select(F.concat(F.lit("nation:"), "n_nationkey").alias("id"), F.lit("nation").alias("type"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("double").alias("size"))
    area = read(spark, sf_dir, "region").select(F.concat(F.lit("region:"), "r_regionkey").alias("id"), F.lit("region").alias("type"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("double").alias("size"))
    return parts.unionByName(supp).unionByName(cust).unionByName(place).unionByName(area)
