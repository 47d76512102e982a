"""What is written can be read again: JSON lines, dated partitions, graph tables, Markdown lists, histories and streams. Written to the session's shared folder, a new one for each call."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import reconcile
from millrace.queries.registry import query
from millrace.session import shared_folder
from millrace.sources import days, io
from millrace.sources.tables import TEXT_LINES, read
from millrace.streaming import events as streams


def folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), folder(spark, "jsonl")
    io.write_jsonl(rows, path)
    return io.read_jsonl(spark, path, rows.schema)


@query("""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN 1 ELSE count(*) END AS n FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-08' GROUP BY CAST(ts AS DATE)""")
def dated_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days are written, then one again with a single row: the others stay. A range of days is read."""
    rows, path = read(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day")), folder(spark, "days")
    io.write_day(rows, path)
    io.write_day(rows.where("day = date'2024-01-05'").orderBy("event_id").limit(1), path)
    return io.read_days(spark, path, "2024-01-03", "2024-01-08").groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def manifest_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written table is held against the count and hash that were taken before it was written."""
    rows, path = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), folder(spark, "manifest")
    manifest = io.digest(rows).first().asDict()
    rows.write.parquet(path)
    return io.verified(spark.read.parquet(path), manifest)


@query("SELECT n_name AS id, [r_name] AS regions, 'LIES_IN' AS rel, r_name AS dst FROM nation JOIN region ON n_regionkey = r_regionkey")
def graph_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with a list and their edges, written as two tables of text and read back."""
    joined, path = read(spark, sf_dir, "nation").join(F.broadcast(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")), folder(spark, "graph")
    nodes, edges = joined.select(F.col("n_name").alias("id"), F.array("r_name").alias("regions")), joined.select(F.col("n_name").alias("src"), F.lit("LIES_IN").alias("rel"), F.col("r_name").alias("dst"))
    io.write_graph(nodes, edges, path)
    nodes, edges = io.read_graph(spark, path, nodes.schema, edges.schema)
    return nodes.join(edges, F.col("id") == F.col("src")).select("id", "regions", "rel", "dst")


@query("SELECT p_brand, 'Parts of ' || p_brand AS heading, p_name AS name, 'https://example.org/' || p_partkey AS url, p_type AS description FROM part")
def markdown_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as Markdown lists for each brand, and read back with the heading that they stand below. A brand has as many lists as it needs for each to stay short."""
    line = F.concat(F.lit("- ["), F.col("p_name"), F.lit("](https://example.org/"), F.col("p_partkey").cast("string"), F.lit(") - "), F.col("p_type"))
    part = read(spark, sf_dir, "part")
    text_id = F.struct("p_brand", F.pmod(F.xxhash64("p_partkey"), F.lit(-(-max(1, part.count()) // TEXT_LINES))).alias("nth")).alias("text_id")
    texts = part.groupBy(text_id).agg(F.array_join(F.collect_list(line), "\n").alias("lines"))
    texts = texts.select("text_id", F.concat(F.lit("# Parts of "), F.col("text_id.p_brand"), F.lit("\n\nsome words\n"), F.col("lines")).alias("text"))
    return io.listed(texts, "text_id", "text").select("text_id.p_brand", "heading", "name", "url", "description")


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_custkey, o_orderkey, 'again' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0")
def history_appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return reconcile.append_once(rows.where("o_orderkey % 3 = 0"), rows.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("again")), ["o_orderkey"])


def streamed(spark: SparkSession, sf_dir: str, of: str) -> tuple[DataFrame, str]:
    """The events as a stream, and a folder for what comes of it. The table's files are in no order of time, so what is there is one batch: no event is late, and a key's state is made once."""
    path = folder(spark, of)
    read(spark, sf_dir, "events").write.parquet(f"{path}/in")
    return streams.stream(spark, f"{path}/in", None), path


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events WHERE ts < (SELECT CAST(max(CAST(ts AS DATE)) - 1 AS TIMESTAMP) FROM events) GROUP BY 1, 2")
def streamed_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that the watermark, one day behind the newest event, has closed."""
    rows, path = streamed(spark, sf_dir, "daily")
    streams.into(streams.counts(rows), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out").select(F.to_date("day").cast("string").alias("day"), "event_type", "n", F.round("total", 3).alias("total"))


@query("SELECT event_id, user_id, event_type FROM events")
def streamed_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice on the stream; each comes out once."""
    path = folder(spark, "once")
    rows = read(spark, sf_dir, "events")
    rows.unionByName(rows).write.parquet(f"{path}/in")
    streams.into(streams.once(streams.stream(spark, f"{path}/in", None), ["event_id"]), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("event_id", "user_id", "event_type")


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY ALL""")
def verified_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a snapshot of JSON lines by day with a manifest, of which three days are checked and read."""
    rows, path = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_id", "event_type"), folder(spark, "snapshot")
    days.write(rows, path)
    found = days.read(spark, path, rows.drop("day").schema, "2024-01-10", "2024-01-12", check_first=True)
    return found.groupBy(F.col("day").cast("string").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
