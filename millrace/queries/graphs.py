"""Graph walks, identity and state between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import graph, identity, state
from millrace.plans.plan import Plan
from millrace.queries.registry import query
from millrace.sources.tables import edges, nodes, read

EDGES = """edges AS (
  SELECT 'supplier:' || l_suppkey AS src, 'OFFERS' AS rel, 'part:' || l_partkey AS dst, round(1 - max(l_discount), 2) AS confidence FROM lineitem GROUP BY l_suppkey, l_partkey
  UNION ALL SELECT DISTINCT 'customer:' || o_custkey, 'BOUGHT', 'part:' || l_partkey, 1.0 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'supplier:' || s_suppkey, 'IN', 'nation:' || s_nationkey, 1.0 FROM supplier
  UNION ALL SELECT 'customer:' || c_custkey, 'IN', 'nation:' || c_nationkey, 1.0 FROM customer
  UNION ALL SELECT 'nation:' || n_nationkey, 'PART_OF', 'region:' || n_regionkey, 1.0 FROM nation),
nodes AS (
  SELECT 'part:' || p_partkey AS id, 'part' AS type, p_name AS name, p_type AS kind, CAST(p_size AS DOUBLE) AS size FROM part
  UNION ALL SELECT 'supplier:' || s_suppkey, 'supplier', s_name, NULL, s_acctbal FROM supplier
  UNION ALL SELECT 'customer:' || c_custkey, 'customer', c_name, c_mktsegment, c_acctbal FROM customer
  UNION ALL SELECT 'nation:' || n_nationkey, 'nation', n_name, NULL, NULL FROM nation
  UNION ALL SELECT 'region:' || r_regionkey, 'region', r_name, NULL, NULL FROM region)"""


def plan(spark: SparkSession, sf_dir: str) -> Plan:
    return Plan(nodes(spark, sf_dir), edges(spark, sf_dir))


@query(f"""WITH {EDGES}, parts AS (SELECT dst AS id, max(confidence) AS confidence, count(*) AS n_from FROM edges WHERE rel = 'OFFERS' AND src IN (SELECT id FROM nodes WHERE type = 'supplier' AND size >= 9000) GROUP BY dst)
SELECT id, name, kind, confidence, n_from FROM nodes JOIN parts USING (id) WHERE kind <> 'ECONOMY' AND n_from >= 4""")
def g_traverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = plan(spark, sf_dir).start("supplier", size={"gte": 9000}).traverse("OFFERS").where(kind={"ne": "ECONOMY"}, n_from={"gte": 4})
    return found.frame().select("id", "name", "kind", "confidence", "n_from")


@query(f"""WITH {EDGES} SELECT id, name FROM nodes WHERE type = 'customer' AND size >= 9500 AND id IN (SELECT a.src FROM edges a JOIN edges b ON a.dst = b.src AND b.rel = 'PART_OF' WHERE a.rel = 'IN' AND b.dst = 'region:1') ORDER BY size DESC, id LIMIT 20""")
def g_require_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = plan(spark, sf_dir)
    into = Plan(whole.nodes, whole.edges.where("rel <> 'PART_OF' or dst = 'region:1'"))
    return into.start("customer", size={"gte": 9500}).require(("IN", "out"), ("PART_OF", "out")).rank("size").limit(20).frame().select("id", "name")


@query(f"""WITH {EDGES} SELECT id, name FROM nodes WHERE type = 'part' AND kind IN ('PROMO', 'LARGE') AND id NOT IN (SELECT a.dst FROM edges a JOIN nodes n ON n.id = a.src WHERE a.rel = 'OFFERS' AND n.size < 1000)""")
def g_exclude_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = plan(spark, sf_dir)
    poor = whole.nodes.where("type = 'supplier' and size < 1000").select(F.col("id").alias("src"))
    offers = whole.edges.where("rel = 'OFFERS'").join(poor, "src", "left_semi")
    return Plan(whole.nodes, offers).start("part", kind={"in": ["PROMO", "LARGE"]}).exclude(("OFFERS", "in")).frame().select("id", "name")


@query(f"""WITH {EDGES}, met AS (SELECT e.dst AS id, e.src AS origin, max(confidence) AS confidence FROM edges e JOIN nodes n ON n.id = e.src WHERE rel = 'IN' AND n.type = 'customer' AND n.size < 0 GROUP BY 1, 2),
sized AS (SELECT id, count(*) AS n FROM met GROUP BY id HAVING count(*) >= 4), firsts AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY confidence DESC, origin) AS place FROM met)
SELECT id, n, string_agg(origin, '|' ORDER BY place) AS members FROM firsts JOIN sized USING (id) WHERE place <= 3 GROUP BY id, n""")
def g_group_neighbour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(spark, sf_dir).start("customer", size={"lte": -0.005}).group("IN", "out", 4).frame().select("id", "n", "members")


@query(f"""WITH {EDGES}, fit AS (SELECT src, dst, confidence FROM edges WHERE rel = 'OFFERS' AND dst IN (SELECT dst FROM edges WHERE rel = 'OFFERS' GROUP BY dst HAVING count(*) > 1))
SELECT a.src AS a, b.src AS b, count(*) AS n_shared, max(least(0.8, a.confidence, b.confidence)) AS confidence FROM fit a JOIN fit b ON a.dst = b.dst AND a.src < b.src GROUP BY 1, 2""")
def g_co_alternative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.co_members(edges(spark, sf_dir), "OFFERS", 0.8)


@query(f"WITH {EDGES} SELECT type, rel, count(*) AS n, round(avg(confidence), 4) AS mean FROM edges JOIN nodes ON id = src GROUP BY ALL")
def g_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = edges(spark, sf_dir).join(nodes(spark, sf_dir).select(F.col("id").alias("src"), "type"), "src")
    return joined.groupBy("type", "rel").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 4).alias("mean"))


@query("""SELECT l_suppkey AS src, l_returnflag AS rel, l_partkey AS dst, max(round(1 - l_discount, 2)) AS confidence, string_agg(DISTINCT l_linestatus, '|' ORDER BY l_linestatus) AS evidence FROM lineitem GROUP BY 1, 2, 3""")
def g_edge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_returnflag").alias("rel"), F.col("l_partkey").alias("dst"), F.round(1 - F.col("l_discount"), 2).alias("confidence"), F.col("l_linestatus").alias("evidence"))
    return graph.upsert_edges(claims).withColumn("evidence", F.array_join("evidence", "|"))


LINKS = """links AS (SELECT DISTINCT least(a.o_custkey, b.o_custkey) AS a, greatest(a.o_custkey, b.o_custkey) AS b FROM orders a JOIN orders b ON a.o_orderdate = b.o_orderdate AND floor(a.o_totalprice / 20000) = floor(b.o_totalprice / 20000) AND a.o_orderpriority = b.o_orderpriority AND a.o_custkey < b.o_custkey)"""


@query(f"""WITH RECURSIVE {LINKS}, ends AS (SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links), reach(x, y) AS (SELECT x, x FROM ends UNION SELECT r.x, e.y FROM reach r JOIN ends e ON r.y = e.x)
SELECT x AS node, min(y) AS component FROM reach GROUP BY x""")
def identity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are tied by orders of the same day, priority and price range: each to the smallest of its bucket, which gives the same components as all pairs."""
    bucket = Window.partitionBy("o_orderdate", "o_orderpriority", F.floor(F.col("o_totalprice") / 20000))
    tied = read(spark, sf_dir, "orders").select(F.min("o_custkey").over(bucket).alias("a"), F.col("o_custkey").alias("b"))
    links = tied.where("a < b").distinct()
    return identity.components(links)


@query("""SELECT p_brand AS owner, split_part(p_name, ' ', 1) AS stem, count(*) AS n, arg_min(p_partkey, (length(CAST(p_partkey AS VARCHAR)), p_partkey)) AS primary_part FROM part GROUP BY 1, 2 HAVING count(*) > 1""")
def sibling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select(F.col("p_brand").alias("owner"), "p_name", "p_partkey")
    return identity.siblings(parts, "owner", F.split("p_name", " ")[0], "p_partkey").withColumnRenamed("primary", "primary_part")


@query("""WITH k AS (SELECT min(s_suppkey) AS id, s_nationkey FROM supplier GROUP BY s_nationkey)
SELECT c_custkey, coalesce(s.s_suppkey, k.id) AS known_id, CASE WHEN s.s_suppkey IS NOT NULL THEN 'key' WHEN k.id IS NOT NULL THEN 'nation' ELSE 'none' END AS "by" FROM customer LEFT JOIN supplier s ON c_custkey = s.s_suppkey LEFT JOIN k ON c_nationkey = k.s_nationkey""")
def identity_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identity.fallback(read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier"), [("key", "c_custkey", "s_suppkey"), ("nation", "c_nationkey", "s_nationkey")], "s_suppkey")
    return found.select("c_custkey", "known_id", "by")


WEEKS = """was AS (SELECT user_id, sum(value) AS v FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY 1), now AS (SELECT user_id, sum(value) AS v FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1)"""


def weeks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = read(spark, sf_dir, "events")
    total = lambda c: events.where(c).groupBy("user_id").agg(F.sum("value").alias("v"))
    return total("ts < timestamp_ntz'2024-01-08'"), total("ts >= timestamp_ntz'2024-01-08' and ts < timestamp_ntz'2024-01-15'")


@query(f"""WITH {WEEKS} SELECT coalesce(was.user_id, now.user_id) AS user_id, CASE WHEN was.v IS NULL THEN 'new' WHEN now.v IS NULL THEN 'failed' WHEN abs(now.v - was.v) >= greatest(50, 0.25 * abs(was.v)) THEN 'changed' ELSE 'unchanged' END AS class FROM was FULL JOIN now ON was.user_id = now.user_id""")
def change_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, now = weeks(spark, sf_dir)
    return state.classify(before, now, "user_id", "v", 50.0, 0.25).select("user_id", "class")


@query("""WITH e AS (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS key, event_type, ts, ts < TIMESTAMP '2024-01-02' AS known FROM events WHERE ts < TIMESTAMP '2024-01-03')
SELECT key, CASE WHEN NOT bool_or(known) THEN 'new' WHEN bool_or(NOT known) THEN 'refreshed' ELSE 'known' END AS status, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS providers, CAST(min(ts) AS DATE)::VARCHAR AS first_seen, CAST(max(ts) AS DATE)::VARCHAR AS last_seen FROM e GROUP BY key""")
def pool_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").where("ts < timestamp_ntz'2024-01-03'").select(F.get_json_object("props", "$.k").cast("long").alias("key"), "event_type", "ts")
    found = state.pool(events.where("ts < timestamp_ntz'2024-01-02'"), events.where("ts >= timestamp_ntz'2024-01-02'"), "key", "event_type", "ts")
    return found.select("key", "status", "providers", F.to_date("first_seen").cast("string").alias("first_seen"), F.to_date("last_seen").cast("string").alias("last_seen"))


SUBMIT = """subs AS (SELECT event_id, user_id AS producer, CAST(json_extract_string(props, '$.k') AS BIGINT) AS key, event_type AS digest, ts FROM events)"""


@query(f"""WITH {SUBMIT}, r AS (SELECT *, row_number() OVER w AS place, first_value(digest) OVER w AS first FROM subs WINDOW w AS (PARTITION BY producer, key ORDER BY ts, event_id))
SELECT event_id, CASE WHEN place = 1 THEN 'accepted' WHEN first = digest THEN 'replay' ELSE 'conflict' END AS outcome FROM r""")
def idempotent_submit(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = read(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("producer"), F.get_json_object("props", "$.k").alias("key"), F.col("event_type").alias("digest"), "ts")
    return state.submit(subs, "producer", "key", "digest", ["ts", "event_id"]).select("event_id", "outcome")


@query("""SELECT event_id, count(*) OVER w AS recent, count(*) OVER w > 3 AS limited FROM (SELECT *, epoch_us(ts) // 1000000 AS s FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)""")
def rate_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").withColumn("s", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long"))
    return state.rate(events, "user_id", "s", 86400, 3).select("event_id", "recent", "limited")


@query("""SELECT day, event_id, slot FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS slot FROM events) WHERE slot <= 20""")
def daily_seal(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts").cast("string"))
    return state.sealed(events, "day", ["ts", "event_id"], 20).select("day", "event_id", "slot")


@query("""WITH e AS (SELECT user_id, event_type = 'error' AS failed, ts, event_id FROM events), s AS (SELECT *, max(CASE WHEN NOT failed THEN (ts, event_id) END) OVER (PARTITION BY user_id) AS last FROM e)
SELECT user_id, count(*) AS failures, CASE WHEN count(*) >= 3 THEN 'dead' ELSE 'retry' END AS state FROM s WHERE failed AND (last IS NULL OR (ts, event_id) > last) GROUP BY user_id""")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.attempts(read(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query("""WITH f AS (SELECT c_custkey, substr(sha256(concat_ws('|', c_name, c_mktsegment)), 1, 16) AS now, substr(sha256(concat_ws('|', c_name, CASE WHEN c_acctbal < 0 THEN 'OTHER' ELSE c_mktsegment END)), 1, 16) AS was FROM customer) SELECT c_custkey, now AS fingerprint FROM f WHERE now <> was""")
def incremental_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer")
    print_of = lambda segment: F.substring(F.sha2(F.concat_ws("|", "c_name", segment), 256), 1, 16).alias("fingerprint")
    before = rows.select("c_custkey", print_of(F.when(F.col("c_acctbal") < 0, "OTHER").otherwise(F.col("c_mktsegment"))))
    return state.stale_by_fingerprint(before, rows.select("c_custkey", print_of(F.col("c_mktsegment"))), "c_custkey", "fingerprint")
