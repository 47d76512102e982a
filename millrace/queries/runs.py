"""Runs that go on from the one before: promoted versions, recomputing within a budget, digests of equal facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import canonical
from millrace.operators import incremental
from millrace.queries.registry import query
from millrace.queries.sources import streamed
from millrace.session import checkpointed
from millrace.sources.tables import read
from millrace.streaming import promotion, states

BUDGET = 60


@query("""
SELECT user_id, event_id, event_type, value FROM events WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) DESC, event_id DESC) = 1""")
def promoted_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event of each user, merged batch by batch into a versioned table."""
    rows, path = streamed(spark, sf_dir, "promoted")
    rows = rows.where("value is not null").select("user_id", F.unix_micros("ts").alias("at"), "event_id", "event_type", "value")
    table = promotion.Versioned(spark, f"{path}/table", rows.schema)
    table.stream(rows, f"{path}/state", promotion.newest_by(["user_id"], ["at", "event_id"])).awaitTermination()
    return table.current().select("user_id", "event_id", "event_type", "value")


def facts(spark: SparkSession, sf_dir: str, until: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < F.lit(until).cast("timestamp"))
    return lines.groupBy(F.col("l_suppkey").alias("supp")).agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("most"), F.countDistinct(F.month("l_shipdate")).alias("months"))


def score(rows: DataFrame) -> DataFrame:
    return rows.select("supp", F.round(F.log1p("n") * 10 + F.col("most") / 10 + F.col("months"), 4).alias("score"))


@query(f"""
WITH was AS (SELECT l_suppkey AS supp, count(*) AS n, max(l_quantity) AS most, count(DISTINCT month(l_shipdate)) AS months FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-06-01' GROUP BY 1),
now AS (SELECT l_suppkey AS supp, count(*) AS n, max(l_quantity) AS most, count(DISTINCT month(l_shipdate)) AS months FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-06-08' GROUP BY 1),
joined AS (
  SELECT now.supp, was.supp IS NULL AS fresh, (now.n, now.most, now.months) IS DISTINCT FROM (was.n, was.most, was.months) AS changed,
         round(ln(1 + now.n) * 10 + now.most / 10 + now.months, 4) AS score, round(ln(1 + was.n) * 10 + was.most / 10 + was.months, 4) AS former
  FROM now LEFT JOIN was ON now.supp = was.supp),
placed AS (SELECT *, row_number() OVER (PARTITION BY changed OR fresh ORDER BY CASE WHEN fresh THEN 0 ELSE 1 END, supp) AS place FROM joined),
named AS (SELECT *, CASE WHEN fresh THEN 'new' WHEN NOT changed THEN 'unchanged' WHEN place <= {BUDGET} THEN 'rescored' ELSE 'deferred' END AS status FROM placed)
SELECT supp, CASE WHEN status IN ('new', 'rescored') THEN score ELSE former END AS score, status, CASE WHEN status IN ('new', 'rescored') THEN 'second' ELSE 'first' END AS run FROM named""")
def rescored_within_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of suppliers a week later: of those whose facts have changed as many as the budget allows."""
    none = spark.createDataFrame([], "supp long, score double, fingerprint string, evaluated_at string, status string")
    run = lambda until, former, name, budget: checkpointed(incremental.recompute(facts(spark, sf_dir, until), former, "supp", ["n", "most", "months"], "score/1", score, F.lit(name), budget))
    first = run("2001-06-01", none, "first", 0)
    return run("2001-06-08", first, "second", BUDGET).select("supp", "score", "status", F.col("evaluated_at").alias("run"))


@query("""
WITH texts AS (
  SELECT p_partkey, concat('{"brand":"', p_brand, '","size":', p_size, ',"what":{"kinds":["', p_type, '"],"name":"', p_name, '"}}') AS t FROM part)
SELECT p_partkey, substr(sha256(t), 1, 16) AS by_schema, substr(sha256(t), 1, 16) AS by_text FROM texts""")
def canonical_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same facts as columns in one order, with the size as a double, and as JSON text in another: equal digests."""
    part = read(spark, sf_dir, "part")
    held = part.select("p_partkey", F.struct(F.array("p_type").alias("kinds"), F.col("p_name").alias("name")).alias("what"), F.col("p_size").cast("double").alias("size"), F.col("p_brand").alias("brand"))
    text = F.concat(F.lit('{ "what": {"name": '), canonical.quoted(F.col("what.name")), F.lit(', "kinds": ['), canonical.quoted(F.col("what.kinds")[0]), F.lit(']}, "size": '), F.col("size").cast("string"), F.lit(', "brand": '), canonical.quoted(F.col("brand")), F.lit("}"))
    return held.select("p_partkey", canonical.digest(canonical.facts(held, ["what", "size", "brand"])).alias("by_schema"), canonical.digest(canonical.canonical_json(text)).alias("by_text"))


@query("""
WITH e AS (SELECT user_id AS id, epoch_us(ts) AS moment, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'accepted' WHEN 'signup' THEN 'held' ELSE 'queued' END AS outcome FROM events),
t AS (SELECT *, count(*) FILTER (WHERE outcome = 'failed') OVER w AS tried FROM e WINDOW w AS (PARTITION BY id ORDER BY moment, outcome ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, outcome = 'held' OR (outcome = 'failed' AND tried >= 3) AS ends FROM t),
k AS (SELECT *, count(*) FILTER (WHERE ends) OVER (PARTITION BY id ORDER BY moment, outcome ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM f)
SELECT id, arg_max(CASE WHEN outcome = 'failed' THEN CASE WHEN tried >= 3 THEN 'dead_letter' ELSE 'failed_retry' END ELSE outcome END, (moment, outcome)) AS state, max(tried) AS attempts, count(*) AS n_outcomes
FROM k WHERE ended = 0 GROUP BY id""")
def streamed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as entities whose events are outcomes: tried again after an error, given up after the third, on a stream."""
    rows, path = streamed(spark, sf_dir, "entities")
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "accepted").when(F.col("event_type") == "signup", "held").otherwise("queued")
    outcomes = rows.select(F.col("user_id").alias("id"), F.unix_micros("ts").alias("at"), kind.alias("outcome"))
    states.into(states.entities(outcomes), f"{path}/out", f"{path}/state").awaitTermination()
    return states.newest(spark, f"{path}/out", ["id"], states.ENTITY).select("id", "state", "attempts", "n_outcomes")


@query("""
WITH m AS (SELECT event_type AS source, user_id % 20 AS item, epoch_us(ts) AS moment, max(value) AS points FROM events WHERE value IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY source, item ORDER BY moment) AS f, row_number() OVER (PARTITION BY source, item ORDER BY moment DESC) AS l FROM m)
SELECT source, item, arg_max(points, moment) AS points, count(*) AS n_readings, string_agg(printf('%.2f', points), '|' ORDER BY moment) AS readings FROM r WHERE f = 1 OR l < 5 GROUP BY source, item""")
def streamed_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of an item, of which the first and the latest four stay, on a stream."""
    rows, path = streamed(spark, sf_dir, "mentions")
    readings = rows.where("value is not null").select(F.col("event_type").alias("source"), (F.col("user_id") % 20).alias("item"), F.unix_micros("ts").alias("at"), F.col("value").alias("points"))
    states.into(states.mentions(readings, keep=5, retain=400.0, late="400 days"), f"{path}/out", f"{path}/state").awaitTermination()
    found = states.newest(spark, f"{path}/out", ["source", "item"], states.MENTION)
    return found.select("source", "item", "points", "n_readings", F.array_join(F.transform("readings", lambda r: F.format_string("%.2f", r["points"])), "|").alias("readings"))
