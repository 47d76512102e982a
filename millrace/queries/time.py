"""Snapshots, momentum and mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scores import rounded
from millrace.operators import asof, mentions
from millrace.queries.registry import query
from millrace.sources.tables import EVENTS_AS_OF, read
from millrace.sources.tables import mentions as events

DAILY = """daily AS (SELECT user_id, day, sum(added) OVER (PARTITION BY user_id ORDER BY day) AS total FROM (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS added FROM events GROUP BY 1, 2))"""
MOMENTUM = asof.Momentum()
WINDOWS = ", ".join(f"({w}, {t})" for w, t in MOMENTUM.windows)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.daily(read(spark, sf_dir, "events"), "user_id", "ts", F.col("value"))


@query(f"WITH {DAILY} SELECT user_id, CAST(day AS VARCHAR) AS day, round(total, 3) AS total FROM daily")
def history_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).select("user_id", F.col("day").cast("string").alias("day"), F.round("total", 3).alias("total"))


GROWTH = f"""{DAILY},
bases AS (SELECT w.days, max(day) AS base FROM (VALUES {WINDOWS}) w(days, tolerance) LEFT JOIN (SELECT DISTINCT day FROM daily WHERE day <= DATE '{EVENTS_AS_OF}') d
          ON d.day <= DATE '{EVENTS_AS_OF}' - CAST(w.days AS INTEGER) AND datediff('day', d.day, DATE '{EVENTS_AS_OF}' - CAST(w.days AS INTEGER)) <= w.tolerance GROUP BY w.days),
wide AS (SELECT n.user_id, b.days, b.base, n.total AS now, t.total AS was FROM daily n CROSS JOIN bases b LEFT JOIN daily t ON t.user_id = n.user_id AND t.day = b.base WHERE n.day = DATE '{EVENTS_AS_OF}'),
rates AS (SELECT *, now - was AS change, (now - was) / datediff('day', base, DATE '{EVENTS_AS_OF}') AS per_day FROM wide),
growth AS (
  SELECT user_id, days AS "window", CASE WHEN base IS NULL THEN 'insufficient_history' WHEN was IS NULL THEN 'no_baseline' ELSE 'measured' END AS status,
         round(change, 4) AS change, round(per_day, 4) AS per_day, round(per_day * 30 / greatest(was, 100) * 100, 4) AS percent,
         CASE WHEN base IS NULL OR was IS NULL THEN 'none' WHEN abs(change) < 3 THEN 'flat' WHEN per_day * 30 / greatest(was, 100) * 100 >= 10 THEN 'surging' WHEN per_day * 30 / greatest(was, 100) * 100 >= 1 THEN 'rising'
              WHEN per_day * 30 / greatest(was, 100) * 100 <= -0.5 THEN 'declining' ELSE 'steady' END AS label
  FROM rates)"""


@query(f"WITH {GROWTH} SELECT * FROM growth")
def momentum_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.growth(history(spark, sf_dir), "user_id", EVENTS_AS_OF)


@query(f'WITH {GROWTH} SELECT "window", status, label, count(*) AS n FROM growth GROUP BY ALL')
def momentum_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.growth(history(spark, sf_dir), "user_id", EVENTS_AS_OF).groupBy("window", "status", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {DAILY}, three AS (SELECT user_id, max(total) FILTER (WHERE day = DATE '{EVENTS_AS_OF}') AS now, max(total) FILTER (WHERE day = DATE '{EVENTS_AS_OF}' - 7) AS mid, max(total) FILTER (WHERE day = DATE '{EVENTS_AS_OF}' - 14) AS old FROM daily GROUP BY user_id),
rates AS (SELECT user_id, (now - mid) / 7 AS recent, (mid - old) / 7 AS prior FROM three WHERE now IS NOT NULL AND mid IS NOT NULL AND old IS NOT NULL)
SELECT user_id, round(recent, 4) AS recent, round(prior, 4) AS prior, CASE WHEN abs(recent * 7) < 3 AND abs(prior * 7) < 3 THEN 'steady' WHEN recent - prior >= greatest(0.5, 0.25 * abs(prior)) THEN 'accelerating'
 WHEN recent - prior <= -greatest(0.5, 0.25 * abs(prior)) THEN 'decelerating' ELSE 'steady' END AS label FROM rates""")
def acceleration_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.acceleration(history(spark, sf_dir), "user_id", EVENTS_AS_OF, 7)


@query("""WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(CASE WHEN event_type = 'error' THEN -value ELSE value END) AS total FROM events GROUP BY 1, 2),
numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS n FROM days),
steps AS (SELECT b.user_id, b.day, b.n, a.total AS before, b.total - a.total AS step FROM numbered a JOIN numbered b ON a.user_id = b.user_id AND b.n = a.n + 1),
big AS (SELECT * FROM steps WHERE abs(step) >= greatest(100, 0.5 * greatest(before, 100))),
judged AS (SELECT g.user_id, g.day, g.step, min((l.total - g.before) / g.step) AS kept FROM big g LEFT JOIN numbered l ON l.user_id = g.user_id AND l.n > g.n GROUP BY 1, 2, 3)
SELECT user_id, CAST(day AS VARCHAR) AS day, round(step, 4) AS step, round(kept, 4) AS kept, CASE WHEN kept IS NULL THEN 'unconfirmed' WHEN kept < 0.5 THEN 'transient' ELSE 'confirmed' END AS outcome FROM judged""")
def jump_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step can be just the threshold, and what is kept just half of a digit: what is added up in which order then tells. It is the order of the events."""
    signed = F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value"))
    events = read(spark, sf_dir, "events").where("user_id is not null").select("event_id", "user_id", F.to_date("ts").alias("day"), signed.alias("signed"))
    days = asof.summed_in_order(events, ["user_id", "day"], ["event_id"], "signed")
    return asof.jumps(days, "user_id", 100.0, relative=0.5).withColumn("day", F.col("day").cast("string"))


@query(f"""WITH {DAILY}, points AS (SELECT DISTINCT user_id, CAST(ts AS DATE) + 2 AS day FROM events WHERE event_type = 'purchase')
SELECT p.user_id, CAST(p.day AS VARCHAR) AS day, CAST(CASE WHEN datediff('day', d.day, p.day) <= 3 THEN d.day END AS VARCHAR) AS base_day, round(CASE WHEN datediff('day', d.day, p.day) <= 3 THEN d.total END, 3) AS base FROM points p ASOF LEFT JOIN daily d ON p.user_id = d.user_id AND d.day <= p.day""")
def asof_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = read(spark, sf_dir, "events").where("event_type = 'purchase'").select("user_id", F.date_add(F.to_date("ts"), 2).alias("day")).distinct()
    found = asof.as_of_value(history(spark, sf_dir), points.withColumnRenamed("day", "point_day"), "user_id", "point_day", 3)
    return found.select("user_id", F.col("point_day").cast("string").alias("day"), F.col("base_day").cast("string").alias("base_day"), F.round("base", 3).alias("base"))


RADAR = mentions.Radar(weights={"purchase": 1.0, "signup": 0.9, "click": 0.7, "view": 0.6, "error": 0.5})
MENTIONS = f"""mentions AS (SELECT event_id AS item, event_type AS source, user_id AS author, ts, value AS points, CAST(json_extract_string(props, '$.k') AS BIGINT) AS key FROM events),
raws AS (SELECT *, round(CASE source WHEN 'purchase' THEN 1.0 WHEN 'signup' THEN 0.9 WHEN 'click' THEN 0.7 WHEN 'view' THEN 0.6 WHEN 'error' THEN 0.5 ELSE 1.0 END * ln(1 + greatest(points, 0)) * pow(0.5, ((epoch_us(TIMESTAMP '{EVENTS_AS_OF}') - epoch_us(ts)) / 86400000000.0) / 3.0), 6) AS raw
  FROM mentions WHERE ts <= TIMESTAMP '{EVENTS_AS_OF}' AND (epoch_us(TIMESTAMP '{EVENTS_AS_OF}') - epoch_us(ts)) / 86400000000.0 < 7),
contributions AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY key, source, author ORDER BY raw DESC, item) > 1 THEN round(raw * 0.25, 6) ELSE raw END AS contribution FROM raws),
counted AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY contribution DESC, item) <= 5 AS counts FROM contributions)"""


def contributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.contributions(events(spark, sf_dir), EVENTS_AS_OF, RADAR)


@query(f"""WITH {MENTIONS}, sums AS (SELECT key, sum(contribution) FILTER (WHERE counts) AS base, count(DISTINCT source) AS n_sources, count(*) AS n_mentions FROM counted GROUP BY key)
SELECT key, n_sources, n_mentions, round(base * (1 + 0.25 * (least(n_sources, 3) - 1)), 4) AS score FROM sums ORDER BY score DESC, key LIMIT 50""")
def radar_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.ranked(contributed(spark, sf_dir), RADAR).select("key", "n_sources", "n_mentions", "score").orderBy(F.desc("score"), "key").limit(50)


@query(f"WITH {MENTIONS} SELECT key, source, count(*) AS n_mentions, round(sum(points), 4) AS points, round(max(contribution), 4) AS best FROM counted GROUP BY key, source")
def radar_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.by_source(contributed(spark, sf_dir))


@query("""WITH m AS (SELECT event_id AS item, ts, value AS points, CAST(json_extract_string(props, '$.k') AS BIGINT) AS key FROM events),
ends AS (SELECT key, arg_min(points, (ts, item)) AS first, arg_max(points, (ts, item)) AS last, greatest((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0, 1.0) AS days FROM m GROUP BY key)
SELECT key, round(greatest((last - first) / days, 0.0), 4) AS velocity, CASE WHEN last > first THEN 'up' WHEN last < first THEN 'down' ELSE 'level' END AS trend FROM ends""")
def mention_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.velocity(events(spark, sf_dir), "key")


@query("""WITH m AS (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) AS key, ts, value AS points FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, points) AS f, row_number() OVER (PARTITION BY key ORDER BY ts DESC, points DESC) AS l FROM m)
SELECT key, arg_max(points, (ts, points)) AS points, string_agg(printf('%.2f', points), '|' ORDER BY ts, points) AS observed FROM r WHERE f = 1 OR l < 4 GROUP BY key""")
def mention_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    found = mentions.upsert(rows.where("item % 2 = 0"), rows.where("item % 2 = 1 or item % 4 = 0"), "key", 4)
    return found.select("key", "points", F.array_join(F.transform("observed", lambda x: F.format_string("%.2f", x["points"])), "|").alias("observed"))


@query("""SELECT user_id, count(*) AS n_steps, count(*) FILTER (WHERE k <> before) AS n_changes FROM (
  SELECT user_id, day, k, lag(k) OVER (PARTITION BY user_id ORDER BY day) AS before, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS last_day
  FROM (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, (ts, event_id)) AS k FROM events GROUP BY 1, 2)) WHERE datediff('day', last_day, day) = 1 GROUP BY user_id""")
def head_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    heads = read(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("k"))
    order = Window.partitionBy("user_id").orderBy("day")
    pairs = heads.withColumn("before", F.lag("k").over(order)).withColumn("last_day", F.lag("day").over(order)).where(F.datediff("day", "last_day") == 1)
    return pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_steps"), F.count_if(F.col("k") != F.col("before")).alias("n_changes"))


@query("""SELECT CAST(time_bucket(INTERVAL 1 DAY, ts) AS VARCHAR) AS day, event_type, count(*) AS n, round(sum(value), 3) AS total FROM (SELECT CAST(ts AS DATE) AS ts, event_type, value FROM events) GROUP BY 1, 2""")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.streaming.events import counts

    rows = counts(read(spark, sf_dir, "events"))
    return rows.select(F.to_date("day").cast("string").alias("day"), "event_type", "n", rounded(F.col("total"), 3).alias("total"))
