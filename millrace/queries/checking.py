"""Quality metrics, observability and disclosure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import text, times
from millrace.operators import quality
from millrace.queries.registry import query
from millrace.sources.tables import read


@query("""WITH r AS (SELECT source AS query, doc_id AS doc, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents),
rel AS (SELECT d.source AS query, doc_id AS doc FROM labels JOIN documents d USING (doc_id) WHERE quality = 1),
hits AS (SELECT query, count(*) AS n_returned, count(*) FILTER (WHERE (query, doc) IN (SELECT (query, doc) FROM rel)) AS n_hit FROM r WHERE rank <= 10 GROUP BY query), wanted AS (SELECT query, count(*) AS n_relevant FROM rel GROUP BY query)
SELECT query, coalesce(n_returned, 0) AS n_returned, coalesce(n_hit, 0) AS n_hit, coalesce(n_relevant, 0) AS n_relevant, round(n_hit / nullif(coalesce(n_relevant, 0), 0), 4) AS recall, round(n_hit / nullif(n_returned, 0), 4) AS precision FROM hits FULL JOIN wanted USING (query)""")
def precision_recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("source").alias("query"), F.col("doc_id").alias("doc"), "n_chars")
    ranked = docs.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("n_chars"), "doc")))
    relevant = docs.join(read(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("doc")), "doc").select("query", "doc")
    return quality.at_k(ranked, relevant, 10)


@query("""SELECT lang, source, CASE WHEN count(*) = 0 OR count(*) >= 5 THEN CAST(count(*) AS VARCHAR) ELSE '<5' END AS n FROM documents GROUP BY lang, source""")
def k_anonymous_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").groupBy("lang", "source").agg(quality.suppressed(F.count(F.lit(1))).alias("n"))


BUCKETS = "CASE WHEN value <= 5 THEN 5 WHEN value <= 10 THEN 10 WHEN value <= 20 THEN 20 WHEN value <= 50 THEN 50 ELSE 1000 END"


@query(f"""WITH c AS (SELECT event_type, {BUCKETS} AS bucket, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY bucket) AS running, sum(n) OVER (PARTITION BY event_type) AS total FROM c)
SELECT event_type, min(bucket) FILTER (WHERE running >= 0.5 * total) AS median, min(bucket) FILTER (WHERE running >= 0.95 * total) AS p95, CAST(max(total) AS BIGINT) AS total FROM r GROUP BY event_type""")
def bucket_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = read(spark, sf_dir, "events").groupBy("event_type", F.expr(BUCKETS).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    half = quality.bucket_quantile(counts, "event_type", "bucket", "n", 0.5).withColumnRenamed("bucket", "median")
    return half.join(quality.bucket_quantile(counts, "event_type", "bucket", "n", 0.95).select("event_type", F.col("bucket").alias("p95")), "event_type").select("event_type", "median", "p95", "total")


@query("""WITH f AS (SELECT substr(sha256(lower(regexp_replace(regexp_replace(concat('error in ', user_id % 7, ' at ', CAST(value AS INTEGER)), '[0-9]+$', '<n>'), ' at', ' near'))), 1, 12) AS fingerprint, CAST(ts AS DATE) AS day, CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS kind FROM events WHERE event_type = 'error')
SELECT fingerprint, CAST(min(day) AS VARCHAR) AS first_at, CAST(max(day) AS VARCHAR) AS last_at, count(*) AS occurrences, string_agg(DISTINCT CAST(kind AS VARCHAR), '|' ORDER BY CAST(kind AS VARCHAR)) AS kinds FROM f GROUP BY fingerprint""")
def fingerprint_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit("error in "), F.col("user_id") % 7, F.lit(" at "), F.floor(F.col("value") + 0.5).cast("int"))
    masked = F.regexp_replace(F.regexp_replace(said, "[0-9]+$", "<n>"), " at", " near")
    rows = read(spark, sf_dir, "events").where("event_type = 'error'").select(F.substring(F.sha2(F.lower(masked), 256), 1, 12).alias("fingerprint"), F.to_date("ts").alias("day"), (F.get_json_object("props", "$.k").cast("long") % 3).cast("string").alias("kind"))
    return quality.history(rows, "fingerprint", "day", "kind").withColumn("first_at", F.col("first_at").cast("string")).withColumn("last_at", F.col("last_at").cast("string"))


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events), h AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM n WHERE event_type IN ('click', 'view'))
SELECT user_id, island, count(*) AS length, min(i) AS start FROM h GROUP BY user_id, island""")
def streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return quality.streaks(rows, "user_id", ["ts", "event_id"], F.col("event_type").isin("click", "view")).select("user_id", F.col("island").cast("long"), "length", F.col("start").cast("long"))


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT NULL AS had_one,
coalesce(last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS previous FROM events""")
def previous_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    found = rows.withColumn("p", quality.previous_where("user_id", ["ts", "event_id"], F.col("event_type") == "purchase", F.col("event_id")))
    return found.select("event_id", F.col("p").isNotNull().alias("had_one"), F.coalesce("p", F.lit(-1)).alias("previous"))


@query("""WITH w AS (SELECT user_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1), n AS (SELECT user_id, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1)
SELECT w.user_id, w.n AS was, coalesce(n.n, 0) AS now FROM w LEFT JOIN n ON w.user_id = n.user_id WHERE w.n - coalesce(n.n, 0) >= 5 AND w.n - coalesce(n.n, 0) >= 0.05 * w.n""")
def shrink_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    count = lambda c: events.where(c).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return quality.shrunk(count("ts < timestamp_ntz'2024-01-16'"), count("ts >= timestamp_ntz'2024-01-16'"), "user_id", "n", 5, 0.05)


@query("""WITH a AS (SELECT o_custkey AS k, sum(o_totalprice) AS v FROM orders GROUP BY 1), b AS (SELECT o_custkey AS k, sum(l_extendedprice) AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT count(*) AS n, count(*) FILTER (WHERE abs(a.v - b.v) <= greatest(100000.0, 0.5 * abs(b.v))) AS n_agree FROM a JOIN b USING (k)""")
def corroborate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    ours = orders.groupBy(F.col("o_custkey").alias("k")).agg(F.sum("o_totalprice").alias("v"))
    theirs = read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("k")).agg(F.sum("l_extendedprice").alias("v"))
    return quality.agreement(ours, theirs, "k", "v", 100000.0, 0.5).agg(F.count(F.lit(1)).alias("n"), F.count_if("agrees").alias("n_agree"))


@query("""SELECT strftime(CAST(ts AS DATE) - CAST(isodow(ts) - 4 AS INTEGER), '%Y') || '-W' || lpad(CAST(week(ts) AS VARCHAR), 2, '0') AS week, event_type AS tool, CASE WHEN count(*) = 0 OR count(*) >= 5 THEN CAST(count(*) AS VARCHAR) ELSE '<5' END AS calls, round(avg(value), 3) AS mean FROM events GROUP BY 1, 2""")
def weekly_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy(times.iso_week(F.col("ts")).alias("week"), F.col("event_type").alias("tool")).agg(quality.suppressed(F.count(F.lit(1))).alias("calls"), F.round(F.avg("value"), 3).alias("mean"))


@query("""SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05) AS discounted, round(count(*) FILTER (WHERE l_discount > 0.05) / count(*), 4) AS share, round(median(l_quantity), 2) AS median_quantity FROM lineitem GROUP BY 1, 2""")
def summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.round(F.median("l_quantity"), 2).alias("median_quantity")).withColumn("share", F.round(F.col("discounted") / F.col("n"), 4))


@query("""SELECT doc_id, regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '<email>', 'g'), '(?i)(password|token|secret|api[_-]?key)\\s*[=:]\\s*[^ \\n]+', '\\1=<secret>', 'g') AS redacted FROM documents""")
def redacted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", text.mask(F.col("text"), text.SECRETS).alias("redacted"))
