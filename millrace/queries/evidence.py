"""Claims, relationships, gates and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import scores as s
from millrace.functions import times
from millrace.operators import reconcile, selection
from millrace.queries.registry import query
from millrace.sources.tables import AS_OF, claims, read

CLAIMS = """claims AS (
  SELECT l_partkey AS part, l_suppkey AS supp, o_orderpriority AS source, o_orderstatus AS status,
         concat(l_orderkey, ':', l_linenumber) AS locator, CAST(l_shipdate AS DATE) AS seen, l_quantity AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
RELATIONSHIPS = f"""{CLAIMS},
relationships AS (
  SELECT part, supp, count(DISTINCT source) AS source_count, string_agg(DISTINCT source, '|' ORDER BY source) AS source_ids, count(*) AS n_claims, max(seen) AS last_at
  FROM claims GROUP BY part, supp)"""
FRESH = ((0, 100.0), (90, 85.0), (365, 50.0), (1500, 0.0))
FRESH_SQL = """CASE WHEN age <= 0 THEN 100.0 WHEN age <= 90 THEN 100.0 + (age - 0.0) * ((85.0 - 100.0) / 90) WHEN age <= 365 THEN 85.0 + (age - 90.0) * ((50.0 - 85.0) / 275)
  WHEN age <= 1500 THEN 50.0 + (age - 365.0) * ((0.0 - 50.0) / 1135) ELSE 0.0 END"""
SCORED = f"""{RELATIONSHIPS},
aged AS (SELECT r.*, datediff('day', last_at, DATE '{AS_OF}') AS age, s_acctbal AS balance FROM relationships r JOIN supplier ON supp = s_suppkey),
scored AS (
  SELECT *, source_count >= 2 AS corroborated, CASE WHEN age <= 90 THEN 'active' WHEN age <= 365 THEN 'maintained' ELSE 'stale' END AS maintenance,
         round(0.4 * least(100.0, 55.0 + 15.0 * source_count) + 0.6 * {FRESH_SQL}, 2) AS score
  FROM aged),
gated AS (
  SELECT *, array_to_string(list_filter([CASE WHEN balance < 0 THEN 'negative_balance' END, CASE WHEN maintenance = 'stale' AND NOT corroborated THEN 'stale_single_source' END,
         CASE WHEN score < CASE WHEN corroborated THEN 35.0 ELSE 40.0 END THEN 'below_floor' END], lambda x: x IS NOT NULL), '|') AS reasons
  FROM scored)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relationships with age, maintenance, score and the reasons why their gate refuses them."""
    rows = reconcile.relationships(claims(spark, sf_dir), ["part", "supp"])
    supplier = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supp"), F.col("s_acctbal").alias("balance"))
    rows = rows.join(supplier, "supp").withColumn("age", times.age_days(F.col("last_at"), AS_OF))
    rows = rows.withColumn("maintenance", F.when(F.col("age") <= 90, "active").when(F.col("age") <= 365, "maintained").otherwise("stale"))
    evidence = F.least(F.lit(100.0), 55.0 + 15.0 * F.col("source_count"))
    rows = rows.withColumn("score", s.rounded(0.4 * evidence + 0.6 * s.curve(F.col("age"), FRESH), 2))
    floor = F.when(F.col("corroborated"), 35.0).otherwise(40.0)
    checks = [("negative_balance", F.col("balance") < 0), ("stale_single_source", (F.col("maintenance") == "stale") & ~F.col("corroborated")), ("below_floor", F.col("score") < floor)]
    return rows.withColumn("reasons", F.array_join(s.reasons(*checks), "|"))


@query(f"""WITH {SCORED},
ranked AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY score DESC, source_count DESC, supp) AS rank, count(*) OVER (PARTITION BY part) AS n FROM gated WHERE reasons = '')
SELECT part, supp, source_count, corroborated, maintenance, score, rank, greatest(n - 3, 0) AS more_available FROM ranked WHERE rank <= 3""")
def q0_ranked_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = scored(spark, sf_dir).where("reasons = ''").select("part", "supp", "source_count", "corroborated", "maintenance", "score")
    order = [F.desc("score"), F.desc("source_count"), F.col("supp")]
    ranked = passed.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy(*order))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("part")))
    return ranked.where("rank <= 3").select("part", "supp", "source_count", "corroborated", "maintenance", "score", "rank", F.greatest(F.col("n") - 3, F.lit(0)).alias("more_available"))


@query(f"WITH {RELATIONSHIPS} SELECT part, supp, source_ids, source_count, source_count >= 2 AS corroborated, n_claims, CAST(last_at AS VARCHAR) AS last_at FROM relationships")
def claims_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reconcile.relationships(claims(spark, sf_dir), ["part", "supp"])
    return rows.select("part", "supp", F.array_join("source_ids", "|").alias("source_ids"), "source_count", "corroborated", "n_claims", F.col("last_at").cast("string").alias("last_at"))


@query(f"""WITH {CLAIMS}, r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY source, seen, locator) AS rank FROM claims)
SELECT part, string_agg(concat_ws('|', source, CAST(seen AS VARCHAR), locator), ' ' ORDER BY rank) AS provenance FROM r WHERE rank <= 5 GROUP BY part""")
def claim_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.provenance(claims(spark, sf_dir), ["part"], ["source", "at", "locator"], 5).select("part", F.array_join("provenance", " ").alias("provenance"))


ALIASES_SQL = "aliases AS (SELECT p_name AS name, min(p_partkey) AS product FROM part WHERE p_brand <> 'Brand#1' GROUP BY p_name)"


def named_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims by the part's name, in two spellings."""
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("spelled"), F.col("p_name").alias("name"))
    return claims(spark, sf_dir).join(parts, "part")


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").where("p_brand <> 'Brand#1'").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("product")).where("name not like 'red%'")


NAMED_SQL = f"""{CLAIMS}, named AS (SELECT c.*, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS spelled, p_name AS name FROM claims c JOIN part ON part = p_partkey),
aliases AS (SELECT p_name AS name, min(p_partkey) AS product FROM part WHERE p_brand <> 'Brand#1' AND p_name NOT LIKE 'red%' GROUP BY p_name)"""


@query(f"WITH {NAMED_SQL} SELECT product, count(*) AS n_claims, count(DISTINCT source) AS n_sources FROM named JOIN aliases USING (name) GROUP BY product")
def claims_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, _ = reconcile.resolve(named_claims(spark, sf_dir), aliases(spark, sf_dir), "name", "product")
    return known.groupBy("product").agg(F.count(F.lit(1)).alias("n_claims"), F.countDistinct("source").alias("n_sources"))


@query(f"""WITH {NAMED_SQL} SELECT lower(trim(spelled)) AS key, count(*) AS n_claims, string_agg(DISTINCT spelled, '|' ORDER BY spelled) AS spellings, string_agg(DISTINCT source, '|' ORDER BY source) AS sources
FROM named LEFT JOIN aliases USING (name) WHERE product IS NULL GROUP BY 1""")
def uncatalogued_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, unknown = reconcile.resolve(named_claims(spark, sf_dir), aliases(spark, sf_dir), "name", "product")
    return reconcile.unresolved(unknown, "spelled", "source")


CODES = {"negative_balance": "R1", "stale_single_source": "R2", "below_floor": "R3"}


@query(f"""WITH {SCORED} SELECT CASE WHEN contains(reasons, 'negative_balance') THEN 'R1' WHEN contains(reasons, 'stale_single_source') THEN 'R2' ELSE 'R3' END AS code, reasons, count(*) AS n
FROM gated WHERE reasons <> '' GROUP BY 1, 2""")
def rejection_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = scored(spark, sf_dir).where("reasons <> ''")
    return refused.withColumn("code", reconcile.rejection_code(F.replace("reasons", F.lit("|"), F.lit(";")), CODES)).groupBy("code", "reasons").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT lower(p_name) AS canonical, count(*) AS n, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS brands, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS types, min(p_partkey) AS first_part,
arg_min(p_retailprice, p_partkey) AS price FROM part GROUP BY 1""")
def rename_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select(F.lower("p_name").alias("canonical"), F.array("p_brand").alias("brands"), F.array("p_type").alias("types"), F.array(F.lit(1)).alias("one"), F.col("p_partkey").alias("first_part"), F.col("p_retailprice").alias("price"))
    found = reconcile.merged(rows, "canonical", ["brands", "types"], {"first_part": "first_part", "price": "first_part"})
    counts = rows.groupBy("canonical").agg(F.count(F.lit(1)).alias("n"))
    return found.join(counts, "canonical").select("canonical", "n", F.array_join("brands", "|").alias("brands"), F.array_join("types", "|").alias("types"), "first_part", "price")


@query(f"""WITH {SCORED} SELECT why, count(*) AS n FROM (SELECT CASE WHEN balance < 0 THEN 'negative_balance' WHEN maintenance = 'stale' AND NOT corroborated THEN 'stale_single_source' WHEN score < 45 THEN 'low_score' END AS why FROM gated)
WHERE why IS NOT NULL GROUP BY why""")
def first_failing_constraint(spark: SparkSession, sf_dir: str) -> DataFrame:
    why = s.first_failing(("negative_balance", F.col("balance") < 0), ("stale_single_source", (F.col("maintenance") == "stale") & ~F.col("corroborated")), ("low_score", F.col("score") < 45))
    return scored(spark, sf_dir).select(why.alias("why")).where("why is not null").groupBy("why").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SCORED} SELECT part, supp, reasons, CASE WHEN reasons = '' THEN 'eligible' WHEN reasons = 'below_floor' THEN 'near_miss' ELSE 'refused' END AS lane FROM gated")
def eligibility_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    lane = F.when(F.col("reasons") == "", "eligible").when(F.col("reasons") == "below_floor", "near_miss").otherwise("refused")
    return scored(spark, sf_dir).select("part", "supp", "reasons", lane.alias("lane"))


@query(f"WITH {SCORED} SELECT maintenance, corroborated, count(*) AS n, round(avg(score), 3) AS mean_score FROM gated GROUP BY ALL")
def lanes_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).groupBy("maintenance", "corroborated").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 3).alias("mean_score"))


@query(f"""WITH {SCORED} SELECT tier, count(*) AS n, count(*) FILTER (WHERE reasons = '') AS passed, round(count(*) FILTER (WHERE reasons = '') / count(*), 4) AS pass_rate FROM (SELECT *, CASE WHEN corroborated THEN 'corroborated' ELSE 'single_source' END AS tier FROM gated) GROUP BY tier""")
def gate_pass_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.when(F.col("corroborated"), "corroborated").otherwise("single_source")
    return scored(spark, sf_dir).groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("reasons") == "").alias("passed")).withColumn("pass_rate", F.round(F.col("passed") / F.col("n"), 4))


SIGNALS = """signals AS (
  SELECT c_custkey AS customer, count(o_orderkey) AS n_orders, max(CAST(o_orderdate AS DATE)) AS last_order, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 WHEN o_orderstatus = 'O' THEN 0.0 END) AS finished, c_acctbal AS balance
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal),
parts AS (
  SELECT *, CASE WHEN n_orders >= 5 THEN finished * 100 END AS p_finished, CASE WHEN balance >= 0 THEN least(1.0, log10(1 + balance) / log10(10001.0)) * 100 END AS p_balance,
         CASE WHEN last_order IS NOT NULL THEN greatest(0.0, 100.0 - datediff('day', last_order, DATE '2001-12-31') / 5.0) END AS p_recent FROM signals)"""


def customer_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max(F.to_date("o_orderdate")).alias("last_order"), F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "O", 0.0)).alias("finished"))
    rows = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer"), F.col("c_acctbal").alias("balance")).join(orders, F.col("customer") == F.col("o_custkey"), "left")
    rows = rows.withColumn("n_orders", F.coalesce("n", F.lit(0)))
    return rows.withColumn("p_finished", F.when(F.col("n_orders") >= 5, F.col("finished") * 100)).withColumn("p_balance", F.when(F.col("balance") >= 0, s.log_share(F.col("balance"), 10000) * 100)).withColumn("p_recent", F.when(F.col("last_order").isNotNull(), F.greatest(F.lit(0.0), 100.0 - times.age_days(F.col("last_order"), AS_OF) / 5.0)))


PARTS = (40.0, "p_finished"), (25.0, "p_balance"), (35.0, "p_recent")
KNOWN = "(" + " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {w} ELSE 0 END" for w, c in PARTS) + ")"
TOTAL = "(" + " + ".join(f"coalesce({c} * {w}, 0)" for w, c in PARTS) + ")"


@query(f"""WITH {SIGNALS} SELECT customer, round({TOTAL} / nullif({KNOWN}, 0), 3) AS health, round({KNOWN} / 100, 4) AS known,
CASE WHEN {KNOWN} / 100 < 0.5 THEN 'insufficient' WHEN round({TOTAL} / {KNOWN}, 3) >= 70 THEN 'strong' WHEN round({TOTAL} / {KNOWN}, 3) >= 40 THEN 'fair' ELSE 'weak' END AS band FROM parts WHERE {KNOWN} > 0""")
def health_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [(w, F.col(c)) for w, c in PARTS]
    rows = customer_parts(spark, sf_dir).select("customer", F.round(s.known_mean(parts), 3).alias("health"), F.round(s.known_share(parts), 4).alias("known")).where("known > 0")
    return rows.withColumn("band", F.when(F.col("known") < 0.5, "insufficient").otherwise(s.band(F.col("health"), [(70, "strong"), (40, "fair"), (0, "weak")])))


@query(f"""WITH {SCORED} SELECT part, supp, round(least(0.5 * score + 0.5 * least(100.0, n_claims * 20.0), CASE WHEN corroborated THEN 100.0 ELSE 80.0 END, CASE WHEN maintenance = 'stale' THEN 45.0 ELSE 100.0 END), 3) AS fit FROM gated""")
def caps_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = 0.5 * F.col("score") + 0.5 * F.least(F.lit(100.0), F.col("n_claims") * 20.0)
    capped = s.capped(raw, F.when(F.col("corroborated"), 100.0).otherwise(80.0), F.when(F.col("maintenance") == "stale", 45.0).otherwise(100.0))
    return scored(spark, sf_dir).select("part", "supp", F.round(capped, 3).alias("fit"))


@query(f"""WITH {SIGNALS} SELECT customer, round(exp(avg(ln(greatest(x / 50, 0.01)))), 4) AS trajectory FROM (SELECT customer, unnest([p_finished, p_balance, p_recent]) AS x FROM parts) WHERE x IS NOT NULL GROUP BY customer""")
def trajectory_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.explode(F.array_compact(F.array("p_finished", "p_balance", "p_recent")))
    return customer_parts(spark, sf_dir).select("customer", known.alias("x")).groupBy("customer").agg(F.round(F.exp(F.avg(F.log(F.greatest(F.col("x") / 50, F.lit(0.01))))), 4).alias("trajectory"))


@query(f"""WITH {CLAIMS} SELECT part, count(DISTINCT status) AS n_values, count(DISTINCT source) AS n_sources FROM claims GROUP BY part HAVING count(DISTINCT status) > 1 AND count(DISTINCT source) >= 3""")
def contradicted_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.contradictions(claims(spark, sf_dir), "part", "status", "source")


@query("""SELECT o_custkey AS customer, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS newest FROM orders GROUP BY o_custkey""")
def supersede_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("newest"), "o_orderdate")
    return reconcile.supersede(rows, ["customer"], [F.col("o_orderdate"), F.col("newest")]).select("customer", "status", "newest")


@query(f"""WITH {CLAIMS}, was AS (SELECT part, count(*) AS n, count(DISTINCT source) AS k FROM claims WHERE seen < DATE '2000-01-01' GROUP BY part), now AS (SELECT part, count(*) AS n, count(DISTINCT source) AS k FROM claims WHERE seen >= DATE '2000-01-01' GROUP BY part)
SELECT coalesce(was.part, now.part) AS part, CASE WHEN was.part IS NULL THEN 'new' WHEN now.part IS NULL THEN 'dropped' WHEN was.n <> now.n OR was.k <> now.k THEN 'changed' ELSE 'same' END AS change,
CASE WHEN was.part IS NULL OR now.part IS NULL THEN '' ELSE concat_ws('|', CASE WHEN was.n <> now.n THEN 'n' END, CASE WHEN was.k <> now.k THEN 'k' END) END AS columns FROM was FULL JOIN now ON was.part = now.part""")
def presence_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = claims(spark, sf_dir)
    side = lambda c: rows.where(c).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source").alias("k"))
    return reconcile.present(side("at < date '2000-01-01'"), side("at >= date '2000-01-01'"), "part", ["n", "k"])


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def dangling_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return reconcile.dangling(read(spark, sf_dir, "lineitem"), orders, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


@query(f"""WITH {SCORED} SELECT part, list_agg AS document FROM (SELECT part, string_agg(concat(supp, '=', printf('%.2f', score)), ',' ORDER BY supp) AS list_agg FROM gated WHERE reasons = '' GROUP BY part)""")
def product_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).where("reasons = ''")
    return rows.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("supp", "score"))).alias("s")).select("part", F.array_join(F.transform("s", lambda x: F.concat(x["supp"].cast("string"), F.lit("="), F.format_string("%.2f", x["score"]))), ",").alias("document"))
