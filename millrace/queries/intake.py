"""Intake: qualification, licences, what is known already, overlays, selection under budgets, and what runs report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import scores
from millrace.functions.scores import rounded
from millrace.operators import evidence, intake
from millrace.queries.registry import query
from millrace.sources.tables import TEXT_LINES, read

FAMILIES = {"Fasteners": ("bolt", "screw", "ring"), "Machines": ("GEAR", "widget")}
ALLOWED = ("MIT", "Apache-2.0", "BSD-3-Clause")
LICENCES = ("MIT", "GPL-X", "NOASSERTION", "Apache-2.0", "Custom")
ACTIVITY = intake.Activity(bots=r"(?i)(bot$|^Customer#0+\d*7$)", documents=r"(?i)(^en$|\.md$|^docs$)", housekeeping=r"(?i)^(fr|\.github)$", code=r"(?i)\.py$", version=r"(?i)^v?[0-9]+(\.[0-9]+)+$")


def noun(column: str) -> Column:
    return F.element_at(F.split(column, " "), -1)


@query("""SELECT p_partkey, string_split(p_name, ' ')[-1] IN ('bolt', 'screw', 'ring') AS fastener, string_split(p_name, ' ')[-1] IN ('gear', 'widget') AS machine, false AS unlisted FROM part""")
def family_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda wanted: intake.in_family(noun("p_name"), FAMILIES, wanted)
    return read(spark, sf_dir, "part").select("p_partkey", of("fasteners").alias("fastener"), of("machines").alias("machine"), of("nothing").alias("unlisted"))


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM documents),
n AS (SELECT doc_id, list_filter(ws[1:3], lambda x: length(x) >= 3) AS known, list_filter(ws[4:5], lambda x: length(x) >= 3) AS mine FROM w),
pairs AS (SELECT doc_id, unnest(known) AS k, mine FROM n),
hits AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, k, unnest(mine) AS m FROM pairs) WHERE contains(m, k) OR contains(k, m))
SELECT doc_id, doc_id NOT IN (SELECT doc_id FROM hits) AS drifted FROM documents WHERE text IS NOT NULL""")
def identity_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text's first three words are the names it was listed under, the next two those it has now."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    rows = read(spark, sf_dir, "documents").where("text is not null").select("doc_id", words.alias("w"))
    return rows.select("doc_id", intake.drifted(F.slice("w", 1, 3), F.slice("w", 4, 2)).alias("drifted"))


CHANGES = """changes AS (SELECT page_id, c_name AS author, string_split(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/') AS paths
FROM pages LEFT JOIN customer ON c_custkey = page_id)"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = F.split(F.btrim(F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1), F.lit("/")), "/")
    authors = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page_id"), F.col("c_name").alias("author"))
    return read(spark, sf_dir, "pages").select("page_id", paths.alias("paths")).join(authors, "page_id", "left")


@query(f"""WITH {CHANGES} SELECT page_id, CASE WHEN coalesce(regexp_matches(author, '(?i)(bot$|^Customer#0+\\d*7$)'), false) THEN 'automation_author'
WHEN NOT list_bool_or(list_transform(paths, lambda p: regexp_matches(p, '(?i)\\.py$') OR NOT (regexp_matches(p, '(?i)(^en$|\\.md$|^docs$)') OR regexp_matches(p, '(?i)^(fr|\\.github)$'))))
  THEN 'documentation_or_housekeeping_only' ELSE 'touches_code' END AS reason FROM changes""")
def change_qualification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir).select("page_id", ACTIVITY.change(F.col("author"), F.col("paths")).alias("reason"))


@query(f"""WITH {CHANGES}, r AS (SELECT page_id, page_id % 7 = 0 AS draft, CASE WHEN page_id % 3 = 0 THEN 'nightly' ELSE 'v' || page_id || '.1' END AS ref, paths[1:1] AS paths FROM changes)
SELECT page_id, CASE WHEN draft THEN 'draft' WHEN NOT regexp_matches(ref, '(?i)^v?[0-9]+(\\.[0-9]+)+$') THEN 'not_a_version_tag'
WHEN regexp_matches(paths[1], '(?i)(^en$|\\.md$|^docs$)') THEN 'tagged_commit_documentation_only' ELSE 'version_release' END AS reason FROM r""")
def release_qualification(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.when(F.col("page_id") % 3 == 0, "nightly").otherwise(F.concat(F.lit("v"), F.col("page_id").cast("string"), F.lit(".1")))
    return changes(spark, sf_dir).select("page_id", ACTIVITY.release(F.col("page_id") % 7 == 0, ref, F.slice("paths", 1, 1)).alias("reason"))


LICENCE_LIST = "['" + "', '".join(LICENCES) + "']"
READINGS = f"""readings AS (SELECT p_partkey, {LICENCE_LIST}[1 + p_partkey % 5] AS host, CASE WHEN p_size % 4 = 0 THEN {LICENCE_LIST}[1 + p_size % 5] END AS text,
CASE WHEN p_partkey % 11 = 0 THEN 'BSD-3-Clause' END AS reviewed, p_partkey % 13 = 0 AS excepted FROM part)"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the host, the detector of texts and a reviewer say of each part's licence."""
    named = lambda c: F.element_at(F.array(*map(F.lit, LICENCES)), (1 + F.col(c) % 5).cast("int"))
    return read(spark, sf_dir, "part").select(
        "p_partkey", "p_size", named("p_partkey").alias("host"), F.when(F.col("p_size") % 4 == 0, named("p_size")).alias("text"),
        F.when(F.col("p_partkey") % 11 == 0, "BSD-3-Clause").alias("reviewed"), (F.col("p_partkey") % 13 == 0).alias("excepted"),
    )


VERDICTS = f"""{READINGS}, verdicts AS (SELECT *, host IN ('MIT', 'Apache-2.0', 'BSD-3-Clause') AS h, coalesce(text IN ('MIT', 'Apache-2.0', 'BSD-3-Clause'), false) AS t, reviewed IS NOT NULL AS r FROM readings)"""


@query(f"""WITH {VERDICTS} SELECT p_partkey, CASE WHEN h THEN host WHEN t THEN text WHEN r THEN reviewed ELSE host END AS licence,
CASE WHEN h THEN 'host' WHEN t THEN 'text' WHEN r THEN 'reviewed' ELSE 'unrecognised' END AS method, h OR t OR r OR excepted AS usable FROM verdicts""")
def licence_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    licence, method, usable = intake.verdict([(x, F.col(x)) for x in ("host", "text", "reviewed")], ALLOWED, F.col("excepted"))
    return readings(spark, sf_dir).select("p_partkey", licence.alias("licence"), method.alias("method"), usable.alias("usable"))


@query(f"""WITH {VERDICTS} SELECT v.p_partkey, CASE WHEN p_size % 9 = 0 THEN 'undetermined' WHEN p_size % 3 = 0 AND host = 'NOASSERTION' THEN 'missing' WHEN p_size % 5 = 0 THEN 'source_available'
WHEN p_size % 7 = 0 THEN 'open_core' WHEN p_size % 6 = 1 THEN 'restricted' WHEN host <> 'NOASSERTION' THEN 'non_osi' WHEN p_size % 2 = 0 THEN 'conflicting' ELSE 'unrecognised' END AS category
FROM verdicts v JOIN part USING (p_partkey) WHERE NOT (h OR t OR r)""")
def licence_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, method, _ = intake.verdict([(x, F.col(x)) for x in ("host", "text", "reviewed")], ALLOWED, F.col("excepted"))
    size = F.col("p_size")
    category = intake.issue(size % 9 != 0, F.when(size % 3 == 0, 0).otherwise(1), F.col("host"), size % 5 == 0, size % 7 == 0, (size % 6 == 1).cast("int"), size % 2 == 0)
    return readings(spark, sf_dir).where(method == "unrecognised").select("p_partkey", category.alias("category"))


KNOWN = """corpus AS (SELECT l_suppkey * 100000 + l_partkey AS id, 'part' || l_partkey AS key, l_returnflag AS host, CASE WHEN l_linenumber = 1 THEN l_orderkey END AS host_id FROM lineitem WHERE l_partkey % 4 = 0),
candidates AS (SELECT 'part' || p_partkey AS key, CASE WHEN p_size % 2 = 0 THEN ['part' || (p_partkey + 1), 'part' || (p_partkey + 2)] END AS aliases, ['A', 'N', 'R'][1 + p_partkey % 3] AS host, p_partkey * 3 AS host_id FROM part),
names AS (SELECT key, 0 AS place, key AS name FROM candidates UNION ALL SELECT key, 1, aliases[1] FROM candidates WHERE aliases IS NOT NULL UNION ALL SELECT key, 2, aliases[2] FROM candidates WHERE aliases IS NOT NULL),
by_key AS (SELECT n.key, arg_min(k.id, n.place) AS found FROM names n JOIN (SELECT key AS name, min(id) AS id FROM corpus GROUP BY key) k USING (name) GROUP BY n.key),
by_host AS (SELECT host, host_id, min(id) AS found FROM corpus WHERE host_id IS NOT NULL GROUP BY 1, 2),
matched AS (SELECT c.key, coalesce(k.found, h.found) AS known_id, CASE WHEN k.found IS NOT NULL THEN 'key_or_alias' WHEN h.found IS NOT NULL THEN 'host_repo_id' END AS by_
  FROM candidates c LEFT JOIN by_key k USING (key) LEFT JOIN by_host h ON c.host = h.host AND c.host_id = h.host_id)"""


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda c: F.concat(F.lit("part"), c.cast("string"))
    corpus = read(spark, sf_dir, "lineitem").where("l_partkey % 4 = 0").select(
        (F.col("l_suppkey") * 100000 + F.col("l_partkey")).alias("id"), part(F.col("l_partkey")).alias("key"), F.col("l_returnflag").alias("host"), F.when(F.col("l_linenumber") == 1, F.col("l_orderkey")).alias("host_id")
    )
    key = F.col("p_partkey")
    candidates = read(spark, sf_dir, "part").select(
        part(key).alias("key"), F.when(F.col("p_size") % 2 == 0, F.array(part(key + 1), part(key + 2))).alias("aliases"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (1 + key % 3).cast("int")).alias("host"), (key * 3).alias("host_id"),
    )
    return intake.known_before(candidates, corpus, "key", "aliases", "host", "host_id", "id").select("key", "known_id", "by")


@query(f"WITH {KNOWN} SELECT key FROM matched WHERE known_id IS NULL")
def alias_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir).where("known_id is null").select("key")


@query(f"WITH {KNOWN} SELECT coalesce(by_, 'new') AS reason, count(*) AS n FROM matched GROUP BY 1")
def identity_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir).groupBy(F.coalesce("by", F.lit("new")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


PATTERNS = (("short_word", "(?i)(^|[^a-z])(is|of|the)([^a-z]|$)"), ("ending", "(?i)[a-z]{4,}tion([^a-z]|$)"), ("number", "(^|[^0-9])[0-9]{3,}([^0-9]|$)"), ("mail", "[a-z0-9.]+@[a-z0-9.]+"))
PATTERNS_SQL = ", ".join(f"('{a}', '{b}')" for a, b in PATTERNS)


@query(f"SELECT doc_id, concept FROM documents JOIN (VALUES {PATTERNS_SQL}) p(concept, pattern) ON regexp_matches(text, pattern)")
def keyword_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns are given, so their number is bounded: a row meets each of them where it lies."""
    hits = F.array_compact(F.array(*[F.when(F.col("text").rlike(p), F.lit(name)) for name, p in PATTERNS]))
    return read(spark, sf_dir, "documents").select("doc_id", F.explode(hits).alias("concept"))


@query(f"""SELECT concept, CASE WHEN concept = 'mail' THEN -1 ELSE count(doc_id) END AS supply FROM (VALUES {PATTERNS_SQL}) p(concept, pattern)
LEFT JOIN documents ON concept <> 'mail' AND lang = 'en' AND regexp_matches(text, pattern) GROUP BY concept""")
def category_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many active rows each category's pattern finds; unknown, told as -1, for a category without one."""
    counts = read(spark, sf_dir, "documents").where("lang = 'en'").agg(*[F.count_if(F.col("text").rlike(p)).alias(name) for name, p in PATTERNS])
    rows = F.array(*[F.struct(F.lit(name).alias("concept"), (F.lit(-1).cast("long") if name == "mail" else F.col(name)).alias("supply")) for name, _ in PATTERNS])
    return counts.select(F.inline(rows))


@query("""WITH terms AS (SELECT p_partkey, lower(p_name) AS identity, unnest([lower(p_type), string_split(p_name, ' ')[1], 'bolt']) AS term, p_name || ' ' || p_type || ' ' || p_brand AS body FROM part)
SELECT p_partkey, count(DISTINCT term) FILTER (WHERE contains(identity, term)) AS in_identity, count(DISTINCT term) FILTER (WHERE NOT contains(identity, term) AND contains(lower(body), term)) AS in_body FROM terms GROUP BY p_partkey""")
def term_set_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of a pair's terms its identity has, and how many only its text has; the terms lie in the row, so nothing is shuffled."""
    identity, body = F.lower("p_name"), F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    terms = F.array_distinct(F.array(F.lower("p_type"), F.element_at(F.split("p_name", " "), 1), F.lit("bolt")))
    own, rest = F.filter(terms, lambda t: F.contains(identity, t)), F.filter(terms, lambda t: ~F.contains(identity, t) & F.contains(body, t))
    return read(spark, sf_dir, "part").select("p_partkey", F.size(own).cast("long").alias("in_identity"), F.size(rest).cast("long").alias("in_body"))


@query("""WITH topics AS (SELECT DISTINCT l_orderkey AS project, lower(string_split(p_name, ' ')[2]) AS topic FROM lineitem JOIN part ON l_partkey = p_partkey),
keys AS (SELECT DISTINCT lower(string_split(p_name, ' ')[2]) AS topic, 'saas:' || lower(string_split(p_name, ' ')[2]) AS product FROM part WHERE p_size > 40),
replaced AS (SELECT DISTINCT l_orderkey AS project, 'saas:' || lower(string_split(p_name, ' ')[2]) AS product FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R')
SELECT project, product FROM topics JOIN keys USING (topic) WHERE topic NOT IN ('ring') AND (project, product) NOT IN (SELECT project, product FROM replaced)""")
def integration_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic that is a product's key, is not stop-listed and whose product the project does not replace, ties the two."""
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.lower(noun("p_name")).alias("topic"), "p_size")
    product = F.concat(F.lit("saas:"), F.col("topic")).alias("product")
    items = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("project"), "l_partkey", "l_returnflag").join(parts, "l_partkey")
    keys = parts.where("p_size > 40").select("topic", product).distinct()
    found = items.where(~F.col("topic").isin("ring")).select("project", "topic").distinct().join(keys, "topic").select("project", "product")
    return found.join(items.where("l_returnflag = 'R'").select("project", product).distinct(), ["project", "product"], "left_anti")


@query("""WITH r AS (SELECT o_orderkey, (o_custkey || '/' || o_orderpriority) AS slug, ['github', 'gitea', 'forge'][1 + o_orderkey % 3] AS host FROM orders),
g AS (SELECT slug, coalesce(min(o_orderkey) FILTER (WHERE host = 'github'), min(o_orderkey)) AS "primary" FROM r GROUP BY slug HAVING count(DISTINCT host) > 1)
SELECT o_orderkey AS alias, "primary" FROM r JOIN g USING (slug) WHERE o_orderkey <> "primary" """)
def cross_host_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.element_at(F.array(F.lit("github"), F.lit("gitea"), F.lit("forge")), (1 + F.col("o_orderkey") % 3).cast("int"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws("/", F.col("o_custkey").cast("string"), "o_orderpriority").alias("slug"), host.alias("host"))
    return intake.cross_host(rows, "slug", "host", "o_orderkey", "github")


@query("""WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS stars, count(*) AS forks, bool_or(event_type <> 'error') AS found FROM events GROUP BY 1, 2),
p AS (SELECT * FROM days WHERE day = DATE '2024-01-10'), l AS (SELECT * FROM days WHERE day = DATE '2024-01-11'), d AS (SELECT * FROM days WHERE day = DATE '2024-01-12' AND user_id % 3 = 0),
j AS (SELECT coalesce(p.user_id, d.user_id) AS user_id, p.stars AS ps, p.forks AS pf, coalesce(p.found, false) AND coalesce(l.found, false) AS over, l.stars AS ls, d.user_id IS NOT NULL AS deep, d.stars AS ds, d.forks AS df
  FROM p FULL JOIN d ON p.user_id = d.user_id LEFT JOIN l ON l.user_id = coalesce(p.user_id, d.user_id))
SELECT user_id, round(CASE WHEN deep THEN ds WHEN over THEN ls ELSE ps END, 4) AS stars, CASE WHEN deep THEN df ELSE pf END AS forks, CASE WHEN deep THEN 'deep' WHEN over THEN 'light_over_previous' ELSE 'previous' END AS origin FROM j""")
def snapshot_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(day: str) -> DataFrame:
        rows = read(spark, sf_dir, "events").where(F.to_date("ts") == F.lit(day).cast("date"))
        return rows.groupBy("user_id").agg(F.sum("value").alias("stars"), F.count(F.lit(1)).alias("forks"), F.bool_or(F.col("event_type") != "error").alias("found"))

    merged = intake.overlay(of("2024-01-10"), of("2024-01-11"), of("2024-01-12").where("user_id % 3 = 0"), "user_id", ["stars", "forks"], ["stars"])
    return merged.withColumn("stars", rounded(F.col("stars")))


@query("""WITH names AS (SELECT DISTINCT lower(p_name) AS name FROM part UNION SELECT DISTINCT 'brand ' || p_size FROM part UNION SELECT lower(n_name) FROM nation),
one AS (SELECT lower(p_name) AS name, p_partkey AS id FROM part WHERE p_size > 45), two AS (SELECT lower(p_name) AS name, p_partkey AS id FROM part WHERE p_size > 5), three AS (SELECT lower(n_name) AS name, n_nationkey AS id FROM nation),
f AS (SELECT name, (SELECT min(id) FROM one o WHERE o.name = n.name) AS a, (SELECT max(id) FROM one o WHERE o.name = n.name) AS a2, (SELECT min(id) FROM two o WHERE o.name = n.name) AS b, (SELECT max(id) FROM two o WHERE o.name = n.name) AS b2,
 (SELECT min(id) FROM three o WHERE o.name = n.name) AS c, (SELECT max(id) FROM three o WHERE o.name = n.name) AS c2 FROM names n)
SELECT name, coalesce(CASE WHEN a IS NOT NULL THEN CASE WHEN a = a2 THEN a END WHEN b IS NOT NULL THEN CASE WHEN b = b2 THEN b END WHEN c = c2 THEN c END, -1) AS id,
CASE WHEN a IS NOT NULL THEN 'canonical' WHEN b IS NOT NULL THEN 'corpus' WHEN c IS NOT NULL THEN 'owner' ELSE '' END AS step,
CASE WHEN a IS NOT NULL THEN CASE WHEN a = a2 THEN 'found' ELSE 'ambiguous' END WHEN b IS NOT NULL THEN CASE WHEN b = b2 THEN 'found' ELSE 'ambiguous' END WHEN c IS NOT NULL THEN CASE WHEN c = c2 THEN 'found' ELSE 'ambiguous' END ELSE 'unknown' END AS status FROM f""")
def name_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(F.lower("p_name").alias("name"), F.col("p_partkey").alias("id"), "p_size")
    nation = read(spark, sf_dir, "nation").select(F.lower("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("id"))
    names = part.select("name").union(part.select(F.concat(F.lit("brand "), F.col("p_size").cast("string")))).union(nation.select("name"))
    steps = [("canonical", part.where("p_size > 45")), ("corpus", part.where("p_size > 5")), ("owner", nation)]
    return intake.resolved(names, "name", steps).select("name", F.coalesce("id", F.lit(-1)).cast("long").alias("id"), F.coalesce("step", F.lit("")).alias("step"), "status")


SIGNALS = """signals AS (SELECT l_suppkey, count(*) AS n, CASE WHEN count(*) >= 20 THEN avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) END AS returned, CASE WHEN count(*) FILTER (WHERE l_linestatus = 'F') >= 10 THEN
 avg(l_discount) FILTER (WHERE l_linestatus = 'F') END AS discount, max(l_shipdate) AS newest, CASE WHEN sum(CASE WHEN year(l_shipdate) = 1996 THEN 1 ELSE 0 END) >= 5 THEN sum(CASE WHEN year(l_shipdate) = 1997 THEN 1 ELSE 0 END) * 1.0 / sum(CASE WHEN year(l_shipdate) = 1996 THEN 1 ELSE 0 END) END AS yearly
 FROM lineitem GROUP BY l_suppkey),
tops AS (SELECT l_suppkey, max(c) AS top FROM (SELECT l_suppkey, l_partkey, count(*) AS c FROM lineitem GROUP BY 1, 2) GROUP BY l_suppkey),
all_signals AS (SELECT s.*, CASE WHEN n >= 20 THEN top * 1.0 / n END AS top_share FROM signals s JOIN tops USING (l_suppkey))"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares and ratios of a supplier's lines, unknown where there are too few; the counts by part come first, so that one pass over them gives all."""
    year = F.year("l_shipdate")
    parts = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(
        F.count(F.lit(1)).alias("c"), F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count_if(F.col("l_linestatus") == "F").alias("f"), F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_discount"))).alias("d"),
        F.max("l_shipdate").alias("newest"), F.count_if(year == 1996).alias("y6"), F.count_if(year == 1997).alias("y7"),
    )
    sums = parts.groupBy("l_suppkey").agg(F.sum("c").alias("n"), F.sum("r").alias("r"), F.sum("f").alias("f"), F.sum("d").alias("d"), F.max("newest").alias("newest"), F.sum("y6").alias("y6"), F.sum("y7").alias("y7"), F.max("c").alias("top"))
    share = lambda x, of, least: F.when(F.col(of) >= least, F.col(x) / F.col(of))
    return sums.select("l_suppkey", "n", share("r", "n", 20).alias("returned"), share("d", "f", 10).alias("discount"), "newest", share("y7", "y6", 5).alias("yearly"), share("top", "n", 20).alias("top_share"))


@query(f"""WITH {SIGNALS} SELECT l_suppkey, n, round(returned, 4) AS returned, round(discount, 4) AS discount, CAST(CAST(newest AS DATE) AS VARCHAR) AS newest, round(yearly, 4) AS yearly, round(top_share, 4) AS top_share FROM all_signals""")
def signal_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    return rows.select("l_suppkey", "n", F.to_date("newest").cast("string").alias("newest"), *[rounded(F.col(c)).alias(c) for c in ("returned", "discount", "yearly", "top_share")])


SCORED = f"""{SIGNALS}, dims AS (SELECT l_suppkey, 100 * (1 - returned) AS quality_returns, 1000 * discount AS quality_price, 100 * yearly AS trend, 100 * (1 - top_share) AS spread FROM all_signals),
inner_means AS (SELECT *, CASE WHEN quality_returns IS NULL AND quality_price IS NULL THEN NULL ELSE (coalesce(2 * quality_returns, 0) + coalesce(quality_price, 0)) / (CASE WHEN quality_returns IS NULL THEN 0 ELSE 2 END + CASE WHEN quality_price IS NULL THEN 0 ELSE 1 END) END AS quality FROM dims),
two_levels AS (SELECT *, CASE WHEN quality IS NULL AND trend IS NULL AND spread IS NULL THEN NULL ELSE (coalesce(0.5 * quality, 0) + coalesce(0.3 * trend, 0) + coalesce(0.2 * spread, 0)) / (CASE WHEN quality IS NULL THEN 0 ELSE 0.5 END + CASE WHEN trend IS NULL THEN 0 ELSE 0.3 END + CASE WHEN spread IS NULL THEN 0 ELSE 0.2 END) END AS score FROM inner_means)"""


def two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals make dimensions by their weights, dimensions the score by theirs; what is unknown drops out on its level."""
    c = F.col
    quality = scores.known_mean([(2.0, 100 * (1 - c("returned"))), (1.0, 1000 * c("discount"))])
    dims = signals(spark, sf_dir).select("l_suppkey", quality.alias("quality"), (100 * c("yearly")).alias("trend"), (100 * (1 - c("top_share"))).alias("spread"))
    return dims.withColumn("score", scores.known_mean([(0.5, c("quality")), (0.3, c("trend")), (0.2, c("spread"))]))


@query(f"WITH {SCORED} SELECT l_suppkey, round(quality, 3) AS quality, round(trend, 3) AS trend, round(score, 3) AS score FROM two_levels")
def two_level_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_levels(spark, sf_dir).select("l_suppkey", *[rounded(F.col(x), 3).alias(x) for x in ("quality", "trend", "score")])


@query(f"""WITH {SCORED}, capped AS (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN least(quality, 60) ELSE quality END AS q2, least(score, CASE WHEN l_suppkey % 5 = 0 THEN 55 ELSE 1000 END) AS gated FROM two_levels)
SELECT l_suppkey, round(score, 3) AS was, round(least(score, gated, (coalesce(0.5 * q2, 0) + coalesce(0.3 * trend, 0) + coalesce(0.2 * spread, 0)) / (CASE WHEN q2 IS NULL THEN 0 ELSE 0.5 END + CASE WHEN trend IS NULL THEN 0 ELSE 0.3 END + CASE WHEN spread IS NULL THEN 0 ELSE 0.2 END)), 3) AS now
FROM capped WHERE score IS NOT NULL""")
def score_recap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores under new caps: a capped dimension gives a new mean, a gate its own bound, and neither ever raises a score."""
    rows, c = two_levels(spark, sf_dir).where("score is not null"), F.col
    quality = F.when(c("l_suppkey") % 3 == 0, F.least(c("quality"), F.when(c("quality").isNotNull(), 60.0))).otherwise(c("quality"))
    again = scores.known_mean([(0.5, quality), (0.3, c("trend")), (0.2, c("spread"))])
    now = scores.capped(c("score"), again, F.when(c("l_suppkey") % 5 == 0, 55.0))
    return rows.select("l_suppkey", rounded(c("score"), 3).alias("was"), rounded(now, 3).alias("now"))


RANKED = "ranked AS (SELECT p_partkey, p_brand, p_name AS grp, dense_rank() OVER (ORDER BY CAST(substr(p_brand, 7) AS INTEGER)) AS rank FROM part WHERE p_size <= 12)"


@query(f"""WITH {RANKED}, firsts AS (SELECT rank, count(*) AS new FROM (SELECT grp, min(rank) AS rank FROM ranked GROUP BY grp) GROUP BY rank), each AS (SELECT rank, count(*) AS n FROM ranked GROUP BY rank),
s AS (SELECT rank, CAST(sum(n) OVER (ORDER BY rank) AS BIGINT) AS n_rows, CAST(sum(coalesce(new, 0)) OVER (ORDER BY rank) AS BIGINT) AS n_groups FROM each LEFT JOIN firsts USING (rank))
SELECT rank, n_rows, n_groups, rank <= 3 OR (coalesce(lag(n_groups) OVER (ORDER BY rank), 0) < 40 AND n_rows <= 400) AS chosen FROM s""")
def floor_then_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").where("p_size <= 12").select("p_brand", F.col("p_name").alias("grp"))
    brands = rows.select("p_brand").distinct().withColumn("rank", F.row_number().over(Window.orderBy(F.substring("p_brand", 7, 9).cast("int"))).cast("long"))  # as many as there are brands
    return intake.floor_then_extend(rows.join(brands, "p_brand"), "rank", "grp", 3, 40, 400)


@query("""WITH r AS (SELECT s_suppkey, s_nationkey = 3 AS must, row_number() OVER (PARTITION BY s_nationkey = 3 ORDER BY s_acctbal DESC, s_suppkey) AS place FROM supplier)
SELECT s_suppkey, CASE WHEN must THEN 'must' ELSE 'rank' END AS selected_by FROM r WHERE must OR place <= 30 - (SELECT count(*) FROM r WHERE must)""")
def must_then_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must be is in however many there are; the others fill what that leaves of the target."""
    rows, must = read(spark, sf_dir, "supplier"), F.coalesce(F.col("s_nationkey") == 3, F.lit(False))
    return intake.filled(rows, must, [F.desc("s_acctbal"), F.col("s_suppkey")], max(30, rows.where(must).count())).select("s_suppkey", "selected_by")


@query("""WITH e AS (SELECT p_partkey, p_brand, p_name, p_size % 5 = 0 AS served, p_retailprice AS score FROM part WHERE p_size > 3),
g AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY served DESC, score DESC, p_partkey) AS a FROM e),
p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY served DESC, score DESC, p_partkey) AS b FROM g WHERE a = 1),
t AS (SELECT *, row_number() OVER (ORDER BY served DESC, score DESC, p_partkey) AS c FROM p WHERE b <= 6) SELECT p_partkey, p_brand, p_name FROM t WHERE c <= 100""")
def budgeted_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").where("p_size > 3").withColumn("served", F.col("p_size") % 5 == 0)
    return intake.served(rows, "p_brand", "p_name", [F.desc("served"), F.desc("p_retailprice"), F.col("p_partkey")], 6, 100).select("p_partkey", "p_brand", "p_name")


@query("""SELECT s_suppkey, CASE WHEN row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) > 20 THEN 'over_cap' ELSE 'kept' END AS outcome FROM supplier""")
def universe_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap's last row is found by a bounded sort; all rows are then compared with it where they lie, so none is dropped without a record."""
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    last = rows.orderBy(F.desc("s_acctbal"), "s_suppkey").limit(20).agg(F.max(F.struct((-F.col("s_acctbal")).alias("b"), F.col("s_suppkey").alias("k"))).alias("last"))
    kept = F.struct((-F.col("s_acctbal")).alias("b"), F.col("s_suppkey").alias("k")) <= F.col("last")
    return rows.crossJoin(F.broadcast(last)).select("s_suppkey", F.when(kept, "kept").otherwise("over_cap").alias("outcome"))  # one row


@query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS stars, min(event_id) % 7 AS rid FROM events GROUP BY 1, 2), a AS (SELECT * FROM d WHERE day = DATE '2024-01-20'), b AS (SELECT * FROM d WHERE day = DATE '2024-01-21')
SELECT a.user_id, CASE WHEN b.stars IS NULL THEN 'live_disagreement' WHEN a.rid <> b.rid AND a.user_id % 2 = 0 THEN 'live_identity_mismatch' WHEN abs(a.stars - b.stars) > greatest(50, 0.3 * b.stars) THEN 'live_disagreement' ELSE 'ok' END AS verdict
FROM a LEFT JOIN b USING (user_id)""")
def live_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(day: str, name: str) -> DataFrame:
        rows = read(spark, sf_dir, "events").where(F.to_date("ts") == F.lit(day).cast("date"))
        rid = F.when(F.col("user_id") % 2 == 0, F.min("event_id") % 7)
        return rows.groupBy("user_id").agg(F.sum("value").alias(f"stars_{name}"), rid.alias(f"rid_{name}"))

    both = of("2024-01-20", "a").join(of("2024-01-21", "b"), "user_id", "left")
    return both.select("user_id", intake.agrees(F.col("stars_a"), F.col("stars_b"), F.col("rid_a"), F.col("rid_b"), 50.0, 0.3).alias("verdict"))


@query("""WITH s AS (SELECT CAST(ts AS DATE) AS run, 'run_failed' AS kind, 'cycle' AS step, regexp_replace(props, '[0-9]+', '#', 'g') || ' ' || (user_id % 3) AS message FROM events WHERE event_type = 'error' AND value > 150
UNION ALL SELECT CAST(ts AS DATE), 'survived', 'step' || (user_id % 4), 'lost ' || floor(value / 50) FROM events WHERE event_type = 'error' UNION ALL SELECT CAST(ts AS DATE), 'degraded', event_type, 'slow' FROM events WHERE value < 1)
SELECT CAST(run AS VARCHAR) AS run, kind, step, message, count(*) AS occurrences FROM s GROUP BY ALL""")
def failure_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One signal for each kind and fault of a run, however many rows show it."""
    rows, c = read(spark, sf_dir, "events"), F.col
    run = F.to_date("ts").cast("string").alias("run")
    errors = rows.where("event_type = 'error'")
    bucket = F.floor(c("value") / 50).cast("double").cast("string")
    failed = errors.where("value > 150").select(run, F.lit("run_failed").alias("kind"), F.lit("cycle").alias("step"), F.concat(F.regexp_replace("props", "[0-9]+", "#"), F.lit(" "), (c("user_id") % 3).cast("string")).alias("message"))
    survived = errors.select(run, F.lit("survived").alias("kind"), F.concat(F.lit("step"), (c("user_id") % 4).cast("string")).alias("step"), F.concat(F.lit("lost "), bucket).alias("message"))
    degraded = rows.where("value < 1").select(run, F.lit("degraded").alias("kind"), c("event_type").alias("step"), F.lit("slow").alias("message"))
    return failed.unionByName(survived).unionByName(degraded).groupBy("run", "kind", "step", "message").agg(F.count(F.lit(1)).alias("occurrences"))


@query("""WITH runs AS (SELECT CAST(ts AS DATE) AS run, user_id % 40 AS fault, count(*) AS n, bool_or(event_type = 'purchase') AS success FROM events WHERE user_id % 40 < 30 AND (value > 60 OR event_type = 'purchase') GROUP BY 1, 2),
h AS (SELECT *, row_number() OVER (PARTITION BY fault ORDER BY run) AS seen, max(CASE WHEN success THEN run END) OVER (PARTITION BY fault ORDER BY run) AS won, lag(n) OVER (PARTITION BY fault ORDER BY run) AS before FROM runs)
SELECT CAST(run AS VARCHAR) AS run, fault, seen = 1 AS is_new, seen >= 3 AS recurring, won IS NULL OR datediff('day', won, run) >= 3 AS no_recent_success, coalesce(before - n >= 2 AND (before - n) >= 0.5 * before, false) AS shrunk FROM h""")
def alert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four alerts of a fault in a run: never seen, seen in three runs, no success for three days, and a count that shrank by two and by a half."""
    rows = read(spark, sf_dir, "events").where("user_id % 40 < 30 and (value > 60 or event_type = 'purchase')")
    runs = rows.groupBy(F.to_date("ts").alias("run"), (F.col("user_id") % 40).alias("fault")).agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("event_type") == "purchase").alias("success"))
    order = Window.partitionBy("fault").orderBy("run")
    won = F.max(F.when(F.col("success"), F.col("run"))).over(order)
    fell = F.lag("n").over(order) - F.col("n")
    shrunk = F.coalesce((fell >= 2) & (fell >= 0.5 * F.lag("n").over(order)), F.lit(False))
    seen = F.row_number().over(order)
    return runs.select(F.col("run").cast("string").alias("run"), "fault", (seen == 1).alias("is_new"), (seen >= 3).alias("recurring"), (won.isNull() | (F.datediff("run", won) >= 3)).alias("no_recent_success"), shrunk.alias("shrunk"))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS run, event_type AS strategy, count(*) AS found FROM events GROUP BY 1, 2),
h AS (SELECT *, avg(found) OVER w AS before FROM d WINDOW w AS (PARTITION BY strategy ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT CAST(run AS VARCHAR) AS run, strategy, found, CASE WHEN before IS NULL THEN 'first' WHEN found < 0.8 * before THEN 'drop' WHEN found > 1.2 * before THEN 'spike' ELSE 'usual' END AS anomaly FROM h""")
def intake_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("run"), F.col("event_type").alias("strategy")).agg(F.count(F.lit(1)).alias("found"))
    before = F.avg("found").over(Window.partitionBy("strategy").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    anomaly = F.when(before.isNull(), "first").when(F.col("found") < 0.8 * before, "drop").when(F.col("found") > 1.2 * before, "spike").otherwise("usual")
    return found.select(F.col("run").cast("string").alias("run"), "strategy", "found", anomaly.alias("anomaly"))


@query("""WITH s AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'closed' END AS r1, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_custkey % 10 = 0 THEN 'blocked' END AS r2, CASE WHEN o_orderpriority LIKE '5%' THEN 'low' END AS r3 FROM orders),
w AS (SELECT coalesce(r1 IS NOT NULL, false) AS a, r1 IS NULL AND r2 IS NOT NULL AS b, r1 IS NULL AND r2 IS NULL AND r3 IS NOT NULL AS c, r1, r2, r3 FROM s),
t AS (SELECT 1 AS stage, r1 AS reason FROM w WHERE a UNION ALL SELECT 2, r2 FROM w WHERE b UNION ALL SELECT 3, r3 FROM w WHERE c),
n AS (SELECT stage, count(*) AS stopped FROM t GROUP BY stage), total AS (SELECT count(*) AS n FROM orders)
SELECT n.stage, (SELECT n FROM total) - CAST(coalesce((SELECT sum(stopped) FROM n m WHERE m.stage < n.stage), 0) AS BIGINT) AS entered, stopped,
(SELECT string_agg(reason || '=' || k, '|' ORDER BY k DESC, reason) FROM (SELECT reason, count(*) AS k FROM t WHERE t.stage = n.stage GROUP BY reason)) AS by_reason FROM n""")
def intake_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What enters and stops at each stage, and why. Each row stops once, so one pass counts all stages; a stage has few reasons."""
    c = F.col
    stop = (
        F.when(c("o_orderstatus") == "F", F.struct(F.lit(1).alias("stage"), F.lit("closed").alias("reason")))
        .when(c("o_totalprice") < 50000, F.struct(F.lit(2).alias("stage"), F.lit("small").alias("reason")))
        .when(c("o_custkey") % 10 == 0, F.struct(F.lit(2).alias("stage"), F.lit("blocked").alias("reason")))
        .when(c("o_orderpriority").startswith("5"), F.struct(F.lit(3).alias("stage"), F.lit("low").alias("reason")))
    )
    counts = read(spark, sf_dir, "orders").groupBy(stop.alias("stop")).agg(F.count(F.lit(1)).alias("k"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-c("k")).alias("k"), c("stop.reason").alias("reason")))), lambda x: F.concat_ws("=", x["reason"], (-x["k"]).cast("string"))), "|")
    stages = counts.groupBy("stop.stage").agg(F.sum("k").alias("stopped"), listed.alias("by_reason"))
    order = Window.orderBy(c("stage").asc_nulls_last())  # as many rows as there are stages
    rest = F.sum("stopped").over(order.rowsBetween(0, Window.unboundedFollowing))
    return stages.select("stage", rest.alias("entered"), "stopped", "by_reason").where("stage is not null")


@query("""WITH c AS (SELECT p_partkey, unnest(list_distinct([p_brand, p_type, 'all'])) AS strategy, p_size % 4 = 0 AS known, p_size % 3 = 0 AS admitted FROM part)
SELECT strategy, count(*) AS found, count(*) FILTER (WHERE NOT known) AS new, count(*) FILTER (WHERE NOT known AND admitted) AS admitted FROM c GROUP BY strategy""")
def strategy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select(F.explode(F.array_distinct(F.array("p_brand", "p_type", F.lit("all")))).alias("strategy"), (F.col("p_size") % 4 != 0).alias("new"), (F.col("p_size") % 3 == 0).alias("fit"))
    return rows.groupBy("strategy").agg(F.count(F.lit(1)).alias("found"), F.count_if(F.col("new")).alias("new"), F.count_if(F.col("new") & F.col("fit")).alias("admitted"))


@query("""WITH c AS (SELECT l_orderkey, l_returnflag || l_linestatus AS hint, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, hint, n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, hint) AS place FROM c) WHERE place = 1""")
def hint_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent hint, the first by name of several."""
    counts = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("hint")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("l_orderkey").agg(F.min(F.struct((-F.col("n")).alias("less"), F.col("hint"))).alias("b"))
    return best.select("l_orderkey", "b.hint", (-F.col("b.less")).alias("n"))


@query("""WITH s AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN 'rejected' WHEN o_orderkey % 37 = 0 THEN 'dead_letter' WHEN o_orderstatus = 'F' THEN 'accepted' WHEN o_orderstatus = 'O' THEN 'queued' ELSE 'failed_retry' END AS state FROM orders),
e AS (SELECT o_custkey, min(o_orderkey) AS ended FROM s WHERE state IN ('rejected', 'dead_letter') GROUP BY 1)
SELECT o_custkey, arg_max(state, o_orderkey) AS state, max(o_orderkey) AS o_orderkey, count(*) AS n_events FROM s LEFT JOIN e USING (o_custkey) WHERE ended IS NULL OR o_orderkey <= ended GROUP BY o_custkey""")
def entity_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    state = F.when(c("o_orderkey") % 29 == 0, "rejected").when(c("o_orderkey") % 37 == 0, "dead_letter").when(c("o_orderstatus") == "F", "accepted").when(c("o_orderstatus") == "O", "queued").otherwise("failed_retry")
    events = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", state.alias("state"))
    return intake.end_state(events, "o_custkey", "o_orderkey", "state", ("rejected", "dead_letter"))


@query("""SELECT p_brand, p_name AS cell_1, p_type || '|' || p_size AS cell_2 FROM part""")
def markdown_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as Markdown tables for each brand, and read back from them. A brand has as many tables as it needs for each to stay short."""
    line = F.concat(F.lit("| "), F.col("p_name"), F.lit(" | "), F.col("p_type"), F.lit("\\|"), F.col("p_size").cast("string"), F.lit(" |"))
    part = read(spark, sf_dir, "part")
    texts = part.groupBy("p_brand", F.pmod(F.xxhash64("p_partkey"), F.lit(-(-max(1, part.count()) // TEXT_LINES))).alias("nth")).agg(F.array_join(F.collect_list(line), "\n").alias("lines"))
    text = F.concat(F.lit("# Parts\n\n| name | kind |\n|---|:--|\n"), F.col("lines"), F.lit("\n\nNo | row\n"))
    return texts.select("p_brand", F.explode(intake.table_rows(text)).alias("cells")).select("p_brand", F.col("cells")[0].alias("cell_1"), F.col("cells")[1].alias("cell_2"))


@query("""WITH c AS (SELECT p_partkey, p_retailprice, p_size % 4 = 0 AS material, p_size % 3 AS waited FROM part WHERE p_size > 10),
q AS (SELECT *, row_number() OVER (ORDER BY material DESC, waited DESC, p_partkey) AS place FROM c WHERE material OR waited >= 1)
SELECT p_partkey, material, CASE WHEN place IS NULL THEN 'waits' WHEN place <= 50 THEN 'rescored' ELSE 'carried_over' END AS outcome FROM c LEFT JOIN q USING (p_partkey, material)""")
def rescore_carry_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Material changes come first, others once they have waited; what the budget does not reach stays in the queue. The last place within the budget is found by a bounded sort, and every row is compared with it."""
    c = F.col
    rows = read(spark, sf_dir, "part").where("p_size > 10").select("p_partkey", (c("p_size") % 4 == 0).alias("material"), (c("p_size") % 3).alias("waited"))
    place = F.struct((~c("material")).alias("m"), (-c("waited")).alias("w"), c("p_partkey").alias("k"))
    due = rows.where("material or waited >= 1")
    last = due.select(place.alias("place")).orderBy("place").limit(50).agg(F.max("place").alias("last"))
    outcome = F.when(~c("material") & (c("waited") < 1), "waits").when(place <= c("last"), "rescored").otherwise("carried_over")
    return rows.crossJoin(F.broadcast(last)).select("p_partkey", "material", outcome.alias("outcome"))  # one row


@query("""WITH RECURSIVE c AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i, 'q' || o_custkey % 5 AS r1, 'w' || o_orderkey % 3 AS r2 FROM orders),
f(i, key, route, counts) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), MAP {'q0': 0, 'q1': 0, 'q2': 0, 'q3': 0, 'q4': 0, 'w0': 0, 'w1': 0, 'w2': 0}
UNION ALL SELECT x.i, x.o_orderkey, x.route, CASE WHEN x.route IS NULL THEN x.counts ELSE map_from_entries(list_transform(map_entries(x.counts), lambda e: {'key': e.key, 'value': CASE WHEN e.key = x.route THEN e.value + 1 ELSE e.value END})) END
FROM (SELECT c.i, c.o_orderkey, f.counts, CASE WHEN f.counts[c.r1] < 7 AND (f.counts[c.r1] < f.counts[c.r2] OR (f.counts[c.r1] = f.counts[c.r2]) OR f.counts[c.r2] >= 7) THEN c.r1 WHEN f.counts[c.r2] < 7 THEN c.r2 END AS route FROM f JOIN c ON c.i = f.i + 1 WHERE c.i <= 300) x)
SELECT key AS o_orderkey, route FROM f WHERE route IS NOT NULL""")
def least_used_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    routes = F.array(F.concat(F.lit("q"), (c("o_custkey") % 5).cast("string")), F.concat(F.lit("w"), (c("o_orderkey") % 3).cast("string")))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", routes.alias("routes"))
    return evidence.routed(rows, "o_orderkey", "routes", ["o_orderkey"], 7, 1000, F.substring("route", 1, 1))


@query("""SELECT lower(p_name) AS alias, min(p_partkey) AS first_seen, count(DISTINCT p_brand) > 1 AS conflict FROM part GROUP BY 1""")
def alias_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alias goes to what first had it; several owners are a conflict."""
    rows = read(spark, sf_dir, "part").select(F.lower("p_name").alias("alias"), "p_partkey", "p_brand")
    return rows.groupBy("alias").agg(F.min("p_partkey").alias("first_seen"), (F.min("p_brand") != F.max("p_brand")).alias("conflict"))
