"""Queries on texts that stand in other texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import blocks, phrases, scope
from millrace.queries.registry import query
from millrace.queries.search import fold_sql
from millrace.session import checkpointed
from millrace.sources.tables import read

#: What in the rest of a text restricts what the reference grants.
MARKERS = ("all rights reserved", "commercial", "license", "copyright")


def words_sql(x: str) -> str:
    return f"list_filter(string_split(regexp_replace({fold_sql(x)}, '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


def grams_sql(table: str, id: str, at: str) -> str:
    return f"""SELECT {id}, unnest(range(1, len(w) - 2)) - 1 AS {at}, unnest(list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p:p + 3], ' '))) AS gram
  FROM {table} WHERE len(w) >= 4"""


@query(f"""
WITH RECURSIVE texts AS (SELECT doc_id AS text, {words_sql("coalesce(text, '')")} AS w FROM documents),
refs AS (SELECT item_id AS ref, {words_sql('text')} AS w FROM benchmark),
known AS ({grams_sql('refs', 'ref', 'i')}),
met AS (SELECT * FROM ({grams_sql('texts', 'text', 'j')}) WHERE gram IN (SELECT gram FROM known)),
shares AS (
  SELECT text, ref, count(*) / any_value(n_grams) AS share
  FROM (SELECT DISTINCT text, gram FROM met) JOIN (SELECT DISTINCT ref, gram FROM known) USING (gram)
  JOIN (SELECT ref, count(DISTINCT gram) AS n_grams FROM known GROUP BY ref) USING (ref) GROUP BY text, ref),
listed AS (SELECT text, ref FROM shares QUALIFY row_number() OVER (PARTITION BY text ORDER BY share DESC, ref) <= 3),
runs AS (
  SELECT text, ref, i, j, i - row_number() OVER (PARTITION BY text, ref, j - i ORDER BY i) AS run
  FROM met JOIN known USING (gram) JOIN listed USING (text, ref)),
maximal AS (SELECT text, ref, min(i) AS i, min(j) AS j, count(*) + 3 AS n FROM runs GROUP BY text, ref, j - i, run),
walk AS (
  SELECT text, ref, 0 AS i0, 1000000000 AS i1, 0 AS j0, 1000000000 AS j1, 0 AS j, 0 AS n, 'start' AS side FROM listed
  UNION ALL
  SELECT text, ref, CASE WHEN s = 'left' THEN i0 ELSE i + n END, CASE WHEN s = 'left' THEN i ELSE i1 END,
         CASE WHEN s = 'left' THEN j0 ELSE j + n END, CASE WHEN s = 'left' THEN j ELSE j1 END, j, n, s
  FROM (SELECT *, row_number() OVER (PARTITION BY text, ref, i0, i1, j0, j1 ORDER BY n DESC, i, j) AS place
        FROM (SELECT text, ref, i0, i1, j0, j1, i + c AS i, j + c AS j, least(n - c, i1 - (i + c), j1 - (j + c)) AS n
              FROM (SELECT w.text, w.ref, i0, i1, j0, j1, m.i, m.j, m.n, greatest(i0 - m.i, j0 - m.j, 0) AS c
                    FROM walk w JOIN maximal m ON m.text = w.text AND m.ref = w.ref)) WHERE n >= 4)
       CROSS JOIN (SELECT unnest(['left', 'right']) AS s) WHERE place = 1),
chosen AS (SELECT text, ref, j, n FROM walk WHERE side = 'left'),
covered AS (SELECT text, ref, list(j) AS js, list(n) AS ns, sum(n) AS n, count(*) AS n_blocks FROM chosen GROUP BY text, ref),
rests AS (
  SELECT c.text, c.ref, c.n / len(r.w) AS coverage, n_blocks,
         array_to_string(list_filter(t.w, lambda w, p: len(list_filter(range(1, len(js) + 1), lambda k: p > js[k] AND p <= js[k] + ns[k])) = 0), ' ') AS leftover
  FROM covered c JOIN texts t USING (text) JOIN refs r USING (ref)),
best AS (SELECT * FROM rests QUALIFY row_number() OVER (PARTITION BY text ORDER BY round(coverage, 2) DESC, length(leftover), ref) = 1),
marked AS (SELECT *, array_to_string(list_filter({sorted(MARKERS)}, lambda m: contains(' ' || leftover || ' ', ' ' || m || ' ')), '|') AS found FROM best)
SELECT text, ref, round(coverage, 4) AS coverage, n_blocks, length(leftover) AS leftover_chars, found,
       CASE WHEN coverage < 0.5 THEN 'other' WHEN found <> '' THEN 'restricted' WHEN coverage >= 0.9 THEN 'whole' ELSE 'part' END AS verdict
FROM marked""")
def block_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark item that most stands in each document, in blocks of at least four words, with what the rest says."""
    texts = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("text"), F.col("text").alias("t"))
    refs = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ref"), F.col("text").alias("t"))
    best = blocks.closest(blocks.matched(texts, refs, MARKERS))
    said = F.array_join("found", "|")
    verdict = F.when(F.col("coverage") < 0.5, "other").when(said != "", "restricted").when(F.col("coverage") >= 0.9, "whole").otherwise("part")
    return best.select("text", "ref", F.round("coverage", 4).alias("coverage"), "n_blocks", F.length("leftover").alias("leftover_chars"), said.alias("found"), verdict.alias("verdict"))


def spaced(x: str) -> Column:
    """A text as words with one space between, so that SQL can count phrases by their words."""
    return F.array_join(blocks.words(F.col(x)), " ")


GRAMS = f"""texts AS (SELECT doc_id AS id, source, {words_sql("coalesce(text, '')")} AS w FROM documents),
known AS (SELECT DISTINCT array_to_string(w[1:k], ' ') AS phrase, k FROM (SELECT {words_sql('text')} AS w FROM benchmark), (SELECT unnest([2, 3]) AS k) WHERE len(w) >= k),
grams AS (
  SELECT id, source, p, array_to_string(w[p:p + k - 1], ' ') AS phrase, k,
         len(array_to_string(w[1:p - 1], ' ')) + CASE WHEN p > 1 THEN 1 ELSE 0 END AS pos
  FROM (SELECT id, source, w, unnest(range(1, len(w) + 1)) AS p FROM texts), (SELECT unnest([2, 3]) AS k) WHERE p + k - 1 <= len(w))"""


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two and the first three words of each benchmark item."""
    w = read(spark, sf_dir, "benchmark").select(blocks.words(F.col("text")).alias("w"))
    return w.select(F.explode(F.array(*[F.when(F.size("w") >= k, F.array_join(F.slice("w", 1, k), " ")) for k in (2, 3)])).alias("phrase")).where("phrase is not null").distinct()


@query(f"""
WITH {GRAMS}
SELECT phrase, source, count(*) AS n_hits, count(DISTINCT id) AS n_documents FROM grams JOIN known USING (phrase, k) GROUP BY phrase, source""")
def phrase_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the openings of benchmark items occur in the documents of each source."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), spaced("text").alias("t"), "source")
    found = phrases.hits(docs, named(spark, sf_dir)).join(docs.select("id", "source"), "id")
    return found.groupBy("phrase", "source").agg(F.count(F.lit(1)).alias("n_hits"), F.countDistinct("id").alias("n_documents"))


@query(f"""
WITH {GRAMS},
found AS (SELECT id, phrase, k - 2 AS g, pos, len(phrase) AS n FROM grams JOIN known USING (phrase, k)),
gaps AS (
  SELECT a.id, a.phrase, a.pos, min(greatest(b.pos - (a.pos + a.n), a.pos - (b.pos + b.n), 0)) AS gap
  FROM found a JOIN found b ON a.id = b.id AND b.g = 1 WHERE a.g = 0 GROUP BY ALL)
SELECT id, count(*) AS n_near, min(gap) AS least_gap FROM gaps WHERE gap <= 200 GROUP BY id""")
def phrases_nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents where a two-word opening stands within 200 characters of a three-word one."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), spaced("text").alias("t"))
    found = phrases.hits(docs, named(spark, sf_dir)).withColumn("g", F.when(F.size(F.split("phrase", " ")) == 3, 1).otherwise(0))
    near = phrases.nearest(found, "g").where("gap <= 200")
    return near.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("gap").alias("least_gap"))


@query(r"""
WITH said AS (
  SELECT p.p_partkey AS id, concat('The ', p.p_name, ', a replacement for the ', q.p_name, ', ', lower(q.p_brand), ' and more. ', p.p_type, ' ', q.p_name, ' alternative; no alternative to ', p.p_name, ' sets.') AS t
  FROM part p JOIN part q ON q.p_partkey = p.p_partkey + 1),
names AS (SELECT min(p_partkey) AS name, p_name AS key FROM part GROUP BY p_name UNION ALL SELECT -min(p_partkey), replace(lower(p_brand), '#', ' ') FROM part GROUP BY p_brand),
lists AS (SELECT id, unnest(regexp_extract_all(lower(t), '\b(?:alternatives?|replacements?) (?:to|for) ([^.;:!?\n]{1,120})', 1)) AS list FROM said),
raw_items AS (SELECT id, trim(unnest(regexp_split_to_array(list, ',|/|&|\bor\b|\band\b'))) AS x FROM lists),
items AS (
  SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '^(?:the|a|an)\s+', ''), '\s+(?:etc\.?|and more)$', ''), '[^a-z0-9.+ -]', ' ', 'g'), '\s+', ' ', 'g'), ' .-') AS key FROM raw_items),
befores AS (SELECT id, generate_subscripts(b, 1) AS k, unnest(b) AS said FROM (SELECT id, regexp_extract_all(lower(t), '([a-z0-9][a-z0-9.+ -]{0,40}?)[ -]alternatives?\b', 1) AS b FROM said)),
keyed AS (SELECT id, k, string_split(trim(regexp_replace(regexp_replace(trim(said), '^(?:the|a|an)\s+', ''), '\s+', ' ', 'g'), ' .-'), ' ') AS w FROM befores),
ends AS (SELECT id, k, cut, array_to_string(w[cut:], ' ') AS key FROM (SELECT *, unnest(range(1, len(w) + 1)) AS cut FROM keyed)),
longest AS (SELECT id, name, key || ' alternative' AS matched FROM ends JOIN names USING (key) QUALIFY rank() OVER (PARTITION BY id, k ORDER BY cut) = 1)
SELECT id, name, min(matched) AS matched FROM (SELECT id, name, key AS matched FROM items JOIN names USING (key) UNION ALL SELECT * FROM longest) GROUP BY id, name""")
def stated_replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which names a part's description, made from the part and its neighbour, states that it replaces."""
    part = read(spark, sf_dir, "part")
    q = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("q_name"), F.lower("p_brand").alias("q_brand"))
    bits = [F.lit("The "), "p_name", F.lit(", a replacement for the "), "q_name", F.lit(", "), "q_brand", F.lit(" and more. "), "p_type", F.lit(" "), "q_name", F.lit(" alternative; no alternative to "), "p_name", F.lit(" sets.")]
    texts = part.join(q, "p_partkey").select(F.col("p_partkey").alias("id"), F.concat(*bits).alias("t"))
    names = part.groupBy(F.col("p_name").alias("key")).agg(F.min("p_partkey").alias("name"))
    brands = part.groupBy("p_brand").agg((-F.min("p_partkey")).alias("name")).select(F.replace(F.lower("p_brand"), F.lit("#"), F.lit(" ")).alias("key"), "name")
    return phrases.stated(texts, names.unionByName(brands))


@query("""
WITH p AS (SELECT a.p_partkey AS id, a.p_name AS name, a.p_type AS kind, a.p_brand AS brand, b.p_name AS other FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)
SELECT id, 'section' AS form, concat(other, ' of') AS statement, NULL AS feature FROM p
UNION ALL SELECT id, 'clause', brand, NULL FROM p
UNION ALL SELECT id, 'clause', concat('We have exporting ', kind, ';'), NULL FROM p
UNION ALL SELECT id, 'clause', '\u2796', NULL FROM p
UNION ALL SELECT id, 'table', concat(kind, ' export'), NULL FROM p
UNION ALL SELECT DISTINCT id, 'feature', NULL, feature FROM p, (SELECT DISTINCT p_name AS feature FROM part) WHERE feature = other""")
def ruled_out_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What descriptions of parts, made from a part and its neighbour, rule out, and which parts' names are among it."""
    part = read(spark, sf_dir, "part")
    other = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other"), F.col("p_brand").alias("other_brand"))
    bits = [
        "# ", F.col("p_name"), "\n\n## Features\n- ", F.col("p_type"), " of ", F.col("p_name"), "\n\n## Non-goals\n\n* ", F.col("other"), " of ", F.col("other_brand"), ", and more\n\n## Notes\n",
        F.col("p_brand"), " is explicitly out of scope. We have no plans to support exporting ", F.col("p_type"), "; a very long and qualified subject is not supported.\n\n\u2796 not planned\n\n| feature | status |\n|---|---|\n| ",
        F.col("p_type"), " export | \u2796 maybe |\n| ", F.col("p_name"), " | yes |\n",
    ]
    texts = part.join(other, "p_partkey").select(F.col("p_partkey").alias("id"), F.concat(*[F.lit(b) if isinstance(b, str) else b for b in bits]).alias("t"))
    said = checkpointed(scope.statements(texts))  # several branches read it
    out = scope.ruled_out(said, part.select(F.col("p_name").alias("feature")).distinct())
    return said.select("id", "form", "statement", F.lit(None).cast("string").alias("feature")).unionByName(out.select("id", F.lit("feature").alias("form"), F.lit(None).cast("string").alias("statement"), "feature"))
