"""Plans whose answers carry their evidence: walked edges, tested attributes, matched words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import retrieval
from millrace.plans.evidence import Found, Hop
from millrace.queries.graphs import EDGES
from millrace.queries.registry import query
from millrace.queries.search import tokens_sql
from millrace.sources.tables import edges, nodes

#: The words of the question: "small widgets, economy".
ASKED = ("small", "widget", "economy")

TEXT = f"""tfs AS (
  SELECT doc, term, sum(w) AS tf
  FROM (SELECT p_partkey AS doc, unnest({tokens_sql('p_name')}) AS term, 2.0 AS w FROM part
        UNION ALL SELECT p_partkey, unnest({tokens_sql('p_type')}), 1.0 FROM part)
  GROUP BY doc, term),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
idfs AS (SELECT term, ln((1 + (SELECT count(DISTINCT doc) FROM tfs)) / (1.0 + df)) + 1 AS idf FROM dfs),
lengths AS (SELECT doc, sqrt(sum(((1 + ln(tf)) * idf) ** 2)) AS norm FROM tfs JOIN idfs USING (term) GROUP BY doc),
asked AS (SELECT term, idf, idf / sqrt(sum(idf * idf) OVER ()) AS qw FROM idfs WHERE term IN {ASKED}),
scored AS (
  SELECT doc, round(sum((1 + ln(tf)) * idf * qw) / any_value(norm), 4) AS score, string_agg(term, '|' ORDER BY term) AS matched
  FROM tfs JOIN asked USING (term) JOIN lengths USING (doc) GROUP BY doc)"""


def found(spark: SparkSession, sf_dir: str) -> Found:
    return Found(nodes(spark, sf_dir), edges(spark, sf_dir))


def names(plan: Found) -> retrieval.Index:
    """Parts by their names, which count twice, and kinds."""
    parts = plan.nodes.where("type = 'part'")
    return retrieval.index(retrieval.bags([(text.tokens(F.col("name")), 2.0), (text.tokens(F.col("kind")), 1.0)], parts, "id"))


def said(edges: str) -> Column:
    return F.array_join(F.transform(edges, lambda e: F.concat_ws(">", e["src"], e["rel"], e["dst"])), "|")


@query(f"""
WITH {TEXT}
SELECT 'part:' || p_partkey AS id, p_name AS name, score, matched, 'part:' || p_partkey || '.size=' || CAST(CAST(p_size AS DOUBLE) AS VARCHAR) AS tested
FROM part JOIN scored ON doc = p_partkey
WHERE p_size >= 10 AND score >= 0.3
ORDER BY score DESC, id LIMIT 25""")
def g_text_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts that a question names best, among those of a size; the words and the attribute that speak for each."""
    plan = found(spark, sf_dir)
    best = plan.start("part").where("size", gte=10).text(names(plan), ASKED, least=0.3).rank("score").result(25)
    tested = F.concat(F.col("facets")[0]["entity"], F.lit("."), F.col("facets")[0]["field"], F.lit("="), F.col("facets")[0]["value"])
    return best.select("id", "name", "score", F.array_join(F.col("semantic")[0]["terms"], "|").alias("matched"), tested.alias("tested"))


@query(f"""
WITH {EDGES}, {TEXT},
offers AS (
  SELECT e.src AS id, e.dst AS part, e.confidence, s.score FROM edges e JOIN scored s ON e.dst = 'part:' || s.doc
  WHERE rel = 'OFFERS' AND e.confidence >= 0.95 AND s.score >= 0.6),
best AS (SELECT * FROM offers QUALIFY row_number() OVER (PARTITION BY id ORDER BY confidence DESC, part) = 1),
members AS (SELECT id, count(*) AS n_members FROM offers GROUP BY id),
listed AS (
  SELECT id, string_agg(part, '|' ORDER BY part) AS members
  FROM (SELECT * FROM offers QUALIFY row_number() OVER (PARTITION BY id ORDER BY part) <= 3) GROUP BY id),
places AS (SELECT a.src AS id, a.dst AS nation, b.dst AS region FROM edges a JOIN edges b ON a.dst = b.src WHERE a.rel = 'IN' AND b.rel = 'PART_OF')
SELECT id, name, score, n_members, members, concat(id, '>OFFERS>', part, '|', id, '>IN>', nation, '|', nation, '>PART_OF>', region) AS chain
FROM best JOIN members USING (id) JOIN listed USING (id) JOIN places USING (id) JOIN nodes USING (id)
WHERE region IN ('region:1', 'region:3') AND nodes.size >= 0""")
def g_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From what a question names to who offers it, only in some regions: each answer with the chain of edges that leads there."""
    plan = found(spark, sf_dir)
    from_parts = Found(plan.nodes, plan.edges, members=3).start("part").text(names(plan), ASKED, least=0.6)
    whole = from_parts.traverse(Hop("OFFERS", "in", least=0.95, to_type="supplier", where={"size": {"gte": 0}}))
    answers = whole.require(Hop("IN", to_type="nation"), Hop("PART_OF", to=["region:1", "region:3"])).result(None)
    return answers.select("id", "name", "score", "n_members", F.array_join("members", "|").alias("members"), said("edges").alias("chain"))


@query(f"""
WITH {EDGES},
met AS (SELECT n.id AS member, e.dst AS id FROM nodes n JOIN edges e ON e.src = n.id WHERE n.type = 'customer' AND n.kind = 'BUILDING' AND e.rel = 'IN'),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY member) AS place FROM met)
SELECT id, CAST(count(*) AS BIGINT) AS n_members, string_agg(member, '|' ORDER BY place) FILTER (WHERE place <= 4) AS members,
       string_agg(member || '>IN>' || id, '|' ORDER BY place) FILTER (WHERE place <= 2) AS chain
FROM numbered WHERE id NOT IN (SELECT src FROM edges WHERE rel = 'PART_OF' AND dst = 'region:0')
GROUP BY id HAVING count(*) >= 3""")
def g_group_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = Found(nodes(spark, sf_dir), edges(spark, sf_dir), members=4)
    shared = plan.start("customer").where("kind", eq="BUILDING").group(Hop("IN"), least=3, evidence=2).exclude(Hop("PART_OF", to=["region:0"])).result(None)
    return shared.select("id", "n_members", F.array_join("members", "|").alias("members"), said("edges").alias("chain"))
