"""Plans with evidence: chains, best edges, matched words, counts of steps; and a store of postings whose scans are pruned."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import retrieval
from millrace.plans.evidence import Found, Hop
from millrace.queries import search


@pytest.fixture(scope="module")
def plan(spark):
    nodes = [("p1", "project", "one", 3.0), ("p2", "project", "two", None), ("p3", "project", "three", 9.0), ("s1", "product", "notes", None), ("s2", "product", "mail", None), ("k1", "category", "writing", None), ("o1", "owner", "acme", None)]
    edges = [
        ("p1", "REPLACES", "s1", 0.9), ("p2", "REPLACES", "s1", 0.7), ("p2", "REPLACES", "s2", 0.95), ("s1", "BELONGS_TO", "k1", 1.0), ("p1", "OWNED_BY", "o1", 1.0), ("p3", "OWNED_BY", "o1", 1.0),
        ("p1", "SIMILAR", "p3", 0.6), ("p3", "REPLACES", "s2", 0.95),
    ]
    return Found(spark.createDataFrame(nodes, "id string, type string, name string, stars double"), spark.createDataFrame(edges, "src string, rel string, dst string, confidence double"), frozenset({"SIMILAR"}))


def test_require_returns_the_chain(plan):
    asked = plan.start("project").require(Hop("REPLACES"), Hop("BELONGS_TO", to=["k1"])).rank("id")
    rows = asked.result().collect()
    # p2's better edge leads to s2, from which the path does not go on
    assert [(r.id, [(e.src, e.rel, e.dst) for e in r.edges]) for r in rows] == [(p, [(p, "REPLACES", "s1"), ("s1", "BELONGS_TO", "k1")]) for p in ("p1", "p2")]
    assert asked.trace() == [("start", 3), ("require", 2), ("rank", 2)]


def test_traverse_keeps_the_best_edge_and_all_members(plan):
    asked = plan.start(ids=["p1", "p2", "p3", "nobody"]).where("type", eq="project").traverse(Hop("REPLACES", least=0.75)).rank("id")
    s1, s2 = asked.result().collect()
    assert (s1.id, s1.n_members, s1.members, s1.edges[-1].confidence) == ("s1", 1, ["p1"], 0.9)
    assert (s2.n_members, s2.members, s2.edges[-1].src) == (2, ["p2", "p3"], "p2")  # a tie: the smaller id
    assert s2.facets[0].field == "type" and s2.facets[0].entity == "p2"
    assert asked.trace() == [("start", 3), ("where", 3), ("traverse", 2), ("rank", 2)]
    gone = plan.start(ids=["s1", "s2"]).traverse(Hop("REPLACES", "in"), exclude_ids=["p3"]).exclude(Hop("OWNED_BY", to=["o1"])).result().collect()
    assert [r.id for r in gone] == ["p2"]


def test_symmetric_group_and_rank(plan):
    near = plan.start(ids=["p3"]).traverse(Hop("SIMILAR")).result().collect()
    assert [(r.id, r.edges[0].src) for r in near] == [("p1", "p1")]
    (owner,) = plan.start("project").group(Hop("OWNED_BY"), least=2, evidence=1).result().collect()
    assert (owner.id, owner.score, owner.members, len(owner.edges)) == ("o1", 2.0, ["p1", "p3"], 1)
    assert [r.id for r in plan.start("project").rank("stars").result(2).collect()] == ["p3", "p1"]
    assert [r.id for r in plan.start("project").rank("name").result().collect()] == ["p1", "p3", "p2"]


def test_hot_neighbour_meets_in_parts(spark):
    n = 3000
    nodes = spark.range(n).select(F.format_string("m%05d", "id").alias("id"), F.lit("m").alias("type"), F.lit("x").alias("name")).unionByName(spark.createDataFrame([("hub", "h", "hub")], "id string, type string, name string"))
    edges = spark.range(n).select(F.format_string("m%05d", "id").alias("src"), F.lit("IN").alias("rel"), F.lit("hub").alias("dst"), (F.col("id") % 7 / 10).alias("confidence"))
    (hub,) = Found(nodes, edges, members=4).start("m").traverse(Hop("IN")).result().collect()
    assert (hub.n_members, hub.members, hub.edges[0].src) == (n, ["m00000", "m00001", "m00002", "m00003"], "m00006")


def test_text_step_scores_and_explains(spark, plan):
    docs = spark.createDataFrame([("p1", "notes server for teams"), ("p2", "mail client"), ("p3", "server for notes and mcp notes")], "id string, t string")
    at = retrieval.index(retrieval.bags([(F.split("t", " "), 1.0)], docs, "id"))
    asked = plan.start("project").text(at, ["mcp", "notes", "server", "unseen"], least=0.05).rank("score")
    rows = asked.result().collect()
    assert [r.id for r in rows] == ["p3", "p1"] and rows[0].semantic[0].terms == ["mcp", "notes", "server"] and rows[0].score > rows[1].score > 0
    assert asked.trace()[-1] == ("rank", 2)
    assert [r.score for r in plan.start("project").text(at, ["unseen"]).result().collect()] == [0.0] * 3


def test_fields_weigh(spark):
    docs = spark.createDataFrame([(1, "a b a", "b c"), (2, None, "c"), (3, "", None)], "id int, t string, u string")
    found = retrieval.bags([(F.split("t", " "), 2.0), (F.split("u", " "), 0.5)], docs, "id").where("doc < 3").collect()
    assert {r.doc: {t.term: t.tf for t in r.terms} for r in found if r.doc == 1} == {1: {"a": 4.0, "b": 2.5, "c": 0.5}}
    assert next(r.length for r in found if r.doc == 1) == 7.0


def test_one_query_reads_its_terms(spark):
    docs = spark.range(400).select("id", F.concat_ws(" ", F.lit("all"), F.concat(F.lit("w"), F.col("id") % 50)).alias("t"))
    at = retrieval.index(retrieval.bags([(F.split("t", " "), 1.0)], docs, "id"))
    few = at.of(spark.createDataFrame([("w7",), ("absent",)], "term string"))
    assert few.count() == 8 and {r.term for r in few.select("term").collect()} == {"w7"}
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "In(term, [absent,w7])" in plan
    read = lambda rows: rows.select(F.input_file_name()).distinct().count()
    assert read(few) == 1 < read(at.postings)
    many = at.of(docs.select(F.explode(F.split("t", " ")).alias("term")))
    assert many.count() == 800


def test_a_changed_table_gets_a_new_index(spark, tmp_path):
    write = lambda t: spark.createDataFrame([(1, t)], "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    write("first words")
    one = search.indexed(spark, str(tmp_path))
    assert search.indexed(spark, str(tmp_path)) is one
    write("second words here")
    two = search.indexed(spark, str(tmp_path))
    assert two is not one and {r.term for r in two.postings.select("term").collect()} == {"second", "word", "here"}
