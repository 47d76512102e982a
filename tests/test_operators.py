"""Operators on tiny frames, one rule each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import scores, text, times
from millrace.operators import asof, graph, identity, mentions, quality, reconcile, retrieval, rules, selection, state
from millrace.plans.plan import Plan, predicate


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'array<string>' if isinstance(v, list) else 'long'}" for n, v in values.items())).select(*names, column.alias("r")).first()["r"]


@pytest.mark.parametrize("x, want", [(-5.0, 100.0), (45.0, 92.5), (90.0, 85.0), (5000.0, 0.0)])
def test_curve(spark, x, want):
    assert one(spark, scores.curve(F.col("x"), ((0, 100.0), (90, 85.0), (365, 0.0))), x=x) == pytest.approx(want)


def test_unknown_is_not_zero(spark):
    parts = [(40.0, F.col("a").cast("double")), (60.0, F.col("b").cast("double"))]
    assert one(spark, scores.known_mean(parts), a=None, b="50") == 50.0
    assert one(spark, scores.known_mean(parts), a=None, b=None) is None
    assert one(spark, scores.known_share(parts), a="1", b=None) == pytest.approx(0.4)


def test_predicates_and_null(spark):
    assert one(spark, predicate(F.col("x"), {"ne": "a"}), x=None) is True
    assert one(spark, predicate(F.col("x"), {"gte": "a"}), x=None) is False
    assert one(spark, predicate(F.col("x"), {"contains": "b"}), x=["a", "b"]) is True
    with pytest.raises(ValueError):
        predicate(F.col("x"), {"like": "a"})


def test_text_keys(spark):
    assert one(spark, text.slug(F.col("x")), x="  Éclair & Söhne / 2 ") == "eclair-sohne-2"
    assert one(spark, text.category_key(F.col("x")), x="Forms & Surveys") == "form-and-survey"
    key, reason = text.repo_key(F.col("x"))
    assert one(spark, key, x="https://www.Example.org/Owner/Name.git?x=1") == "example.org/owner/name"
    assert one(spark, reason, x="ftp://a/b/c") == "not_a_web_url"
    assert one(spark, text.truncated(F.col("x"), 6), x="ab  cd efgh") == "ab cd…"


def test_stale_when_unknown(spark):
    assert one(spark, times.stale(F.col("x").cast("int"), 10), x=None) is True


def test_rejection_codes(spark):
    codes = {"b": "B", "a": "A"}
    assert one(spark, reconcile.rejection_code(F.col("x"), codes), x="a; b") == "B"
    with pytest.raises(Exception, match="unknown reason"):
        one(spark, reconcile.rejection_code(F.col("x"), codes), x="c")


def test_append_once_never_rewrites(spark):
    old = spark.createDataFrame([(1, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    assert sorted(map(tuple, reconcile.append_once(old, new, ["k"]).collect())) == [(1, "x"), (2, "z")]


def test_as_of_ignores_later_days_and_respects_tolerance(spark):
    d = lambda n: dt.date(2024, 1, n)
    history = spark.createDataFrame([(1, d(1), 10.0), (1, d(9), 20.0), (2, d(9), 5.0)], "k int, day date, total double")
    points = spark.createDataFrame([(1, d(3)), (1, d(8)), (2, d(8))], "k int, p date")
    got = {(r.k, r.p): r.base for r in asof.as_of_value(history, points, "k", "p", 3).collect()}
    assert got == {(1, d(3)): 10.0, (1, d(8)): None, (2, d(8)): None}
    bases = {r.window: r.base for r in asof.as_of_days(history, "2024-01-08", [(1, 0), (7, 1)]).collect()}
    assert bases == {7: d(1)}


def test_jumps_are_judged_by_what_comes_after(spark):
    days = [(k, dt.date(2024, 1, n + 1), v) for k, row in enumerate([[0.0, 200.0, 150.0, 160.0], [0.0, 200.0, 20.0], [100.0, 110.0, 900.0], [1000.0, 1100.0], [500.0, 100.0, 120.0]]) for n, v in enumerate(row)]
    got = {(r.k, r.day.day): (r.step, r.outcome) for r in asof.jumps(spark.createDataFrame(days, "k int, day date, total double"), "k", 150.0, relative=0.5).collect()}
    # a jump on the newest day waits, one that goes back is a spike, a share of the former value counts
    assert got == {(0, 2): (200.0, "confirmed"), (1, 2): (200.0, "transient"), (1, 3): (-180.0, "unconfirmed"), (2, 3): (790.0, "unconfirmed"), (4, 2): (-400.0, "confirmed")}


def test_members_of_a_large_node_all_meet(spark):
    edges = spark.createDataFrame([(i, "R", 0, 1.0) for i in range(120)] + [(500, "R", 1, 1.0), (3, "R", 1, 0.5)], "src long, rel string, dst long, confidence double")
    for block in (16, 1000):
        got = {(r.a, r.b): r.n_shared for r in graph.co_members(edges, "R", 0.8, block).collect()}
        assert len(got) == 120 * 119 // 2 + 1 and got[3, 500] == 1


def test_upsert_does_not_depend_on_order(spark):
    t = lambda n: dt.datetime(2024, 1, n)
    rows = [(1, t(n), float(n)) for n in range(1, 8)]
    frame = lambda r: spark.createDataFrame(r, "k int, at timestamp, points double")
    a = mentions.upsert(frame(rows[:3]), frame(rows[3:]), "k", 3).collect()
    b = mentions.upsert(frame(rows[4:]), frame(rows[:5]), "k", 3).collect()
    assert a == b and [x.points for x in a[0].observed] == [1.0, 6.0, 7.0]


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102)]
    got = {r.node: r.component for r in identity.components(spark.createDataFrame(links, "a int, b int")).collect()}
    assert set(got.values()) == {0, 100} and got[40] == 0 and got[102] == 100


def test_plan_steps(spark):
    nodes = spark.createDataFrame([("a", "x", 1), ("b", "x", None), ("c", "y", 3), ("d", "y", 4)], "id string, type string, size int")
    edges = spark.createDataFrame([("a", "R", "c", 0.5), ("b", "R", "c", 0.9), ("b", "R", "d", 0.2)], "src string, rel string, dst string, confidence double")
    plan = Plan(nodes, edges)
    assert [r.id for r in plan.start("x").traverse("R").rank("confidence").frame().collect()] == ["c", "d"]
    assert [r.id for r in plan.start("x").where(size={"exists": False}).frame().collect()] == ["b"]
    assert {r.id: r.n for r in plan.start("x").group("R", "out", 2).frame().collect()} == {"c": 2}
    assert [r.id for r in plan.start("y").exclude(("R", "in")).frame().collect()] == []
    with pytest.raises(ValueError):
        plan.limit(1)
    assert graph.walk(nodes.where("id = 'a'").select("id"), edges, [("R", "out"), ("R", "in")]).count() == 2


def test_most_specific_url_rule(spark):
    urls = spark.createDataFrame([(1, "a.b.org", "/x/y"), (2, "b.org", "/z"), (3, "xb.org", "/")], "id int, host string, path string")
    table = spark.createDataFrame([("all", "b.org", "/"), ("deep", "b.org", "/x"), ("sub", "a.b.org", "/")], "rule string, domain string, prefix string")
    assert {r.id: r.rule for r in rules.match_urls(urls, table, "id", "host", "path").collect()} == {1: "sub", 2: "all"}


def test_longest_name_without_ties(spark):
    texts = spark.createDataFrame([(1, "big data tool here"), (2, "red hat and sun one")], "id int, t string")
    names = spark.createDataFrame([("big data", 2), ("big data tool", 3), ("red hat", 2), ("sun one", 2)], "name string, n_words int")
    assert [tuple(r) for r in rules.longest_name(texts, names, "id", F.split("t", " ")).collect()] == [(1, "big data tool")]


def test_budget_and_caps(spark):
    rows = spark.createDataFrame([(i, i % 4 == 0) for i in range(12)], "i int, must boolean")
    assert sorted(r.i for r in selection.budget(rows, F.col("must"), [F.col("i")], 5).collect()) == [0, 1, 2, 4, 8]
    sizes = spark.createDataFrame([(5,), (5,), (1,)], "n int")
    assert selection.largest_cap(sizes, "n", 7, 9).first()["cap"] == 3


def test_bm25_formula(spark):
    docs = spark.createDataFrame([(1, "cat cat dog"), (2, "dog"), (3, "bird dog fish")], "id int, t string")
    at = retrieval.index(retrieval.bags([(F.split("t", " "), 1.0)], docs, "id"))
    got = {r.doc: r.score for r in retrieval.bm25(at, spark.createDataFrame([("q", "cat")], "query string, term string")).collect()}
    import math

    assert got == {1: pytest.approx(math.log(1 + 2.5 / 1.5) * 2 * 2.2 / (2 + 1.2 * (0.25 + 0.75 * 3 / (7 / 3))), abs=1e-4)}


def test_suppression_and_streaks(spark):
    assert one(spark, quality.suppressed(F.col("n")), n=3) == "<5" and one(spark, quality.suppressed(F.col("n")), n=0) == "0"
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate("aabaaa")], "k int, i int, x string")
    assert sorted(r.length for r in quality.streaks(rows, "k", ["i"], F.col("x") == "a").collect()) == [2, 3]


def test_submission_outcomes(spark):
    rows = spark.createDataFrame([(1, "p", "k", "d", 1), (2, "p", "k", "d", 2), (3, "p", "k", "e", 3), (4, "p", "l", "e", 4)], "id int, p string, k string, d string, t int")
    assert {r.id: r.outcome for r in state.submit(rows, "p", "k", "d", ["t"]).collect()} == {1: "accepted", 2: "replay", 3: "conflict", 4: "accepted"}
