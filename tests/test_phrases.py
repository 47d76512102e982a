"""Phrase hits against one regular expression a phrase, in both ways; windows, lists and names."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import phrases

NAMES = ["web", "web server", "server", "c++", ".net", "a b", "b a", "a", "node.js", "r&d team", "..", "größe", "x y z"]


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(8)
    words = ["web", "server", "webs", "c++", ".net", "a", "b", "node.js", "r&d", "team", "größe", "x", "y", "z", "8"]
    texts = {i: "".join(rng.choice(words) + rng.choice([" ", " ", " ", ".", "", ", "]) for _ in range(rng.randint(0, 60))) for i in range(50)} | {90: "", 91: "a b a b a"}
    rows = spark.createDataFrame([*texts.items(), (92, None)], "id int, t string").repartition(3)
    return texts, rows, spark.createDataFrame([(n,) for n in [*NAMES, "a", " web ", ""]], "phrase string")


def test_hits_equal_a_regular_expression_each(frames):
    texts, rows, names = frames
    want = sorted((i, n, m.start(), len(n)) for i, t in texts.items() for n in NAMES if n not in ("..",) for m in re.finditer(rf"(?=(?<![a-z0-9]){re.escape(n)}(?![a-z0-9]))", t))
    assert sorted(map(tuple, phrases.hits(rows, names).collect())) == want
    dealt = phrases.hits(rows, names, most=3)
    assert sorted(map(tuple, dealt.collect())) == want
    plan = dealt._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert phrases.hits(rows, names.limit(0)).count() == 0 and phrases.hits(rows.limit(0), names).count() == 0


def test_leftmost_longest(frames):
    texts, rows, names = frames
    usable = sorted((n for n in NAMES if n != ".."), key=len, reverse=True)
    pattern = re.compile("(?<![a-z0-9])(?:" + "|".join(map(re.escape, usable)) + ")(?![a-z0-9])")
    want = sorted((i, m.group(), m.start(), len(m.group())) for i, t in texts.items() for m in pattern.finditer(t))
    assert sorted(map(tuple, phrases.leftmost(phrases.hits(rows, names)).collect())) == want


def test_nearest(spark):
    rng = random.Random(9)
    rows = [(t, f"p{k}", at, n, rng.randint(0, 1)) for t in range(6) for k, (at, n) in enumerate({rng.randint(0, 300): rng.randint(1, 9) for _ in range(12)}.items())]
    got = {(r.id, r.phrase): r.gap for r in phrases.nearest(spark.createDataFrame(rows, "id int, phrase string, at long, n long, g int"), "g").collect()}
    for t, p, at, n, g in rows:
        if g == 0:
            gaps = [max(a - at - n, at - a - m, 0) for u, _, a, m, h in rows if u == t and h == 1]
            assert got[t, p] == min(gaps, default=None)


def test_statements(spark):
    names = spark.createDataFrame([("Notes", "notes"), ("Go", "google docs"), ("Docs", "docs"), ("GitHub", "github"), ("C", "c++")], "name string, key string")
    texts = [
        (1, "An alternative to Notes, the Google Docs and GitHub etc. Not C++"), (2, "alternative to GitHub Gist"), (3, "open-source google docs alternative; a github-alternative"), (4, "We like notes"),
        (5, "Replacement for notes/c++ or docs!"), (6, None), (7, ""), (8, "alternatives to a, b\nnotes"),
    ]
    got = sorted((r.id, r.name) for r in phrases.stated(spark.createDataFrame(texts, "id int, t string"), names).collect())
    assert got == [(1, "GitHub"), (1, "Go"), (1, "Notes"), (3, "GitHub"), (3, "Go"), (5, "C"), (5, "Docs"), (5, "Notes")]


def test_plain(spark):
    assert [r.t for r in spark.createDataFrame([("A-B c",), (None,)], "t string").select(phrases.plain(F.col("t")).alias("t")).collect()] == ["a b c", ""]
