"""Evidence, quotas, chains, as-of growth and streaming helpers on tiny frames."""

import datetime as dt
import random

from pyspark.sql import functions as F

from millrace.operators import asof, evidence, quality, reconcile, state


def test_quotas_are_sequential(spark):
    rows = [(i, r, f) for i, (r, f) in enumerate([("a", "x"), ("a", "x"), ("a", "x"), ("b", "x"), ("b", "x"), ("b", "x"), ("c", "y")])]
    got = evidence.quotas(spark.createDataFrame(rows, "i int, r string, f string"), "r", "f", ["i"], 2, 3).collect()
    assert sorted(x.i for x in got) == [0, 1, 3, 6]


def test_validation_tells_unknown_from_failed(spark):
    rows = spark.createDataFrame([(1, 5, None), (2, None, None), (3, -1, 4), (4, 5, 4)], "i int, a int, b int")
    got = {r.i: (r.status, r.failed, r.unknown) for r in evidence.validated(rows, {"a": F.col("a") > 0, "b": F.col("b") > 0}).collect()}
    assert got == {1: ("flagged", [], ["b"]), 2: ("flagged", [], ["a", "b"]), 3: ("failed", ["a"], []), 4: ("valid", [], [])}


def test_range_split_covers_all_rows_once(spark):
    rows = spark.createDataFrame([(float(i * i),) for i in range(500)], "x double")
    cells = evidence.range_split(rows, "x", 60, 6).collect()
    assert sum(c.n for c in cells) == 500 and all(c.n <= 60 or c.level == 6 for c in cells)
    assert evidence.range_split(rows.limit(0), "x", 60).count() == 0


def test_growth_statuses(spark):
    d = lambda n: dt.date(2024, 1, n)
    history = spark.createDataFrame([("a", d(1), 100.0), ("a", d(8), 150.0), ("b", d(8), 10.0)], "k string, day date, total double")
    got = {(r.k, r.window): (r.status, r.change, r.label) for r in asof.growth(history, "k", "2024-01-08").collect()}
    assert got["a", 7] == ("measured", 50.0, "surging") and got["b", 7] == ("no_baseline", None, "none") and got["a", 30] == ("insufficient_history", None, "none")


def test_regressions_count_a_lost_metric(spark):
    a, b = spark.createDataFrame([("x", 0.9), ("y", 0.5), ("z", 0.4)], "k string, v double"), spark.createDataFrame([("x", 0.7), ("y", 0.49)], "k string, v double")
    assert sorted(r.k for r in evidence.regressions(a, b, "k", "v", 0.05).collect()) == ["x", "z"]


def test_presence_and_contradiction(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string"), spark.createDataFrame([(2, "z"), (3, None), (4, "w")], "k int, v string")
    assert {r.k: r.change for r in reconcile.present(a, b, "k", ["v"]).collect()} == {1: "dropped", 2: "changed", 3: "same", 4: "new"}


def test_rate_and_attempts(spark):
    rows = spark.createDataFrame([(1, "p", 0), (2, "p", 10), (3, "p", 3000), (4, "p", 3605)], "i int, p string, s long")
    assert {r.i: r.recent for r in state.rate(rows, "p", "s", 3600, 2).collect()} == {1: 1, 2: 2, 3: 3, 4: 3}
    outcomes = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 1, True), ("b", 2, True), ("b", 3, True)], "k string, t int, bad boolean")
    assert {r.k: (r.failures, r.state) for r in state.attempts(outcomes, "k", ["t"], F.col("bad")).collect()} == {"a": (1, "retry"), "b": (3, "dead")}


def test_bucket_quantile(spark):
    counts = spark.createDataFrame([("t", 10, 90), ("t", 50, 8), ("t", 1000, 2)], "tool string, bucket int, n int")
    assert [quality.bucket_quantile(counts, "tool", "bucket", "n", q).first()["bucket"] for q in (0.5, 0.95, 0.99)] == [10, 50, 1000]


def test_candidates_take_the_least_used_of_their_routes(spark):
    rng = random.Random(7)
    names = ["a:x", "a:y", "b:x", "b:y", "b:z"]
    rows = [(i, rng.sample(names, rng.randint(1, 3))) for i in range(400)]
    per_route, per_family, routes, families, want = 6, 9, {}, {}, []
    for i, mine in rows:
        fit = [r for r in mine if routes.get(r, 0) < per_route and families.get(r[0], 0) < per_family]
        if fit:
            best = min(fit, key=lambda r: (routes.get(r, 0), r))
            routes[best], families[best[0]] = routes.get(best, 0) + 1, families.get(best[0], 0) + 1
            want.append((i, best))
    frame = spark.createDataFrame(rows, "i int, routes array<string>")
    got = evidence.routed(frame, "i", "routes", ["i"], per_route, per_family, F.split("route", ":")[0])
    assert sorted(map(tuple, got.collect())) == want
