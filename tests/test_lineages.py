"""Cut answers, checked chains, causes of changes, and bounded rounds against a plain walk."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.functions import compact
from millrace.operators import graph, lineage

BLOCKS = compact.Blocks({"scores": "scores", "history": "history", "readme": "texts", "label": "labels"}, r"^(licence.*|tier|as_of)$", whole=frozenset({"texts"}), top=frozenset({"label"}))
SCHEMA = (
    "name:string, licence:struct<id:string, history:string>, label:string, readme:struct<tier:string>, scores:struct<fit:int, parts:array<struct<x:int, as_of:string>>>, "
    "rows:array<struct<id:int, label:string, history:struct<n:int, tier:string>, inner:struct<label:string, scores:int>>>, by:map<string,struct<v:int, history:int>>"
)


def test_blocks_go_and_trusted_fields_stay(spark):
    one = ("a", ("MIT", "kept whole"), "top", ("gone",), (1, [(1, "d1"), (2, None)]), [(1, "l", (5, "T1"), ("in", 3)), (2, None, None, None)], {"k": (1, 2)})
    bare = ("b", None, None, None, None, [], {})
    frame = spark.createDataFrame([(1, one), (2, bare), (3, None)], f"id int, r struct<{SCHEMA}>")
    cut = {r.id: r for r in compact.compact(frame, "r", BLOCKS).collect()}
    got = cut[1].r.asDict(True)
    assert got == {
        "name": "a", "licence": {"id": "MIT", "history": "kept whole"}, "scores": {"parts": [{"as_of": "d1"}]},
        "rows": [{"id": 1, "label": "l", "history": {"tier": "T1"}, "inner": {"label": "in"}}, {"id": 2, "label": None, "history": None, "inner": None}], "by": {"k": {"v": 1}},
    }
    assert cut[1].left_out == ["history", "labels", "scores", "texts"] and cut[2].left_out == [] and cut[3].r is None and cut[3].left_out == []
    some = compact.compact(frame, "r", BLOCKS, frozenset({"scores", "texts"})).where("id = 1").first()
    assert some.r.scores.fit == 1 and some.r.readme.tier == "gone" and some.left_out == ["history", "labels"]
    whole = compact.compact(frame, "r", BLOCKS, frozenset(BLOCKS.of.values()))
    assert whole.where("id = 1").first().r == frame.where("id = 1").first().r
    with pytest.raises(ValueError, match="unknown blocks nothing"):
        compact.compact(frame, "r", BLOCKS, frozenset({"nothing"}))


def test_an_altered_part_breaks_the_chain(spark):
    rows = [(v, p, f"{p}{i}", i) for v in (1, 2, 3, 4) for p in "xyz" for i in range(v * 3)]
    schema = "version int, part string, name string, n int"
    good = spark.createDataFrame(rows, schema)
    recorded = lineage.versions(lineage.parts(good, "version", "part")).select((F.col("version") * 1).alias("seq"), "version", F.when(F.col("version") > 1, F.col("version") - 1).alias("replaces"), "n", "digest")
    again = lineage.versions(lineage.parts(good.orderBy(F.rand(1)).repartition(5), "version", "part"))
    assert all(r.ok and r.sound for r in lineage.verified(recorded, again).collect())
    bad = good.withColumn("name", F.when((F.col("version") == 3) & (F.col("part") == "y") & (F.col("n") == 2), "changed").otherwise(F.col("name")))
    checked = {r.version: r for r in lineage.verified(recorded, lineage.versions(lineage.parts(bad, "version", "part"))).collect()}
    assert [checked[v].ok for v in (1, 2, 3, 4)] == [True, True, False, True] and [checked[v].sound for v in (1, 2, 3, 4)] == [True, True, False, False]
    assert [tuple(r) for r in lineage.altered(lineage.parts(good, "version", "part"), lineage.parts(bad, "version", "part")).collect()] == [(3, "y", "altered")]
    # a row that is moved and one that is lost and added twice are seen, too
    moved = good.withColumn("part", F.when((F.col("version") == 2) & (F.col("name") == "x0"), "z").otherwise(F.col("part")))
    assert {tuple(r) for r in lineage.altered(lineage.parts(good, "version", "part"), lineage.parts(moved, "version", "part")).collect()} == {(2, "x", "altered"), (2, "z", "altered")}
    linked = recorded.withColumn("replaces", F.when(F.col("version") == 4, 2).otherwise(F.col("replaces")))
    (wrong,) = [r for r in lineage.verified(linked, again).collect() if not r.ok]
    assert wrong.version == 4 and wrong.problems == ["replaces another version than the one before"]
    gone = {r.version: r.problems for r in lineage.verified(recorded, again.where("version <> 2")).collect()}
    assert gone[2] == ["rows are missing"]


def test_changes_have_causes(spark):
    schema = "id string, inside boolean, links int, rank int"
    before = spark.createDataFrame([("a", True, 3, 1), ("b", True, 2, 2), ("c", True, 1, 3), ("d", False, 0, None), ("e", False, 2, 9), ("f", True, 1, 4)], schema)
    after = spark.createDataFrame([("a", True, 3, 1), ("b", False, 0, None), ("c", False, 1, 8), ("d", True, 2, 2), ("e", True, 2, 3), ("g", True, 1, 5)], schema)
    left = [("unknown_now", F.col("after.id").isNull()), ("no_links", F.col("after.links") == 0), ("below_cutoff", F.col("after.rank") > 5)]
    joined = [("first_seen", F.col("before.id").isNull()), ("gained_links", F.col("before.links") == 0)]
    got = {r.id: (r.change, r.cause) for r in lineage.reconciled(before, after, "id", "inside", left, joined).collect()}
    assert got == {"b": ("removed", "no_links"), "c": ("removed", "below_cutoff"), "f": ("removed", "unknown_now"), "d": ("added", "gained_links"), "e": ("added", "other"), "g": ("added", "first_seen")}


def walked(seeds, routes, depth, least, bound):
    out = {s: (0, 0, "seed") for s in seeds}
    open_ = set(seeds)
    for n in range(1, depth + 1):
        met = defaultdict(set)
        for a, r, b in routes:
            if a in open_:
                met[b].add(r)
        fresh = sorted(((-len(r), i) for i, r in met.items() if i not in out))
        open_ = {i for k, i in [x for x in fresh if -x[0] >= least][:bound]}
        for k, i in fresh:
            out[i] = (n, -k, "few_routes" if -k < least else "admitted" if i in open_ else "over_bound")
        if not open_:
            break
    return out


@pytest.mark.parametrize("depth,least,bound", [(1, 2, 3), (3, 2, 4), (4, 1, 1000), (3, 9, 5), (2, 1, 0)])
def test_frontier_equals_a_plain_walk(spark, depth, least, bound):
    rng = random.Random(3)
    routes = [(rng.randrange(40), f"r{rng.randrange(6)}", rng.randrange(40)) for _ in range(160)]
    seeds = [1, 2, 3]
    frames = spark.createDataFrame([(s,) for s in [*seeds, 1]], "id int"), spark.createDataFrame(routes, "src int, route string, dst int")
    got = {r.id: (r.depth, r.n_routes, r.status) for r in graph.frontier(*frames, depth, least, bound).collect()}
    assert got == walked(seeds, routes, depth, least, bound)
