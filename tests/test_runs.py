"""Recomputing within a budget, and canonical texts."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import canonical
from millrace.operators import incremental

FACTS = "id int, stars int, topics array<string>"


def run(spark, rows, former, budget, name, settings="v1", seen=None):
    def score(frame):
        if seen is not None:
            seen.append({r.id for r in frame.collect()})
        return frame.select("id", (F.col("stars") * 2).alias("score"))

    out = incremental.recompute(spark.createDataFrame(rows, FACTS), former, "id", ["stars", "topics"], settings, score, F.lit(name), budget)
    return spark.createDataFrame(out.collect(), out.schema)


def test_only_changes_are_rescored(spark):
    none = spark.createDataFrame([], "id int, fingerprint string, evaluated_at string")
    rows = [(i, i, ["a", "b"]) for i in range(20)]
    first = run(spark, rows, none, 0, "1")
    assert {r.status for r in first.collect()} == {"new"} and first.count() == 20
    seen = []
    changed = [(i, i + 100 * (i in (3, 4)), t) for i, _, t in rows if i != 9] + [(50, None, None)]
    second = run(spark, changed, first, 100, "2", seen=seen)
    got = {r.id: (r.score, r.status, r.evaluated_at) for r in second.collect()}
    assert seen == [{3, 4, 50}]
    assert got[3] == (206, "rescored", "2") and got[5] == (10, "unchanged", "1") and got[50] == (None, "new", "2") and 9 not in got
    assert {r.status: r.n for r in incremental.tally(second, first, "id").collect()} == {"rescored": 2, "unchanged": 17, "new": 1, "removed": 1}


def test_budget_defers_and_the_oldest_come_first(spark):
    none = spark.createDataFrame([], "id int, score int, fingerprint string, evaluated_at string, status string")
    rows = [(i, i, []) for i in range(10)]
    state = run(spark, rows, none, 0, "1")
    state = run(spark, [*rows, (99, 1, [])], state, 4, "2", settings="v2")  # new settings: all are due; the new row counts against the budget
    by = {r.id: r for r in state.collect()}
    assert [i for i in range(10) if by[i].status == "rescored"] == [0, 1, 2] and by[99].status == "new"
    assert by[7].status == "deferred" and by[7].evaluated_at == "1" and by[7].score == 14
    state = run(spark, [*rows, (99, 1, [])], state, 5, "3", settings="v2")
    by = {r.id: r for r in state.collect()}
    assert [i for i in range(10) if by[i].status == "rescored"] == [3, 4, 5, 6, 7] and by[0].status == "unchanged" and by[8].status == "deferred"
    assert {r.status for r in run(spark, rows, state, 0, "4", settings="v3").collect()} == {"deferred"}


NESTED = T.StructType(
    [
        T.StructField("b", T.StructType([T.StructField("z", T.DoubleType()), T.StructField("a", T.ArrayType(T.StructType([T.StructField("y", T.StringType()), T.StructField("x", T.DecimalType(10, 3))])))])),
        T.StructField("a", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))),
        T.StructField("t", T.StringType()),
        T.StructField("ok", T.BooleanType()),
    ]
)


def test_permuted_facts_have_one_text(spark):
    rng = random.Random(1)
    value = {"b": {"z": 3.0, "a": [{"y": 'q"\\\n', "x": 1.5}, {"y": None, "x": 2.0}]}, "a": {"k2": {"n": 1e-7, "m": 2.0}, "k1": {}, "é": {"": -0.5}}, "t": None, "ok": True}
    want = '{"a":{"k1":{},"k2":{"m":2,"n":1.0E-7},"é":{"":-0.5}},"b":{"a":[{"x":1.5,"y":"q\\"\\\\\\n"},{"x":2,"y":null}],"z":3},"ok":true,"t":null}'

    def shuffled(kind):
        if isinstance(kind, T.StructType):
            return T.StructType(rng.sample([T.StructField(f.name, shuffled(f.dataType)) for f in kind], len(kind)))
        return T.ArrayType(shuffled(kind.elementType)) if isinstance(kind, T.ArrayType) else kind

    def of(x, kind):
        from decimal import Decimal

        if x is None:
            return None
        if isinstance(kind, T.StructType):
            return tuple(of(x[f.name], f.dataType) for f in kind)
        if isinstance(kind, T.ArrayType):
            return [of(v, kind.elementType) for v in x]
        if isinstance(kind, T.MapType):
            return {k: of(x[k], kind.valueType) for k in rng.sample(list(x), len(x))}
        return Decimal(str(x)) if isinstance(kind, T.DecimalType) else x

    for _ in range(4):
        kind = shuffled(NESTED)
        frame = spark.createDataFrame([of(value, kind)], kind)
        assert frame.select(canonical.facts(frame, frame.columns).alias("c")).first().c == want


def test_json_texts_of_equal_facts(spark):
    same = ['{"a": 1, "b": [1.50, {"y": null, "x": 2.0}]}', ' {"b":[15e-1,{"x":2,"y":null}],"a":1.0}']
    frame = spark.createDataFrame([(t,) for t in [*same, "{", None, '"1"', "1"]], "t string")
    got = [r.c for r in frame.select(canonical.canonical_json("t").alias("c")).collect()]
    assert got[0] == got[1] == '{"a":1,"b":[1.5,{"x":2,"y":null}]}' and got[2:] == [None, None, '"1"', "1"]
    assert json.loads(got[0])["b"][0] == 1.5


def test_numbers_have_one_form(spark):
    frame = spark.createDataFrame([(1, 1.0, 0.1), (2, -0.0, float("nan")), (3, 1e300, 1e15)], "i int, d double, f double").withColumn("g", F.col("d").cast("float"))
    got = [tuple(r) for r in frame.select(*[canonical.canonical(F.col(c), frame.schema[c].dataType).alias(c) for c in "idf"]).collect()]
    assert got == [("1", "1", "0.1"), ("2", "0", '"NaN"'), ("3", "1.0E300", "1000000000000000")]
    tenth = spark.createDataFrame([(0.1,)], "f float")
    assert tenth.select(canonical.facts(tenth, ["f"])).first()[0] == '{"f":0.1}'
