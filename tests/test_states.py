"""Streamed state equals the batch twin for several orders of arrival; old state is forgotten."""

import random

import pytest

from millrace.streaming import states


def arrived(spark, rows, schema, path, parts):
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("order", [0, 1, 2])
def test_mentions_in_any_order(spark, tmp_path, order):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(4), rng.randrange(1, 30) * 1_000_000, float(rng.randrange(9))) for _ in range(120)]
    schema = "source string, item long, at long, points double"
    want = {(r.source, r.item): r for r in states.mentions_of(spark.createDataFrame(rows, schema), 4).collect()}
    rows = [rows, rows[::-1], random.Random(order).sample(rows, len(rows))][order]
    stream = arrived(spark, rows, schema, str(tmp_path / "in"), 3)
    states.into(states.mentions(stream, keep=4), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = {(r.source, r.item): r for r in states.newest(spark, str(tmp_path / "out"), ["source", "item"], states.MENTION).collect()}
    assert set(got) == set(want) and len(got) == 8
    for k, r in want.items():
        assert (got[k].at, got[k].points, got[k].n_readings, got[k].readings) == (r.at, r.points, r.n_readings, r.readings)


@pytest.mark.parametrize("order", [0, 1, 2])
def test_entities_in_any_order(spark, tmp_path, order):
    rng = random.Random(6)
    kinds = ["queued", "failed", "failed", "accepted", "held", "canonical", "unheard"]
    rows = [(i % 25, rng.randrange(1000), rng.choice(kinds)) for i in range(150)] + [(90, t, "failed") for t in range(5)]
    rows = list({(a, b): (a, b, c) for a, b, c in rows}.values())
    frame = spark.createDataFrame(rows, "id long, at long, outcome string")
    want = {i: states.folded([(t, o) for j, t, o in rows if j == i]) for i in {r[0] for r in rows}}
    assert want[90] == ("dead_letter", 3, 3, 2)
    known = [o for o in kinds if o != "unheard"]
    twin = {r.id: (r.state, r.attempts, r.n_outcomes, r.at) for r in states.entities_of(frame.where(frame.outcome.isin(known))).collect()}
    assert twin == {i: states.folded([(t, o) for j, t, o in rows if j == i and o in known]) for i in twin}
    rows = [rows, rows[::-1], random.Random(order).sample(rows, len(rows))][order]
    stream = arrived(spark, rows, frame.schema, str(tmp_path / "in"), 3)
    states.into(states.entities(stream), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = {r.id: (r.state, r.attempts, r.n_outcomes, r.at) for r in states.newest(spark, str(tmp_path / "out"), ["id"], states.ENTITY).collect()}
    assert got == want


def test_mentions_are_forgotten(spark, tmp_path):
    day = 86_400_000_000
    schema = "source string, item long, at long, points double"
    for rows in ([("a", 1, 3, 1.0), ("a", 1, 5, 2.0)], [("b", 1, 100 * day, 1.0)], [("b", 2, 101 * day, 1.0)], [("a", 1, 102 * day, 7.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        states.into(states.mentions(stream, retain=30.0), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = {(r.source, r.item): (r.n_readings, r.points) for r in states.newest(spark, str(tmp_path / "out"), ["source", "item"], states.MENTION).collect()}
    assert got == {("a", 1): (1, 7.0), ("b", 1): (1, 1.0), ("b", 2): (1, 1.0)}
