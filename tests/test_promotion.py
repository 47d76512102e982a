"""Versions: a stop between writing and promoting, replays, failed checks, restores; items that fail alone."""

import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.streaming import promotion

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("at", T.LongType()), T.StructField("v", T.DoubleType())])


@pytest.fixture
def table(spark, tmp_path):
    return promotion.Versioned(spark, str(tmp_path / "t"), SCHEMA)


def rows(spark, *items):
    return spark.createDataFrame([(k, at, float(v)) for k, at, v in items], SCHEMA)


def state(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_batches_are_applied_once(spark, table):
    step = promotion.newest_by(["k"], ["at"])
    assert state(table.current()) == [] and table.version() is None
    assert table.apply(rows(spark, ("a", 1, 1), ("b", 1, 2)), 0, step) == "promoted"
    assert table.apply(rows(spark, ("a", 9, 9)), 0, step) == "replayed"
    assert table.apply(rows(spark, ("a", 2, 5), ("c", 1, 1)), 1, step) == "promoted"
    assert state(table.current()) == [("a", 2, 5.0), ("b", 1, 2.0), ("c", 1, 1.0)]
    assert state(table.current(1)) == [("a", 1, 1.0), ("b", 1, 2.0)]


def test_a_stop_before_the_promotion_leaves_the_former_version(spark, table, monkeypatch):
    step = promotion.newest_by(["k"], ["at"])
    table.apply(rows(spark, ("a", 1, 1)), 0, step)

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(promotion.Versioned, "_promote", stop)
        with pytest.raises(KeyboardInterrupt):
            table.apply(rows(spark, ("a", 2, 2)), 1, step)
    assert state(table.current()) == [("a", 1, 1.0)] and table.version()["version"] == 1
    assert table.apply(rows(spark, ("a", 2, 2)), 1, step) == "promoted"  # the run after the stop
    assert state(table.current()) == [("a", 2, 2.0)]


def test_a_failed_check_promotes_nothing_and_versions_can_be_restored(spark, table):
    step = promotion.newest_by(["k"], ["at"])
    table.apply(rows(spark, ("a", 1, 1)), 0, step)
    table.apply(rows(spark, ("a", 2, 2)), 1, step)
    with pytest.raises(promotion.CheckFailed, match="1 of 2"):
        table.apply(rows(spark, ("b", 1, -1)), 2, step, lambda made: F.col("v") >= 0)
    assert table.version()["version"] == 2
    table.restore(1)
    assert state(table.current()) == [("a", 1, 1.0)] and table.version()["status"] == "restored"
    assert table.apply(rows(spark, ("c", 1, 1)), 2, step) == "promoted"
    assert state(table.current()) == [("a", 1, 1.0), ("c", 1, 1.0)]
    assert len(table.superseded(1)) == 2 and table.version()["path"] not in table.superseded(1)
    with pytest.raises(ValueError):
        table.restore(77)


def test_order_of_batches_changes_nothing(spark, tmp_path):
    batches = [rows(spark, ("a", 1, 1), ("b", 5, 1)), rows(spark, ("a", 3, 3), ("a", 2, 2)), rows(spark, ("b", 4, 9), ("c", 1, 1), ("a", 3, 4))]
    ends = set()
    for n, order in enumerate(itertools.permutations(batches)):
        if n % 2:
            continue
        table = promotion.Versioned(spark, str(tmp_path / str(n)), SCHEMA)
        for i, batch in enumerate(order):
            table.apply(batch, i, promotion.newest_by(["k"], ["at"]))
        ends.add(tuple(state(table.current())))
    assert ends == {(("a", 3, 4.0), ("b", 5, 1.0), ("c", 1, 1.0))}


def test_stream_goes_on_where_it_stopped(spark, table, tmp_path):
    source = str(tmp_path / "in")
    read = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    for at in (1, 2):
        rows(spark, ("a", at, at)).coalesce(1).write.mode("append").parquet(source)
    table.stream(read(), str(tmp_path / "c"), promotion.newest_by(["k"], ["at"])).awaitTermination()
    assert table.version()["version"] == 2
    rows(spark, ("a", 3, 3)).coalesce(1).write.mode("append").parquet(source)
    table.stream(read(), str(tmp_path / "c"), promotion.newest_by(["k"], ["at"])).awaitTermination()
    assert state(table.current()) == [("a", 3, 3.0)] and table.version()["version"] == 3
    # the same batches once more, as after a lost checkpoint: all are in the log
    table.stream(read(), str(tmp_path / "c2"), promotion.newest_by(["k"], ["at"])).awaitTermination()
    assert table.version()["version"] == 3


def test_items_fail_alone(spark):
    def assess(item):
        return {"half": 10 // item["n"]}

    batch = spark.createDataFrame([("x1", 2), ("x2", 0), ("bad", 1), (None, 1)], "id string, n int").repartition(2)
    found = {r.id: r for r in promotion.assessed(batch, F.col("id").rlike("^x[0-9]$"), assess, T.StructType([T.StructField("half", T.LongType())])).collect()}
    assert (found["x1"].outcome, found["x1"].out.half) == ("done", 5)
    assert (found["x2"].outcome, found["x2"].reason, found["x2"].out) == ("error", "ZeroDivisionError", None)
    assert found["bad"].outcome == found[None].outcome == "skipped" and found["bad"].reason == "item_malformed"
