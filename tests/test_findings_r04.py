"""Cases of the findings of round 4."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.operators import similarity
from millrace.queries import ORACLE_SQL, QUERIES


def test_jumps_do_not_hang_on_the_order_of_rows(spark, tmp_path):
    at = lambda day: datetime.datetime(2024, 1, day, 12)
    # a step of just 100 if the day's values are added in the order of the events, and just under it otherwise
    rows = [(1, at(1), 7, "view", 0.0), (2, at(2), 7, "view", 0.38), (3, at(2), 7, "click", 0.38), (4, at(2), 7, "view", 99.24), (5, at(3), 7, "view", 90.0)]
    rows += [(6, at(1), None, "view", 1.0), (7, at(2), None, "view", 500.0), (8, None, 8, "view", 900.0), (9, at(1), 8, "view", 1.0), (10, at(2), 8, "view", None)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").withColumn("props", F.lit("{}"))
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    con.execute("set threads = 1")
    found = []
    for name, order in (("rising", "event_id"), ("falling", "event_id desc")):
        events.coalesce(1).sortWithinPartitions(F.expr(order.split()[0]).desc() if "desc" in order else "event_id").write.parquet(f"{tmp_path}/{name}/events.parquet")
        found.append(sorted(map(tuple, QUERIES["jump_scan"](spark, f"{tmp_path}/{name}").collect()), key=repr))
    con.execute(f"create view events as select * from '{tmp_path}/rising/events.parquet/*.parquet'")
    want = sorted(con.execute(ORACLE_SQL["jump_scan"]).fetchall(), key=repr)
    assert found[0] == found[1] == want and (7, "2024-01-02", 100.0, 0.9, "confirmed") in want


def planned(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("block", "vocabulary", "piece"), [(2_000_000, 500_000, 500_000), (700, 40, 50)])
def test_pairs_of_texts_are_not_shuffled(spark, tmp_path, monkeypatch, block, vocabulary, piece):
    for name, value in {"BLOCK": block, "VOCABULARY": vocabulary, "PIECE": piece, "CELLS": piece, "ROWS": 16}.items():
        monkeypatch.setattr(similarity, name, value)
    # groups of near copies among texts that share a word or two, some without words; more than 30 candidates for many
    word = lambda i, j: f"w{(i * 7 + j * j * 3) % 90}x" if j % 3 else f"g{i % 40}y{j}"
    texts = [(i, " ".join(word(i, j) for j in range(5 + i % 23)) + f" own{i}z") for i in range(300)] + [(300, ""), (301, None), (302, "common alone")]
    texts += [(1000 + i, f"common text {i % 3} " * 2 + f"pair{i // 2}q both{i // 2}q") for i in range(300)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = QUERIES["similar_pairs"](spark, str(tmp_path))
    assert "Join" not in planned(found)
    want = sorted(con.execute(ORACLE_SQL["similar_pairs"]).fetchall())
    assert sorted(map(tuple, found.select("a", "b", "cosine").collect())) == want and len(want) > 300
