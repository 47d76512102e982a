import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import io


def test_jsonl_round_trip_and_fail_fast(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b"), (1, None)], "k long, v string")
    io.write_jsonl(rows, str(tmp_path / "a"))
    assert sorted(io.read_jsonl(spark, str(tmp_path / "a"), rows.schema).collect(), key=lambda r: r.k) == sorted(rows.collect(), key=lambda r: r.k)
    (tmp_path / "bad.json").write_text('{"k": "no number"}\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|parse"):
        io.read_jsonl(spark, str(tmp_path / "bad.json"), T.StructType([T.StructField("k", T.LongType())])).collect()


def test_days_are_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k int, d string").select("k", F.to_date("d").alias("day"))
    io.write_day(rows, path)
    io.write_day(rows.where("k = 2").withColumn("k", F.lit(9)), path)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 9]
    assert [r.k for r in io.read_days(spark, path, "2024-01-02", "2024-01-05").collect()] == [9]
    assert [r.k for r in io.retained(spark, path, 1, "2024-01-02").collect()] == [9]


def test_manifest_refuses_a_changed_table(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    manifest = io.digest(rows).first().asDict()
    assert io.verified(rows.orderBy(F.desc("k")), manifest).count() == 2
    with pytest.raises(ValueError):
        io.verified(rows.withColumn("v", F.lit("c")), manifest)


def test_graph_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([("a", ["x", 'say "y"'])], "id string, aliases array<string>")
    edges = spark.createDataFrame([("a", "R", "b", {"k": 1})], "src string, rel string, dst string, attrs map<string,int>")
    io.write_graph(nodes, edges, str(tmp_path))
    back = io.read_graph(spark, str(tmp_path), nodes.schema, edges.schema)
    assert back[0].collect() == nodes.collect() and back[1].collect() == edges.collect()


def test_lists_and_overlay(spark):
    text = "# Tools\n\n- [A](http://a) - first\n* [B](http://b)\n## More\n- [C](http://c): third\nnone"
    got = [(r.heading, r.name, r.url, r.description) for r in io.listed(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t").orderBy("line").collect()]
    assert got == [("Tools", "A", "http://a", "first"), ("Tools", "B", "http://b", ""), ("More", "C", "http://c", "third")]
    base, over = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string"), spark.createDataFrame([(2, "B")], "k int, v string")
    assert sorted(map(tuple, io.with_overlay(base, over, "k").collect())) == [(1, "a", "x"), (2, "B", "y")]
