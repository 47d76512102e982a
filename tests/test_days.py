"""Snapshots by day: damage is named and gives no rows, other days are not opened."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import days

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    rows = spark.range(60).select(F.date_add(F.lit("2024-02-27").cast("date"), (F.col("id") % 4).cast("int")).alias("day"), F.col("id").alias("k"), F.concat(F.lit('é "q"\n'), "id").alias("t"))
    days.write(rows, path, rows_of_file=10)
    return path


def files_of(folder, day):
    return sorted(glob.glob(f"{folder}/data/day={day}/*.json"))


def test_round_trip_and_range(spark, folder):
    whole = days.read(spark, folder, SCHEMA, check_first=True)
    assert sorted(r.k for r in whole.collect()) == list(range(60)) and whole.where("k = 7").first().t == 'é "q"\n7'
    some = days.read(spark, folder, SCHEMA, "2024-02-28", "2024-02-29")
    assert {str(r.day) for r in some.collect()} == {"2024-02-28", "2024-02-29"} and some.count() == 30
    assert len(files_of(folder, "2024-02-28")) == 2
    assert days.audit(spark, folder).where("problem is not null").count() == 0


def test_a_damaged_day_fails_and_others_are_not_opened(spark, folder):
    bad = files_of(folder, "2024-02-29")[0]
    text = open(bad, encoding="utf-8").read()
    open(bad, "w", encoding="utf-8").write(text.replace('"k":2,', '"k":3,'))
    os.remove(os.path.join(os.path.dirname(bad), f".{os.path.basename(bad)}.crc"))
    found = {r.name: r.problem for r in days.audit(spark, folder).where("problem is not null").collect()}
    assert found == {os.path.basename(bad): "other content"}
    with pytest.raises(days.Damaged, match="2024-02-29.*other content"):
        days.read(spark, folder, SCHEMA, check_first=True)
    with pytest.raises(Exception, match="2024-02-29.*other content"):
        days.read(spark, folder, SCHEMA).collect()
    for name in files_of(folder, "2024-02-29"):
        os.chmod(name, 0)  # not readable at all: the range is pruned before files are opened
    some = days.read(spark, folder, SCHEMA, "2024-02-27", "2024-02-28")
    assert some.count() == 30
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()


def test_lost_and_unknown_files(spark, folder):
    gone = files_of(folder, "2024-03-01")[0]
    os.rename(gone, gone.replace("part-", "other-"))
    problems = sorted(r.problem for r in days.audit(spark, folder, "2024-03-01").where("problem is not null").collect())
    assert problems == ["missing", "not in the manifest"]
    with pytest.raises(days.Damaged, match="missing"):
        days.read(spark, folder, SCHEMA, check_first=True)
