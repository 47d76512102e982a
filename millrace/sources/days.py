"""Dated snapshots of JSON lines that are checked on reading: a manifest holds each file's day, name, hash and number of lines, and no row of a file that is not the recorded one is ever given.

Days are folders, so that days outside the wanted range are not opened. A file is read once: the bytes that were hashed are the bytes that are parsed. It is one row while that happens, so files are written with a
bounded number of rows (`rows_of_file`). Any store that Spark reads will do.

Defined results: a file whose hash or number of lines differs, one that the manifest does not know, and one that it has and that is gone are named, in audit() as rows and in read() as an error; blank lines count as none;
a day without files is no error unless the manifest has some.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "day date, name string, sha256 string, n_lines long"


class Damaged(Exception):
    """Files that are not what their manifest says."""


def name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def lines(content: Column) -> Column:
    return F.filter(F.split(content.cast("string"), "\n"), lambda x: F.btrim(x) != "")


def files(spark: SparkSession, folder: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """day, name, content of the snapshot's files, of a range of days."""
    found = spark.read.format("binaryFile").option("basePath", f"{folder}/data").option("pathGlobFilter", "*.json").load(f"{folder}/data")
    found = found.where(F.col("day") >= F.lit(first).cast("date")) if first else found
    found = found.where(F.col("day") <= F.lit(last).cast("date")) if last else found
    return found.select(F.col("day").cast("date").alias("day"), name_of(F.col("path")).alias("name"), "content")


def manifest(spark: SparkSession, folder: str, first: str | None = None, last: str | None = None) -> DataFrame:
    known = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    known = known.where(F.col("day") >= F.lit(first).cast("date")) if first else known
    return known.where(F.col("day") <= F.lit(last).cast("date")) if last else known


def write(rows: DataFrame, folder: str, day: str = "day", rows_of_file: int = 100_000) -> None:
    """A snapshot and its manifest, which is written last: one that has none is not complete."""
    rows.withColumnRenamed(day, "day").repartition("day").write.option("maxRecordsPerFile", rows_of_file).partitionBy("day").json(f"{folder}/data")
    held = files(rows.sparkSession, folder)
    held.select("day", "name", F.sha2("content", 256).alias("sha256"), F.size(lines(F.col("content"))).cast("long").alias("n_lines")).write.parquet(f"{folder}/manifest")


def held_against(spark: SparkSession, folder: str, first: str | None, last: str | None) -> DataFrame:
    """day, name, content, problem (null for a file that is as recorded)."""
    known = manifest(spark, folder, first, last)
    both = files(spark, folder, first, last).withColumn("there", F.lit(True)).join(known.select("day", "name", F.col("sha256").alias("was"), F.col("n_lines").alias("n")), ["day", "name"], "full_outer")
    problem = (
        F.when(F.col("there").isNull(), "missing").when(F.col("was").isNull(), "not in the manifest").when(F.sha2("content", 256) != F.col("was"), "other content")
        .when(F.size(lines(F.col("content"))) != F.col("n"), "other number of lines")
    )
    return both.withColumn("problem", problem)


def audit(spark: SparkSession, folder: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """day, name, problem: of each file in the range, null where it is as recorded."""
    return held_against(spark, folder, first, last).select("day", "name", "problem")


def read(spark: SparkSession, folder: str, schema: T.StructType, first: str | None = None, last: str | None = None, check_first: bool = False) -> DataFrame:
    """day and the schema's columns. The query that reads a damaged file fails and names it; with check_first nothing is given before all files of the range are found to be as recorded (Damaged names some that are not)."""
    if check_first and (bad := audit(spark, folder, first, last).where("problem is not null").orderBy("day", "name").limit(20).collect()):
        raise Damaged("; ".join(f"{r['day']}/{r['name']}: {r['problem']}" for r in bad))
    held = held_against(spark, folder, first, last)
    said = F.concat(F.col("day").cast("string"), F.lit("/"), F.col("name"), F.lit(": "), F.col("problem"))
    safe = F.when(F.col("problem").isNotNull(), F.raise_error(said).cast("binary")).otherwise(F.col("content"))
    rows = held.select("day", F.explode(lines(safe)).alias("line"))
    return rows.select("day", F.from_json("line", schema, {"mode": "FAILFAST"}).alias("x")).select("day", "x.*")
