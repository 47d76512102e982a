"""Scans and sinks: JSON lines, dated partitions, manifests, graph tables as CSV, lists in Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One object a line, by an explicit schema; a line that does not fit it fails the read. Blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    """Keys in sorted order."""
    rows.select(*sorted(rows.columns)).write.mode("overwrite").json(path)


def write_day(rows: DataFrame, path: str, day: str = "day") -> None:
    """Only the days among the rows are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def read_days(spark: SparkSession, path: str, first: str, last: str, day: str = "day") -> DataFrame:
    """Days are folders, so other days are not read."""
    return spark.read.parquet(path).where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def retained(spark: SparkSession, path: str, keep_days: int, today: str, day: str = "day") -> DataFrame:
    return spark.read.parquet(path).where(F.col(day) > F.date_sub(F.lit(today).cast("date"), keep_days))


def digest(rows: DataFrame) -> DataFrame:
    """n_rows and a hash of all rows that does not depend on their order: sums of two unlike hashes of each row."""
    row = [F.xxhash64(*rows.columns), F.xxhash64(F.lit("salt"), *rows.columns)]
    sums = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(h.cast("decimal(38,0)")).alias(f"s{i}") for i, h in enumerate(row)])
    return sums.select("n_rows", F.sha2(F.concat_ws("|", "n_rows", "s0", "s1"), 256).alias("digest"))


def verified(rows: DataFrame, manifest: dict) -> DataFrame:
    """rows, if their count and digest are those of the manifest; an error otherwise."""
    found = digest(rows).first().asDict()
    if any(found[k] != manifest[k] for k in found):
        raise ValueError(f"the table is not the one of its manifest: {found} is not {manifest}")
    return rows


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Two CSV tables; nested columns become JSON."""
    for name, rows in (("nodes", nodes), ("edges", edges)):
        flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name) for f in rows.schema]
        rows.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", "\\N").csv(f"{path}/{name}")


def read_graph(spark: SparkSession, path: str, nodes: T.StructType, edges: T.StructType) -> tuple[DataFrame, DataFrame]:
    def one(name: str, schema: T.StructType) -> DataFrame:
        nested = (T.ArrayType, T.MapType, T.StructType)
        flat = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType) for f in schema])
        rows = spark.read.schema(flat).option("header", True).option("escape", '"').option("nullValue", "\\N").csv(f"{path}/{name}")
        return rows.select(*[F.from_json(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in schema])

    return one("nodes", nodes), one("edges", edges)


def listed(texts: DataFrame, id: str, text: str) -> DataFrame:
    """Entries `- [name](url) - description` of Markdown lists, with the heading that they stand below. Lines are numbered, and the heading is carried forward in each document."""
    lines = texts.select(id, F.posexplode(F.split(text, "\n")).alias("line", "said"))
    heading = F.last(F.when(F.col("said").rlike("^#+ "), F.regexp_replace("said", "^#+ +", "")), ignorenulls=True).over(Window.partitionBy(id).orderBy("line"))
    entry = r"^\s*[-*] \[([^\]]+)\]\(([^)\s]+)\)(?:\s*[-–—:]\s*(.*))?$"
    found = lines.withColumn("heading", heading).where(F.col("said").rlike(entry))
    return found.select(id, "line", "heading", F.regexp_extract("said", entry, 1).alias("name"), F.regexp_extract("said", entry, 2).alias("url"), F.regexp_extract("said", entry, 3).alias("description"))


def with_overlay(base: DataFrame, overlay: DataFrame, key: str) -> DataFrame:
    """base, each value replaced by the overlay's where that has one."""
    over = overlay.select(key, *[F.col(c).alias(f"_{c}") for c in overlay.columns if c != key])
    return base.join(over, key, "left").select(key, *[F.coalesce(f"_{c}", c).alias(c) if f"_{c}" in over.columns else F.col(c) for c in base.columns if c != key])
