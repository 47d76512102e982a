"""Helpers that the operators share: reading tables, cutting lineage, and keys made from whole texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(), "longs": T.ArrayType(T.LongType())}


def fields(spec: str) -> T.StructType:
    """A schema from text like `n long, name string`; unlike a DDL string it needs no running session."""
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in (x.split() for x in spec.split(", "))])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share. Only a session in one process, as in tests, may do without: it gets a folder of its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir()


def stored(df: DataFrame, what: str) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read again: their lineage is cut, so that a lost executor costs no recomputation of what came before.

    What is written stays until the folder is cleaned, by who owns it: results are lazy, so no query knows when its last reader is done.
    """
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """stored() for narrow rows on the way. Unlike a checkpoint, a table read again carries no constraints of the plan that made it, which grow with each round of a loop."""
    return stored(df, "cut")


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def wide_hash(*columns: Column) -> Column:
    """A struct of two unlike hashes, 96 bits in all, made inside the JVM."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.hash(*columns).alias("b"))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for work that ends inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
