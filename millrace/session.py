"""A session with the settings that the operators expect."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "millrace", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpointed(df):
    """df with its lineage cut: written to the folder that the session names, and read again. A table read again carries no constraints of the plan that made it, which grow with each round of a loop."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share. Only a session in one process, as in tests, may do without: it gets a folder of its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir()
