"""Session settings the operators count on. Only runtime SQL settings; safe to call on any session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Parsed dates and printed dates must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins that share one shuffle are split too when a key is hot, at the price of one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods beyond 8000 bytes, so stages of many text rules would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to the session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """The folder all executors can reach: the given one, else spark.checkpoint.dir. Without either there is none."""
    found = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        raise ValueError("spark.checkpoint.dir is not set and no folder was given")
    return found.rstrip("/")


def cut_lineage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the table below the shared folder and go on from its files.

    For a table that several later steps read: it is computed once, survives the loss of
    an executor, and later steps read only the columns they need.
    """
    return df.sparkSession.read.schema(df.schema).parquet(cut_path(df, folder))


def cut_path(df: DataFrame, folder: str | None = None) -> str:
    """Write the table below the shared folder; returns its path."""
    path = f"{shared_folder(df.sparkSession, folder)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path
