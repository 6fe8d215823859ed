"""Helpers of the text operators: the shared folder, written stages, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def working_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors reach: spark.checkpoint.dir of the session.

    Where the setting is absent and Spark runs in one process (tests), a temporary
    folder takes its place; on a cluster its absence is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _OWN.setdefault("folder", "file://" + tempfile.mkdtemp(prefix="tallyroll-"))


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the working folder."""
    return f"{working_folder(spark)}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the working folder and go on from its files.

    It is computed once, survives lost executors, and its size is known to the
    planner, which broadcasts it only below the session's threshold.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """The column's texts; null is the empty text."""
    return [x if x is not None else "" for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """The column's texts in UTF-8; null is the empty text."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return [x if x is not None else b"" for x in column.cast(pa.large_binary() if large else pa.binary()).to_pylist()]


def by_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow: `make` builds the worker's state, its result turns one batch into another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            if batch.num_rows:
                yield one(batch)
    return run
