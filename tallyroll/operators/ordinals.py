"""Numbers and running totals along a global order, without one task that sees all rows.

A window without partition sends every row to one task. Here rows are sorted by range
partitions and written; a row's place is its place in its file plus the number of rows
in the files before. What reaches the driver is one line for each written file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.operators.keys import c
from tallyroll.session import cut_path


def _read_numbered(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of written files with `_file` (number of the file in the order of writing) and `_row` (place in it, from 0)."""
    name = F.col("_metadata.file_name")
    # part-<task>-<uuid>.c<part of the task>.<format>: both numbers grow beyond their padding.
    task, part = (F.regexp_extract(name, p, 1).cast("long") for p in (r"^part-(\d+)", r"c(\d+)\."))
    read = spark.read.schema(schema).parquet(path)
    return read.select(*[c(n) for n in read.columns], (task * 1_000_000 + part).alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _before(spark: SparkSession, per_file: list[tuple], empty) -> DataFrame:
    """(_of, _before): the sum of all earlier files' figures, for each file."""
    rows, total = [], empty
    for file, value in sorted(per_file):
        rows.append((file, total))
        total = total + (value if value is not None else 0)
    return spark.createDataFrame(rows, f"_of long, _before {'long' if isinstance(empty, int) else 'double'}")


def number_sorted(df: DataFrame, name: str = "place", folder: str | None = None) -> DataFrame:
    """The rows of a sorted table (the last operation is its sort) with their place from 1.

    The table is written below the shared folder once. An empty table stays empty;
    columns named `_file` or `_row` must not exist.
    """
    path = cut_path(df, folder)
    rows = _read_numbered(df.sparkSession, path, df.schema)
    counts = [(r[0], r[1]) for r in rows.groupBy("_file").count().collect()]  # one row for each file
    before = _before(df.sparkSession, counts, 0)
    # The list of files has as many rows as tasks wrote, so it may be broadcast.
    return rows.join(F.broadcast(before), F.col("_file") == F.col("_of")).withColumn(name, F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_of", "_before")


def _sorted_evenly(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sorted by ranges. Rows that tie are split by their place in the input, so a value that a third of all rows share fills many ranges."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    return tied.repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order, "_tie").drop("_tie")


def with_ordinals(df: DataFrame, order: Sequence[Column], name: str = "place", folder: str | None = None) -> DataFrame:
    """row_number over the whole table in this order, from 1. Rows that tie come in the order of the input. NULLs stand where ``order`` puts them."""
    return number_sorted(_sorted_evenly(df, order), name, folder)


def with_running_total(df: DataFrame, order: Sequence[Column], value: str, name: str = "running_total", folder: str | None = None) -> DataFrame:
    """The sum of ``value`` over the row and all before it in this order; NULLs add nothing. Longs stay exact; other numbers are summed as doubles."""
    whole = df.schema[value].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    kind = "long" if whole else "double"
    path = cut_path(_sorted_evenly(df, order), folder)
    rows = _read_numbered(df.sparkSession, path, df.schema).withColumn("_value", F.coalesce(c(value).cast(kind), F.lit(0).cast(kind)))
    sums = [(r[0], r[1]) for r in rows.groupBy("_file").agg(F.sum("_value")).collect()]  # one row for each file
    before = _before(df.sparkSession, sums, 0 if whole else 0.0)
    inside = F.sum("_value").over(W.partitionBy("_file").orderBy("_row"))  # a file holds one range
    return rows.withColumn("_inside", inside).join(F.broadcast(before), F.col("_file") == F.col("_of")).withColumn(
        name, F.col("_before") + F.col("_inside")).drop("_file", "_row", "_value", "_inside", "_of", "_before")
