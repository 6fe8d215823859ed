"""Bronze ingest of page files as they land, each file exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyroll.sources.pages import BRONZE_SCHEMA, with_audit_columns


def read_landed(spark: SparkSession, folder: str, source: str, schema: StructType = BRONZE_SCHEMA, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of JSON-lines pages under the fixed schema, with audit columns."""
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    return with_audit_columns(pages, source)


def ingest_available(records: DataFrame, target: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append everything that has landed since the last run, then stop.

    The checkpoint records the files already read, so a rerun after a failure neither
    repeats nor skips a page.
    """
    return (
        records.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(target)
    )
