"""Writing: full-refresh tables, sorted tables, report sets, and the check after the write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.operators.keys import c


def write_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Replace a catalog table, schema included. Running it twice gives the same table."""
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def sorted_for_write(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Globally ordered output files without a single sorting task: range shuffle, then sort inside each part."""
    return df.repartitionByRange(*[c(o) for o in order]).sortWithinPartitions(*[c(o) for o in order])


def write_report(tabs: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """One directory per tab; returns tab -> path."""
    paths = {tab: f"{folder.rstrip('/')}/{tab.replace(' ', '_')}" for tab in tabs}
    for tab, df in tabs.items():
        safe = df.toDF(*[n.translate(str.maketrans(" ,;{}()\n\t=>#", "____________")) for n in df.columns])
        safe.write.format(fmt).mode("overwrite").save(paths[tab])
    return paths


def require_rows(df: DataFrame) -> DataFrame:
    """Raise on an empty source (reads until the first row)."""
    if df.isEmpty():
        raise ValueError("the source has no records")
    return df


def row_counts(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """One row per table: its name and its number of rows."""
    return table_counts({t: spark.table(t) for t in tables})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result
