"""Paged records: pulled by a data source in parallel ranges, or read as landed page files.

A transport is a picklable callable ``fetch(offset, limit) -> list of dicts``. It may
return fewer records than asked for; an empty page means that there are none from that
offset on. A pull advances by what came back, has no record cap, and gives the same
rows whatever the number of tasks.
"""

from __future__ import annotations

import bisect
import json
import math
import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tallyroll import config as cfg

Fetch = Callable[[int, int], list[dict]]

# Fixed value: records asked for at once.
PAGE_LIMIT = 2000

BRONZE_SCHEMA = StructType([StructField(n, StringType()) for n in cfg.BRONZE_COLUMNS])


class PageRange(InputPartition):
    """Records from ``first`` up to ``last``; without ``last`` up to the end of the source."""

    def __init__(self, first: int, last: int | None):
        super().__init__((first, last))
        self.first, self.last = first, last


class LandedPages:
    """Fetch from page files ``<folder>/start=<offset>/...`` (JSON lines, pages of any length) on any file system that Arrow opens.

    It answers like a server that never reaches over the end of a page.
    """

    def __init__(self, folder: str):
        from pyarrow import fs

        self.folder = folder
        system, base = fs.FileSystem.from_uri(folder)
        files = [f.path for f in system.get_file_info(fs.FileSelector(base, recursive=True)) if f.is_file and f.path.endswith(".json")]
        found = sorted((int(path.rsplit("start=", 1)[1].split("/")[0]), path) for path in files)
        self.starts, self.paths = [s for s, _ in found], [p for _, p in found]

    def __call__(self, offset: int, limit: int) -> list[dict]:
        from pyarrow import fs

        page = bisect.bisect_right(self.starts, offset) - 1
        if page < 0:
            return []
        system, _ = fs.FileSystem.from_uri(self.folder)
        with system.open_input_stream(self.paths[page]) as f:
            lines = [line for line in f.read().splitlines() if line.strip()]
        first = offset - self.starts[page]
        return [json.loads(line) for line in lines[first:first + limit]]


class RestPages:
    """Fetch from a REST endpoint with $limit/$offset/$order paging."""

    def __init__(self, url: str, token: str | None = None, timeout: int = 60):
        self.url, self.token, self.timeout = url, token, timeout

    def __call__(self, offset: int, limit: int) -> list[dict]:
        from urllib.parse import urlencode
        from urllib.request import Request, urlopen

        query = urlencode({"$limit": limit, "$offset": offset, "$order": ":id"})
        headers = {"X-App-Token": self.token} if self.token else {}
        with urlopen(Request(f"{self.url}?{query}", headers=headers), timeout=self.timeout) as response:
            return json.load(response)


def count_records(fetch: Fetch) -> int:
    """How many records a source has, by single-record requests: about twice the logarithm of the answer."""
    if not fetch(0, 1):
        return 0
    low, high = 0, 1
    while fetch(high, 1):
        low, high = high, high * 2
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if fetch(middle, 1) else (low, middle)
    return high


def as_text(value: object) -> str | None:
    """A record's value as text: text as it is, everything else as JSON."""
    return value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False)


class _Reader(DataSourceReader):
    def __init__(self, fetch: Fetch, schema: StructType, page_limit: int, tasks: int):
        self.fetch, self.schema, self.page_limit, self.tasks = fetch, schema, page_limit, tasks

    def partitions(self) -> list[PageRange]:
        total = count_records(self.fetch)
        # Whole pages for each task; the last range is open, for records that arrive meanwhile.
        step = max(1, math.ceil(math.ceil(total / self.tasks) / self.page_limit)) * self.page_limit
        firsts = list(range(0, total, step)) or [0]
        return [PageRange(first, first + step if first != firsts[-1] else None) for first in firsts]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        names, offset = self.schema.fieldNames(), partition.first
        while partition.last is None or offset < partition.last:
            wanted = self.page_limit if partition.last is None else min(self.page_limit, partition.last - offset)
            records = self.fetch(offset, wanted)
            if not records:
                return
            for record in records:
                yield tuple(as_text(record.get(n)) for n in names)
            offset += len(records)


def register(spark: SparkSession, fetch: Fetch, schema: StructType = BRONZE_SCHEMA, page_limit: int = PAGE_LIMIT,
             tasks: int = 100, name: str = "paged_records") -> str:
    """Register the source under ``name``; read it with spark.read.format(name).load().

    Keys missing from a record become NULL, keys outside the schema are dropped.
    """

    class PagedRecords(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(fetch, schema, page_limit, tasks)

    # Ship the reader and the transport by value, so the executors need no copy of their modules.
    for module in {__name__, type(fetch).__module__} - {"__main__", "builtins"}:
        cloudpickle.register_pickle_by_value(sys.modules[module])
    spark.dataSource.register(PagedRecords)
    return name


def read_pages(spark: SparkSession, fetch: Fetch, **options) -> DataFrame:
    """All records of all pages, every column text."""
    return spark.read.format(register(spark, fetch, **options)).load()


def land_pages(records: DataFrame, folder: str, page: str) -> str:
    """Write records as page files ``<folder>/start=<offset>/*.json``, one page for each value of the column ``page``, in its order."""
    sizes = records.groupBy(page).agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(F.col(page).alias("_page"), (F.sum("_n").over(Window.orderBy(page)) - F.col("_n")).alias("start"))
    body = records.join(starts, F.col(page) == F.col("_page")).drop(page, "_page")
    body.repartition("start").write.partitionBy("start").json(folder)
    return folder


def read_landed_pages(spark: SparkSession, folder: str, schema: StructType = BRONZE_SCHEMA) -> DataFrame:
    """All records of a folder of page files, read by Spark; keys missing become NULL, other keys are dropped."""
    return conform_records(spark.read.text(folder, recursiveFileLookup=True, pathGlobFilter="*.json"), "value", schema)


def conform_records(df: DataFrame, json_column: str, schema: StructType = BRONZE_SCHEMA) -> DataFrame:
    """JSON text records -> the schema's columns: missing keys NULL, extra keys dropped."""
    record = F.from_json(F.col(json_column), schema)
    return df.select(record.alias("_record")).select("_record.*")


def conform_columns(df: DataFrame, schema: StructType = BRONZE_SCHEMA) -> DataFrame:
    """The same for a table: columns in schema order, absent ones NULL, others dropped."""
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def with_audit_columns(df: DataFrame, source: str, ingested_at=None) -> DataFrame:
    """Ingest time and source; a given time makes a rerun reproducible."""
    when = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast(TimestampType())
    return df.withColumns({"ingested_at": when, "source_api": F.lit(source)})
