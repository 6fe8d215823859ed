"""Text tables with unknown headers: resolve columns by pattern, find header rows, drop junk rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroll import config as cfg
from tallyroll.functions.text import null_tokens, present, strip
from tallyroll.operators.keys import c

# ---------------------------------------------------------------- columns
def normalize_header(name: str | None) -> str:
    """Non-breaking spaces and line breaks become blanks, blanks collapse, ends are trimmed."""
    return re.sub(r"\s+", " ", name or "").strip()


def unique_headers(names: Sequence[str]) -> list[str]:
    """Normalized headers; a repeated or empty one gets its position, as 'Entry Date...5'."""
    clean = [normalize_header(n) for n in names]
    return [n if n and clean.count(n) == 1 else f"{n}...{i}" for i, n in enumerate(clean, 1)]


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_headers(df.columns))


def find_column(columns: Sequence[str], patterns: Sequence[str], occurrence: int = 1, exclude: str | None = None) -> str | None:
    """The n-th column matching the patterns, tried pattern by pattern, ignoring case."""
    hits: list[str] = []
    for pattern in patterns:
        for name in columns:
            if name not in hits and re.search(pattern, name, re.IGNORECASE):
                if exclude is None or not re.search(exclude, name, re.IGNORECASE):
                    hits.append(name)
    return hits[occurrence - 1] if len(hits) >= occurrence else None


def resolve_roles(columns: Sequence[str], patterns: dict[str, Sequence[str]], overrides: dict[str, str | None] | None = None) -> dict[str, str | None]:
    """role -> column name or None. Patterns over-match ('END' finds 'GENDER'): review the answer, override what is wrong."""
    overrides = overrides or {}
    return {role: overrides[role] if role in overrides else find_column(columns, p) for role, p in patterns.items()}


def widened(patterns: dict[str, Sequence[str]], wide: dict[str, Sequence[str]]) -> dict[str, list[str]]:
    """The role lists of both billing readers: headers that the first list misses are found by the wider one."""
    return {role: [*patterns.get(role, ()), *(p for p in wide.get(role, ()) if p not in patterns.get(role, ()))] for role in [*patterns, *(r for r in wide if r not in patterns)]}


def conform_to_roles(df: DataFrame, patterns: dict[str, Sequence[str]], overrides: dict[str, str | None] | None = None,
                     prefix: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """One text column per role, NULL where no header fits, plus the kept columns. Names come from the schema; no data is read."""
    roles = resolve_roles(df.columns, patterns, overrides)
    return df.select(
        *[c(k) for k in keep],
        *[(c(name).cast("string") if name else F.lit(None).cast("string")).alias(prefix + role) for role, name in roles.items()],
    )


def prepopulated_columns(columns: Sequence[str]) -> dict[str, str | None]:
    """System entry/exit/school columns already inside a roster: named ones, else the second Entry/Exit column."""
    found = resolve_roles(columns, {r: cfg.BILLING_ROSTER_PATTERNS[r] for r in ("st_entry", "st_exit", "st_school")})
    for role, patterns in cfg.PREPOPULATED_PATTERNS.items():
        found[role] = found[role] or find_column(columns, patterns, 2, cfg.PREPOPULATED_EXCLUDE)
    return found


def require(df: DataFrame, roles: dict[str, str | None], needed: Sequence[str]) -> None:
    """Fail before any work if a needed role has no column."""
    missing = [r for r in needed if roles.get(r) is None]
    if missing:
        raise ValueError(f"no column found for {missing}; headers are {df.columns}")


def with_fallback(sources: Sequence[DataFrame | None], schema: str) -> DataFrame:
    """The first source that is there; an empty table of the given schema if none is."""
    for source in sources:
        if source is not None:
            return source
    return SparkSession.getActiveSession().createDataFrame([], schema)


# ---------------------------------------------------------------- rows
def drop_blank_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with at least one value; '' is no value."""
    some = F.lit(False)
    for name in columns or df.columns:
        some = some | present(strip(c(name).cast("string")))
    return df.filter(some)


def clean_null_tokens(df: DataFrame, tokens: Sequence[str] = cfg.NULLS_ROSTER) -> DataFrame:
    """Pseudo-nulls become NULL in every text column."""
    return df.select(*[
        null_tokens(c(f.name), tokens).alias(f.name) if f.dataType.typeName() == "string" else c(f.name)
        for f in df.schema.fields
    ])


def drop_junk_rows(df: DataFrame, id_column: str, table: str, share: float = 0.5) -> DataFrame:
    """Keep rows whose ID is 6 to 12 digits, in the tables where at least ``share`` of the rows have one.

    Footers and totals go; a table that carries no IDs in that column stays whole. All
    tables are judged by one aggregation; its answer is one value, the list of labels of
    the tables to be cut, so the rows themselves are not shuffled.
    """
    valid = F.coalesce(F.regexp_replace(strip(c(id_column).cast("string")), r"\.0", "").rlike(r"^\d{6,12}$"), F.lit(False))
    label = F.to_json(F.struct(c(table).alias("t")))  # NULL is a label too
    shares = df.select(label.alias("_table"), valid.cast("int").alias("_valid")).groupBy("_table").agg(F.avg("_valid").alias("_share"))
    cut = shares.filter(F.col("_share") >= share).agg(F.collect_list("_table")).scalar()
    return df.filter(valid | ~F.array_contains(cut, label))


def filter_export_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Export rows with at least one identifying value."""
    return drop_blank_rows(df, columns)


# ---------------------------------------------------------------- header rows of landed files
def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line) of landed text files, which Spark splits as it does any text.

    A line's place in its split comes from the order in which a task reads; splits of a
    file are put one after the other by the number of lines before them.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"))
    blocks = raw.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = F.sum("_lines").over(Window.partitionBy("file").orderBy("_block")) - F.col("_lines")
    places = blocks.select(F.col("file").alias("_file"), F.col("_block").alias("_at"), "_first", before.alias("_before"))
    joined = raw.join(places, (F.col("file") == F.col("_file")) & (F.col("_block") == F.col("_at")))
    return joined.select("file", (F.col("_before") + F.col("_id") - F.col("_first")).cast("int").alias("pos"), "line")


def with_cells(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """Split each line into trimmed cells. A cell in double quotes may hold delimiters, and quotes written twice."""
    d = re.escape(delimiter)
    # Every match starts at a delimiter: a quoted cell up to the next one, or all up to the next one.
    pattern = rf'{d}(?:[ \t]*"([^"]*+(?:""[^"]*+)*+)"[ \t]*(?={d}|$)|([^{d}]*))'
    line = F.concat(F.lit(delimiter), "line")
    quoted, bare = (F.regexp_extract_all(line, F.lit(pattern), F.lit(k)) for k in (1, 2))
    cell = lambda q, b: strip(F.when(b == "", F.replace(q, F.lit('""'), F.lit('"'))).otherwise(b))
    plain = F.transform(F.split("line", "\\Q" + delimiter + "\\E", -1), lambda x: strip(x))
    return lines.withColumn("cells", F.when(F.contains("line", F.lit('"')), F.zip_with(quoted, bare, cell)).otherwise(plain))


def header_rows(lines: DataFrame) -> DataFrame:
    """(file, header_pos): where the header of each file is; -1 for a file without a value.

    The first row that has a value, wherever it is; one row further if that row is a
    title (at most two values, and the next row has four or more); two rows further if
    its first cell, or that of the next row, is a color legend, or if the row below
    has fewer than three values and two rows further there are three or more.
    """
    filled = F.size(F.filter("cells", lambda x: x != ""))
    # One number for each file, aggregated where the lines are read; then three lines for each file. Only these, and lines
    # with quotes, are cut into cells: any other line has a value if more than delimiters and blanks is in it.
    some = F.when(F.contains("line", F.lit('"')), filled > 0).otherwise(F.translate("line", cfg.WHITE_SPACE + ",", "") != "")
    starts = with_cells(lines).groupBy("file").agg(F.min(F.when(some, F.col("pos"))).alias("start"))
    near = lines.join(starts.withColumnRenamed("file", "_file"), (F.col("file") == F.col("_file")) & (F.col("pos") >= F.col("start")) & (F.col("pos") <= F.col("start") + 2))
    near = with_cells(near).select("file", "pos", "start", filled.alias("filled"), F.get("cells", F.lit(0)).alias("first"))
    at = lambda k, name: F.max(F.when(F.col("pos") == F.col("start") + k, F.col(name)))
    seen = near.groupBy("file").agg(*[at(k, n).alias(f"{n}_{k}") for k in range(3) for n in ("filled", "first")])
    legend = lambda k: F.coalesce(F.upper(F.col(f"first_{k}")).rlike("COLOR.*KEY"), F.lit(False))
    title = (F.col("filled_0") <= 2) & F.coalesce(F.col("filled_1") >= 4, F.lit(False))
    third = F.coalesce((F.col("filled_1") < 3) & (F.col("filled_2") >= 3), F.lit(False))
    skip = F.when(legend(0) | legend(1), 2).when(title, 1).when(third, 2).otherwise(0)
    judged = seen.select(F.col("file").alias("_file"), skip.alias("skip"))
    return starts.join(judged, F.col("file") == F.col("_file"), "left").select("file", F.coalesce(F.col("start") + F.col("skip"), F.lit(-1)).cast("int").alias("header_pos"))


def table_rows(lines: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """(file, pos, header, cells): the non-blank rows below each file's header, with the header's cells alongside."""
    found = (headers if headers is not None else header_rows(lines)).withColumnRenamed("file", "_file")
    body = with_cells(lines.join(found, F.col("file") == F.col("_file")).filter("pos >= header_pos").drop("_file"))
    names = body.filter("pos = header_pos").select(F.col("file").alias("_file"), F.col("cells").alias("header"))
    rows = body.filter("pos > header_pos").filter(F.exists("cells", lambda x: x != ""))
    return rows.join(names, F.col("file") == F.col("_file")).select("file", "pos", "header", "cells")


def select_by_header(rows: DataFrame, patterns: dict[str, Sequence[str]]) -> DataFrame:
    """Role columns out of rows that carry their own header: files with different layouts become one table.

    Same order as find_column: the first pattern that fits any header, then the first such header.
    """
    def first_match(pattern: str) -> Column:
        """1-based position of the first header that matches, NULL if none does."""
        position = F.array_position(F.transform("header", lambda h: h.rlike("(?i)" + pattern)), True)
        return F.when(position > 0, position.cast("int"))

    spots = {role: F.coalesce(*[first_match(p) for p in alternatives]) for role, alternatives in patterns.items()}
    # Positions are worked out once per header, not once per row.
    headers = rows.select("file", "header").distinct().select(
        F.col("file").alias("_file"), *[spot.alias(f"_{role}") for role, spot in spots.items()])
    cell = lambda role: F.nullif(F.get("cells", F.col(f"_{role}") - 1), F.lit(""))
    return rows.join(headers, F.col("file") == F.col("_file")).select("file", "pos", *[cell(role).alias(role) for role in patterns])


def folder_of(path: Column) -> Column:
    """The path of a file without its name."""
    return F.regexp_replace(path, "/[^/]*$", "")


def newest_snapshot(df: DataFrame, modified: str = "file_modification_time", delivery: str | None = None) -> DataFrame:
    """Rows of the most recently modified file; the newest time is one value.

    With ``delivery`` (the column that names a row's delivery, see folder_of) all rows of
    the delivery that holds that file: several tasks write the files of one at different times.
    """
    if delivery is not None:
        newest = df.agg(F.max_by(c(delivery), F.struct(c(modified), c(delivery))).alias("_newest"))
        return df.join(newest, c(delivery) == F.col("_newest")).drop("_newest")
    newest = df.agg(F.max(c(modified)).alias("_newest"))
    return df.join(newest, c(modified) == F.col("_newest")).drop("_newest")


def read_newest_file(spark: SparkSession, folder: str, schema: str | None = None, pattern: str = "*.csv", in_folders: bool = False) -> DataFrame:
    """Newest file of a folder, all columns text. Times come from the listing; older files are never opened.

    With ``in_folders`` each delivery is a folder below, whose files several tasks wrote:
    all files of the folder that holds the newest one are read.
    """
    if in_folders:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
        newest = files.agg(F.max_by(folder_of(F.col("path")), F.struct("modificationTime", "path"))).first()[0]
        if newest is None:
            raise ValueError(f"no {pattern} below {folder}")
        reader = spark.read.option("header", True).option("pathGlobFilter", pattern).option("inferSchema", False)
        return (reader.schema(schema) if schema else reader).csv(newest)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).agg(F.max("modificationTime"))
    newest = listed.first()[0]
    reader = spark.read.option("header", True).option("pathGlobFilter", pattern).option("inferSchema", False)
    if newest is None:
        raise ValueError(f"no {pattern} in {folder}")
    df = (reader.schema(schema) if schema else reader).csv(folder)
    return df.filter(F.col("_metadata.file_modification_time") == F.lit(newest)).select(*df.columns)


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """A roster as text columns with normalized headers."""
    return normalize_headers(spark.read.option("header", True).option("inferSchema", False).csv(path))
