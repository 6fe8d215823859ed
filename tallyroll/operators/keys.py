"""Keyed lookups: text-key left joins, first/latest row per key, membership flags.

Two rules hold throughout. NULL never matches: rows without a key stay in the
result but are spread over the shuffle instead of meeting in one task. And no
side is broadcast by hint: adaptive execution broadcasts what it has measured to
be small and splits what it has measured to be skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.functions.text import strip_decimal_zero

# Number of shuffle targets for rows without a key.
NULL_SPREAD = 4096


def c(name: str) -> Column:
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def spread_key(key: Column, *identity: Column) -> Column:
    """The key as text; where it is NULL, one of many texts no real key can equal."""
    filler = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*identity), F.lit(NULL_SPREAD)).cast("string"))
    return F.coalesce(key.cast("string"), filler)


def left_on_key(left: DataFrame, right: DataFrame, left_key: Column, right_key: str, identity: Sequence[str]) -> DataFrame:
    """LEFT join on one text key. ``right_key`` is dropped from the result.

    ``identity`` names columns that vary from row to row; they only decide where a
    row without a key is computed.
    """
    return left_on_same_key(left, [right], left_key, right_key, identity)


def left_on_same_key(left: DataFrame, rights: Sequence[DataFrame], left_key: Column, right_key: str, identity: Sequence[str]) -> DataFrame:
    """LEFT join of several tables on the same key of the left side, which is shuffled once for all of them."""
    joined = left.withColumn("_left_key", spread_key(left_key, *[c(i) for i in identity]))
    for i, right in enumerate(rights):
        side = right.filter(c(right_key).isNotNull()).withColumnRenamed(right_key, f"_right_key_{i}")
        joined = joined.join(side, F.col("_left_key") == F.col(f"_right_key_{i}"), "left").drop(f"_right_key_{i}")
    return joined.drop("_left_key")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given total order. Rows with a NULL key part are dropped.

    The filter on row_number lets Spark keep one candidate per key and map task, so
    a hot key never travels whole.
    """
    known = df
    for k in keys:
        known = known.filter(c(k).isNotNull())
    window = W.partitionBy(*[c(k) for k in keys]).orderBy(*order)
    return known.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], day: str, ordinal: str) -> DataFrame:
    """One row per key with the latest day; unknown days last, ties by ingest order."""
    return first_per_key(df, keys, [c(day).desc_nulls_last(), c(ordinal).asc()])


def latest_with_count(df: DataFrame, key: str, day: str, ordinal: str, count_name: str = "enrollment_count") -> DataFrame:
    """latest_per_key plus the number of rows of the key, in one aggregation and one shuffle."""
    payload = [n for n in df.columns if n != key]
    row = F.struct(*[c(n) for n in payload])
    rank = F.struct(c(day), -c(ordinal))
    grouped = df.filter(c(key).isNotNull()).groupBy(c(key)).agg(
        F.max_by(row, rank).alias("_row"), F.count(F.lit(1)).alias(count_name)
    )
    return grouped.select(c(key), *[F.col("_row")[n].alias(n) for n in payload], count_name)


def distinct_keys(df: DataFrame, key: Column, name: str) -> DataFrame:
    """The non-NULL keys of a table, once each."""
    return df.select(key.alias(name)).filter(c(name).isNotNull()).distinct()


def flag_members(df: DataFrame, key: Column, keys: DataFrame, flag: str, identity: Sequence[str]) -> DataFrame:
    """Add a boolean: does the key occur in the one-column table ``keys``? A semi join that keeps every row."""
    name = keys.columns[0]
    marked = distinct_keys(keys, c(name), "_member").withColumn(flag, F.lit(True))
    return left_on_key(df, marked, key, "_member", identity).withColumn(flag, F.coalesce(c(flag), F.lit(False)))


def with_enrollment_count(df: DataFrame, key: str, other: DataFrame, other_key: Column, identity: Sequence[str]) -> DataFrame:
    """Number of rows of ``other`` per key, and the label shown for more than one."""
    counts = (
        other.select(other_key.alias("_k")).filter("_k is not null").groupBy("_k")
        .agg(F.count(F.lit(1)).alias("enrollment_count"))
    )
    return left_on_key(df, counts, c(key), "_k", identity).withColumn(
        "multiple_enrollments", enrollment_label(F.col("enrollment_count"))
    )


def enrollment_label(count: Column) -> Column:
    """'3 ENROLLMENTS' above one, '' otherwise."""
    return F.when(count > 1, F.concat(count.cast("string"), F.lit(" ENROLLMENTS"))).otherwise("")


def sped_keys(
    sped: DataFrame, sped_nyssis: str | None, sped_student_id: str | None,
    xref: DataFrame | None = None, ordinal: str | None = None,
) -> DataFrame:
    """Special-education roster with its join key ``sped_key``.

    The state ID itself where the roster has one, else the student ID translated by
    ``xref`` (student_id, nyssis), else the student ID as it is.
    """
    if sped_nyssis is not None:
        return sped.withColumn("sped_key", strip_decimal_zero(c(sped_nyssis)))
    if sped_student_id is None or xref is None:
        return sped.withColumn("sped_key", F.lit(None).cast("string"))
    keyed = sped.withColumn("_sid", strip_decimal_zero(c(sped_student_id)))
    bridge = xref.select(F.col("student_id").alias("_xref_sid"), F.col("nyssis").alias("_xref_nyssis"))
    joined = left_on_key(keyed, bridge, F.col("_sid"), "_xref_sid", [ordinal or sped_student_id])
    return joined.withColumn("sped_key", F.coalesce("_xref_nyssis", "_sid")).drop("_sid", "_xref_nyssis")


def id_xref(st: DataFrame, student_id: str, nyssis: str, order: Sequence[Column]) -> DataFrame:
    """(student_id, nyssis): the first row of every non-blank student ID."""
    named = st.filter(F.trim(c(student_id)) != "")
    first = first_per_key(named, [student_id], order)
    return first.select(c(student_id).alias("student_id"), c(nyssis).alias("nyssis"))


def fill_by_composite(
    df: DataFrame, lookup: DataFrame, names: dict[str, str], identity: Sequence[str], order: Sequence[Column] | None = None,
) -> DataFrame:
    """LEFT join on first name, last name (upper/trimmed), birth date and grade.

    ``names`` maps each lookup column to carry over to its new name. With ``order``
    the lookup is cut to its first row per composite key, otherwise every match counts.
    """
    def parts(prefix: str) -> dict[str, Column]:
        return {
            f"{prefix}f": F.upper(F.trim("first_name")), f"{prefix}l": F.upper(F.trim("last_name")),
            f"{prefix}d": F.col("dob").cast("string").try_cast("date").cast("string"), f"{prefix}g": F.col("grade").cast("string"),
        }

    side = lookup.withColumns(parts("_r"))
    keys = ["_rf", "_rl", "_rd", "_rg"]
    if order is not None:
        side = first_per_key(side, keys, order)
    side = side.dropna(subset=keys).select(*keys, *[c(n).alias(new) for n, new in names.items()])
    left = df.withColumns(parts("_l"))
    known = F.col("_lf").isNotNull() & F.col("_ll").isNotNull() & F.col("_ld").isNotNull() & F.col("_lg").isNotNull()
    left = left.withColumn("_lf", spread_key(F.when(known, F.col("_lf")), *[c(i) for i in identity]))
    on = [F.col(f"_l{x}") == F.col(f"_r{x}") for x in "fldg"]
    return left.join(side, on, "left").drop(*keys, "_lf", "_ll", "_ld", "_lg")
