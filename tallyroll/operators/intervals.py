"""Join of periods that overlap, as equi-joins.

Of two periods that overlap, the later start lies in the other period. Every period
covers at most two buckets of the level that fits its length (buckets of a level are
four times as long as those of the level below), and every start asks in its bucket of
each level. So a start meets a period that holds it exactly once, a long period costs
no more rows than a short one, and each pair is reported once: by the right start if it
is the later one, else by the left start.

The join keys are (key, level, bucket): a key with a third of all rows is spread over
time, and what is left is split by adaptive skew handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.operators.keys import c

#: Levels of buckets: of 1, 4, 16, ... days; the last (4^9 days) is longer than the calendar.
LEVELS = 10


def _day(column: Column) -> Column:
    return F.datediff(column, F.lit("1970-01-01").cast("date"))


def _prepared(df: DataFrame, keys: Sequence[str], start: str, end: str, side: str) -> DataFrame:
    """Keys as `_k<n>`, the period as whole days `_s`, `_e` (NULL end: open), the row in one struct."""
    last = F.coalesce(_day(c(end)), F.lit(4 ** (LEVELS - 1) - 1))
    rows = df.select(*[c(k).alias(f"_k{n}") for n, k in enumerate(keys)], _day(c(start)).alias("_s"), last.alias("_e"), F.struct(*[c(n) for n in df.columns]).alias(f"_{side}"))
    for n in range(len(keys)):
        rows = rows.filter(F.col(f"_k{n}").isNotNull())
    return rows.filter("_s <= _e")


def _covers(rows: DataFrame, side: str) -> DataFrame:
    level = F.least(F.lit(LEVELS - 1), F.ceil(F.log2(F.col("_e") - F.col("_s") + 1) / 2)).cast("int")
    width = F.pow(F.lit(4.0), F.col("_level"))
    span = F.sequence(F.floor(F.col("_s") / width).cast("int"), F.floor(F.col("_e") / width).cast("int"))
    return rows.withColumn("_level", level).withColumn("_bucket", F.explode(span)).withColumnsRenamed({"_s": f"_s{side}", "_e": f"_e{side}"})


def _starts(rows: DataFrame, side: str) -> DataFrame:
    asked = rows.withColumn("_level", F.explode(F.array(*[F.lit(k) for k in range(LEVELS)])))
    return asked.withColumn("_bucket", F.floor(F.col("_s") / F.pow(F.lit(4.0), F.col("_level"))).cast("int")).withColumnsRenamed({"_s": f"_s{side}", "_e": f"_e{side}"})


def overlapping(
    left: DataFrame, right: DataFrame, left_on: tuple[str, str], right_on: tuple[str, str], keys: Sequence[tuple[str, str]] = (),
    left_prefix: str = "left_", right_prefix: str = "right_",
) -> DataFrame:
    """All pairs of rows whose periods (start, end; both days included) share a day, equal in the ``keys``: the columns of both sides under their prefixes, and overlap_days.

    A NULL end is open; overlap_days is NULL where both ends are. Rows with a NULL key or
    start, or an end before the start, pair with nothing; a NULL key equals no other.
    Repeated rows pair one by one. Empty sides give no rows.
    """
    a = _prepared(left, [k for k, _ in keys], *left_on, "left")
    b = _prepared(right, [k for _, k in keys], *right_on, "right")
    on = [*(f"_k{n}" for n in range(len(keys))), "_level", "_bucket"]
    by_left = _starts(a, "_l").join(_covers(b, "_r"), on).filter("_s_r <= _s_l AND _s_l <= _e_r")
    by_right = _covers(a, "_l").join(_starts(b, "_r"), on).filter("_s_l < _s_r AND _s_r <= _e_l")
    pairs = by_left.unionByName(by_right)
    shared = F.least("_e_l", "_e_r") - F.greatest("_s_l", "_s_r") + 1
    both_open = F.col("_left")[left_on[1]].isNull() & F.col("_right")[right_on[1]].isNull()
    return pairs.select(
        *[F.col("_left")[n].alias(left_prefix + n) for n in left.columns], *[F.col("_right")[n].alias(right_prefix + n) for n in right.columns],
        F.when(~both_open, shared).alias("overlap_days"))
