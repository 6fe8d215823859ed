"""States that run along time within a key, also where one key holds a third of all rows.

A window per key runs in one task per key. Here a key's rows are cut into blocks of
time. Inside a block a window carries the state on; each block's end state is one row;
a window over these rows, one per key and block, hands the state to later blocks.
Callers first bring the rows to one per key and point of time, so a block of dates
holds as many rows as it has days, however many rows share them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.operators.keys import c, spread_key

#: Days of a block.
BLOCK_DAYS = 32


def block_of(time: Column, days: int = BLOCK_DAYS) -> Column:
    """The number of the block that a date or a timestamp lies in."""
    return F.floor(F.datediff(time, F.lit("1970-01-01").cast("date")) / days)


def running(rows: DataFrame, by: Sequence[str], block: str, order: Sequence[str], value: str, name: str, how: str, own: bool) -> DataFrame:
    """Add the state before each row (with ``own``: after it): the ``max`` or the ``last`` non-NULL value of ``value``.

    Rows are ordered by (block, order) within ``by``; the order must be total, and no
    column of ``by`` may be NULL.
    """
    keys = [c(b) for b in by]
    inside = W.partitionBy(*keys, c(block)).orderBy(*[c(o) for o in order]).rowsBetween(W.unboundedPreceding, 0 if own else -1)
    along = W.partitionBy(*[F.col(f"_c{b}") for b in by]).orderBy("_cblock").rowsBetween(W.unboundedPreceding, -1)
    if how == "max":
        local, end = F.max(c(value)).over(inside), F.max(c(value))
        carry = F.max("_end").over(along)
    else:
        local, end = F.last(c(value), ignorenulls=True).over(inside), F.max_by(F.struct(c(value).alias("v")), F.when(c(value).isNotNull(), F.struct(*[c(o) for o in order])))["v"]
        carry = F.last("_end", ignorenulls=True).over(along)
    ends = rows.groupBy(*keys, c(block)).agg(end.alias("_end")).select(*[c(b).alias(f"_c{b}") for b in by], c(block).alias("_cblock"), "_end")
    carried = ends.withColumn("_carry", carry).drop("_end")
    on = [c(b) == F.col(f"_c{b}") for b in [*by]] + [c(block) == F.col("_cblock")]
    joined = rows.withColumn("_local", local).join(carried, on, "left")
    state = F.greatest("_local", "_carry") if how == "max" else F.coalesce("_local", "_carry")
    return joined.withColumn(name, state).drop("_local", "_carry", "_cblock", *[f"_c{b}" for b in by])


def as_of(
    left: DataFrame, right: DataFrame, left_key: str, left_time: str, right_key: str, right_time: str, payload: dict[str, str], ordinal: str,
    identity: Sequence[str], within_days: int | None = None,
) -> DataFrame:
    """Every left row with the right row of its key that was the last on or before its time.

    ``payload`` maps right columns to their new names; they are NULL where there is no
    such row, or it is more than ``within_days`` older. Right rows of one key and time:
    the one with the smallest ``ordinal`` counts. Left rows with a NULL key or time stay,
    without payload; right ones are not looked at. Empty sides give no rows, or rows
    without payload.
    """
    names = [F.col(f"_p{n}") for n in range(len(payload))]
    states = right.filter(c(right_key).isNotNull() & c(right_time).isNotNull()).select(
        c(right_key).cast("string").alias("_key"), c(right_time).alias("_time"), c(ordinal).alias("_ordinal"), *[c(p).alias(f"_p{n}") for n, p in enumerate(payload)])
    states = states.groupBy("_key", "_time").agg(F.min_by(F.struct("_time", *names), "_ordinal").alias("_state"))
    asked = left.filter(c(left_key).isNotNull() & c(left_time).isNotNull()).select(c(left_key).cast("string").alias("_key"), c(left_time).alias("_time")).distinct()
    # A state of the same time stands before the question.
    events = states.select("_key", "_time", F.lit(0).alias("_side"), "_state").unionByName(asked.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    known = running(events.withColumn("_block", block_of(F.col("_time"))), ["_key"], "_block", ["_time", "_side"], "_state", "_last", "last", own=True)
    answers = known.filter("_side = 1").select(F.col("_key").alias("_akey"), F.col("_time").alias("_atime"), "_last")
    if within_days is not None:
        answers = answers.withColumn("_last", F.when(F.datediff("_atime", F.col("_last")["_time"]) <= within_days, F.col("_last")))
    key = spread_key(F.when(c(left_time).isNotNull(), c(left_key)), *[c(i) for i in identity])
    joined = left.withColumn("_lkey", key).join(answers, (F.col("_lkey") == F.col("_akey")) & (c(left_time) == F.col("_atime")), "left")
    return joined.select(*[c(n) for n in left.columns], *[F.col("_last")[f"_p{n}"].alias(new) for n, new in enumerate(payload.values())])


def stays(df: DataFrame, key: str, start: str, end: str, max_gap: int) -> DataFrame:
    """Periods of one key that follow each other within ``max_gap`` days, or overlap, as one: key, stay_start, stay_end, periods.

    A NULL end is open, and so is its stay: stay_end is NULL. Rows with a NULL key or
    start are left out; an end before its start counts as the start. Repeated rows count
    as periods of their own. An empty table gives an empty one.
    """
    forever = F.lit("9999-12-31").cast("date")
    known = df.filter(c(key).isNotNull() & c(start).isNotNull()).select(
        c(key).alias("_key"), c(start).alias("_start"), F.coalesce(F.greatest(c(start), c(end)), c(start)).alias("_shut"), c(end).isNull().alias("_open"))
    once = known.groupBy("_key", "_start").agg(F.max(F.when(F.col("_open"), forever).otherwise(F.col("_shut"))).alias("_end"), F.count(F.lit(1)).alias("_n"))
    rows = once.withColumn("_block", block_of(F.col("_start")))
    reached = running(rows, ["_key"], "_block", ["_start"], "_end", "_reach", "max", own=False)
    opens = F.col("_reach").isNull() | (F.datediff("_start", "_reach") > max_gap)
    marked = reached.withColumn("_mark", F.when(opens, F.col("_start")))
    placed = running(marked, ["_key"], "_block", ["_start"], "_mark", "_stay", "last", own=True)
    return placed.groupBy("_key", "_stay").agg(F.max("_end").alias("_last"), F.sum("_n").alias("periods")).select(
        F.col("_key").alias(key), F.col("_stay").alias("stay_start"), F.when(F.col("_last") < forever, F.col("_last")).alias("stay_end"), "periods")
