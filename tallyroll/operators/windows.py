"""Ranks and look-backs that survive a hot partition.

A plain window sends every row of its partition to one task. Here the window runs
over pre-aggregated blocks (distinct values, distinct dates, one row per period),
whose number is bounded by the calendar or by the value range, and the result is
joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.operators.keys import c

# Rows of one period are spread over up to this many blocks. A block costs a row in the look-back
# over blocks only if it holds rows, so a period with one row still has one block.
BLOCKS_PER_PERIOD = 4096
# Value buckets per power of two; more buckets, smaller window partitions.
BUCKETS_PER_OCTAVE = 16


def _null_safe(left: DataFrame, right: DataFrame, names: Sequence[str], prefix: str) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & left[f"`{n}`"].eqNullSafe(right[f"`{prefix}{n}`"])
    return on


def dense_rank_desc(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """dense_rank over (partition by ``by`` order by ``value`` desc), unknown values last.

    Years are few and rows are many, so ranking inside ``by`` alone would run in as
    many tasks as there are years. The distinct values are cut into ordered buckets;
    each bucket ranks on its own and adds the number of values in the buckets above.
    """
    magnitude = F.log2(F.abs(c(value).cast("double")) + 1) * BUCKETS_PER_OCTAVE
    bucket = F.floor(F.signum(c(value).cast("double")) * magnitude)
    values = df.select(*[c(b) for b in by], c(value)).distinct().withColumn("_bucket", bucket)
    keys = [c(b) for b in by]
    above = W.partitionBy(*keys).orderBy(F.col("_bucket").desc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    sizes = values.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        *[c(b).alias(f"_o{b}") for b in by], F.col("_bucket").alias("_o_bucket"),
        F.coalesce(F.sum("_size").over(above), F.lit(0)).alias("_offset"),
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(c(value).desc_nulls_last())
    ranked = values.withColumn("_inside", F.dense_rank().over(inside))
    ranked = ranked.join(offsets, _null_safe(ranked, offsets, [*by, "_bucket"], "_o"))
    ranks = ranked.select(
        *[c(b).alias(f"_r{b}") for b in by], c(value).alias(f"_r{value}"),
        (F.col("_inside") + F.col("_offset")).cast("int").alias(name),
    )
    joined = df.join(ranks, _null_safe(df, ranks, [*by, value], "_r"))
    return joined.drop(*[f"_r{b}" for b in by], f"_r{value}")


def with_previous_two(df: DataFrame, by: Sequence[str], period: str, ties: Sequence[str], value: str) -> DataFrame:
    """Add ``prev_1`` and ``prev_2``: the value one and two rows back within ``by`` ordered by ``period``.

    Rows of one period (there is one, unless loads overlap) are spread over a fixed
    number of blocks. Look-backs inside a block come from a window over the block;
    the first two rows of a block take theirs from the tails of the blocks before,
    found by a window over one row per block.
    """
    block = [*by, period, "_salt"]
    order = [c(t) for t in ties]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(BLOCKS_PER_PERIOD)).cast("int"))
    inside = W.partitionBy(*[c(b) for b in block]).orderBy(*order)
    rows = salted.withColumns({
        "_rn": F.row_number().over(inside),
        "_lag_1": F.lag(c(value), 1).over(inside),
        "_lag_2": F.lag(c(value), 2).over(inside),
    })
    tails = rows.groupBy(*[c(b) for b in block]).agg(
        F.max_by(F.struct(c(value).alias("last"), F.col("_lag_1").alias("before")), F.col("_rn")).alias("_tail"),
        F.max("_rn").alias("_n"),
    )
    along = W.partitionBy(*[c(b) for b in by]).orderBy(c(period), "_salt")
    carry = tails.select(
        *[c(b).alias(f"_c{b}") for b in block],
        F.lag("_tail.last", 1).over(along).alias("_carry_1"),
        F.when(F.lag("_n", 1).over(along) >= 2, F.lag("_tail.before", 1).over(along))
        .otherwise(F.lag("_tail.last", 2).over(along)).alias("_carry_2"),
    )
    joined = rows.join(carry, _null_safe(rows, carry, block, "_c"), "left")
    first, second = F.col("_rn") == 1, F.col("_rn") == 2
    return joined.withColumns({
        "prev_1": F.when(first, F.col("_carry_1")).otherwise(F.col("_lag_1")),
        "prev_2": F.when(first, F.col("_carry_2")).when(second, F.col("_carry_1")).otherwise(F.col("_lag_2")),
    }).drop("_salt", "_rn", "_lag_1", "_lag_2", "_carry_1", "_carry_2", *[f"_c{b}" for b in block])


def change_from_previous(value: str) -> Column:
    """Value minus the row before (use after with_previous_two)."""
    return c(value) - F.col("prev_1")


def rolling_mean_of_three(value: str) -> Column:
    """Mean of this row and up to two before it, two decimals (use after with_previous_two)."""
    terms = [c(value), F.col("prev_1"), F.col("prev_2")]
    total = sum((F.coalesce(t, F.lit(0.0)) for t in terms), F.lit(0.0))
    known = sum((F.when(t.isNotNull(), 1).otherwise(0) for t in terms), F.lit(0))
    return F.round(F.try_divide(total, known), 2)


def enrollment_transitions(df: DataFrame, student: str, start: str, end: str, ordinal: str) -> DataFrame:
    """Gaps and overlaps between consecutive enrollments of a student.

    Only the row just before counts, and a row whose predecessor is still open is left
    out. The look-back runs over the distinct (start, end) pairs of a student, so a
    placeholder ID shared by a third of all rows costs as many rows as there are
    dates; rows repeating a pair follow their own end date.
    """
    base = df.filter(c(student).isNotNull() & c(start).isNotNull())
    pairs = base.groupBy(c(student), c(start), c(end)).agg(F.min(c(ordinal)).alias("_first"))
    along = W.partitionBy(c(student)).orderBy(c(start).asc(), c(end).asc_nulls_first())
    prior = pairs.select(
        c(student).alias("_student"), c(start).alias("_start"), c(end).alias("_end"), "_first",
        F.lag(c(end)).over(along).alias("_prior"),
    )
    on = (c(student) == F.col("_student")) & (c(start) == F.col("_start")) & c(end).eqNullSafe(F.col("_end"))
    joined = base.join(prior, on).withColumn(
        "prior_enddate", F.when(c(ordinal) == F.col("_first"), F.col("_prior")).otherwise(c(end))
    )
    gap = F.datediff(c(start), F.col("prior_enddate"))
    return (
        joined.filter(F.col("prior_enddate").isNotNull())
        .withColumn("days_between", gap)
        .withColumn("transition_type", F.when(gap < 0, "Overlap").when(gap > 0, "Gap").otherwise("Same-day transition"))
        .filter(F.col("transition_type").isin("Gap", "Overlap"))
        .drop("_student", "_start", "_end", "_first", "_prior")
    )
