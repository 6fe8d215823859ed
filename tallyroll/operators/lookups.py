"""Ordered fallback lookups ("waterfalls").

A row may be found by several keys, tried in a fixed order. Instead of one join per
key, each row emits its (level, key) pairs, one join finds all levels at once, the
lowest level wins, and the winners are joined to the rows by row id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.operators.keys import c


def _pairs(levels: Sequence[Column]) -> list[Column]:
    return [F.struct(F.lit(i).alias("level"), k.alias("key")) for i, k in enumerate(levels)]


def level_table(source: DataFrame, levels: Sequence[Column], aggregates: Sequence[Column], keep: Sequence[Column],
                unique_levels: Sequence[int] = ()) -> DataFrame:
    """Lookup side: one row per (level, key). Levels in ``unique_levels`` answer only with exactly one source row."""
    tagged = source.select(*keep, F.inline(F.array(*_pairs(levels)))).filter("key is not null")
    grouped = tagged.groupBy("level", "key").agg(*aggregates, F.count(F.lit(1)).alias("_rows"))
    if unique_levels:
        grouped = grouped.filter(~F.col("level").isin(*unique_levels) | (F.col("_rows") == 1))
    return grouped.drop("_rows")


def patch(df: DataFrame, row_id: str, needs: Column, levels: Sequence[Column], table: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Every row plus the payload of its winning level, NULL where nothing was needed or found.

    Only (row id, level, key) of rows that need something go through the lookup; rows
    that know no key emit nothing. What was found is joined to the rows by their id, so
    a whole row is shuffled once, and never once per key. ``row_id`` is unique.
    """
    wanted = [F.when(needs, k) for k in levels]
    asked = df.select(c(row_id).alias("_asked"), F.inline(F.array(*_pairs(wanted)))).filter("key is not null")
    side = table.select(F.col("level").alias("_level"), F.col("key").alias("_key"), F.struct(*[c(p).alias(f"_p{i}") for i, p in enumerate(payload)]).alias("_payload"))
    joined = asked.join(side, (F.col("level") == F.col("_level")) & (F.col("key") == F.col("_key")))
    # One row per level that answered, so no group here exceeds the number of levels.
    won = joined.groupBy("_asked").agg(F.min_by("_payload", "level").alias("_won"))
    found = df.join(won, c(row_id) == F.col("_asked"), "left")
    return found.select(*[c(n) for n in df.columns], *[F.col("_won")[f"_p{i}"].alias(p) for i, p in enumerate(payload)])
