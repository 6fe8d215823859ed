"""Comparison of computed statuses with an analyst's final table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions.text import comparable_status, present, strip_decimal_zero
from tallyroll.operators import billing_rules as rules
from tallyroll.operators.keys import c, first_per_key


def match(engine: DataFrame, final: DataFrame, key: str, engine_status: str, final_status: str,
          engine_order: Sequence[Column], final_order: Sequence[Column], carry: Sequence[str] = ()) -> DataFrame:
    """First row per cleaned key on both sides, joined; MATCH / MISMATCH / SKIP-NA."""
    def side(df: DataFrame, order: Sequence[Column]) -> DataFrame:
        keyed = df.withColumn("_key", strip_decimal_zero(c(key)))
        return first_per_key(keyed.filter(present(F.col("_key"))), ["_key"], order)

    left = side(engine, engine_order).select(
        "_key", c(engine_status).alias("engine_status"), *[c(n) for n in carry])
    right = side(final, final_order).select("_key", c(final_status).alias("final_status"))
    joined = left.join(right, "_key").withColumnRenamed("_key", "nyssis")
    scaled = joined.withColumns({
        "engine_norm": comparable_status(F.col("engine_status")), "final_norm": comparable_status(F.col("final_status"))})
    return scaled.withColumn("status_match", F.when(
        F.col("engine_norm").isNull() | F.col("final_norm").isNull(), "SKIP-NA"
    ).when(F.col("engine_norm") == F.col("final_norm"), "MATCH").otherwise("MISMATCH"))


def match_rate(matched: DataFrame) -> DataFrame:
    """One row: compared, matched, mismatched, skipped, and the match rate in percent."""
    is_ = lambda s: F.count_if(F.col("status_match") == s)
    total = F.count(F.lit(1))
    rate = F.round(100.0 * is_("MATCH") / F.greatest(total - is_("SKIP-NA"), F.lit(1)), 1)
    return matched.agg(total.alias("compared"), is_("MATCH").alias("matched"), is_("MISMATCH").alias("mismatched"),
                       is_("SKIP-NA").alias("skipped"), rate.alias("match_rate_pct"))


def _mismatch_category() -> Column:
    """Category of a mismatch, NULL on other rows."""
    return F.when(F.col("status_match") == "MISMATCH", rules.difference_category(F.col("engine_norm"), F.col("final_norm")))


def summary(matched: DataFrame) -> DataFrame:
    """(section, value) rows of the comparison, from one pass over the matched rows."""
    is_ = lambda s: F.count_if(F.col("status_match") == s)
    total, skipped = F.count(F.lit(1)), is_("SKIP-NA")
    of = lambda k: F.count_if(F.col("_category") == k)
    values = {
        "Total Students Compared": total, "Status Matches": is_("MATCH"), "Status Differences": is_("MISMATCH"),
        "Skipped (missing status)": skipped,
        "Match rate %": F.round(100.0 * is_("MATCH") / F.greatest(total - skipped, F.lit(1)), 1),
        "Category A": of("A"), "Category B": of("B"), "Category C": of("C"), "Category D": of("D"),
        "Unexplained differences": of("Other"),
    }
    one = matched.withColumn("_category", _mismatch_category()).agg(
        *[v.cast("double").alias(f"v{i}") for i, v in enumerate(values.values())])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("section"), F.col(f"v{i}").alias("value")) for i, name in enumerate(values)])))


def differences(matched: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The mismatches with their category and its explanation."""
    return matched.withColumn("category", _mismatch_category()).filter(F.col("category").isNotNull()).select(
        "nyssis", "engine_status", "final_status", "category", *[c(n) for n in carry],
        rules.difference_explanation(F.col("category")).alias("explanation"))


def category_counts(diffs: DataFrame) -> DataFrame:
    """One row: mismatches per category, zero included."""
    return diffs.agg(*[
        F.count_if(F.col("category") == k).alias(f"category_{k.lower()}") for k in ("A", "B", "C", "D", "Other")
    ], F.count(F.lit(1)).alias("total_differences"))
