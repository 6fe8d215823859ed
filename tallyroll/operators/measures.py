"""Report measures over the county-year table, in the filter context of their ``by`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.operators.keys import c


def _share(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    ratio = F.try_divide(part, whole)
    return ratio if empty is None else F.coalesce(ratio, F.lit(empty))


def totals(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total crimes, violent and property rate, completeness rate and complete records, in one aggregation."""
    complete = F.col("data_quality_flag") == "COMPLETE"
    return df.groupBy(*by).agg(
        F.sum("total_index_crimes").alias("total_crimes"),
        _share(F.sum("violent_crime_total"), F.sum("total_index_crimes")).alias("violent_crime_rate"),
        _share(F.sum("property_crime_total"), F.sum("total_index_crimes")).alias("property_crime_rate"),
        _share(F.count_if(complete), F.count(F.lit(1))).alias("completeness_rate"),
        F.count_if(complete).alias("complete_records"),
    )


def county_measures(df: DataFrame, county: str, by: Sequence[str] = ()) -> DataFrame:
    """Total and violent rate of one county inside every context."""
    here = F.col("county") == county
    total = F.sum(F.when(here, F.col("total_index_crimes")))
    return df.groupBy(*by).agg(
        total.alias("county_crimes"),
        _share(F.sum(F.when(here, F.col("violent_crime_total"))), total).alias("county_violent_rate"),
    )


def yoy_change(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(this year - last year) / last year by year value; NULL if last year is absent or zero.

    The self join runs over one row per year and context.
    """
    yearly = df.groupBy(*by, "year").agg(F.sum("total_index_crimes").alias("current_total"))
    prior = yearly.select(*[c(b).alias(f"_p{b}") for b in by], (F.col("year") + 1).alias("_pyear"),
                          F.col("current_total").alias("prior_total"))
    on = F.col("year") == F.col("_pyear")
    for b in by:
        on = on & (c(b) == c(f"_p{b}"))
    change = F.try_divide(F.col("current_total") - F.col("prior_total"), F.col("prior_total"))
    return yearly.join(prior, on, "left").select(*by, "year", "current_total", "prior_total", change.alias("yoy_change_pct"))


def top_county(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """County with the most crimes in each context; NULL if several share the top."""
    per_county = df.groupBy(*by, "county").agg(F.sum("total_index_crimes").alias("_total"))
    per_total = per_county.groupBy(*by, "_total").agg(F.count(F.lit(1)).alias("_ties"), F.max("county").alias("_county"))
    best = per_total.groupBy(*by).agg(F.max_by(F.struct("_ties", "_county"), F.col("_total")).alias("_best"))
    return best.select(*by, F.when(F.col("_best._ties") == 1, F.col("_best._county")).alias("top_county"))


def moving_average(df: DataFrame, value: str, years: int = 3, name: str | None = None) -> DataFrame:
    """Mean over rows whose year lies in [year - years + 1, year], by year value, per county.

    Rows are summed per county and year first, so the window sees one row per year.
    """
    yearly = df.groupBy("county", "year").agg(F.sum(c(value)).alias("_sum"), F.count(c(value)).alias("_n"))
    span = W.partitionBy("county").orderBy("year").rangeBetween(-(years - 1), 0)
    mean = F.try_divide(F.sum("_sum").over(span), F.sum("_n").over(span))
    return yearly.select("county", "year", F.col("_sum").alias(value), mean.alias(name or f"moving_avg_{years}yr"))


def above_trailing_average(df: DataFrame, value: str, years: int = 10) -> DataFrame:
    """Flag the years whose value exceeds the county's trailing mean."""
    averaged = moving_average(df, value, years, "trailing_avg")
    return averaged.withColumn("above_average", (c(value) > F.col("trailing_avg")).cast("int"))


def average_per_county(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean over counties of the county total."""
    per_county = df.groupBy(*by, "county").agg(F.sum("total_index_crimes").alias("_total"))
    return per_county.groupBy(*by).agg(F.avg("_total").alias("avg_crimes_per_county"))


def quality_matrix(df: DataFrame) -> DataFrame:
    """The completeness flag of every county and year, one row each: no year is left out, and no list of years is needed."""
    return df.groupBy("county", "year").agg(F.min("data_quality_flag").alias("data_quality_flag"))
