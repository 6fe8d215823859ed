"""Statistics layers: typed silver table, six gold tables, and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll import config as cfg
from tallyroll.functions.ladders import ladder
from tallyroll.functions.text import title_case
from tallyroll.operators import windows
from tallyroll.operators.keys import left_on_key
from tallyroll.sources import sinks

INTEGERS = ("year", "months_reported")
DOUBLES = tuple(n for n in cfg.BRONZE_COLUMNS if n not in (*INTEGERS, "county", "agency"))


def _total(parts: tuple[str, ...]):
    return sum((F.coalesce(F.col(p), F.lit(0.0)) for p in parts[1:]), F.coalesce(F.col(parts[0]), F.lit(0.0)))


def silver(bronze: DataFrame) -> DataFrame:
    """Typed and derived columns. No shuffle: every column depends on its own row."""
    typed = bronze.withColumns({
        **{n: F.col(n).try_cast("int") for n in INTEGERS},
        **{n: F.col(n).try_cast("double") for n in DOUBLES},
        "county": title_case(F.col("county")),
        "agency": title_case(F.col("agency")),
    })
    totals = typed.withColumns({
        "violent_crime_total": _total(cfg.VIOLENT_PARTS),
        "property_crime_total": _total(cfg.PROPERTY_PARTS),
    })
    violent, prop = F.col("violent_crime_total"), F.col("property_crime_total")
    is_total = F.coalesce(F.upper("agency").contains("COUNTY TOTAL"), F.lit(False))
    return totals.withColumns({
        "crime_category": ladder([(violent > prop, "Violent-Heavy"), (violent < prop, "Property-Heavy")], "Mixed"),
        "decade": (F.floor(F.col("year") / 10) * 10).cast("int"),
        "is_county_total": is_total.cast("int"),
        "data_quality_flag": F.when(F.col("months_reported") >= 12, "COMPLETE").otherwise("INCOMPLETE"),
        "crime_rate_per_100k": F.lit(None).cast("double"),
    }).select(*cfg.SILVER_COLUMNS)


def county_totals(silver_df: DataFrame) -> DataFrame:
    return silver_df.filter(F.col("is_county_total") == 1)


def gold_county_year(silver_df: DataFrame) -> DataFrame:
    return county_totals(silver_df).select(
        "county", "year", "total_index_crimes", "violent_crime_total", "property_crime_total", "crime_category",
        "decade", "data_quality_flag")


def gold_rankings(silver_df: DataFrame) -> DataFrame:
    """Rank of each county within its year by all index crimes, ties sharing a rank."""
    base = county_totals(silver_df).select(
        "year", "county", "total_index_crimes", "violent_crime_total", "property_crime_total")
    return windows.dense_rank_desc(base, ["year"], "total_index_crimes", "county_rank").select(
        "year", "county", "total_index_crimes", "county_rank", "violent_crime_total", "property_crime_total")


def _trend(base: DataFrame, total: str) -> DataFrame:
    """Change against the county's previous row and mean of its last three rows."""
    ties = [n for n in base.columns if n not in ("county", "year")]
    looked_back = windows.with_previous_two(base, ["county"], "year", ties, total)
    return looked_back.select(
        *base.columns,
        windows.change_from_previous(total).alias("yoy_change"),
        windows.rolling_mean_of_three(total).alias("rolling_3yr_avg"),
    )


def gold_violent_trends(silver_df: DataFrame) -> DataFrame:
    return _trend(county_totals(silver_df).select(
        "county", "year", F.col("murder_non_negl_manslaughter").alias("murder"),
        F.col("rape_legacy_definition").alias("rape_legacy"), "robbery", "aggravated_assault", "violent_crime_total",
    ), "violent_crime_total")


def gold_property_trends(silver_df: DataFrame) -> DataFrame:
    return _trend(county_totals(silver_df).select(
        "county", "year", *cfg.PROPERTY_PARTS, "property_crime_total"), "property_crime_total")


def gold_agency_activity(silver_df: DataFrame) -> DataFrame:
    return silver_df.select("county", "agency", "year", "total_index_crimes", "months_reported", "data_quality_flag")


def gold_forecast_base(silver_df: DataFrame) -> DataFrame:
    return county_totals(silver_df).select(
        "county", "year", "total_index_crimes", "violent_crime_total", "property_crime_total")


# Gold table -> (builder, sort order of the written table).
GOLD = {
    "gold_county_year_crime": (gold_county_year, ("county", "year")),
    "gold_county_rankings": (gold_rankings, ("year", "county_rank")),
    "gold_violent_crime_trends": (gold_violent_trends, ("county", "year")),
    "gold_property_crime_trends": (gold_property_trends, ("county", "year")),
    "gold_agency_activity": (gold_agency_activity, ("county", "agency", "year")),
    "gold_forecast_base": (gold_forecast_base, ("county", "year")),
}


def gold(silver_df: DataFrame) -> dict[str, DataFrame]:
    return {name: build(silver_df) for name, (build, _) in GOLD.items()}


def build_tables(bronze: DataFrame, bronze_table: str = "bronze_statistics", silver_table: str = "silver_statistics",
                 fmt: str = "parquet") -> list[str]:
    """Write bronze, silver and the six gold tables, each layer read back from the table below it. Returns the names.

    Every table is a full refresh, so a failed run is simply run again.
    """
    spark = bronze.sparkSession
    sinks.write_table(bronze, bronze_table, fmt)
    sinks.write_table(silver(spark.table(bronze_table)), silver_table, fmt)
    for name, (build, order) in GOLD.items():
        sinks.write_table(sinks.sorted_for_write(build(spark.table(silver_table)), order), name, fmt)
    return [bronze_table, silver_table, *GOLD]


def rank_movement(rankings: DataFrame) -> DataFrame:
    """Places gained (positive) or lost against the county's previous ranked year."""
    moved = windows.with_previous_two(rankings, ["county"], "year", ["county_rank"], "county_rank")
    return moved.select("county", "year", "county_rank", F.col("prev_1").alias("previous_rank"),
                        (F.col("prev_1") - F.col("county_rank")).alias("places_gained"))


def top_counties(rankings: DataFrame, k: int = 10) -> DataFrame:
    """The counties ranked k or better in each year; ties all stay."""
    return rankings.filter(F.col("county_rank") <= k)


def county_history(trend: DataFrame, county: str, columns: list[str], n: int) -> DataFrame:
    """The last n years of one county; rows of one year by their other columns."""
    return trend.filter(F.col("county") == county).select(*columns).orderBy(F.desc("year"), *columns).limit(n)


def with_population_rate(silver_df: DataFrame, population: DataFrame) -> DataFrame:
    """Fill crime_rate_per_100k from (county, year, population); unknown or zero population leaves NULL.

    A county and year that is listed more than once counts with its largest population, so rows are never multiplied.
    """
    glued = F.when(F.col("county").isNotNull() & F.col("year").isNotNull(), F.concat_ws("\u001f", "county", F.col("year").cast("string")))
    side = population.groupBy(glued.alias("_key")).agg(F.max("population").alias("population")).filter("_key IS NOT NULL")
    key = glued
    joined = left_on_key(silver_df, side, key, "_key", ["agency", "total_index_crimes"])
    rate = F.round(F.try_divide(F.col("total_index_crimes") * 100000, F.col("population")), 2)
    return joined.withColumn("crime_rate_per_100k", rate).drop("population")
