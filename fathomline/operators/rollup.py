"""Sensor rollups: hourly to daily, period means, seasons, threshold shares, table profile.

Every operator is one grouped aggregation, so a station that holds most of the rows is reduced on the map
side and only (group, partial sum) rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.columns import (SUMMER_MONTHS, WINTER_MONTHS, heating_season, share_percent)

# Fixed value: daily guideline for fine particles, in micrograms per cubic metre.
DAILY_GUIDELINE = 15.0


def daily_rollup(hourly: DataFrame, min_hours: int = 12) -> DataFrame:
    """Daily means per city, kept only for days with enough non-missing hours."""
    return (hourly.groupBy("city", F.to_date("time").alias("date"))
            .agg(F.avg("pm25").alias("pm25"), F.avg("pm10").alias("pm10"), F.count("pm25").alias("hours"))
            .filter(F.col("hours") >= min_hours))


def with_group(daily: DataFrame, dimension: DataFrame) -> DataFrame:
    """Attach the group of each city; unknown cities get NULL. Spark broadcasts the dimension if it is small."""
    return daily.join(dimension.select("city", "group"), "city", "left")


def valid_rate(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("city").agg(F.count(F.lit(1)).alias("hours"),
                                      share_percent(F.col("pm25").isNotNull()).alias("valid_percent"))


def period_ranking(daily: DataFrame, digits: int = 1) -> DataFrame:
    """Period mean per city and group, highest first."""
    return (daily.groupBy("city", "group").agg(F.round(F.avg("pm25"), digits).alias("annual_pm25"))
            .orderBy(F.desc("annual_pm25"), "city"))


def ranking_ends(ranking: DataFrame) -> DataFrame:
    """First and last city of a ranking; equal values are decided by city name."""
    first = F.struct(-F.col("annual_pm25"), "city")
    return ranking.agg(F.min_by("city", first).alias("worst"), F.max("annual_pm25").alias("worst_pm25"),
                       F.max_by("city", first).alias("best"), F.min("annual_pm25").alias("best_pm25"))


def table_profile(daily: DataFrame) -> DataFrame:
    return daily.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("city").alias("n_cities"),
                     F.count_distinct("date").alias("n_days"), F.min("date").alias("first_day"),
                     F.max("date").alias("last_day"))


def month_group_pivot(daily: DataFrame, groups: list[str], digits: int = 6) -> DataFrame:
    """Mean per calendar month with one column per group; naming the groups saves a discovery pass."""
    return (daily.groupBy(F.month("date").alias("month")).pivot("group", groups)
            .agg(F.round(F.avg("pm25"), digits)))


def _mean_in(months: tuple[int, ...]) -> Column:
    return F.avg(F.when(F.month("date").isin(*months), F.col("pm25")))


def season_ratio(daily: DataFrame) -> DataFrame:
    """Winter and summer mean per city and their ratio, in one pass; a missing season gives NULL."""
    means = daily.groupBy("city").agg(_mean_in(WINTER_MONTHS).alias("winter"), _mean_in(SUMMER_MONTHS).alias("summer"))
    return means.withColumn("ratio", F.try_divide("winter", "summer"))


def heating_means(daily: DataFrame) -> DataFrame:
    """Mean inside and outside the heating season per group."""
    heating = heating_season(F.col("date"))
    return daily.groupBy("group").agg(
        F.avg(F.when(heating, F.col("pm25"))).alias("heating_pm25"),
        F.avg(F.when(~heating, F.col("pm25"))).alias("other_pm25"),
        F.count(F.when(heating, 1)).alias("heating_days"), F.count(F.when(~heating, 1)).alias("other_days"))


def exceed_share(daily: DataFrame, threshold: float = DAILY_GUIDELINE, digits: int = 1) -> DataFrame:
    """Percentage of rows above the threshold; a missing value counts as not above."""
    above = F.coalesce(F.col("pm25") > threshold, F.lit(False))
    return daily.groupBy("city").agg(F.round(share_percent(above), digits).alias("exceed_percent"))
