"""Monthly features per city from two daily tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.columns import month_cos, month_sin, month_start
from fathomline.session import collect_bounded

MAX_LEVELS = 10_000


def city_month_features(pm: DataFrame, weather: DataFrame) -> DataFrame:
    """Join the daily tables on city and date and roll them up to months with a cyclic month encoding.

    Both inputs hold one row per (city, date), so the join key is unique on each side and cannot be hot.
    """
    daily = pm.join(weather.select("city", "date", "tmean", "precip"), ["city", "date"])
    monthly = daily.groupBy("city", "group", month_start(F.col("date")).alias("ym")).agg(
        F.avg("pm25").alias("pm25"), F.avg("tmean").alias("tmean"), F.sum("precip").alias("precip"))
    month = F.month("ym")
    return monthly.withColumns({"month": month, "month_sin": month_sin(month), "month_cos": month_cos(month)})


def levels_of(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a column that is meant to have few."""
    rows = collect_bounded(df.select(column).distinct(), MAX_LEVELS, f"levels of {column}")
    return sorted(row[0] for row in rows if row[0] is not None)


def one_hot(df: DataFrame, column: str, levels: list) -> DataFrame:
    """Replace a column by one 0/1 column per level, all levels kept."""
    flags = {f"{column}_{level}": F.coalesce(F.col(column) == level, F.lit(False)).cast("int") for level in levels}
    return df.withColumns(flags).drop(column)
