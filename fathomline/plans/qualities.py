"""Registered query: the data-quality report over the analysed views, with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.operators import quality, rollup
from fathomline.plans import views
from fathomline.plans.rollups import REGIONS
from fathomline.sources import tables


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    daily = tables.city_daily(spark, folder)
    weather = tables.weather_daily(spark, folder)
    readings = tables.station_hourly(spark, folder)
    year = daily.withColumn("year", F.year("date"))
    reports = [
        quality.check(year, "city_daily", [
            quality.distinct_count("city", 25), quality.row_count(1000), quality.not_below("year", 1995),
            quality.not_below("pm25", 0), quality.only_values("group", REGIONS),
            quality.mean_between("pm25", 200, 300)]),
        quality.check(readings, "station_hourly", [
            quality.distinct_count("city", 5), quality.no_missing("pm25"), quality.not_below("pm10", 1)]),
        quality.join_coverage(daily, weather, ["city", "date"], "city_daily with weather", 350),
        quality.argmax_agrees(rollup.period_ranking(daily, 9), "city", "annual_pm25", daily, "ranking")]
    every = reports[0]
    for report in reports[1:]:
        every = every.unionByName(report)
    return every.withColumn("observed", F.round("observed", 4))


QUERIES = {"dq_report": dq_report}


def _row(table: str, check: str, observed: str, source: str, low, high) -> str:
    low, high = ("NULL" if v is None else f"{float(v)!r}" for v in (low, high))
    return f"""SELECT '{table}' AS "table", '{check}' AS "check", CAST({observed} AS DOUBLE) AS observed,
               CAST({low} AS DOUBLE) AS at_least, CAST({high} AS DOUBLE) AS at_most FROM {source}"""


_allowed = ", ".join(f"'{r}'" for r in REGIONS)
_rows = [
    _row("city_daily", "distinct city = 25", "count(DISTINCT city)", "city_daily", 25, 25),
    _row("city_daily", "rows >= 1000", "count(*)", "city_daily", 1000, None),
    _row("city_daily", "year >= 1995", "count(*) FILTER (year(date) < 1995)", "city_daily", 0, 0),
    _row("city_daily", "pm25 >= 0", "count(*) FILTER (pm25 < 0)", "city_daily", 0, 0),
    _row("city_daily", "group only in allowed values", f'count(*) FILTER ("group" NOT IN ({_allowed}))', "city_daily",
         0, 0),
    _row("city_daily", "mean pm25 in [200, 300]", "avg(pm25)", "city_daily", 200, 300),
    _row("station_hourly", "distinct city = 5", "count(DISTINCT city)", "station_hourly", 5, 5),
    _row("station_hourly", "pm25 present", "count(*) FILTER (pm25 IS NULL)", "station_hourly", 0, 0),
    _row("station_hourly", "pm10 >= 1", "count(*) FILTER (pm10 < 1)", "station_hourly", 0, 0),
    _row("city_daily with weather", "rows >= 350", "count(*)", "city_daily JOIN weather_daily USING (city, date)",
         350, None),
    _row("ranking", "ranking head has the highest mean", "1", "(SELECT 1)", 1, 1)]

ORACLE = {
    "dq_report": views.with_views(views.STATION_HOURLY, views.CITY_DAILY, views.WEATHER_DAILY,
                                  "checks AS (" + "\nUNION ALL ".join(_rows) + ")")
    + """SELECT "table", "check", round(observed, 4) AS observed, at_least, at_most,
                (at_least IS NULL OR observed >= at_least) AND (at_most IS NULL OR observed <= at_most) AS passed
         FROM checks""",
}
