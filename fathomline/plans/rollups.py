"""Registered queries: sensor rollups, monthly features, landed responses; each with its SQL twin."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.columns import columns_with_prefix, month_label, numeric_columns
from fathomline.operators import features, rollup
from fathomline.plans import views
from fathomline.session import new_shared_folder
from fathomline.sources import files, landing, tables

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
COMPLETE_DAY = 60
READINGS_PER_RESPONSE = 240


def daily_rollup(spark: SparkSession, folder: str, min_hours: int = COMPLETE_DAY) -> DataFrame:
    daily = rollup.daily_rollup(tables.station_hourly(spark, folder), min_hours)
    return rollup.with_group(daily, tables.channel_dimension(spark)).select(
        "city", "group", "date", F.round("pm25", 6).alias("pm25"), F.round("pm10", 6).alias("pm10"), "hours")


def valid_rate(spark: SparkSession, folder: str) -> DataFrame:
    readings = tables.station_hourly(spark, folder)
    gaps = (F.col("city") == "error") & (F.col("event_id") % 3 == 0)
    holed = readings.withColumn("pm25", F.when(~gaps, F.col("pm25")))
    return rollup.valid_rate(holed).withColumn("valid_percent", F.round("valid_percent", 6))


def station_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.period_ranking(tables.city_daily(spark, folder), 1)


def ranking_ends(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.ranking_ends(rollup.period_ranking(tables.city_daily(spark, folder), 1))


def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.table_profile(tables.city_daily(spark, folder))


def month_group_pivot(spark: SparkSession, folder: str) -> DataFrame:
    groups = features.levels_of(tables.table(spark, folder, "region"), "r_name")
    pivoted = rollup.month_group_pivot(tables.city_daily(spark, folder), groups, digits=8)
    return pivoted.withColumnsRenamed({g: g.lower().replace(" ", "_") for g in groups})


def season_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.season_ratio(tables.city_daily(spark, folder)).select(
        "city", *[F.round(c, 8).alias(c) for c in ("winter", "summer", "ratio")])


def season_flag_means(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.heating_means(tables.city_daily(spark, folder)).withColumns(
        {c: F.round(c, 6) for c in ("heating_pm25", "other_pm25")})


def exceed_share(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.exceed_share(tables.station_hourly(spark, folder), digits=6)


def exceed_share_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.exceed_share(tables.city_daily(spark, folder), threshold=250.0, digits=6)


def city_months(spark: SparkSession, folder: str) -> DataFrame:
    return features.city_month_features(tables.city_daily(spark, folder), tables.weather_daily(spark, folder))


def city_month_features(spark: SparkSession, folder: str) -> DataFrame:
    return city_months(spark, folder).select(
        "city", "group", month_label(F.col("ym")).alias("ym"), "month",
        *[F.round(c, 9).alias(c) for c in ("pm25", "tmean", "precip", "month_sin", "month_cos")])


def one_hot_city(spark: SparkSession, folder: str) -> DataFrame:
    nations = tables.table(spark, folder, "nation")
    daily = tables.city_daily(spark, folder).select("city", F.col("date").cast("string").alias("date"), "pm25")
    coded = features.one_hot(daily, "city", features.levels_of(nations, "n_name"))
    flags = columns_with_prefix(coded, "city_")
    kept = [c for c in numeric_columns(coded) if c not in flags]
    return coded.select("date", *[F.round(c, 8).alias(c) for c in kept], *flags)


def landed_latest(spark: SparkSession, folder: str) -> DataFrame:
    return landing.stored_payloads(tables.landed_pages(spark, folder)).select(
        "cache_key", "url", "fetched_at", F.md5("payload").alias("payload_md5"))


def landed_first(spark: SparkSession, folder: str) -> DataFrame:
    return landing.stored_payloads(tables.landed_pages(spark, folder), refresh=False).select(
        "cache_key", "url", "fetched_at", F.md5("payload").alias("payload_md5"))


def landed_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Pages fetched twice at the same time: one response per address stays."""
    tied = tables.landed_pages(spark, folder).withColumn("fetched_at", F.length("url") % 7)
    return landing.stored_payloads(tied).select("cache_key", "url", "fetched_at")


def store_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The first and the second fetch of the pages merged into a store as two batches, and the first batch once more."""
    store = new_shared_folder(spark, "store")
    pages = tables.landed_pages(spark, folder)
    again = F.col("fetched_at") >= 1000000
    for batch in (pages.filter(~again), pages.filter(again), pages.filter(~again)):
        landing.merge_batch(batch, store)
    return landing.read_store(spark, store).select("cache_key", "url", "fetched_at", F.md5("payload").alias("payload_md5"))


def request_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = tables.table(spark, folder, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    base = F.regexp_extract("url", r"^[^?#]*", 0)
    words = F.split(title, " ")
    params = F.array(
        F.struct(F.lit("q").alias("name"), F.array(title, F.lit("~a*b c/d")).alias("values")),
        F.struct(F.lit("first word").alias("name"), F.array(F.get(words, F.lit(0))).alias("values")))
    request = landing.canonical_url(base, params)
    return pages.select("page_id", request.alias("request_url"), landing.cache_key(request).alias("cache_key"))


def _responses(readings: DataFrame) -> DataFrame:
    """Response documents of bounded size: city, hourly (parallel arrays)."""
    reading = F.struct(F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"),
                       F.col("pm25").alias("pm2_5"), "pm10")
    packed = (readings.groupBy("city", F.floor(F.col("event_id") / READINGS_PER_RESPONSE).alias("request"))
              .agg(F.collect_list(reading).alias("h")))
    hourly = F.struct(*[F.col(f"h.{name}").alias(name) for name in ("time", "pm2_5", "pm10")])
    return packed.select("city", hourly.alias("hourly"))


def json_inline(spark: SparkSession, folder: str) -> DataFrame:
    """Pack readings into response documents of bounded size, parse them as JSON and flatten them again."""
    documents = _responses(tables.station_hourly(spark, folder)).select(F.to_json(F.struct("city", "hourly")).alias("body"))
    parsed = documents.select(F.from_json("body", files.RESPONSE_SCHEMA).alias("doc")).select("doc.*")
    return files.hourly_rows(parsed)


def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """The daily values written as CSV files and read back with their declared types."""
    daily = tables.city_daily(spark, folder)
    path = new_shared_folder(spark, "daily-csv")
    files.write_csv(daily.select("city", "date", "pm25", F.lit(None).cast("double").alias("pm10"), "group"), path)
    return files.read_csv(spark, path, files.DAILY_SCHEMA).withColumn("pm25", F.round("pm25", 8))


def response_files(spark: SparkSession, folder: str) -> DataFrame:
    """Readings packed into response documents, written as JSON files and read back as hours."""
    path = new_shared_folder(spark, "responses")
    files.write_json(_responses(tables.station_hourly(spark, folder)), path)
    return files.read_responses(spark, path)


def report_files(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking and the shares above a limit as one nested report, written as JSON and read back flat."""
    path = new_shared_folder(spark, "report")
    ranking, shares = station_ranking(spark, folder), exceed_share_daily(spark, folder)
    files.write_json(files.nested_report(ranking, shares, "daily means"), path)
    report = spark.read.json(path)
    ranked = report.select("protocol", F.explode("results").alias("r")).select("protocol", "r.*")
    return ranked.join(report.select(F.explode("significance_tests").alias("s")).select("s.*"), "city")


QUERIES = {f.__name__: f for f in (
    daily_rollup, valid_rate, station_ranking, ranking_ends, table_profile, month_group_pivot, season_ratio,
    season_flag_means, exceed_share, exceed_share_daily, city_month_features, one_hot_city, landed_latest,
    landed_first, landed_ties, store_latest, request_urls, json_inline, csv_files, response_files, report_files)}

_daily = views.with_views(views.CITY_DAILY)
_hourly = views.with_views(views.STATION_HOURLY)
_landed = views.with_views(views.LANDED)
_ranking = """SELECT city, "group", round(avg(pm25), 1) AS annual_pm25 FROM city_daily GROUP BY ALL"""
_cities = [f"NATION_{i}" for i in range(25)]

ORACLE = {
    "daily_rollup": _hourly + f"""
      SELECT city, CASE WHEN city IN ('click', 'purchase', 'signup') THEN 'active'
                        WHEN city = 'view' THEN 'passive' END AS "group",
             CAST(time AS DATE) AS date, round(avg(pm25), 6) AS pm25, round(avg(pm10), 6) AS pm10,
             count(pm25) AS hours
      FROM station_hourly GROUP BY city, CAST(time AS DATE) HAVING count(pm25) >= {COMPLETE_DAY}""",
    "valid_rate": _hourly + """
      SELECT city, count(*) AS hours,
             round(avg(CASE WHEN city = 'error' AND event_id % 3 = 0 THEN 0.0 ELSE 1.0 END) * 100, 6) AS valid_percent
      FROM station_hourly GROUP BY city""",
    "station_ranking": _daily + _ranking,
    "ranking_ends": _daily + f""", ranking AS ({_ranking})
      SELECT (SELECT city FROM ranking ORDER BY annual_pm25 DESC, city LIMIT 1) AS worst,
             max(annual_pm25) AS worst_pm25,
             (SELECT city FROM ranking ORDER BY annual_pm25, city DESC LIMIT 1) AS best,
             min(annual_pm25) AS best_pm25 FROM ranking""",
    "table_profile": _daily + """
      SELECT count(*) AS n_rows, count(DISTINCT city) AS n_cities, count(DISTINCT date) AS n_days,
             min(date) AS first_day, max(date) AS last_day FROM city_daily""",
    "month_group_pivot": _daily + "SELECT month(date) AS month, " + ", ".join(
        f"""round(avg(pm25) FILTER ("group" = '{r}'), 8) AS {r.lower().replace(' ', '_')}""" for r in REGIONS)
        + " FROM city_daily GROUP BY 1",
    "season_ratio": _daily + """, w AS (SELECT city, avg(pm25) AS winter FROM city_daily
                                        WHERE month(date) IN (12, 1, 2) GROUP BY city),
      s AS (SELECT city, avg(pm25) AS summer FROM city_daily WHERE month(date) IN (6, 7, 8) GROUP BY city)
      SELECT city, round(winter, 8) AS winter, round(summer, 8) AS summer, round(winter / summer, 8) AS ratio
      FROM w FULL JOIN s USING (city)""",
    "season_flag_means": _daily + """, flagged AS (
        SELECT "group", pm25, month(date) IN (11, 12, 1, 2, 3) AS heating FROM city_daily)
      SELECT "group", round(avg(pm25) FILTER (heating), 6) AS heating_pm25,
             round(avg(pm25) FILTER (NOT heating), 6) AS other_pm25,
             count(*) FILTER (heating) AS heating_days, count(*) FILTER (NOT heating) AS other_days
      FROM flagged GROUP BY 1""",
    "exceed_share": _hourly + """
      SELECT city, round(count(*) FILTER (pm25 > 15) * 100.0 / count(*), 6) AS exceed_percent
      FROM station_hourly GROUP BY city""",
    "exceed_share_daily": _daily + """
      SELECT city, round(count(*) FILTER (pm25 > 250) * 100.0 / count(*), 6) AS exceed_percent
      FROM city_daily GROUP BY city""",
    "city_month_features": views.with_views(views.CITY_DAILY, views.WEATHER_DAILY, views.CITY_MONTHS) + f"""
      SELECT city, "group", strftime(ym, '%Y-%m') AS ym, CAST(month(ym) AS INTEGER) AS month,
             round(pm25, 9) AS pm25, round(tmean, 9) AS tmean, round(precip, 9) AS precip,
             round(sin({2 * math.pi!r}::DOUBLE * month(ym) / 12.0::DOUBLE), 9) AS month_sin,
             round(cos({2 * math.pi!r}::DOUBLE * month(ym) / 12.0::DOUBLE), 9) AS month_cos
      FROM city_months""",
    "one_hot_city": _daily + "SELECT CAST(date AS VARCHAR) AS date, round(pm25, 8) AS pm25, " + ", ".join(
        f"CAST(city = '{c}' AS INTEGER) AS \"city_{c}\"" for c in _cities) + " FROM city_daily",
    "landed_latest": _landed + """
      SELECT substr(sha1(url), 1, 20) AS cache_key, url, fetched_at, md5(payload) AS payload_md5 FROM landed
      QUALIFY row_number() OVER (PARTITION BY substr(sha1(url), 1, 20) ORDER BY fetched_at DESC) = 1""",
    "landed_first": _landed + """
      SELECT substr(sha1(url), 1, 20) AS cache_key, url, fetched_at, md5(payload) AS payload_md5 FROM landed
      QUALIFY row_number() OVER (PARTITION BY substr(sha1(url), 1, 20) ORDER BY fetched_at) = 1""",
    "landed_ties": _landed + """
      SELECT substr(sha1(url), 1, 20) AS cache_key, url, max(length(url) % 7) AS fetched_at FROM landed GROUP BY url""",
    "request_urls": """
      WITH parts AS (
        SELECT page_id, regexp_extract(url, '^[^?#]*', 0) AS base,
               regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages),
      requests AS (
        SELECT page_id, base || '?q=' || replace(url_encode(title), '%20', '+') || '&q=~a%2Ab+c%2Fd&first+word='
               || replace(url_encode(split_part(title, ' ', 1)), '%20', '+') AS request_url FROM parts)
      SELECT page_id, request_url, substr(sha1(request_url), 1, 20) AS cache_key FROM requests""",
    "json_inline": _hourly + "SELECT city, time, pm25, pm10 FROM station_hourly",
    "response_files": _hourly + "SELECT city, time, pm25, pm10 FROM station_hourly",
    "csv_files": _daily + """SELECT city, date, round(pm25, 8) AS pm25, CAST(NULL AS DOUBLE) AS pm10, "group" FROM city_daily""",
    "report_files": _daily + """
      SELECT 'daily means' AS protocol, city, "group", round(avg(pm25), 1) AS annual_pm25,
             round(count(*) FILTER (pm25 > 250) * 100.0 / count(*), 6) AS exceed_percent
      FROM city_daily GROUP BY ALL""",
}

ORACLE["store_latest"] = ORACLE["landed_latest"]
