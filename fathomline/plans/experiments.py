"""Registered queries: experiment statistics and rank tests; each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions import normal
from fathomline.functions.columns import heating_season
from fathomline.operators import experiment, ranktests
from fathomline.plans import views
from fathomline.sources import tables

MDE, ALPHA, POWER = 0.05, 0.05, 0.8
REPLICATES = 2000


def _baselines(spark: SparkSession, folder: str) -> DataFrame:
    counts = experiment.conversion_counts(tables.experiment_units(spark, folder), ["segment"])
    return counts.select("segment", ((F.col("x_a") + F.col("x_b")) / (F.col("n_a") + F.col("n_b"))).alias("p_baseline"))


def conversion_counts(spark: SparkSession, folder: str) -> DataFrame:
    return experiment.conversion_counts(tables.experiment_units(spark, folder), ["segment"])


def required_n(spark: SparkSession, folder: str) -> DataFrame:
    return _baselines(spark, folder).select(
        "segment", F.round("p_baseline", 8).alias("p_baseline"),
        experiment.required_size(F.col("p_baseline"), MDE, ALPHA, POWER).alias("required_n"))


def ztest_segments(spark: SparkSession, folder: str) -> DataFrame:
    tested = experiment.two_proportion_test(conversion_counts(spark, folder), ALPHA)
    return experiment.test_report(tested)


def analytic_power(spark: SparkSession, folder: str) -> DataFrame:
    return experiment.power_curve(_baselines(spark, folder), MDE, ALPHA, POWER).select(
        "segment", "multiple", "n", F.round("power", 6).alias("power"))


def aa_replay(spark: SparkSession, folder: str) -> DataFrame:
    return experiment.false_positive_rate(tables.experiment_units(spark, folder), REPLICATES, ALPHA).withColumn(
        "false_positive_rate", F.round("false_positive_rate", 6))


def mann_whitney_season(spark: SparkSession, folder: str) -> DataFrame:
    daily = tables.city_daily(spark, folder).withColumn("heating", heating_season(F.col("date")))
    # Whole units, so that the tie correction matters.
    return ranktests.mann_whitney(daily.withColumn("pm25", F.floor("pm25")), ["group"], "pm25", "heating").select(
        "group", "n1", "n2", "u", F.round("z", 6).alias("z"), F.round("p", 6).alias("p"))


def mann_whitney_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly means of each city and year, heating months against the others: small samples, so the exact distribution."""
    date = F.col("date")
    monthly = (tables.city_daily(spark, folder).groupBy("city", F.year(date).alias("year"), F.month(date).alias("month"))
               .agg(F.avg("pm25").alias("pm25"), F.first(heating_season(date)).alias("heating")))
    tested = ranktests.mann_whitney(monthly, ["city", "year"], "pm25", "heating").filter("n1 > 0 and n2 > 0")
    return tested.select("city", "year", "n1", "n2", "u", F.round("p", 6).alias("p"))


def _consecutive_years(values: DataFrame, keys: list[str], digits: int) -> DataFrame:
    """Means of a year and the next one for every key that has both: keys, year (the first), first, second.

    Each yearly mean takes part in two pairs, so one grouping makes them all and no year is named.
    """
    yearly = values.groupBy(*keys, F.year("date").alias("y")).agg(F.round(F.avg("pm25"), digits).alias("mean"))
    roles = F.array(F.struct(F.col("y").alias("year"), F.col("mean").alias("first"), F.lit(None).cast("double").alias("second")),
                    F.struct((F.col("y") - 1).alias("year"), F.lit(None).cast("double").alias("first"), F.col("mean").alias("second")))
    return yearly.select(*keys, F.explode(roles).alias("r")).groupBy(*keys, "r.year").agg(
        F.max("r.first").alias("first"), F.max("r.second").alias("second")).filter(
        F.col("first").isNotNull() & F.col("second").isNotNull())


def paired_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Means of every two consecutive years, paired by city within a region."""
    return _consecutive_years(tables.city_daily(spark, folder), ["group", "city"], 1)


def wilcoxon_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return ranktests.signed_rank(paired_scores(spark, folder), ["group", "year"], "first", "second").select(
        "group", "year", F.round("diff_mean", 4).alias("diff_mean"), "n", "statistic", F.round("p", 4).alias("wilcoxon_p"),
        (F.col("p") < ALPHA).alias("significant"))


def wilcoxon_months(spark: SparkSession, folder: str) -> DataFrame:
    """Every two consecutive years, paired by city and month over all regions: more than 50 pairs, so the normal approximation."""
    daily = tables.city_daily(spark, folder).withColumn("month", F.month("date"))
    tested = ranktests.signed_rank(_consecutive_years(daily, ["city", "month"], 0), ["year"], "first", "second")
    return tested.filter(F.col("n") > ranktests.EXACT_SIGNED_RANK_SIZE).select(
        "year", F.round("diff_mean", 6).alias("diff_mean"), "n", "statistic", F.round("p", 6).alias("wilcoxon_p"))


QUERIES = {f.__name__: f for f in (
    conversion_counts, required_n, ztest_segments, analytic_power, aa_replay, mann_whitney_season, mann_whitney_exact, wilcoxon_pairs,
    wilcoxon_months)}

_COUNTS = """counts AS (
  SELECT segment, CAST(sum(converted) FILTER (arm = 'A') AS BIGINT) AS x_a, count(*) FILTER (arm = 'A') AS n_a,
         CAST(sum(converted) FILTER (arm = 'B') AS BIGINT) AS x_b, count(*) FILTER (arm = 'B') AS n_b
  FROM experiment_units GROUP BY segment)"""
_TESTED = """rated AS (
  SELECT *, x_a / n_a AS p_a, x_b / n_b AS p_b, (x_a + x_b) / (n_a + n_b) AS pool FROM counts),
tested AS (
  SELECT *, (p_b - p_a) / sqrt(pool * (1 - pool) * (1.0::DOUBLE / n_a + 1.0::DOUBLE / n_b)) AS z,
         sqrt(p_a * (1 - p_a) / n_a + p_b * (1 - p_b) / n_b) AS se FROM rated)"""
_z_alpha = f"{normal.quantile(1 - ALPHA / 2)!r}::DOUBLE"
_z_power = f"{normal.quantile(POWER)!r}::DOUBLE"
_SIZED = f"""baselines AS (SELECT segment, (x_a + x_b) / (n_a + n_b) AS p1 FROM counts),
targets AS (SELECT *, p1 * {1 + MDE!r}::DOUBLE AS p2 FROM baselines),
middles AS (SELECT *, (p1 + p2) / 2 AS m FROM targets),
sized AS (
  SELECT *, CAST(ceil(({_z_alpha} * sqrt(2 * m * (1 - m)) + {_z_power} * sqrt(p1 * (1 - p1) + p2 * (1 - p2))) ** 2
                 / (p2 - p1) ** 2) AS BIGINT) AS required_n FROM middles)"""
_power_z = f"(abs(p2 - p1) * sqrt(n) - {_z_alpha} * sqrt(2 * m * (1 - m))) / sqrt(p1 * (1 - p1) + p2 * (1 - p2))"


def _signed_rank_sql(source: str, key: str) -> str:
    return f"""gaps AS (SELECT {key}, round(first - second, 12) AS gap FROM {source}),
means AS (SELECT {key}, avg(gap) AS diff_mean, count(*) FILTER (gap <> 0) AS n FROM gaps GROUP BY {key}),
ranked AS (
  SELECT {key}, gap, rank() OVER (PARTITION BY {key} ORDER BY abs(gap))
         + (count(*) OVER (PARTITION BY {key}, abs(gap)) - 1) / 2 AS r
  FROM gaps WHERE gap <> 0),
sums AS (SELECT {key}, coalesce(sum(r) FILTER (gap > 0), 0) AS plus, sum(r) AS every, list(r) AS ranks FROM ranked GROUP BY {key})"""


def _consecutive_sql(keys: str, digits: int) -> str:
    return f"""yearly AS (
  SELECT {keys.replace('month(date)', 'month(date) AS month')}, year(date) AS year, round(avg(pm25), {digits}) AS mean FROM city_daily GROUP BY ALL),
pairs AS (
  SELECT a.*, a.mean AS first, b.mean AS second FROM yearly a JOIN yearly b
  ON {' AND '.join(f'a.{k} = b.{k}' for k in keys.replace('month(date)', 'month').split(', '))} AND b.year = a.year + 1)"""


ORACLE = {
    "conversion_counts": views.with_views(views.EXPERIMENT_UNITS, _COUNTS) + "SELECT * FROM counts",
    "required_n": views.with_views(views.EXPERIMENT_UNITS, _COUNTS, _SIZED)
    + "SELECT segment, round(p1, 8) AS p_baseline, required_n FROM sized",
    "ztest_segments": views.with_views(views.EXPERIMENT_UNITS, _COUNTS, _TESTED) + f"""
      SELECT segment, x_a, n_a, x_b, n_b, round(z, 3) AS z, round(p_b - p_a, 5) AS uplift_abs,
             round((p_b - p_a) / p_a, 4) AS uplift_rel, round(p_b - p_a - 1.96::DOUBLE * se, 5) AS ci_low,
             round(p_b - p_a + 1.96::DOUBLE * se, 5) AS ci_high, round({views.two_sided_p_sql('z')}, 5) AS p,
             {views.two_sided_p_sql('z')} < 0.05 AS significant FROM tested""",
    "analytic_power": views.with_views(views.EXPERIMENT_UNITS, _COUNTS, _SIZED, f"""steps AS (
        SELECT *, unnest([0.25, 0.5, 0.75, 1.0, 1.5, 2.0])::DOUBLE AS multiple FROM sized),
      sizes AS (SELECT *, CAST(floor(required_n * multiple) AS BIGINT) AS n FROM steps),
      scored AS (SELECT segment, multiple, n, {_power_z} AS z FROM sizes)""")
    + f"SELECT segment, multiple, n, round({views.normal_cdf_sql('z')}, 6) AS power FROM scored",
    "aa_replay": views.with_views(views.EXPERIMENT_UNITS, f"""replicates AS (
        SELECT unnest(range({REPLICATES})) AS replicate),
      assigned AS (
        SELECT replicate, converted, ('0x' || substr(md5((replicate // 32) || '|' || unit), replicate % 32 + 1, 1))::INT
               % 2 AS is_b FROM experiment_units, replicates),
      counts AS (
        SELECT replicate, sum(converted) FILTER (is_b = 0) AS x_a, count(*) FILTER (is_b = 0) AS n_a,
               sum(converted) FILTER (is_b = 1) AS x_b, count(*) FILTER (is_b = 1) AS n_b
        FROM assigned GROUP BY replicate)""", _TESTED) + f"""
      SELECT count(*) AS replicates, round(avg(CAST({views.two_sided_p_sql('z')} < 0.05 AS DOUBLE)), 6)
             AS false_positive_rate, avg(CAST({views.two_sided_p_sql('z')} < 0.05 AS DOUBLE)) <= 0.075 AS healthy
      FROM tested""",
    "mann_whitney_season": views.with_views(views.CITY_DAILY, """samples AS (
        SELECT "group", floor(pm25) AS v, month(date) IN (11, 12, 1, 2, 3) AS heating FROM city_daily),
      ranked AS (
        SELECT "group", heating, count(*) OVER (PARTITION BY "group", v) AS t,
               rank() OVER (PARTITION BY "group" ORDER BY v) + (count(*) OVER (PARTITION BY "group", v) - 1) / 2 AS r
        FROM samples),
      sums AS (
        SELECT "group", count(*) FILTER (heating) AS n1, count(*) FILTER (NOT heating) AS n2,
               sum(r) FILTER (heating) AS r1, sum((t::DOUBLE * t * t - t) / t) AS ties, count(*) AS n
        FROM ranked GROUP BY "group"),
      scored AS (
        SELECT *, r1 - n1 * (n1 + 1) / 2 AS u FROM sums),
      zs AS (
        SELECT *, (abs(u - n1 * n2 / 2) - 0.5::DOUBLE)
               / sqrt(n1::DOUBLE * n2 / 12 * (n + 1 - ties / (n::DOUBLE * (n - 1)))) AS z FROM scored)""") + f"""
      SELECT "group", n1, n2, u, round(z, 6) AS z, round(least({views.two_sided_p_sql('z')}, 1.0), 6) AS p FROM zs""",
    "mann_whitney_exact": views.with_views(views.CITY_DAILY, """monthly AS (
        SELECT city, year(date) AS year, month(date) AS month, month(date) IN (11, 12, 1, 2, 3) AS heating,
               avg(pm25) AS v FROM city_daily GROUP BY ALL),
      ranked AS (SELECT *, rank() OVER (PARTITION BY city, year ORDER BY v) AS r FROM monthly),
      sums AS (
        SELECT city, year, count(*) FILTER (heating) AS n1, count(*) FILTER (NOT heating) AS n2,
               sum(r) FILTER (heating) - n1 * (n1 + 1) / 2 AS u FROM ranked GROUP BY city, year),
      sizes AS (SELECT DISTINCT n1, n2 FROM sums WHERE n1 > 0 AND n2 > 0),
      masks AS (SELECT n1, n2, unnest(range(CAST(2 ** (n1 + n2) AS BIGINT))) AS mask FROM sizes),
      possible AS (
        SELECT n1, n2, list_sum([i * ((mask >> (i - 1)) % 2) for i in range(1, n1 + n2 + 1)]) - n1 * (n1 + 1) / 2 AS w
        FROM masks WHERE bit_count(mask) = n1)""") + """
      SELECT city, year, n1, n2, any_value(u) AS u,
             round(least(1.0::DOUBLE, 2 * avg(CAST(w >= greatest(u, n1 * n2 - u) AS DOUBLE))), 6) AS p
      FROM sums JOIN possible USING (n1, n2) GROUP BY city, year, n1, n2""",
    "wilcoxon_pairs": views.with_views(views.CITY_DAILY, _consecutive_sql('"group", city', 1),
        _signed_rank_sql("pairs", '"group", year'), """signs AS (
        SELECT "group", year, plus, every, ranks, unnest(range(CAST(2 ** len(ranks) AS BIGINT))) AS mask FROM sums),
      possible AS (
        SELECT "group", year, plus, list_sum([CASE WHEN (mask >> (i - 1)) % 2 = 1 THEN ranks[i] ELSE 0 END
                                              for i in range(1, len(ranks) + 1)]) AS w FROM signs),
      tails AS (SELECT "group", year, avg(CAST(w <= plus AS DOUBLE)) AS low, avg(CAST(w >= plus AS DOUBLE)) AS high
                FROM possible GROUP BY "group", year)""") + """
      SELECT "group", year, round(diff_mean, 4) AS diff_mean, n, least(plus, every - plus) AS statistic,
             round(coalesce(least(1.0, 2 * least(low, high)), 1.0), 4) AS wilcoxon_p,
             coalesce(least(1.0, 2 * least(low, high)), 1.0) < 0.05 AS significant
      FROM means LEFT JOIN sums USING ("group", year) LEFT JOIN tails USING ("group", year)""",
    "wilcoxon_months": views.with_views(views.CITY_DAILY, _consecutive_sql("city, month(date)", 0),
        _signed_rank_sql("pairs", "year"), """ties AS (
        SELECT year, sum(t::DOUBLE * t * t - t) AS ties FROM (
          SELECT year, abs(gap) AS size, count(*) AS t FROM gaps WHERE gap <> 0 GROUP BY ALL) GROUP BY year),
      zs AS (
        SELECT *, least(plus, every - plus) AS statistic, (least(plus, every - plus) - n * (n + 1) / 4)
               / sqrt((n * (n + 1.0::DOUBLE) * (2 * n + 1) - ties / 2) / 24) AS z
        FROM means JOIN sums USING (year) JOIN ties USING (year) WHERE n > 50)""") + f"""
      SELECT year, round(diff_mean, 6) AS diff_mean, n, statistic, round({views.two_sided_p_sql('z')}, 6) AS wilcoxon_p
      FROM zs""",
}
