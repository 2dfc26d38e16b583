"""Data-quality expectations: one aggregation pass per table, one result row per check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """An aggregate that must lie between two limits (a missing limit is open)."""

    name: str
    observed: Column
    at_least: float | None = None
    at_most: float | None = None


def row_count(at_least: int) -> Expectation:
    return Expectation(f"rows >= {at_least}", F.count(F.lit(1)), at_least)


def distinct_count(column: str, expected: int) -> Expectation:
    return Expectation(f"distinct {column} = {expected}", F.count_distinct(column), expected, expected)


def only_values(column: str, allowed: list) -> Expectation:
    return Expectation(f"{column} only in allowed values", F.count_if(~F.col(column).isin(*allowed)), 0, 0)


def not_below(column: str, limit: float) -> Expectation:
    return Expectation(f"{column} >= {limit:g}", F.count_if(F.col(column) < limit), 0, 0)


def no_missing(column: str) -> Expectation:
    return Expectation(f"{column} present", F.count_if(F.col(column).isNull()), 0, 0)


def mean_between(column: str, low: float, high: float) -> Expectation:
    return Expectation(f"mean {column} in [{low:g}, {high:g}]", F.avg(column), low, high)


def check(df: DataFrame, table: str, expectations: list[Expectation]) -> DataFrame:
    """Rows (table, check, observed, at_least, at_most, passed)."""
    observed = df.agg(*[e.observed.cast("double").alias(f"c{i}") for i, e in enumerate(expectations)])

    def limit(value: float | None) -> Column:
        return F.lit(None if value is None else float(value)).cast("double")

    checks = F.array(*[F.struct(
        F.lit(table).alias("table"), F.lit(e.name).alias("check"), F.col(f"c{i}").alias("observed"),
        limit(e.at_least).alias("at_least"), limit(e.at_most).alias("at_most"))
        for i, e in enumerate(expectations)])
    rows = observed.select(F.explode(checks).alias("e")).select("e.*")
    above = F.coalesce(F.col("observed") >= F.col("at_least"), F.col("at_least").isNull())
    below = F.coalesce(F.col("observed") <= F.col("at_most"), F.col("at_most").isNull())
    return rows.withColumn("passed", above & below)


def join_coverage(left: DataFrame, right: DataFrame, keys: list[str], table: str, at_least: int) -> DataFrame:
    """Rows of the left table that have a partner."""
    return check(left.join(right.select(*keys).distinct(), keys, "left_semi"), table, [row_count(at_least)])


def argmax_agrees(ranking: DataFrame, key: str, value: str, daily: DataFrame, table: str) -> DataFrame:
    """The first entity of a ranking is the entity with the highest mean of the underlying rows."""
    head = ranking.agg(F.min_by(key, F.struct(-F.col(value), key)).alias("head")).scalar()
    means = daily.groupBy(key).agg(F.round(F.avg("pm25"), 9).alias("mean"))
    top = means.agg(F.min_by(key, F.struct(-F.col("mean"), key)).alias("top"))
    agrees = Expectation("ranking head has the highest mean", F.count_if(F.col("top") == F.col("head")), 1, 1)
    return check(top.select("top", head.alias("head")), table, [agrees])
