"""Column functions for the sensor tables: missing values, calendar parts, seasons, rounding."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

# Calendar months of the heating season, of winter and of summer.
HEATING_MONTHS = (11, 12, 1, 2, 3)
WINTER_MONTHS = (12, 1, 2)
SUMMER_MONTHS = (6, 7, 8)


def null_if_nan(column: Column) -> Column:
    """NaN means missing: `avg` and `count` skip NULL but not NaN."""
    return F.when(~F.isnan(column), column)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Map NaN to NULL in every floating column of a freshly read table."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({name: null_if_nan(F.col(name)) for name in floating}) if floating else df


def heating_season(date: Column) -> Column:
    return F.month(date).isin(*HEATING_MONTHS)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MONTH")


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_sin(month: Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * month / F.lit(12.0))


def month_cos(month: Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * month / F.lit(12.0))


def share_percent(condition: Column) -> Column:
    """Aggregate: percentage of rows that meet the condition."""
    return F.avg(condition.cast("double")) * 100


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [name for name in df.columns if name.startswith(prefix)]


def explode_computed(df: DataFrame, array: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per element of a computed array; the other columns stay.

    A plain explode makes the optimizer add a `size(array) > 0` filter below it, which computes the array a
    second time; the outer form with a filter on its output does not.
    """
    if position is None:
        return df.select("*", F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
    return df.select("*", F.posexplode_outer(array).alias(position, name)).filter(F.col(position).isNotNull())
