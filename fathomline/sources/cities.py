"""City dimension of the air-quality table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NORTH, SOUTH = "北方", "南方"

# City, latitude, longitude, group.
CITIES = [
    ("北京", 39.90, 116.41, NORTH),
    ("天津", 39.13, 117.20, NORTH),
    ("石家庄", 38.04, 114.51, NORTH),
    ("太原", 37.87, 112.55, NORTH),
    ("西安", 34.34, 108.94, NORTH),
    ("兰州", 36.06, 103.83, NORTH),
    ("乌鲁木齐", 43.83, 87.62, NORTH),
    ("沈阳", 41.80, 123.43, NORTH),
    ("哈尔滨", 45.80, 126.53, NORTH),
    ("上海", 31.23, 121.47, SOUTH),
    ("南京", 32.06, 118.80, SOUTH),
    ("杭州", 30.27, 120.16, SOUTH),
    ("武汉", 30.59, 114.31, SOUTH),
    ("成都", 30.57, 104.07, SOUTH),
    ("重庆", 29.56, 106.55, SOUTH),
    ("广州", 23.13, 113.26, SOUTH),
    ("深圳", 22.54, 114.06, SOUTH),
]


def city_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, "city string, lat double, lon double, `group` string")
