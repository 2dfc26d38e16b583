"""Files in and out: typed CSV, array-shaped JSON responses, Markdown folders, nested JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.functions.columns import explode_computed, nan_to_null

DAILY_SCHEMA = "city string, date date, pm25 double, pm10 double, `group` string"
WEATHER_SCHEMA = "city string, date date, tmean double, tmax double, tmin double, precip double"
RESPONSE_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("pm2_5", T.ArrayType(T.DoubleType())),
        T.StructField("pm10", T.ArrayType(T.DoubleType())),
    ])),
])


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with a declared schema (no inference pass); a byte-order mark is accepted."""
    return nan_to_null(spark.read.schema(schema).option("header", True).csv(path))


BYTE_ORDER_MARK = "\ufeff"


def write_csv(df: DataFrame, path: str, byte_order_mark: bool = True) -> None:
    """Header CSV in UTF-8; every file begins with the byte-order mark that spreadsheets look for, unless it is not wanted."""
    first, *others = df.columns
    named = df.toDF(BYTE_ORDER_MARK + first, *others) if byte_order_mark else df
    named.write.mode("overwrite").option("header", True).csv(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Hourly rows of every response document in a landing folder."""
    return hourly_rows(spark.read.schema(RESPONSE_SCHEMA).json(path))


def hourly_rows(responses: DataFrame) -> DataFrame:
    """One row per hour from documents holding parallel arrays."""
    zipped = F.arrays_zip("hourly.time", "hourly.pm2_5", "hourly.pm10")
    return (explode_computed(responses.select("city", zipped.alias("hours")), F.col("hours"), "h")
            .select("city", F.to_timestamp_ntz("h.time").alias("time"),
                    F.col("h.pm2_5").alias("pm25"), F.col("h.pm10").alias("pm10"))
            .transform(nan_to_null))


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """One row per Markdown file, keyed by file name; the name is also the corpus order."""
    files = spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("doc"),
                        F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def nested_report(results: DataFrame, tests: DataFrame, protocol: str) -> DataFrame:
    """One-row report: protocol, sorted result records, sorted test records (both are summary tables)."""
    def records(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))

    result_list = records(results, "results")
    return result_list.select(F.lit(protocol).alias("protocol"), "results",
                              records(tests, "significance_tests").scalar().alias("significance_tests"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
