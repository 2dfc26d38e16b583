"""The driver tables and the views over them that stand for the analysed data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.hashing import digest
from fathomline.functions.columns import nan_to_null
from fathomline.session import parts_of, spread_out

# Lookup from event type to channel; one type is left out so that it maps to NULL.
CHANNELS = [("click", "active"), ("purchase", "active"), ("signup", "active"), ("view", "passive")]


def table(spark: SparkSession, folder: str, name: str, where: Column | None = None) -> DataFrame:
    """A driver table with NaN as NULL; `where` is applied to the stored columns, so that the scan can use it."""
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return nan_to_null(rows if where is None else rows.filter(where))


def station_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Readings per station: city, time, pm25, pm10."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("city"), F.col("ts").alias("time"), F.col("value").alias("pm25"),
        F.get_json_object("props", "$.k").cast("double").alias("pm10"), "event_id")


def channel_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHANNELS, "city string, `group` string")


def city_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily values per city with its group: city, group, date, pm25."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return (table(spark, folder, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("n_name").alias("city"), F.col("r_name").alias("group"),
                     F.to_date("o_orderdate").alias("date"))
            .agg((F.avg("o_totalprice") / 1000).alias("pm25")))


def weather_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily weather per city: city, date, tmean, tmax, tmin, precip."""
    places = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return (table(spark, folder, "lineitem").join(places, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(F.col("n_name").alias("city"), F.to_date("l_shipdate").alias("date"))
            .agg((F.avg("l_discount") * 100).alias("tmean"), (F.max("l_discount") * 100).alias("tmax"),
                 (F.min("l_discount") * 100).alias("tmin"), F.sum("l_quantity").alias("precip")))


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents to search, named by source, language and number."""
    return spread_out(table(spark, folder, "documents").select(
        F.concat_ws("/", "source", "lang", "doc_id").alias("doc"), "text"), "doc")


def parts(spark: SparkSession, folder: str, name: str) -> int:
    """Parts that `corpus` (documents) and `turn_documents` (conversations) are dealt into."""
    return parts_of(table(spark, folder, name))


def search_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def search_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Queries with the document name parts that count as relevant and the text a hit must hold."""
    shard = F.concat(F.lit("src"), F.pmod("query_id", F.lit(10)).cast("string"), F.lit("/"))
    return search_queries(spark, folder).select(
        "query_id", "query", F.array(F.lit("/en/"), F.lit("src1"), shard, F.lit("src99/")).alias("relevant_docs"),
        F.col("query").alias("keyword"))


def turn_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation turn as a small Markdown document with nested, skipped and empty headings."""
    text = F.concat(
        F.lit("Note before any heading, on turn "), F.col("turn"), F.lit(" of this conversation.\n"),
        F.lit("# conversation "), F.col("conv_id"), F.lit("\n## "), "role", F.lit(" "), F.col("turn"), F.lit("\n"),
        "text", F.lit("\n\n#### size\n<b>this turn holds "), F.length("text"),
        F.lit(" characters</b> in one message\n## empty\n\n### <i>again</i>\n"),
        "text", F.lit("\n \n"), "text", F.lit("\n\nEnd of turn.\n"))
    return spread_out(table(spark, folder, "conversations").select(
        F.concat_ws("-", F.lit("conv"), "conv_id", "turn").alias("doc"), text.alias("text")), "doc")


def landed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Web responses as they landed; every second page was fetched again later with changed content."""
    first = table(spark, folder, "pages").select("page_id", "url", F.col("page_id").alias("fetched_at"),
                                                 F.col("html").alias("payload"))
    second = (first.filter(F.col("page_id") % 2 == 0)
              .withColumns({"fetched_at": F.col("fetched_at") + 1000000,
                            "payload": F.concat("payload", F.lit("<!-- again -->"))}))
    return first.unionByName(second)


def embedding_features(spark: SparkSession, folder: str) -> DataFrame:
    """Classification matrix: row_id, label, features."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("row_id"), "label", F.col("embedding").cast("array<double>").alias("features"))


def quality_features(spark: SparkSession, folder: str) -> DataFrame:
    """Document quality labels with simple counts of the text as features; shares of an empty text are 0.

    Characters of a kind are counted by what is left without them, as few match.
    """
    def held(kind: str) -> Column:
        return F.col("length") - F.length(F.regexp_replace("text", kind, ""))

    counts = {"length": F.length("text"), "words": F.size(F.split("text", r"\s+"))}
    kinds = {"points": held("[.,;:!?]"), "digits": held("[0-9]"), "capitals": held("[A-Z]"), "lines": held(r"\n"),
             "others": held(r"[^\p{L}\p{N}\s]+")}
    labelled = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id")
    features = [F.col("length"), F.col("words"), *[F.try_divide(of, by) for of, by in (
        ("length", "words"), ("points", "length"), ("digits", "length"), ("capitals", "length"), ("lines", "words"), ("others", "length"))]]
    return labelled.withColumns(counts).withColumns(kinds).select(
        F.col("doc_id").alias("row_id"), F.col("quality").alias("label"),
        F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in features]).alias("features"))


def experiment_units(spark: SparkSession, folder: str, price: float = 400000.0, year: int = 1998) -> DataFrame:
    """Customers as experiment units: unit, segment, arm, converted (an order above `price` in `year`)."""
    bought = ((F.col("o_totalprice") > price)
              & (F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
              & (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))
    # NaN counts as larger than any price in the scan filter, and is dropped once it reads as missing.
    buyers = (table(spark, folder, "orders", bought).filter(F.col("o_totalprice").isNotNull())
              .select(F.col("o_custkey").alias("c_custkey"), F.lit(1).alias("converted")).distinct())
    arm_digit = F.conv(F.substring(digest(42, F.col("c_custkey")), 1, 8), 16, 10).cast("long")
    return (table(spark, folder, "customer").join(buyers, "c_custkey", "left")
            .select(F.col("c_custkey").alias("unit"), F.col("c_mktsegment").alias("segment"),
                    F.when(arm_digit % 2 == 0, "A").otherwise("B").alias("arm"),
                    F.coalesce("converted", F.lit(0)).alias("converted")))
