"""Seasonal operators on hand-made rows."""

from pyspark.sql import functions as F

from fathomline.operators import rollup


def daily(spark):
    rows = [("n", "north", "2024-01-05", 30.0), ("n", "north", "2024-07-05", 10.0), ("n", "north", "2024-12-01", 50.0),
            ("s", "south", "2024-01-05", 20.0), ("s", "south", "2024-04-05", 15.0)]
    return spark.createDataFrame(rows, "city string, group string, date string, pm25 double").withColumn(
        "date", F.to_date("date"))


def test_season_ratio_with_a_missing_season(spark):
    rows = {r["city"]: r for r in rollup.season_ratio(daily(spark)).collect()}
    assert (rows["n"]["winter"], rows["n"]["summer"], rows["n"]["ratio"]) == (40.0, 10.0, 4.0)
    assert rows["s"]["summer"] is None and rows["s"]["ratio"] is None


def test_ranking_and_its_ends(spark):
    ranking = rollup.period_ranking(daily(spark))
    assert [(r["city"], r["annual_pm25"]) for r in ranking.collect()] == [("n", 30.0), ("s", 17.5)]
    ends = rollup.ranking_ends(ranking).first()
    assert (ends["worst"], ends["best"]) == ("n", "s")


def test_share_above_counts_missing_as_not_above(spark):
    rows = daily(spark).withColumn("pm25", F.when(F.col("date") != "2024-04-05", F.col("pm25")))
    found = {r["city"]: r["exceed_percent"] for r in rollup.exceed_share(rows).collect()}
    assert found == {"n": 66.7, "s": 50.0}


def test_heating_means(spark):
    north = rollup.heating_means(daily(spark)).filter(F.col("group") == "north").first()
    assert (north["heating_pm25"], north["other_pm25"], north["heating_days"], north["other_days"]) == (40.0, 10.0, 2, 1)
