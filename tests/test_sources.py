"""Files and landed responses."""

import hashlib
import json
from urllib.parse import urlencode

from pyspark.sql import functions as F

from fathomline import session
from fathomline.operators import features, quality, rollup
from fathomline.sources import cities, files, landing


def test_csv_round_trip_with_byte_order_mark(spark, tmp_path):
    source = tmp_path / "daily.csv"
    source.write_text("city,date,pm25,pm10,group\n北京,2024-01-01,1.5,NaN,北方\n上海,2024-01-02,,3.0,南方\n",
                      encoding="utf-8-sig")
    daily = files.read_csv(spark, str(source), files.DAILY_SCHEMA)
    rows = {r["city"]: r for r in daily.collect()}
    assert rows["北京"]["pm10"] is None and rows["上海"]["pm25"] is None
    files.write_csv(daily, str(tmp_path / "out"))
    again = files.read_csv(spark, str(tmp_path / "out"), files.DAILY_SCHEMA)
    assert sorted(again.collect()) == sorted(daily.collect())


def test_responses_become_hourly_rows(spark, tmp_path):
    for city, values in {"a": [1.0, None, 3.0], "b": [5.0, 6.0, 7.0]}.items():
        document = {"city": city, "hourly": {"time": [f"2024-01-01T0{h}:00" for h in range(3)], "pm2_5": values,
                                             "pm10": [9.0, 9.0, 9.0]}}
        (tmp_path / f"{city}.json").write_text(json.dumps(document))
    hourly = files.read_responses(spark, str(tmp_path))
    assert hourly.count() == 6
    daily = {r["city"]: r for r in rollup.daily_rollup(hourly, min_hours=2).collect()}
    assert (daily["a"]["pm25"], daily["a"]["hours"], daily["b"]["pm25"]) == (2.0, 2, 6.0)
    assert [r["city"] for r in rollup.daily_rollup(hourly, min_hours=3).collect()] == ["b"]
    assert {r["city"]: r["valid_percent"] for r in rollup.valid_rate(hourly).collect()}["b"] == 100.0


def test_markdown_folder(spark, tmp_path):
    (tmp_path / "b.md").write_bytes("# B\r\ntext".encode())
    (tmp_path / "a.md").write_text("# A\ntext")
    (tmp_path / "skip.txt").write_text("no")
    rows = [(r["doc"], r["text"]) for r in files.read_markdown(spark, str(tmp_path)).orderBy("doc").collect()]
    assert rows == [("a.md", "# A\ntext"), ("b.md", "# B\ntext")]


def test_nested_report(spark, tmp_path):
    results = spark.createDataFrame([("d", "m2", 0.5), ("d", "m1", 0.75)], "dataset string, model string, score double")
    tests = spark.createDataFrame([("d", "top2", 0.25)], "dataset string, pair string, p double")
    files.write_json(files.nested_report(results, tests, "5 x 2 folds"), str(tmp_path / "report"))
    part = next((tmp_path / "report").glob("part-*.json"))
    assert json.loads(part.read_text()) == {
        "protocol": "5 x 2 folds", "results": [{"dataset": "d", "model": "m1", "score": 0.75},
                                               {"dataset": "d", "model": "m2", "score": 0.5}],
        "significance_tests": [{"dataset": "d", "pair": "top2", "p": 0.25}]}


def test_request_address_matches_the_standard_encoder(spark):
    params = [("q", ["a b&c", "~*é"]), ("tz", ["Asia/Shanghai"])]
    row = spark.createDataFrame([(params,)], "p array<struct<name:string,values:array<string>>>").select(
        landing.canonical_url(F.lit("http://x/y"), F.col("p")).alias("url")).first()
    expected = "http://x/y?" + urlencode(dict(params), doseq=True)
    assert row["url"] == expected
    key = spark.range(1).select(landing.cache_key(F.lit(expected)).alias("k")).first()["k"]
    assert key == hashlib.sha1(expected.encode()).hexdigest()[:20]


def test_stored_payloads_with_and_without_refresh(spark):
    landed = spark.createDataFrame([("u", 1, "old"), ("u", 2, "new"), ("v", 1, "only")],
                                   "url string, fetched_at int, payload string")
    assert {r["payload"] for r in landing.stored_payloads(landed).collect()} == {"new", "only"}
    assert {r["payload"] for r in landing.stored_payloads(landed, refresh=False).collect()} == {"old", "only"}


def test_city_dimension(spark):
    rows = cities.city_dimension(spark).groupBy("group").count().collect()
    assert {r["group"]: r["count"] for r in rows} == {cities.NORTH: 9, cities.SOUTH: 8}


def test_one_hot_keeps_every_level(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "city string, v int")
    coded = features.one_hot(df, "city", features.levels_of(df, "city"))
    assert [tuple(r) for r in coded.orderBy("v").collect()] == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]


def test_quality_report_names_failures(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", -1.0)], "g string, v double")
    rows = quality.check(df, "t", [quality.row_count(2), quality.not_below("v", 0), quality.only_values("g", ["a", "b"]),
                                   quality.distinct_count("g", 3)]).collect()
    assert [r["passed"] for r in rows] == [True, False, True, False]


def test_parts_grow_with_the_splits_of_a_scan(spark):
    few, many = (spark.range(0, 1000, 1, n).withColumn("key", F.col("id").cast("string")) for n in (1, 40))
    assert session.parts_of(few) >= 8 and session.parts_of(many) == 160
    assert session.spread_out(many, "key").rdd.getNumPartitions() == 160
