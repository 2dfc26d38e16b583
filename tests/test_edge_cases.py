"""Ordinary data that must not end a job: ties, empty arms, zero rates, constant targets, saved stages."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from fathomline.operators import evaluation, experiment, models, ranktests
from fathomline.sources import landing


def test_equal_times_give_one_response(spark):
    landed = spark.createDataFrame([("u", 5, "a"), ("u", 5, "b"), ("v", 1, "c")], "url string, fetched_at long, payload string")
    for refresh in (True, False):
        rows = landing.stored_payloads(landed, refresh).collect()
        assert sorted(r.url for r in rows) == ["u", "v"]
        assert {r.payload for r in rows} == {r.payload for r in landing.stored_payloads(landed.repartition(3), refresh).collect()}


def test_empty_arm_and_zero_rate(spark):
    counts = spark.createDataFrame([(0, 0, 3, 10), (2, 10, 3, 10), (0, 9, 0, 9)], "x_a long, n_a long, x_b long, n_b long")
    rows = {r.n_a: r for r in experiment.two_proportion_test(counts).collect()}
    assert rows[0].z is None and rows[0].ci_low is None and rows[10].z is not None and rows[9].z is None
    rates = spark.createDataFrame([(0.0,), (0.1,)], "p_baseline double")
    power = experiment.power_curve(rates, 0.05).groupBy("p_baseline").agg(F.count("power").alias("n")).collect()
    assert {r.p_baseline: r.n for r in power} == {0.0: 0, 0.1: 6}


def test_replays_count_every_unit(spark):
    units = spark.range(50).select(F.col("id").alias("unit"), (F.col("id") % 3 == 0).cast("int").alias("converted"))
    rows = experiment.replayed_counts(units, 70).collect()
    assert sorted(r.replicate for r in rows) == list(range(70))
    assert all(r.n_a + r.n_b == 50 and r.x_a + r.x_b == 17 and 0 < r.n_a < 50 for r in rows)


def test_constant_target_has_no_r2(spark):
    rows = spark.createDataFrame([("m", 1.0, 1.5), ("m", 1.0, 0.5), ("n", 1.0, 1.0), ("n", 3.0, 2.0)],
                                 "model string, target double, prediction double")
    found = {r.model: (r.r2, r.mae) for r in evaluation.regression_scores(rows, ["model"]).collect()}
    assert found == {"m": (None, 0.5), "n": (0.5, 0.5)}


def test_large_samples_take_the_normal_branch(spark):
    rows = spark.range(2_003).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"), (F.col("id") < 3).alias("first"))
    exact = ranktests.mann_whitney(rows, ["g"], "v", "first").first()
    bounded = ranktests.mann_whitney(rows, ["g"], "v", "first", exact_cells=100).first()
    assert exact.u == bounded.u and exact.p != bounded.p and abs(exact.p - bounded.p) < 0.01


def test_saved_fourier_stage_is_the_same(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense([1.0, 2.0, 3.0]),)], ["scaled"])
    stage = models.RandomFourierFeatures(inputCol="scaled", outputCol="out", width=3, gamma=0.3, count=16)
    stage.save(str(tmp_path / "stage"))
    again = models.RandomFourierFeatures.load(str(tmp_path / "stage"))
    assert stage.transform(rows).first().out == again.transform(rows).first().out


def test_replay_deals_units_over_the_cores(spark):
    units = spark.createDataFrame([(k, k % 2) for k in range(40)], "unit long, converted int").coalesce(1)
    plan = experiment.replayed_counts(units, 70)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(unit#", plan) and "REPARTITION_BY_NUM" in plan
