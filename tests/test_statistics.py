"""Statistics against golden values, enumeration and counting."""

import itertools
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fathomline.functions.normal import erfc, two_sided_p
from fathomline.operators import experiment, ranktests
from fathomline.operators.ranks import position_by_hash, running_by_value


def test_erfc_matches_the_c_library(spark):
    points = [x / 8 for x in range(-40, 200)]
    rows = spark.createDataFrame([(x,) for x in points], "x double").select("x", erfc(F.col("x")).alias("y")).collect()
    for row in rows:
        assert row["y"] == pytest.approx(math.erfc(row["x"]), rel=1e-12)


def test_required_size_and_power_sizes(spark):
    base = spark.createDataFrame([(0.10,)], "p_baseline double")
    rows = experiment.power_curve(base, 0.05).orderBy("multiple").collect()
    assert {r["required_n"] for r in rows} == {57763}
    assert [r["n"] for r in rows] == [14440, 28881, 43322, 57763, 86644, 115526]
    powers = [r["power"] for r in rows]
    assert powers == sorted(powers)
    assert powers[3] == pytest.approx(0.8, abs=1e-4)


def test_two_proportion_test(spark):
    counts = spark.createDataFrame([(5700, 57763, 6041, 57763), (10, 100, 10, 100), (0, 50, 0, 50)],
                                   "x_a long, n_a long, x_b long, n_b long")
    rows = experiment.test_report(experiment.two_proportion_test(counts)).collect()
    p_a, p_b, n = 5700 / 57763, 6041 / 57763, 57763
    pool = (5700 + 6041) / (2 * n)
    z = (p_b - p_a) / math.sqrt(pool * (1 - pool) * 2 / n)
    assert rows[0]["z"] == round(z, 3)
    assert rows[0]["p"] == round(math.erfc(z / math.sqrt(2)), 5)
    assert rows[0]["significant"]
    half = 1.96 * math.sqrt(p_a * (1 - p_a) / n + p_b * (1 - p_b) / n)
    assert (rows[0]["ci_low"], rows[0]["ci_high"]) == (round(p_b - p_a - half, 5), round(p_b - p_a + half, 5))
    assert rows[1]["z"] == 0 and rows[1]["p"] == 1 and not rows[1]["significant"]
    assert rows[2]["z"] is None


def test_false_positive_rate_is_near_alpha(spark):
    units = spark.range(4000).select(F.col("id").alias("unit"), (F.col("id") % 7 == 0).cast("int").alias("converted"))
    row = experiment.false_positive_rate(units, 500).first()
    assert row["replicates"] == 500
    assert 0.02 <= row["false_positive_rate"] <= 0.08


def _u_by_pairs(x, y):
    return sum((a > b) + 0.5 * (a == b) for a in x for b in y)


def test_mann_whitney_counts_pairs(spark):
    draw = random.Random(5)
    rows = []
    for group in ("a", "b"):
        rows += [(group, float(draw.randint(0, 30)), draw.random() < 0.4) for _ in range(120)]
    result = ranktests.mann_whitney(spark.createDataFrame(rows, "g string, v double, first boolean"), ["g"], "v", "first")
    for row in result.collect():
        x = [v for g, v, f in rows if g == row["g"] and f]
        y = [v for g, v, f in rows if g == row["g"] and not f]
        assert row["u"] == _u_by_pairs(x, y)
        n, pooled = len(x) + len(y), x + y
        ties = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
        spread = math.sqrt(len(x) * len(y) / 12 * (n + 1 - ties / (n * (n - 1))))
        z = (abs(row["u"] - len(x) * len(y) / 2) - 0.5) / spread
        assert row["p"] == pytest.approx(min(1.0, math.erfc(z / math.sqrt(2))), rel=1e-9)


def test_mann_whitney_small_samples_are_exact(spark):
    x, y = [1.0, 4.0, 9.0], [2.0, 3.0, 5.0, 6.0, 7.5]
    rows = [(v, True) for v in x] + [(v, False) for v in y]
    row = ranktests.mann_whitney(spark.createDataFrame(rows, "v double, first boolean").withColumn("g", F.lit(1)),
                                 ["g"], "v", "first").first()
    pooled = x + y
    us = [_u_by_pairs(c, [v for v in pooled if v not in c]) for c in itertools.combinations(pooled, 3)]
    top = max(row["u"], 15 - row["u"])
    assert row["p"] == pytest.approx(min(1.0, 2 * sum(u >= top for u in us) / len(us)))


def _signed_rank_by_enumeration(gaps):
    gaps = [g for g in gaps if g]
    sizes = sorted(abs(g) for g in gaps)
    ranks = [sizes.index(abs(g)) + 1 + (sizes.count(abs(g)) - 1) / 2 for g in gaps]
    plus = sum(r for r, g in zip(ranks, gaps) if g > 0)
    sums = [sum(r for r, s in zip(ranks, signs) if s) for signs in itertools.product((0, 1), repeat=len(gaps))]
    low, high = sum(s <= plus for s in sums), sum(s >= plus for s in sums)
    return min(1.0, 2 * min(low, high) / len(sums))


def test_signed_rank_equals_enumeration(spark):
    draw = random.Random(9)
    groups = {f"g{i}": [draw.randint(-4, 6) for _ in range(3 + i)] for i in range(8)}
    groups["zero"] = [0, 0, 0]
    rows = [(g, float(v), 0.0) for g, gaps in groups.items() for v in gaps]
    result = ranktests.signed_rank(spark.createDataFrame(rows, "g string, a double, b double"), ["g"], "a", "b")
    found = {r["g"]: r["p"] for r in result.collect()}
    for g, gaps in groups.items():
        assert found[g] == pytest.approx(_signed_rank_by_enumeration(gaps)), g


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=60))
def test_running_totals_do_not_depend_on_the_ranges(spark, values):
    counted = {v: values.count(v) for v in values}
    counts = spark.createDataFrame([("k", float(v), c) for v, c in counted.items()], "k string, v double, c long")
    rows = running_by_value(counts, ["k"], "v", ["c"], rows_per_range=4).collect()
    assert {(r["v"], r["c_before"]) for r in rows} == {
        (float(v), sum(c for w, c in counted.items() if w < v)) for v in counted}


def test_positions_are_a_permutation(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 3 == 0).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    placed = position_by_hash(rows, ["g"], "h", "id").collect()
    for g in (True, False):
        mine = sorted((r for r in placed if r["g"] == g), key=lambda r: r["h"])
        assert [r["position"] for r in mine] == list(range(len(mine)))


def test_two_sided_p_of_far_tails(spark):
    row = spark.range(1).select(two_sided_p(F.lit(18.6)).alias("p")).first()
    assert row["p"] == pytest.approx(math.erfc(18.6 / math.sqrt(2)), rel=1e-10)


def test_exact_u_equals_all_arrangements():
    for n1, n2 in [(1, 1), (1, 6), (3, 5), (4, 4), (5, 7)]:
        ways = [sum(chosen) - n1 * (n1 - 1) // 2 for chosen in itertools.combinations(range(n1 + n2), n1)]
        for u in range(n1 * n2 + 1):
            far = max(u, n1 * n2 - u)
            want = min(1.0, 2 * sum(w >= far for w in ways) / len(ways))
            assert ranktests._exact_u_p(u, n1, n2) == pytest.approx(want, abs=1e-12)


def test_the_branch_of_a_rank_test_is_reported(spark):
    rows = spark.range(40).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"), (F.col("id") < 3).alias("first"))
    assert ranktests.mann_whitney(rows, ["g"], "v", "first").first().exact
    assert not ranktests.mann_whitney(rows, ["g"], "v", "first", exact_cells=100).first().exact
