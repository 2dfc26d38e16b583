"""Trees, linear and kernel models that are fitted together: brute force, and the same results on every path."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.operators import linear, models, neighbours, scenarios, trees
from fathomline.operators import folds


def placed_of(spark, labels, points, tested=lambda k: [k % 3 == 0, k % 2 == 0]):
    """Two scenarios; a row tests those that `tested` names and trains the others."""
    rows = []
    for k, (y, x) in enumerate(zip(labels, points)):
        marks = tested(k)
        rows.append((k, y.item() if hasattr(y, "item") else y, [float(v) for v in x], [f"s{j}" for j, t in enumerate(marks) if not t],
                     [f"s{j}" for j, t in enumerate(marks) if t]))
    kind = "double" if isinstance(rows[0][1], float) else "int"
    return spark.createDataFrame(rows, f"row_id long, label {kind}, features array<double>, trains array<string>, tests array<string>").repartition(3)


def brute_tree(x, y, least, depth, leaves):
    """Best-first regression tree on whole-number features: predictions of its rows."""
    def best(rows):
        found = (0.0, None)
        for j in range(x.shape[1]):
            for cut in np.unique(x[rows, j])[:-1]:
                a, b = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                if min(len(a), len(b)) >= least:
                    gain = y[a].sum() ** 2 / len(a) + y[b].sum() ** 2 / len(b) - y[rows].sum() ** 2 / len(rows)
                    if gain > found[0] + 1e-6:
                        found = (gain, (a, b))
        return found

    nodes = [(np.arange(len(y)), 0)]
    while len(nodes) < leaves:
        tries = [(best(rows) if d < depth else (0.0, None)) for rows, d in nodes]
        at = int(np.argmax([g for g, _ in tries]))
        if tries[at][1] is None:
            break
        (a, b), d = tries[at][1], nodes[at][1]
        nodes[at:at + 1] = [(a, d + 1), (b, d + 1)]
    predicted = np.zeros(len(y))
    for rows, _ in nodes:
        predicted[rows] = y[rows].mean()
    return predicted


@pytest.mark.parametrize("growth", [trees.Growth(60, 7, 3), trees.Growth(60, 31, 2), trees.Growth(3, None, 1), trees.Growth(60, 2, 1)])
def test_a_tree_equals_brute_force(growth):
    draw = np.random.default_rng(4)
    x = draw.integers(0, 9, size=(90, 4)).astype(np.uint8)
    y = draw.integers(-40, 40, size=90).astype(float) + 30 * (x[:, 1] > 4)
    grown = trees.grow_here(x, np.stack([np.ones(90), y], axis=1), growth, 0, 1)
    tree = grown.tree(growth, lambda s: s[1] / s[0])
    assert (tree.feature == -1).sum() <= (growth.leaves or 8)
    expected = brute_tree(x, y, growth.least, growth.depth, growth.leaves or 1000)
    assert np.allclose(tree.values(x)[:, 0], expected, atol=1e-4)


@pytest.mark.parametrize("numeric", [True, False])
def test_histograms_and_single_tasks_grow_the_same_trees(spark, monkeypatch, numeric):
    draw = np.random.default_rng(9)
    points = draw.integers(0, 30, size=(150, 5))
    labels = (points[:, 0] * 3 + points[:, 2]).astype(float) if numeric else (points[:, 0] // 8 + points[:, 1] // 16).astype(int)
    data = trees.matrix(placed_of(spark, labels, points), numeric=numeric)
    jobs = [(trees.Bootstraps(2, 3, len(data.labels)), trees.Growth(6, drawn=3)),
            (trees.Bootstraps(2, 2, len(data.labels)), trees.Growth(60, leaves=9, least=4))]
    for job, growth in jobs:
        grown = []
        for small, room in ((10_000, 1 << 28), (0, 1 << 28), (25, 1 << 15)):
            monkeypatch.setattr(trees, "HISTOGRAM_BYTES", room)
            found = trees.grow(data, data.rows, job, growth, small)
            grown.append({u: [a.tolist() for a in s.tree(growth, lambda v: v[1:] / v[0]).__dict__.values()] for u, s in found.items()})
        assert grown[0] == grown[1] == grown[2] and len(grown[0]) == len(job.units)


def test_boosting_on_both_paths_and_over_written_scores(spark, monkeypatch):
    draw = np.random.default_rng(2)
    labels = draw.integers(0, 3, size=120)
    points = draw.normal(size=(120, 3)).round(1) + 2 * labels[:, None]
    data = trees.matrix(placed_of(spark, labels, points))
    found = []
    for small, kept in ((10_000, 10), (0, 2)):
        monkeypatch.setattr(trees, "SMALL_ROWS", small)
        monkeypatch.setattr(trees, "ROUNDS_KEPT", kept)
        found.append(sorted(map(tuple, trees.boosted_predictions(data, 5, 0.3, trees.Growth(3)).collect())))
    assert found[0] == found[1] and len(found[0]) == 40 + 60
    assert np.mean([label == p for _, _, label, p in found[0]]) > 0.8


def test_boosted_squares_come_near_the_target(spark):
    draw = np.random.default_rng(1)
    points = draw.uniform(0, 10, size=(300, 3))
    labels = np.sin(points[:, 0]) * 5 + points[:, 1]
    data = trees.matrix(placed_of(spark, labels, points), numeric=True)
    rows = trees.boosted_predictions(data, 40, 0.1, trees.Growth(60, leaves=15, least=5)).collect()
    apart = np.array([(r["label"] - r["prediction"]) ** 2 for r in rows])
    assert len(rows) == 250 and apart.mean() < 0.2 * labels.var()


def test_logistic_weights_are_the_minimum(spark):
    draw = np.random.default_rng(3)
    labels = draw.integers(0, 3, size=90)
    points = draw.normal(size=(90, 2)) * [1, 50] + labels[:, None] * [1, 30]
    found = {(r["scenario"], r["row_id"]): r["prediction"] for r in linear.logistic_predictions(placed_of(spark, labels, points)).collect()}
    for s, test in enumerate((np.arange(90) % 3 == 0, np.arange(90) % 2 == 0)):
        x, y = points[~test], labels[~test]
        z = (x - x.mean(axis=0)) / x.std(axis=0)
        z1, w = np.column_stack([z, np.ones(len(z))]), np.zeros((3, 3))
        for _ in range(20_000):  # plain gradient descent on the same loss
            e = np.exp(z1 @ w - (z1 @ w).max(axis=1, keepdims=True))
            d = z1.T @ (e / e.sum(axis=1, keepdims=True) - np.eye(3)[y])
            d[:-1] += w[:-1]
            w -= 0.02 * d
        own = np.column_stack([(points[test] - x.mean(axis=0)) / x.std(axis=0), np.ones(test.sum())]) @ w
        sure = np.sort(own, axis=1)[:, -1] - np.sort(own, axis=1)[:, -2] > 1e-2
        expected = dict(zip(np.flatnonzero(test)[sure].tolist(), own.argmax(axis=1)[sure].tolist()))
        assert {k: found[f"s{s}", k] for k in expected} == expected and len(expected) > 20


def test_kernel_classifier_learns_rings_like_an_exact_one(spark):
    draw = np.random.default_rng(5)
    labels = np.arange(160) % 3
    angle = draw.uniform(0, 2 * np.pi, size=160)
    radius = 1 + 2 * labels + draw.normal(scale=0.35, size=160)
    points = np.column_stack([radius * np.cos(angle), radius * np.sin(angle)])
    placed = placed_of(spark, labels, points, lambda k: [k % 4 == 0])
    test = np.arange(160) % 4 == 0
    x, y = points[~test], labels[~test]
    mean, std = x.mean(axis=0), x.std(axis=0)
    kernel = lambda a, b: np.exp(-((a[:, None] - b[None]) ** 2).sum(axis=2) / 2)
    k, own = kernel((x - mean) / std, (x - mean) / std), kernel((points[test] - mean) / std, (x - mean) / std)
    votes = np.zeros((test.sum(), 3))
    for a in range(3):
        for b in range(a + 1, 3):
            pair = np.flatnonzero((y == a) | (y == b))
            t, alpha, bias = np.where(y[pair] == a, 1.0, -1.0), np.zeros(len(pair)), 0.0
            for _ in range(4_000):  # the exact kernel machine in its dual coefficients
                f = k[np.ix_(pair, pair)] @ alpha + bias
                short = np.maximum(1 - t * f, 0) * t
                alpha -= 0.05 * (alpha - 2 * short)
                bias += 0.002 * short.sum()
            f = own[:, pair] @ alpha + bias
            votes[:, a] += f > 0
            votes[:, b] += f <= 0
    exact = (votes.argmax(axis=1) == labels[test]).mean()
    found = linear.kernel_predictions(placed).collect()
    ours = np.mean([r["label"] == r["prediction"] for r in found])
    assert len(found) == 40 and ours > 0.9 and abs(ours - exact) <= 0.05


def test_least_squares_is_the_shortest_exact_solution(spark):
    draw = np.random.default_rng(6)
    city = draw.integers(0, 4, size=60)
    points = np.column_stack([draw.normal(size=60) * 1e-3, draw.normal(size=60) * 1e4 + 1e6, np.eye(4)[city], np.full(60, 7.0)])
    target = points[:, 0] * 500 + points[:, 1] * 1e-4 + city + draw.normal(size=60)
    found = {(r["scenario"], r["row_id"]): r["prediction"] for r in
             linear.least_squares_predictions(placed_of(spark, target, points)).collect()}
    for s, test in enumerate((np.arange(60) % 3 == 0, np.arange(60) % 2 == 0)):
        mean = points[~test].mean(axis=0)
        w = np.linalg.lstsq(points[~test] - mean, target[~test] - target[~test].mean(), rcond=None)[0]
        for k in np.flatnonzero(test):
            assert found[f"s{s}", int(k)] == pytest.approx(target[~test].mean() + (points[k] - mean) @ w, rel=1e-7)
    assert len(found) == 20 + 30


def test_sums_of_many_partitions_equal_those_of_few(spark, monkeypatch):
    draw = np.random.default_rng(8)
    labels = draw.integers(0, 2, size=60)
    placed = placed_of(spark, labels, draw.normal(size=(60, 3)) + labels[:, None])
    few = sorted(map(tuple, linear.logistic_predictions(placed).collect()))
    monkeypatch.setattr(linear, "PARTIALS", 0)
    assert sorted(map(tuple, linear.logistic_predictions(placed).collect())) == few


def test_ten_classes_with_all_five_models(spark):
    draw = np.random.default_rng(7)
    labels = np.arange(200) % 10
    centres = draw.normal(size=(10, 6)) * 4
    features = spark.createDataFrame(
        [(k, int(y), [float(v) for v in centres[y] + draw.normal(size=6)]) for k, y in enumerate(labels)],
        "row_id long, label int, features array<double>")
    chosen = models.classifiers(trees=30, rounds=15)
    scores = models.cross_validation(features, chosen, "ten").groupBy("model").agg(F.avg("score").alias("mean"), F.count("*").alias("n")).collect()
    assert {r["model"] for r in scores} == set(chosen) and {r["n"] for r in scores} == {10}
    assert all(r["mean"] > 0.8 for r in scores)
    predicted = models.holdout_best(features, chosen, "ten").collect()
    assert len(predicted) == 50 and np.mean([r["label"] == r["prediction"] for r in predicted]) > 0.8


def test_scenarios_fitted_together_are_those_fitted_alone(spark):
    draw = np.random.default_rng(11)
    labels = draw.integers(0, 3, size=100)
    features = spark.createDataFrame([(k, int(y), [float(v) for v in draw.normal(size=3) + y]) for k, y in enumerate(labels)],
                                     "row_id long, label int, features array<double>")
    members = scenarios.fold_members(folds.stratified_folds(features, repeats=1))
    together = models.classifiers(trees=4, rounds=4)["GBDT"](scenarios.place(features, members, ["fold"]))
    one = members.filter("fold = 2")
    alone = models.classifiers(trees=4, rounds=4)["GBDT"](scenarios.place(features, one, ["fold"]))
    expected = {(r["row_id"], r["prediction"]) for r in alone.collect()}
    assert {(r["row_id"], r["prediction"]) for r in together.filter("scenario like '%2%'").collect()} == expected and len(expected) == 20


def test_neighbours_in_blocks_equal_plain_distances():
    draw = np.random.default_rng(12)
    for spread in ([1, 1, 1], [30, 1, 0.01]):
        trains, tests = (draw.normal(size=(n, 3)).round(1) * spread for n in (230, 61))
        trains[::5] = trains[0]
        i, j, squared, compared = neighbours._closest(tests, trains, 5, 16)
        apart = np.round(((tests[:, None] - trains[None]) ** 2).sum(axis=2), neighbours.DISTANCE_DIGITS)
        expected = np.argsort(apart, axis=1, kind="stable")[:, :5]
        rank = np.lexsort((j, squared, i))
        assert (i[rank] == np.repeat(np.arange(61), 5)).all() and (j[rank].reshape(61, 5) == expected).all()
        assert compared <= trains.shape[0] * len(tests)
    assert compared < 0.5 * trains.shape[0] * len(tests)
    few = neighbours._closest(tests[:3], trains[:2], 5, 16)
    assert len(few[0]) == 6


def test_rows_travel_once_for_each_part_of_the_other_side(spark):
    draw = np.random.default_rng(13)
    labels = draw.integers(0, 2, size=128)
    placed = placed_of(spark, labels, draw.normal(size=(128, 2)))
    count = neighbours.PairCount(spark)
    assert len(neighbours.nearest_rows(placed, 3, 8, count).collect()) == 3 * (43 + 64)
    assert count.met.value == 43 * 85 + 64 * 64 and 0 < count.share <= 1


def test_tiles_get_a_flag_for_each_scenario(spark):
    placed = placed_of(spark, [0, 1] * 10, np.arange(40.0).reshape(20, 2))
    near = neighbours.nearest_rows(placed, 1)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "array_contains(trains#" in plan and "scenario string, row_id" not in plan
    names = {name for r in placed.collect() for name in r["tests"]}
    assert {r["scenario"] for r in near.collect()} == names


def test_exact_quantiles_of_a_large_group(spark, monkeypatch):
    from fathomline.operators import evaluation, ranks
    monkeypatch.setattr(ranks, "ROWS_PER_RANGE", 10_000)
    monkeypatch.setattr(ranks.running_by_value, "__defaults__", (10_000,))
    n = 500_000
    large = spark.range(n).select(F.lit("a").alias("g"), ((F.col("id") * 7919) % n / 1000).alias("v"))
    small = spark.createDataFrame([("b", 1.0), ("b", 4.0), ("b", None), ("c", 2.0), ("c", 2.0), ("c", 9.0)], "g string, v double")
    shares = [0.0, 0.1, 0.25, 0.5, 1.0]
    found = {r["g"]: r["q"] for r in evaluation.exact_quantiles(large.unionByName(small), ["g"], "v", shares).collect()}
    assert found["a"] == pytest.approx([q * (n - 1) / 1000 for q in shares], abs=1e-9)
    assert found["b"] == pytest.approx([1.0, 1.3, 1.75, 2.5, 4.0]) and found["c"] == pytest.approx([2.0, 2.0, 2.0, 2.0, 9.0])
