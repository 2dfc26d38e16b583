"""Folds, hold-outs, neighbours and models: sizes, brute force, golden curves."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fathomline.operators import evaluation, folds, models, neighbours
from fathomline.plans import trainings


@pytest.fixture(scope="module")
def labelled(spark):
    """1797 rows; one label holds more than a third of them."""
    label = F.when(F.col("id") % 5 < 2, 0).otherwise(F.col("id") % 7)
    return spark.range(1797).select(F.col("id").alias("row_id"), label.cast("int").alias("label")).persist()


def test_folds_are_balanced_and_complete(labelled):
    rows = folds.stratified_folds(labelled).collect()
    assert len(rows) == 2 * 1797
    for repeat in (0, 1):
        mine = [r for r in rows if r["repeat"] == repeat]
        assert len({r["row_id"] for r in mine}) == 1797
        sizes = Counter((r["label"], r["fold"]) for r in mine)
        for label in {r["label"] for r in mine}:
            of_label = [sizes[label, f] for f in range(5)]
            assert max(of_label) - min(of_label) <= 1
    first = {r["row_id"]: r["fold"] for r in rows if r["repeat"] == 0}
    assert any(first[r["row_id"]] != r["fold"] for r in rows if r["repeat"] == 1)


def test_plain_folds_are_even(labelled):
    sizes = Counter(r["fold"] for r in folds.plain_folds(labelled, ["row_id"]).collect())
    assert sorted(sizes.values()) == [359, 359, 359, 360, 360]


def test_holdout_has_the_exact_size(labelled):
    rows = folds.holdout_split(labelled).collect()
    tested = [r for r in rows if r["is_test"]]
    assert (len(rows) - len(tested), len(tested)) == (1347, 450)
    share = Counter(r["label"] for r in tested)
    for label, n in Counter(r["label"] for r in rows).items():
        assert abs(share[label] - n * 450 / 1797) < 1


def test_subsamples_have_the_exact_sizes(labelled):
    sizes = Counter((r["fraction"], r["seed"]) for r in
                    folds.stratified_subsamples(labelled, [0.05, 0.5, 1.0], [42, 43]).collect())
    assert sizes == {(f, s): n for f, n in ((0.05, 89), (0.5, 898), (1.0, 1797)) for s in (42, 43)}


def test_neighbours_equal_brute_force_with_many_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 16)
    draw = np.random.default_rng(3)
    points = draw.normal(size=(240, 4)).round(1)
    points[::3] = points[0]
    rows = [(int(i), int(draw.integers(0, 3)), [float(x) for x in p], int(i) % 2, bool(draw.random() < 0.3))
            for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "row_id long, label int, features array<double>, part int, is_test boolean")
    found = {(r["part"], r["row_id"]): r["prediction"]
             for r in neighbours.knn_predict(frame, ["part"], 5).collect()}
    expected = {}
    for part in (0, 1):
        train = [r for r in rows if r[3] == part and not r[4]]
        values = np.array([r[2] for r in train])
        mean, std = values.mean(axis=0), values.std(axis=0)
        for row in (r for r in rows if r[3] == part and r[4]):
            apart = ((values - mean) / std - (np.array(row[2]) - mean) / std) ** 2
            order = sorted(range(len(train)), key=lambda i: (round(apart[i].sum(), 9), train[i][0]))[:5]
            votes = Counter(train[i][1] for i in order)
            expected[part, row[0]] = min(votes, key=lambda label: (-votes[label], label))
    assert found == expected


def test_fewer_train_rows_than_neighbours(spark):
    rows = [(0, 1, [0.0], False), (1, 1, [1.0], False), (2, 0, [5.0], False), (3, 0, [0.4], True)]
    frame = spark.createDataFrame(rows, "row_id long, label int, features array<double>, is_test boolean")
    assert neighbours.knn_predict(frame.withColumn("s", F.lit("x")), ["s"], 5).first()["prediction"] == 1


def test_published_curves_give_the_published_sizes(spark):
    sizes = {"digits": [67, 135, 337, 674, 1010, 1347], "breast_cancer": [21, 43, 106, 213, 320, 426]}
    curves = {
        ("digits", "LogReg"): [0.856, 0.8982, 0.9431, 0.9587, 0.9698, 0.9778],
        ("digits", "SVM-RBF"): [0.8236, 0.8827, 0.9476, 0.9676, 0.9769, 0.98],
        ("digits", "KNN"): [0.7782, 0.8507, 0.9191, 0.9502, 0.9613, 0.9644],
        ("digits", "RandomForest"): [0.8578, 0.8973, 0.9453, 0.9551, 0.9644, 0.9667],
        ("breast_cancer", "LogReg"): [0.9469, 0.9497, 0.9608, 0.9678, 0.9818, 0.986],
        ("breast_cancer", "SVM-RBF"): [0.9203, 0.9343, 0.9524, 0.9622, 0.9748, 0.979],
        ("breast_cancer", "KNN"): [0.9245, 0.9329, 0.9413, 0.9566, 0.9664, 0.979],
        ("breast_cancer", "RandomForest"): [0.9273, 0.9343, 0.9469, 0.9566, 0.9524, 0.958],
    }
    rows = [(d, m, s, v) for (d, m), means in curves.items() for s, v in zip(sizes[d], means)]
    found = evaluation.samples_to_reach(spark.createDataFrame(rows, "dataset string, model string, size int, mean double"))
    assert {(r["dataset"], r["model"]): r["samples"] for r in found.collect()} == {
        **{("digits", m): 1010 for m in ("LogReg", "SVM-RBF", "KNN", "RandomForest")},
        ("breast_cancer", "LogReg"): 320, ("breast_cancer", "SVM-RBF"): 320, ("breast_cancer", "KNN"): 426,
        ("breast_cancer", "RandomForest"): 213}


def test_published_means_give_the_published_pairs(spark):
    means = {
        "breast_cancer": {"LogReg": .9754, "SVM-RBF": .9763, "KNN": .9649, "RandomForest": .9561, "GBDT": .9543},
        "digits": {"LogReg": .9686, "SVM-RBF": .9825, "KNN": .9755, "RandomForest": .9794, "GBDT": .9627},
        "wine": {"LogReg": .9888, "SVM-RBF": .9833, "KNN": .9659, "RandomForest": .9829, "GBDT": .9328}}
    rows = [(d, m, v) for d, by_model in means.items() for m, v in by_model.items()]
    found = evaluation.model_pairs(spark.createDataFrame(rows, "dataset string, model string, score double"))
    assert {(r["dataset"], r["pair"]): (r["best"], r["other"]) for r in found.collect()} == {
        ("breast_cancer", "top2"): ("SVM-RBF", "LogReg"), ("breast_cancer", "best_vs_worst"): ("SVM-RBF", "GBDT"),
        ("digits", "top2"): ("SVM-RBF", "RandomForest"), ("digits", "best_vs_worst"): ("SVM-RBF", "GBDT"),
        ("wine", "top2"): ("LogReg", "SVM-RBF"), ("wine", "best_vs_worst"): ("LogReg", "GBDT")}


def test_regression_scores(spark):
    rows = [("m", 1.0, 1.5), ("m", 2.0, 1.5), ("m", 4.0, 3.0), ("base", 1.0, 3.0), ("base", 3.0, 1.0)]
    scores = evaluation.regression_scores(
        spark.createDataFrame(rows, "model string, target double, prediction double"), ["model"])
    found = {r["model"]: r for r in evaluation.gain_over_baseline(scores, "base").collect()}
    mean = 7 / 3
    total = (1 - mean) ** 2 + (2 - mean) ** 2 + (4 - mean) ** 2
    assert found["m"]["r2"] == pytest.approx(1 - 1.5 / total)
    assert found["m"]["mae"] == pytest.approx(2 / 3)
    assert found["base"]["r2"] == pytest.approx(-3.0)
    assert found["m"]["gain_pp"] == pytest.approx((1 - 1.5 / total + 3) * 100)


def test_box_summary(spark):
    rows = [("d", "m", x) for x in (0.1, 0.5, 0.52, 0.55, 0.6)]
    row = evaluation.box_summary(spark.createDataFrame(rows, "dataset string, model string, score double"),
                                 ["dataset", "model"]).first()
    assert (row["q1"], row["median"], row["q3"]) == (0.5, 0.52, 0.55)
    assert (row["low"], row["high"], row["outliers"]) == (0.5, 0.6, 1)


def test_fourier_features_approximate_the_kernel(spark):
    points = np.random.default_rng(1).normal(size=(6, 3))
    frame = spark.createDataFrame([([float(x) for x in p],) for p in points], "features array<double>").select(
        array_to_vector("features").alias("scaled"))
    stage = models.RandomFourierFeatures(inputCol="scaled", outputCol="out", width=3, gamma=0.3, count=8000)
    z = np.array([r["out"].toArray() for r in stage.transform(frame).select("out").collect()])
    distances = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-0.3 * distances)).max() < 0.06


def test_models_learn_separable_labels(spark):
    draw = np.random.default_rng(7)
    labels = draw.integers(0, 2, size=80)
    rows = [(i, int(y), [float(v) for v in draw.normal(loc=3 * y, scale=0.7, size=3)]) for i, y in enumerate(labels)]
    features = spark.createDataFrame(rows, "row_id long, label int, features array<double>")
    split = folds.holdout_split(features).drop("label").join(features, "row_id").withColumn("s", F.lit(1))
    scores = models.scenario_scores(split, ["s"], models.classifiers(trees=10, rounds=3)).collect()
    assert {r["model"] for r in scores} == {"LogReg", "SVM-RBF", "KNN", "RandomForest", "GBDT"}
    assert all(r["score"] >= 0.9 and r["train_rows"] == 60 for r in scores)


def test_out_of_fold_recovers_a_line(spark):
    months = spark.range(60).select(
        F.concat(F.lit("c"), (F.col("id") % 5).cast("string")).alias("city"),
        F.add_months(F.lit("2020-01-01").cast("date"), (F.col("id") / 5).cast("int")).alias("ym"),
        (F.col("id") % 11).cast("double").alias("tmean"), (F.col("id") % 3).cast("double").alias("precip"))
    month = F.month("ym")
    monthly = months.withColumns({
        "month": month, "month_sin": F.sin(month * math.pi / 6), "month_cos": F.cos(month * math.pi / 6),
        "pm25": 5 + 2 * F.col("tmean") - F.col("precip") + F.when(F.col("city") == "c3", 10).otherwise(0)})
    rows = folds.plain_folds(models.month_vectors(monthly), ["city", "ym"])
    linear = {"linear": models.regressors()["linear"]}
    predicted = models.out_of_fold(rows, linear)
    assert predicted.count() == 60
    assert evaluation.regression_scores(predicted, ["model"]).first()["r2"] > 0.999
    series = models.actual_and_predicted(predicted, "linear", ["c3"]).collect()
    assert [r["ym"] for r in series] == sorted(r["ym"] for r in series) and len(series) == 12


def test_multi_class_queries_compare_all_five_models(spark, monkeypatch):
    draw = np.random.default_rng(6)
    rows = [(i, i % 3, [float(x) for x in draw.normal(size=3) + 4 * (i % 3)]) for i in range(45)]
    features = spark.createDataFrame(rows, "row_id long, label int, features array<double>")
    every, cross_validation, compared = models.classifiers, models.cross_validation, []

    def recorded(features, chosen, dataset):
        compared.append(set(chosen))
        return cross_validation(features, chosen, dataset)

    monkeypatch.setattr(trainings.tables, "embedding_features", lambda spark, folder: features)
    monkeypatch.setattr(models, "classifiers", lambda: every(trees=2, rounds=1))
    monkeypatch.setattr(models, "cross_validation", recorded)
    scores = {r["model"]: r for r in trainings.embedding_bench(spark, "").collect()}
    assert set(scores) == {"LogReg", "SVM-RBF", "KNN", "RandomForest", "GBDT"}
    monkeypatch.setattr(models, "cross_validation", lambda features, chosen, dataset: compared.append(set(chosen)) or spark.createDataFrame(
        [(dataset, name, 0, fold, 0.5 + (name == "GBDT") / 4) for name in chosen for fold in range(5)],
        "dataset string, model string, repeat int, fold int, score double"))
    best = trainings.holdout_best(spark, "").collect()
    assert compared == [set(scores)] * 2 and {r["model"] for r in best} == {"GBDT"}
