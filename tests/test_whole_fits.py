"""Fits in tasks of their own: the same predictions as step by step, and no tree or step that passes the driver."""

from __future__ import annotations

import numpy as np
import pytest

from fathomline.operators import linear, trees, whole
from fathomline.sources import tables


def placed_of(spark, labels, points, kind="int"):
    rows = [(k, y, [float(v) for v in x], [f"s{j}" for j in (0, 1) if k % (j + 2)], [f"s{j}" for j in (0, 1) if not k % (j + 2)])
            for k, (y, x) in enumerate(zip(labels.tolist(), points))]
    return spark.createDataFrame(rows, f"row_id long, label {kind}, features array<double>, trains array<string>, tests array<string>").repartition(3)


def drawn(seed, classes, size=90, width=4):
    draw = np.random.default_rng(seed)
    labels = draw.integers(0, classes, size=size)
    return labels, draw.normal(size=(size, width)).round(1) + 0.7 * labels[:, None]


@pytest.mark.parametrize("classes, size, growth", [(2, 3000, trees.Growth(20, drawn=2)), (5, 4000, trees.Growth(20, drawn=3)),
                                                   (3, 700, trees.Growth(6, least=4)), (2, 50, trees.Growth(1)), (4, 300, trees.Growth(20, drawn=1))])
def test_trees_level_by_level_equal_those_node_by_node(classes, size, growth):
    draw = np.random.default_rng(size)
    x = draw.integers(0, 200, size=(size, 6)).astype(np.uint8)
    y = (x[:, 0] // 50 + draw.integers(0, 2, size=size)) % classes
    weight = 1.0 + draw.poisson(1, size=size)
    stats = np.concatenate([weight[:, None], weight[:, None] * np.eye(classes)[y]], axis=1)
    for unit in range(3):
        one = trees.grow_here(x, stats, growth, unit, classes).tree(growth, lambda s: s[1:] / s[0])
        level = trees.grow_labels(x, y, weight, classes, growth, unit)
        assert len(one.feature) == len(level.feature) and np.array_equal(one.values(x), level.values(x))


def test_fits_in_tasks_equal_those_in_steps(spark, monkeypatch):
    found = {}
    for room in (whole.TASK_BYTES, 0):
        monkeypatch.setattr(whole, "TASK_BYTES", room)
        for classes in (2, 4):
            placed = placed_of(spark, *drawn(classes, classes))
            for name, fit in (("logistic", linear.logistic_predictions), ("kernel", lambda p: linear.kernel_predictions(p, 8)),
                              ("forest", lambda p: trees.forest_predictions(trees.matrix(p), 7, trees.Growth(5, drawn=2))),
                              ("boosted", lambda p: trees.boosted_predictions(trees.matrix(p), 4, 0.3, trees.Growth(2)))):
                found.setdefault((name, classes), []).append(sorted(map(tuple, fit(placed).collect())))
        labels, points = drawn(9, 3)
        data = trees.matrix(placed_of(spark, labels * 2.5, points, "double"), numeric=True)
        found.setdefault("numeric", []).append(sorted(map(tuple, trees.forest_predictions(data, 5, trees.Growth(4, least=2)).collect())))
    for name, (tasks, steps) in found.items():
        assert len(tasks) == len(steps) == 45 + 30, name
        assert [r[:3] for r in tasks] == [r[:3] for r in steps] and [r[3] for r in tasks] == pytest.approx([r[3] for r in steps], abs=1e-6), name


def test_forests_and_rounds_pass_the_driver_by(spark, monkeypatch):
    def on_the_driver(*_):
        raise AssertionError("grown step by step")

    data = trees.matrix(placed_of(spark, *drawn(1, 3)))
    monkeypatch.setattr(trees, "grow", on_the_driver)
    monkeypatch.setattr(linear, "minimise_together", on_the_driver)
    for predicted in (trees.forest_predictions(data, 6, trees.Growth(20, drawn=2)), trees.boosted_predictions(data, 3, 0.1, trees.Growth(2)),
                      linear.logistic_predictions(placed_of(spark, *drawn(1, 3)))):
        assert predicted.count() == 45 + 30


def test_the_driver_holds_few_trees_of_a_larger_forest(spark, monkeypatch):
    grown, nodes = trees.grow, []

    def counted(*arguments):
        found = grown(*arguments)
        nodes.append(sum(len(s.feature) for s in found.values()))
        return found

    data = trees.matrix(placed_of(spark, *drawn(2, 2)))
    growth = trees.Growth(3)
    whole_forest = sorted(map(tuple, trees.forest_predictions(data, 5, growth).collect()))
    monkeypatch.setattr(whole, "TASK_BYTES", 0)
    monkeypatch.setattr(trees, "NODES_HELD", 60)
    monkeypatch.setattr(trees, "grow", counted)
    assert sorted(map(tuple, trees.forest_predictions(data, 5, growth).collect())) == whole_forest
    assert len(nodes) > 2 and max(nodes) <= 2 * 60


def test_units_are_dealt_by_work():
    groups = whole.dealt([1.0, 3.0, 0.0], 10, 8)
    assert sorted((s, k) for s, first, count in groups for k in range(first, first + count)) == [(s, k) for s in range(3) for k in range(10)]
    assert sum(s == 1 for s, _, _ in groups) == 6 and sum(s == 0 for s, _, _ in groups) == 2


def test_equal_ids_come_in_the_order_of_their_values():
    x, y = np.array([[3], [1], [2], [9]], np.uint8), np.array([0.0, 1.0, 0.0, 0.0])
    order = whole._order(np.array([5, 5, 5, 1]), x, np.ones(4, np.uint8), y)
    assert order.tolist() == [3, 2, 0, 1]


def test_counts_of_characters_are_those_of_each_character(spark, tmp_path):
    texts = ["", "Ab1, ß9!\n\n x\U0001f600?", "  ", "ÄÖ..::\t中文 12٣", "word", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, k % 2) for k in range(6)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r["row_id"]: r["features"] for r in tables.quality_features(spark, str(tmp_path)).collect()}
    for k, text in enumerate(texts[:5]):
        n, rest = len(text), sum(not (c.isalpha() or c.isnumeric() or c in " \t\n") for c in text)
        kinds = [sum(c in held for c in text) for held in (".,;:!?", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")]
        words = found[k][1]
        expected = [n, words, n / words, *[v / n if n else 0.0 for v in kinds], text.count("\n") / words, rest / n if n else 0.0]
        assert found[k] == pytest.approx(expected)
    assert found[5][0] == found[5][7] == 0.0
