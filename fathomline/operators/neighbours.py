"""Exact k-nearest-neighbour classification on a grid of tiles.

With P times a thousand rows, test and train rows are dealt by a hash into sqrt(P) parts each, and a tile compares one
part of either side for all scenarios that use them: each row travels at most sqrt(P) times as a test and as a train row.
In a tile, rows lie in order of the leading principal component of the train rows. Blocks of them are met from near to
far, and a block is left out once its distance along that component alone exceeds the k-th distance found; of the
others, only pairs that are near enough in the leading components are compared in full. Both are lower bounds, so no
neighbour is missed. A tile emits the k nearest of each of its test rows only.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.operators import scenarios
from fathomline.session import cut_lineage

NEIGHBOURS = 5
TILE_ROWS = 1024
# Squared distances are compared at this many decimals, so that equal rows tie exactly.
DISTANCE_DIGITS = 9
# Relative and absolute allowance on a proposed distance: covers its rounding, so that no neighbour is missed.
SLACK = 2e-9
ELEMENTS_AT_ONCE = 1_000_000
# Leading components whose distance is a first bound, and the share of a block that may pass it and still go pair by pair.
LEADING, FEW_PAIRS = 8, 0.1


def scaling(placed: DataFrame) -> DataFrame:
    """Mean and population deviation of every feature of a scenario's train rows; constant features scale by 1."""
    metrics = Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("features")).alias("m")
    moments = placed.select(F.explode("trains").alias("scenario"), "features").groupBy("scenario").agg(metrics)
    n = F.col("m.count")
    shrink = F.when(n > 1, (n - 1) / n).otherwise(0.0)
    stds = F.transform(vector_to_array("m.variance"), lambda v: F.when(v > 0, F.sqrt(v * shrink)).otherwise(1.0))
    return moments.select("scenario", vector_to_array("m.mean").alias("means"), stds.alias("stds"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def _apart(tests: np.ndarray, trains: np.ndarray) -> np.ndarray:
    return (tests ** 2).sum(axis=1)[:, None] + (trains ** 2).sum(axis=1)[None, :] - 2 * tests @ trains.T


def _leading_components(rows: np.ndarray) -> np.ndarray:
    """Orthonormal columns along which the rows vary most; distances along them are never longer than the whole ones."""
    centred = rows - rows.mean(axis=0)
    return np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :LEADING]


def _closest(tests: np.ndarray, trains: np.ndarray, k: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Row of the test, row of the train and squared distance of the k nearest, and the number of pairs compared in full.

    Equal distances go in train order. Work is in blocks of at most `block` rows of either side.
    """
    basis = _leading_components(trains)
    near_tests, near_trains = tests @ basis, trains @ basis
    order = np.argsort(near_trains[:, 0], kind="stable")
    slack = SLACK * (1 + (tests ** 2).sum(axis=1) + (trains ** 2).sum(axis=1).max())
    blocks = [order[at:at + block] for at in range(0, len(order), block)]
    ends = np.array([near_trains[rows[[0, -1]], 0] for rows in blocks])
    found, compared, test_order = [], 0, np.argsort(near_tests[:, 0], kind="stable")
    for at in range(0, len(tests), block):
        mine = test_order[at:at + block]
        low, high = near_tests[mine[0], 0], near_tests[mine[-1], 0]
        gaps = np.maximum(0, np.maximum(ends[:, 0] - high, low - ends[:, 1])) ** 2
        limit = np.full(len(mine), np.inf)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for b in np.argsort(gaps, kind="stable"):
            if gaps[b] > (limit + slack[mine]).max():
                break
            theirs = blocks[b]
            passed = _apart(near_tests[mine], near_trains[theirs]) <= (limit + slack[mine])[:, None]
            if passed.mean() > FEW_PAIRS:
                proposed = _apart(tests[mine], trains[theirs])
                compared += proposed.size
                wanted = min(k, len(theirs))
                top = np.minimum(limit, np.partition(proposed, wanted - 1, axis=1)[:, wanted - 1] if wanted == k else np.inf)
                passed = proposed <= (top + slack[mine])[:, None]
            else:
                compared += int(passed.sum())
            i, j = np.nonzero(passed)
            step = max(1, ELEMENTS_AT_ONCE // max(1, tests.shape[1]))
            squared = np.concatenate([np.zeros(0)] + [
                ((tests[mine[i[p:p + step]]] - trains[theirs[j[p:p + step]]]) ** 2).sum(axis=1) for p in range(0, len(i), step)])
            i, j, squared = (np.concatenate(x) for x in zip(best, (i, theirs[j], np.round(squared, DISTANCE_DIGITS))))
            rank = np.lexsort((j, squared, i))
            i, j, squared = i[rank], j[rank], squared[rank]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            limit[i[place == k - 1]] = squared[place == k - 1]
            best = tuple(x[place < k] for x in (i, j, squared))
        found.append((mine[best[0]], best[1], best[2]))
    return *(np.concatenate(x) for x in zip(*found)), compared


class PairCount:
    """Pairs of a test and a train row of a scenario that tiles met, and how many of them they compared in full."""

    def __init__(self, spark: SparkSession):
        self.met, self.compared = (spark.sparkContext.accumulator(0) for _ in range(2))

    @property
    def share(self) -> float:
        return self.compared.value / max(1, self.met.value)


def nearest_rows(placed: DataFrame, k: int = NEIGHBOURS, tile_rows: int | None = None, count: PairCount | None = None) -> DataFrame:
    """The k nearest train rows of every test row in every scenario: scenario, row_id, label, candidate, place.

    `count` is filled when the result is computed (again for every repeated task).

    `placed` is a table of `scenarios.place`. Features are scaled with the train rows of the scenario. Train rows at
    the same distance come in the order of their row_id. A scenario without train rows finds nothing.
    """
    placed = cut_lineage(placed)
    scales = placed.sparkSession.sparkContext.broadcast(  # one row per scenario, and those the caller lists
        {r["scenario"]: (np.array(r["means"]), np.array(r["stds"])) for r in scaling(placed).collect()})
    names = sorted(scales.value)
    block = tile_rows or TILE_ROWS
    parts = math.ceil(math.sqrt(1 + placed.count() // block))
    own, every = F.pmod(F.xxhash64("row_id"), F.lit(parts)), F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    def flags(listed: str):
        """A byte for each scenario: the lists of names would outweigh the features in the shuffle and in a tile."""
        return F.array(*[F.array_contains(listed, name) for name in names]).cast("array<boolean>").alias(listed)

    tests = placed.filter(F.size("tests") > 0).select(
        own.alias("test_part"), every.alias("train_part"), "row_id", "label", "features", flags("tests"))
    trains = placed.filter(F.size("trains") > 0).select(
        every.alias("test_part"), own.alias("train_part"), "row_id", "label", "features", flags("trains"))

    def best_of_tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"scenario": pd.Series(dtype="int32"), "row_id": pd.Series(dtype="int64"),
                               "label": pd.Series(dtype="int32"), "train_id": pd.Series(dtype="int64"),
                               "candidate": pd.Series(dtype="int32"), "squared": pd.Series(dtype="float64")})]
        if not len(left) or not len(right):
            return found[0]
        right = right.sort_values("row_id", kind="stable")
        test_values, train_values = _matrix(left["features"]), _matrix(right["features"])
        in_test, in_train = np.stack(left["tests"].to_numpy()), np.stack(right["trains"].to_numpy())
        left, right = left[["row_id", "label"]], right[["row_id", "label"]]
        for number, name in enumerate(names):
            means, stds = scales.value[name]
            tested, trained = np.flatnonzero(in_test[:, number]), np.flatnonzero(in_train[:, number])
            if len(tested) and len(trained):
                test_at, train_at, squared, compared = _closest(
                    (test_values[tested] - means) / stds, (train_values[trained] - means) / stds, k, block)
                if count is not None:
                    count.met.add(len(tested) * len(trained))
                    count.compared.add(compared)
                mine, theirs = left.iloc[tested[test_at]], right.iloc[trained[train_at]]
                found.append(pd.DataFrame({
                    "scenario": np.int32(number), "row_id": mine["row_id"].to_numpy(), "label": mine["label"].to_numpy(),
                    "train_id": theirs["row_id"].to_numpy(), "candidate": theirs["label"].to_numpy(),
                    "squared": squared}))
        return pd.concat(found[1:] or found)

    tile = ["test_part", "train_part"]
    best = tests.groupBy(*tile).cogroup(trains.groupBy(*tile)).applyInPandas(
        best_of_tile, "scenario int, row_id long, label int, train_id long, candidate int, squared double")
    closest = Window.partitionBy("scenario", "row_id").orderBy("squared", "train_id")
    nearest = best.withColumn("place", F.row_number().over(closest)).filter(F.col("place") <= k)
    named = F.get(F.array(*[F.lit(name) for name in names]).cast("array<string>"), F.col("scenario"))
    return nearest.withColumn("scenario", named)


def predict_each(placed: DataFrame, scenario_types: T.StructType, counts: list[int]) -> DataFrame:
    """Majority label of the k nearest train rows for several k, found in one search.

    Result: scenario columns, row_id, label, k, prediction. Ties between labels go to the smaller label.
    """
    near = nearest_rows(placed, max(counts))
    used = F.explode(F.filter(F.array(*[F.lit(k) for k in counts]), lambda k: k >= F.col("place"))).alias("k")
    row = ["scenario", "row_id", "label", "k"]
    votes = near.select("scenario", "row_id", "label", used, "candidate").groupBy(*row, "candidate").agg(
        F.count(F.lit(1)).alias("votes"))
    winner = votes.groupBy(*row).agg(F.min_by("candidate", F.struct(-F.col("votes"), "candidate")).alias("prediction"))
    return winner.select(*scenarios.named(scenario_types), "row_id", "label", "k", "prediction")


def knn_predict(rows: DataFrame, scenario: list[str], k: int = NEIGHBOURS) -> DataFrame:
    """Majority label of the k nearest train rows for a table that repeats its rows per scenario.

    `rows` has the scenario columns, row_id, label, features and is_test.
    """
    return predict_each(scenarios.gather(rows, scenario), scenarios.types_of(rows, scenario), [k]).drop("k")
