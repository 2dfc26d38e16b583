"""Rows and the scenarios (folds, or subsamples) that train or test on them, without a copy of the rows per scenario.

A placed table has one row per data row: row_id, label, features, and the names of the scenarios that train on it
(`trains`) and test on it (`tests`). Scenarios are listed by the caller and few; their rows are not bounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.operators import folds
from fathomline.session import collect_bounded

MAX_SCENARIOS, MAX_LABELS = 1_000, 1_000


def place(features: DataFrame, members: DataFrame, scenario: list[str]) -> DataFrame:
    """`features` (row_id, label, features) with the scenarios of `members` (scenario columns, row_id, is_test)."""
    name = F.to_json(F.struct(*scenario))
    roles = members.groupBy("row_id").agg(F.collect_set(F.when(~F.col("is_test"), name)).alias("trains"),
                                          F.collect_set(F.when(F.col("is_test"), name)).alias("tests"))
    return features.select("row_id", "label", "features").join(roles, "row_id")


def gather(rows: DataFrame, scenario: list[str]) -> DataFrame:
    """The placed form of a table that repeats every row (with the same label and features) per scenario."""
    features = rows.groupBy("row_id").agg(F.first("label").alias("label"), F.first("features").alias("features"))
    return place(features, rows, scenario)


def named(scenario_types: T.StructType) -> list[Column]:
    """The scenario columns again, from the column `scenario` with the name."""
    parsed = F.from_json("scenario", scenario_types)
    return [parsed.getField(c).alias(c) for c in scenario_types.names]


def types_of(members: DataFrame, scenario: list[str]) -> T.StructType:
    return T.StructType([members.schema[c] for c in scenario])


def train_shapes(placed: DataFrame) -> DataFrame:
    """Per scenario: rows, feature count and classes of its train rows."""
    return placed.select(F.explode("trains").alias("scenario"), "label", F.size("features").alias("size")).groupBy(
        "scenario").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("width"),
                        F.count_distinct("label").alias("classes"))


def fold_members(placed: DataFrame, n_folds: int = folds.FOLDS) -> DataFrame:
    """(row_id, repeat, fold, is_test) for every held-out fold, from the own fold of every row."""
    return placed.select("row_id", "repeat", F.col("fold").alias("own"),
                         F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias("fold")).select(
        "row_id", "repeat", "fold", (F.col("own") == F.col("fold")).alias("is_test"))


def curve_members(features: DataFrame, fractions: list[float], seeds: list[int]) -> DataFrame:
    """(row_id, fraction, seed, is_test): train subsamples of a fixed stratified hold-out, which tests every one."""
    split = folds.holdout_split(features)
    chosen = folds.stratified_subsamples(split.filter(~F.col("is_test")), fractions, seeds).select(
        "row_id", "fraction", "seed", F.lit(False).alias("is_test"))
    pairs = F.array(*[F.struct(F.lit(float(f)).alias("fraction"), F.lit(s).alias("seed"))
                      for f in fractions for s in seeds])
    tested = split.filter("is_test").select("row_id", F.explode(pairs).alias("s")).select(
        "row_id", "s.fraction", "s.seed", F.lit(True).alias("is_test"))
    return chosen.unionByName(tested)


def names_of(placed: DataFrame) -> tuple[str, ...]:
    """The scenarios of a placed table, in order of their name."""
    return tuple(sorted(r[0] for r in collect_bounded(
        placed.select(F.explode(F.concat("trains", "tests"))).distinct(), MAX_SCENARIOS, "scenarios")))


def labels_of(placed: DataFrame) -> tuple:
    return tuple(sorted(r[0] for r in collect_bounded(placed.select("label").distinct(), MAX_LABELS, "labels")))


def roles_of(batch: pa.RecordBatch, names: tuple[str, ...]) -> np.ndarray:
    """By row and scenario: 1 where the row trains it, 2 where it tests it, else 0."""
    roles, place = np.zeros((batch.num_rows, len(names)), np.uint8), {name: k for k, name in enumerate(names)}
    for name, role in (("trains", 1), ("tests", 2)):
        own = batch.column(name).flatten().dictionary_encode()
        columns = np.array([place[s] for s in own.dictionary.to_pylist()], np.int64)
        if len(own):
            roles[pc.list_parent_indices(batch.column(name)).to_numpy(), columns[own.indices.to_numpy()]] = role
    return roles
