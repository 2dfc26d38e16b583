"""Training and comparison of models on shared folds.

A model fits all scenarios (folds, subsamples) together: its jobs don't grow with their number. Models run side by side
from driver threads; the driver receives one score per fit and no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.operators import evaluation, folds, linear, neighbours, scenarios
from fathomline.operators import trees as tree
from fathomline.session import cut_lineage

SEED = 42
# Model settings.
BENCH_TREES, CURVE_TREES, REGRESSION_TREES = 300, 200, 300
BOOST_ROUNDS, BOOST_DEPTH, BOOST_RATE = 100, 3, 0.1
REGRESSION_ROUNDS, REGRESSION_LEAVES, REGRESSION_LEAF = 200, 31, 20
# Depths that stand for none.
FOREST_DEPTH, REGRESSION_DEPTH = 20, 60
FOURIER_FEATURES = 256
KNN = "KNN"
FITS_AT_ONCE = 8


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Random cosine features whose inner products approximate an RBF kernel (Rahimi and Recht, 2007)."""

    width = Param(Params._dummy(), "width", "length of the input vectors", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "inverse scale of the kernel", TypeConverters.toFloat)
    count = Param(Params._dummy(), "count", "number of features drawn", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol: str = "features", outputCol: str = "fourier", width: int = 1, gamma: float = 1.0,
                 count: int = FOURIER_FEATURES, seed: int = SEED):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, width=width, gamma=gamma, count=count, seed=seed)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # Redrawn from the parameters alone, so that a saved and loaded stage is the same.
        width, gamma, count, seed = (self.getOrDefault(p) for p in (self.width, self.gamma, self.count, self.seed))
        draws = np.random.default_rng(seed)
        directions = draws.normal(scale=math.sqrt(2 * gamma), size=(width, count))
        offsets = draws.uniform(0, 2 * math.pi, size=count)
        scale = math.sqrt(2 / len(offsets))

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def cosines(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype="object")
            return pd.Series(list(scale * np.cos(np.stack(vectors.to_numpy()) @ directions + offsets)))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(cosines(vector_to_array(self.getInputCol()))))


def classifiers(trees: int = BENCH_TREES, rounds: int = BOOST_ROUNDS) -> dict[str, Callable[[DataFrame], DataFrame] | None]:
    """Model name to a function from a placed table to scenario, row_id, label and prediction of its test rows.

    Each fits all scenarios together. The neighbour model has no fit.
    """
    def forest(placed: DataFrame) -> DataFrame:
        data = tree.matrix(placed)
        drawn = max(1, int(math.sqrt(data.features)))
        return tree.forest_predictions(data, trees, tree.Growth(FOREST_DEPTH, drawn=drawn, seed=SEED))

    def boosted(placed: DataFrame) -> DataFrame:
        return tree.boosted_predictions(tree.matrix(placed), rounds, BOOST_RATE, tree.Growth(BOOST_DEPTH, seed=SEED))

    return {"LogReg": linear.logistic_predictions, "SVM-RBF": linear.kernel_predictions, KNN: None, "RandomForest": forest,
            "GBDT": boosted}


def in_parallel(tasks: Iterable[Callable], spark: SparkSession, at_once: int = FITS_AT_ONCE) -> list:
    """Run driver-side functions that each submit Spark jobs, a few at a time, in order of the results."""
    with ThreadPool(at_once) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda task: task()), list(tasks), chunksize=1)


def scenario_scores(rows: DataFrame, scenario: list[str], models: dict[str, Callable | None]) -> DataFrame:
    """`placed_scores` for a table that repeats its rows per scenario: scenario columns, row_id, label, features, is_test."""
    return placed_scores(scenarios.gather(rows, scenario), scenarios.types_of(rows, scenario), models)


def placed_scores(placed: DataFrame, scenario_types: T.StructType, models: dict[str, Callable | None]) -> DataFrame:
    """Accuracy of every model in every scenario: scenario columns, model, score, train_rows.

    `placed` is a table of `scenarios.place`: one copy of the rows, written once, serves all fits. The models run side by
    side; one score per scenario and model reaches the driver.
    """
    spark = placed.sparkSession
    rows = cut_lineage(placed.hint("rebalance"))
    sizes = {r["scenario"]: r["n"] for r in scenarios.train_shapes(rows).collect()}

    def scored(name: str) -> Callable:
        def run() -> list[tuple]:
            found = evaluation.accuracy(models[name](rows), ["scenario"]).collect()
            return [(r["scenario"], name, r["score"], sizes.get(r["scenario"], 0)) for r in found]
        return run

    fitted = in_parallel([scored(name) for name in models if models[name] is not None], spark)
    scores = spark.createDataFrame([row for part in fitted for row in part], "scenario string, model string, score double, train_rows long")
    scores = scores.select(*scenarios.named(scenario_types), "model", "score", "train_rows")
    if KNN in models:
        trained = spark.createDataFrame(list(sizes.items()), "scenario string, train_rows long")
        trained = trained.select(*scenarios.named(scenario_types), "train_rows")
        predicted = neighbours.predict_each(rows, scenario_types, [neighbours.NEIGHBOURS])
        near = evaluation.accuracy(predicted, scenario_types.names).join(F.broadcast(trained), scenario_types.names)
        scores = scores.unionByName(near.select(*scenario_types.names, F.lit(KNN).alias("model"), "score", "train_rows"))
    return scores


def cross_validation(features: DataFrame, models: dict[str, Callable | None], dataset: str) -> DataFrame:
    """Scores of all models on the same repeated stratified folds: dataset, model, repeat, fold, score."""
    members = scenarios.fold_members(folds.stratified_folds(features))
    keys = ["repeat", "fold"]
    placed = scenarios.place(features, members, keys)
    return placed_scores(placed, scenarios.types_of(members, keys), models).withColumn("dataset", F.lit(dataset))


def holdout_best(features: DataFrame, models: dict[str, Callable | None], dataset: str) -> DataFrame:
    """Predictions on a stratified hold-out by the model with the best cross-validated mean score."""
    pairs = evaluation.model_pairs(cross_validation(features, models, dataset))
    best = pairs.select("best").first()[0]
    rows = folds.holdout_split(features).drop("label").join(features, "row_id").withColumn("dataset", F.lit(dataset))
    predicted = (neighbours.knn_predict(rows, ["dataset"]) if models[best] is None
                 else models[best](scenarios.gather(rows, ["dataset"])))
    return predicted.select("row_id", F.lit(best).alias("model"), F.col("label").cast("int").alias("label"),
                            F.col("prediction").cast("int").alias("prediction"))


def learning_curve(features: DataFrame, models: dict[str, Callable | None], dataset: str, fractions: list[float],
                   seeds: list[int]) -> DataFrame:
    """Hold-out accuracy per model and train size, mean and deviation over the seeds."""
    members = scenarios.curve_members(features, fractions, seeds)
    keys = ["fraction", "seed"]
    scores = placed_scores(scenarios.place(features, members, keys), scenarios.types_of(members, keys), models)
    return evaluation.curve_summary(scores.withColumn("dataset", F.lit(dataset)).withColumnRenamed(
        "train_rows", "size"))


def regressors(trees: int = REGRESSION_TREES, rounds: int = REGRESSION_ROUNDS) -> dict[str, tuple[str, Callable]]:
    """Model name to the feature column and a function from a placed table with numeric labels to predictions of its test rows."""
    def forest(placed: DataFrame) -> DataFrame:
        return tree.forest_predictions(tree.matrix(placed, numeric=True), trees, tree.Growth(FOREST_DEPTH, least=2, seed=SEED))

    def boosted(placed: DataFrame) -> DataFrame:
        growth = tree.Growth(REGRESSION_DEPTH, leaves=REGRESSION_LEAVES, least=REGRESSION_LEAF, seed=SEED)
        return tree.boosted_predictions(tree.matrix(placed, numeric=True), rounds, BOOST_RATE, growth)

    return {"month only": ("month_vector", linear.least_squares_predictions), "linear": ("full_vector", linear.least_squares_predictions),
            "random forest": ("full_vector", forest), "boosted trees": ("full_vector", boosted)}


def month_vectors(monthly: DataFrame, include_city: bool = True) -> DataFrame:
    """Feature vectors of the monthly table: months only, and months with weather and (optionally) the city."""
    coded = StringIndexer(inputCols=["city", "month_name"], outputCols=["city_at", "month_at"],
                          stringOrderType="alphabetAsc")
    flags = OneHotEncoder(inputCols=["city_at", "month_at"], outputCols=["city_flags", "month_flags"], dropLast=False)
    named = monthly.withColumn("month_name", F.col("month").cast("string"))
    indexed = coded.fit(named).transform(named)
    flagged = flags.fit(indexed).transform(indexed)
    months = ["month_sin", "month_cos", "month"] + (["month_flags"] if include_city else [])
    full = ["month_sin", "month_cos", "tmean", "precip"] + (["city_flags"] if include_city else [])
    assembled = VectorAssembler(inputCols=months, outputCol="month_vector").transform(flagged)
    return VectorAssembler(inputCols=full, outputCol="full_vector").transform(assembled).select(
        "city", "ym", F.col("pm25").alias("target"), "month_vector", "full_vector")


def out_of_fold(rows: DataFrame, models: dict[str, tuple[str, Callable]]) -> DataFrame:
    """Prediction of every model for every row, made by the fit that did not see the row's fold.

    `rows` has city, ym, target, the vector columns and fold. The fits of all folds of a model run together on one placed
    table, whose row_id numbers the rows; predictions join back by it.
    """
    spark = rows.sparkSession
    numbered = cut_lineage(rows.hint("rebalance").withColumn("row_id", F.monotonically_increasing_id()))
    held_out = sorted(r["fold"] for r in numbered.select("fold").distinct().collect())
    names = {fold: f"fold {fold}" for fold in held_out}
    tests = F.array(*[F.when(F.col("fold") == fold, F.lit(name)) for fold, name in names.items()])
    trains = F.array(*[F.when(F.col("fold") != fold, F.lit(name)) for fold, name in names.items()])

    def predicted(name: str) -> Callable:
        column, model = models[name]
        placed = numbered.select("row_id", F.col("target").cast("double").alias("label"), vector_to_array(column).alias("features"),
                                 F.array_compact(trains).alias("trains"), F.array_compact(tests).alias("tests"))
        return lambda: cut_lineage(model(placed).select(F.lit(name).alias("model"), "row_id", "prediction"))

    parts = in_parallel([predicted(name) for name in models], spark)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.join(numbered.select("row_id", "city", "ym", "target"), "row_id").select("model", "city", "ym", "target", "prediction")


def actual_and_predicted(predictions: DataFrame, model: str, cities: list[str]) -> DataFrame:
    """Monthly series of target and prediction for chosen cities, in time order inside each city."""
    return (predictions.filter((F.col("model") == model) & F.col("city").isin(*cities))
            .select("city", F.date_format("ym", "yyyy-MM").alias("ym"), "target", "prediction")
            .repartition("city").sortWithinPartitions("city", "ym"))
