"""Registered queries: models on shared folds, hold-outs and subsamples; the exact linear fits have SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.operators import evaluation, folds, models
from fathomline.plans import rollups, views
from fathomline.plans.comparisons import FRACTIONS, SEEDS
from fathomline.session import cut_lineage
from fathomline.sources import tables

SERIES_CITIES = ["NATION_1", "NATION_7", "NATION_19"]


def bench_table(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and deviation of the accuracy of five models over 5 folds and 2 repeats."""
    features = cut_lineage(tables.quality_features(spark, folder))  # the texts are read once
    shape = features.agg(F.count(F.lit(1)).alias("n_samples"), F.max(F.size("features")).alias("n_features"),
                         F.count_distinct("label").alias("n_classes"))
    scores = models.cross_validation(features, models.classifiers(), "quality")
    return evaluation.score_summary(scores, ["dataset", "model"]).withColumns(
        {c: shape.select(c).scalar() for c in ("n_samples", "n_features", "n_classes")})


def embedding_bench(spark: SparkSession, folder: str) -> DataFrame:
    """The multi-class matrix with all five models."""
    features = tables.embedding_features(spark, folder)
    return evaluation.score_summary(models.cross_validation(features, models.classifiers(), "embeddings"),
                                    ["dataset", "model"])


def holdout_best(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion counts of the best model on the stratified hold-out."""
    features = tables.embedding_features(spark, folder)
    predicted = models.holdout_best(features, models.classifiers(), "embeddings")
    return evaluation.confusion_matrix(predicted, ["model"])


def learning_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Four models, six train sizes, five seeds on one fixed hold-out."""
    chosen = {name: build for name, build in models.classifiers(models.CURVE_TREES).items() if name != "GBDT"}
    features = cut_lineage(tables.quality_features(spark, folder))
    curve = models.learning_curve(features, chosen, "quality", FRACTIONS, SEEDS)
    return curve.withColumns({c: F.round(c, 4) for c in ("mean", "std")})


def month_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of the monthly table with the fold of every row."""
    monthly = rollups.city_months(spark, folder)
    return folds.plain_folds(models.month_vectors(monthly), ["city", "ym"])


def regression_scores(spark: SparkSession, folder: str) -> DataFrame:
    """R², error and gain over the month-only baseline of four models, from pooled out-of-fold predictions."""
    predicted = models.out_of_fold(month_rows(spark, folder), models.regressors())
    scores = evaluation.gain_over_baseline(evaluation.regression_scores(predicted, ["model"]), "month only")
    return scores.select("model", F.round("r2", 3).alias("r2"), F.round("mae", 2).alias("mae"),
                         F.round("gain_pp", 1).alias("gain_pp"))


def linear_scores(spark: SparkSession, folder: str) -> DataFrame:
    """R², error and gain of the two linear models, from pooled out-of-fold predictions of exact fits."""
    exact = {name: m for name, m in models.regressors().items() if name in ("month only", "linear")}
    predicted = models.out_of_fold(month_rows(spark, folder), exact)
    scores = evaluation.gain_over_baseline(evaluation.regression_scores(predicted, ["model"]), "month only")
    return scores.select("model", *[F.round(c, 6).alias(c) for c in ("r2", "mae", "gain_pp")])


def regression_series(spark: SparkSession, folder: str) -> DataFrame:
    """Actual and predicted months of three cities under the linear model."""
    linear = {name: m for name, m in models.regressors().items() if name == "linear"}
    predicted = models.out_of_fold(month_rows(spark, folder), linear)
    return models.actual_and_predicted(predicted, "linear", SERIES_CITIES).withColumns(
        {"target": F.round("target", 9), "prediction": F.round("prediction", 6)})


QUERIES = {f.__name__: f for f in (
    bench_table, embedding_bench, holdout_best, learning_curve, regression_scores, linear_scores, regression_series)}

_WEATHER = ["month_sin", "month_cos", "tmean", "precip"]


def _elimination_sql(k: int) -> str:
    """Views m0 ... mk: Gaussian elimination of the normal equations of every fold; after the last, column r holds the weights."""
    views_, columns = [], [f"a{i}{j}" for i in range(k) for j in range(k)] + [f"b{i}" for i in range(k)]
    for p in range(k):
        pivot = [f"a{p}{j} / a{p}{p} AS a{p}{j}" for j in range(k)] + [f"b{p} / a{p}{p} AS b{p}"]
        other = [f"a{i}{j} - a{i}{p} * a{p}{j} / a{p}{p} AS a{i}{j}" for i in range(k) if i != p for j in range(k)]
        other += [f"b{i} - a{i}{p} * b{p} / a{p}{p} AS b{i}" for i in range(k) if i != p]
        views_.append(f"m{p + 1} AS (SELECT fold, {', '.join(pivot + other)} FROM m{p})")
    assert len(columns) == k * (k + 1)
    return ",\n".join(views_)


def _centred(c: str) -> str:
    return f"(t.{c} - g.{c})"


# City flags are city means: the weights of the weather are those of deviations from the means of a city's train rows
# (Frisch and Waugh). Month flags alone predict the mean of a month.
_LINEAR_SQL = views.with_views(views.CITY_DAILY, views.WEATHER_DAILY, views.CITY_MONTHS, f"""coded AS (
  SELECT city, ym, month(ym) AS month, pm25 AS target, sin(2 * pi() * month(ym) / 12) AS month_sin,
         cos(2 * pi() * month(ym) / 12) AS month_cos, tmean, precip,
         (row_number() OVER (ORDER BY md5('{folds.SEED}|' || city || '|' || CAST(ym AS VARCHAR))) - 1) % {folds.FOLDS} AS own
  FROM city_months),
folds AS (SELECT unnest(range({folds.FOLDS})) AS fold),
train AS (SELECT * FROM folds JOIN coded ON own <> fold),
g AS (SELECT fold, city, avg(target) AS target, {', '.join(f'avg({c}) AS {c}' for c in _WEATHER)} FROM train GROUP BY fold, city),
m0 AS (
  SELECT fold, {', '.join(f'sum({_centred(a)} * {_centred(b)}) AS a{i}{j}' for i, a in enumerate(_WEATHER) for j, b in enumerate(_WEATHER))},
         {', '.join(f'sum({_centred(a)} * {_centred("target")}) AS b{i}' for i, a in enumerate(_WEATHER))}
  FROM train t JOIN g USING (fold, city) GROUP BY fold),
{_elimination_sql(len(_WEATHER))},
levels AS (
  SELECT fold, city, target - ({' + '.join(f'b{i} * {c}' for i, c in enumerate(_WEATHER))}) AS level
  FROM g JOIN m{len(_WEATHER)} USING (fold)),
months AS (SELECT fold, month, avg(target) AS mean FROM train GROUP BY fold, month),
predicted AS (
  SELECT 'linear' AS model, c.city, ym, target,
         coalesce(level, (SELECT avg(level) FROM levels l WHERE l.fold = own)) + {' + '.join(f'b{i} * c.{x}' for i, x in enumerate(_WEATHER))} AS prediction
  FROM coded c JOIN m{len(_WEATHER)} m ON m.fold = own LEFT JOIN levels ON levels.fold = own AND levels.city = c.city
  UNION ALL
  SELECT 'month only', city, ym, target, mean FROM coded c JOIN months ON months.fold = own AND months.month = c.month)""")

ORACLE: dict[str, str] = {
    "linear_scores": _LINEAR_SQL + """,
scores AS (
  SELECT model, 1 - sum((target - prediction) ** 2) / (var_pop(target) * count(*)) AS r2, avg(abs(target - prediction)) AS mae
  FROM predicted GROUP BY model)
SELECT model, round(r2, 6) AS r2, round(mae, 6) AS mae,
       round((r2 - (SELECT r2 FROM scores WHERE model = 'month only')) * 100, 6) AS gain_pp FROM scores""",
    "regression_series": _LINEAR_SQL + f"""
SELECT city, strftime(ym, '%Y-%m') AS ym, round(target, 9) AS target, round(prediction, 6) AS prediction FROM predicted
WHERE model = 'linear' AND city IN ({', '.join(f"'{c}'" for c in SERIES_CITIES)})""",
}
