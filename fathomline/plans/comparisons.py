"""Registered queries: folds, subsamples, nearest-neighbour models and the comparison of their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.operators import evaluation, folds, neighbours, scenarios
from fathomline.plans import views
from fathomline.sources import tables

NEIGHBOUR_COUNTS = (1, 3, 5, 9, 15)
FRACTIONS = [0.05, 0.1, 0.25, 0.5, 0.75, 1.0]
SEEDS = [42, 43, 44, 45, 46]


def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return folds.stratified_folds(tables.embedding_features(spark, folder))


def stratified_subsample(spark: SparkSession, folder: str) -> DataFrame:
    return folds.stratified_subsamples(tables.embedding_features(spark, folder), FRACTIONS, SEEDS)


def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    return folds.holdout_split(tables.embedding_features(spark, folder))


def plain_folds(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return folds.plain_folds(orders, ["o_orderkey"])


def knn_predictions(spark: SparkSession, folder: str, counts: tuple[int, ...] = (neighbours.NEIGHBOURS,),
                    repeats: int = folds.REPEATS) -> DataFrame:
    """Predictions of the repeated folds, for every number of neighbours from one search."""
    features = tables.embedding_features(spark, folder)
    members = scenarios.fold_members(folds.stratified_folds(features, repeats=repeats))
    keys = ["repeat", "fold"]
    return neighbours.predict_each(scenarios.place(features, members, keys), scenarios.types_of(members, keys),
                                   list(counts))


def knn_cv_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    scores = evaluation.accuracy(knn_predictions(spark, folder), ["repeat", "fold"])
    return scores.select("repeat", "fold", F.round("score", 6).alias("score"), "n")


def knn_cv_summary(spark: SparkSession, folder: str) -> DataFrame:
    scores = evaluation.accuracy(knn_predictions(spark, folder), ["repeat", "fold"])
    features = tables.embedding_features(spark, folder)
    shape = features.agg(F.count(F.lit(1)).alias("n_samples"), F.max(F.size("features")).alias("n_features"),
                         F.count_distinct("label").alias("n_classes"))
    named = scores.withColumns({"dataset": F.lit("embeddings"), "model": F.lit("KNN")})
    return evaluation.score_summary(named, ["dataset", "model"]).withColumns(
        {c: shape.select(c).scalar() for c in ("n_samples", "n_features", "n_classes")})


def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion_matrix(knn_predictions(spark, folder, repeats=1))


def _knn_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of neighbour models with different numbers of neighbours on the same folds."""
    predicted = knn_predictions(spark, folder, NEIGHBOUR_COUNTS).withColumns(
        {"dataset": F.lit("embeddings"), "model": F.format_string("KNN-%02d", "k")})
    scores = evaluation.accuracy(predicted, ["dataset", "model", "repeat", "fold"])
    return scores.withColumn("score", F.round("score", 9)).drop("n")


def model_rank_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.model_pairs(_knn_scores(spark, folder))


def significance_tests(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.significance_tests(_knn_scores(spark, folder), ["repeat", "fold"], digits=6)


def score_summary(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.score_summary(_knn_scores(spark, folder), ["dataset", "model"], digits=6)


def boxplot_stats(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.box_summary(_knn_scores(spark, folder), ["dataset", "model"]).withColumns(
        {c: F.round(c, 6) for c in ("q1", "median", "q3", "low", "high")})


def knn_curve(spark: SparkSession, folder: str, fractions=FRACTIONS, seeds=SEEDS) -> DataFrame:
    features = tables.embedding_features(spark, folder)
    members = scenarios.curve_members(features, fractions, seeds)
    keys = ["fraction", "seed"]
    sizes = members.filter(~F.col("is_test")).groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    predicted = neighbours.predict_each(scenarios.place(features, members, keys), scenarios.types_of(members, keys),
                                        [neighbours.NEIGHBOURS])
    scores = evaluation.accuracy(predicted, keys).join(sizes, keys)
    return evaluation.curve_summary(scores.withColumns({"dataset": F.lit("embeddings"), "model": F.lit("KNN")}))


def knn_learning_curve(spark: SparkSession, folder: str) -> DataFrame:
    return knn_curve(spark, folder).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


def samples_to_99pct(spark: SparkSession, folder: str) -> DataFrame:
    """First train size whose mean accuracy is within 1 % of the final one."""
    reached = evaluation.samples_to_reach(knn_curve(spark, folder))
    return reached.withColumn("final_accuracy", F.round("final_accuracy", 6))


QUERIES = {f.__name__: f for f in (
    stratified_folds, stratified_subsample, holdout_split, plain_folds, knn_cv_accuracy, knn_cv_summary,
    confusion_matrix, model_rank_pairs, significance_tests, score_summary, boxplot_stats, knn_learning_curve,
    samples_to_99pct)}

_FOLDS = """folds AS (
  SELECT row_id, label, repeat, CAST((row_number() OVER (
           PARTITION BY repeat, label ORDER BY md5('42|' || repeat || '|' || row_id), row_id) - 1) % 5 AS INTEGER) AS fold
  FROM feature_rows, (SELECT unnest([0, 1]) AS repeat))"""


def _quotas(keys: str, source: str, total: str) -> str:
    return f"""label_counts AS (SELECT {keys}, label, count(*) AS nl FROM {source} GROUP BY ALL),
group_counts AS (SELECT {keys}, sum(nl) AS n FROM label_counts GROUP BY ALL),
shares AS (
  SELECT {keys}, label, nl * CAST({total} AS BIGINT) / n AS exact, CAST({total} AS BIGINT) AS total
  FROM label_counts JOIN group_counts USING ({keys})),
quotas AS (
  SELECT {keys}, label, floor(exact) + CASE WHEN row_number() OVER (
           PARTITION BY {keys} ORDER BY round(exact - floor(exact), 9) DESC, label)
           <= any_value(total) OVER (PARTITION BY {keys}) - sum(floor(exact)) OVER (PARTITION BY {keys})
         THEN 1 ELSE 0 END AS quota FROM shares)"""


_HOLDOUT = f"""numbered AS (SELECT 0 AS g, row_id, label, md5('42|' || row_id) AS hash FROM feature_rows),
{_quotas('g', 'numbered', 'ceil(0.25 * n)')},
split AS (
  SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY hash, row_id) <= quota AS is_test
  FROM numbered JOIN quotas USING (g, label))"""
_SCENARIOS = """(SELECT unnest([0.05, 0.1, 0.25, 0.5, 0.75, 1.0])::DOUBLE AS fraction),
  (SELECT unnest([42, 43, 44, 45, 46]) AS seed)"""
_TOTAL = "CASE WHEN fraction >= 1 THEN n ELSE floor(round(fraction * n, 9)) END"


def _subsamples(source: str) -> str:
    quotas = _quotas('fraction, seed', 'sampled', _TOTAL).replace(
        "label_counts", "sub_label_counts").replace("group_counts", "sub_group_counts").replace(
        "shares", "sub_shares").replace("quotas AS", "sub_quotas AS")
    return f"""sampled AS (
  SELECT row_id, label, fraction, seed, md5(seed || '|' || row_id) AS hash FROM {source}, {_SCENARIOS}),
{quotas},
subsamples AS (
  SELECT row_id, label, fraction, seed FROM sampled JOIN sub_quotas USING (fraction, seed, label)
  QUALIFY row_number() OVER (PARTITION BY fraction, seed, label ORDER BY hash, row_id) <= any_value(quota) OVER (
    PARTITION BY fraction, seed, label))"""


def knn_sql(scenario_rows: str, keys: str, counts: tuple[int, ...] = (5,)) -> str:
    """Brute force over `scenario_rows` (keys, row_id, label, features, is_test); one prediction per number k."""
    pairing = " AND ".join(f"a.{c.strip()} = b.{c.strip()}" for c in keys.split(","))
    named = ", ".join(f"a.{c.strip()}" for c in keys.split(","))
    return f"""parts AS (
  SELECT {keys}, unnest(features) AS x, generate_subscripts(features, 1) AS dim FROM {scenario_rows} WHERE NOT is_test),
moments AS (SELECT {keys}, dim, avg(x) AS mean, stddev_pop(x) AS std FROM parts GROUP BY ALL),
scales AS (
  SELECT {keys}, list(mean ORDER BY dim) AS means, list(CASE WHEN std > 0 THEN std ELSE 1 END ORDER BY dim) AS stds
  FROM moments GROUP BY ALL),
scaled AS (
  SELECT {keys}, row_id, label, is_test,
         [(features[i] - means[i]) / stds[i] for i in range(1, len(features) + 1)] AS f
  FROM {scenario_rows} JOIN scales USING ({keys})),
near AS (
  SELECT {named}, a.row_id, a.label, b.row_id AS train_id, b.label AS candidate,
         round(list_distance(a.f, b.f) * list_distance(a.f, b.f), 9) AS d,
         row_number() OVER (PARTITION BY {named}, a.row_id ORDER BY d, b.row_id) AS place
  FROM scaled a JOIN scaled b ON a.is_test AND NOT b.is_test AND {pairing}
  QUALIFY place <= {max(counts)}),
predictions AS (
  SELECT {keys}, row_id, label, k, candidate AS prediction FROM (
    SELECT {keys}, row_id, label, k, candidate, count(*) AS votes
    FROM near JOIN (SELECT unnest({list(counts)}) AS k) ON place <= k GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {keys}, row_id, k ORDER BY votes DESC, candidate) = 1)"""


_FOLD_ROWS = """fold_rows AS (
  SELECT repeat, held AS fold, row_id, f.label, features, folds.fold = held AS is_test
  FROM folds JOIN feature_rows f USING (row_id), (SELECT unnest([0, 1, 2, 3, 4]) AS held))"""
_KNN = views.with_views(views.EMBEDDING_FEATURES, _FOLDS, _FOLD_ROWS, knn_sql("fold_rows", "repeat, fold"))
_SCORED = """fold_scores AS (
  SELECT repeat, fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS score, count(*) AS n
  FROM predictions GROUP BY ALL)"""
_KNN_SCORES = (views.EMBEDDING_FEATURES, _FOLDS, _FOLD_ROWS, knn_sql("fold_rows", "repeat, fold", NEIGHBOUR_COUNTS),
               """scores AS (
  SELECT 'embeddings' AS dataset, printf('KNN-%02d', k) AS model, repeat, fold,
         round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS score
  FROM predictions GROUP BY ALL)""")
_PAIRS = """means AS (SELECT dataset, model, round(avg(score), 12) AS mean FROM scores GROUP BY ALL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY mean DESC, model) AS place,
         count(*) OVER (PARTITION BY dataset) AS models FROM means),
pairs AS (
  SELECT b.dataset, 'top2' AS pair, b.model AS best, o.model AS other FROM placed b JOIN placed o
    ON b.dataset = o.dataset AND b.place = 1 AND o.place = 2
  UNION ALL
  SELECT b.dataset, 'best_vs_worst', b.model, o.model FROM placed b JOIN placed o
    ON b.dataset = o.dataset AND b.place = 1 AND o.place = o.models)"""
_SIGNED = """gaps AS (
  SELECT p.*, round(a.score - b.score, 12) AS gap FROM pairs p
  JOIN scores a ON a.dataset = p.dataset AND a.model = best
  JOIN scores b ON b.dataset = p.dataset AND b.model = other 
    AND a.repeat = b.repeat AND a.fold = b.fold),
gap_means AS (SELECT dataset, pair, best, other, avg(gap) AS diff_mean FROM gaps GROUP BY ALL),
ranked AS (
  SELECT dataset, pair, gap, rank() OVER (PARTITION BY dataset, pair ORDER BY abs(gap))
         + (count(*) OVER (PARTITION BY dataset, pair, abs(gap)) - 1) / 2 AS r FROM gaps WHERE gap <> 0),
sums AS (SELECT dataset, pair, coalesce(sum(r) FILTER (gap > 0), 0) AS plus, list(r) AS ranks FROM ranked GROUP BY ALL),
signs AS (SELECT *, unnest(range(CAST(2 ** len(ranks) AS BIGINT))) AS mask FROM sums),
possible AS (
  SELECT dataset, pair, plus, list_sum([CASE WHEN (mask >> (i - 1)) % 2 = 1 THEN ranks[i] ELSE 0 END
                                        for i in range(1, len(ranks) + 1)]) AS w FROM signs),
tails AS (
  SELECT dataset, pair, least(1.0, 2 * least(avg(CAST(w <= plus AS DOUBLE)), avg(CAST(w >= plus AS DOUBLE)))) AS p
  FROM possible GROUP BY ALL)"""

_KNN_CURVE = views.with_views(
    views.EMBEDDING_FEATURES, _HOLDOUT, "train_rows AS (SELECT row_id, label FROM split WHERE NOT is_test)",
    _subsamples("train_rows"), f"""scenario_rows AS (
  SELECT fraction, seed, row_id, s.label, features, false AS is_test
  FROM subsamples s JOIN feature_rows USING (row_id)
  UNION ALL
  SELECT fraction, seed, row_id, split.label, features, true
  FROM split JOIN feature_rows USING (row_id), {_SCENARIOS} WHERE is_test)""",
    knn_sql("scenario_rows", "fraction, seed"), """curve_scores AS (
  SELECT fraction, seed, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS score
  FROM predictions GROUP BY ALL),
sizes AS (SELECT fraction, seed, count(*) AS size FROM subsamples GROUP BY ALL),
curve AS (
  SELECT 'embeddings' AS dataset, 'KNN' AS model, size, avg(score) AS mean, stddev_pop(score) AS std
  FROM curve_scores JOIN sizes USING (fraction, seed) GROUP BY size)""")

ORACLE = {
    "stratified_folds": views.with_views(views.EMBEDDING_FEATURES, _FOLDS)
    + "SELECT row_id, label, repeat, fold FROM folds",
    "stratified_subsample": views.with_views(views.EMBEDDING_FEATURES, _subsamples("feature_rows"))
    + "SELECT row_id, label, fraction, seed FROM subsamples",
    "holdout_split": views.with_views(views.EMBEDDING_FEATURES, _HOLDOUT) + "SELECT row_id, label, is_test FROM split",
    "plain_folds": """
      SELECT o_orderkey, o_orderpriority, CAST((row_number() OVER (
        ORDER BY md5('42|' || o_orderkey), CAST(o_orderkey AS VARCHAR)) - 1) % 5 AS INTEGER) AS fold FROM orders""",
    "knn_cv_accuracy": _KNN + ", " + _SCORED + " SELECT repeat, fold, round(score, 6) AS score, n FROM fold_scores",
    "knn_cv_summary": _KNN + ", " + _SCORED + """
      SELECT 'embeddings' AS dataset, 'KNN' AS model, round(avg(score), 4) AS accuracy_mean,
             round(stddev_pop(score), 4) AS accuracy_std, (SELECT count(*) FROM embeddings) AS n_samples,
             CAST((SELECT max(len(embedding)) FROM embeddings) AS INTEGER) AS n_features,
             (SELECT count(DISTINCT label) FROM embeddings) AS n_classes FROM fold_scores""",
    "confusion_matrix": _KNN + """
      SELECT label, prediction, count(*) AS n FROM predictions WHERE repeat = 0 GROUP BY ALL""",
    "model_rank_pairs": views.with_views(*_KNN_SCORES, _PAIRS) + "SELECT dataset, pair, best, other FROM pairs",
    "significance_tests": views.with_views(*_KNN_SCORES, _PAIRS, _SIGNED) + """
      SELECT dataset, pair, best, other, round(diff_mean, 6) AS diff_mean, round(p, 6) AS wilcoxon_p,
             p < 0.05 AS significant_at_0_05 FROM gap_means JOIN tails USING (dataset, pair)""",
    "score_summary": views.with_views(*_KNN_SCORES) + """
      SELECT dataset, model, round(avg(score), 6) AS accuracy_mean, round(stddev_pop(score), 6) AS accuracy_std
      FROM scores GROUP BY ALL""",
    "boxplot_stats": views.with_views(*_KNN_SCORES) + """, boxes AS (
        SELECT dataset, model, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median,
               quantile_cont(score, 0.75) AS q3 FROM scores GROUP BY ALL),
      marked AS (
        SELECT *, score BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS inside
        FROM scores JOIN boxes USING (dataset, model))
      SELECT dataset, model, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
             round(min(score) FILTER (inside), 6) AS low, round(max(score) FILTER (inside), 6) AS high,
             count(*) FILTER (NOT inside) AS outliers FROM marked GROUP BY dataset, model, q1, median, q3""",
    "knn_learning_curve": _KNN_CURVE + """
      SELECT dataset, model, size, round(mean, 6) AS mean, round(std, 6) AS std FROM curve""",
    "samples_to_99pct": _KNN_CURVE + """, final AS (
        SELECT dataset, model, arg_max(mean, size) AS final_accuracy, max(size) AS last FROM curve GROUP BY ALL)
      SELECT dataset, model, round(final_accuracy, 6) AS final_accuracy,
             coalesce(min(size) FILTER (round(mean, 12) >= round(final_accuracy * 0.99::DOUBLE, 12)), any_value(last))
               AS samples
      FROM curve JOIN final USING (dataset, model) GROUP BY ALL""",
}
