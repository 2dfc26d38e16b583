"""Scores of predictions and comparison of models: accuracy, confusion counts, error, ranking, curves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.ranks import running_by_value
from fathomline.operators.ranktests import signed_rank

# Box-plot quartiles and whisker reach, share of the final accuracy that counts as reached.
QUARTILES = (0.25, 0.5, 0.75)
WHISKER = 1.5
REACHED = 0.99


def accuracy(predictions: DataFrame, by: list[str]) -> DataFrame:
    return predictions.groupBy(*by).agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("score"), F.count(F.lit(1)).alias("n"))


def confusion_matrix(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    return predictions.groupBy(*(by or []), "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def score_summary(scores: DataFrame, by: list[str], digits: int = 4) -> DataFrame:
    """Mean and population deviation over the replicates."""
    return scores.groupBy(*by).agg(F.round(F.avg("score"), digits).alias("accuracy_mean"),
                                   F.round(F.stddev_pop("score"), digits).alias("accuracy_std"))


def regression_scores(predictions: DataFrame, by: list[str]) -> DataFrame:
    """R² against the mean of the pooled targets, and the mean absolute error.

    One aggregation: the squared deviations are the variance of the targets times their number. R² of a constant target
    is null.
    """
    error = F.col("target") - F.col("prediction")
    sums = predictions.filter(F.col("target").isNotNull() & F.col("prediction").isNotNull()).groupBy(*by).agg(
        F.sum(error * error).alias("unexplained"), (F.var_pop("target") * F.count("target")).alias("total"),
        F.avg(F.abs(error)).alias("mae"))
    return sums.select(*by, (1 - F.try_divide("unexplained", "total")).alias("r2"), "mae")


def gain_over_baseline(scores: DataFrame, baseline: str) -> DataFrame:
    """Difference of R² to the baseline model, in percentage points."""
    base = scores.filter(F.col("model") == baseline).select("r2").scalar()
    return scores.withColumn("gain_pp", (F.col("r2") - base) * 100)


def exact_quantiles(values: DataFrame, by: list[str], value: str, shares: list[float]) -> DataFrame:
    """Quantiles of every group, between the two nearest values by distance: the columns of `by`, and an array q.

    Equal values are counted first; running counts over ranges of values (see ranks) tell which values hold the wanted
    places, so no task holds a group, however many distinct values it has. Nulls don't count; NaN is larger than all
    numbers.
    """
    counts = values.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("same"))
    running = running_by_value(counts, by, "v", ["same"])
    totals = running.groupBy(*by).agg(F.sum("same").alias("n"))
    placed = running.join(totals, by)
    wanted, picked = [], []
    for k, share in enumerate(shares):
        # A place as good as whole is whole: 0.1 x 10 may miss 1 by a rounding.
        at = F.round((F.col("n") - 1) * F.lit(float(share)), 9)
        for name, place in ((f"low{k}", F.floor(at)), (f"high{k}", F.ceil(at))):
            inside = (F.col("same_before") <= place) & (place < F.col("same_before") + F.col("same"))
            wanted.append(inside)
            picked.append(F.max(F.when(inside, F.col("v"))).alias(name))
        picked.append(F.max(at - F.floor(at)).alias(f"part{k}"))
    held = placed.filter(reduce(lambda a, b: a | b, wanted))
    between = [F.col(f"low{k}") + F.when(F.col(f"part{k}") > 0, (F.col(f"high{k}") - F.col(f"low{k}")) * F.col(f"part{k}")).otherwise(0.0)
               for k in range(len(shares))]
    return held.groupBy(*by).agg(*picked).select(*by, F.array(*between).alias("q"))


def box_summary(scores: DataFrame, by: list[str]) -> DataFrame:
    """Quartiles and whiskers: the outermost scores within 1.5 box heights of the box."""
    quartiles = exact_quantiles(scores, by, "score", list(QUARTILES))
    boxes = quartiles.select(*by, *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.col("score").between(F.col("q1") - reach, F.col("q3") + reach)
    return scores.join(boxes, by).groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("score"))).alias("low"), F.max(F.when(inside, F.col("score"))).alias("high"),
        F.count(F.when(~inside, 1)).alias("outliers"))


def model_pairs(scores: DataFrame) -> DataFrame:
    """Per dataset the best model against the second and against the last; equal means go by model name."""
    means = scores.groupBy("dataset", "model").agg(F.round(F.avg("score"), 12).alias("mean"))
    models = Window.partitionBy("dataset")
    ranked = means.withColumns({"place": F.row_number().over(models.orderBy(F.desc("mean"), "model")),
                                "models": F.count(F.lit(1)).over(models)})
    ends = ranked.groupBy("dataset").agg(
        F.max(F.when(F.col("place") == 1, F.col("model"))).alias("best"),
        F.max(F.when(F.col("place") == 2, F.col("model"))).alias("second"),
        F.max(F.when(F.col("place") == F.col("models"), F.col("model"))).alias("last"))
    pairs = F.array(F.struct(F.lit("top2").alias("pair"), F.col("second").alias("other")),
                    F.struct(F.lit("best_vs_worst").alias("pair"), F.col("last").alias("other")))
    return ends.select("dataset", "best", F.explode(pairs).alias("p")).select("dataset", "p.pair", "best", "p.other")


def significance_tests(scores: DataFrame, replicate: list[str], alpha: float = 0.05, digits: int = 4) -> DataFrame:
    """Wilcoxon test of each model pair on the scores of the same folds."""
    def of(model: str, name: str) -> DataFrame:
        return scores.select("dataset", F.col("model").alias(model), *replicate, F.col("score").alias(name))

    paired = (model_pairs(scores).join(of("best", "first"), ["dataset", "best"])
              .join(of("other", "second"), ["dataset", "other", *replicate]))
    tested = signed_rank(paired, ["dataset", "pair", "best", "other"], "first", "second")
    return tested.select("dataset", "pair", "best", "other", F.round("diff_mean", digits).alias("diff_mean"),
                         F.round("p", digits).alias("wilcoxon_p"), (F.col("p") < alpha).alias("significant_at_0_05"))


def curve_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation per (dataset, model, size)."""
    return scores.groupBy("dataset", "model", "size").agg(
        F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))


def samples_to_reach(curve: DataFrame, share: float = REACHED) -> DataFrame:
    """Smallest size whose mean reaches the share of the final mean, else the last size."""
    keys = ["dataset", "model"]
    final = curve.groupBy(*keys).agg(F.max_by("mean", "size").alias("final_accuracy"), F.max("size").alias("last"))
    enough = F.round(F.col("mean"), 12) >= F.round(F.col("final_accuracy") * share, 12)
    reached = curve.join(final, keys).groupBy(*keys, "final_accuracy", "last").agg(
        F.min(F.when(enough, F.col("size"))).alias("first"))
    return reached.select(*keys, "final_accuracy", F.coalesce("first", "last").alias("samples"))
