"""Reproducible splits: stratified folds, plain folds, exact-size stratified hold-outs and subsamples.

Rows are ordered by an md5 of (seed, row id). Positions inside a label come from `position_by_hash`, so even a
label that holds most of the table is never ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.hashing import digest
from fathomline.operators.ranks import position_by_hash

FOLDS, REPEATS, SEED = 5, 2, 42
TEST_SHARE = 0.25


def stratified_folds(rows: DataFrame, folds: int = FOLDS, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """Fold of every row in every repeat: row_id, label, repeat, fold. Fold sizes per label differ by at most 1."""
    repeated = rows.select("row_id", "label", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"))
    hashed = repeated.withColumn("hash", digest(seed, F.col("repeat"), F.col("row_id")))
    placed = position_by_hash(hashed, ["repeat", "label"], "hash", "row_id")
    return placed.select("row_id", "label", "repeat", (F.col("position") % folds).cast("int").alias("fold"))


def plain_folds(rows: DataFrame, key: list[str], folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """The table with a fold per row, sizes differing by at most 1 over the whole table."""
    named = rows.withColumns({"hash": digest(seed, *[F.col(k) for k in key]), "all": F.lit(0),
                              "name": F.concat_ws("|", *key)})
    placed = position_by_hash(named, ["all"], "hash", "name")
    return placed.withColumn("fold", (F.col("position") % folds).cast("int")).drop("hash", "all", "name", "position")


def label_quotas(rows: DataFrame, keys: list[str], total: Column) -> DataFrame:
    """Rows to take per label so that each group takes exactly `total`, split by largest remainder.

    Works on the table of label counts, which is small; `total` may use `n`, the group's row count.
    """
    counts = rows.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n_label"))
    group = Window.partitionBy(*keys)
    sized = counts.withColumn("n", F.sum("n_label").over(group)).withColumn("total", total.cast("long"))
    exact = F.col("n_label") * F.col("total") / F.col("n")
    shared = sized.withColumns({"base": F.floor(exact), "remainder": F.round(exact - F.floor(exact), 9)})
    order = group.orderBy(F.desc("remainder"), "label")
    left = F.col("total") - F.sum("base").over(group)
    extra = F.when(F.row_number().over(order) <= left, 1).otherwise(0)
    return shared.withColumn("quota", F.col("base") + extra).select(*keys, "label", "quota")


def holdout_split(rows: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Mark exactly ceil(share * n) rows as the stratified test set: row_id, label, is_test."""
    hashed = rows.select("row_id", "label", F.lit(0).alias("all"), digest(seed, F.col("row_id")).alias("hash"))
    quotas = label_quotas(hashed, ["all"], F.ceil(F.lit(test_share) * F.col("n")))
    placed = position_by_hash(hashed, ["all", "label"], "hash", "row_id").join(quotas, ["all", "label"])
    return placed.select("row_id", "label", (F.col("position") < F.col("quota")).alias("is_test"))


def stratified_subsamples(rows: DataFrame, fractions: list[float], seeds: list[int]) -> DataFrame:
    """Exact-size stratified subsamples: row_id, label, fraction, seed. A fraction of 1 or more takes every row."""
    scenarios = F.explode(F.array(*[F.struct(F.lit(float(f)).alias("fraction"), F.lit(s).alias("seed"))
                                    for f in fractions for s in seeds])).alias("s")
    each = rows.select("row_id", "label", scenarios).select("row_id", "label", "s.*")
    hashed = each.withColumn("hash", digest(F.col("seed"), F.col("row_id")))
    keys = ["fraction", "seed"]
    total = F.when(F.col("fraction") >= 1, F.col("n")).otherwise(F.floor(F.round(F.col("fraction") * F.col("n"), 9)))
    quotas = label_quotas(hashed, keys, total)
    placed = position_by_hash(hashed, [*keys, "label"], "hash", "row_id").join(quotas, [*keys, "label"])
    return placed.filter(F.col("position") < F.col("quota")).select("row_id", "label", *keys)
