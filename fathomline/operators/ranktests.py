"""Rank tests: Mann-Whitney U for two samples, Wilcoxon signed-rank for paired scores."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.functions.normal import two_sided_p
from fathomline.operators.ranks import running_by_value

# Sample sizes up to which the exact null distributions are used.
EXACT_U_SIZE = 8
# Largest product of the two sample sizes for the exact distribution, which has one number for each value of U.
EXACT_U_CELLS = 10_000_000
EXACT_SIGNED_RANK_SIZE = 50
# Score differences closer than this many decimals are equal; the rest is floating-point noise.
DIFFERENCE_DIGITS = 12


def _exact_u_p(u: float, n1: int, n2: int) -> float:
    """Two-sided p of U without ties: arrangements per U by convolution over sample sizes, up to the nearer end of U only.

    Both tails have equally many arrangements, and no value of U depends on a larger one.
    """
    size = int(np.floor(min(u, n1 * n2 - u))) + 1
    ways = np.zeros(size)
    ways[0] = 1.0
    for i in range(1, n1 + 1):
        widened = ways.copy()
        if n2 + i < size:
            widened[n2 + i:] -= ways[:size - n2 - i]
        for start in range(min(i, size)):
            widened[start::i] = np.cumsum(widened[start::i])
        ways = widened
    return float(min(1.0, 2 * ways.sum() / math.comb(n1 + n2, n1)))


@F.pandas_udf(T.DoubleType())
def exact_u_p(u: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([_exact_u_p(a, min(int(b), int(c)), max(int(b), int(c))) for a, b, c in zip(u, n1, n2)],
                     dtype="float64")


def mann_whitney(samples: DataFrame, by: list[str], value: str, in_first: str,
                 exact_cells: int = EXACT_U_CELLS) -> DataFrame:
    """Two-sided test of the rows where `in_first` holds against the others, one result row per group.

    Values are first counted per side, which is all the test needs; ranks come from running counts. `exact` says whether p is of
    the exact distribution: for samples without ties of which one has at most 8 values, while U has at most `exact_cells` values.
    """
    first = F.col(in_first)
    counts = (samples.filter(F.col(value).isNotNull() & first.isNotNull())
              .groupBy(*by, F.col(value).cast("double").alias("v"))
              .agg(F.count(F.when(first, 1)).cast("double").alias("c1"),
                   F.count(F.when(~first, 1)).cast("double").alias("c2")))
    running = running_by_value(counts, by, "v", ["c2"])
    same = F.col("c1") + F.col("c2")
    sums = running.groupBy(*by).agg(
        F.sum("c1").alias("n1"), F.sum("c2").alias("n2"),
        F.sum(F.col("c1") * (F.col("c2_before") + F.col("c2") / 2)).alias("u"),
        F.sum(same * same * same - same).alias("ties"))
    n1, n2, u, ties = (F.col(c) for c in ("n1", "n2", "u", "ties"))
    total, product = n1 + n2, n1 * n2
    spread = F.sqrt(product / 12 * (total + 1 - F.try_divide(ties, total * (total - 1))))
    z = F.try_divide(F.abs(u - product / 2) - 0.5, spread)
    approximate = F.least(F.when(z < 0, 2 - two_sided_p(z)).otherwise(two_sided_p(z)), F.lit(1.0))
    exact = (F.least(n1, n2) <= EXACT_U_SIZE) & (ties == 0) & (product > 0) & (product <= exact_cells)
    parts = sums.withColumns({"z": z, "p": approximate, "exact": exact})
    # The Python helper sees only the rows that need it: empty samples elsewhere.
    p_exact = exact_u_p(F.when(F.col("exact"), u).otherwise(0.0), F.when(F.col("exact"), n1).otherwise(0.0),
                        F.when(F.col("exact"), n2).otherwise(0.0))
    return parts.withColumn("p", F.when(F.col("exact"), p_exact).otherwise(F.col("p"))).select(
        *by, n1.cast("long").alias("n1"), n2.cast("long").alias("n2"), "u", "z", "p", "exact")


def _exact_signed_rank_p(doubled_ranks: Column, doubled_plus: Column) -> Column:
    """Two-sided p from the exact null: the number of sign patterns per doubled rank sum, ties included."""
    top = F.aggregate(doubled_ranks, F.lit(0), lambda acc, r: acc + r)
    start = F.transform(F.sequence(F.lit(0), top), lambda i: F.when(i == 0, 1.0).otherwise(0.0))

    def add_rank(ways: Column, rank: Column) -> Column:
        return F.transform(ways, lambda n, i: n + F.when(i >= rank, F.get(ways, i - rank)).otherwise(0.0))

    ways = F.aggregate(doubled_ranks, start, add_rank)

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda acc, n: acc + n)

    at = doubled_plus.cast("int")
    below = total(F.slice(ways, F.lit(1), at + 1))
    above = total(F.slice(ways, at + 1, F.size(ways) - at))
    return F.least(F.lit(1.0), 2 * F.least(below, above) / F.pow(F.lit(2.0), F.size(doubled_ranks)))


def signed_rank(pairs: DataFrame, by: list[str], first: str, second: str) -> DataFrame:
    """Two-sided Wilcoxon test of paired scores, zeros dropped; exact for up to 50 non-zero differences."""
    gap = F.round(F.col(first) - F.col(second), DIFFERENCE_DIGITS)
    counts = (pairs.select(*by, gap.alias("gap")).filter(F.col("gap").isNotNull())
              .groupBy(*by, F.abs("gap").alias("size"))
              .agg(F.count(F.lit(1)).alias("same"), F.count(F.when(F.col("gap") > 0, 1)).alias("positive"))).persist()
    negative = F.col("same") - F.col("positive")
    means = counts.groupBy(*by).agg(
        (F.sum(F.col("size") * (F.col("positive") - negative)) / F.sum("same")).alias("diff_mean"),
        F.sum(F.when(F.col("size") > 0, F.col("same")).otherwise(0)).alias("n"))
    running = running_by_value(counts.filter(F.col("size") > 0), by, "size", ["same"])
    ranked = running.withColumn("doubled_rank", 2 * F.col("same_before") + F.col("same") + 1)
    ranked = ranked.join(means.select(*by, "n"), by)
    same = F.col("same").cast("double")
    few = F.col("n") <= EXACT_SIGNED_RANK_SIZE
    # Only groups of at most 50 differences are gathered into an array; larger ones add nothing to it.
    repeated = F.when(few, F.array_repeat(F.col("doubled_rank").cast("int"), F.col("same").cast("int")))
    sums = ranked.groupBy(*by).agg(
        F.sum(F.col("doubled_rank") * F.col("positive")).alias("doubled_plus"),
        F.sum(F.col("doubled_rank") * F.col("same")).alias("doubled_all"),
        F.sum(same * same * same - same).alias("ties"), F.collect_list(repeated).alias("ranks"))
    joined = means.join(sums, by, "left").withColumn("doubled_ranks", F.flatten("ranks"))
    n = F.col("n").cast("double")
    statistic = F.least(F.col("doubled_plus"), F.col("doubled_all") - F.col("doubled_plus")) / 2
    spread = F.sqrt((n * (n + 1) * (2 * n + 1) - F.col("ties") / 2) / 24)
    approximate = two_sided_p((statistic - n * (n + 1) / 4) / spread)
    exact = _exact_signed_rank_p(F.col("doubled_ranks"), F.col("doubled_plus"))
    return joined.select(*by, "diff_mean", "n", statistic.alias("statistic"),
                         F.when(F.col("n") == 0, 1.0).when(few, exact).otherwise(approximate).alias("p"))
