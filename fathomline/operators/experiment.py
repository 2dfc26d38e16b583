"""Two-arm experiments: conversion counts, z-test, sample size, power, A/A replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.hashing import digest
from fathomline.functions.normal import normal_cdf, quantile, two_sided_p
from fathomline.session import shuffle_partitions

# Half width of the 95 % interval in standard errors, multiples of the required size.
Z_95 = 1.96
POWER_MULTIPLES = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0)
BITS_PER_DIGEST = 32
TASKS_A_CORE = 4


def conversion_counts(units: DataFrame, by: list[str]) -> DataFrame:
    """Converted and total units per arm, one row per experiment."""
    is_a, is_b = F.col("arm") == "A", F.col("arm") == "B"
    converted = F.col("converted").cast("long")
    return units.groupBy(*by).agg(
        F.sum(F.when(is_a, converted).otherwise(0)).alias("x_a"), F.count(F.when(is_a, 1)).alias("n_a"),
        F.sum(F.when(is_b, converted).otherwise(0)).alias("x_b"), F.count(F.when(is_b, 1)).alias("n_b"))


def two_proportion_test(counts: DataFrame, alpha: float = 0.05, z_interval: float = Z_95) -> DataFrame:
    """Pooled z-test with an unpooled interval for every row of (x_a, n_a, x_b, n_b); null results for an empty arm."""
    p_a, p_b = F.try_divide("x_a", "n_a"), F.try_divide("x_b", "n_b")
    rated = counts.withColumns({"p_a": p_a, "p_b": p_b, "p_pool": F.try_divide(
        F.col("x_a") + F.col("x_b"), F.col("n_a") + F.col("n_b"))})
    p_a, p_b, pool = F.col("p_a"), F.col("p_b"), F.col("p_pool")
    gap = p_b - p_a
    standard_error = F.sqrt(pool * (1 - pool) * (F.try_divide(F.lit(1.0), F.col("n_a")) + F.try_divide(F.lit(1.0), F.col("n_b"))))
    unpooled = F.sqrt(F.try_divide(p_a * (1 - p_a), F.col("n_a")) + F.try_divide(p_b * (1 - p_b), F.col("n_b")))
    tested = rated.withColumns({
        "z": F.try_divide(gap, standard_error), "uplift_abs": gap, "uplift_rel": F.try_divide(gap, p_a),
        "ci_low": gap - z_interval * unpooled, "ci_high": gap + z_interval * unpooled})
    tested = tested.withColumn("p", two_sided_p(F.col("z")))
    return tested.withColumn("significant", F.col("p") < alpha).drop("p_a", "p_b", "p_pool")


def test_report(tested: DataFrame) -> DataFrame:
    """The published rounding of a test result."""
    digits = {"z": 3, "p": 5, "uplift_abs": 5, "uplift_rel": 4, "ci_low": 5, "ci_high": 5}
    return tested.withColumns({name: F.round(name, n) for name, n in digits.items()})


def required_size(baseline: Column, mde: float, alpha: float = 0.05, power: float = 0.8) -> Column:
    """Units per arm needed to see a relative change of `mde` over the baseline rate; null for a rate of zero."""
    target = baseline * (1 + mde)
    middle = (baseline + target) / 2
    spread = (F.lit(quantile(1 - alpha / 2)) * F.sqrt(2 * middle * (1 - middle))
              + F.lit(quantile(power)) * F.sqrt(baseline * (1 - baseline) + target * (1 - target)))
    return F.ceil(F.try_divide(spread * spread, (target - baseline) * (target - baseline)))


def analytic_power(baseline: Column, mde: float, size: Column, alpha: float = 0.05) -> Column:
    """Chance to detect the change with `size` units per arm: the inverse of `required_size`."""
    target = baseline * (1 + mde)
    middle = (baseline + target) / 2
    noise = F.sqrt(baseline * (1 - baseline) + target * (1 - target))
    distance = F.abs(target - baseline) * F.sqrt(size) - F.lit(quantile(1 - alpha / 2)) * F.sqrt(
        2 * middle * (1 - middle))
    return normal_cdf(F.try_divide(distance, noise))


def power_curve(baselines: DataFrame, mde: float, alpha: float = 0.05, power: float = 0.8,
                multiples: tuple[float, ...] = POWER_MULTIPLES) -> DataFrame:
    """Power at several multiples of the required size, one row per baseline and multiple."""
    sized = baselines.withColumn("required_n", required_size(F.col("p_baseline"), mde, alpha, power))
    each = sized.withColumn("multiple", F.explode(F.array(*[F.lit(float(m)) for m in multiples])))
    size = F.floor(F.col("required_n") * F.col("multiple"))
    return each.withColumn("n", size).withColumn(
        "power", analytic_power(F.col("p_baseline"), mde, F.col("n").cast("double"), alpha))


def replayed_counts(units: DataFrame, replicates: int) -> DataFrame:
    """Counts of `replicates` independent random splits of the same units: no true difference exists.

    One md5 of (block, unit) yields 32 split bits. A row per unit and block adds to 32 pairs of counters inside the
    map-side aggregation; replicates become rows only after the sums, so (block, partial counts) is all that is shuffled.
    """
    blocks = (replicates + BITS_PER_DIGEST - 1) // BITS_PER_DIGEST
    # Units are few bytes and much work: left alone, a few tasks would hold all of them.
    context = units.sparkSession.sparkContext
    dealt = units.repartition(max(shuffle_partitions(units.sparkSession), TASKS_A_CORE * context.defaultParallelism), "unit")
    hashed = dealt.select(F.col("converted").cast("long").alias("converted"), "unit",
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    hashed = hashed.select("converted", "block", digest(F.col("block"), F.col("unit")).alias("hex"))
    in_b = [F.substring("hex", bit + 1, 1).isin(*"13579bdf") for bit in range(BITS_PER_DIGEST)]
    sums = hashed.groupBy("block").agg(
        F.count("converted").alias("n"), F.sum("converted").alias("x"),
        *[F.count(F.when(odd, F.col("converted"))).alias(f"n_{bit}") for bit, odd in enumerate(in_b)],
        *[F.sum(F.when(odd, F.col("converted")).otherwise(0)).alias(f"x_{bit}") for bit, odd in enumerate(in_b)])
    each = sums.select("block", "n", "x", F.posexplode(F.array(*[
        F.struct(F.col(f"x_{bit}").alias("x_b"), F.col(f"n_{bit}").alias("n_b")) for bit in range(BITS_PER_DIGEST)])))
    counts = each.select(
        (F.col("block") * BITS_PER_DIGEST + F.col("pos")).alias("replicate"),
        (F.col("x") - F.col("col.x_b")).alias("x_a"), (F.col("n") - F.col("col.n_b")).alias("n_a"), "col.x_b", "col.n_b")
    return counts.filter(F.col("replicate") < replicates)


def false_positive_rate(units: DataFrame, replicates: int = 2000, alpha: float = 0.05) -> DataFrame:
    """Share of no-difference replays called significant; healthy up to one and a half times alpha."""
    tested = two_proportion_test(replayed_counts(units, replicates), alpha)
    return tested.agg(F.count(F.lit(1)).alias("replicates"),
                      F.avg(F.coalesce("significant", F.lit(False)).cast("double")).alias("false_positive_rate")
                      ).withColumn("healthy", F.col("false_positive_rate") <= 1.5 * alpha)
