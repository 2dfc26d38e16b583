"""Running totals and positions inside groups of any size.

A window over a whole group would put that group into one task. Here every group is cut into ranges of the
ordering value; a small table holds one total per (group, range); the running total of a row is the total of
the ranges before its own plus the running total inside its range.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.hashing import range_of

ROWS_PER_RANGE = 100_000
MAX_VALUE_RANGES = 4096
HASH_DIGITS = 4


def _totals_before(df: DataFrame, keys: list[str], slot: str, measures: list[str]) -> DataFrame:
    """Per (keys, slot): sum of every measure over the slots before it; one row per slot, so groups are bounded."""
    earlier = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, slot).agg(*[F.sum(m).alias(m) for m in measures])
    return totals.select(*keys, slot, *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_before")
                                        for m in measures])


def _add_running(df: DataFrame, keys: list[str], slot: str, order: list[str], measures: list[str]) -> DataFrame:
    """Add `<measure>_before`: the sum over all rows of the group that come earlier in the order."""
    inside = Window.partitionBy(*keys, slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(_totals_before(df, keys, slot, measures), [*keys, slot])
    return joined.withColumns({f"{m}_before": F.col(f"{m}_before") + F.coalesce(F.sum(m).over(inside), F.lit(0))
                               for m in measures}).drop(slot)


def running_by_value(counts: DataFrame, keys: list[str], value: str, measures: list[str],
                     rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Exclusive running sums of `measures` in order of a numeric value.

    `counts` holds one row per (keys, value). The range limits are quantiles of the values, so ranges stay
    even under skewed values; where exactly they fall has no effect on the result.
    """
    counts = counts.persist()
    ranges = min(MAX_VALUE_RANGES, 1 + counts.count() // rows_per_range)
    limits = [] if ranges == 1 else counts.approxQuantile(
        value, [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    splits = [-float("inf"), *sorted(set(limits)), float("inf")]
    slotted = Bucketizer(splits=splits, inputCol=value, outputCol="value_range").transform(counts) \
        if limits else counts.withColumn("value_range", F.lit(0.0))
    return _add_running(slotted, keys, "value_range", [value], measures)


def position_by_hash(df: DataFrame, keys: list[str], hex_digest: str, tie_break: str) -> DataFrame:
    """Add `position`: 0-based place of each row in its group in the order of an md5 digest.

    Digests are uniform, so the 65,536 ranges of a group are even however large the group is.
    """
    slotted = df.withColumns({"hash_range": range_of(F.col(hex_digest), HASH_DIGITS), "one": F.lit(1).cast("long")})
    ranked = _add_running(slotted, keys, "hash_range", [hex_digest, tie_break], ["one"])
    return ranked.withColumnRenamed("one_before", "position").drop("one")
