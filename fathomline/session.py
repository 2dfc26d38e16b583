"""Session helpers shared by the operators: where to cut lineage and how to bound what reaches the driver."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARTS_A_SPLIT = 4
# Rows that are worth a task of their own in a job that is repeated often, and rows that one task of it holds at most.
LEAST_ROWS, MOST_ROWS = 2_000, 50_000


def shared_top(spark: SparkSession) -> str:
    """The shared folder that the cluster names, or one below the warehouse where it names none."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


def new_shared_folder(spark: SparkSession, what: str) -> str:
    """Path of a folder of its own for files that driver and executors both see."""
    return f"{shared_top(spark)}/{what}-{uuid.uuid4().hex}"


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point the context at the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_top(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and read it back, so that a lost executor costs one stage."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def collect_bounded(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a table that is small by design; fails loudly instead of flooding the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows, too many to hold on the driver")
    return rows


def shuffle_partitions(spark: SparkSession) -> int:
    """Partition count the cluster was sized for; naming it keeps small but costly stages from being merged."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_of(scan: DataFrame) -> int:
    """Parts that grow with a scan: some for each of its splits, and one for every core at least."""
    return max(scan.sparkSession.sparkContext.defaultParallelism, PARTS_A_SPLIT * scan.rdd.getNumPartitions())


def spread_out(scan: DataFrame, key: str) -> DataFrame:
    """Deal a scan by a key into `parts_of` it: as many as the cores would grow with the input, as few files can't be split."""
    return scan.repartition(parts_of(scan), key)


def over_cores(df: DataFrame) -> DataFrame:
    """Deal a written table over all cores, as repeated passes over its rows take long however few bytes they have."""
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(cores, rows // LEAST_ROWS), -(-rows // MOST_ROWS)))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action that is planned in here go when it ends. For actions that write their result; tables that
    are read later must be planned outside.
    """
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_SETTING) if before is None else spark.conf.set(CLEANUP_SETTING, before)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of `new_shared_folder`, or one below it, that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
