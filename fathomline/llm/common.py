"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most so many narrow rows may be broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000

_LOWER_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of UTF-8 text with A-Z lower-cased; none for null."""
    return text.translate(_LOWER_WORDS).split() if text else []


def pick(rows: DataFrame, names: Mapping[str, Column | str | tuple[str, str]]) -> DataFrame:
    """The named columns only, found by exact name, so that other columns never clash with the operator's own.

    `names` maps an own name to a column of `rows`, or to (column, type) for a cast.
    """
    plain, given = rows.toDF(*(f"c{i}" for i in range(len(rows.columns)))), rows.columns

    def column(name: str | tuple[str, str]) -> Column:
        name, kind = name if isinstance(name, tuple) else (name, None)
        found = F.col(f"c{given.index(name)}")
        return found.cast(kind) if kind else found

    return plain.select(*(column(name).alias(own) for own, name in names.items()))


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir; below the warehouse where it is unset."""
    top = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(
        spark.conf.get("spark.sql.warehouse.dir"), "checkpoints")
    return f"{top.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def landed(rows: DataFrame, what: str, codec: str = "zstd") -> DataFrame:
    """`rows` written once as a table in the shared folder and read back: lineage is cut, lost executors cost nothing."""
    folder = shared_folder(rows.sparkSession, what)
    rows.write.option("compression", codec).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def small_or_shuffled(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A landed table, hinted for a broadcast if its counted rows are within the limit and for a sort-merge join else."""
    return F.broadcast(rows) if rows.count() <= limit else rows.hint("merge")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
