"""A search index kept in files and grown by batches, for searches that don't read the corpus again.

Every batch is a segment: postings by bucket of the term and in order of the term, chunks, how many chunks of the batch
hold each term, and last a row of totals that makes the segment count. Document frequencies and the mean length of the
whole index are sums over segments, so an index grown by batches scores like one built at once. A search reads the buckets of
its own terms only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.operators import retrieval
from fathomline.session import collect_bounded

BUCKETS = 64
MAX_SEGMENTS = 10_000
CHUNKS_OF_PART = 4096
_TOTALS = "segment string, n_chunks long, total_length long"


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _totals(spark: SparkSession, path: str) -> DataFrame:
    """One row for each finished segment; none where there is no index yet."""
    try:
        return spark.read.schema(_TOTALS).parquet(f"{path}/totals")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _TOTALS)


def append(chunks: DataFrame, path: str, batch: str | None = None, unicode_words: bool = False) -> bool:
    """Add chunks (doc, chunk_no, section, text) as a segment. A named batch that is there already is left as it is (False).

    The totals are written last and in one file: a batch that failed before has no effect, and can be added again.
    """
    spark = chunks.sparkSession
    segment = batch or uuid.uuid4().hex
    if "|" in segment or "/" in segment:
        raise ValueError("the name of a batch has no | and no /")
    if not _totals(spark, path).filter(F.substring_index("segment", "|", 1) == segment).isEmpty():
        return False
    # Files of an attempt that failed stay apart, as every attempt has a folder of its own.
    folder = f"{segment}-{uuid.uuid4().hex}"
    built = retrieval.build_index(chunks, unicode_words)
    postings = built.postings.withColumn("bucket", _bucket(F.col("term")))
    # Ranges go on inside a term, so a term that most chunks hold is several files.
    order = ["bucket", "term", *retrieval.CHUNK]
    postings.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("bucket").parquet(f"{path}/postings/{folder}")
    counts = retrieval.document_frequency(built.postings).withColumn("bucket", _bucket(F.col("term")))
    counts.repartitionByRange("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms/{folder}")
    built.kept.select(*retrieval.CHUNK, "section", "text").write.parquet(f"{path}/chunks/{folder}")
    built.kept.agg(F.lit(folder).alias("segment"), F.count(F.lit(1)).alias("n_chunks"),
                   F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("total_length")).select(
        F.concat_ws("|", F.lit(segment), "segment").alias("segment"), "n_chunks", "total_length").coalesce(1).write.mode(
        "append").parquet(f"{path}/totals")
    built.release()
    return True


@dataclass(frozen=True)
class StoredIndex:
    """The finished segments of an index, as `retrieval` reads one."""

    spark: SparkSession
    path: str
    folders: tuple[str, ...]
    totals: DataFrame
    parts: int

    @property
    def chunks(self) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/chunks/{f}" for f in self.folders])

    @property
    def stats(self) -> DataFrame:
        return self.totals.agg(F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("n_chunks"), F.coalesce(
            F.try_divide(F.sum("total_length"), F.sum("n_chunks")), F.lit(0.0)).alias("avg_length"))

    def _of_terms(self, kind: str, terms: DataFrame) -> DataFrame:
        """Rows of a segmented table for some terms: only files of their buckets are listed and read."""
        placed = terms.withColumn("bucket", _bucket(F.col("term")))
        buckets = [r["bucket"] for r in collect_bounded(placed.select("bucket").distinct(), BUCKETS, "buckets")]
        parts = [self.spark.read.parquet(f"{self.path}/{kind}/{f}").filter(F.col("bucket").isin(buckets)) for f in self.folders]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        return every.join(placed, ["bucket", "term"], "left_semi").drop("bucket")

    def relevant(self, terms: DataFrame) -> DataFrame:
        return self._of_terms("postings", terms)

    def packed(self, terms: DataFrame) -> DataFrame:
        """As of a `TextIndex`, but a row for each posting of the terms."""
        return self.relevant(terms).select(*retrieval.CHUNK, "length", F.col("term").alias("words"), F.array("tf").alias("tfs"),
                                           F.array("section_tf").alias("section_tfs"))

    def frequencies(self, terms: DataFrame, relevant: DataFrame) -> DataFrame:
        return self._of_terms("terms", terms).groupBy("term").agg(F.sum("df").alias("df"))


def open_index(spark: SparkSession, path: str) -> StoredIndex:
    """What is finished now; segments that come later don't change it."""
    rows = collect_bounded(_totals(spark, path).select("*"), MAX_SEGMENTS, "segments")
    if not rows:
        raise ValueError(f"no finished segment in {path}")
    first: dict[str, tuple] = {}
    for r in sorted(map(tuple, rows)):  # a batch that two writers added at once counts once
        first.setdefault(r[0].split("|")[0], r)
    parts = 1 + sum(r[1] for r in first.values()) // CHUNKS_OF_PART
    return StoredIndex(spark, path, tuple(r[0].split("|")[1] for r in first.values()), spark.createDataFrame(list(first.values()), _TOTALS),
                       parts)
