"""Token counts from an exact histogram of encoded lengths."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import landed, pick
from fathomline.llm.tokens import default_vocabulary, encoder

#: Lengths whose sums are taken together before the running sums are formed.
RANGE = 1024


def length_histogram(docs: DataFrame, text_column: str = "text", vocabulary: str | None = None) -> DataFrame:
    """n_tokens, n_docs: number of documents by encoded length, without special tokens.

    Texts are encoded where they are read and each task sums its lengths before the shuffle, so what moves is bounded by
    tasks x distinct lengths, however many documents share a length. Null and empty texts have length 0.
    """
    path = vocabulary or default_vocabulary()

    def measure(batches):
        ids = encoder(path).ids
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(ids(t)) // 4 for t in batch["text"].to_pylist()], pa.int64())], ["n_tokens"])

    lengths = pick(docs, {"text": (text_column, "string")}).mapInArrow(measure, "n_tokens long")
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each distinct length as context limit: what is at most as long, what is longer, and the truncated total.

    Columns: n_tokens, n_docs, docs_at_most, tokens_at_most, docs_longer, tokens_longer, truncated_total (every document
    cut to n_tokens), tokens_lost, share_at_most. Between two lengths nothing changes but the limit itself, so these rows
    answer every limit. Sums run inside ranges of lengths and over the totals of ranges; no task holds all lengths. An empty histogram gives no rows.
    """
    rows = landed(histogram.withColumns({
        "tokens": F.col("n_tokens") * F.col("n_docs"), "range": F.floor(F.col("n_tokens") / RANGE)}), "lengths")
    ranges = rows.groupBy("range").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("all_tokens"))
    above = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select(
        "range", F.coalesce(F.sum("docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("all_tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("docs").over(everything).alias("docs_all"), F.sum("all_tokens").over(everything).alias("tokens_all"))
    longer = Window.partitionBy("range").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(ranges, "range").withColumns({
        "docs_longer": F.col("docs_above") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0)),
        "tokens_longer": F.col("tokens_above") + F.coalesce(F.sum("tokens").over(longer), F.lit(0))})
        .select("n_tokens", "n_docs", (F.col("docs_all") - F.col("docs_longer")).alias("docs_at_most"),
                (F.col("tokens_all") - F.col("tokens_longer")).alias("tokens_at_most"), "docs_longer", "tokens_longer",
                (F.col("tokens_all") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer"))
                .alias("truncated_total"),
                (F.col("tokens_longer") - F.col("n_tokens") * F.col("docs_longer")).alias("tokens_lost"),
                ((F.col("docs_all") - F.col("docs_longer")) / F.col("docs_all")).alias("share_at_most")))


def totals(histogram: DataFrame, limits: list[int], quantiles: list[float]) -> DataFrame:
    """One row: documents, tokens, truncated_<limit> for each limit and q<quantile> (smallest length that reaches it).

    An empty histogram gives zeros, and null quantiles.
    """
    n, count = F.col("n_tokens"), F.col("n_docs")
    sums = suffix_sums(histogram)
    return sums.agg(
        F.coalesce(F.sum(count), F.lit(0)).alias("documents"), F.coalesce(F.sum(n * count), F.lit(0)).alias("tokens"),
        *[F.coalesce(F.sum(F.least(n, F.lit(limit)) * count), F.lit(0)).alias(f"truncated_{limit}") for limit in limits],
        *[F.min(F.when(F.col("share_at_most") >= q, n)).alias(f"q{q:g}") for q in quantiles])
