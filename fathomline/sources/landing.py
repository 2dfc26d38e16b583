"""Landed web responses: canonical request address, cache key, one stored payload per key."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.session import collect_bounded

# Leading digits of a cache key that name its part of a store: 256 parts, and a batch rewrites those that it touches.
PREFIX_DIGITS = 2


def quote_plus(text: Column) -> Column:
    """Form encoding where `~` stays and `*` is escaped (the JVM encoder does the opposite)."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(base: Column, params: Column) -> Column:
    """`base?name=value&...` from an array of (name, values); a name with many values is repeated."""
    pairs = F.flatten(F.transform(params, lambda p: F.transform(
        p["values"], lambda value: F.concat(quote_plus(p["name"]), F.lit("="), quote_plus(value)))))
    return F.when(F.size(pairs) > 0, F.concat(base, F.lit("?"), F.array_join(pairs, "&"))).otherwise(base)


def cache_key(url: Column) -> Column:
    return F.substring(F.sha1(url), 1, 20)


def stored_payloads(landed: DataFrame, refresh: bool = True) -> DataFrame:
    """One response per cache key: the newest when responses are refreshed, else the first one stored.

    Responses fetched at the same time are ordered by a digest of their columns, so exactly one comes back. Every task
    keeps one response per key before the shuffle, so a key fetched very often never gathers its payloads in one task.
    """
    others = [c for c in landed.columns if c != "fetched_at"]
    response, order = F.struct(*others), F.struct("fetched_at", F.sha2(F.to_json(F.struct(*others)), 256))
    pick = F.max_by if refresh else F.min_by
    kept = landed.groupBy(cache_key(F.col("url")).alias("cache_key")).agg(
        (F.max if refresh else F.min)("fetched_at").alias("fetched_at"), pick(response, order).alias("response"))
    return kept.select("cache_key", "fetched_at", "response.*")


_CATALOGUE = "prefix string, version long, folder string"


def _prefix() -> Column:
    """Part of a key; responses without an address have one of their own."""
    return F.coalesce(F.substring("cache_key", 1, PREFIX_DIGITS), F.lit("none"))


def _current(spark: SparkSession, store: str) -> dict[str, tuple[int, str]]:
    """Newest version and folder of every part of a store; nothing where there is no store yet."""
    try:
        rows = spark.read.schema(_CATALOGUE).parquet(f"{store}/catalogue")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    newest = rows.groupBy("prefix").agg(F.max(F.struct("version", "folder")).alias("v")).select("prefix", "v.*")
    return {r["prefix"]: (r["version"], r["folder"]) for r in collect_bounded(newest, 1 + 16 ** PREFIX_DIGITS, "parts of the store")}


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """The stored response of every key, as far as batches were merged completely."""
    parts = _current(spark, store)
    if not parts:
        raise ValueError(f"nothing is stored in {store}")
    return spark.read.parquet(*[f"{store}/parts/{folder}/prefix={prefix}" for prefix, (_, folder) in sorted(parts.items())])


def merge_batch(landed: DataFrame, store: str, refresh: bool = True) -> None:
    """Merge landed responses (url, fetched_at and others) into a store of one response per cache key; see stored_payloads.

    Parts are cut by the leading digits of the key. Only parts that the batch touches are read, merged and written, into a
    new folder; the catalogue then names them, in one small file, so readers see the whole batch or nothing of it. A batch
    that failed, or comes again, merges to the same rows. One writer at a time.
    """
    spark = landed.sparkSession
    kept = stored_payloads(landed, refresh).withColumn("prefix", _prefix())
    folder = uuid.uuid4().hex
    fresh = f"{store}/fresh/{folder}"
    kept.hint("rebalance", "prefix").write.partitionBy("prefix").parquet(fresh)  # it is read twice below
    batch = spark.read.schema(kept.schema).parquet(fresh)
    touched = sorted(r["prefix"] for r in collect_bounded(batch.select("prefix").distinct(), 1 + 16 ** PREFIX_DIGITS, "parts of a batch"))
    if not touched:
        return
    parts = _current(spark, store)
    old = [f"{store}/parts/{parts[p][1]}/prefix={p}" for p in touched if p in parts]
    every = batch.drop("prefix")
    if old:
        every = every.unionByName(spark.read.schema(every.schema).parquet(*old))
    merged = stored_payloads(every.drop("cache_key"), refresh).withColumn("prefix", _prefix())
    merged.hint("rebalance", "prefix").write.partitionBy("prefix").parquet(f"{store}/parts/{folder}")
    rows = [(p, 1 + max((v for v, _ in parts.values()), default=0), folder) for p in touched]
    spark.createDataFrame(rows, _CATALOGUE).coalesce(1).write.mode("append").parquet(f"{store}/catalogue")
