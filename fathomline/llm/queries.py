"""The registered queries of this subpackage and the SQL twins of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm import (
    alignment, decontaminate, exact_dedup, language_id, near_join, packing, pii, quality, secret_scan, suffix_dedup,
    token_counts, warc, whitening)
from fathomline.llm.common import table


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("x_held_out", F.coalesce(
        F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))
    model = language_id.fit(docs.filter(~F.col("x_held_out")))
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % 4 == 2, F.lit(False))
    return language_id.classify(docs, model).select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.length_histogram(table(spark, folder, "documents")))


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    classes = near_join.similarity_classes(table(spark, folder, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_shingles")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    labels = exact_dedup.label_copies(table(spark, folder, "documents"), digest_all=True)
    return labels.select(F.col("id").alias("doc_id"), "keep_id", F.col("group_size").cast("long").alias("group_size"),
                         "kept", "text_sha256")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii.find_personal_data(table(spark, folder, "documents"))
    base, spans = pii.described_spans()
    return rows.select(F.col("id").alias("doc_id"), *[f"n_{kind}" for kind in pii.KINDS],
                       F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.write_archive(table(spark, folder, "pages"))
    return warc.read_index(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = secret_scan.find_secrets(table(spark, folder, "documents"))
    base, spans = secret_scan.described_spans()
    return rows.select(F.col("id").alias("doc_id"), *[f"n_{kind}" for kind in secret_scan.KINDS],
                       F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.usable_rows(table(spark, folder, "embeddings"))
    model = whitening.fit(rows)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return whitening.transform(rows, model).select(
        F.col("id").alias("vec_id"), "n", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"))


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    model = quality.fit(docs, labels.filter(~quality.in_fold(F.col("doc_id"))))
    return quality.score_documents(docs, model).select(
        F.col("id").alias("doc_id"), quality.in_fold(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_passages")


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    aligned = alignment.aligned_documents(table(spark, folder, "documents"))
    return alignment.link_scores(aligned, alignment.pair_counts(aligned)).withColumnRenamed("id", "doc_id")


_ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all(coalesce({_ASCII_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = f"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, m, item FROM starts JOIN windows USING (m, s)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY 1),
hit_items AS (SELECT doc_id, list(DISTINCT item) AS items FROM hits GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(array_to_string(list_sort(coalesce(items, [])), ',')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

OP6_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept,
       sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)"""

OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
digits AS (SELECT page_id, h, first, sha1(h) AS x FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
         (('0x' || substr(x, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))::BIGINT) & 31)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM digits"""

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_ngram_join": op5_ngram_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_packing": op7_packing,
    "op8_pii": op8_pii,
    "op9_warc": op9_warc,
    "op10_secret_scan": op10_secret_scan,
    "op11_whitening": op11_whitening,
    "op12_quality": op12_quality,
    "op13_alignment": op13_alignment,
}

ORACLE = {"op2_decontamination": OP2_SQL, "op6_exact_dedup": OP6_SQL, "op9_warc": OP9_SQL}
