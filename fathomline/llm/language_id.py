"""Language identification: the nearest of several clustered centroids per language, by cosine of TF-IDF n-gram vectors."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed, small_or_shuffled

#: Hash buckets of the byte 2-grams and 3-grams.
BUCKETS = 1 << 14
#: Labelled documents that a language is learnt from (expected number; they are drawn by a hash of id and text).
SAMPLE_PER_LABEL = 1_000
#: Centroids of a language, and rounds of their clustering.
CENTROIDS, ROUNDS = 4, 12
#: Labels whose centroids are held at once, CENTROIDS vectors of BUCKETS numbers each; more labels take more passes over the documents.
BLOCK_LABELS = 500
#: A text is rejected if it is this much less similar than the least similar in a thousand of the learnt texts of its size.
REJECT_QUANTILE, REJECT_SHARE = 0.001, 0.5

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PIECE = 1 << 20


def counts(text: bytes) -> np.ndarray:
    """Hashed counts of the byte 2-grams and 3-grams of the words of a whole text, lower-cased in ASCII."""
    total = np.zeros(BUCKETS, np.int64)
    plain = b" " + b" ".join(text.translate(_LETTERS).split()) + b" "
    for at in range(0, max(1, len(plain) - 2), _PIECE):
        a = np.frombuffer(plain, np.uint8, min(_PIECE + 2, len(plain) - at), at).astype(np.uint32)
        two = a[:-1] << np.uint32(8) | a[1:]
        three = (two[:-1] << np.uint32(8) | a[2:]) + np.uint32(1 << 24)
        if at + _PIECE + 2 < len(plain):
            two = two[:-1]
        for grams in (two, three):
            total += np.bincount(grams * np.uint32(0x9E3779B1) >> np.uint32(18), minlength=BUCKETS)
    return total


def _weighted(matrix: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as unit vectors of sqrt(count) x idf."""
    matrix = np.sqrt(matrix, dtype=np.float32) * idf
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), np.float32(1e-12))


def size_class(n: int) -> int:
    return int(n).bit_length()


@dataclass(frozen=True)
class Model:
    """Labels by centroid, centroids as unit rows, idf by bucket, and the least similarity by size class of a text."""

    labels: tuple[str, ...]
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray

    def predict(self, texts: list[bytes]) -> list[tuple[str | None, float, bool]]:
        """Label, cosine with its nearest centroid, and whether that is too far. A model without labels finds nothing too far."""
        if not texts or not self.labels:
            return [(None, 0.0, False)] * len(texts)
        raw = np.stack([counts(t) for t in texts])
        cosine = _weighted(raw, self.idf) @ self.centroids.T
        best, size = cosine.argmax(axis=1), raw.sum(axis=1)
        return [(self.labels[b], float(min(1.0, max(0.0, c[b]))), bool(c[b] <= self.least[size_class(n)]))
                for b, c, n in zip(best.tolist(), cosine, size.tolist())]


@dataclass(frozen=True)
class BlockedModel:
    """A model of more labels than are held at once: blocks of a written table of centroids, in order of label."""

    blocks: int
    centroids: DataFrame
    idf: np.ndarray
    least: np.ndarray

    def block(self, number: int) -> Model:
        return _model(self.centroids.filter(F.col("block") == number), self.idf, self.least)


def _model(centroids: DataFrame, idf: np.ndarray, least: np.ndarray) -> Model:
    found = sorted(centroids.select("label", "centres").collect(), key=lambda r: r.label)
    vectors = [np.frombuffer(r.centres, "<f4").reshape(-1, BUCKETS) for r in found]
    labels = tuple(r.label for r, rows in zip(found, vectors) for _ in rows)
    return Model(labels, np.concatenate(vectors) if vectors else np.zeros((0, BUCKETS), np.float32), idf, least)


def _cluster(matrix: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means from rows at even steps of similarity to the mean; rows and centroids are unit vectors."""
    order = np.argsort(matrix @ matrix.mean(axis=0), kind="stable")
    count = min(count, len(matrix))
    centres = matrix[order[(np.arange(count) * 2 + 1) * len(matrix) // (2 * count)]]
    for _ in range(ROUNDS):
        own = (matrix @ centres.T).argmax(axis=1)
        means = np.stack([matrix[own == k].sum(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
        centres = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), np.float32(1e-12))
    return centres


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


_COUNTED = "id string, text_hash long, label string, buckets binary, times binary"


def _counted(batches):
    """Labelled texts as sparse counts, so that no text is shuffled and a row has a size bound."""
    for batch in batches:
        found = [counts(text) for text in batch["text"].to_pylist()]
        buckets = [np.flatnonzero(row) for row in found]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["text_hash"], batch["label"],
             pa.array([at.astype("<u2").tobytes() for at in buckets], pa.binary()),
             pa.array([row[at].astype("<i8").tobytes() for row, at in zip(found, buckets)], pa.binary())],
            ["id", "text_hash", "label", "buckets", "times"])


def _frequencies(batches):
    """Documents by bucket of the rows of one task, and under -1 how many rows there are."""
    found, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for at in batch["buckets"].to_pylist():
            found[np.frombuffer(at, "<u2")] += 1
        rows += batch.num_rows
    some = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *some.tolist()], pa.int32()), pa.array([rows, *found[some].tolist()], pa.int64())], ["bucket", "n"])


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang",
        sample_per_label: int = SAMPLE_PER_LABEL, block_labels: int = BLOCK_LABELS) -> Model | BlockedModel:
    """Learn from the rows with a label and a letter in their text.

    Labels are counted over all rows; of a label with more than `sample_per_label` documents, those whose hash is below
    the share that this is are used, with their whole texts. The texts are counted where they are read; the sparse counts of the
    sample are written and clustered, one label to a task. The driver gets a vector of document frequencies, 64 limits of similarity,
    and the centroids of at most `block_labels` labels: with more labels they stay in a written table and are read block by block
    (BlockedModel). Repeated rows count as often as they are there; ties in counts or distances go to the first in order of label or
    row. Without a labelled row the model has no label and rejects nothing but texts without a letter.
    """
    given = labelled.columns
    plain = labelled.toDF(*(f"c{i}" for i in range(len(given))))
    column = lambda name: F.col(f"c{given.index(name)}")
    rows = plain.select(column(id_column).cast("string").alias("id"), column(text_column).cast("string").alias("text"),
                        column(label_column).cast("string").alias("label"))
    rows = rows.filter(F.col("label").isNotNull() & has_letter(F.col("text")))
    sizes = landed(rows.groupBy("label").agg(F.count("*").alias("n")), "label-sizes")
    drawn = (F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
             < F.least(F.lit(1.0), F.lit(float(sample_per_label)) / F.col("n")) * float(1 << 30))
    sample = landed(rows.join(small_or_shuffled(sizes), "label").filter(drawn)
                    .select("id", F.xxhash64("text").alias("text_hash"), "label", F.encode("text", "UTF-8").alias("text"))
                    .mapInArrow(_counted, _COUNTED), "language-sample")

    parts = sample.select("buckets").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r.bucket: r.n for r in parts.collect()}
    total, df = found.pop(-1, 0), np.zeros(BUCKETS)
    df[list(found)] = list(found.values())
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    def clusters(group: pa.Table) -> pa.Table:
        texts = sorted(zip(*(group[c].to_pylist() for c in ("id", "text_hash", "buckets", "times"))),
                       key=lambda x: (x[0] or "", *x[1:]))
        raw = np.zeros((len(texts), BUCKETS), np.float32)
        for row, (_, _, buckets, times) in zip(raw, texts):
            row[np.frombuffer(buckets, "<u2")] = np.frombuffer(times, "<i8")
        matrix = _weighted(raw, idf)
        centres = _cluster(matrix, CENTROIDS)
        # How near a text comes is measured with centroids of the other half of the sample.
        best = np.empty(len(matrix), np.float32)
        for half in (0, 1):
            other = matrix[1 - half::2] if len(matrix) > 1 else matrix
            best[half::2] = (matrix[half::2] @ _cluster(other, CENTROIDS).T).max(axis=1)
        return pa.table([
            pa.array([group["label"][0].as_py()], pa.string()), pa.array([centres.astype("<f4").tobytes()], pa.binary()),
            pa.array([[size_class(int(n)) for n in raw.sum(axis=1)]], pa.list_(pa.int32())),
            pa.array([best.tolist()], pa.list_(pa.float64()))], ["label", "centres", "sizes", "cosines"])

    learnt = landed(sample.groupBy("label").applyInArrow(
        clusters, "label string, centres binary, sizes array<int>, cosines array<double>"), "language-centroids")
    similar = learnt.select(F.explode(F.arrays_zip("sizes", "cosines")).alias("x")).groupBy(F.col("x.sizes").alias("size")).agg(
        F.percentile("x.cosines", F.lit(REJECT_QUANTILE)).alias("limit"))
    limits = {r.size: r.limit for r in similar.collect()}
    # A size that no learnt text has takes the limit of the next longer one; no text needs more than a longer one does.
    least = np.ones(65, np.float32)
    for size in reversed(range(64)):
        least[size] = min(least[size + 1], REJECT_SHARE * limits[size] if size in limits else 1.0)
    least = np.where(least == 1.0, least.min(initial=1.0), least)

    labels = sizes.count()
    if labels <= block_labels:
        return _model(learnt, idf, least)
    # Labels are dealt by hash: blocks hold about four fifths of the limit.
    blocks = 1 + 5 * labels // (4 * block_labels)
    dealt = learnt.select("label", "centres", F.pmod(F.xxhash64("label"), F.lit(blocks)).alias("block"))
    return BlockedModel(blocks, landed(dealt, "language-blocks"), idf, least)


def _scored(model: Model, batch: int):
    """id, label, cosine and rejection of rows (id, text); null texts have none."""
    def score(batches):
        for rows in batches:
            texts = rows["text"].to_pylist()
            found: list = [("und", 0.0, True)] * len(texts)
            known = [k for k, t in enumerate(texts) if t is not None]
            for k in range(0, len(known), batch):
                part = known[k:k + batch]
                for n, (label, cosine, far) in zip(part, model.value.predict([texts[n] for n in part])):
                    found[n] = (label or "und", cosine, far)
            labels, cosines, far = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([rows["id"], pa.array(labels, pa.string()), pa.array(cosines, pa.float64()),
                                              pa.array(far, pa.bool_())], ["id", "lang_pred", "score", "rejected"])
    return score


_SCORED = "id long, lang_pred string, score double, rejected boolean"


def _scored_in_blocks(texts: DataFrame, model: BlockedModel, batch: int) -> DataFrame:
    """The nearest label of all blocks for rows (id, text), whose ids are row numbers: one pass and one written table a block."""
    passes = None
    for number in range(model.blocks):
        shared = texts.sparkSession.sparkContext.broadcast(model.block(number))
        found = landed(texts.mapInArrow(_scored(shared, batch), _SCORED), "language-scores")
        shared.destroy()
        passes = found if passes is None else passes.unionByName(found)
    # Equally near labels: the first in order.
    best = passes.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("far"), "lang_pred", "rejected")).alias("x"))
    return best.select("id", "x.lang_pred", (-F.col("x.far")).alias("score"), "x.rejected")


def classify(docs: DataFrame, model: Model | BlockedModel, id_column: str = "doc_id", text_column: str = "text",
             batch: int = 64) -> DataFrame:
    """One row per document: id, lang_pred, score, rejected.

    The label of the nearest centroid and the cosine with it, of the whole text. `rejected` where it is too far from
    every centroid for its size. Null texts and texts without a letter are `und`, 0 and rejected; a model without labels calls all
    `und`, 0, and rejects no text with a letter. Equally near centroids go to the first label in order. Repeated rows each get their row, null ids stay.
    Texts are scored where they are read: nothing is shuffled. The model's size doesn't depend on the corpus. A BlockedModel takes a
    pass over the numbered documents for each of its blocks; the best of all passes meet by that number.
    """
    at = docs.columns.index
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = F.col(f"c{at(text_column)}").cast("string")
    rows = plain.select(F.col(f"c{at(id_column)}").cast("long").alias("id"),
                        F.when(has_letter(text), F.encode(text, "UTF-8")).alias("text"))
    if isinstance(model, Model):
        return rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model), batch), _SCORED)
    numbered = landed(rows.withColumn("row", F.monotonically_increasing_id()), "numbered-texts")
    found = _scored_in_blocks(numbered.select(F.col("row").alias("id"), "text"), model, batch)
    return (numbered.select("id", "row").join(found.withColumnRenamed("id", "row"), "row")
            .select("id", "lang_pred", "score", "rejected"))


def keep_known(docs: DataFrame, model: Model | BlockedModel, text_column: str = "text", batch: int = 64) -> DataFrame:
    """The documents that are not rejected, with the columns of `docs`; see classify."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = F.col(f"c{docs.columns.index(text_column)}").cast("string")
    rows = plain.filter(has_letter(text)).withColumn("x_text", F.encode(text, "UTF-8"))
    if isinstance(model, BlockedModel):
        rows = landed(rows.withColumn("x_row", F.monotonically_increasing_id()), "numbered-texts")
        found = _scored_in_blocks(rows.select(F.col("x_row").alias("id"), F.col("x_text").alias("text")), model, batch)
        known = landed(found.filter("not rejected").select(F.col("id").alias("x_row")), "known-rows")
        return rows.join(small_or_shuffled(known), "x_row", "left_semi").select(*plain.columns).toDF(*docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def near(batches):
        for found in batches:
            texts = found["x_text"].to_pylist()
            keep = [not far for k in range(0, len(texts), batch) for _, _, far in shared.value.predict(texts[k:k + batch])]
            yield found.filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(near, rows.schema).drop("x_text").toDF(*docs.columns)
