"""Document quality by attention over passages (gated attention of Ilse, Tomczak and Welling, 2018).

A document is a bag of passages. Each passage is encoded by a learnt layer, a learnt gate weighs it, and the document's
score is that of the weighted mean of its passages. Only labels of documents are used; which passages matter is learnt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed, pick

#: Words of a passage; a passage also ends after so many bytes of a text.
PASSAGE_WORDS, PIECE_BYTES = 64, 1 << 22
#: Labelled documents of each class that are learnt from (expected number; they are drawn by a hash of their id).
SAMPLE_PER_CLASS = 4_000
#: Parts of the sample that learn side by side, rounds after which their weights are averaged, passes over a part in a round.
SHARDS, ROUNDS, PASSES = 6, 10, 3
#: Documents of a step, its size, and the pull of the weights to 0.
STEP_DOCS, STEP, DECAY = 32, 0.01, 1e-4
#: Widths of the encoded passage and of its gate.
ENCODED, GATE = 24, 12
SEED = 42
#: Bytes of text that are scored at a time.
BATCH_BYTES = 1 << 21

_WORD_BUCKETS = 256
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _byte_kinds() -> np.ndarray:
    """Sixteen kinds of bytes: letters, digits, spaces, line ends, groups of ASCII marks, and bytes above ASCII."""
    kinds = np.full(256, 15, np.uint8)
    for kind, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c",
                                    b"\n\r", b".,;:", b"!?", b"'\"`", b"()[]{}", b"#*", b"$%&", b"<>|\\/", b"-_=+~^@")):
        kinds[list(members)] = kind
    kinds[:32][kinds[:32] == 15] = 13
    kinds[128:] = 14
    return kinds


_KINDS = _byte_kinds()
#: Neighbouring kinds of bytes, hashed words, and five shares that describe repetition and size.
WIDTH = 256 + _WORD_BUCKETS + 5


def _per_word(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, values.dtype)


_POWERS = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    """Powers of an odd number modulo 2^64."""
    if len(_POWERS[0]) < n:
        found = np.full(2 * n, 0x9E3779B97F4A7C15, np.uint64)
        found[0] = 1
        _POWERS[0] = np.multiply.accumulate(found)
    return _POWERS[0]


def _piece_features(data: np.ndarray, piece: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of `pieces` runs of bytes, and the run of each; a run without words has one of zeros."""
    space = _SPACE[data]
    inside = ~space
    fresh = np.ones(len(data), bool)
    fresh[1:] = space[:-1] | (piece[1:] != piece[:-1])
    starts = np.flatnonzero(inside & fresh)
    of_word = piece[starts]
    # The position of a word in its run gives its passage; a run without words has one passage.
    words = np.bincount(of_word, minlength=pieces)
    before = np.cumsum(words) - words
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    first = np.cumsum(passages) - passages
    own = first[of_word] + (np.arange(len(starts)) - before[of_word]) // PASSAGE_WORDS
    count = int(passages.sum())
    owner = np.repeat(np.arange(pieces), passages)
    rows = np.zeros((count, WIDTH), np.float32)
    if not len(starts):
        return rows, owner
    # Bytes go with the word that they are in or follow; space before the first word of a run doesn't count.
    word = np.maximum(np.cumsum(inside & fresh) - 1, 0)
    placed = (of_word[word] == piece) & (starts[word] <= np.arange(len(data)))
    of_byte = own[word]
    kinds = _KINDS[data].astype(np.int64)
    pair = (of_byte[:-1] * 256 + kinds[:-1] * 16 + kinds[1:])[(piece[1:] == piece[:-1]) & placed[:-1]]
    rows[:, :256] = np.bincount(pair, minlength=count * 256).reshape(count, 256)
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64) + np.uint64(1)
    place = np.where(inside, np.arange(len(data)) - starts[word], 0)
    hashes = _per_word(np.where(inside, lower * _powers(int(place.max()) + 1)[place], np.uint64(0)), starts)
    hashes = (hashes ^ hashes >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (hashes >> np.uint64(56)).astype(np.int64)
    rows[:, 256:256 + _WORD_BUCKETS] = np.bincount(own * _WORD_BUCKETS + bucket, minlength=count * _WORD_BUCKETS).reshape(count, -1)
    for part in (slice(0, 256), slice(256, 256 + _WORD_BUCKETS)):
        rows[:, part] = np.sqrt(rows[:, part] / np.maximum(rows[:, part].sum(axis=1, keepdims=True), 1))
    in_passage = np.bincount(own, minlength=count)
    some = np.maximum(in_passage, 1)
    order = np.lexsort((hashes, own))
    again = (own[order][1:] == own[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    same = (own[1:] == own[:-1]) & (hashes[1:] == hashes[:-1])
    letters = np.bincount(own, _per_word(inside.astype(np.int64), starts), count)
    rows[:, -5:] = np.stack([
        np.bincount(own[order][1:][again], minlength=count) / some, np.bincount(own[1:][same], minlength=count) / some,
        np.minimum(letters / some, 32) / 16, in_passage / PASSAGE_WORDS,
        np.minimum(np.bincount(of_byte[placed], minlength=count) / np.maximum(letters, 1), 4) / 4], axis=1)
    return rows, owner


def bags(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Batches of whole texts (binary): first and last text, feature rows of their passages, and the text of each row, from 0.

    Every text has at least one passage; a null or empty text or one without words has one of zeros.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    if texts.null_count:  # nulls have no bytes
        sizes = np.where(texts.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
    else:
        sizes = np.diff(offsets)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, begin + int(np.searchsorted(np.cumsum(sizes[begin:]), BATCH_BYTES, "right")))
        rows, owners = [], []
        if end == begin + 1 and sizes[begin] > PIECE_BYTES:  # a long text, piece by piece
            for at in range(0, sizes[begin], PIECE_BYTES):
                run = data[offsets[begin] + at:offsets[begin] + min(at + PIECE_BYTES, sizes[begin])]
                found, owner = _piece_features(run, np.zeros(len(run), np.int64), 1)
                rows.append(found)
                owners.append(owner)
        else:
            run = data[offsets[begin]:offsets[end]]
            found, owner = _piece_features(run, np.repeat(np.arange(end - begin), np.diff(offsets[begin:end + 1])), end - begin)
            rows, owners = [found], [owner]
        yield begin, end, np.concatenate(rows), np.concatenate(owners)
        begin = end


#: Shapes of the weights: encoder, gate (tanh and sigmoid halves and their mix), output.
_SHAPES = {"w": (WIDTH, ENCODED), "b": (ENCODED,), "v": (ENCODED, GATE), "u": (ENCODED, GATE), "m": (GATE,), "c": (ENCODED,), "o": (1,)}


@dataclass(frozen=True)
class Model:
    """Weights by name, or none, and the share of label 1 that stands for documents when nothing was learnt."""

    weights: dict[str, np.ndarray] | None
    prior: float

    def score(self, rows: np.ndarray, owner: np.ndarray, bags_: int) -> np.ndarray:
        """Probability of label 1 of every bag."""
        if self.weights is None:
            return np.full(bags_, self.prior)
        return _forward(self.weights, rows, owner, bags_)[-1]


def _start() -> dict[str, np.ndarray]:
    draw = np.random.default_rng(SEED)
    scale = {"w": 1.0, "v": 0.3, "u": 0.3, "m": 0.3, "c": 0.3}
    return {k: draw.normal(scale=scale[k], size=s).astype(np.float32) if k in scale else np.zeros(s, np.float32)
            for k, s in _SHAPES.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _forward(p: dict[str, np.ndarray], rows: np.ndarray, owner: np.ndarray, count: int) -> tuple:
    """Encoded passages, both halves of the gate, weights of the passages, weighted means and scores; owners are in order."""
    h = np.tanh(rows @ p["w"] + p["b"])
    t, s = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
    logit = (t * s) @ p["m"]
    at = np.searchsorted(owner, np.arange(count))
    e = np.exp(logit - np.maximum.reduceat(logit, at)[owner])
    a = e / np.add.reduceat(e, at)[owner]
    z = np.add.reduceat(a[:, None] * h, at)
    return h, t, s, a, z, _sigmoid(z @ p["c"] + p["o"])


def gradient(p: dict[str, np.ndarray], rows: np.ndarray, owner: np.ndarray, label: np.ndarray, weight: np.ndarray
             ) -> dict[str, np.ndarray]:
    """Of the weighted mean log loss of the bags; `label` may be a share."""
    h, t, s, a, z, y = _forward(p, rows, owner, len(label))
    d_out = (y - label) * weight / weight.sum()
    d_z = d_out[:, None] * p["c"]
    towards = (h * d_z[owner]).sum(axis=1)  # how the score of its bag grows with a passage's weight
    mean = (z * d_z).sum(axis=1)
    d_logit = a * (towards - mean[owner])
    d_t, d_s = (d_logit[:, None] * p["m"] * x for x in (s, t))
    d_t, d_s = d_t * (1 - t * t), d_s * s * (1 - s)
    d_h = (a[:, None] * d_z[owner] + d_t @ p["v"].T + d_s @ p["u"].T) * (1 - h * h)
    return {"w": rows.T @ d_h, "b": d_h.sum(axis=0), "v": h.T @ d_t, "u": h.T @ d_s, "m": (t * s).T @ d_logit,
            "c": z.T @ d_out, "o": np.array([d_out.sum()])}


def _learn(p: dict[str, np.ndarray], bag_rows: list[np.ndarray], label: np.ndarray, weight: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """PASSES passes of Adam over the bags of a part, in drawn order."""
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    draw, steps = np.random.default_rng(seed), 0
    for _ in range(PASSES):
        order = draw.permutation(len(label))
        for at in range(0, len(order), STEP_DOCS):
            chosen, steps = order[at:at + STEP_DOCS], steps + 1
            owner = np.repeat(np.arange(len(chosen)), [len(bag_rows[k]) for k in chosen])
            g = gradient(p, np.concatenate([bag_rows[k] for k in chosen]), owner, label[chosen], weight[chosen])
            for k in p:
                d = g[k].astype(np.float32) + DECAY * p[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                p[k] -= STEP * (first[k] / (1 - 0.9 ** steps)) / (np.sqrt(second[k] / (1 - 0.999 ** steps)) + 1e-8)
    return p


def _drawn(labels: DataFrame, per_class: int) -> tuple[DataFrame, float]:
    """id, label, weight of the documents to learn from, and the share of label 1 among all labelled ones.

    A document with several labels has their mean. Of each half (label at least 0.5 or not) those ids are drawn whose
    hash is below the share that `per_class` is; the weight is the inverse of that share.
    """
    one = labels.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~F.isnan("label")).groupBy("id").agg(
        F.avg("label").alias("label"))
    one = landed(one, "labels")
    upper = F.col("label") >= 0.5
    found = one.agg(F.count_if(upper).alias("upper"), F.count_if(~upper).alias("lower"), F.avg("label").alias("prior")).first()
    share = F.when(upper, min(1.0, per_class / max(1, found["upper"]))).otherwise(min(1.0, per_class / max(1, found["lower"])))
    drawn = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) < share * float(1 << 30)
    return one.filter(drawn).withColumn("weight", 1 / share), found["prior"]


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learn from the whole texts of labelled documents; `labels` has the id column and a label from 0 to 1.

    The drawn ids, about 2 x per_class, are sent to the documents, so only texts of the sample move. The encoded sample
    is written in SHARDS parts, each of which learns for itself; after every round the driver averages their weights.
    Null labels and ids don't count, of several documents with one id the smallest text does. Without a labelled
    document every score is the prior 0.5; with one class the model learns just that.
    """
    wanted, prior = _drawn(pick(labels, {"id": (id_column, "long"), "label": (label_column, "double")}), per_class)
    rows = pick(docs, {"id": (id_column, "long"), "text": (text_column, "string")})
    texts = rows.join(F.broadcast(wanted), "id").groupBy("id", "label", "weight").agg(F.min("text").alias("text"))
    texts = texts.repartition(SHARDS, F.pmod(F.xxhash64("id", F.lit(SEED + 1)), F.lit(SHARDS)))

    def encoded(batches):
        for batch in batches:
            for begin, end, features, owner in bags(batch.column("text").cast(pa.binary())):
                at = np.searchsorted(owner, np.arange(end - begin + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[begin:end] for c in ("id", "label", "weight")] + [pa.array(
                        [features[i:j].astype("<f2").tobytes() for i, j in zip(at, at[1:])], pa.binary())],
                    ["id", "label", "weight", "rows"])

    sample = landed(texts.mapInArrow(encoded, "id long, label double, weight double, rows binary")
                    .withColumn("shard", F.pmod(F.xxhash64("id", F.lit(SEED + 2)), F.lit(SHARDS))), "quality-sample")
    if sample.isEmpty():
        return Model(None, 0.5 if prior is None else prior)
    weights = _start()
    context = sample.sparkSession.sparkContext
    for at in range(ROUNDS):
        shared = context.broadcast(weights)

        def learn(group: pa.Table) -> pa.Table:
            group = group.sort_by("id")
            bag_rows = [np.frombuffer(r, "<f2").astype(np.float32).reshape(-1, WIDTH) for r in group["rows"].to_pylist()]
            label, weight = (group[c].to_numpy() for c in ("label", "weight"))
            found = _learn(shared.value, bag_rows, label, weight, at)
            flat = np.concatenate([found[k].ravel() for k in _SHAPES]).astype("<f4").tobytes()
            return pa.table({"n": [float(weight.sum())], "weights": [flat]})

        parts = sample.groupBy("shard").applyInArrow(learn, "n double, weights binary").collect()
        total = sum(r["n"] for r in parts)
        flat = sum(np.frombuffer(r["weights"], "<f4").astype(np.float64) * (r["n"] / total) for r in parts)
        cuts = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()])[:-1]
        weights = {k: v.reshape(s).astype(np.float32) for (k, s), v in zip(_SHAPES.items(), np.split(flat, cuts))}
        shared.destroy()
    return Model(weights, prior)


def score_documents(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, score (probability of label 1), n_passages.

    Every passage of a whole text takes part; null and empty texts and those without a word are one passage of zeros. Repeated rows
    and null ids each get their row. Texts are scored where they are read: nothing is shuffled, and the model's size
    doesn't depend on the corpus.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = pick(docs, {"id": (id_column, "long"), "text": (text_column, "string")})

    def score(batches):
        for batch in batches:
            for begin, end, features, owner in bags(batch.column("text").cast(pa.binary())):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[begin:end], pa.array(shared.value.score(features, owner, end - begin), pa.float64()),
                     pa.array(np.bincount(owner, minlength=end - begin), pa.int64())], ["id", "score", "n_passages"])

    return rows.mapInArrow(score, "id long, score double, n_passages long")


def in_fold(id_column: Column, folds: int = 5) -> Column:
    """Whether a document is held out: its id's CRC-32, as text, is divisible by `folds`."""
    return F.coalesce(F.crc32(id_column.cast("string")) % folds == 0, F.lit(False))
