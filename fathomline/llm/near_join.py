"""Similarity join on word n-grams: a MinHash LSH forest for candidates, exact Jaccard similarity for links."""

from __future__ import annotations

import functools
import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed, small_or_shuffled, words_of
from fathomline.llm.components import components
from fathomline.llm.forest import DEPTH, TARGET_RECALL, TREES, WIDTH, candidate_links, depth_of, prefix_length
from fathomline.llm.rolling import Prefixes

#: Texts compared with each other at once; larger groups are dealt out as pairs of such blocks.
BLOCK = 256
#: Texts of small groups that one task compares, group by group.
BATCH = 2_000

_SLICE = 50_000
_LONG_WORD = 256
_COLUMNS = 8_192


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words; all words of a shorter text; none of a text without."""
    words = [w if len(w) <= _LONG_WORD else hashlib.sha256(w).hexdigest().encode() for w in words_of(text)]
    if not words:
        return np.empty(0, np.uint64)
    found = []
    for at in range(0, max(1, len(words) - size + 1), _SLICE):
        part = b" ".join(words[at:at + _SLICE + size - 1])
        buffer = np.frombuffer(part, np.uint8)
        gaps = np.flatnonzero(buffer == 32)
        starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(buffer)]])
        last = max(1, len(starts) - size + 1)
        found.append(Prefixes(buffer).hashes(starts[:last], ends[-last:]))
    return np.unique(np.concatenate(found))


@functools.lru_cache
def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(5)
    return (draw.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1),
            draw.integers(0, 1 << 32, count, dtype=np.uint32))


def signature(hashes: np.ndarray, count: int) -> np.ndarray:
    """`count` 32-bit min-hashes of a set that isn't empty."""
    a, b = _multipliers(count)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(hashes), 2048):
        x = low[at:at + 2048, None] * a
        x ^= high[at:at + 2048, None]
        x *= np.uint32(0x9E3779B1)
        x += b
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA77)
        np.minimum(least, x.min(axis=0), out=least)
    return least


def links_between(sets: list[np.ndarray], first: int, threshold: Fraction) -> np.ndarray:
    """Boolean matrix: sets[i] and sets[first + j] (all sets if `first` is 0) have at least the similarity, not itself.

    Common elements are counted by products of 0/1 matrices over slices of the elements that two sets or more have.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    left, right = (len(sets), 0) if first == 0 else (first, first)
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, number, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[number] > 1
    rank = np.cumsum(times > 1) - 1
    column, owner = rank[number[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((left, len(sets) - right), np.float64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        part = np.zeros((len(sets), _COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        common += part[:left] @ part[right:].T
    common = common.astype(np.int64)
    union = sizes[:left, None] + sizes[right:][None] - common
    linked = (common * threshold.denominator >= threshold.numerator * union) & (common > 0)
    if first == 0:
        np.fill_diagonal(linked, False)
    return linked


def _roots(count: int, linked: np.ndarray) -> list[int]:
    """Smallest member of the component of each of `count` items."""
    root = list(range(count))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


_SKETCH = "row long, id long, n_shingles long, depth int, text_set binary, sketch binary"
_VERIFIED = "u long, v long, links long"


def _sketches(size: int, threshold: Fraction, trees: int, depth: int, recall: float):
    """Per text: its number of shingles, the depth to which it ascends, a digest of the set and its keys (see forest)."""

    def sketch(batches):
        for batch in batches:
            found = [shingles(text, size) for text in batch["text"].to_pylist()]
            depths = [depth_of(len(s), threshold, trees, depth, recall) if len(s) else None for s in found]
            yield pa.RecordBatch.from_arrays([
                batch["row"], batch["id"], pa.array([len(s) for s in found], pa.int64()), pa.array(depths, pa.int32()),
                pa.array([hashlib.sha256(s.tobytes()).digest()[:16] if len(s) else None for s in found], pa.binary()),
                pa.array([signature(s, trees * depth).astype(f"u{WIDTH}").tobytes() if at else None
                          for s, at in zip(found, depths)], pa.binary())],
                ["row", "id", "n_shingles", "depth", "text_set", "sketch"])
    return sketch


def _sets(size: int):
    def sets(batches):
        for batch in batches:
            found = [shingles(text, size).tobytes() for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["group"], batch["copies"], batch["block"], batch["blocks"], pa.array(found, pa.binary())],
                ["row", "group", "copies", "block", "blocks", "shingles"])
    return sets


def _verify(threshold: Fraction):
    def verify(rows: pa.Table) -> pa.Table:
        members: dict[tuple, list] = {}
        for row, group, copies, block, low, high, found in zip(*(rows[c].to_pylist() for c in (
                "row", "group", "copies", "block", "low", "high", "shingles"))):
            members.setdefault((group, low, high), []).append((block, row, copies, found))
        u, v, links = [], [], []
        for (_, low, high), docs in sorted(members.items(), key=lambda x: x[0]):
            docs.sort(key=lambda d: d[:2])
            first = 0 if low == high else sum(d[0] == low for d in docs)
            if len(docs) < 2 or (low != high and first in (0, len(docs))):
                continue
            linked = links_between([np.frombuffer(d[3], np.uint64) for d in docs], first, threshold)
            copies = np.array([d[2] for d in docs], np.int64)
            weight = np.zeros(len(docs), np.int64)
            weight[:linked.shape[0]] += linked @ copies[first:]
            whole = linked
            if first:
                weight[first:] += copies[:first] @ linked
                whole = np.zeros((len(docs), len(docs)), bool)
                whole[:first, first:] = linked
            for k, root in enumerate(_roots(len(docs), whole)):
                if weight[k]:
                    u.append(docs[k][1])
                    v.append(docs[root][1])
                    links.append(int(weight[k]))
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(links, pa.int64())], ["u", "v", "links"])
    return verify


def _classes(docs: DataFrame, id_column: str, text_column: str, words: int = 5, threshold: float = 0.8,
             trees: int = TREES, depth: int = DEPTH, recall: float = TARGET_RECALL) -> tuple[DataFrame, DataFrame]:
    """The documents as c0, c1, ... with row numbers, and for each: row, id, class_id, n_links, n_shingles, kept.

    Documents are linked if the Jaccard similarity of their distinct runs of `words` words (lower-cased A-Z, see
    words_of; all words of a shorter text) is at least `threshold`. `class_id` is the smallest id of all documents
    connected by links, `n_links` the number of documents that one is linked to, and one document of each class is kept.

    1. Documents with equal sets are one text from here on; copies count in `n_links` without being compared.
    2. Each text has a key of `depth` min-hashes in each of `trees` sorted tries. It ascends from the longest prefix that it shares with
       any other to the depth that reaches the target recall for the least similarity a partner of it can have, and meets
       the texts below that node (see forest). A node links its texts to one of them, never pairs.
    3. Texts connected so are one group, whose sets are compared exactly. Groups of more than BLOCK texts are dealt out as
       pairs of blocks over many tasks; a task keeps counts of links and the components of its blocks, no pairs.
    4. Components of what the tasks found are the classes.

    Null and empty texts, and texts without words, have no set: they are alone, with no link. Repeated rows are copies. The
    smallest id stays, null ids last, of equal ids the first row; class_id is null where all ids of a class are null.
    An empty table gives no rows.
    """
    given = docs.columns
    exact = Fraction(threshold).limit_denominator(10_000)
    plain = docs.toDF(*(f"c{i}" for i in range(len(given))))
    rows = landed(plain.withColumn("row", F.monotonically_increasing_id()), "join-texts").withColumns({
        "id": F.col(f"c{given.index(id_column)}").cast("long"), "text": F.col(f"c{given.index(text_column)}").cast("binary")})
    sketched = landed(rows.select("row", "id", "text").mapInArrow(_sketches(words, exact, trees, depth, recall), _SKETCH), "sketches")

    # Equal sets: the first row by number stands for its copies.
    texts = landed(sketched.filter("text_set is not null").groupBy("text_set").agg(
        F.min("row").alias("row"), F.count("*").alias("copies"), F.first("depth").alias("depth"),
        F.first("sketch").alias("sketch")), "texts")
    met = candidate_links(texts, prefix_length(threshold, trees, depth, recall), trees, depth)
    groups = landed(components(met), "candidate-groups")

    sizes = landed(groups.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "group-sizes")
    members = (groups.join(small_or_shuffled(sizes), "root")
               .join(texts.select(F.col("row").alias("node"), "copies"), "node")
               .select(F.col("node").alias("row"), F.col("root").alias("group"), "copies", "blocks",
                       F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")))
    members = landed(members, "group-members")
    batches = 1 + members.count() // BATCH
    sets = (rows.select("row", "text").join(small_or_shuffled(members), "row")
            .select("row", "text", "group", "copies", "block", "blocks")
            .mapInArrow(_sets(words), "row long, group long, copies long, block int, blocks int, shingles binary")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
            .withColumn("task", F.when(F.col("blocks") == 1, F.struct(
                F.pmod(F.xxhash64("group"), F.lit(batches)).alias("a"), F.lit(-1).alias("b"), F.lit(-1).alias("c")))
                .otherwise(F.struct(F.col("group").alias("a"), F.col("low").alias("b"), F.col("high").alias("c")))))
    verified = landed(sets.groupBy("task").applyInArrow(_verify(exact), _VERIFIED), "verified")

    classes = components(verified.select("u", "v"))
    linked = landed(classes.join(verified.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links")), "node")
                    .select(F.col("node").alias("text_row"), "root", "links"), "linked-texts")
    copies = landed(texts.filter("copies > 1").select("text_set", F.col("row").alias("first"), "copies"), "copied-texts")
    labelled = landed(
        sketched.join(small_or_shuffled(copies), "text_set", "left").withColumn("text_row", F.coalesce("first", "row"))
        .join(small_or_shuffled(linked), "text_row", "left")
        .select("row", "id", "n_shingles", F.coalesce("root", "text_row").alias("class"),
                (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "labelled")
    # Classes of one document need no partner: only those with links are looked up.
    first = landed(labelled.filter("n_links > 0").groupBy("class").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("x")).select("class", "x.id", "x.row")
        .toDF("class", "first_id", "first_row"), "class-heads")
    result = labelled.join(small_or_shuffled(first), "class", "left").select(
        "row", "id", F.when(F.col("first_row").isNull(), F.col("id")).otherwise(F.col("first_id")).alias("class_id"),
        "n_links", "n_shingles", F.coalesce(F.col("first_row") == F.col("row"), F.lit(True)).alias("kept"))
    return rows, result


def similarity_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One row per document: id, class_id, n_links, n_shingles, kept; see _classes."""
    return _classes(docs, id_column, text_column, **settings)[1].drop("row")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One document of each class, with the columns of `docs`; see _classes."""
    rows, classes = _classes(docs, id_column, text_column, **settings)
    dropped = landed(classes.filter("not kept").select("row"), "dropped")
    return (rows.join(small_or_shuffled(dropped), "row", "left_anti")
            .select(*(f"c{i}" for i in range(len(docs.columns)))).toDF(*docs.columns))
