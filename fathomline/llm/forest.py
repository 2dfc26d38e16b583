"""MinHash LSH forest: sorted prefix tries of signatures, whose matched prefixes are shortened text by text.

A signature has one key per tree, a sequence of `depth` short min-hashes. Sorted keys are a trie: the texts below a node
are neighbours, and the longest prefix that a text shares with any other is one that it shares with a neighbour. From
there a text ascends until it reaches the depth at which a partner is found with the target recall, and is linked to the
texts below that node.

How far a text ascends depends on the least similarity that a partner of it can have. Similarities of small sets are
coarse: none of three elements has a different partner at 0.8, one of seven none below 6/7, so those stop early or never
start, while large sets ascend to the depth for the threshold itself. What was found on the way is no reason to stop
early: a near partner says nothing about one at the threshold.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed

#: Tries of a forest, and the min-hashes of a key.
TREES, DEPTH = 24, 8
#: Share of the pairs at the least similarity that must meet below a node.
TARGET_RECALL = 0.999
#: Bytes of a min-hash in a key; two that agree by chance give a candidate more, never one less.
WIDTH = 2


def prefix_length(similarity: float, trees: int = TREES, depth: int = DEPTH, recall: float = TARGET_RECALL) -> int:
    """Longest prefix with which pairs of a similarity meet in one of the tries with the target recall; at least 1."""
    for length in range(depth, 0, -1):
        if 1 - (1 - float(similarity) ** length) ** trees >= recall:
            return length
    return 1


@functools.lru_cache(100_000)
def least_similarity(size: int, threshold: Fraction) -> Fraction | None:
    """Least Jaccard similarity of at least the threshold between a set of `size` elements and any other set; None without one.

    With c common elements the union has at most c / threshold; where c is a multiple of the numerator it has just that.
    """
    fewest = -(-threshold.numerator * size // threshold.denominator)
    if size - fewest >= threshold.numerator:
        return threshold
    found = [Fraction(common, union) for common in range(max(1, fewest), size + 1)
             if (union := common * threshold.denominator // threshold.numerator) >= size and (common, union) != (size, size)]
    return min(found, default=None)


def depth_of(size: int, threshold: Fraction, trees: int = TREES, depth: int = DEPTH, recall: float = TARGET_RECALL) -> int | None:
    """Depth to which a text of `size` shingles ascends; None if no other set can be similar enough."""
    least = least_similarity(size, threshold)
    return None if least is None else prefix_length(float(least), trees, depth, recall)


class _Level:
    """Nodes of one depth, met in sorted order: the first text of the open node, and whether it has a text of a lesser depth."""

    def __init__(self, depth: int) -> None:
        self.depth, self.head, self.lesser, self.at_start = depth, None, False, True

    def links(self, rows: np.ndarray, depths: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, int | None]:
        """Links (text, first text of its node) of a batch, and the first text of the partition's first node if it ended here.

        `shared` is the length of the prefix that each text shares with the one before it. All texts that end their ascent
        here are linked to the first, and so is the first text of those that go on: the rest meet that one further up.
        """
        nodes = np.cumsum(shared < self.depth)
        ends = np.flatnonzero(depths == self.depth)
        on = np.flatnonzero(depths < self.depth)
        first_on = np.ones(len(on), bool)
        first_on[1:] = nodes[on[1:]] != nodes[on[:-1]]
        if len(on) and self.lesser and nodes[on[0]] == 0:
            first_on[0] = False
        members = np.sort(np.concatenate([ends, on[first_on]]))
        node, row = nodes[members], rows[members]
        fresh = np.ones(len(members), bool)
        fresh[1:] = node[1:] != node[:-1]
        heads = row[fresh]
        if len(members) and node[0] == 0 and self.head is not None:
            heads[0] = self.head
        linked_to = heads[np.cumsum(fresh) - 1]

        closed = None
        if nodes[-1] > 0 and self.at_start:
            closed = int(linked_to[0]) if len(members) and node[0] == 0 else self.head
            self.at_start = False
        in_last = len(members) > 0 and node[-1] == nodes[-1]
        self.lesser = bool(len(on) and nodes[on[-1]] == nodes[-1]) or (self.lesser and nodes[-1] == 0)
        self.head = int(linked_to[-1]) if in_last else self.head if nodes[-1] == 0 else None
        differ = row != linked_to
        return row[differ], linked_to[differ], closed


def _name(tree: int, depth: int, key: bytes) -> bytes:
    return bytes([tree, depth]) + key[:depth * WIDTH]


def _scan(least_depth: int, most_depth: int):
    """Links of one run of sorted keys; nodes that may go on in another run are named together with their first text here."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [_Level(d) for d in range(least_depth, most_depth + 1)]
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            joined = b"".join(batch["key"].to_pylist())
            size = len(joined) // batch.num_rows
            trees = batch["tree"].to_numpy()
            keys = np.frombuffer(joined, np.uint16).reshape(batch.num_rows, -1)
            before = last or (-1, bytes(size))
            same = np.vstack([np.frombuffer(before[1], np.uint16)[None], keys[:-1]]) == keys
            shared = np.cumprod(same, axis=1).sum(axis=1)
            shared[trees != np.concatenate([[before[0]], trees[:-1]])] = 0
            if last is None:
                first = (int(trees[0]), joined[:size])
                shared[0] = most_depth  # the first node is the one that is open at the start
            rows, depths = batch["row"].to_numpy(), batch["depth"].to_numpy()
            u, v, named = [], [], []
            for level in levels:
                a, b, closed = level.links(rows, depths, shared)
                u.append(a)
                v.append(b)
                if closed is not None:
                    named.append((_name(*_at(first, level.depth)), closed))
            last = (int(trees[-1]), joined[-size:])
            yield _links(np.concatenate(u), np.concatenate(v), named)
        if last is not None:
            yield _links(np.empty(0, np.int64), np.empty(0, np.int64),
                         [(_name(*_at(last, x.depth)), x.head) for x in levels if x.head is not None])
    return scan


def _at(place: tuple[int, bytes], depth: int) -> tuple[int, int, bytes]:
    return place[0], depth, place[1]


def _links(u: np.ndarray, v: np.ndarray, named: list[tuple[bytes, int]]) -> pa.RecordBatch:
    heads = np.array([head for _, head in named], np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([u, heads])), pa.array(np.concatenate([v, heads])),
        pa.array([None] * len(u) + [name for name, _ in named], pa.binary())], ["u", "v", "node"])


def candidate_links(texts: DataFrame, least_depth: int, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Links (u, v) between texts (row long, depth int, sketch binary), so that texts that meet in a trie are connected.

    Two texts meet if they share a prefix of the greater of their depths in any trie. Keys are sorted by ranges, which may
    cut any node, also one with a third of all texts, between tasks; a task reads its run once and holds a batch of it. It
    gives at most one link a text and depth. Nodes at either end of a run are named, and their parts are linked by name:
    at most two names a depth and run. Texts without a depth take no part.
    """
    width = depth * WIDTH
    keys = texts.filter("depth is not null").select("row", "depth", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.substring("sketch", t * width + 1, F.lit(width)))).alias("tree", "key"))
    runs = keys.repartitionByRange("tree", "key", "row").sortWithinPartitions("tree", "key")
    found = landed(runs.mapInArrow(_scan(least_depth, depth), "u long, v long, node binary"), "trie-links")
    named = found.filter("node is not null").select("node", F.col("v").alias("u"))
    heads = named.groupBy("node").agg(F.min("u").alias("v"))
    return found.filter("node is null").select("u", "v").unionByName(
        named.join(heads, "node").filter("u <> v").select("u", "v"))
