"""Decision trees of many scenarios grown together: forests, boosted classifiers and boosted regressors.

All trees that don't depend on each other (every fold, class and bootstrap of a round) are units of the same Spark jobs.
A node with many rows is split from histograms: every task adds up its rows by (unit, node, feature, bin), Spark sums
them by unit, and only the chosen splits reach the driver. A node with few rows is finished in one task, as its rows fit
there (Panda, Herbach, Basu and Bayardo: PLANET, 2009). Both find the same splits. Trees with a budget of leaves grow
best first: the split with the largest gain is taken next, and only nodes that this order can reach are looked at.

Where the rows of a scenario fit a task, its trees are grown and used there, and only predictions leave it. Forests of larger
tables are grown a few trees at a time, whose votes are added to the rows, so that the driver never holds a forest.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators import scenarios, whole
from fathomline.session import cut_lineage, over_cores, shuffle_partitions

BINS = 255
#: A node with at most so many rows is finished in one task.
SMALL_ROWS = 20_000
#: Histograms that one job may hold in a task; more nodes take more jobs.
HISTOGRAM_BYTES = 1 << 28
#: Rounds of boosting after which the scores of all rows are written, so that tasks apply few trees.
ROUNDS_KEPT = 10
#: Nodes of a forest that the driver may hold, and times as many trees of them as before that it takes on at most.
NODES_HELD, FASTER = 200_000, 8
#: Groups of trees for each core, nodes of a level split at once, and test rows of a block of votes.
GROUPS_A_CORE, NODES_AT_ONCE, ROWS_A_BLOCK = 4, 256, 20_000
_LEAF = -1


@dataclass(frozen=True)
class Growth:
    """Where a tree ends: depth, leaves (None: no budget), least weight of a leaf; features drawn for a node (None: all)."""

    depth: int
    leaves: int | None = None
    least: float = 1.0
    drawn: int | None = None
    seed: int = 42


# ---------------------------------------------------------------- the table of rows


@dataclass(frozen=True)
class Matrix:
    """Rows ready for growing: row_id, x (a byte for the bin of each feature), roles (a byte for each scenario: 1 trains,
    2 tests, 0 neither), y (place of the label, or the target) and scores. Few small facts stay on the driver.
    """

    rows: DataFrame
    scenarios: tuple[str, ...]
    #: Labels in order; empty for numeric targets.
    labels: tuple
    features: int
    #: Train rows and the sum of their targets (by label, or of the numbers) for each scenario.
    trained: np.ndarray
    totals: np.ndarray
    #: Rows that a scenario trains or tests at most.
    most: int


def bin_edges(rows: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the upper limits of its bins but the last: quantiles of the values, every value where there are few."""
    shares = [float(q) for q in np.arange(1, bins + 1) / bins]
    found = rows.select(F.posexplode("features").alias("at", "value")).groupBy("at").agg(
        F.percentile_approx("value", shares, 20 * bins).alias("edges")).collect()
    edges = {r["at"]: np.unique(np.array(r["edges"], float)) for r in found}
    return [edges[k][:-1] for k in sorted(edges)]


def matrix(placed: DataFrame, numeric: bool = False, bins: int = BINS) -> Matrix:
    """Of a table of `scenarios.place` (row_id, label, features, trains, tests); `numeric` for regression.

    Bins are quantiles over all rows: they use no label, and all scenarios share them.
    """
    placed = cut_lineage(placed.select("row_id", "label", "features", "trains", "tests"))
    names, labels = scenarios.names_of(placed), () if numeric else scenarios.labels_of(placed)
    edges = bin_edges(placed, bins)
    at = {label: k for k, label in enumerate(labels)}

    def encoded(batches):
        for batch in batches:
            n = batch.num_rows
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            x = np.stack([np.searchsorted(edge, column) for edge, column in zip(edges, flat.T)], axis=1).astype(np.uint8) if n else flat
            roles = scenarios.roles_of(batch, names)
            y = batch.column("label").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array([v.tobytes() for v in x], pa.binary()),
                 pa.array([v.tobytes() for v in roles], pa.binary()),
                 pa.array(y if numeric else [at[v] for v in y], pa.float64())], ["row_id", "x", "roles", "y"])

    rows = cut_lineage(over_cores(placed).mapInArrow(encoded, "row_id long, x binary, roles binary, y double"))
    width = max(1, len(labels))

    def counted(batches):
        total = np.zeros((len(names), 2 + width))
        for batch in batches:
            block = Block.of(batch)
            train = (block.roles == 1).astype(float)
            total[:, 0] += (block.roles > 0).sum(axis=0)
            total[:, 1] += train.sum(axis=0)
            total[:, 2:] += train.T @ (np.eye(width)[block.y.astype(int)] if labels else block.y[:, None])
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["t"])

    sums = rows.mapInArrow(counted, "t array<double>").select(F.posexplode("t").alias("at", "t")).groupBy("at").agg(
        F.sum("t").alias("t")).orderBy("at").collect()
    total = np.array([r["t"] for r in sums]).reshape(len(names), 2 + width) if sums else np.zeros((len(names), 2 + width))
    return Matrix(rows, names, labels, len(edges), total[:, 1], total[:, 2:], int(total[:, 0].max(initial=0)))


@dataclass
class Block:
    """The rows of an Arrow batch as arrays."""

    row_id: np.ndarray
    x: np.ndarray
    roles: np.ndarray
    y: np.ndarray
    scores: np.ndarray | None

    @classmethod
    def of(cls, batch: pa.RecordBatch, scores: str = "<f4") -> Block:
        def bytes_of(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, -1) if batch.num_rows \
                else np.zeros((0, 1), kind)
        return cls(batch.column("row_id").to_numpy(), bytes_of("x", "u1"), bytes_of("roles", "u1"),
                   batch.column("y").to_numpy(), bytes_of("scores", scores) if "scores" in batch.schema.names else None)


# ---------------------------------------------------------------- one tree


@dataclass
class Sketch:
    """A tree while it grows. Nodes are numbered as they are found; a node is unknown, split, or a leaf for good."""

    feature: list[int] = field(default_factory=lambda: [_LEAF])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    known: list[bool] = field(default_factory=lambda: [False])
    depth: list[int] = field(default_factory=lambda: [0])
    #: Number of the node in the full binary tree: names the features drawn for it.
    path: list[int] = field(default_factory=lambda: [1])
    sums: list = field(default_factory=lambda: [None])
    #: Without a budget of leaves: nodes before this one need no look.
    seen: int = 0

    def plan(self, growth: Growth) -> tuple[list[int], list[int]]:
        """Split nodes that the growth takes, and unknown nodes that it has to look at first."""
        def divisible(node: int) -> bool:
            return not self.known[node] and self.depth[node] < growth.depth and (
                self.sums[node] is None or self.sums[node][0] >= 2 * growth.least)

        if growth.leaves is None:
            wanted = [node for node in range(self.seen, len(self.feature)) if divisible(node)]
            self.seen = wanted[0] if wanted else len(self.feature)
            return ([] if wanted else [node for node, f in enumerate(self.feature) if f != _LEAF]), wanted
        taken, wanted, leaves, order = [], [], 1, []

        def meet(node: int) -> None:
            if self.feature[node] != _LEAF:
                heapq.heappush(order, (-self.gain[node], self.path[node], node))
            elif divisible(node):
                wanted.append(node)

        meet(0)
        while order and leaves < growth.leaves:
            node = heapq.heappop(order)[-1]
            taken.append(node)
            leaves += 1
            meet(self.left[node])
            meet(self.right[node])
        return taken, wanted

    def tell(self, node: int, split: tuple | None) -> None:
        """The best split of a node: gain, feature, cut, sums of both sides; or None, then it is a leaf."""
        self.known[node] = True
        if split is None:
            return
        gain, feature, cut, left, right = split
        self.gain[node], self.feature[node], self.cut[node] = float(gain), int(feature), int(cut)
        self.sums[node] = left + right
        for side, sums in ((0, left), (1, right)):
            (self.right if side else self.left)[node] = len(self.feature)
            for values, value in ((self.feature, _LEAF), (self.cut, 0), (self.left, 0), (self.right, 0), (self.gain, 0.0),
                                  (self.known, False), (self.depth, self.depth[node] + 1),
                                  (self.path, 2 * self.path[node] + side), (self.sums, sums)):
                values.append(value)

    def graft(self, node: int, grown: Sketch) -> None:
        """A subtree that was grown elsewhere; what it left unknown isn't needed."""
        self.sums[node] = grown.sums[0]
        pairs = [(node, 0)]
        for own, other in pairs:
            if grown.feature[other] == _LEAF:
                self.known[own] = True
                continue
            left, right = grown.left[other], grown.right[other]
            self.tell(own, (grown.gain[other], grown.feature[other], grown.cut[other], grown.sums[left], grown.sums[right]))
            pairs += [(self.left[own], left), (self.right[own], right)]

    def tree(self, growth: Growth, value) -> Tree:
        """What the growth takes; `value` makes the value of a leaf from its sums."""
        self.seen = 0
        taken = set(self.plan(growth)[0])
        order, number = [0], {0: 0}
        for node in order:
            if node in taken:
                for child in (self.left[node], self.right[node]):
                    number[child] = len(order)
                    order.append(child)
        split = [node in taken for node in order]
        return Tree(*(np.array([get(node) if s else other for node, s in zip(order, split)], kind) for get, other, kind in (
            (lambda k: self.feature[k], _LEAF, np.int32), (lambda k: self.cut[k], 0, np.uint8),
            (lambda k: number[self.left[k]], 0, np.int32), (lambda k: number[self.right[k]], 0, np.int32))),
            np.array([value(self.sums[node]) for node in order], np.float32).reshape(len(order), -1))

    def packed(self) -> bytes:
        return pickle.dumps([getattr(self, f.name) for f in fields(self)])

    @classmethod
    def unpacked(cls, data: bytes) -> Sketch:
        return cls(*pickle.loads(data))

    def routes(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(v, k) for v, k in ((self.feature, np.int32), (self.cut, np.uint8), (self.left, np.int32),
                                                 (self.right, np.int32)))


@dataclass(frozen=True)
class Tree:
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def values(self, x: np.ndarray) -> np.ndarray:
        return self.value[leaf_of((self.feature, self.cut, self.left, self.right), x)]


def leaf_of(routes: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Node where every row ends."""
    feature, cut, left, right = routes
    at = np.zeros(len(x), np.int32)
    moving = np.arange(len(x)) if feature[0] != _LEAF else np.zeros(0, np.int64)
    while len(moving):
        node = at[moving]
        down = np.where(x[moving, feature[node]] <= cut[node], left[node], right[node])
        at[moving] = down
        moving = moving[feature[down] != _LEAF]
    return at


def _mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of whole numbers, elementwise."""
    with np.errstate(over="ignore"):
        h = np.uint64(0x9E3779B97F4A7C15)
        for part in parts:
            h = (h ^ np.asarray(part).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(32))
    return h


def drawn_features(growth: Growth, unit: int, paths: list[int], features: int) -> np.ndarray:
    """Features that each node may split on, in order."""
    if growth.drawn is None or growth.drawn >= features:
        return np.tile(np.arange(features), (len(paths), 1))
    keys = _mixed(growth.seed, unit, np.array(paths, np.uint64)[:, None], np.arange(features)[None, :])
    return np.sort(np.argpartition(keys, growth.drawn - 1, axis=1)[:, :growth.drawn], axis=1)


def _score(sums: np.ndarray, scored: int) -> np.ndarray:
    """Squared sums of the targets over the weight: what a split raises is explained variance, or the Gini impurity it removes."""
    return (sums[..., 1:1 + scored] ** 2).sum(axis=-1) / np.maximum(sums[..., 0], 1e-300)


def _gains(left: np.ndarray, total: np.ndarray, scored: int, least: float) -> np.ndarray:
    """Gain of every cut, rounded so that sums in another order choose alike; 0 where a side is too light."""
    right = total - left
    gain = _score(left, scored) + _score(right, scored) - _score(total, scored)
    gain = np.where((left[..., 0] >= least) & (right[..., 0] >= least), gain, 0.0)
    return np.where(gain > 1e-9 * np.maximum(1.0, np.abs(total[..., 1:1 + scored]).sum(axis=-1)), gain, 0.0).astype(np.float32)


def splits_by_sorting(x: np.ndarray, stats: np.ndarray, node: np.ndarray, drawn: np.ndarray, scored: int, least: float) -> list:
    """Best split of every node from its rows; see `Sketch.tell`. Equal gains go to the first feature, then the lowest cut.

    Each drawn feature is a column of rows in order of node and bin; sums of the rows so far give all cuts at once.
    """
    count, width = drawn.shape
    bins = np.take_along_axis(x, drawn[node], axis=1).T
    order = np.argsort(bins, axis=1, kind="stable")
    if count > 1:
        small = node.astype(np.uint16 if count < 1 << 16 else np.int64)
        order = np.take_along_axis(order, np.argsort(small[order], axis=1, kind="stable"), axis=1)
    rows, bins = order.ravel(), np.take_along_axis(bins, order, axis=1).ravel()
    # Every column holds the same number of rows of a node.
    sizes = np.bincount(node, minlength=count)
    full = np.flatnonzero(sizes)
    ends = (np.cumsum(sizes[full])[None, :] + np.arange(width)[:, None] * len(node)).ravel() - 1
    last = np.zeros(len(rows), bool)
    last[ends] = True
    cuts = np.flatnonzero(~last & np.append(bins[1:] != bins[:-1], False))
    found: list = [None] * count
    if not len(cuts):
        return found
    run = np.stack([np.cumsum(column[rows]) for column in stats.T], axis=1)
    base = np.concatenate([np.zeros((1, stats.shape[1])), run[ends[:-1]]])
    totals = run[ends] - base
    segment = np.cumsum(last)[cuts]  # of a cut: column by column, node by node
    left = run[cuts] - base[segment]
    gain = _gains(left, totals[segment], scored, least)
    best = np.zeros(len(ends), np.float32)
    firsts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    best[segment[firsts]] = np.maximum.reduceat(gain, firsts)
    best = best.reshape(width, len(full))
    for k, (own, j) in enumerate(zip(full.tolist(), best.argmax(axis=0).tolist())):
        if best[j, k] > 0:
            begin = int(np.searchsorted(segment, j * len(full) + k))
            at = begin + int(np.argmax(gain[begin:] == best[j, k]))
            found[own] = (best[j, k], drawn[own, j], bins[cuts[at]], left[at], totals[segment[at]] - left[at])
    return found


def splits_by_counting(x: np.ndarray, stats: np.ndarray, node: np.ndarray, drawn: np.ndarray, scored: int, least: float) -> list:
    """`splits_by_sorting` from histograms: for nodes with many rows. Only what enters the gain is counted for every bin."""
    count, width = drawn.shape
    sums, base, every = np.zeros((count, width, 256, 1 + scored)), node << 8, np.arange(len(x))
    alike, whole_rows = (drawn == drawn[0]).all(), (stats[:, 0] == 1).all()
    for j in range(width):
        key = base | (x[:, drawn[0, j]] if alike else x[every, drawn[node, j]])
        for k in range(1 + scored):
            sums[:, j, :, k] = np.bincount(key, None if whole_rows and not k else stats[:, k], count << 8).reshape(count, 256)
    found = splits_of_histograms(sums, drawn, scored, least)
    cuts = np.array([split[1:3] if split else (0, -1) for split in found], np.int64)
    side = 2 * node + (x[every, cuts[node, 0]] > cuts[node, 1])
    sides = np.stack([np.bincount(side, column, 2 * count) for column in stats.T], axis=1)
    return [split and (*split[:3], sides[2 * k], sides[2 * k + 1]) for k, split in enumerate(found)]


def splits_of_histograms(sums: np.ndarray, drawn: np.ndarray, scored: int, least: float) -> list:
    """Best split of every node from sums by (node, drawn feature, bin, statistic)."""
    left = np.cumsum(sums, axis=2)
    total = left[:, :, -1:, :]
    # A cut behind an empty bin is the one before it.
    gain = np.where(sums[..., 0] > 0, _gains(left, np.broadcast_to(total, left.shape), scored, least), np.float32(0))
    found: list = []
    for k, of_node in enumerate(gain.reshape(len(gain), -1)):
        at = int(of_node.argmax())
        j, cut = divmod(at, sums.shape[2])
        found.append((of_node[at], drawn[k, j], cut, left[k, j, cut], total[k, j, 0] - left[k, j, cut]) if of_node[at] > 0 else None)
    return found


def grow_here(x: np.ndarray, stats: np.ndarray, growth: Growth, unit: int, scored: int, path: int = 1, depth: int = 0) -> Sketch:
    """A whole (sub)tree from rows in memory."""
    sketch = Sketch()
    sketch.path[0], sketch.depth[0], sketch.sums[0] = path, depth, stats.sum(axis=0)
    at = np.zeros(len(x), np.int64)
    while wanted := sketch.plan(growth)[1]:
        place = np.full(len(sketch.feature), -1)
        place[wanted] = np.arange(len(wanted))
        rows = np.flatnonzero(place[at] >= 0)
        drawn = drawn_features(growth, unit, [sketch.path[k] for k in wanted], x.shape[1])
        splits = splits_by_counting if len(wanted) << 8 <= len(rows) else splits_by_sorting
        own = slice(None) if len(rows) == len(x) else rows
        for node, split in zip(wanted, splits(x[own], stats[own], place[at[rows]], drawn, scored, growth.least)):
            sketch.tell(node, split)
        feature, cut, left, right = sketch.routes()
        node = at[rows]
        rows, node = rows[feature[node] != _LEAF], node[feature[node] != _LEAF]
        at[rows] = np.where(x[rows, feature[node]] <= cut[node], left[node], right[node])
    return sketch


# ---------------------------------------------------------------- a tree of labels, level by level


def _gains_of_squares(left: np.ndarray, left_squares: np.ndarray, right_squares: np.ndarray, total: np.ndarray, squares: np.ndarray,
                      least: float) -> np.ndarray:
    """`_gains` from weights and the sums of the squared weights of the labels."""
    right = total - left
    gain = left_squares / np.maximum(left, 1e-300) + right_squares / np.maximum(right, 1e-300) - squares / np.maximum(total, 1e-300)
    return np.where((left >= least) & (right >= least) & (gain > 1e-9 * np.maximum(1.0, total)), gain, 0.0).astype(np.float32)


def _level_by_counting(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, node: np.ndarray, drawn: np.ndarray, totals: np.ndarray,
                       least: float) -> tuple[np.ndarray, ...]:
    """By node: whether a cut raises the gain, the feature, the cut. `bins` are those of the features drawn for the node, by row."""
    (count, width), classes = drawn.shape, totals.shape[1]
    sums, base = np.empty((count, width, 256, classes)), (node << 8) * classes + y
    for j in range(width):
        key = base + bins[:, j].astype(np.int64) * classes
        sums[:, j] = np.bincount(key, weight, (count << 8) * classes).reshape(count, 256, classes)
    left, of_node = np.cumsum(sums, axis=2), np.arange(count)
    total, squares = totals.sum(axis=1)[:, None, None], (totals ** 2).sum(axis=1)[:, None, None]
    gain = _gains_of_squares(left.sum(axis=-1), (left ** 2).sum(axis=-1), ((totals[:, None, None, :] - left) ** 2).sum(axis=-1), total, squares, least)
    # A cut behind an empty bin is the one before it.
    gain = np.where(sums.any(axis=-1), gain, np.float32(0)).reshape(count, -1)
    at = gain.argmax(axis=1)
    return gain[of_node, at] > 0, drawn[of_node, at >> 8], at & 255


def _level_by_sorting(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, node: np.ndarray, drawn: np.ndarray, totals: np.ndarray,
                      least: float) -> tuple[np.ndarray, ...]:
    """`_level_by_counting` for nodes with few rows; rows come in order of their node, of which there are 256 at most.

    Each drawn feature is a row of rows in order of node and bin. A row of weight w and label k raises the sum of squares on
    the left by w (2 L_k + w), where L_k is the weight of the label so far: no sums are kept for every label and cut.
    """
    (count, width), classes = drawn.shape, totals.shape[1]
    key = (node.astype(np.uint16) << np.uint16(8))[None, :] | bins.T
    order = np.argsort(key, axis=1, kind="stable")
    key, y, weight = np.take_along_axis(key, order, axis=1), y[order], weight[order]
    starts, of_node = np.searchsorted(node, np.arange(count)), np.arange(count)
    total, squares = totals.sum(axis=1)[node], (totals ** 2).sum(axis=1)[node]

    def running(values: np.ndarray) -> np.ndarray:
        run = np.cumsum(values, axis=1)
        return run - np.where(starts > 0, run[:, starts - 1], 0.0)[:, node]

    if classes <= 3:
        left_squares = right_squares = np.zeros(key.shape)
        for k in range(classes):
            left = running(np.where(y == k, weight, 0.0))
            left_squares, right_squares = left_squares + left ** 2, right_squares + (totals[node, k] - left) ** 2
    else:
        label = (node * classes)[None, :] + y
        by = np.argsort(label.astype(np.uint16) if totals.size <= 1 << 16 else label, axis=1, kind="stable")
        so_far = np.empty(key.shape)
        np.put_along_axis(so_far, by, np.cumsum(np.take_along_axis(weight, by, axis=1), axis=1), axis=1)
        so_far -= (np.cumsum(totals.ravel()) - totals.ravel())[label]
        left_squares = running(weight * (2 * so_far - weight))
        right_squares = squares - 2 * running(weight * totals.ravel()[label]) + left_squares
    gain = _gains_of_squares(running(weight), left_squares, right_squares, total, squares, least)
    gain[:, :-1][key[:, 1:] == key[:, :-1]] = 0
    gain[:, np.append(starts[1:], len(node)) - 1] = 0
    best = np.maximum.reduceat(gain, starts, axis=1)
    j = best.argmax(axis=0)
    best = best[j, of_node]
    hit = np.flatnonzero(gain[j[node], np.arange(len(node))] == best[node])
    first = hit[np.searchsorted(node[hit], of_node)]
    return best > 0, drawn[of_node, j], key[j, first] & 255


def grow_labels(x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, growth: Growth, unit: int) -> Tree:
    """The tree of `grow_here` from rows with places of labels and whole weights, without a budget of leaves: all nodes of a level
    at once, and arrays instead of lists. Leaves have the share of each label.
    """
    rows, node, flat, wide = np.arange(len(y)), np.zeros(len(y), np.int64), np.ascontiguousarray(x).ravel(), x.shape[1]
    totals, paths, count, depth, levels = np.bincount(y, weight, classes)[None, :], np.ones(1, np.int64), 1, 0, []
    while True:
        levels.append((np.full(len(totals), _LEAF, np.int32), np.zeros(len(totals), np.uint8), np.zeros(len(totals), np.int32), totals))
        # A node with a single label has nothing to gain.
        looked = np.flatnonzero((totals.sum(axis=1) >= 2 * growth.least) & ((totals > 0).sum(axis=1) > 1) & (depth < growth.depth))
        if not len(looked):
            break
        if len(looked) < len(totals):
            place = np.full(len(totals), -1)
            place[looked] = np.arange(len(looked))
            node = place[node]
            kept = np.flatnonzero(node >= 0)
            rows, node = rows[kept], node[kept]
        paths, totals, many = paths[looked], totals[looked], len(looked)
        drawn = drawn_features(growth, unit, paths, wide)
        if many * 256 * classes <= 2 * len(rows) and many <= NODES_AT_ONCE:
            split, feature, cut = _level_by_counting(flat.take((rows * wide)[:, None] + drawn[node]), y[rows], weight[rows], node, drawn, totals, growth.least)
        else:
            order = np.argsort(node.astype(np.uint16) if many <= 1 << 16 else node, kind="stable")
            rows, node = rows[order], node[order]
            split, feature, cut = np.zeros(many, bool), np.zeros(many, np.int64), np.zeros(many, np.int64)
            for low in range(0, many, NODES_AT_ONCE):
                own = slice(low, min(many, low + NODES_AT_ONCE))
                begin, end = np.searchsorted(node, [own.start, own.stop])
                here, at = rows[begin:end], node[begin:end]
                by = _level_by_counting if (own.stop - own.start) * 256 * classes <= 2 * len(here) else _level_by_sorting
                split[own], feature[own], cut[own] = by(flat.take((here * wide)[:, None] + drawn[at]), y[here], weight[here], at - low,
                                                        drawn[own], totals[own], growth.least)
        if not split.any():
            break
        at, new = looked[split], 2 * int(split.sum())
        for values, found in zip(levels[-1], (feature[split], cut[split], count + 2 * np.arange(len(at)))):
            values[at] = found
        if len(at) < many:
            kept = np.flatnonzero(split[node])
            rows, node = rows[kept], node[kept]
        node = 2 * (np.cumsum(split) - 1)[node] + (flat.take(rows * wide + feature[node]) > cut[node])
        totals = np.bincount(node * classes + y[rows], weight[rows], new * classes).reshape(new, classes)
        paths, count, depth = (2 * paths[split][:, None] + np.arange(2)).ravel(), count + new, depth + 1
    feature, cut, left, totals = (np.concatenate(v) for v in zip(*levels))
    return Tree(feature, cut, left, np.where(feature != _LEAF, left + 1, 0).astype(np.int32),
                (totals / np.maximum(totals.sum(axis=1, keepdims=True), 1e-300)).astype(np.float32))


# ---------------------------------------------------------------- trees of many scenarios


class Job:
    """Which rows a unit grows from. `scored` statistics after the weight enter the gain, the others only the leaves."""

    scored: int
    units: list[int]

    def scenario(self, unit: int) -> int:
        raise NotImplementedError

    def of_block(self, block: Block, units: Iterable[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Unit, rows of the block, and their weight and targets (float32)."""
        raise NotImplementedError

    def stats(self, raw: np.ndarray) -> np.ndarray:
        """Statistics from weights and targets."""
        return np.concatenate([raw[:, :1], raw[:, :1] * raw[:, 1:]], axis=1).astype(float)


@dataclass
class Bootstraps(Job):
    """`trees` bootstraps of each scenario: Poisson weights by a hash of row and unit. Labels count one by one."""

    scenarios: int
    trees: int
    classes: int
    seed: int = 42

    def __post_init__(self):
        self.scored = max(1, self.classes)
        self.units = list(range(self.scenarios * self.trees))

    def scenario(self, unit):
        return unit // self.trees

    def weights(self, unit: int, row_id: np.ndarray) -> np.ndarray:
        chances = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1], np.arange(1, 12)])))
        drawn = _mixed(self.seed, unit, row_id) >> np.uint64(11)
        return np.searchsorted(chances, drawn.astype(float) / (1 << 53), "right")

    def of_block(self, block, units):
        for unit in units:
            rows = np.flatnonzero(block.roles[:, self.scenario(unit)] == 1)
            weight = self.weights(unit, block.row_id[rows])
            rows, weight = rows[weight > 0], weight[weight > 0]
            yield unit, rows, np.stack([weight, block.y[rows]], axis=1).astype(np.float32)

    def stats(self, raw):
        if not self.classes:
            return super().stats(raw)
        return np.concatenate([raw[:, :1], raw[:, :1] * np.eye(self.classes)[raw[:, 1].astype(int)]], axis=1)


@dataclass
class Residuals(Job):
    """One unit for each scenario and score: what its scores miss, and the curvature of the loss. `trees`: rounds since the
    scores of the table were written.
    """

    scenarios: int
    classes: int
    rate: float
    trees: list[dict[int, Tree]]

    def __post_init__(self):
        self.scored, self.wide = 1, 1 if self.classes <= 2 else self.classes
        self.units = list(range(self.scenarios * self.wide))

    def scenario(self, unit):
        return unit // self.wide

    def advanced(self, block: Block) -> np.ndarray:
        """Scores by (row, scenario, class) with the trees since."""
        scores = block.scores.reshape(len(block.y), self.scenarios, self.wide).copy()
        for grown in self.trees:
            for unit, tree in grown.items():
                s, k = divmod(unit, self.wide)
                rows = np.flatnonzero(block.roles[:, s])
                scores[rows, s, k] += np.float32(self.rate) * tree.values(block.x[rows])[:, 0]
        return scores

    def missing(self, scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What scores by (row, scenario, class) miss, and the curvature of the loss there."""
        scores = scores.astype(float)
        if self.classes == 0:
            return y[:, None, None] - scores, np.ones_like(scores)
        if self.wide == 1:
            p, y = 0.5 + 0.5 * np.tanh(0.5 * scores), y[:, None, None]
        else:
            p = np.exp(scores - scores.max(axis=2, keepdims=True))
            p /= p.sum(axis=2, keepdims=True)
            y = np.eye(self.classes)[y.astype(int)][:, None, :]
        return y - p, p * (1 - p)

    def likely(self, scores: np.ndarray) -> np.ndarray:
        return scores[:, 0] if not self.classes else scores[:, 0] > 0 if self.wide == 1 and self.classes == 2 else scores.argmax(axis=1)

    def of_block(self, block, units):
        missed, curved = self.missing(self.advanced(block), block.y)
        for unit in units:
            s, k = divmod(unit, self.wide)
            rows = np.flatnonzero(block.roles[:, s] == 1)
            yield unit, rows, np.stack([np.ones(len(rows)), missed[rows, s, k], curved[rows, s, k]], axis=1).astype(np.float32)


def _subtrees(rows: DataFrame, job: Job, sketches: dict[int, Sketch], nodes: dict[int, list[int]], growth: Growth) -> None:
    """Finish the given nodes, each from its rows in one task."""
    shared = rows.sparkSession.sparkContext.broadcast(
        (job, {u: (sketches[u].routes(), [(k, sketches[u].path[k], sketches[u].depth[k]) for k in nodes[u]]) for u in nodes}))

    def gathered(batches):
        job, plan = shared.value
        for batch in batches:
            block, out = Block.of(batch), []
            for unit, own, raw in job.of_block(block, plan):
                routes, ends = plan[unit]
                at = leaf_of(routes, block.x[own])
                for node, path, depth in ends:
                    here = at == node
                    if here.any():
                        out.append((unit, node, path, depth, block.x[own[here]].tobytes(), raw[here].tobytes(), int(here.sum())))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32()))],
                ["unit", "node", "path", "depth", "x", "raw", "n"])

    def finished(group: pa.Table) -> pa.Table:
        job, _ = shared.value
        n = sum(group["n"].to_pylist())
        x = np.frombuffer(b"".join(group["x"].to_pylist()), "u1").reshape(n, -1)
        raw = np.frombuffer(b"".join(group["raw"].to_pylist()), "<f4").reshape(n, -1)
        unit, node, path, depth = (group[c][0].as_py() for c in ("unit", "node", "path", "depth"))
        grown = grow_here(x, job.stats(raw), growth, unit, job.scored, path, depth)
        return pa.table({"unit": pa.array([unit], pa.int32()), "node": pa.array([node], pa.int32()), "grown": [grown.packed()]})

    parts = rows.mapInArrow(gathered, "unit int, node int, path long, depth int, x binary, raw binary, n int")
    parts = parts.repartition(shuffle_partitions(rows.sparkSession), "unit", "node")
    for r in parts.groupBy("unit", "node").applyInArrow(finished, "unit int, node int, grown binary").collect():
        sketches[r["unit"]].graft(r["node"], Sketch.unpacked(r["grown"]))
    for unit, ends in nodes.items():  # nodes that no row reaches
        for node in ends:
            sketches[unit].known[node] = True


def _split_by_histograms(rows: DataFrame, job: Job, sketches: dict[int, Sketch], nodes: dict[int, list[int]], growth: Growth,
                         features: int, statistics: int) -> None:
    """Split the given nodes from histograms that Spark sums by unit; with more than fit, in several jobs."""
    wide = features if growth.drawn is None else min(features, growth.drawn)
    at_once = max(1, HISTOGRAM_BYTES // (wide * 256 * statistics * 8))
    every = [(u, k) for u in nodes for k in nodes[u]]
    for begin in range(0, len(every), at_once):
        chosen: dict[int, list[int]] = {}
        for unit, node in every[begin:begin + at_once]:
            chosen.setdefault(unit, []).append(node)
        drawn = {u: drawn_features(growth, u, [sketches[u].path[k] for k in own], features) for u, own in chosen.items()}
        shared = rows.sparkSession.sparkContext.broadcast((job, {u: (sketches[u].routes(), chosen[u], drawn[u]) for u in chosen}))

        def added(batches):
            job, plan = shared.value
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                block = Block.of(batch)
                for unit, own, raw in job.of_block(block, plan):
                    routes, ends, draw = plan[unit]
                    place = np.full(len(routes[0]), -1)
                    place[ends] = np.arange(len(ends))
                    node = place[leaf_of(routes, block.x[own])]
                    own, raw, node = own[node >= 0], raw[node >= 0], node[node >= 0]
                    if len(own):
                        slots = (node[:, None] * draw.shape[1] + np.arange(draw.shape[1])) << 8
                        key = (slots | np.take_along_axis(block.x[own], draw[node], axis=1)).ravel()
                        found = np.stack([np.bincount(key, np.repeat(column, draw.shape[1]), len(ends) * draw.shape[1] << 8)
                                          for column in job.stats(raw).T], axis=1)
                        total[unit] = total[unit] + found if unit in total else found
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                             ["unit", "sums"])

        def best(group: pa.Table) -> pa.Table:
            job, plan = shared.value
            unit = group["unit"][0].as_py()
            _, ends, draw = plan[unit]
            sums = sum(np.frombuffer(s, "<f8") for s in group["sums"].to_pylist())
            found = splits_of_histograms(sums.reshape(len(ends), draw.shape[1], 256, -1), draw, job.scored, growth.least)
            return pa.table({"unit": pa.array([unit], pa.int32()), "splits": [pickle.dumps(found)]})

        sums = rows.mapInArrow(added, "unit int, sums binary").repartition(shuffle_partitions(rows.sparkSession), "unit")
        for r in sums.groupBy("unit").applyInArrow(best, "unit int, splits binary").collect():
            for node, split in zip(chosen[r["unit"]], pickle.loads(r["splits"])):
                sketches[r["unit"]].tell(node, split)
        for unit, own in chosen.items():
            for node in own:
                sketches[unit].known[node] = True


def grow(data: Matrix, rows: DataFrame, job: Job, growth: Growth, small_rows: int | None = None) -> dict[int, Sketch]:
    """The trees of all units of a job, split by split together."""
    small_rows = SMALL_ROWS if small_rows is None else small_rows
    sketches = {unit: Sketch() for unit in job.units}
    statistics = 1 + job.scored + isinstance(job, Residuals)
    while True:
        small: dict[int, list[int]] = {}
        large: dict[int, list[int]] = {}
        for unit, sketch in sketches.items():
            for node in sketch.plan(growth)[1]:
                n = data.trained[job.scenario(unit)] if sketch.sums[node] is None else sketch.sums[node][0]
                (small if n <= small_rows else large).setdefault(unit, []).append(node)
        if not small and not large:
            return sketches
        if small:
            _subtrees(rows, job, sketches, small, growth)
        if large:
            _split_by_histograms(rows, job, sketches, large, growth, data.features, statistics)


# ---------------------------------------------------------------- models

_PREDICTED = "scenario int, row_id long, y double, prediction double"
_SCORED = "row_id long, x binary, roles binary, y double, scores binary"


def _named(data: Matrix, predicted: DataFrame) -> DataFrame:
    """scenario, row_id, label, prediction with the names and labels of the table."""
    names = F.array(*[F.lit(n) for n in data.scenarios])
    def label(c: str): return F.get(F.array(*[F.lit(x) for x in data.labels]), F.col(c).cast("int")) if data.labels else F.col(c)
    return predicted.select(F.get(names, "scenario").alias("scenario"), "row_id", label("y").alias("label"),
                            label("prediction").alias("prediction"))


def _predicted(batch_rows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [np.concatenate([np.full(len(i), s) for s, i, _, _ in batch_rows] or [np.zeros(0)]).astype(np.int32)]
    columns += [np.concatenate([np.asarray(r[k], kind) for r in batch_rows] or [np.zeros(0, kind)]) for k, kind in ((1, np.int64), (2, float), (3, float))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["scenario", "row_id", "y", "prediction"])


def forest_predictions(data: Matrix, trees: int, growth: Growth) -> DataFrame:
    """Of every test row of every scenario, by a forest of its train rows: mean of the leaves, or the likeliest label."""
    job = Bootstraps(len(data.scenarios), trees, len(data.labels), growth.seed)
    wide = data.features if growth.drawn is None else min(growth.drawn, data.features)
    # Rows travel and are sorted four times over; a level holds some fourteen numbers of each row and drawn feature.
    if whole.fits(data.most, 4 * (data.features + 25) + 112 * wide):
        return _named(data, _forest_in_tasks(data, job, trees, growth))
    return _named(data, _forest_by_votes(data, job, trees, growth))


def _voted(sums: np.ndarray, trees: int, classes: int) -> np.ndarray:
    mean = sums / trees
    return np.round(mean, 9).argmax(axis=1) if classes else mean[:, 0]


def _forest_in_tasks(data: Matrix, job: Bootstraps, trees: int, growth: Growth) -> DataFrame:
    """Each group of trees of a scenario is grown in a task with the scenario's rows, which adds up their votes for its test rows."""
    classes = job.classes

    def fit(group: tuple, row_id: np.ndarray, x: np.ndarray, role: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
        scenario, first, count = group
        train, test = np.flatnonzero(role == 1), np.flatnonzero(role == 2)
        x_train, x_test, y_train, votes = x[train], x[test], y[train], np.zeros((len(test), job.scored))
        for unit in range(scenario * trees + first, scenario * trees + first + count):
            weight = job.weights(unit, row_id[train])
            own = np.flatnonzero(weight)
            if classes and growth.leaves is None:
                tree = grow_labels(x_train[own], y_train[own].astype(np.int64), weight[own].astype(float), classes, growth, unit)
            else:
                stats = job.stats(np.stack([weight[own], y_train[own]], axis=1).astype(np.float32))
                tree = grow_here(x_train[own], stats, growth, unit, job.scored).tree(growth, _shares(classes))
            votes += tree.values(x_test)
        for part in range(0, len(test), ROWS_A_BLOCK):
            own = slice(part, part + ROWS_A_BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip((scenario, part, first, row_id[test][own].tobytes(), y[test][own].tobytes(), votes[own].tobytes()),
                                                  (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                ["scenario", "part", "first", "row_id", "y", "votes"])

    def summed(blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("first").to_pylist()
        row_id, y = np.frombuffer(blocks[0]["row_id"], "<i8"), np.frombuffer(blocks[0]["y"], "<f8")
        votes = sum(np.frombuffer(b["votes"], "<f8") for b in blocks).reshape(len(y), -1)
        return pa.Table.from_batches([_predicted([(blocks[0]["scenario"], row_id, y, _voted(votes, trees, classes))])])

    tasks = GROUPS_A_CORE * data.rows.sparkSession.sparkContext.defaultParallelism
    groups = whole.dealt(data.trained.tolist(), trees, tasks)
    votes = whole.in_tasks(data.rows, groups, "u1", fit, "scenario int, part int, first int, row_id binary, y binary, votes binary")
    return cut_lineage(cut_lineage(votes).groupBy("scenario", "part").applyInArrow(summed, _PREDICTED))


def _shares(classes: int):
    return (lambda s: s[1:] / max(s[0], 1e-300)) if classes else (lambda s: s[1] / max(s[0], 1e-300))


def _forest_by_votes(data: Matrix, job: Bootstraps, trees: int, growth: Growth) -> DataFrame:
    """A few trees are grown at a time and their votes are added to the rows; how many depends on the nodes that the last ones had."""
    count, classes, context = len(data.scenarios), job.classes, data.rows.sparkSession.sparkContext
    units, at_once, value, nothing = job.units, 1, _shares(classes), np.zeros(1 + job.scored)
    rows = data.rows.withColumn("scores", F.lit(np.zeros(count * job.scored).tobytes()))
    while units:
        job.units, units = units[:at_once], units[at_once:]
        grown, nodes = {}, 1
        for unit, sketch in grow(data, data.rows, job, growth).items():
            sketch.sums[0] = nothing if sketch.sums[0] is None else sketch.sums[0]
            grown[unit], nodes = sketch.tree(growth, value), max(nodes, len(sketch.feature))
        shared = context.broadcast(grown)
        rows = cut_lineage(_with_votes(rows, shared, trees, job.scored))
        shared.destroy()
        at_once = max(1, min(FASTER * at_once, NODES_HELD // nodes))

    def predict(batches):
        for batch in batches:
            block, found = Block.of(batch, "<f8"), []
            votes = block.scores.reshape(len(block.y), count, -1)
            for s in range(count):
                own = np.flatnonzero(block.roles[:, s] == 2)
                found.append((s, block.row_id[own], block.y[own], _voted(votes[own, s], trees, classes)))
            yield _predicted(found)

    return rows.mapInArrow(predict, _PREDICTED)


def _with_votes(rows: DataFrame, grown, trees: int, wide: int) -> DataFrame:
    def add(batches):
        for batch in batches:
            block = Block.of(batch, "<f8")
            votes = block.scores.reshape(len(block.y), -1, wide).copy()
            for unit, tree in grown.value.items():
                own = np.flatnonzero(block.roles[:, unit // trees] == 2)
                votes[own, unit // trees] += tree.values(block.x[own])
            yield _with_scores(batch, votes)

    return rows.mapInArrow(add, _SCORED)


def boosted_predictions(data: Matrix, rounds: int, rate: float, growth: Growth) -> DataFrame:
    """Of every test row of every scenario, by gradient boosting of its train rows: all scenarios and classes of a round
    grow together. Log loss with a score for each label (one score for two labels), or squared loss.
    """
    count, classes = len(data.scenarios), len(data.labels)
    wide = 1 if classes <= 2 else classes
    share = data.totals / np.maximum(data.trained, 1)[:, None]
    if classes == 2:
        share = np.clip(share[:, 1:], 1e-12, 1 - 1e-12)
        start = np.log(share / (1 - share))
    else:
        start = np.log(np.maximum(share, 1e-12)) if classes else share
    # A Newton step of the log loss, (K - 1) / K for K scores; the mean of what is missed for the squared loss.
    shrink = (classes - 1) / classes if wide > 1 else 1.0
    value = (lambda s: shrink * s[1] / s[2] if s[2] > 1e-150 else 0.0) if classes else (lambda s: s[1] / s[0] if s[0] else 0.0)
    start = start.astype("<f4").reshape(count, wide)
    if whole.fits(data.most, 5 * (data.features + 25) + 64 * (1 + wide)):
        return _named(data, _boosted_in_tasks(data, start, Residuals(count, classes, rate, []), rounds, growth, value))
    rows, kept = data.rows.withColumn("scores", F.lit(start.tobytes())), []
    for _ in range(rounds):
        grown = grow(data, rows, Residuals(count, classes, rate, kept), growth)
        kept = [*kept, {u: sketch.tree(growth, value) for u, sketch in grown.items() if sketch.sums[0] is not None}]
        if len(kept) == ROUNDS_KEPT:
            rows, kept = cut_lineage(_advanced(rows, Residuals(count, classes, rate, kept))), []
    shared = rows.sparkSession.sparkContext.broadcast(Residuals(count, classes, rate, kept))

    def predict(batches):
        for batch in batches:
            block, found = Block.of(batch), []
            scores = shared.value.advanced(block)
            for s in range(count):
                own = np.flatnonzero(block.roles[:, s] == 2)
                found.append((s, block.row_id[own], block.y[own], shared.value.likely(scores[own, s])))
            yield _predicted(found)

    return _named(data, rows.mapInArrow(predict, _PREDICTED))


def _boosted_in_tasks(data: Matrix, start: np.ndarray, job: Residuals, rounds: int, growth: Growth, value) -> DataFrame:
    """All rounds of a scenario in a task with its rows."""
    def fit(group: tuple, row_id: np.ndarray, x: np.ndarray, role: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
        s, train, test = group[0], np.flatnonzero(role == 1), np.flatnonzero(role == 2)
        x_train = np.asfortranarray(x[train])
        scores = np.tile(start[s], (len(y), 1))
        for _ in range(rounds if len(train) else 0):
            missed, curved = job.missing(scores[train][:, None, :], y[train])
            for k in range(job.wide):
                stats = job.stats(np.stack([np.ones(len(train)), missed[:, 0, k], curved[:, 0, k]], axis=1).astype(np.float32))
                tree = grow_here(x_train, stats, growth, s * job.wide + k, job.scored).tree(growth, value)
                scores[:, k] += np.float32(job.rate) * tree.values(x)[:, 0]
        yield _predicted([(s, row_id[test], y[test], job.likely(scores[test]))])

    groups = sorted(((s,) for s in range(len(data.scenarios))), key=lambda g: -data.trained[g[0]])
    return cut_lineage(whole.in_tasks(data.rows, groups, "u1", fit, _PREDICTED))


def _advanced(rows: DataFrame, job: Residuals) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(job)

    def advance(batches):
        for batch in batches:
            yield _with_scores(batch, shared.value.advanced(Block.of(batch)))

    return rows.mapInArrow(advance, _SCORED)


def _with_scores(batch: pa.RecordBatch, scores: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row_id", "x", "roles", "y")), pa.array([s.tobytes() for s in scores], pa.binary())],
                                      ["row_id", "x", "roles", "y", "scores"])
