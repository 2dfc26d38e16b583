"""Linear and kernel classifiers of many scenarios fitted together.

Where the rows of a scenario fit a task, its optimiser runs there. In a larger table every scenario has its optimiser on the
driver; each says at which weights it wants its loss and gradient next, and one Spark job answers all of them with a single
pass over the rows. The number of jobs is that of the slowest scenario, whatever their number, and the driver holds weights
and gradients only.
"""

from __future__ import annotations

from collections.abc import Generator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators import scenarios, whole
from fathomline.session import cut_lineage, over_cores

#: An optimiser ends when a step lowers its loss by less than this share, or after so many evaluations.
TOLERANCE, EVALUATIONS = 1e-7, 300
#: Corrections that an optimiser remembers.
MEMORY = 10
#: Landmarks of the kernel, and eigenvalues of their kernel matrix that count as 0.
LANDMARKS, NO_EIGENVALUE = 256, 1e-10
#: With more partitions than this, partial sums are added by Spark before they reach the driver.
PARTIALS = 16
#: Rows that an optimiser in a task takes at once, as few as stay in a core's cache, and bytes of what it makes of them that it
#: keeps between its steps.
ROWS_AT_ONCE, KEPT_BYTES = 512, 3 << 26
SEED = 42


@dataclass(frozen=True)
class Matrix:
    """row_id, x (doubles), roles and y (place of the label) as a written table; moments of the train rows by scenario."""

    rows: DataFrame
    scenarios: tuple[str, ...]
    labels: tuple
    trained: np.ndarray
    means: np.ndarray
    #: Population deviations; 1 for constant features.
    stds: np.ndarray
    partitions: int
    #: Rows that a scenario trains or tests at most.
    most: int


@dataclass
class Block:
    row_id: np.ndarray
    x: np.ndarray
    roles: np.ndarray
    y: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Block:
        def bytes_of(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, -1) if batch.num_rows \
                else np.zeros((0, 1), kind)
        return cls(batch.column("row_id").to_numpy(), bytes_of("x", "<f8"), bytes_of("roles", "u1"), batch.column("y").to_numpy())


def _summed(rows: DataFrame, partitions: int, shared, of_block) -> dict[int, np.ndarray]:
    """Per scenario the sum over all rows of the vectors that `of_block` makes of a block and the broadcast value."""
    def partial(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for scenario, vector in of_block(Block.of(batch), shared.value):
                total[scenario] = total[scenario] + vector if scenario in total else vector
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.astype("<f8").tobytes() for v in total.values()], pa.binary())],
                                         ["scenario", "total"])

    def added(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, "<f8") for v in group["total"].to_pylist())
        return pa.table({"scenario": group["scenario"].slice(0, 1), "total": [total.tobytes()]})

    parts = rows.mapInArrow(partial, "scenario int, total binary")
    if partitions > PARTIALS:
        parts = parts.groupBy("scenario").applyInArrow(added, "scenario int, total binary")
    found: dict[int, np.ndarray] = {}
    for r in parts.collect():
        vector = np.frombuffer(r["total"], "<f8")
        found[r["scenario"]] = found[r["scenario"]] + vector if r["scenario"] in found else vector
    return found


def matrix(placed: DataFrame) -> Matrix:
    """Of a table of `scenarios.place`. Moments are those of the train rows, from two passes."""
    placed = cut_lineage(placed.select("row_id", "label", "features", "trains", "tests"))
    names, labels = scenarios.names_of(placed), scenarios.labels_of(placed)
    at = {label: k for k, label in enumerate(labels)}

    def encoded(batches):
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array([v.tobytes() for v in flat], pa.binary()),
                 pa.array([v.tobytes() for v in scenarios.roles_of(batch, names)], pa.binary()),
                 pa.array([at[v] for v in batch.column("label").to_pylist()], pa.int32())], ["row_id", "x", "roles", "y"])

    rows = cut_lineage(over_cores(placed).mapInArrow(encoded, "row_id long, x binary, roles binary, y int"))
    partitions = rows.rdd.getNumPartitions()
    context = rows.sparkSession.sparkContext

    def sums(block: Block, _) -> Generator:
        for s in range(len(names)):
            x = block.x[block.roles[:, s] == 1]
            yield s, np.concatenate([[(block.roles[:, s] > 0).sum(), len(x)], x.sum(axis=0)])

    def squares(block: Block, means) -> Generator:
        for s in range(len(names)):
            yield s, ((block.x[block.roles[:, s] == 1] - means[s]) ** 2).sum(axis=0)

    first = _summed(rows, partitions, context.broadcast(None), sums)
    first = np.stack([first[s] for s in range(len(names))]) if first else np.zeros((0, 2))
    most, first = int(first[:, 0].max(initial=0)), first[:, 1:]
    trained = np.maximum(first[:, :1], 1)
    means = first[:, 1:] / trained
    second = _summed(rows, partitions, context.broadcast(means), squares)
    stds = np.sqrt(np.stack([second[s] for s in range(len(names))]) / trained) if second else np.zeros((0, 0))
    return Matrix(rows, names, labels, first[:, 0], means, np.where(stds > 0, stds, 1.0), partitions, most)


def minimiser(start: np.ndarray) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Limited-memory BFGS (Nocedal, 1980) that yields points and is sent the loss and gradient there; returns the best point."""
    w, history = start, []
    loss, slope = yield w
    for _ in range(EVALUATIONS):
        if not np.abs(slope).max(initial=0.0) > 1e-10:
            break
        q, steps = slope.copy(), []
        for s, y, rho in reversed(history):
            steps.append(rho * (s @ q))
            q -= steps[-1] * y
        if history:
            s, y, _ = history[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, y, rho), a in zip(history, reversed(steps)):
            q += (a - rho * (y @ q)) * s
        descent, size = -(slope @ q), 1.0
        for _ in range(30):
            tried = w - size * q
            tried_loss, tried_slope = yield tried
            if tried_loss <= loss + 1e-4 * size * descent:
                break
            size /= 2 if size > 1 / 8 else 8
        else:
            break
        s, y = tried - w, tried_slope - slope
        if s @ y > 1e-12 * (y @ y):
            history = [*history, (s, y, 1 / (s @ y))][-MEMORY:]
        done = loss - tried_loss <= TOLERANCE * max(abs(loss), 1e-12)
        w, loss, slope = tried, tried_loss, tried_slope
        if done:
            break
    return w


def minimise_together(data: Matrix, length: int, losses, penalty) -> list[np.ndarray]:
    """The best weights of every scenario. `losses(block, {scenario: weights})` gives (scenario, [loss, gradient]) of train rows;
    `penalty(scenario, weights)` a loss and gradient that don't depend on rows.
    """
    solvers = {s: minimiser(np.zeros(length)) for s in range(len(data.scenarios))}
    points = {s: next(solver) for s, solver in solvers.items()}
    best = [np.zeros(length)] * len(solvers)
    context = data.rows.sparkSession.sparkContext
    while points:
        shared = context.broadcast(points)
        sums, asked = _summed(data.rows, data.partitions, shared, losses), points
        points = {}
        for s, w in asked.items():
            loss, slope = penalty(s, w)
            total = sums.get(s, np.zeros(1 + length))
            try:
                points[s] = solvers[s].send((loss + total[0], slope + total[1:]))
            except StopIteration as done:
                best[s] = done.value
        shared.destroy()
    return best


def fitted_predictions(data: Matrix, length: int, prepare, losses, penalty, predict) -> DataFrame:
    """scenario, row_id, label, prediction of all test rows by the best weights of every scenario.

    `prepare(x, scenario)` makes what the weights meet: `losses(made, y, weights, scenario)` gives [loss, gradient] of train rows,
    `predict(made, weights, scenario)` places of labels. `penalty(scenario, weights)` gives a loss and gradient that don't depend on rows.
    """
    if whole.fits(data.most, 4 * (8 * data.means.shape[1] + 21)):
        return _fitted_in_tasks(data, length, prepare, losses, penalty, predict)

    def of_block(block: Block, points: dict[int, np.ndarray]) -> Generator:
        for s, w in points.items():
            own = block.roles[:, s] == 1
            yield s, losses(prepare(block.x[own], s), block.y[own], w, s)

    best = minimise_together(data, length, of_block, penalty)
    shared = data.rows.sparkSession.sparkContext.broadcast(best)
    return _predictions(data, shared, lambda x, s, weights: predict(prepare(x, s), weights[s], s))


def _fitted_in_tasks(data: Matrix, length: int, prepare, losses, penalty, predict) -> DataFrame:
    def fit(group: tuple, row_id: np.ndarray, x: np.ndarray, role: np.ndarray, y: np.ndarray) -> Generator:
        s, kept, blocks = group[0], 0, []
        train, test = np.flatnonzero(role == 1), np.flatnonzero(role == 2)
        for low in range(0, len(train), ROWS_AT_ONCE):
            own = train[low:low + ROWS_AT_ONCE]
            made = prepare(x[own], s) if kept < KEPT_BYTES else None
            kept += 0 if made is None else made.nbytes
            blocks.append((own, made))
        solver = minimiser(np.zeros(length))
        w = next(solver)
        try:
            while True:
                loss, slope = penalty(s, w)
                total = np.zeros(1 + length)
                for own, made in blocks:
                    total += losses(prepare(x[own], s) if made is None else made, y[own], w, s)
                w = solver.send((loss + total[0], slope + total[1:]))
        except StopIteration as done:
            w = done.value
        for low in range(0, len(test), ROWS_AT_ONCE):
            own = test[low:low + ROWS_AT_ONCE]
            columns = (np.full(len(own), s), row_id[own], y[own], predict(prepare(x[own], s), w, s))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, ("i4", "i8", "i4", "i4"))],
                                             ["scenario", "row_id", "y", "p"])

    groups = sorted(((s,) for s in range(len(data.scenarios))), key=lambda g: -data.trained[g[0]])
    return _named(data, cut_lineage(whole.in_tasks(data.rows, groups, "<f8", fit, "scenario int, row_id long, y int, p int")))


def _named(data: Matrix, predicted: DataFrame) -> DataFrame:
    names, labels = (F.array(*[F.lit(v) for v in values]) for values in (data.scenarios, data.labels))
    return predicted.select(F.get(names, "scenario").alias("scenario"), "row_id", F.get(labels, "y").alias("label"),
                            F.get(labels, "p").alias("prediction"))


def _predictions(data: Matrix, shared, predict) -> DataFrame:
    """scenario, row_id, label, prediction of all test rows; `predict(x, scenario, value)` gives places of labels."""
    count = len(data.scenarios)

    def predicted(batches):
        for batch in batches:
            block, found = Block.of(batch), []
            for s in range(count):
                own = np.flatnonzero(block.roles[:, s] == 2)
                if len(own):
                    found.append((np.full(len(own), s), block.row_id[own], block.y[own], predict(block.x[own], s, shared.value)))
            columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0)] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, ("i4", "i8", "i4", "i4"))],
                                             ["scenario", "row_id", "y", "p"])

    return _named(data, data.rows.mapInArrow(predicted, "scenario int, row_id long, y int, p int"))


def logistic_predictions(placed: DataFrame) -> DataFrame:
    """Multinomial logistic regression on features scaled in the scenario, with a squared penalty of 1/2 on the weights."""
    data = matrix(placed)
    classes, width = len(data.labels), data.means.shape[1]
    means, stds = data.means, data.stds

    def prepare(x: np.ndarray, s: int) -> np.ndarray:
        return (x - means[s]) / stds[s]

    def scores(z: np.ndarray, w: np.ndarray) -> np.ndarray:
        w = w.reshape(width + 1, classes)
        return z @ w[:-1] + w[-1]

    def losses(z: np.ndarray, y: np.ndarray, w: np.ndarray, s: int) -> np.ndarray:
        f = scores(z, w)
        f = f - f.max(axis=1, keepdims=True)
        e = np.exp(f)
        total = e.sum(axis=1, keepdims=True)
        d = e / total
        d[np.arange(len(y)), y] -= 1
        return np.concatenate([[(np.log(total[:, 0]) - f[np.arange(len(y)), y]).sum()], (z.T @ d).ravel(), d.sum(axis=0)])

    def penalty(s: int, w: np.ndarray) -> tuple[float, np.ndarray]:
        held = w.copy()
        held[width * classes:] = 0
        return 0.5 * float(held @ held), held

    return fitted_predictions(data, (width + 1) * classes, prepare, losses, penalty, lambda z, w, s: scores(z, w).argmax(axis=1))


def least_squares_predictions(placed: DataFrame) -> DataFrame:
    """Exact least squares with an intercept: scenario, row_id, label (the target), prediction of the test rows.

    One pass sums the products of the features and targets of the rows with each set of scenarios that they train (each
    fold, for a cross-validation); a scenario's sums are those of its sets, and its system is solved on the driver. Of
    equally good weights, as with all flags of a category, the shortest are taken. Products are formed from differences
    to the mean of all rows, so that large values lose no digits.
    """
    placed = cut_lineage(placed.select("row_id", F.col("label").cast("double").alias("label"), "features", "trains", "tests"))
    names = scenarios.names_of(placed)
    middle = [r["m"] for r in placed.select(F.posexplode(F.concat("features", F.array("label"))).alias("at", "v")).groupBy("at").agg(
        F.avg("v").alias("m")).orderBy("at").collect()]
    if not middle:
        return placed.select(F.lit("").alias("scenario"), "row_id", "label", F.col("label").alias("prediction"))
    width = len(middle)
    sets = placed.select(F.sort_array("trains").alias("trains"), F.concat("features", F.array("label")).alias("z"))

    def products(batches):
        total: dict[tuple, np.ndarray] = {}
        for batch in batches:
            z = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) - middle if batch.num_rows else np.zeros((0, width))
            z = np.concatenate([np.ones((len(z), 1)), z], axis=1)
            keys: dict[tuple, list[int]] = {}
            for k, trains in enumerate(batch.column("trains").to_pylist()):
                keys.setdefault(tuple(trains), []).append(k)
            for key, rows in keys.items():
                found = z[rows].T @ z[rows]
                total[key] = total[key] + found if key in total else found
        yield pa.RecordBatch.from_arrays([pa.array([list(k) for k in total], pa.list_(pa.string())),
                                          pa.array([v.ravel().tolist() for v in total.values()], pa.list_(pa.float64()))], ["trains", "t"])

    added = sets.mapInArrow(products, "trains array<string>, t array<double>").select("trains", F.posexplode("t").alias("at", "t"))
    by_scenario = added.groupBy("trains", "at").agg(F.sum("t").alias("t")).select(F.explode("trains").alias("scenario"), "at", "t")
    rows = by_scenario.groupBy("scenario", "at").agg(F.sum("t").alias("t")).collect()
    weights = {}
    for name in names:
        total = np.zeros((width + 1) ** 2)
        for r in rows:
            if r["scenario"] == name:
                total[r["at"]] = r["t"]
        weights[name] = _least_squares(total.reshape(width + 1, width + 1), np.array(middle))
    shared = placed.sparkSession.sparkContext.broadcast(weights)

    def predicted(batches):
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            w = [shared.value[name] for name in batch.column("scenario").to_pylist()]
            found = (x * np.array([v[:-1] for v in w]).reshape(x.shape)).sum(axis=1) + np.array([v[-1] for v in w]) if w else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("scenario", "row_id", "label")), pa.array(found, pa.float64())],
                                             ["scenario", "row_id", "label", "prediction"])

    tested = placed.select(F.explode("tests").alias("scenario"), "row_id", "label", F.col("features").cast("array<double>").alias("features"))
    return tested.mapInArrow(predicted, "scenario string, row_id long, label double, prediction double")


def _least_squares(products: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Weights of the features and the intercept from the products of (1, features, target) less `middle`; without rows zeros."""
    n = products[0, 0]
    if not n:
        return np.zeros(len(middle))
    means = products[0, 1:] / n
    centred = products[1:, 1:] - n * np.outer(means, means)
    # Solved for features of unit variance; what the unscaled weights have along the null space is then taken off.
    g, b = centred[:-1, :-1], centred[:-1, -1]
    size = np.sqrt(np.maximum(np.diag(g), 0))
    size = np.where(size > 0, size, np.inf)
    values, vectors = np.linalg.eigh(g / size / size[:, None])
    held = values > NO_EIGENVALUE * max(values[-1], 1e-300)
    w = vectors[:, held] @ ((vectors[:, held].T @ (b / size)) / values[held]) / size
    null = (vectors[:, ~held] / size[:, None])[:, np.abs(vectors[:, ~held] / size[:, None]).max(axis=0) > 0]
    if null.shape[1]:
        w -= null @ np.linalg.lstsq(null, w, rcond=None)[0]
    return np.append(w, middle[-1] + means[-1] - (middle[:-1] + means[:-1]) @ w)


def landmarks(placed: DataFrame, count: int = LANDMARKS, seed: int = SEED) -> np.ndarray:
    """Points that stand for all rows: centres of a k-means started by its distributed k-means++; no label is used.

    Features count by their deviation. Fewer distinct rows than `count` give fewer points.
    """
    rows = cut_lineage(placed.select("features"))
    moments = rows.select(F.posexplode("features").alias("at", "v")).groupBy("at").agg(
        F.stddev_pop("v").alias("std")).orderBy("at").collect()
    stds = [r["std"] if r["std"] else 1.0 for r in moments]
    scaled = F.transform("features", lambda v, k: v / F.get(F.lit(stds), k))
    found = KMeans(k=count, seed=seed, maxIter=5, featuresCol="v").fit(rows.select(array_to_vector(scaled).alias("v"))).clusterCenters()
    return np.unique(np.stack(found) * stds, axis=0)


def kernel_predictions(placed: DataFrame, count: int = LANDMARKS, cost: float = 1.0) -> DataFrame:
    """Radial kernel classifier, one vote for each pair of labels, all pairs and scenarios in one pass.

    The kernel of width 1 / (2 x number of features) on features scaled in the scenario is taken through landmarks (Nystroem),
    whose features are whitened by the kernel among them; where they hold all rows it is exact. Every pair minimises half
    the squared weights and `cost` x squared hinge losses. Equal votes go to the first label.
    """
    data = matrix(placed)
    points = landmarks(placed, count)
    classes, width = len(data.labels), points.shape[1]
    pairs = np.array([(a, b) for a in range(classes) for b in range(a + 1, classes)], np.int64).reshape(-1, 2)
    means, stds, gamma = data.means, data.stds, 1.0 / max(1, width)
    sign = np.zeros((max(1, classes), len(pairs)))
    sign[pairs[:, 0], np.arange(len(pairs))], sign[pairs[:, 1], np.arange(len(pairs))] = 1.0, -1.0
    context = data.rows.sparkSession.sparkContext

    def kernel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        apart = (x ** 2).sum(axis=1)[:, None] + (y ** 2).sum(axis=1)[None, :]
        apart -= 2 * x @ y.T
        np.maximum(apart, 0, out=apart)
        apart *= -gamma
        return np.exp(apart, out=apart)

    maps = []
    for s in range(len(data.scenarios)):
        own = (points - means[s]) / stds[s]
        values, vectors = np.linalg.eigh(kernel(own, own))
        held = values > NO_EIGENVALUE * values[-1]
        maps.append((own, np.where(held, 1 / np.sqrt(np.where(held, values, 1.0)), 0.0) * vectors))
    shared_maps = context.broadcast(maps)
    m = len(points)

    def prepare(x: np.ndarray, s: int) -> np.ndarray:
        return kernel((x - means[s]) / stds[s], shared_maps.value[s][0])

    def whitened(w: np.ndarray, s: int) -> np.ndarray:
        # Weights are whitened instead of the rows: m x pairs products a row, not m x m.
        w = w.reshape(m + 1, len(pairs))
        return np.concatenate([shared_maps.value[s][1] @ w[:-1], w[-1:]])

    def losses(k: np.ndarray, y: np.ndarray, w: np.ndarray, s: int) -> np.ndarray:
        w = whitened(w, s)
        f = k @ w[:-1] + w[-1]
        t = sign[y]
        short = np.maximum(1 - t * f, 0) * (t != 0)
        d = -2 * cost * short * t
        slope = shared_maps.value[s][1].T @ (k.T @ d)
        return np.concatenate([[cost * (short ** 2).sum()], slope.ravel(), d.sum(axis=0)])

    def penalty(s: int, w: np.ndarray) -> tuple[float, np.ndarray]:
        held = w.copy()
        held[m * len(pairs):] = 0
        return 0.5 * float(held @ held), held

    def predict(k: np.ndarray, w: np.ndarray, s: int) -> np.ndarray:
        w = whitened(w, s)
        f = k @ w[:-1] + w[-1]
        counted = np.zeros((len(k), max(1, classes)))
        for at, (a, b) in enumerate(pairs):
            counted[:, a] += f[:, at] > 0
            counted[:, b] += f[:, at] <= 0
        return counted.argmax(axis=1)

    return fitted_predictions(data, (m + 1) * len(pairs), prepare, losses, penalty, predict)
