"""Fits of scenarios in tasks of their own, for tables whose rows fit there.

A fit of many steps over all rows takes a Spark job a step. Where the rows of a scenario fit a task, they are sent there once, as
packed blocks, and all steps are taken in it; only predictions leave the task. Larger tables are fitted step by step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes that the rows of a task may take, with what a fit makes of them.
TASK_BYTES = 1 << 28


def fits(rows: float, bytes_a_row: float) -> bool:
    return rows * bytes_a_row <= TASK_BYTES


def in_tasks(rows: DataFrame, groups: list[tuple], kind: str, fit: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`fit(group, row_id, x, role, y)` of every group, with the rows that its scenario (the group's first value) trains or tests.

    `rows` has row_id, x (values of `kind`), roles and y. Rows come in order of row_id, whatever their partition. Groups are
    few, and each is a task: those that come first start first. A group whose scenario has no rows makes nothing.
    """
    numbers: dict[int, list[int]] = {}
    for number, group in enumerate(groups):
        numbers.setdefault(group[0], []).append(number)
    label = "<f8" if rows.schema["y"].dataType.typeName() == "double" else "<i4"
    kinds = ("<i8", kind, "u1", label)

    def packed(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            row_id, y = batch.column("row_id").to_numpy(), batch.column("y").to_numpy()
            x, roles = (np.frombuffer(b"".join(batch.column(c).to_pylist()), k).reshape(n, -1) for c, k in (("x", kind), ("roles", "u1")))
            for scenario, places in numbers.items():
                own = np.flatnonzero(roles[:, scenario])
                if len(own):
                    held = [np.ascontiguousarray(v[own]).astype(k).tobytes() for v, k in zip((row_id, x, roles[:, scenario], y), kinds)]
                    yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array([len(own)] * len(places), pa.int32()),
                                                      *(pa.array([v] * len(places), pa.binary()) for v in held)],
                                                     ["task", "n", "row_id", "x", "role", "y"])

    def fitted(batches):
        held: dict[int, list[dict]] = {}
        for batch in batches:
            for block in batch.to_pylist():
                held.setdefault(block["task"], []).append(block)
        for number in sorted(held):
            blocks = held.pop(number)
            n = sum(b["n"] for b in blocks)
            row_id, x, role, y = (np.frombuffer(b"".join(b.pop(c) for b in blocks), k).reshape(n, -1)
                                  for c, k in zip(("row_id", "x", "role", "y"), kinds))
            order = _order(row_id[:, 0], x, role[:, 0], y[:, 0])
            yield from fit(groups[number], row_id[order, 0], x[order], role[order, 0], y[order, 0])

    dealt = rows.mapInArrow(packed, "task int, n int, row_id binary, x binary, role binary, y binary")
    return dealt.repartitionById(max(1, len(groups)), "task").mapInArrow(fitted, schema)


def _order(row_id: np.ndarray, x: np.ndarray, role: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places in order of row_id, and of the other values where ids repeat: the same in every task."""
    order = np.argsort(row_id, kind="stable")
    repeats = row_id[order[1:]] == row_id[order[:-1]]
    if repeats.any():
        ends = np.flatnonzero(np.diff(np.concatenate([[0], repeats, [0]]).astype("i1"))).reshape(-1, 2)
        for begin, last in ends.tolist():
            order[begin:last + 1] = sorted(order[begin:last + 1].tolist(), key=lambda k: (role[k], y[k], x[k].tobytes()))
    return order


def dealt(work: list[float], most: int, tasks: int) -> list[tuple[int, int, int]]:
    """(scenario, first, count) of the `most` equal units of every scenario, dealt into about `tasks` groups of like work, heaviest first."""
    share = sum(work) * most / max(1, tasks)
    groups = []
    for scenario, of_one in enumerate(work):
        parts = int(min(most, max(1, np.ceil(of_one * most / share)))) if share > 0 else 1
        cuts = np.linspace(0, most, parts + 1).astype(int).tolist()
        groups += [(of_one * (b - a), scenario, a, b - a) for a, b in zip(cuts, cuts[1:])]
    return [group[1:] for group in sorted(groups, key=lambda g: (-g[0], g[1:]))]
