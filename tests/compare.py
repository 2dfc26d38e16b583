"""Compare registered queries with their SQL twins on the same tables.

Usage: python tests/compare.py [folder] [query name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return str(value)


def normalised(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows ordered by their exact columns first and their floating ones last."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(row[i] for i in order) for row in rows]
    rows.sort(key=lambda r: ([_plain(v) for v in r if not isinstance(v, float)], [_plain(v) for v in r]))
    return [columns[i] for i in order], rows


def _same(ours: tuple, theirs: tuple, tolerance: float) -> bool:
    return all(_plain(a) == _plain(b) or (tolerance and isinstance(a, float) and isinstance(b, float)
                                          and abs(a - b) <= tolerance) for a, b in zip(ours, theirs))


def differences(spark, connection, folder: str, query, sql: str, tolerance: float = 0.0) -> list[str]:
    """First differing rows. A tolerance forgives a last digit that both engines round from an exact half."""
    frame = query(spark, folder)
    ours = normalised(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    theirs = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} != {theirs[0]}"]
    found = [f"{a}\n      {b}" for a, b in zip(ours[1], theirs[1]) if not _same(a, b, tolerance)]
    if len(ours[1]) != len(theirs[1]):
        return [f"{len(ours[1])} rows != {len(theirs[1])}", *found[:3]]
    return found[:5]


def main() -> None:
    from pyspark.sql import SparkSession

    from fathomline.plans import registry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.QUERIES)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "10g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in names:
        start = time.time()
        try:
            if name in registry.ORACLE:
                found = differences(spark, connection, folder, registry.QUERIES[name], registry.ORACLE[name])
                verdict = "ok" if not found else "DIFFERS\n   " + "\n   ".join(found)
            else:
                frame = registry.QUERIES[name](spark, folder)
                rows = frame.collect()
                verdict = f"rows only: {len(rows)}\n   " + "\n   ".join(str(r)[:300] for r in rows[:8])
        except Exception as error:  # report every query, then go on
            verdict = f"FAILS {type(error).__name__} {str(error)[:1500]}"
        print(f"{name}: {verdict} ({time.time() - start:.1f} s)", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
