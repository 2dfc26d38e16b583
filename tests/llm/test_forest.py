"""The forest against brute force over all pairs, its depths, and the recall of the join on whole driver tables."""

from __future__ import annotations

import random
from fractions import Fraction
from itertools import combinations

import pytest

from fathomline.llm import near_join
from fathomline.llm.forest import WIDTH, candidate_links, depth_of, least_similarity, prefix_length

TEXT = "row long, depth int, sketch binary"


def roots(edges, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for u, v in edges:
        root[max(find(u), find(v))] = min(find(u), find(v))
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("runs,batch", [(1, 10_000), (3, 7), (17, 2)])
@pytest.mark.parametrize("symbols", [1, 2, 4])
def test_texts_meet_as_all_pairs_say(spark, runs, batch, symbols):
    rng = random.Random(symbols * 31 + runs)
    trees, depth, least = 3, 4, 2
    rows = [(k, rng.choice([2, 3, 4, 4, None]), [[rng.randrange(symbols) for _ in range(depth)] for _ in range(trees)])
            for k in range(90)]
    texts = spark.createDataFrame([(k, d, bytes(b for key in keys for x in key for b in x.to_bytes(WIDTH, "little")))
                                   for k, d, keys in rows], TEXT)
    before = {name: spark.conf.get(name) for name in (
        "spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", runs)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        spark.conf.set("spark.sql.adaptive.enabled", False)
        links = [tuple(r) for r in candidate_links(texts, least, trees, depth).collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    searching = [r for r in rows if r[1] is not None]
    pairs = [(a[0], b[0]) for a, b in combinations(searching, 2)
             if any(x[:max(a[1], b[1])] == y[:max(a[1], b[1])] for x, y in zip(a[2], b[2]))]
    nodes = [r[0] for r in searching]
    assert {x for link in links for x in link} <= set(nodes)
    assert roots(links, nodes) == roots(pairs, nodes)
    assert len(links) <= trees * depth * len(rows) + 2 * depth * runs


def test_no_text_and_one_text(spark):
    assert candidate_links(spark.createDataFrame([], TEXT), 6).count() == 0
    assert candidate_links(spark.createDataFrame([(5, 6, bytes(24 * 8 * WIDTH))], TEXT), 6).count() == 0


@pytest.mark.parametrize("threshold", [Fraction(4, 5), Fraction(1, 2), Fraction(17, 20), Fraction(1)])
def test_least_similarity(threshold):
    for size in range(1, 60):
        found = [Fraction(c, u) for c in range(1, size + 1) for u in range(size, 2 * size + 2)
                 if (c, u) != (size, size) and Fraction(c, u) >= threshold]
        assert least_similarity(size, threshold) == min(found, default=None)


def test_texts_ascend_as_far_as_their_size_asks():
    eight = Fraction(4, 5)
    assert [depth_of(n, eight) for n in (1, 3, 4, 6, 7, 40, 10 ** 6)] == [None, None, 6, 7, 8, 6, 6]
    for size in range(4, 200):
        depth = depth_of(size, eight)
        assert 1 - (1 - float(least_similarity(size, eight)) ** depth) ** 24 >= 0.999
        assert depth >= prefix_length(0.8)


def test_recall_on_a_whole_table(spark):
    """Links of every document whose id is divisible by 100, against all documents of the table."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {r.doc_id: set(near_join.shingles((r.text or "").encode(), 5).tolist()) for r in docs.collect()}
    found = {r.id: r for r in near_join.similarity_classes(docs).collect()}
    assert len(found) == len(sets)
    wanted = reached = 0
    for doc in [d for d in sets if d % 100 == 0]:
        near = [o for o in sets if o != doc and sets[doc] and 5 * len(sets[doc] & sets[o]) >= 4 * len(sets[doc] | sets[o])]
        assert found[doc].n_links <= len(near)
        wanted, reached = wanted + len(near), reached + found[doc].n_links
        assert found[doc].n_links < len(near) or all(found[o].class_id == found[doc].class_id for o in near)
    assert reached >= 0.99 * wanted
