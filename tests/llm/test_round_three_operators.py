"""Whitening, passage classifier and alignment against brute force, and their defined results for odd input."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from fathomline.llm import alignment, quality, queries, whitening

VECTOR = "vec_id long, embedding array<float>"
DOC = "doc_id long, text string"


# ---------------------------------------------------------------- 11 whitening


def brute_whitening(rows):
    """id -> (deviation, whitened), shares and rows of the contract, by an eigendecomposition."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(np.float64(np.float32(c)) * 1024)) + 100_000 for c in v] for _, v in good], object)
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    centred = (apart / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:8]
    return ([i for i, _ in good], [int((a * a).sum()) for a in apart], centred @ vectors[:, order] / np.sqrt(values[order]),
            values[order] / values.sum())


def whitened(spark, rows, schema=VECTOR):
    kept = whitening.usable_rows(spark.createDataFrame(rows, schema).repartition(3))
    model = whitening.fit(kept)
    return model, whitening.transform(kept, model).orderBy("id").collect()


def test_whitening_equals_an_eigendecomposition(spark):
    draw = np.random.default_rng(5)
    mixed = draw.normal(size=(400, 12)) @ draw.normal(size=(12, 12)) * np.logspace(0, -3, 12)
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(mixed)]
    rows += [(400 + k, rows[0][1]) for k in range(200)]
    odd = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, []), (905, [1.0])]
    model, found = whitened(spark, rows + odd)
    ids, deviations, expected, shares = brute_whitening(rows)
    assert [r.id for r in found] == ids and [r.deviation for r in found] == deviations and {r.n for r in found} == {600}
    ours = np.array([r.whitened for r in found])
    signs = np.sign((ours * expected).sum(axis=0))
    assert np.abs(ours * signs - expected).max() < 1e-8
    assert np.allclose(model.explained, shares, rtol=1e-9) and model.identity_error < 1e-9


def test_whitening_of_dependent_columns_keeps_only_what_varies(spark):
    draw = np.random.default_rng(2)
    rows = [(k, [float(a), float(b), float(a + b), 3.0]) for k, (a, b) in enumerate(draw.integers(-50, 50, size=(80, 2)))]
    model, found = whitened(spark, rows)
    assert (model.variances > 0).tolist() == [True, True, False, False] and model.identity_error < 1e-9
    assert all([w is None for w in r.whitened] == [False, False, True, True] for r in found)
    assert np.isclose(model.explained.sum(), 1)


def test_whitening_of_odd_tables(spark):
    kept = whitening.usable_rows(spark.createDataFrame([], VECTOR))
    assert whitening.transform(kept, whitening.fit(kept)).count() == 0
    same = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])]
    model, found = whitened(spark, [(*r, 7, "x", 3) for r in same], VECTOR + ", id int, x string, n int")
    assert [(r.id, r.n, r.deviation, r.whitened) for r in found] == [(None, 3, 0, [None, None]), (1, 3, 0, [None, None]), (1, 3, 0, [None, None])]
    assert model.identity_error is None
    _, huge = whitened(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 5.0])])
    assert [r.deviation for r in huge] == [None, None, (3 * 5120 - 8192) ** 2] and all(r.whitened[0] is not None for r in huge)


def test_whitening_query_on_driver_rows(spark, small_tables):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small_tables}/embeddings.parquet").orderBy("vec_id").collect()]
    ids, deviations, expected, shares = brute_whitening(rows)
    found = queries.op11_whitening(spark, small_tables).orderBy("vec_id", "component").collect()
    assert [r.vec_id for r in found[::8]] == ids and [r.deviation for r in found[::8]] == deviations
    ours = np.array([r.whitened for r in found]).reshape(-1, 8)
    assert np.abs(ours * np.sign((ours * expected).sum(axis=0)) - expected).max() < 1e-8
    assert np.allclose([r.explained for r in found[:8]], shares, rtol=1e-8)
    assert all(r.identity_error < 1e-8 for r in found)


# ---------------------------------------------------------------- 13 alignment


def brute_alignment(texts):
    """One tuple per text: n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet = alignment._byte_alphabet()
    kept = []
    for text in texts:
        links, groups, a, b = Counter(), [], [], []
        if text:
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = second.encode(text)
            spelt_a = [bytes(alphabet[c] for c in first.id_to_token(i)) for i in a]
            spelt_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
                       for i in b for p in [second.id_to_piece(i)]]
            if b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
                ends = [np.cumsum([len(s) for s in side]).tolist() for side in (spelt_a, spelt_b)]
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    begin = groups[-1][2] if groups else 0
                    groups.append(([i for i, e in zip(a, ends[0]) if begin < e <= cut],
                                   [i for i, e in zip(b, ends[1]) if begin < e <= cut], cut))
                for left, right, _ in groups:
                    links.update((i, j) for i in left for j in right)
            else:
                a, b = [], []
        kept.append((a, b, groups, links))
    counts = Counter(pair for _, _, _, links in kept for pair in links)
    tops = defaultdict(int)
    for (a, _), n in counts.items():
        tops[a] = max(tops[a], n)
    rows = []
    for a, b, groups, links in kept:
        spelt = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right, _ in groups)
        rows.append((len(a), len(b), len(groups), sum(links.values()),
                     sum(n for pair, n in links.items() if counts[pair] == tops[pair[0]]),
                     sum(n * counts[pair] for pair, n in links.items()),
                     hashlib.sha256(spelt.encode()).hexdigest() if groups else ""))
    return rows


ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("most", [0, 20, 1 << 17])
def test_alignment_equals_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 64)
    monkeypatch.setattr(alignment, "LONG_GROUP", 4)
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 100)
    rng = random.Random(4)
    texts = [None, "", " ", "▁x", "a▁", "<|endoftext|> </s>", "hello\x00 world", "日本語のテキスト 🤗🤗", "aaaa" * 2000, "  two  spaces ", "café ½"]
    texts += ["".join(rng.choices("ab 日é\n\t🤗.,", k=rng.randrange(60))) for _ in range(60)]
    texts += ["the same words"] * 40
    rows = spark.createDataFrame([(k if k % 7 else None, t, 1, "x", 2) for k, t in enumerate(texts)],
                                 DOC + ", row int, pairs string, id int")
    aligned = alignment.aligned_documents(rows.coalesce(1), batch_text=300)
    found = alignment.link_scores(aligned, alignment.pair_counts(aligned), most)
    ours = sorted(tuple(r[c] for c in ALIGNED) for r in found.collect())
    assert ours == sorted(brute_alignment(texts))
    assert found.columns == ["id", *ALIGNED]


def test_alignment_of_an_empty_table(spark):
    aligned = alignment.aligned_documents(spark.createDataFrame([], DOC))
    assert alignment.link_scores(aligned, alignment.pair_counts(aligned)).count() == 0


def test_group_strings():
    found = alignment.align(["unbelievable", None], alignment.sides(alignment.default_vocabulary(), alignment.default_model()), True)
    spelt = found["groups"].to_pylist()
    assert spelt[1] == "" and hashlib.sha256(spelt[0].encode()).hexdigest() == found["groups_sha256"][0].as_py()
    assert spelt[0].count(";") + 1 == found["n_groups"][0].as_py()


def test_alignment_query_on_driver_rows(spark, small_tables):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{small_tables}/documents.parquet' ORDER BY doc_id").fetchall()
    expected = dict(zip([i for i, _ in rows], brute_alignment([t for _, t in rows])))
    found = {r.doc_id: tuple(r[c] for c in ALIGNED) for r in queries.op13_alignment(spark, small_tables).collect()}
    assert found == expected


# ---------------------------------------------------------------- 12 quality


def test_gradient_equals_differences():
    draw = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) * 0.5 for k, v in quality._start().items()}
    rows, owner = draw.random((9, quality.WIDTH)) * 0.1, np.array([0, 0, 0, 1, 1, 2, 2, 2, 2])
    label, weight = np.array([1.0, 0.0, 0.3]), np.array([1.0, 2.0, 1.0])

    def loss(p):
        y = quality._forward(p, rows, owner, 3)[-1]
        return -(weight * (label * np.log(y) + (1 - label) * np.log(1 - y))).sum() / weight.sum()

    found = quality.gradient(weights, rows, owner, label, weight)
    for name in weights:
        at = np.unravel_index(3 % weights[name].size, weights[name].shape)
        sides = []
        for step in (1e-6, -1e-6):
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += step
            sides.append(loss(moved))
        assert found[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-6, rel=1e-4, abs=1e-9)


def test_passages_of_a_batch_are_those_of_each_text(monkeypatch):
    rng = random.Random(8)
    texts = [None, "", "  ", "\n one", "ÉA é 1!? a a a", "x" * 500, " ".join(rng.choices(["a", "bb", "C.", "!!"], k=300)), "end "]

    def alone(text):
        (_, _, rows, owner), = quality.bags(pa.array([text.encode() if text else None], pa.binary()))
        assert (owner == 0).all()
        return rows

    each = [alone(t) for t in texts]
    assert [len(r) for r in each] == [1, 1, 1, 1, 1, 1, 5, 1]
    assert not each[0].any() and not each[2].any()
    whole = pa.array(["cut"] + texts, pa.string()).cast(pa.binary())[1:]
    for most in (1 << 21, 40):
        monkeypatch.setattr(quality, "BATCH_BYTES", most)
        found = [rows[owner == k] for _, end, rows, owner in quality.bags(whole) for k in range(owner.max() + 1)]
        assert all(np.allclose(a, b) for a, b in zip(found, each)) and len(found) == len(each)
    monkeypatch.setattr(quality, "PIECE_BYTES", 100)
    (_, _, rows, owner), = quality.bags(pa.array([texts[6].encode()], pa.binary()))
    assert len(rows) > 5 and (owner == 0).all()


def test_quality_attends_to_the_bad_passage(spark):
    rng = random.Random(3)
    good = lambda n: " ".join(rng.choices(["the", "quiet", "river", "runs", "to", "sea,", "and", "on."], k=n))
    bad = lambda n: " ".join(rng.choices(["CLICK!!", "$$$", "WIN!!", "###"], k=n))
    rows, labels = [], []
    for k in range(300):
        label = k % 2
        parts = [good(64) for _ in range(4)]
        if not label:
            parts[rng.randrange(4)] = bad(64)
        rows.append((k, " ".join(parts)))
        labels.append((k, float(label), 1))
    rows += [(None, "free text"), (7, "a second row of one id"), (901, None), (902, "")]
    labels += [(5, None, 0), (None, 1.0, 0), (901, 1.0, 0), (6, 0.0, 5), (950, 1.0, 5), (951, float("nan"), 5)]
    schema = DOC + ", id int, label string, weight int"
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], schema).repartition(3)
    model = quality.fit(docs.filter("doc_id is null or doc_id < 240 or doc_id > 900"),
                        spark.createDataFrame(labels, "doc_id long, quality double, id int"))
    found = defaultdict(list)
    for r in quality.score_documents(docs, model).collect():
        found[r.id].append(r)
    assert sum(len(v) for v in found.values()) == len(rows) and len(found[7]) == 2
    right = [(found[k][0].score >= 0.5) == bool(k % 2) for k in range(240, 300)]
    assert np.mean(right) > 0.95 and all(found[k][0].n_passages == 4 for k in range(240, 300))
    assert all(0 <= r.score <= 1 for v in found.values() for r in v)
    # The gate, learnt from labels of documents alone, looks at the bad passage.
    text = " ".join([good(64), good(64), bad(64), good(64)])
    (_, _, features, owner), = quality.bags(pa.array([text.encode()], pa.binary()))
    assert quality._forward(model.weights, features, owner, 1)[3].argmax() == 2


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "abc"), (2, None)], DOC)
    model = quality.fit(docs, none)
    assert [r.score for r in quality.score_documents(docs, model).collect()] == [0.5, 0.5]
    empty = spark.createDataFrame([], DOC)
    assert quality.fit(empty, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).score(None, None, 2).tolist() == [1.0, 1.0]
    assert quality.score_documents(empty, model).count() == 0


def test_quality_query_predicts_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.op12_quality(spark, folder)
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = rows.join(labels, "doc_id").filter("held_out").collect()
    assert {r.held_out for r in held} == {True} and len(held) > 40
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    assert all(r.predicted == int(r.score >= 0.3) for r in held)
    assert all(r.predicted == 1 for r in held if r.quality == 1)
