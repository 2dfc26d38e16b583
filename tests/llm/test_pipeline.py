"""Registered queries against their SQL twins, and each pipeline stage against brute force on what it was given."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from compare import connect, differences
from test_llm_operators import brute_classes, brute_contamination, brute_pii, brute_repeats, brute_secrets, check_packing, tokenizer  # noqa: F401

import corpus_pipeline
from fathomline.llm import language_id, registry
from fathomline.llm.common import landed


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_rows_as_sql(spark, small_tables, name):
    assert differences(spark, connect(small_tables), small_tables, registry.QUERIES[name], registry.ORACLE[name]) == []


@pytest.fixture(scope="module")
def texts(spark, small_tables):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{small_tables}/documents.parquet").collect()]


def test_queries_without_sql(spark, small_tables, texts):
    query = lambda name: registry.QUERIES[name](spark, small_tables).collect()
    assert sorted(tuple(r) for r in query("op3_suffix_dedup")) == [
        r[:5] for r in sorted(brute_repeats([(i, t.encode()) for i, t in texts], 400))]
    assert sorted(tuple(r) for r in query("op5_ngram_join")) == sorted(brute_classes(texts))
    personal, secret = {r.doc_id: r for r in query("op8_pii")}, {r.doc_id: r for r in query("op10_secret_scan")}
    for doc, text in texts:
        spans = ",".join(f"{k}:{a}:{b}" for k, found in brute_pii(text).items() for a, b in found)
        assert personal[doc].spans == spans
        kinds, found = brute_secrets(text)
        assert secret[doc].spans.startswith(",".join(f"{list(kinds)[k]}:{a}:{b}" for a, k, b in found))


def test_language_of_held_out_documents(spark, small_tables):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{small_tables}/documents.parquet").collect()}
    held_out = [r for r in registry.QUERIES["op1_language_id"](spark, small_tables).collect() if r.held_out]
    assert len(held_out) > 20
    assert sum(r.lang_pred == labels[r.doc_id] for r in held_out) >= 0.97 * len(held_out)


def test_stages(spark, small_tables, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{small_tables}/documents.parquet")
    benchmark = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{small_tables}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "ngram_join", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        after = landed(stage(spark, docs, small_tables), f"test-{name}")
        if name == "packing":
            ids = {i: (tokenizer.encode(t or "", add_special_tokens=False).ids + [1], 1) for i, t in rows}
            check_packing(after.collect(), ids, 2048)
            continue
        assert after.columns == docs.columns
        if name == "language_id":
            model = language_id.fit(docs)
            want = [i for i, t in rows if re.search(r"[^\W\d_]", t or "") and not model.predict([t.encode()])[0][2]]
            assert len(want) > 0.95 * len(rows)
        elif name == "exact_dedup":
            first: dict[str, int] = {}
            for i, t in rows:
                key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
                first[key] = min(i, first.get(key, i))
            want = list(first.values())
        elif name == "ngram_join":
            want = [r[0] for r in brute_classes(rows) if r[0] == r[1]]
        else:
            want = [r[0] for r in brute_contamination(rows, benchmark) if not r[2]]
        assert sorted(r.doc_id for r in after.collect()) == sorted(want)
        docs = after


ODD = "doc_id long, text string, lang string, row long, x_row int, c0 string, id string, x_text string, kept string, block int"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, small_tables, name, stage):
    """Null, empty, very long, repeated and tied rows, clashing column names, and no row at all."""
    words = " ".join(f"alpha{k} beta{k % 7}" for k in range(60))
    long_text = " ".join(f"word{k % 97} other{k % 89}" for k in range(40_000))
    rows = [(1, None, None), (2, "", "en"), (3, "   ", "en"), (4, words, "en"), (4, words, "en"), (None, words, None),
            (5, words.replace("alpha3 ", "gamma "), "en"), (6, long_text, "en"), (7, "¡¿ 123 --", "es"), (8, "éa", "fr")]
    extra = (7, 8, "nine", "ten", "own", "no", 3)
    docs = spark.createDataFrame([(*r, *extra) for r in rows], ODD).repartition(3)
    after = landed(stage(spark, docs, small_tables), f"odd-{name}")
    empty = landed(stage(spark, docs.limit(0), small_tables), f"none-{name}")
    assert empty.count() == 0 and empty.columns == after.columns
    if name == "packing":
        tokens = {r.doc_id: r.doc_tokens for r in after.collect()}
        assert set(tokens) == {r[0] for r in rows} and tokens[1] == tokens[2] == 1
        return
    assert after.columns == docs.columns
    found = after.collect()
    assert all(tuple(r)[3:] == extra for r in found)
    ids = Counter(r.doc_id for r in found)
    everything = Counter(r[0] for r in rows)
    if name == "language_id":
        assert not {1, 2, 3, 7} & set(ids) and {4, 6} <= set(ids)
    elif name == "exact_dedup":
        assert ids == Counter([1, 3, 4, 5, 6, 7, 8])
    elif name == "ngram_join":
        assert ids == Counter([1, 2, 3, 4, 6, 7, 8])
    else:
        assert ids == everything


def test_token_queries_against_the_tokenizer(spark, small_tables, texts, tokenizer):  # noqa: F811
    encoded = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts}
    check_packing(registry.QUERIES["op7_packing"](spark, small_tables).collect(),
                  {i: (ids + [1], 1) for i, ids in encoded.items()}, 2048)
    name = next(n for n in registry.QUERIES if n.startswith("op4_"))
    lengths = sorted(len(ids) for ids in encoded.values())
    rows = sorted(registry.QUERIES[name](spark, small_tables).collect(), key=lambda r: r.n_tokens)
    assert [(r.n_tokens, r.n_docs) for r in rows] == sorted(Counter(lengths).items())
    for r in rows:
        shorter, longer = [n for n in lengths if n <= r.n_tokens], [n for n in lengths if n > r.n_tokens]
        assert (r.docs_at_most, r.tokens_at_most, r.docs_longer, r.tokens_longer) == (
            len(shorter), sum(shorter), len(longer), sum(longer))
        assert r.truncated_total == sum(min(n, r.n_tokens) for n in lengths)
        assert r.tokens_lost == sum(lengths) - r.truncated_total
