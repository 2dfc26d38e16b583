"""The refreshed store of responses, the index kept in files, the byte-order mark and searches given as functions."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from fathomline.operators import retrieval, stored_index
from fathomline.sources import files, landing

PAGES = "url string, fetched_at long, payload string"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("url", "fetched_at", "payload").collect()), key=repr)


def test_batches_and_replays_give_the_newest_responses(spark, tmp_path):
    store = f"file://{tmp_path}/store"
    first = spark.createDataFrame([(f"u{k}", k % 5, f"first {k}") for k in range(40)] + [("u1", 0, "old")], PAGES)
    second = spark.createDataFrame([(f"u{k}", 3, f"second {k}") for k in range(0, 50, 5)] + [(None, 1, "no address")], PAGES)
    with pytest.raises(ValueError):
        landing.read_store(spark, store)
    landing.merge_batch(first.limit(0), store)
    for batch in (first, second, first, second):
        landing.merge_batch(batch, store)
    expected = rows_of(landing.stored_payloads(first.unionByName(second)))
    assert rows_of(landing.read_store(spark, store)) == expected
    kept = f"file://{tmp_path}/kept"
    for batch in (first, second):
        landing.merge_batch(batch, kept, refresh=False)
    assert rows_of(landing.read_store(spark, kept)) == rows_of(landing.stored_payloads(first.unionByName(second), refresh=False))


def test_a_batch_writes_only_the_parts_that_it_touches(spark, tmp_path):
    store = f"{tmp_path}/store"
    landing.merge_batch(spark.range(300).select(F.concat(F.lit("u"), "id").alias("url"), F.lit(1).alias("fetched_at"), F.lit("x").alias("payload")), store)
    landing.merge_batch(spark.createDataFrame([("u7", 2, "y")], PAGES), store)
    folders = sorted(glob.glob(f"{store}/parts/*"), key=lambda f: len(glob.glob(f"{f}/prefix=*")))
    assert len(glob.glob(f"{folders[0]}/prefix=*")) == 1 and len(glob.glob(f"{folders[1]}/prefix=*")) > 100
    # Files of a batch that never reached the catalogue have no effect.
    before = rows_of(landing.read_store(spark, store))
    spark.createDataFrame([("u8", 9, "lost", "ab")], PAGES + ", prefix string").write.partitionBy("prefix").parquet(f"{store}/parts/failed")
    assert rows_of(landing.read_store(spark, store)) == before and ("u7", 2, "y") in before and len(before) == 300


def chunk_rows(spark, ids):
    words = ["river", "stone", "quiet", "light", "common"]
    return spark.createDataFrame([(f"d{k:02d}", 0, f"part {words[k % 4]}", " ".join([words[k % 4]] * (k % 3 + 1) + ["common"] + [f"w{k}"])) for k in ids],
                                 "doc string, chunk_no int, section string, text string")


def test_an_index_grown_by_batches_scores_like_one_built_at_once(spark, tmp_path):
    path = f"{tmp_path}/index"
    queries = spark.createDataFrame([(1, "quiet river"), (2, "common w7 w31"), (3, "nothing here")], "query_id int, query string")
    every = range(40)
    with pytest.raises(ValueError):
        stored_index.open_index(spark, path)
    assert stored_index.append(chunk_rows(spark, every[:13]), path, "a")
    opened = stored_index.open_index(spark, path)
    assert stored_index.append(chunk_rows(spark, every[13:]), path, "b")
    assert not stored_index.append(chunk_rows(spark, every[:13]), path, "a")
    whole = retrieval.build_index(chunk_rows(spark, every))

    def hits(index):
        return sorted((r["query_id"], r["doc"], r["rank"], round(r["score"], 9)) for r in retrieval.bm25_search(queries, index, 6).collect())

    index = stored_index.open_index(spark, path)
    assert hits(index) == hits(whole) and len(hits(whole)) > 8
    assert {h[1] for h in hits(opened)} <= {f"d{k:02d}" for k in every[:13]}
    assert index.chunks.count() == 40
    plan = index.relevant(queries.select(F.explode(F.split("query", " ")).alias("term")).distinct())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1][:80]


def test_csv_files_begin_with_the_mark(spark, tmp_path):
    rows = spark.createDataFrame([("é", 1.5)], "city string, pm25 double").coalesce(1)
    for mark in (True, False):
        files.write_csv(rows, f"{tmp_path}/{mark}", mark)
        with open(glob.glob(f"{tmp_path}/{mark}/*.csv")[0], "rb") as file:
            data = file.read()
        assert data == (b"\xef\xbb\xbf" if mark else b"") + "city,pm25\né,1.5\n".encode()
        assert [tuple(r) for r in files.read_csv(spark, f"{tmp_path}/{mark}", "city string, pm25 double").collect()] == [("é", 1.5)]


def test_searches_are_functions_of_queries_and_chunks(spark):
    chunks = chunk_rows(spark, range(12))
    cases = spark.createDataFrame([(1, "river", ["d00"], "river"), (2, "w5", ["d05"], "w5")],
                                  "query_id int, query string, relevant_docs array<string>, keyword string")
    queries = cases.select("query_id", "query")
    first = lambda asked, given: asked.crossJoin(given.orderBy("doc").limit(1)).select("query_id", "doc", "chunk_no", F.lit(1).alias("rank"))
    found = {r["method"]: (r["recall"], r["mrr"]) for r in retrieval.evaluate_searches(
        {"BM25": retrieval.bm25(12), "TF-IDF": retrieval.tfidf(12), "first": first}, queries, chunks, cases).collect()}
    assert found["first"] == (0.5, 0.5) and found["BM25"][0] == found["TF-IDF"][0] == 1.0
