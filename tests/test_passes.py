"""Steps that are repeated: rows dealt over the cores, term factors summed over parts a few directions at a time."""

import pytest

from fathomline import session
from fathomline.operators import chunking, latent, linear, retrieval, scenarios, trees


@pytest.fixture(scope="module")
def placed(spark):
    rows = spark.sql("SELECT id AS row_id, CAST(id % 3 AS INT) AS label, array(CAST(id % 7 AS DOUBLE), CAST(id % 11 AS DOUBLE)) AS features, "
                     "explode(array(id % 2 = 0)) AS is_test, 'd' AS dataset FROM range(0, 16500, 1, 1)")
    return scenarios.gather(rows, ["dataset"])


def test_repeated_passes_use_all_cores_however_few_bytes_the_rows_have(spark, placed):
    assert linear.matrix(placed).partitions == 8
    assert trees.matrix(placed).rows.rdd.getNumPartitions() == 8
    assert session.over_cores(spark.range(0, 500_000, 1, 1)).rdd.getNumPartitions() == 10
    assert session.over_cores(spark.range(100)).rdd.getNumPartitions() == 1
    assert session.over_cores(spark.range(0)).rdd.getNumPartitions() == 1


def test_latent_space_is_the_same_from_many_parts_in_small_steps(spark, monkeypatch):
    texts = [(f"d{k}", f"# Part {k % 3}\n" + " ".join(f"w{(k * j) % 13} own{k}" for j in range(1, 9))) for k in range(20)]
    chunks = chunking.chunk_documents(spark.createDataFrame([*texts, texts[4]], "doc string, text string"))
    queries = spark.createDataFrame([(0, "w3 w5 own7"), (1, "w1 own4"), (2, "zebra")], "query_id int, query string")
    found, shapes = [], []
    for few in (1_000_000, 1):
        monkeypatch.setattr(latent, "FEW_POSTINGS", few)
        if few == 1:
            monkeypatch.setattr(latent, "SUMMED_PAIRS", 20)
            monkeypatch.setattr(latent, "STEP_BYTES", 0)
        index = retrieval.tfidf_index(chunks)
        layout = latent.lay_out(index, 12)
        shapes.append((layout.parts, len(latent._groups(12, layout))))
        space = latent.fit_layout(layout, 2)
        hits = latent.space_search(queries, index, space, 30).collect()
        found.append((space.singular_values, {(r["query_id"], r["doc"], r["chunk_no"]): r["score"] for r in hits}))
        names = {r["term"] for r in space.terms_of(spark.createDataFrame([("w1",), ("own4",), ("zebra",)], "term string")).collect()}
        assert names == {"w1", "own4"}
    assert shapes[0] == (1, 1) and shapes[1][0] == 8 and shapes[1][1] > 1
    assert found[0][0] == pytest.approx(found[1][0], rel=1e-9)
    assert found[0][1].keys() == found[1][1].keys() and len(found[0][1]) > 10
    assert found[0][1] == pytest.approx(found[1][1], abs=1e-8)


def test_shuffles_are_freed_inside_only(spark):
    before = spark.conf.get(session.CLEANUP_SETTING, None)
    with session.freed_shuffles(spark):
        assert spark.conf.get(session.CLEANUP_SETTING) == "true"
    assert spark.conf.get(session.CLEANUP_SETTING, None) == before
