"""Tokens and Markdown chunks: hand-written cases."""

import pytest
from pyspark.sql import functions as F

from fathomline.functions.text import lines_with_ends, tokenize
from fathomline.operators import chunking

LONG = "x" * 50


def chunks_of(spark, text, **options):
    docs = spark.createDataFrame([("d.md", text)], "doc string, text string")
    rows = chunking.chunk_documents(docs, **options).orderBy("chunk_no").collect()
    assert [r["chunk_no"] for r in rows] == list(range(len(rows)))
    return [(r["section"], r["text"]) for r in rows]


@pytest.mark.parametrize("text, plain, words", [
    ("LRU-Cache v2.0!", ["lru", "cache", "v2", "0"], ["lru", "cache", "v2", "0"]),
    ("Élan vital", ["lan", "vital"], ["élan", "vital"]),
    ("缓存怎么LRU实现", ["缓存", "存怎", "怎么", "lru", "实现"], ["缓存", "存怎", "怎么", "lru", "实现"]),
    ("中 a", ["a"], ["a"]),
    ("", [], []),
])
def test_tokens(spark, text, plain, words):
    row = spark.createDataFrame([(text,)], "t string").select(
        tokenize(F.col("t")).alias("a"), tokenize(F.col("t"), unicode_words=True).alias("b")).first()
    assert (row["a"], row["b"]) == (plain, words)


def test_document_without_heading_is_one_preamble(spark):
    assert chunks_of(spark, f"  {LONG}\nmore \n") == [("d.md · 简介", f"d.md\n{LONG}\nmore")]


def test_preamble_is_not_split_but_sections_are(spark):
    paragraphs = "\n\n".join(["y" * 500] * 4)
    found = chunks_of(spark, f"{paragraphs}\n# T\n{paragraphs}")
    assert found[0] == ("T · 简介", f"T\n{paragraphs}")
    assert found[1] == ("T", "T\n" + "\n\n".join(["y" * 500] * 2))
    assert found[2] == ("T", "\n\n".join(["y" * 500] * 2))


def test_paths_skip_levels_and_empty_bodies(spark):
    text = f"# A\n### B\n{LONG}\n## C\n\n#### D\n{LONG}\n# E\n##### no heading {LONG}\n## F\n{LONG}"
    assert [s for s, _ in chunks_of(spark, text)] == ["A · B", "A · C · D", "E", "E · F"]


def test_sibling_after_deeper_level(spark):
    text = f"### deep\n{LONG}\n## mid\n{LONG}\n### again\n{LONG}\n# top\n{LONG}"
    assert [s for s, _ in chunks_of(spark, text)] == ["deep", "mid", "mid · again", "top"]


def test_tags_are_removed_across_lines(spark):
    assert chunks_of(spark, f"# T <img\nsrc='x'>\n{LONG}") == [("T", f"T\n{LONG}")]


def test_comment_in_code_counts_as_heading_unless_fences_are_skipped(spark):
    text = f"# T\n{LONG}\n```\n# note\n{LONG}\n```\n"
    assert [s for s, _ in chunks_of(spark, text)] == ["T", "note"]
    assert [s for s, _ in chunks_of(spark, text, skip_fences=True)] == ["T"]


def test_one_long_paragraph_stays_whole(spark):
    assert chunks_of(spark, "# T\n" + "z" * 3000) == [("T", "T\n" + "z" * 3000)]


def test_short_pieces_are_dropped(spark):
    body = "a" * 1194 + "\n\n" + "short"
    assert chunks_of(spark, f"# T\n{body}") == [("T", "T\n" + "a" * 1194)]


def test_fallback_takes_whole_paragraphs(spark):
    text = "# one\nshort\n# two\nshort text\n\n# three\nalso a short text here too\n# four\nb\n"
    assert chunks_of(spark, text) == [("（全文）", "# three\nalso a short text here too\n# four\nb")]
    assert chunks_of(spark, "# T\nx") == []


def test_titles_are_stripped(spark):
    assert chunks_of(spark, f"intro {LONG}\n#  Title  \nb")[0] == ("Title · 简介", f"Title\nintro {LONG}")


def test_label(spark):
    docs = spark.createDataFrame([("d.md", LONG)], "doc string, text string")
    assert chunking.with_label(chunking.chunk_documents(docs)).first()["label"] == "d.md · d.md · 简介"


def test_lines_are_split_at_their_ends(spark):
    text = "a\n\nb\r\nc\r\r\nd\x0b\u2028e\x85f"
    lines = lines_with_ends(F.col("t")).alias("lines")
    rows = spark.createDataFrame([(text,), ("",), ("x\n",), (None,)], "t string").select(lines).collect()
    assert [r["lines"] for r in rows] == [["a\n", "\n", "b\r\n", "c\r", "\r\n", "d\x0b", "\u2028", "e\x85", "f"], [], ["x\n"], None]
    assert "regexp_extract_all" not in str(lines)  # which tried each character of a line against all ends
