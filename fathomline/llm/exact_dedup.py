"""Exact duplicates by progressive refinement: length, then a hash of the first characters, then a hash of the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import BROADCAST_ROWS, landed, pick, small_or_shuffled

#: Bits of the slots that mark shared (length, prefix) pairs: 2**27 slots are 16 MB.
SLOT_BITS = 27

#: Runs of two or more, or one that isn't a plain space: replacing these alone by one space changes all that must change.
_WHITE_RUN = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalised(text: Column) -> Column:
    """Text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _WHITE_RUN, " ")


def _is_shared(rows: DataFrame, slot_bits: int) -> DataFrame:
    """`rows` with x_shared: false only where no other row has the same x_length and x_prefix.

    Pairs that several rows have set a bit of 2**slot_bits, in rows of 4 KB: at most 2**slot_bits / 8 bytes are broadcast, however
    large the corpus. Pairs that share a bit with such a pair are refined without need, which changes no result.
    """
    slot = F.pmod(F.xxhash64("x_length", "x_prefix"), F.lit(1 << slot_bits))
    pairs = pick(rows, {"x_length": "x_length", "x_prefix": "x_prefix"}).groupBy("x_length", "x_prefix").count()
    bits = landed(pairs.filter("count > 1").withColumn("slot", slot)
                  .groupBy(F.shiftright("slot", 15).alias("x_page"))
                  .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(32767)).alias("x_bits")), "shared-prefixes")
    byte = F.conv(F.hex(F.substring(
        F.col("x_bits"), (F.shiftright(F.col("x_slot").bitwiseAND(32767), 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.element_at(F.array(*(F.lit(1 << k) for k in range(8))), (F.col("x_slot") % 8 + 1).cast("int"))
    return (rows.withColumn("x_slot", slot).withColumn("x_page", F.shiftright("x_slot", 15))
            .join(F.broadcast(bits), "x_page", "left")
            .withColumn("x_shared", F.coalesce(byte.bitwiseAND(bit) > 0, F.lit(False)))
            .drop("x_bits", "x_slot", "x_page"))


def _refined(docs: DataFrame, id_column: str, text_column: str, digest_all: bool, carry: bool, prefix_chars: int,
             slot_bits: int) -> tuple[DataFrame, DataFrame]:
    """A written table of x_row, x_id, x_shared, x_sha (and the columns of `docs` as c0, c1, ...), and the groups of copies."""
    given = docs.columns
    rows = docs.toDF(*(f"c{i}" for i in range(len(given))))
    rows = rows.select(
        *(rows.columns if carry else []), F.col(f"c{given.index(id_column)}").alias("x_id"),
        normalised(F.col(f"c{given.index(text_column)}")).alias("x_text"))
    rows = rows.withColumns({
        "x_length": F.length("x_text"), "x_prefix": F.xxhash64(F.substring("x_text", 1, prefix_chars))})
    digest = F.sha2(F.encode("x_text", "UTF-8"), 256)
    refined = landed(
        _is_shared(rows, slot_bits).withColumn("x_row", F.monotonically_increasing_id())
        .withColumn("x_sha", digest if digest_all else F.when(F.col("x_shared"), digest))
        .drop("x_text", "x_prefix", "x_length"), "refined")
    order = F.struct(F.col("x_id").isNull(), "x_id", "x_row")
    groups = landed(refined.filter("x_shared").groupBy("x_sha").agg(F.count("*").alias("x_size"), F.min(order).alias("x_first"))
                    .filter("x_size > 1")
                    .select(F.col("x_sha"), "x_size", F.col("x_first.x_id").alias("x_keep"),
                            F.col("x_first.x_row").alias("x_keep_row")), "copy-groups")
    return refined, groups


def label_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest_all: bool = False,
                 prefix_chars: int = 64, broadcast_rows: int = BROADCAST_ROWS, slot_bits: int = SLOT_BITS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    1. One scan counts documents by (length, hash of the first characters) of the normalised text. Documents whose pair
       no other document has are unique and are done: their whole text is never hashed or compared.
    2. The whole text of the survivors is hashed (SHA-256) where it is read, and counted; equal digests are equal texts.

    Both counts are sums over keys that each task combines first, so a text with a third of all copies is one row of
    each task. Survivors are told by a broadcast of fixed size (_is_shared), so no text is shuffled at any size of the corpus. The
    labels meet survivors' ids and digests alone, by a broadcast of checked size or a sort-merge join whose hot keys Spark splits
    (the other side has one row a key); unique documents take no part in it.

    Of equal texts the smallest id stays, null ids last; of rows that also share the id, the first in the scan.
    Null texts are empty and equal to each other; `keep_id` is null only where every id of the group is null.
    `text_sha256` is null for unique documents unless `digest_all`. An empty table gives an empty result.
    """
    refined, groups = _refined(docs, id_column, text_column, digest_all, False, prefix_chars, slot_bits)
    met = refined.filter("x_shared").join(small_or_shuffled(groups, broadcast_rows), "x_sha", "left").select(
        F.col("x_id").alias("id"),
        F.when(F.col("x_size").isNull(), F.col("x_id")).otherwise(F.col("x_keep")).alias("keep_id"),
        F.coalesce("x_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("x_row") == F.col("x_keep_row"), F.lit(True)).alias("kept"),
        F.col("x_sha").alias("text_sha256"))
    unique = refined.filter("not x_shared").select(
        F.col("x_id").alias("id"), F.col("x_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("x_sha").alias("text_sha256"))
    return met.unionByName(unique)


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", prefix_chars: int = 64,
               broadcast_rows: int = BROADCAST_ROWS, slot_bits: int = SLOT_BITS) -> DataFrame:
    """The documents that stay, with the columns of `docs`; see label_copies.

    Copies are found on row numbers and digests. Whole rows are met once, by the numbers of those that go: a broadcast of checked
    size, or else a join on the number, in which no key is hot.
    """
    refined, groups = _refined(docs, id_column, text_column, False, True, prefix_chars, slot_bits)
    gone = landed(refined.filter("x_shared").select("x_sha", "x_row").join(small_or_shuffled(groups, broadcast_rows), "x_sha")
                  .filter("x_row <> x_keep_row").select("x_row"), "copies")
    return (refined.join(small_or_shuffled(gone, broadcast_rows), "x_row", "left_anti")
            .select(*(f"c{i}" for i in range(len(docs.columns)))).toDF(*docs.columns))
