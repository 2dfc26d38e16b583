"""Alignment of the tokens of two tokenizers, as Arrow tables inside the tasks and sums of counts by Spark.

Tokenizer A is a byte-level BPE file of the tokenizers library and reads a space and the text; tokenizer B is a
sentencepiece model, which adds the space itself. Both spell the same bytes, so the places where a token of each ends
cut a text into groups. Within a batch of documents all tokens are one flat column with parent indices: ends are
cumulative sums, common ends a hash join of (document, end), and linked id pairs grouped counts.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed, pick
from fathomline.llm.tokens import _BESIDE, _SINGLE, _Words, _byte_alphabet, default_vocabulary, encoder

#: Bytes of text whose tokens are one Arrow table.
BATCH_TEXT = 1 << 19
#: Links that are spelt out at a time, and pairs that a task counts before it hands them on.
LINKS_AT_ONCE, PAIRS_AT_ONCE = 1 << 20, 1 << 21
#: The pairs that most documents hold are sent to every executor: at most so many, of 17 bytes each.
FREQUENT_PAIRS = 1 << 17

#: Links of a group from which equal ids are counted before they are spelt out.
LONG_GROUP = 256
#: Bits of an id of B and of a pair in a key, and of an offset in a document. Documents of a batch are the bits above.
_B_BITS, _PAIR_BITS, _END_BITS = 20, 40, 40


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class _Side:
    """ids(text): little-endian unsigned 32-bit ids of a text; spelt[id]: bytes of a token; lengths[id]: their number."""

    def __init__(self, spelt: list[bytes]):
        if len(spelt) > 1 << _B_BITS:
            raise ValueError(f"a vocabulary of more than {1 << _B_BITS} entries")
        self.spelt, self.lengths = pa.array(spelt, pa.binary()), np.array([len(s) for s in spelt], np.int64)


class ByteSide(_Side):
    """A byte-level BPE file on a space and the text. Strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        self.encoder = encoder(path)
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        alphabet, entries = _byte_alphabet(), known["model"]["vocab"] | {t["content"]: t["id"] for t in known.get("added_tokens") or []}
        spelt = [b""] * (max(entries.values()) + 1)
        for token, at in entries.items():
            # An added token need not be written in the byte alphabet; it never occurs here.
            spelt[at] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else b""
        super().__init__(spelt)

    def ids(self, text: str) -> bytes:
        text = " " + text
        if self.encoder.words is None:
            self.encoder.tokenizer.encode_special_tokens = True
            return np.array(self.encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        parts = _SINGLE.split(text) if _BESIDE.search(text) or text[-1] == " " else text.split(" ")
        return np.array(self.encoder.whole(parts[0]), "<u4").tobytes() + b"".join(
            map(self.encoder.words.__getitem__, parts[1:]))


class PieceSide(_Side):
    """A sentencepiece model on the text. No piece goes on over a space, so words with the spaces before them are encoded once."""

    _PARTS = re.compile(r" +[^ ]+| +$")

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelt = []
        for at in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(at)
            spelt.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(at)
                         else b"" if self.model.is_control(at) or self.model.is_unknown(at)
                         else piece.replace("▁", " ").encode())
        super().__init__(spelt)
        self.by_word = not any(b" " in s.lstrip(b" ") for s in spelt)
        space = self.model.piece_to_id("▁")
        # The cache hands on the word after one more space; the model adds the first space of a word by itself.
        self.words = _Words(lambda word: self.model.encode(word[2:], num_threads=1) if len(word) > 2 else [space])

    def ids(self, text: str) -> bytes:
        if not self.by_word or "▁" in text:
            return np.array(self.model.encode(text, num_threads=1), "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, self._PARTS.findall(" " + text)))


@functools.lru_cache(maxsize=2)
def sides(vocabulary: str, model: str) -> tuple[ByteSide, PieceSide]:
    """One pair of tokenizers per worker process and files."""
    return ByteSide(vocabulary), PieceSide(model)


def _token_lists(texts: list[str], side: _Side) -> pa.ListArray:
    ids = [np.frombuffer(side.ids(t), "<u4").astype(np.int32) if t else np.zeros(0, np.int32) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def _spell_the_text(texts: list[str], lists: pa.ListArray, side: _Side) -> np.ndarray:
    """Whether the joined bytes of the tokens of each text are a space and the text."""
    whole = [b" " + t.encode() if t else b"" for t in texts]
    sizes = np.array([len(w) for w in whole], np.int64)
    ends = np.concatenate([[0], np.cumsum(side.lengths[lists.values.to_numpy()])])[lists.offsets.to_numpy()]
    good = np.diff(ends) == sizes
    flat = pc.take(side.spelt, lists.values)
    spelt = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[:ends[-1]]
    if not good.all():
        spelt = spelt[np.repeat(good, np.diff(ends))]
    expected = np.frombuffer(b"".join([w for w, same in zip(whole, good.tolist()) if same]), np.uint8)
    apart = np.flatnonzero(spelt != expected)
    of = np.searchsorted(np.cumsum(sizes[good]), apart, "right")
    good[np.flatnonzero(good)[np.unique(of)]] = False
    return good & (sizes > 0)


def _flat(lists: pa.ListArray, side: _Side) -> pa.Table:
    """doc, id, key, at: all tokens, the document and byte offset where they end as one key, and their place in the table."""
    ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ends = pc.cumulative_sum(pc.take(pa.array(side.lengths), ids))
    # A segmented sum: what all earlier documents have is taken off.
    before = np.concatenate([[0], ends.to_numpy(zero_copy_only=False)])[lists.offsets.to_numpy()[:-1]]
    docs = parents.to_numpy().astype(np.int64)
    ends = ends.to_numpy(zero_copy_only=False) - before[docs]
    return pa.table({"doc": docs, "id": ids, "key": docs << _END_BITS | ends, "at": np.arange(len(docs))})


def _groups(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document of every group in order, and the group of every token of both tables."""
    common = a.select(["key", "at"]).join(b.select(["key", "at"]), "key", join_type="inner", right_suffix="_b", use_threads=False)
    cuts = []
    for table, name in ((a, "at"), (b, "at_b")):
        last = np.zeros(table.num_rows, np.int64)
        last[common[name].to_numpy()] = 1
        cuts.append(last)
    return a["doc"].to_numpy()[cuts[0] > 0], *(np.cumsum(last) - last for last in cuts)


def _joined(ids: pa.Array, groups: np.ndarray, count: int) -> pa.Array:
    """Decimal ids of every group, comma-joined."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(groups, minlength=count))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pc.cast(ids, pa.string())), ",")


def _spelt_out(left: tuple, right: tuple, docs: np.ndarray) -> pa.Table:
    """key, times: links of the groups of two (group, id, times) sides, by document and pair; right is in order of group."""
    group, ids, times = left
    first, last = (np.searchsorted(right[0], group, way) for way in ("left", "right"))
    width = last - first
    total = np.cumsum(width)
    cuts = np.unique(np.searchsorted(total, np.arange(0, total[-1] if len(total) else 0, LINKS_AT_ONCE), "right"))
    parts = []
    for begin, end in zip(cuts, [*cuts[1:], len(width)]):
        own = width[begin:end]
        mine = np.repeat(np.arange(begin, end), own)
        theirs = np.arange(len(mine)) + np.repeat(first[begin:end] - np.cumsum(own) + own, own)
        key = docs[group[mine]] << _PAIR_BITS | ids[mine].astype(np.int64) << _B_BITS | right[1][theirs]
        part = pa.table({"key": key, "times": times[mine] * right[2][theirs]})
        parts.append(part.group_by("key", use_threads=False).aggregate([("times", "sum")]).rename_columns(["key", "times"]))
    return pa.concat_tables(parts) if parts else pa.table({"key": np.zeros(0, np.int64), "times": np.zeros(0, np.int64)})


def _linked(a: pa.Table, b: pa.Table, group_a: np.ndarray, group_b: np.ndarray, docs: np.ndarray) -> pa.Table:
    """key, times: linked ids of every document in order, with their occurrences.

    Links of short groups are spelt out as they are. Equal ids of a long group are counted first, so it costs its
    distinct ids. Both in blocks of whole tokens of A.
    """
    per_a, per_b = (np.bincount(g, minlength=len(docs)) for g in (group_a, group_b))
    long_group = per_a * per_b > LONG_GROUP
    every = []
    for table, groups in ((a, group_a), (b, group_b)):
        ids, counted = table["id"].to_numpy(), long_group[groups]
        own = pa.table({"group": groups[counted], "id": ids[counted], "one": np.ones(int(counted.sum()), np.int64)})
        own = own.group_by(["group", "id"], use_threads=False).aggregate([("one", "sum")]).sort_by("group")
        plain = ~counted
        every.append(((groups[plain], ids[plain], np.ones(int(plain.sum()), np.int64)),
                      tuple(c.to_numpy() for c in own.columns)))
    parts = pa.concat_tables([_spelt_out(left, right, docs) for left, right in zip(*every) if len(left[0])] or [
        _spelt_out(*(x[0] for x in every), docs)])
    if parts["key"].num_chunks < 2:
        return parts.sort_by("key")
    # Parts of different groups can hold the same pair of a document.
    merged = parts.group_by("key", use_threads=False).aggregate([("times", "sum")]).rename_columns(["key", "times"])
    return merged.sort_by("key")


def align(texts: list[str | None], of: tuple[_Side, _Side], with_groups: bool = False) -> dict[str, pa.Array]:
    """Counts, group digest and linked pairs of every text; see `aligned_documents`. With the group strings on demand."""
    texts = [t or "" for t in texts]
    lists = [_token_lists(texts, side) for side in of]
    good = np.logical_and(*(_spell_the_text(texts, tokens, side) for tokens, side in zip(lists, of)))
    if not good.all():
        left = [t if same else "" for t, same in zip(texts, good.tolist())]
        lists = [_token_lists(left, side) for side in of]
    a, b = (_flat(tokens, side) for tokens, side in zip(lists, of))
    docs, group_a, group_b = _groups(a, b)
    n, count = len(texts), len(docs)
    per_a, per_b = (np.bincount(g, minlength=count) for g in (group_a, group_b))
    group_offsets = pa.array(np.searchsorted(docs, np.arange(n + 1)), pa.int32())
    strings = pc.binary_join_element_wise(*(
        _joined(t["id"].combine_chunks(), g, count) for t, g in ((a, group_a), (b, group_b))), "|")
    by_doc = pc.binary_join(pa.ListArray.from_arrays(group_offsets, strings), ";").to_pylist()
    linked = _linked(a, b, group_a, group_b, docs)
    keys = linked["key"].to_numpy()
    pair_offsets = pa.array(np.searchsorted(keys, np.arange(n + 1) << _PAIR_BITS), pa.int32())
    found = {
        "n_a": pc.cast(pc.list_value_length(lists[0]), pa.int64()),
        "n_b": pc.cast(pc.list_value_length(lists[1]), pa.int64()),
        "n_groups": pa.array(np.bincount(docs, minlength=n).astype(np.int64)[:n]),
        "n_links": pa.array(np.add.reduceat(np.append(per_a * per_b, 0), np.minimum(group_offsets.to_numpy()[:-1], count))
                            * (np.diff(group_offsets.to_numpy()) > 0)),
        "groups_sha256": pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in by_doc], pa.string()),
        "pairs": pa.ListArray.from_arrays(pair_offsets, pa.array(keys & ((1 << _PAIR_BITS) - 1))),
        "times": pa.ListArray.from_arrays(pair_offsets, linked["times"].combine_chunks())}
    return found | ({"groups": pa.array(by_doc, pa.string())} if with_groups else {})


_FIELDS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def _slices(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of texts of at most `most` bytes together; a longer text is alone."""
    begin, total = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield slice(begin, at)
            begin, total = at, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def aligned_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None,
                      model: str | None = None, batch_text: int = BATCH_TEXT) -> DataFrame:
    """One landed row per document: row (its number), id, counts of tokens, groups and links, the digest of the groups,
    and its distinct linked id pairs with their occurrences.

    The digest is the SHA-256 of `a1,a2|b1;a3|b2,b3`. Texts that are null or empty, or that either tokenizer does not spell
    byte for byte, have no tokens: zeros, no pairs and an empty digest. Repeated rows and null ids each get their row.
    Texts are aligned where they are read; nothing is shuffled.
    """
    files = (vocabulary or default_vocabulary(), model or default_model())

    def aligned(batches):
        of = sides(*files)
        for batch in batches:
            texts = batch.column("text")
            for part in _slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), batch_text):
                found = align(texts[part].to_pylist(), of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[part] for c in ("row", "id")] + list(found.values()), ["row", "id", *found])

    rows = pick(docs, {"id": (id_column, "long"), "text": (text_column, "string")}).select(
        F.monotonically_increasing_id().alias("row"), "id", "text")
    return landed(rows.mapInArrow(aligned, f"row long, id long, {_FIELDS}"), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n, best: in how many documents two ids are linked, and whether no other partner of the A id has more.

    Tasks count with grouped Arrow tables and Spark adds their counts. The best count of every A id is a table of at most
    the vocabulary of A. Landed.
    """
    def partial(batches):
        kept, size = [], 0

        def counted() -> pa.RecordBatch:
            pairs = pa.concat_arrays(kept)
            table = pa.table({"pair": pairs, "n": pa.array(np.ones(len(pairs), np.int64))})
            table = table.group_by("pair", use_threads=False).aggregate([("n", "sum")])
            return pa.RecordBatch.from_arrays([c.combine_chunks() for c in table.columns], ["pair", "n"])

        for batch in batches:
            kept.append(batch.column("pairs").flatten())
            size += len(kept[-1])
            if size >= PAIRS_AT_ONCE:
                yield counted()
                kept, size = [], 0
        if size:
            yield counted()

    counts = aligned.select("pairs").mapInArrow(partial, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = landed(counts, "pair-counts")
    tops = counts.groupBy(F.shiftright("pair", _B_BITS).alias("a")).agg(F.max("n").alias("top"))
    # One row for each A id that occurs: its vocabulary bounds it.
    return landed(counts.join(F.broadcast(tops), F.shiftright("pair", _B_BITS) == F.col("a"))
                  .select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pair-ranks")


def _frequent(counts: DataFrame, most: int) -> int:
    """Smallest power of two such that at most `most` pairs are in as many documents."""
    steps = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("step")).agg(F.count("*").alias("pairs")).collect()
    by_step, total = {r["step"]: r["pairs"] for r in steps}, 0
    for step in range(max(by_step, default=0), -1, -1):
        total += by_step.get(step, 0)
        if total > most:
            return 1 << (step + 1)
    return 1


def link_scores(aligned: DataFrame, counts: DataFrame, most: int = FREQUENT_PAIRS) -> DataFrame:
    """The aligned documents with n_best (links whose count is the highest of their A id) and count_sum (over links).

    The most frequent pairs, at most `most`, are looked up in the tasks; those occurrences never move. The others
    are in fewer documents than any of these, so no key of their join is hot; Spark joins them by pair and adds
    them up by document.
    """
    limit = _frequent(counts, most)
    top = counts.filter(F.col("n") >= limit).toPandas().sort_values("pair")
    shared = aligned.sparkSession.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("pair", "n", "best")))

    def looked_up(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        known, n, best = shared.value
        lists = batch.column("pairs")
        pairs, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
        at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
        held = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
        parents = pc.list_parent_indices(lists).to_numpy()
        return parents, pairs, times, held, at

    def frequent(batches):
        _, n, best = shared.value
        for batch in batches:
            parents, _, times, held, at = looked_up(batch)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], parents[held], times[held] * best[at[held]])
            np.add.at(sums[1], parents[held], times[held] * n[at[held]])
            names = [f for f in batch.schema.names if f not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *map(pa.array, sums)], [*names, "best_1", "sum_1"])

    def others(batches):
        for batch in batches:
            parents, pairs, times, held, _ = looked_up(batch)
            rows = batch.column("row").to_numpy()[parents]
            yield pa.RecordBatch.from_arrays([pa.array(x[~held]) for x in (rows, pairs, times)], ["row", "pair", "times"])

    fields = _FIELDS.partition(", pairs")[0]
    first = aligned.mapInArrow(frequent, f"row long, id long, {fields}, best_1 long, sum_1 long")
    rest = aligned.select("row", "pairs", "times").mapInArrow(others, "row long, pair long, times long")
    rest = rest.join(counts.filter(F.col("n") < limit).hint("merge"), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_2"),
        F.sum(F.col("times") * F.col("n")).alias("sum_2"))
    return first.join(rest, "row", "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", (F.col("best_1") + F.coalesce("best_2", F.lit(0))).alias("n_best"),
        (F.col("sum_1") + F.coalesce("sum_2", F.lit(0))).alias("count_sum"), "groups_sha256")
