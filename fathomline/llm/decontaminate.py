"""Benchmark decontamination by Wu-Manber search over words."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed, pick, words_of

#: Words of a window; an item of fewer words is one window.
WINDOW_WORDS = 10
#: Words of the block that the shift table looks at.
BLOCK_WORDS = 2
#: Benchmark text searched in one pass over the documents; more text takes more passes, each with bounded tables.
BLOCK_CHARS = 8_000_000
#: Words of one piece of a long item; pieces overlap so that no window is lost.
PIECE_WORDS = 2_000


_MIX = 0x9E3779B1
_KEY = (1 << 62) - 1


class _Table:
    """Wu-Manber tables for the windows of one length, as flat arrays: no object is kept per window.

    A block is known by a key of the hashes of its words. Blocks that share a slot of the shift table share the shorter shift, so
    collisions cost a look, never a hit; an occurrence is settled by comparing the bytes of the window. Windows are sorted by the key
    of their last and of their first block; equal windows are one entry with a run of item numbers.
    """

    def __init__(self, length: int, pieces: list[tuple[int, bytes]]):
        """`pieces` are (item number, words joined by one space), each of at least `length` words."""
        self.length, self.block = length, min(BLOCK_WORDS, length)
        self.last = length - self.block
        self.text = b" ".join(text for _, text in pieces)
        buffer = np.frombuffer(self.text, np.uint8)
        gaps = np.flatnonzero(buffer == 32)
        begins, ends = np.append(0, gaps + 1).astype(np.int32), np.append(gaps, len(buffer)).astype(np.int32)
        sizes = np.array([text.count(b" ") + 1 for _, text in pieces], np.int64)
        hashes = np.concatenate([np.fromiter(map(hash, text.split(b" ")), np.int64) for _, text in pieces])
        heads = np.repeat(np.cumsum(sizes) - sizes, sizes)
        offset, left = np.arange(len(hashes)) - heads, np.repeat(sizes, sizes)
        left -= offset
        keys = hashes & _KEY
        if self.block == 2:
            keys[:-1] = (hashes[:-1] * _MIX ^ hashes[1:]) & _KEY

        # A block ends some window at its place in it; the later in a window, the shorter the shift.
        slots = 1 << max(10, (8 * len(keys)).bit_length())
        self.mask = slots - 1
        shift = np.full(slots, min(255, self.last + 1), np.uint8)
        whole = left >= self.block
        steps = np.minimum(255, self.last - np.minimum(self.last, offset[whole])).astype(np.uint8)
        np.minimum.at(shift, keys[whole] & self.mask, steps)
        self.shift = shift.tobytes()

        starts = np.flatnonzero(left >= length)
        ending, first = keys[starts + self.last], keys[starts]
        content = np.zeros(len(starts), np.int64)
        for k in range(length):
            content = content * 0x100000001B3 ^ hashes[starts + k]
        owner = np.repeat(np.array([item for item, _ in pieces], np.int32), sizes)[starts]
        order = np.lexsort((owner, content, first, ending))
        starts, ending, first, content, owner = (x[order] for x in (starts, ending, first, content, owner))
        low, high = begins[starts], ends[starts + length - 1]
        again = np.zeros(len(starts), bool)
        again[1:] = (ending[1:] == ending[:-1]) & (first[1:] == first[:-1]) & (content[1:] == content[:-1])
        for k in np.flatnonzero(again).tolist():
            again[k] = self.text[low[k - 1]:high[k - 1]] == self.text[low[k]:high[k]]
        fresh = ~again
        fresh[1:] |= owner[1:] != owner[:-1]
        heads = np.flatnonzero(~again)
        self.ending, self.first, self.low, self.high = ending[heads], first[heads], low[heads], high[heads]
        self.owners = owner[fresh]
        self.runs = np.append(np.cumsum(fresh)[heads] - 1, len(self.owners))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """Start and number of the window of every occurrence."""
        last, shift, mask, pair = self.last, self.shift, self.mask, self.block == 2
        at, end = last, len(words) - self.block + 1
        while at < end:
            key = (hash(words[at]) * _MIX ^ hash(words[at + 1])) & _KEY if pair else hash(words[at]) & _KEY
            step = shift[key & mask]
            if step:
                at += step
                continue
            low, high = self.ending.searchsorted(key, "left"), self.ending.searchsorted(key, "right")
            if low < high:
                start = at - last
                key = (hash(words[start]) * _MIX ^ hash(words[start + 1])) & _KEY if pair else key
                heads = self.first[low:high]
                window = None
                for entry in range(low + heads.searchsorted(key, "left"), low + heads.searchsorted(key, "right")):
                    window = window or b" ".join(words[start:start + self.length])
                    if self.text[self.low[entry]:self.high[entry]] == window:
                        yield start, entry
                        break
            at += 1

    def items(self, entry: int) -> list[int]:
        """Numbers of the items that have a window."""
        return self.owners[self.runs[entry]:self.runs[entry + 1]].tolist()


class Matcher:
    """All windows of some benchmark pieces; windows of the full length share one table, shorter items have their own."""

    def __init__(self, pieces: Iterable[tuple[str, bytes]], window: int = WINDOW_WORDS):
        numbers: dict[str, int] = {}
        by_length: dict[int, list[tuple[int, bytes]]] = {}
        for name, text in pieces:
            length = min(window, text.count(b" ") + 1)
            by_length.setdefault(length, []).append((numbers.setdefault(name, len(numbers)), text))
        self.names = list(numbers)
        self.tables = [_Table(length, found) for length, found in by_length.items()]

    def hits(self, words: list[bytes]) -> tuple[list[int], list[str]]:
        """Merged [start, end) positions of the hit words, flat, and the items that occur."""
        spans, found = [], set()
        for searched in self.tables:
            entries = set()
            for start, entry in searched.search(words):
                spans.append((start, start + searched.length))
                entries.add(entry)
            for entry in entries:
                found.update(searched.items(entry))
        return merged(spans), sorted({self.names[i] for i in found})


_MATCHERS: dict[tuple[str, int], Matcher] = {}


def matcher_of(shared, token: str, window: int) -> Matcher:
    """The tables of a broadcast block, built once by a worker process and kept until it meets another block."""
    if (token, window) not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[token, window] = Matcher(shared.value, window)
    return _MATCHERS[token, window]


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Union of intervals as a flat list of starts and ends."""
    flat: list[int] = []
    for start, end in sorted(spans):
        if flat and start <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += [start, end]
    return flat


_PIECES = "item string, words binary"
_FOUND = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.int32())),
                    ("items", pa.list_(pa.string()))])
_FOUND_SQL = "id long, row long, n_words long, spans array<int>, items array<string>"
_HITS_SQL = "id long, n_words long, n_hit long, items array<string>, items_sha256 string"


def _pieces(window: int):
    def cut(batches):
        for batch in batches:
            names, texts = [], []
            for name, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(text)
                for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS) if words else ():
                    names.append(name)
                    texts.append(b" ".join(words[at:at + PIECE_WORDS + window - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], ["item", "words"])
    return cut


def _scan(shared, window: int):
    token = uuid.uuid4().hex

    def scan(batches):
        matcher = matcher_of(shared, token, window)
        for batch in batches:
            ids, numbers, texts, rows = *(batch[c].to_pylist() for c in ("id", "row", "text")), []
            for i, row, text in zip(ids, numbers, texts):
                words = words_of(text)
                spans, items = matcher.hits(words)
                rows.append((i, row, len(words), spans, items))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind.type) for column, kind in zip(zip(*rows), _FOUND)] if rows
                else [pa.array([], kind.type) for kind in _FOUND], schema=_FOUND)
    return scan


def _digest(batches):
    for batch in batches:
        columns = batch.to_pydict()
        hit = [sum(s[1::2]) - sum(s[0::2]) for s in columns["spans"]]
        digests = [hashlib.sha256(",".join(items).encode()).hexdigest() for items in columns["items"]]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["n_words"], pa.array(hit, pa.int64()), batch["items"], pa.array(digests, pa.string())],
            ["id", "n_words", "n_hit", "items", "items_sha256"])


def _union(batches):
    """Hits of several passes in one row: the union of the positions and of the items."""
    for batch in batches:
        columns = batch.to_pydict()
        spans = [merged([(s[k], s[k + 1]) for s in passes for k in range(0, len(s), 2)]) for passes in columns["passes"]]
        items = [sorted({i for found in lists for i in found}) for lists in columns["lists"]]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["n_words"], pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
            ["id", "n_words", "spans", "items"])


def _blocks(benchmark: DataFrame, item_column: str, text_column: str, window: int, block_chars: int):
    """Number of blocks, and a function that broadcasts (item, words) of one of them, about `block_chars` bytes.

    One empty block if there is no text. Pieces of several blocks are cut once and written; each read takes one block.
    """
    items = pick(benchmark, {"item": (item_column, "string"), "text": (text_column, "binary")}).fillna("", ["item"])
    blocks = 1 + (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_chars
    pieces = items.mapInArrow(_pieces(window), _PIECES).distinct()
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)))
    if blocks > 1:
        dealt = landed(dealt, "benchmark-pieces")

    def share(block: int):
        rows = dealt.filter(F.col("block") == block).select("item", "words").collect()
        return benchmark.sparkSession.sparkContext.broadcast([(r.item, bytes(r.words)) for r in rows])
    return blocks, share


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       item_column: str = "item_id", item_text_column: str = "text", window: int = WINDOW_WORDS,
                       block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (sorted as strings), items_sha256.

    Benchmark text is cut into blocks of bounded size. Each block is one pass over the documents: its tables go to the
    tasks by a broadcast of that bound, every document is searched as a whole where it is read, and nothing but hits
    comes out. Benchmarks of one block need no shuffle. With several blocks, the hits of a pass are written before its
    broadcast is given up and the next block is read, so the driver holds one block at a time. Documents are then numbered
    in a written table first, and the hits of a document are joined by its number: one row per pass, however many are equal.

    Null or empty texts have no words and no hits; an item without words has no window; a null item id counts as the
    empty string. Repeated documents each get their row, repeated items count once by id. An empty benchmark hits
    nothing. Ties can't arise: the result doesn't depend on order.
    """
    blocks, share = _blocks(benchmark, item_column, item_text_column, window, block_chars)
    texts = pick(docs, {"id": (id_column, "long"), "text": (text_column, "binary")}).withColumn(
        "row", F.monotonically_increasing_id())
    if blocks > 1:
        texts = landed(texts, "numbered-texts")
    passes = []
    for block in range(blocks):
        shared = share(block)
        found = texts.mapInArrow(_scan(shared, window), _FOUND_SQL)
        if blocks > 1:
            found = landed(found, "benchmark-hits")
            shared.destroy()
        passes.append(found)
    found = passes[0]
    if blocks > 1:
        for other in passes[1:]:
            found = found.unionByName(other)
        found = (found.groupBy("row").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"),
                                          F.collect_list("spans").alias("passes"), F.collect_list("items").alias("lists"))
                 .select("id", "n_words", "passes", "lists")
                 .mapInArrow(_union, "id long, n_words long, spans array<int>, items array<string>"))
    return found.select("id", "n_words", "spans", "items").mapInArrow(_digest, _HITS_SQL)


def _clean(shared, window: int, text_column: str):
    """Whole rows without a hit, as they came."""
    token = uuid.uuid4().hex

    def keep(batches):
        matcher = matcher_of(shared, token, window)
        for batch in batches:
            texts = batch[text_column].to_pylist()
            yield batch.filter(pa.array([not matcher.hits(words_of(t))[0] for t in texts], pa.bool_()))
    return keep


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
                      item_text_column: str = "text", window: int = WINDOW_WORDS,
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents without any hit, with the columns of `docs`; see find_contamination.

    Each block of the benchmark filters what the last one left, which is written in between.
    """
    at = docs.columns.index(text_column)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    rows = plain.withColumn("x_text", F.col(f"c{at}").cast("binary"))
    blocks, share = _blocks(benchmark, item_column, item_text_column, window, block_chars)
    for block in range(blocks):
        shared = share(block)
        rows = rows.mapInArrow(_clean(shared, window, "x_text"), rows.schema)
        if block < blocks - 1:
            rows = landed(rows, "decontaminated")
            shared.destroy()
    return rows.drop("x_text").toDF(*docs.columns)
