"""Packing of token ids into fixed sequences with a bounded number of open windows per partition."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed, pick
from fathomline.llm.tokens import default_vocabulary, encoder

#: Windows that a partition keeps open.
OPEN_WINDOWS = 32
#: Partitions whose leftover windows are merged together: at most this times OPEN_WINDOWS windows in a task.
MERGED_PARTITIONS = 64
#: Sequences of one partition or merge have numbers of their own below this many bits.
_SEQUENCE_BITS = 40
_ROWS = 20_000

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("merge", pa.int64()), ("ids", pa.binary())])
_SQL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "merge long, ids binary")

#: A piece: document, position in it, tokens of the document, ids.
Piece = tuple[int | None, int, int, bytes]


class _Window:
    __slots__ = ("free", "pieces")

    def __init__(self, size: int):
        self.free, self.pieces = size, []

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.free -= len(piece[3]) // 4


def cut(piece: Piece, tokens: int) -> tuple[Piece, Piece]:
    doc, start, whole, ids = piece
    return (doc, start, whole, ids[:4 * tokens]), (doc, start + tokens, whole, ids[4 * tokens:])


def pack(pieces: Iterator[Piece], size: int, windows: int) -> Iterator[tuple[bool, list[Piece]]]:
    """(full, pieces) of each window, the ones still open at the end last.

    A piece of a full sequence or more gives whole sequences first. The rest goes to the open window that it fits best. If
    none has the room and no more windows may open, the fullest takes what it has room for and is emitted, and the rest
    of the piece begins its successor.
    """
    open_: list[_Window] = []
    for piece in pieces:
        while len(piece[3]) >= 4 * size:
            first, piece = cut(piece, size)
            yield True, [first]
        need = len(piece[3]) // 4
        if not need:
            continue
        best = min((w for w in open_ if w.free >= need), key=lambda w: w.free, default=None)
        if best is None and len(open_) < windows:
            open_.append(best := _Window(size))
        elif best is None:
            fullest = min(open_, key=lambda w: w.free)
            first, piece = cut(piece, fullest.free)
            fullest.put(first)
            yield True, fullest.pieces
            open_.remove(fullest)
            open_.append(best := _Window(size))
        best.put(piece)
        if not best.free:
            yield True, best.pieces
            open_.remove(best)
    for window in open_:
        yield False, window.pieces


def merge(windows: list[list[Piece]], size: int) -> Iterator[list[Piece]]:
    """Leftover windows as full sequences, the fullest first; what remains is split into sequences of powers of two."""
    tokens = lambda pieces: sum(len(p[3]) for p in pieces) // 4
    queue = [piece for window in sorted(windows, key=lambda w: (-tokens(w), w[0][:2])) for piece in window][::-1]
    left = tokens(queue)
    while left:
        want = free = size if left >= size else 1 << (left.bit_length() - 1)
        row = []
        while free:
            piece = queue.pop()
            if len(piece[3]) > 4 * free:
                piece, rest = cut(piece, free)
                queue.append(rest)
            row.append(piece)
            free -= len(piece[3]) // 4
        left -= want
        yield row


def _batches(sequences: Iterator[tuple[int | None, int | None, list[Piece]]]) -> Iterator[pa.RecordBatch]:
    """Rows of (sequence number, merge group) and pieces; pieces for a merge keep their ids."""
    rows: list[tuple] = []
    for number, group, pieces in sequences:
        offset = 0
        for doc, start, whole, ids in pieces:
            length = len(ids) // 4
            rows.append((doc, start, length, zlib.crc32(ids), whole, number, offset, group,
                         ids if group is not None else None))
            offset += length
        if len(rows) >= _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def pack_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 2048,
                   end_id: int | None = 1, open_windows: int = OPEN_WINDOWS, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every partition packs its documents as they come with `open_windows` open windows (see `pack`); only these few
    leftover windows keep their ids, are written with the finished pieces, and are merged for MERGED_PARTITIONS
    partitions at a time. So a task holds a bounded number of windows, and a source or key with most rows is spread
    like any other. Padding is nil: sequences have `size` tokens, and those of a merge's remainder powers of two.

    Null texts are empty; with `end_id` each document ends with that id, so an empty one has one token. Without it, empty
    documents have no piece. Repeated rows are packed as often as they come; a null id stays null. Which sequence holds
    what depends on the order of the scan, the ids and their order in a document never do. An empty table gives no rows.
    """
    path, end = vocabulary or default_vocabulary(), b"" if end_id is None else end_id.to_bytes(4, "little")

    def pieces(batches, ids) -> Iterator[Piece]:
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                encoded = ids(text) + end
                yield doc, 0, len(encoded) // 4, encoded

    def first(batches):
        part, number = TaskContext.get().partitionId(), 0

        def sequences():
            nonlocal number
            for full, row in pack(pieces(batches, encoder(path).ids), size, open_windows):
                yield (part << _SEQUENCE_BITS) + number, None if full else part // MERGED_PARTITIONS, row
                number += 1
        yield from _batches(sequences())

    def last(rows: pa.Table) -> pa.Table:
        group = rows["merge"][0].as_py()
        windows: dict[int, list] = {}
        for doc, start, whole, number, offset, ids in zip(*(rows[c].to_pylist() for c in (
                "doc_id", "start", "doc_tokens", "sequence_id", "offset", "ids"))):
            windows.setdefault(number, []).append((offset, (doc, start, whole, ids)))
        ordered = [[piece for _, piece in sorted(windows[n], key=lambda x: x[0])] for n in sorted(windows)]
        base = (1 << 62) + (group << _SEQUENCE_BITS)
        merged = _batches((base + n, None, row) for n, row in enumerate(merge(ordered, size)))
        return pa.Table.from_batches(merged, _SCHEMA)

    packed = landed(pick(docs, {"doc_id": (id_column, "long"), "text": (text_column, "string")})
                    .mapInArrow(first, _SQL), "packed")
    leftovers = packed.filter("merge is not null").groupBy("merge").applyInArrow(last, _SQL)
    return packed.filter("merge is null").unionByName(leftovers).drop("merge", "ids")
