"""Removal of repeated byte strings, by matching fingerprints at the positions of a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed, pick
from fathomline.llm.rolling import Prefixes

# Perfect difference sets. Modulo the period, every difference is one of two members, exactly once.
COVERS = {
    3: (0, 1),
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    31: (1, 5, 11, 24, 25, 27),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    133: (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121),
}

#: Text of one block of documents, whose suffixes a task handles together.
BLOCK_BYTES = 1_800_000
#: Sample suffixes, and fingerprints of long contexts, that are sorted together in one bucket.
BUCKET_SAMPLES, BUCKET_PRINTS = 4_000_000, 2_000_000
#: Answers of at most so many bytes are broadcast to the blocks they are for; more are joined by a shuffle.
BROADCAST_BYTES = 32_000_000


def cover_for(size: int) -> tuple[int, tuple[int, ...]]:
    """Period and members of the cover for strings of `size` bytes: the longest period of at most a third, or 1."""
    period = max((p for p in COVERS if 3 * p <= size), default=1)
    return period, COVERS.get(period, (0,))


class _Block:
    """Suffixes of a block of whole documents, and what the earlier rounds found out about them.

    Any two equal strings of `size` bytes have a sample position at the same distance from their begin, at most a period
    away, since the sample is a difference cover. So only sample suffixes are matched, by their first
    `short` = size - period + 1 bytes; a string can be repeated only where such a short context is.
    """

    def __init__(self, blob, lengths: list[int], size: int):
        self.blob, self.size = memoryview(blob), size
        self.period, members = cover_for(size)
        self.short = size - self.period + 1
        lens = np.array(lengths, np.int64)
        self.ends = np.cumsum(lens)
        self.starts = self.ends - lens
        longest = int(lens.max(initial=0))
        pattern = (np.arange(0, longest + 1, self.period)[:, None] + np.array(members)).ravel()
        long_enough = np.flatnonzero(lens >= size)
        count = np.searchsorted(pattern, lens[long_enough] - self.short, side="right")
        at = [pattern[:c] + s for c, s in zip(count.tolist(), self.starts[long_enough].tolist())]
        self.at = np.concatenate(at) if at else np.empty(0, np.int64)
        self.owner = np.repeat(long_enough, count)
        buffer = np.frombuffer(blob, np.uint8)
        self.hashes = Prefixes(buffer).hashes(self.at, self.at + self.short) if len(self.at) else np.empty(0, np.uint64)

    def samples(self, buckets: int) -> "_Sent":
        """Round 1: the short contexts of all sample suffixes, of which no more than equality is asked."""
        bucket = ((self.hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        return _Sent(bucket << np.uint64(32) | (self.hashes & np.uint64(0xFFFFFFFF)), None, buckets)

    def keep_shared(self, shared: np.ndarray) -> None:
        """Sample suffixes whose short context stands elsewhere too."""
        self.at, self.owner = self.at[shared], self.owner[shared]
        self.low = np.maximum(self.starts[self.owner], self.at - self.period + 1)
        self.high = np.minimum(self.ends[self.owner], self.at + self.size)
        # Strings of full size that begin in the context: low to last.
        self.last = np.minimum(self.at, self.ends[self.owner] - self.size)

    def _prints(self, low: np.ndarray, high: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        blob, digest = self.blob, xxhash.xxh3_128_digest
        joined = b"".join([digest(blob[a:b], s) for a, b, s in zip(low.tolist(), high.tolist(), seeds.tolist())])
        return np.frombuffer(joined, ">u8").astype(np.uint64).reshape(-1, 2)

    def contexts(self, buckets: int) -> "_Sent":
        """Round 2: long ties, of whole contexts: all bytes of the strings of full size that hold the sample's begin."""
        prints = self._prints(self.low, self.high, (self.at - self.low) * 65536 + (self.high - self.at))
        return _Sent(prints[:, 0], prints[:, 1], buckets)

    def _marks(self, chosen: np.ndarray) -> np.ndarray:
        """Begins of strings in the chosen contexts."""
        change = np.zeros(len(self.blob) + 1, np.int32)
        some = chosen & (self.last >= self.low)
        np.add.at(change, self.low[some], 1)
        np.add.at(change, self.last[some] + 1, -1)
        return np.cumsum(change[:-1]) > 0

    def settle(self, repeated: np.ndarray, first: np.ndarray) -> None:
        """Strings in contexts that stand elsewhere as a whole are repeated. Of such a context, one block sends the strings
        for partners that share a part of it; every other string with a shared sample is sent by itself."""
        self.repeated = self._marks(repeated)
        open_ = self._marks(np.ones(len(self.at), bool)) & ~self.repeated
        self.sent = np.flatnonzero(open_ | self._marks(repeated & first))

    def strings(self, buckets: int) -> "_Sent":
        """Round 3: the strings of full size that are still open, and one of each settled kind."""
        prints = self._prints(self.sent, self.sent + self.size, np.zeros(len(self.sent), np.int64))
        return _Sent(prints[:, 0], prints[:, 1], buckets)

    def removed(self, found: np.ndarray) -> np.ndarray:
        """Bytes under repeated strings."""
        begins = self.repeated.copy()
        begins[self.sent[found]] = True
        upto = np.concatenate([[0], np.cumsum(begins)])
        at = np.arange(1, len(begins) + 1)
        return upto[at] > upto[np.maximum(0, at - self.size)]


class _Sent:
    """Distinct keys of a block in order, dealt to buckets by range, and how its items map to them."""

    def __init__(self, high: np.ndarray, low: np.ndarray | None, buckets: int):
        if low is None:
            self.keys, self.index, times = np.unique(high, return_inverse=True, return_counts=True)
            bucket = self.keys >> np.uint64(32)
            self.payload = self.keys.astype("<u4")
        else:
            order = np.lexsort((low, high))
            a, b = high[order], low[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            number = np.cumsum(new) - 1
            self.index = np.empty(len(a), np.int64)
            self.index[order] = number
            times = np.bincount(number, minlength=0)
            self.keys = a[new]
            bucket = ((self.keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            self.payload = np.stack([a[new], b[new]], axis=1).astype("<u8")
        self.twice = times > 1
        self.cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))

    def messages(self) -> Iterator[tuple[int, bytes]]:
        for bucket in np.flatnonzero(np.diff(self.cuts)).tolist():
            yield bucket, self.payload[self.cuts[bucket]:self.cuts[bucket + 1]].tobytes()

    def read(self, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """For each item: whether its key is there twice or more, and whether this block is the first that has it."""
        there, first = self.twice.copy(), np.ones(len(self.twice), bool)
        for answer in answers:
            low, high = self.cuts[answer["bucket"]], self.cuts[answer["bucket"] + 1]
            bits = np.unpackbits(np.frombuffer(answer["answer"], np.uint8).reshape(2, -1), axis=1, count=high - low)
            there[low:high] |= bits[0].astype(bool)
            first[low:high] = bits[1]
        return there[self.index], first[self.index]


def _meet(wide: bool):
    """One bucket: sort the keys of all blocks and tell each block which of its keys others have, and which it has first."""
    def meet(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        payloads = rows["keys"].to_pylist()
        parts = [np.frombuffer(p, "<u8").reshape(-1, 2) if wide else np.frombuffer(p, "<u4") for p in payloads]
        keys = np.concatenate(parts)
        if wide:
            order = np.lexsort((keys[:, 1], keys[:, 0]))
            found = keys[order]
            same = (found[1:] == found[:-1]).all(axis=1)
        else:
            order = np.argsort(keys, kind="stable")
            found = keys[order]
            same = found[1:] == found[:-1]
        before, after = np.concatenate([[False], same]), np.concatenate([same, [False]])
        there, first = np.empty(len(keys), bool), np.empty(len(keys), bool)
        there[order], first[order] = before | after, ~before
        answers, at = [], 0
        for part in parts:
            bits = np.stack([there[at:at + len(part)], first[at:at + len(part)]])
            answers.append(np.packbits(bits, axis=1).tobytes())
            at += len(part)
        return pa.table([rows["block"], rows["bucket"], pa.array(answers, pa.binary())], ["block", "bucket", "answer"])
    return meet


def _blocks(block_bytes: int):
    """Whole documents, packed into blocks."""
    def pack(batches):
        number, held = TaskContext.get().partitionId() << 32, []

        def row():
            ids, texts = zip(*held)
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([b"".join(texts)], pa.binary())],
                ["block", "ids", "lengths", "blob"])

        size = 0
        for batch in batches:
            for i, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                held.append((i, text or b""))
                size += len(text or b"")
                if size >= block_bytes or len(held) >= block_bytes:
                    yield row()
                    number, held, size = number + 1, [], 0
        if held:
            yield row()
    return pack


def _replay(row: dict, size: int, buckets: tuple[int, int, int], rounds: int) -> tuple[_Block, _Sent]:
    """A block after so many answered rounds, with what it sends next or what it sent last."""
    block = _Block(row["blob"], row["lengths"], size)
    sent = block.samples(buckets[0])
    if rounds > 0:
        block.keep_shared(sent.read(row["answers0"])[0])
        sent = block.contexts(buckets[1])
    if rounds > 1:
        block.settle(*sent.read(row["answers1"]))
        sent = block.strings(buckets[2])
    return block, sent


def _rows(batch, rounds: int) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {"block": batch["block"][k].as_py(), "ids": batch["ids"][k].as_py(), "lengths": batch["lengths"][k].as_py(),
               "blob": batch["blob"][k].as_buffer() or b""} | {f"answers{r}": batch[f"answers{r}"][k].as_py() or [] for r in range(rounds)}


def _ask(size: int, buckets: tuple[int, int, int], rounds: int):
    def ask(batches):
        for batch in batches:
            for row in _rows(batch, rounds):
                sent = [*_replay(row, size, buckets, rounds)[1].messages()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["block"]] * len(sent), pa.int64()), pa.array([b for b, _ in sent], pa.int64()),
                    pa.array([keys for _, keys in sent], pa.binary())], ["block", "bucket", "keys"])
    return ask


def _result(size: int, buckets: tuple[int, int, int]):
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def result(batches):
        for batch in batches:
            for row in _rows(batch, 3):
                block, sent = _replay(row, size, buckets, 2)
                gone = block.removed(sent.read(row["answers2"])[0])
                out, buffer = [], np.frombuffer(row["blob"], np.uint8)
                for i, start, end in zip(row["ids"], block.starts.tolist(), block.ends.tolist()):
                    mask = gone[start:end]
                    removed = int(np.count_nonzero(mask))
                    spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + bool(mask[0]) if removed else 0
                    kept = (buffer[start:end][~mask] if removed else buffer[start:end]).tobytes()
                    out.append((i, end - start, removed, spans, hashlib.sha256(kept).hexdigest(), kept))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return result


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 400,
                   block_bytes: int = BLOCK_BYTES, bucket_samples: int = BUCKET_SAMPLES,
                   bucket_prints: int = BUCKET_PRINTS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay).

    A byte goes if a string of `size` bytes over it also begins anywhere else, in this document or another, overlapping or
    not; strings are those of the input, never over the end of a document.

    Fingerprints stand in for the sorting of suffixes, as only equality is asked: documents are written once as blocks. Only
    contexts at a difference cover are matched, about 9 % of the positions, one bucket of their hashes at a time.

    1. Equal first bytes (size less the period) make a class, by their hash; a suffix alone in its class is out.
    2. Long ties: the whole context of a sample, all strings that hold its begin, is looked up once; if it stands
       elsewhere, every string in it is repeated without looking at them one by one.
    3. Strings at the edges of repeats, and one of each settled kind, are looked up by 128-bit fingerprints.

    A block sends a key once however often it has it, and gets two bits per key back, so a passage that most documents
    have costs as many keys as there are blocks. Buckets take a range of hashes each and are numbered from the size of
    the input, so what a task sorts is bounded. Answers go back by a broadcast of checked size, or a join on the block.

    Null and empty texts have no bytes. Repeated rows are documents like any other, so long ones remove each other. Texts
    shorter than `size` stay. Null ids stay null. An empty table gives no rows.
    """
    blocks = landed(pick(docs, {"id": (id_column, "long"), "text": (text_column, "binary")}).mapInArrow(
        _blocks(block_bytes), "block long, ids array<long>, lengths array<long>, blob binary"), "blocks")
    total = blocks.agg(F.sum(F.octet_length("blob"))).first()[0] or 0
    period, members = cover_for(size)
    samples = total * len(members) // period
    buckets = (1 + samples // bucket_samples, 1 + samples // bucket_prints, 1 + total // (2 * bucket_prints))
    state = blocks
    for rounds in range(3):
        sent = state.mapInArrow(_ask(size, buckets, rounds), "block long, bucket long, keys binary")
        answers = landed(sent.groupBy("bucket").applyInArrow(_meet(rounds > 0), "block long, bucket long, answer binary"),
                         f"answers-{rounds}")
        size_of = answers.agg(F.sum(F.octet_length("answer"))).first()[0] or 0
        own = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "answer")).alias(f"answers{rounds}"))
        state = state.join(F.broadcast(own) if size_of <= broadcast_bytes else own.hint("merge"), "block", "left")
    return state.mapInArrow(_result(size, buckets),
                            "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
