"""Token ids of whole texts by a byte-level BPE file of the tokenizers library."""

from __future__ import annotations

import functools
import json
import re

import numpy as np

#: Encoded words kept by a worker; beyond it the cache starts anew.
CACHED_WORDS = 300_000

#: A space beside other white space. Without one, no token reaches over a space from the left.
_BESIDE = re.compile(r" (?:\s|(?<=\s ))")
_SINGLE = re.compile(r"(?<=\S) (?=\S)")


def _byte_alphabet() -> dict[str, int]:
    """Byte for each character in which byte-level vocabularies are written."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class _Words(dict):
    """Ids, as little-endian bytes, of a word after a space."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = np.array(self.encode(" " + word), "<u4").tobytes()
        return found


class Encoder:
    """ids(text): little-endian unsigned 32-bit ids without special tokens, equal to those of the tokenizers library.

    For the byte-level pattern without a normaliser, a space between two characters that aren't white space always
    begins a token and nothing before it matters, so words are encoded once and looked up afterwards. A word that isn't
    known is encoded by tiktoken with the same vocabulary. Texts with the string of an added token, and every text for
    files of another kind, go through the tokenizers library itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        before = model.get("pre_tokenizer") or {}
        self.words = None
        self.added = [t["content"] for t in model.get("added_tokens") or []]
        if (model["model"]["type"] == "BPE" and not model.get("normalizer") and before.get("type") == "ByteLevel"
                and not before.get("add_prefix_space") and before.get("use_regex", True)
                and not model["model"].get("ignore_merges") and not model["model"].get("dropout")):
            import public_tokenizers
            import tiktoken

            alphabet = _byte_alphabet()
            ranks = {bytes(alphabet[c] for c in token): rank for token, rank in model["model"]["vocab"].items()
                     if token not in self.added}
            self.whole = tiktoken.Encoding(
                "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self.words = _Words(self.whole)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.words is None or any(special in text for special in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _BESIDE.search(text) or text[0] == " " or text[-1] == " ":
            parts = _SINGLE.split(text)
        else:
            parts = text.split(" ")
        first = np.array(self.whole(parts[0]), "<u4").tobytes()
        return first + b"".join(map(self.words.__getitem__, parts[1:]))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
