"""Byte-level BPE ids of whole texts, with a bounded cache of pieces.

The vocabulary file (a ``tokenizers`` JSON) is the only source: its merges
are applied by the same ranks.  A text may be cut wherever a single space
stands between two non-space characters, as the pre-tokenizer's pattern
always starts a new piece there.  The cuts of a slice of texts are found on
its bytes, equal pieces are encoded once, and numpy puts their ids back in
the texts' order.  Pieces that hold a special token go to the ``tokenizers``
library itself.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from aerocast.llm import common as c

MAX_WORDS = 100_000     # cached pieces of a generation
_made: dict = {}

_BLANK = np.zeros(256, bool)            # ASCII characters that are white space
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_MAYBE = np.zeros(256, bool)            # first bytes of other characters that may be
_MAYBE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: at texts, and at single spaces between two
    characters that surely are no white space.  (Where it is not sure, there
    is no cut: a longer piece has the same ids.)"""
    n = len(data)
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at < n - 1)]
    start = np.zeros(n + 1, bool)
    start[offsets] = True
    before, behind = data[at - 1], data[at + 1]
    ok = ~(_BLANK[before] | _BLANK[behind] | _MAYBE[behind] | start[at] | start[at + 1])
    ok &= ~((before >= 0x80) & (_MAYBE[data[np.maximum(at - 2, 0)]] | _MAYBE[data[np.maximum(at - 3, 0)]]))
    start[at[ok]] = True
    start[n] = False
    return np.flatnonzero(start)


def _bytes_of_chars() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ids:
    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.whole = Tokenizer.from_file(path)
        byte = _bytes_of_chars()
        ranks = {bytes(byte[ch] for ch in w): i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        self.core = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, word: str) -> bytes:
        if any(t in word for t in self.special):
            ids = self.whole.encode(word, add_special_tokens=False).ids
        else:
            ids = self.core.encode_ordinary(word)
        return np.array(ids, "<u4").tobytes()

    def _of(self, piece: str) -> bytes:
        got = self.cache.get(piece) or self.old.get(piece)
        if got is None:
            got = self._encode(piece)
        if len(piece) <= 64:
            self.cache[piece] = got
        return got

    def encode_all(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after the other, as unsigned 32-bit
        integers, and the n + 1 offsets; a null text counts as empty."""
        data, off = c.text_bytes(col)
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(off), np.int64)
        at = cuts(data, off)
        pieces = pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        which = pieces.indices.to_numpy(zero_copy_only=False)
        ids = [self._of(x) for x in pieces.dictionary.to_pylist()]
        if len(self.cache) > MAX_WORDS:                 # of two generations: what is used again stays
            self.cache, self.old = {}, self.cache
        size = np.array([len(x) for x in ids], np.int64) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        first = np.cumsum(size) - size
        many = size[which]
        ends = np.cumsum(many)
        take = np.arange(int(ends[-1])) + np.repeat(first[which] - (ends - many), many)
        return flat[take], np.append(0, ends)[np.searchsorted(at, off)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


def ids_for(path: str) -> Ids:
    """One instance per Python worker and file."""
    if path not in _made:
        _made[path] = Ids(path)
    return _made[path]
