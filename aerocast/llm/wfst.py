"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The model file is compiled into three machines:

- the normaliser, a transducer of one state: an arc per character, which
  copies it or, for the space, writes the piece mark; its start writes one
  mark more;
- the pieces, a transducer whose paths are the characters of a piece (a
  trie) and whose ends write its id; a character without a piece has an arc
  of its own that writes its byte pieces (byte fallback);
- the neighbours, a weighted acceptor whose states are pieces: the arc from
  u to v weighs 0 if the merges of the model turn the characters of u and v
  into just u and v, else infinity.  Its arcs are made when they are asked.

Composed with an input they form a graph without cycles, whose states are
(place, last piece).  Its shortest path in the tropical semiring, where
weights along a path are added and the least of two paths is taken, is found
by relaxing arcs best first.

For a merge (BPE) model a sequence of pieces is the encoding exactly if all
neighbours are compatible, so the shortest path, the only one of finite
weight, is the encoding.  (Scores of pieces alone, added up along a path,
would give another segmentation than the model's merges.)  No piece has its
mark behind another character, so a text can be cut before each run of
marks; the words of many texts are cut on their bytes, equal ones are
encoded once, and numpy puts their ids back in the texts' order.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from aerocast.llm import common as c

MARK = "▁"
MAX_WORDS, MAX_ARCS = 300_000, 200_000      # cached words of a generation, cached arcs
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
HELD_BYTES = 8 << 20        # of texts that a task encodes at once
INFINITE = float("inf")
NORMAL, BYTE, BPE = 1, 6, 2        # piece types and the model type of the file format


def fields(buf: bytes):
    """(number, value) of a serialised message's fields."""
    i, n = 0, len(buf)

    def varint():
        nonlocal i
        value = shift = 0
        while True:
            x = buf[i]
            i += 1
            value |= (x & 127) << shift
            shift += 7
            if x < 128:
                return value
    while i < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, buf[i:i + size]
        i += size


class Transducer:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(fields(f.read()))
        self.pieces: list[str] = []
        score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.out: list[bytes] = []
        for k, (_, raw) in enumerate(x for x in model if x[0] == 1):
            p = dict(fields(raw))
            text, kind = p[1].decode(), p.get(3, NORMAL)
            self.pieces.append(text)
            out = b""
            if kind == NORMAL:
                self.id[text], out = k, text.replace(MARK, " ").encode()
                score[text] = float(np.frombuffer(p.get(2, b"\0\0\0\0"), "<f4")[0])
            elif kind == BYTE:
                value = int(text[3:5], 16)
                self.byte[value], out = k, bytes([value])
            self.out.append(out)
        trainer = dict(fields(next(v for f, v in model if f == 2)))
        normal = dict(fields(next(v for f, v in model if f == 3)))
        if trainer.get(3, 1) != BPE or not trainer.get(35) or normal.get(2) or normal.get(4, 1) or not normal.get(3, 1):
            raise ValueError("supported: BPE models with byte fallback, identity normaliser, dummy prefix, spaces kept")
        self.score = score
        self.normaliser = {ord(" "): MARK}              # all other characters are copied
        self.start = MARK
        self.trie: dict = {}
        for text in self.id:
            node = self.trie
            for ch in text:
                node = node.setdefault(ch, {})
            node[""] = text
        self.size = np.array([len(x) for x in self.out], np.int64)          # bytes that an id stands for
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(self.out), np.uint8)
        self.known: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.cache: dict[str, bytes] = {}      # of two generations: what is used again stays
        self.old: dict[str, bytes] = {}

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the last merge of a piece joins (a character:
        itself and nothing); None if its characters do not merge into it.
        Merges go by score, the leftmost of equals first."""
        if piece not in self.parts:
            parts, last = list(piece), (piece, "")
            while len(parts) > 1:
                best = max(((self.score[x], -i) for i in range(len(parts) - 1) if (x := parts[i] + parts[i + 1]) in self.score),
                           default=None)
                if best is None:
                    break
                i = -best[1]
                last = (parts[i], parts[i + 1])
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.parts[piece] = last if len(parts) == 1 else None
        return self.parts[piece]

    def arc(self, u: str, v: str) -> bool:
        """Whether v may follow u (u empty: may come first).

        No merge across the border may come before those that make u and v.
        These are undone from the last (lowest score, rightmost) on; what
        then stands at the border must not merge earlier than the one
        undone."""
        score = self.score
        if self.split(v) is None:
            return False
        limit, right = -float("inf"), True
        while u:
            x = score.get(u + v)
            if x is not None and (x > limit or (x == limit and right)):
                return False
            a = score[u] if len(u) > 1 else None
            b = score[v] if len(v) > 1 else None
            if a is None and b is None:
                break
            right = b is not None and (a is None or b <= a)
            if right:
                limit, v = b, self.split(v)[0]
            else:
                limit, u = a, self.split(u)[1]
        return True

    def weight(self, u: str, v: str) -> float:
        """Of the neighbours' arc from u to v, in the tropical semiring."""
        ok = self.known.get((u, v))
        if ok is None:
            ok = self.arc(u, v)
            if len(self.known) < MAX_ARCS:
                self.known[u, v] = ok
        return 0.0 if ok else INFINITE

    def pieces_at(self, word: str, i: int) -> list[str]:
        """Arcs of the pieces' machine that leave place i of a word: longest
        first, the fallback of a character without a piece last."""
        out, node, j = [], self.trie.get(word[i]), i + 1
        if node is None or "" not in node:
            out.append(word[i])
        while node is not None:
            if "" in node:
                out.append(node[""])
            node = node.get(word[j]) if j < len(word) else None
            j += 1
        return out[::-1]

    def path(self, word: str) -> list[str]:
        """Pieces of the shortest path of a word in normal form.

        Best first: of the states reached, that of the least distance goes
        on, of equals the farthest in the word, and its arcs are relaxed one
        by one, the longest piece first.  Distances are sums of 0 and
        infinity, so a state reached at all is reached at distance 0, a
        second arc to it is not shorter, and the queue is a stack."""
        n = len(word)
        reached = {(0, "")}
        arcs: dict[int, list[str]] = {}
        queue = [[0, "", 0]]                                    # place, piece, arcs relaxed so far
        while queue:
            state = queue[-1]
            i, u, k = state
            if i == n:
                break
            out = arcs.get(i)
            if out is None:
                out = arcs[i] = self.pieces_at(word, i)
            if k == len(out):
                queue.pop()
                continue
            state[2] = k + 1
            v = out[k]
            there = (i + len(v), v)
            if there not in reached and self.weight(u, v) < INFINITE:
                reached.add(there)
                queue.append([*there, 0])
        else:
            raise ValueError(f"no path of finite weight for {word!r}")
        return [v for _, v, _ in queue[1:]]

    def _ids(self, word: str) -> bytes:
        ids: list[int] = []
        for p in self.path(word):
            k = self.id.get(p)
            ids += [self.byte[x] for x in p.encode()] if k is None else [k]
        return np.array(ids, "<u4").tobytes()

    def _of(self, part: str) -> bytes:
        """Ids of a part of a text in normal form that begins with a mark."""
        out = []
        for w in _WORD.findall(part):
            got = self.cache.get(w) or self.old.get(w)
            if got is None:
                got = self._ids(w)
            if len(w) <= 64:
                self.cache[w] = got
            out.append(got)
        return b"".join(out)

    def encode_all(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after the other, as unsigned 32-bit
        integers, and the n + 1 offsets; a null text counts as empty."""
        data, off = c.text_bytes(col)
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(off), np.int64)
        at = cuts(data, off)
        parts = pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        first = np.unique(np.searchsorted(at, off[:-1][off[1:] > off[:-1]]))        # parts that begin a text
        words = parts.dictionary_encode()
        which = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        which[first] = len(words.dictionary) + np.arange(len(first))
        used = np.zeros(len(words.dictionary), bool)
        used[which[which < len(used)]] = True
        normal = lambda x: x.translate(self.normaliser)
        ids = [self._of(normal(x)) if u else b"" for x, u in zip(words.dictionary.to_pylist(), used.tolist())]
        ids += [self._of(self.start + normal(x)) for x in parts.take(pa.array(first)).to_pylist()]
        if len(self.cache) > MAX_WORDS:                 # of two generations: what is used again stays
            self.cache, self.old = {}, self.cache
        size = np.array([len(x) for x in ids], np.int64) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        begin, many = np.cumsum(size) - size, size[which]
        ends = np.cumsum(many)
        take = np.arange(int(ends[-1])) + np.repeat(begin[which] - (ends - many), many)
        return flat[take], np.append(0, ends)[np.searchsorted(at, off)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the ids stand for, and where each id's end."""
        size = self.size[ids]
        ends = np.cumsum(size)
        take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.first[ids] - (ends - size), size)
        return self.bytes[take], ends

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement marks."""
        raw = self.bytes_of(np.frombuffer(ids, "<u4"))[0].tobytes()
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin: at texts, and at spaces behind a character that is
    neither space nor mark.  (A mark in the text may begin a word inside a
    part; parts are cut again by their characters.)"""
    n = len(data)
    start = np.zeros(n + 1, bool)
    start[offsets] = True
    at = np.flatnonzero(data == 0x20)
    at = at[at > 0]
    at = at[data[at - 1] != 0x20]
    mark = (data[at - 1] == 0x81) & (data[np.maximum(at - 2, 0)] == 0x96) & (data[np.maximum(at - 3, 0)] == 0xE2)
    start[at[~mark]] = True
    start[n] = False
    return np.flatnonzero(start)


_made: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per Python worker and file."""
    if path not in _made:
        _made[path] = Transducer(path)
    return _made[path]


def encode(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``piece_ids`` (array of int).

    A null text has null ids, an empty one none; texts are encoded whole;
    repeated rows give equal ids; a column named piece_ids is replaced; an
    empty table gives an empty result."""
    c.prepare(docs.sparkSession)
    src = docs.drop("piece_ids")

    def run(batches):
        t = transducer(model)
        for b in c.slices(batches, text_col):
            col = c.column(b, text_col)
            flat, off = t.encode_all(col)
            ids = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat.astype(np.int32)), mask=col.is_null())
            yield pa.RecordBatch.from_arrays([*b.columns, ids], [*b.schema.names, "piece_ids"])
    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField("piece_ids", T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, model: str, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """All columns plus ``text_col``, the text of the ids.

    Null ids give a null text, no ids an empty one; null, negative and
    unknown ids inside an array are passed over."""
    c.prepare(docs.sparkSession)
    src = docs.drop(text_col)

    def run(batches):
        t = transducer(model)
        size = len(t.pieces)
        for b in batches:
            texts = [None if x is None else t.decode(np.array([i for i in x if i is not None and 0 <= i < size], "<u4").tobytes())
                     for x in c.column(b, ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, text_col])
    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField(text_col, T.StringType())]))


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of little-endian unsigned 32-bit ids),
    round_trip: whether the decoded ids are the text again (the piece mark
    in a text comes back as a space).  A null text counts as empty."""
    c.prepare(docs.sparkSession)

    def run(batches):
        t = transducer(model)
        for b in c.merged(batches, HELD_BYTES):
            texts = c.column(b, "text")
            flat, off = t.encode_all(texts)
            back, ends = t.bytes_of(flat)
            back, at = back.tobytes(), np.append(0, ends)[off]
            crc, same = [], []
            for x, lo, hi, i, j in zip(texts.to_pylist(), off[:-1].tolist(), off[1:].tolist(), at[:-1].tolist(), at[1:].tolist()):
                crc.append(zlib.crc32(flat[lo:hi].tobytes()))
                same.append(back[i + (back[i:i + 1] == b" " and j > i):j] == (x or "").replace(MARK, " ").encode())
            yield pa.RecordBatch.from_arrays([c.column(b, "doc_id"), pa.array(np.diff(off)), pa.array(crc, pa.int64()), pa.array(same)],
                                             ["doc_id", "n_ids", "ids_crc32", "round_trip"])
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
