"""Packing of documents into sequences by best-fit decreasing.

Each document's ids are cut into full windows and a remainder.  A full
window is a sequence of its own.  The remainders are dealt at random into
shards of about SHARD_PIECES, whose number grows with the data; in each
shard they are placed in order of decreasing length into the open window
with the least sufficient room, found in a segment tree over the room
left.  A shard of that size leaves next to no padding, and needs memory
for its few numbers per piece only: ids never leave the task that made
them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aerocast.llm import common as c
from aerocast.llm.bytebpe import ids_for

SHARD_PIECES = 1 << 15
HELD_BYTES = 2 << 20        # of texts that a task encodes at once
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class RoomTree:
    """Open windows by room left; finds the least room that is enough."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, seq: int) -> None:
        self.open[room].append(seq)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(sequence, room) of a tightest window with room >= need."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        while i:
            self.count[i] -= 1
            i >>= 1
        return self.open[room].pop(), room


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece; lengths in decreasing order."""
    tree, seqs, offsets, n = RoomTree(window), [], [], 0
    for x in lengths:
        got = tree.take(x)
        if got is None:
            got, n = (n, window), n + 1
        seqs.append(got[0])
        offsets.append(window - got[1])
        if got[1] > x:
            tree.add(got[1] - x, got[0])
    return seqs, offsets


def _pieces(path: str, end_id: int, window: int):
    @c.lean
    def run(batches):
        ids = ids_for(path)
        end = np.array([end_id], "<u4")
        for b in c.merged(batches, HELD_BYTES):
            flat, off = ids.encode_all(c.column(b, "text"))
            rows = []
            for did, lo, hi in zip(c.column(b, "doc_id").to_pylist(), off[:-1].tolist(), off[1:].tolist()):
                x = memoryview(np.concatenate([flat[lo:hi], end]).tobytes())
                n = len(x) // 4
                for s in range(0, n, window):
                    part = x[4 * s:4 * (s + window)]
                    rows.append((did, s, len(part) // 4, zlib.crc32(part), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in zip(*rows)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def _place(window: int):
    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        seqs, offsets = best_fit(p["length"].tolist(), window)
        return p.assign(sequence_id=(p["shard"].to_numpy(np.int64) << 32) + np.array(seqs, np.int64), offset=offsets).drop(columns="shard")
    return run


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A null or empty text is the end id alone; a null id stays null;
    repeated rows are packed each; a text of any length is cut into full
    windows and one remainder; other columns are ignored; an empty table
    gives an empty result.  Sequence ids are unique: full windows count
    down from -1, shared sequences from 0 up.
    """
    spark = docs.sparkSession
    c.prepare(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = c.stored(src.mapInArrow(_pieces(tokenizer, end_id, window), _PIECES), "packing-pieces")
    row = F.monotonically_increasing_id()
    full = (pieces.where(F.col("length") == window)
            .withColumn("sequence_id", -row - 1).withColumn("offset", F.lit(0).cast("long")))
    rest = pieces.where(F.col("length") < window)
    shards = max(1, -(-rest.count() // SHARD_PIECES))
    dealt = rest.withColumn("shard", F.pmod(F.xxhash64(row), F.lit(shards)).cast("long"))
    placed = dealt.groupBy("shard").applyInPandas(_place(window), _PIECES + ", sequence_id long, offset long")
    return full.union(placed)
