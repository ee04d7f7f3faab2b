"""Nearest neighbours by a block matrix join.

Vectors are scaled to unit length and quantised to int8 with a scale of
their own.  Blocks of rows meet the queries tile by tile; the product of two
int8 tiles (as exact integers) bounds every cosine from both sides by the
quantisation errors.  A pair whose upper bound is below the k-th largest
lower bound of its query in the tile, or below the k-th best cosine that the
query has already, cannot be among the k nearest and goes; the rest are
recomputed in double precision from the original vectors, and a heap of k
per query merges the tiles.  The result is exact.

Rows are dealt at random into blocks of about BLOCK, each to one task, which
quantises it once; the queries, sorted behind the block's rows, stream past
in batches.  A row is shuffled once, a query once per block; memory holds
one block and one batch, and a frequent vector spreads over all blocks.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from aerocast.llm import common as c

BLOCK, BLOCK_BYTES, TILE = 1 << 15, 64 << 20, 2048

#: Conditions on a vector column: no nulls, nothing non-finite.
def valid(col: str):
    return (F.col(col).isNotNull() & (F.size(col) > 0)
            & F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))))


def blocks(df: DataFrame, rows: int, least: int = 1):
    """(number of blocks, block of a row): random, of about ``rows``."""
    n = max(least, -(-df.count() // rows))
    return n, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")


def blocked(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """(rb, kind, vec_id, v): blocks of rows (kind 0), each followed by all
    queries (kind 1).  An id that stands in several rows asks once, with its
    smallest vector."""
    par = rows.sparkSession.sparkContext.defaultParallelism
    rows = c.stored(rows, "vectors")
    queries = c.stored(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "query-vectors")
    widest = rows.agg(F.max(F.size("v"))).first()[0] or 1
    nr, rb = blocks(rows, max(TILE, min(BLOCK, BLOCK_BYTES // (8 * widest))), par)
    rows = rows.select(rb.alias("rb"), F.lit(0).alias("kind"), "vec_id", "v")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(nr - 1))).alias("rb"), F.lit(1).alias("kind"), "vec_id", "v")
    return rows.union(asked).repartition("rb").sortWithinPartitions("rb", "kind")


def by_length(b: pa.RecordBatch, dtype) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length of the vectors → (ids, matrix)."""
    v, ids = c.column(b, "v"), c.longs(b, "vec_id")
    size = np.diff(v.offsets.to_numpy())
    flat = v.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(size) - size
    return {int(n): (ids[size == n], flat[first[size == n][:, None] + np.arange(n)].astype(dtype)) for n in np.unique(size)}


def streamed(prepare, answer, dtype, schema: pa.Schema):
    """A function for mapInArrow over ``blocked``: ``prepare(ids, matrix)``
    once for each block and vector length, then ``answer(prepared, ids,
    matrix)`` gives the rows for a batch of queries."""
    def run(batches):
        block, held, ready = None, [], None
        for b in batches:
            at, kind = c.longs(b, "rb"), c.longs(b, "kind")
            edge = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (kind[1:] != kind[:-1]))) if len(at) else []
            for i, j in zip(edge, np.append(edge[1:], len(at))):
                part = b.slice(int(i), int(j - i))
                if at[i] != block:
                    block, held, ready = at[i], [], None
                if kind[i] == 0:
                    held.append(part)
                    continue
                if ready is None:
                    whole = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
                    ready = {n: prepare(*x) for n, x in by_length(whole[0], dtype).items()} if whole else {}
                    held = []
                for n, (ids, q) in by_length(part, dtype).items():
                    out = answer(ready[n], ids, q) if n in ready else []
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
    return run


def merged(found: DataFrame, k: int, value: str) -> DataFrame:
    """The k best of each query over all blocks, ties to the smaller id; a
    task keeps no more than k rows of a query before the shuffle."""
    best = Window.partitionBy("query_id").orderBy(F.desc(value), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", value))


def quantised(unit: np.ndarray):
    """int8 values (as floats that hold sums of their products exactly),
    scales and error norms of unit vectors."""
    scale = np.maximum(np.abs(unit).max(axis=1), 1e-300) / 127
    q = np.rint(unit / scale[:, None])
    err = np.linalg.norm(unit - q * scale[:, None], axis=1)
    return q.astype(np.float32 if 127 * 127 * unit.shape[1] < 1 << 24 else float), scale, err


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of a with rows of b, pair by pair; sums run from the
    first component to the last, so that every engine can repeat them."""
    def total(x):
        return np.cumsum(x, axis=1)[:, -1]
    return total(a * b) / np.sqrt(total(a * a) * total(b * b))


def _prepare(ids: np.ndarray, x: np.ndarray):
    return ids, x, quantised(x / np.linalg.norm(x, axis=1)[:, None])


def _answer(k: int):
    def answer(block, qids: np.ndarray, y: np.ndarray) -> list[tuple]:
        ids, x, (qx, sx, ex) = block
        qy, sy, ey = quantised(y / np.linalg.norm(y, axis=1)[:, None])
        heaps: list[list] = [[] for _ in qids]              # (cosine, -id): the worst on top
        floor = np.full(len(qids), -np.inf)                 # the k-th best cosine so far
        slack = 1e-9
        for i in range(0, len(x), TILE):
            t = slice(i, i + TILE)
            est = (qy @ qx[t].T).astype(float) * sy[:, None] * sx[None, t]
            # |u.v - u'.v'| <= |u - u'| + |v - v'| * |u'|, and |u'| <= 1 + |u - u'|
            err = ey[:, None] + ex[None, t] * (1 + ey[:, None]) + slack
            self_ = qids[:, None] == ids[None, t]
            low = np.where(self_, -np.inf, est - err)
            if low.shape[1] > k:
                floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
            a, b = np.nonzero((est + err >= floor[:, None]) & ~self_)
            for q, score, i_ in zip(a.tolist(), cosines(y[a], x[t][b]).tolist(), ids[t][b].tolist()):
                heap = heaps[q]
                if len(heap) < k:
                    heapq.heappush(heap, (score, -i_))
                elif (score, -i_) > heap[0]:
                    heapq.heapreplace(heap, (score, -i_))
                if len(heap) == k:
                    floor[q] = max(floor[q], heap[0][0])
        return [(q, -i_, score) for q, heap in zip(qids.tolist(), heaps) for score, i_ in heap]
    return answer


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k rows of largest
    cosine, itself (by id) left out, ties to the smaller id.

    Vectors that are null, empty, zero or hold nulls or non-finite values
    and rows with a null id take no part; vectors of another length than the
    query's are not compared; fewer than k rows give what there is; a
    repeated row counts as often as it occurs, but a query id asks once, with
    the smallest of its vectors; other columns are ignored; empty tables give
    an empty result."""
    c.prepare(vectors.sparkSession)

    def usable(df):
        return (df.where(F.col(id_col).isNotNull() & valid(vector_col) & F.exists(vector_col, lambda x: x != 0))
                .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")))
    found = blocked(usable(vectors), usable(queries)).mapInArrow(
        streamed(_prepare, _answer(k), float, pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])),
        "query_id long, vec_id long, score double")
    return merged(found, k, "score")
