"""Vector codes by ball k-means, in exact integers.

Vectors become integers floor(scale * x) and are cut into parts; every part
position has a codebook of its own.  A round assigns each part to its
nearest entry (squared Euclidean distance, ties to the lower index) and
moves each entry to the floor of its parts' mean.

From the second round on a part starts from the entry it has.  The members
of an entry are a ball with the largest member's distance as radius, taken
per batch of rows.  Only entries within twice the radius are neighbours of
the ball.  A ball that did not move and none of whose neighbours moved stays
as it is.  In any other ball, parts nearer than half the way to the nearest
neighbour are its stable core and stay; the rest lie in rings, each ring
reaching to the next neighbour's half way, and a part is compared with just
the neighbours of its ring, by the exact distance: an entry j is a candidate
of a part at distance d from entry a if |a - j|^2 <= 4 d^2, which by the
triangle inequality leaves out no entry as near as a.

A round is one pass: a task writes its rows with their new entries and, as
its last rows, its sums and counts per entry, into a table in the shared
folder.  The sums are added by Spark; parts * entries * length numbers reach
the driver and go back as the next codebooks, whatever the number of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from aerocast.llm import common as c

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
ROWS = 1 << 14              # rows that a task works on at once


def finite(col: str):
    """No null and nothing non-finite in a vector that is not null."""
    return F.col(col).isNotNull() & F.forall(
        col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def square(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows against entries.  Products go through
    doubles while every sum stays below 2**53, else through integers."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if x.shape[1] * (2 * top) ** 2 >= 1 << 62:
        raise ValueError("vector components are too large for exact 64-bit distances")
    if x.shape[1] * (2 * top) ** 2 < 1 << 53:
        x, book = x.astype(float), book.astype(float)
    return (square(x)[:, None] - 2 * (x @ book.T) + square(book)[None]).astype(np.int64)


class Book:
    """Entries of one part position with their mutual distances."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries = entries
        self.moved = np.ones(len(entries), bool) if before is None else (entries != before).any(axis=1)
        between = distances(entries, entries)
        np.fill_diagonal(between, -1)                   # an entry comes first among its own neighbours
        self.order = np.argsort(between, axis=1, kind="stable")
        self.between = np.take_along_axis(between, self.order, axis=1)
        self.computed = 0                               # distances of parts to entries, for tests

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each row, against all entries."""
        d = distances(x, self.entries)
        self.computed += d.size
        at = d.argmin(axis=1)
        return at, d[np.arange(len(x)), at]

    def reassign(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, from the entry that each row had."""
        at = at.copy()
        diff = x - self.entries[at]
        own = square(diff)
        self.computed += len(x)
        order = np.argsort(at, kind="stable")
        first = np.searchsorted(at[order], np.arange(len(self.entries) + 1))
        for a in range(len(self.entries)):
            ball = order[first[a]:first[a + 1]]
            if not len(ball):
                continue
            reach = self.between[a]
            n = int(np.searchsorted(reach, 4 * int(own[ball].max()), side="right"))     # itself and the ball's neighbours
            near = self.order[a, :n]
            if n == 1 or not self.moved[near].any():
                continue
            loose = ball[4 * own[ball] >= reach[1]]                                     # outside the stable core
            ring = np.searchsorted(reach[:n], 4 * own[loose], side="right")             # neighbours of each part's ring
            width = np.ceil(np.log2(np.maximum(ring, 1))).astype(int)
            for w in np.unique(width):                                                  # rings of similar width together
                here = width == w
                rows, many = loose[here], ring[here]
                cand = near[:many.max()]
                d = distances(x[rows], self.entries[cand])
                self.computed += d.size
                d[np.arange(len(cand))[None] >= many[:, None]] = np.iinfo(np.int64).max
                best = d.min(axis=1)
                at[rows] = np.where(d == best[:, None], cand[None], len(self.entries)).min(axis=1)
                own[rows] = best
        return at, own


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def _large(batches):
    """Batches put together to about ROWS rows."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= ROWS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _round(sent, dim: int, parts: int, names: list[str], schema: pa.Schema):
    """One pass: rows with their entries and distances, then the sums."""
    def run(batches):
        books = [Book(e, b) for e, b in sent.value]
        size, k = dim // parts, len(books[0].entries)
        sums, counts = np.zeros((parts, k, size), np.int64), np.zeros((parts, k), np.int64)
        for b in _large(batches):
            x = _matrix(c.column(b, "v"), dim)
            old = c.column(b, "at")
            had = old.flatten().to_numpy(zero_copy_only=False).reshape(-1, parts) if not old.null_count else None
            at, err = np.empty((len(x), parts), np.int64), np.zeros(len(x), np.int64)
            for p, book in enumerate(books):
                part = np.ascontiguousarray(x[:, p * size:(p + 1) * size])
                at[:, p], d = book.nearest(part) if had is None else book.reassign(part, had[:, p].astype(np.int64))
                err += d
                order = np.argsort(at[:, p], kind="stable")
                start = np.flatnonzero(np.append(True, np.diff(at[order, p]) != 0))
                sums[p, at[order[start], p]] += np.add.reduceat(part[order], start)
                counts[p] += np.bincount(at[:, p], minlength=k)
            cols = [c.column(b, n) for n in names]
            at = pa.ListArray.from_arrays(pa.array(np.arange(0, at.size + 1, parts, dtype=np.int32)), pa.array(at.ravel().astype(np.int32)))
            none = lambda t: pa.nulls(b.num_rows, t)
            yield pa.RecordBatch.from_arrays([*cols, c.column(b, "v"), at, pa.array(err), none(pa.int32()), none(pa.int32()),
                                              none(pa.list_(pa.int64())), none(pa.int64())], schema=schema)
        p, e = np.nonzero(counts)
        if len(p):
            total = sums[p, e]
            total = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, size, dtype=np.int32)), pa.array(total.ravel()))
            rest = [pa.nulls(len(p), schema.field(i).type) for i in range(len(names) + 3)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), total, pa.array(counts[p, e])],
                                             schema=schema)
    return run


def _first_books(rows: DataFrame, dim: int, parts: int, entries: int) -> list[np.ndarray]:
    ids = F.broadcast(rows.where("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(entries))
    first = rows.join(ids, "vec_id").groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").collect()
    whole = np.array([r.v for r in first], np.int64).reshape(-1, dim)
    return [np.ascontiguousarray(x) for x in np.split(whole, parts, axis=1)]


def _means(table: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Entries as floor(sum / count) of their parts; unused ones stay."""
    total = (table.where("part is not null").select("part", "entry", "n", F.posexplode("total").alias("pos", "x"))
             .groupBy("part", "entry", "pos").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")))
    out = [b.copy() for b in books]
    for r in total.toLocalIterator():
        out[r.part][r.entry, r.pos] = int(r.x) // r.n
    return out


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = ()) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): rows are vec_id, the columns named in ``keep``,
    code (array of entry numbers by part) and error (squared distances
    summed over the parts); a codebook is an array of integer entries.

    The codebooks start as the vectors of the smallest ids (of a repeated
    id the smallest vector; null ids start no entry); with fewer ids there
    are fewer entries.  Rows whose vector is null or holds nulls or
    non-finite components are left out.  The length of the smallest id's
    vector, a multiple of ``parts``, is the length of all; a vector of
    another length has null code and error.  Repeated rows count each;
    a table without a usable id gives no codebook and no code; an empty
    table an empty result.  Components must leave squared distances below
    2**62; larger ones raise."""
    spark = vectors.sparkSession
    c.prepare(spark)
    if not 0 < entries <= 256:
        raise ValueError("between 1 and 256 entries")
    names = ["vec_id", *keep]
    rows = (vectors.where(finite(vector_col))
            .select(F.col(id_col).cast("long").alias("vec_id"), *keep, F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v")))
    rows = c.stored(rows, "ball-vectors")
    start = rows.where("vec_id is not null").orderBy("vec_id", "v").select(F.size("v").alias("n")).first()
    nothing = rows.select(*names, F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
    if start is None or start.n == 0:
        return nothing, []
    dim = start.n
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    fits = F.size("v") == dim
    now = [(b, None) for b in _first_books(rows.where(fits), dim, parts, entries)]
    state = rows.where(fits).select(*names, "v", F.lit(None).cast("array<int>").alias("at"))
    shape = state.select("*", *(F.lit(None).cast(t).alias(n) for n, t in (
        ("error", "long"), ("part", "int"), ("entry", "int"), ("total", "array<long>"), ("n", "long")))).schema
    shape = T.StructType([T.StructField(f.name, f.dataType, True) for f in shape])
    fields = {"bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    table = rows
    for r in range(rounds + 1):
        sent = spark.sparkContext.broadcast(now)
        arrow = _arrow_schema(state, shape, fields)
        last, table = table, c.stored(state.mapInArrow(_round(sent, dim, parts, names, arrow), shape), f"ball-round-{r}")
        if r:
            c.discard(last)
        sent.unpersist()
        state = table.where("part is null").select(*names, "v", "at")
        if r < rounds:
            books = [b for b, _ in now]
            now = list(zip(_means(table, books), books))
    coded = table.where("part is null").select(*names, F.col("at").alias("code"), "error")
    return coded.union(nothing.where(~fits)), [b for b, _ in now]


def _arrow_schema(state: DataFrame, shape, fields: dict) -> pa.Schema:
    """Arrow types of a round's output; kept columns have those Spark sends."""
    from pyspark.sql.pandas.types import to_arrow_schema
    sent = to_arrow_schema(shape)
    return pa.schema([pa.field(f.name, fields.get(t.dataType.simpleString(), f.type)) for f, t in zip(sent, shape)])


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for e in b for x in e).encode()).hexdigest()


def hex_code(code: str = "code"):
    """Entry numbers as two hex digits each."""
    return F.when(F.col(code).isNotNull(), F.array_join(F.transform(code, lambda x: F.lpad(F.lower(F.hex(x.cast("long"))), 2, "0")), ""))
