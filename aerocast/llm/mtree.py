"""Exact top-k by inner product with M-trees searched best first.

Components become integers floor(scale * x).  With R the largest norm of a
block, a row x gets one component more, sqrt(R**2 - |x|**2), and a query q
a zero: then |q - x|**2 = |q|**2 + R**2 - 2 q.x, so that the largest inner
products are the smallest Euclidean distances, a metric.

Every block of rows (dealt at random, of bounded size) has an M-tree of its
own over its distinct vectors, each with the ids of all its rows: pages of
at most FANOUT routing objects with covering radius and distance to their
parent, leaves of at most LEAF vectors with their distance to the leaf's
routing object.  Without copies any two routing objects part a page, so
every radius is that of the vectors below it.  A query takes pages from a
queue by the least distance they can hold.  By the triangle inequality the
stored distances tell entries that are too far without computing their
distance.  Scores are exact integers (doubles while every sum stays below
2**53, else 64-bit integers); a bound prunes only beyond what rounding can
do, so no row is lost, nor a tie.  The queries stream past each block's
tree, and the k best of the blocks are merged.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aerocast.llm import common as c
from aerocast.llm.ann import blocked, merged, streamed, valid

FANOUT, LEAF = 16, 256


class Page:
    """Routing objects (rows of ``at``) with radii, distances to the parent
    and child pages; or, in a leaf, rows with their distance to the parent."""
    __slots__ = ("at", "far", "radius", "child", "x")

    def __init__(self, x, at, far, radius=None, child=None):
        self.at, self.far, self.radius, self.child = at, far, radius, child
        self.x = x[at]                          # the page's own vectors, side by side


def _dist(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = x - p
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def build(x: np.ndarray, rows: np.ndarray, far: np.ndarray, rng) -> Page:
    """Page over ``rows``, all different; far: their distance to the routing
    object above."""
    if len(rows) <= LEAF:
        return Page(x, rows, far)
    part = x[rows]
    own = np.full(len(rows), np.inf)
    of = np.zeros(len(rows), np.int64)
    routes: list[int] = []
    for pick in rng.choice(len(rows), min(FANOUT, -(-2 * len(rows) // LEAF)), replace=False).tolist():
        d = _dist(part, part[pick])
        nearer = d < own
        own[nearer], of[nearer] = d[nearer], len(routes)
        routes.append(pick)
    at, fars, radius, child = [], [], [], []
    for k, r in enumerate(routes):
        mine = np.flatnonzero(of == k)
        if len(mine):
            at.append(rows[r])
            fars.append(far[r])
            radius.append(own[mine].max())
            child.append(build(x, rows[mine], own[mine], rng))
    return Page(x, np.array(at), np.array(fars), np.array(radius), child)


class MTree:
    def __init__(self, v: np.ndarray, ids: np.ndarray):
        """v: integer vectors."""
        code, _ = pd.factorize(np.array([r.tobytes() for r in v], object))
        order = np.lexsort((ids, code))
        start = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
        v = v[order[start]]
        self.v, self.ids = v, np.split(ids[order], start[1:])   # ids of each distinct vector, ascending
        norm2 = np.einsum("ij,ij->i", v.astype(float), v.astype(float))
        self.big = int(np.abs(v).max(initial=0))
        self.top = float(norm2.max())
        self.x = np.column_stack([v, np.sqrt(self.top - norm2)])
        self.root = build(self.x, np.arange(len(v)), np.zeros(len(v)), np.random.default_rng(0))
        self.computed = 0

    def search(self, q: np.ndarray, k: int, skip: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, id) of integer vector q, best first, ties to
        the smaller id; the row whose id is ``skip`` left out."""
        qx = np.append(q, 0).astype(float)
        base = float(np.sum(q.astype(float) ** 2)) + self.top
        room = 1 + base * 2.0 ** -40            # more than the distances' rounding
        largest = len(q) * int(np.abs(q).max(initial=0)) * self.big
        if largest >= 1 << 63:
            raise ValueError("vector components are too large for 64-bit scores")
        best: list[tuple[int, int]] = []        # heap of (score, -id): the worst on top
        limit = np.inf                          # distance beyond which nothing is needed
        queue = [(0.0, 0, self.root, None)]     # least distance, number, page, distance to its routing object
        number = 0
        while queue:
            least, _, page, above = heapq.heappop(queue)
            if least > limit:
                break
            at, x, radius, rows = page.at, page.x, page.radius, None
            if above is not None and limit < np.inf:
                ok = np.abs(above - page.far) <= (limit if radius is None else limit + radius)
                if not ok.all():
                    rows = np.flatnonzero(ok)
                    if not len(rows):
                        continue
                    at, x = at[rows], x[rows]
                    radius = radius if radius is None else radius[rows]
            self.computed += len(at)
            if radius is None:
                score = x @ qx if largest < 1 << 53 else self.v[at] @ q
                if len(best) == k:
                    good = np.flatnonzero(score >= best[0][0])
                    at, score = at[good], score[good]
                elif len(score) > k:            # of a first page only what can be among its k best
                    good = np.flatnonzero(score >= np.partition(score, -k - 1)[-k - 1])
                    at, score = at[good], score[good]
                for s, r in zip(score.astype(np.int64).tolist(), at.tolist()):
                    for i in map(int, self.ids[r]):
                        if i == skip:
                            continue
                        if len(best) < k:
                            heapq.heappush(best, (s, -i))
                        elif (s, -i) > best[0]:
                            heapq.heapreplace(best, (s, -i))
                        else:
                            break               # the other ids are larger
                if len(best) == k:
                    limit = np.sqrt(max(0.0, base - 2 * best[0][0] + room))
            else:
                d = _dist(x, qx)
                near = np.maximum(d - radius, 0)
                for r, n, dist in zip(range(len(d)) if rows is None else rows.tolist(), near.tolist(), d.tolist()):
                    if n <= limit:
                        number += 1
                        heapq.heappush(queue, (n, number, page.child[r], dist))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _answer(k: int):
    def answer(tree: MTree, qids: np.ndarray, q: np.ndarray) -> list[tuple]:
        return [(qid, i, s) for qid, v in zip(qids.tolist(), q) for s, i in tree.search(v, k, qid)]
    return answer


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k largest integer
    inner products, itself (by id) left out, ties to the smaller id.

    Vectors that are null, empty or hold nulls or non-finite values and rows
    with a null id take no part; vectors of another length than the query's
    are not compared; fewer than k rows give what there is; a repeated row
    counts as often as it occurs, but a query id asks once, with the smallest
    of its vectors; scores must stay below 2**63 (larger components raise);
    other columns are ignored; empty tables give an empty result."""
    c.prepare(vectors.sparkSession)

    def usable(df):
        return (df.where(F.col(id_col).isNotNull() & valid(vector_col))
                .select(F.col(id_col).cast("long").alias("vec_id"),
                        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v")))
    found = blocked(usable(vectors), usable(queries)).mapInArrow(
        streamed(lambda ids, x: MTree(x, ids), _answer(k), np.int64, pa.schema([(n, pa.int64()) for n in ("query_id", "vec_id", "score")])),
        "query_id long, vec_id long, score long")
    return merged(found, k, "score")
