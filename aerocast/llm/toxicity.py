"""Toxicity by a support vector machine over a gapped subsequence kernel
with Nyström landmarks.

A unit is a word, or a run of three and more spaced-out single letters put
together, in lower case, with a mark at either end.  The kernel counts common
subsequences of three bytes within a span of five, weighted by
DECAY**span in each string and divided by both norms: an insult with an
inserted or left-out character keeps most of its subsequences.

Training: units of a bounded sample of labelled texts that stand out in
toxic ones (likelihood ratio) against units of clean ones, then the
strongest units of clean texts as further negatives; Nyström features over
LANDMARKS units, squared-hinge SVM by Newton steps.  A text's score is
that of its strongest unit, calibrated by a logistic fit on the sample.

The kernel has an explicit feature map, so the decision
sum_j beta_j K(u, z_j) of all landmarks folds into one weight per
subsequence bucket: a table of 2**18 floats, which is what is sent to the
executors, whatever the corpus' size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from aerocast.llm import common as c
from aerocast.llm.labelled import logistic, remainder, sample, sigmoid

PER_CLASS = 4000        # labelled texts of each class that the fit reads at most
POSITIVES, NEGATIVES = 1500, 12000
LANDMARKS = 600
COST, NEG_COST = 3000.0, 3.0   # of the SVM's hinge, per class; of clean units against toxic ones
DECAY, SPAN = 0.7, 5
BUCKETS = 1 << 18
FIT_BLOCK = 1000        # units whose features the fit holds in full precision
SEEN = 0.004            # share of the toxic sample that has a unit, to count as positive
PIECE, STEP = 32, 24    # a longer word is scored in overlapping pieces

_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def units(col: pa.Array):
    """Lower-cased bytes, unit starts and ends, and units per text."""
    data, off = c.text_bytes(pc.utf8_lower(col.cast(pa.large_string())))
    s, e, first = c.word_spans(data, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    for _ in range(4):                          # marks around a word
        e = e - (_MARK[data[e - 1]] & (e - s > 1))
        s = s + (_MARK[data[s]] & (e - s > 1))
    single = (e - s) == 1
    if len(s):                                  # runs of single letters, as one unit more
        edge = np.ones(len(s) + 1, bool)
        edge[1:-1] = ~(single[1:] & single[:-1] & (doc[1:] == doc[:-1]))
        a = np.flatnonzero(edge)
        lo, hi = a[:-1], a[1:] - 1
        lo, hi = (x[(hi - lo) >= 2] for x in (lo, hi))
        if len(lo):                             # their letters, put together behind the text
            size = hi - lo + 1
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
            end = len(data) + np.cumsum(size)
            data = np.concatenate([data, data[s[at]]])
            s, e, doc = (np.concatenate(x) for x in ((s, end - size), (e, end), (doc, doc[lo])))
    n = np.where(e - s > PIECE + STEP // 2, -(-(e - s - PIECE) // STEP) + 1, 1)
    if (n > 1).any():
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        s, e, doc, m = (np.repeat(x, n) for x in (s, e, doc, n))
        s = s + k * STEP
        e = np.where(m > 1, np.minimum(e, s + PIECE), e)
    return data, s, e, doc


def subsequences(data: np.ndarray, s: np.ndarray, e: np.ndarray):
    """(bucket, unit, weight) of all gapped triples, and the units' norms: a
    triple that stands in a unit several times is one dimension."""
    n = e - s + 2
    end = np.cumsum(n)
    first = end - n
    code = np.zeros(int(end[-1]) if len(n) else 0, np.uint32)
    unit = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(code)) - first[unit]
    inner = (at > 0) & (at < n[unit] - 1)
    code[inner] = data[(s[unit] + at - 1)[inner]]
    code[at == 0], code[at == n[unit] - 1] = 1, 2
    left = n[unit] - at
    parts = []
    for b in range(2, SPAN):
        ok = np.flatnonzero(left > b)
        w = DECAY ** (b + 1)
        for a in range(1, b):
            with np.errstate(over="ignore"):
                x = code[ok] * np.uint32(0x01000193) ^ code[ok + a] * np.uint32(0x9E3779B1) ^ code[ok + b] * np.uint32(0x85EBCA77)
                x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            parts.append(((x >> np.uint32(14)).astype(np.int32), unit[ok], w))
    return parts, _norms(parts, len(n))


def _norms(parts, units: int) -> np.ndarray:
    """Square roots of the sums of squares over the buckets of each unit."""
    weights = np.array(sorted({w for _, _, w in parts}))
    key = np.sort(np.concatenate([((u.astype(np.int64) << 18) | x) << 3 | int(np.searchsorted(weights, w)) for x, u, w in parts]))
    out = np.zeros(units)
    if len(key):
        dim = key >> 3
        at = np.flatnonzero(np.append(True, dim[1:] != dim[:-1]))
        total = np.add.reduceat(weights[key & 7], at)
        out = np.bincount(dim[at] >> 18, weights=total * total, minlength=units)
    return np.sqrt(np.maximum(out, 1e-12))


def kernel(u: bytes, v: bytes) -> float:
    """K(u, v) of two units, by the feature map."""
    parts, norm = _matrix([u, v])
    sides = np.zeros((2, BUCKETS))
    for x, unit, w in parts:
        np.add.at(sides, (unit, x), w)
    return float(sides[0] @ sides[1] / (norm[0] * norm[1]))


def unit_scores(table: np.ndarray, data, s, e) -> np.ndarray:
    out = np.zeros(len(s))
    for i in range(0, len(s), SCORED_UNITS):
        some = slice(i, i + SCORED_UNITS)
        parts, norm = subsequences(data, s[some], e[some])
        total = out[some]
        for x, u, w in parts:
            total += w * np.bincount(u, weights=table[x], minlength=len(norm))
        total /= norm
    return out


SCORED_UNITS = 1 << 13  # whose subsequences are held at once
KNOWN = 50_000          # units of a generation whose score a task remembers


class Scores:
    """Scores of units by their hash, the recent ones remembered."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.new: dict[int, float] = {}
        self.old: dict[int, float] = {}

    def of(self, h: np.ndarray, data, s, e) -> np.ndarray:
        new, old = self.new, self.old
        out = np.array([new.get(x) or old.get(x) or np.nan for x in h.tolist()])
        todo = np.flatnonzero(np.isnan(out))
        if len(todo):
            out[todo] = unit_scores(self.table, data, s[todo], e[todo])
        new.update(zip(h.tolist(), out.tolist()))
        if len(new) > KNOWN:
            self.new, self.old = {}, new
        return out


def strongest(scores: Scores, col: pa.Array):
    """Per text the highest unit score (-inf without units), and that
    unit's bytes."""
    data, s, e, doc = units(col)
    best, what = np.full(len(col), -np.inf), [b""] * len(col)
    if len(s):
        h, at, back = np.unique(c.word_hashes(data, s, e), return_index=True, return_inverse=True)
        sc = scores.of(h, data, s[at], e[at])[back]
        order = np.lexsort((sc, doc))
        last = np.flatnonzero(np.append(doc[order][1:] != doc[order][:-1], True))
        for i in order[last]:
            best[doc[i]], what[doc[i]] = sc[i], data[s[i]:e[i]].tobytes()
    return best, what


_UNITS = "unit binary, y int, doc long"


@c.lean
def _unit_rows(batches):
    for b in c.slices(batches):
        data, s, e, doc = units(c.column(b, "text"))
        if not len(s):
            continue
        h = c.word_hashes(data, s, e)
        order = np.lexsort((h, doc))
        keep = np.append(True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1]))
        at = order[keep]
        yield pa.RecordBatch.from_arrays(
            [pa.array([data[x:y].tobytes() for x, y in zip(s[at], e[at])], pa.binary()),
             pa.array(c.longs(b, "y")[doc[at]].astype(np.int32)),
             pa.array(c.longs(b, "doc_id")[doc[at]])], ["unit", "y", "doc"])


def _matrix(words: list[bytes]) -> tuple[np.ndarray, list]:
    data = np.frombuffer(b"".join(words), np.uint8)
    e = np.cumsum([len(w) for w in words])
    s = e - np.array([len(w) for w in words])
    return subsequences(data, s, e)


def _against(words: list[bytes], row_of: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Kernel of words with landmarks.  dense: one row for each bucket the
    landmarks have (row_of gives it), a column for each landmark."""
    out = np.zeros((len(words), dense.shape[1]), np.float32)
    for i in range(0, len(words), 200):
        parts, norm = _matrix(words[i:i + 200])
        for x, u, w in parts:
            r = row_of[x]
            u, r = u[r > 0], r[r > 0]
            if len(u):
                at = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
                out[i + u[at]] += np.float32(w) * np.add.reduceat(dense[r], at)
        out[i:i + 200] /= norm[:, None]
    return out


def _svm(pos: list[bytes], neg: list[bytes]) -> np.ndarray:
    """Weight per subsequence bucket."""
    marks = pos[:LANDMARKS // 2] + neg[:LANDMARKS - min(len(pos), LANDMARKS // 2)]
    parts, norm = _matrix(marks)
    used = np.unique(np.concatenate([x for x, _, _ in parts]))
    row_of = np.zeros(BUCKETS, np.int32)
    row_of[used] = np.arange(1, len(used) + 1)
    dense = np.zeros((len(used) + 1, len(marks)), np.float32)
    for x, u, w in parts:
        np.add.at(dense, (row_of[x], u), w / norm[u])
    kmm = _against(marks, row_of, dense).astype(float)
    lam, vec = np.linalg.eigh((kmm + kmm.T) / 2)
    keep = lam > 1e-5 * lam.max()
    half = vec[:, keep] / np.sqrt(lam[keep])
    words = pos + neg
    y = np.array([1.0] * len(pos) + [-1.0] * len(neg))
    cost = np.where(y > 0, COST / len(pos), COST * NEG_COST / len(neg))
    k = half.shape[1] + 1
    x = np.ones((len(words), k), np.float32)            # the only table of all units
    blocks = [slice(i, i + FIT_BLOCK) for i in range(0, len(words), FIT_BLOCK)]
    for b in blocks:
        x[b, :-1] = _against(words[b], row_of, dense) @ half
    v, reg = np.zeros(k), np.eye(k)
    reg[-1, -1] = 1e-3
    for _ in range(12):
        gram, right = reg.copy(), np.zeros(k)
        for b in blocks:                                # Gram matrix of the active units
            xb = x[b].astype(float)
            act = y[b] * (xb @ v) < 1
            xa = xb[act] * cost[b][act][:, None]
            gram += xa.T @ xb[act]
            right += xa.T @ y[b][act]
        new = np.linalg.solve(gram, right)
        done = np.abs(new - v).max() < 1e-6
        v = new
        if done:
            break
    # the intercept shifts every unit's score alike; the calibration has its own
    table = np.zeros(BUCKETS, np.float32)
    table[used] = dense[1:] @ (half @ v[:-1])
    return table


def cover(having: dict[bytes, set], least: int) -> list[bytes]:
    """Units that explain the toxic texts: again and again the one in most
    texts not yet explained, so that a copied text's other words, which
    stand out as well, are not taken."""
    left, out = {u: set(d) for u, d in having.items()}, []
    while left:
        u = max(sorted(left), key=lambda x: len(left[x]))
        if len(left[u]) < least:
            break
        gone = left.pop(u)
        out.append(u)
        left = {x: r for x, d in left.items() if len(r := d - gone) >= least}
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable=None, per_class: int = PER_CLASS):
    """(table, a, b) for score = sigmoid(a * strongest unit + b), or None
    where the sample lacks a class or no unit stands out."""
    c.prepare(docs.sparkSession)
    usable = F.coalesce(remainder(5) != 0, F.lit(False)) if usable is None else usable
    rows = c.stored(sample(docs, labels, label, usable, per_class), "toxicity-sample")
    size = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if not size.get(0) or not size.get(1):
        return None
    n1, n0 = float(size[1]), float(size[0])
    seen = c.stored(rows.mapInArrow(_unit_rows, _UNITS).groupBy("unit")
                    .agg(F.sum("y").cast("double").alias("p"), F.sum(1 - F.col("y")).cast("double").alias("q")), "toxicity-units")
    xlog = lambda k, m: F.when(k > 0, k * F.log(k / m)).otherwise(0.0)
    t = F.col("p") + F.col("q")
    g2 = 2 * (xlog(F.col("p"), t * n1 / (n1 + n0)) + xlog(F.col("q"), t * n0 / (n1 + n0)))
    few = max(2, int(SEEN * n1))
    likely = (seen.where((g2 > 15) & (F.col("p") >= few) & (F.col("p") / n1 > 20 * F.col("q") / n0))
              .orderBy(F.desc("p"), "unit").limit(POSITIVES).select("unit"))
    having: dict[bytes, set] = {}
    for r in rows.where("y = 1").mapInArrow(_unit_rows, _UNITS).join(F.broadcast(likely), "unit").select("unit", "doc").collect():
        having.setdefault(bytes(r.unit), set()).add(r.doc)
    pos = cover(having, few)
    if not pos:
        return None
    clean = seen.where("q > 0").where(F.col("p") / n1 < 3 * F.col("q") / n0)
    neg = [bytes(r.unit) for part in (clean.orderBy(F.desc("q"), "unit"), clean.orderBy(F.xxhash64("unit")))
           for r in part.limit(NEGATIVES // 2).select("unit").collect()]
    spark = docs.sparkSession
    for _ in range(2):
        table = _svm(pos, neg)
        best = _best(spark, rows, table)
        neg = [w for w, s in {w: s for s, w, y in best if y == 0 and w}.items()] + neg
    table = _svm(pos, neg)
    best = _best(spark, rows, table)
    s, y = np.array([x[0] for x in best]), np.array([x[2] for x in best])
    ok = np.isfinite(s)
    a, b = logistic(s[ok][:, None], y[ok])
    return table, float(a), float(b)


def _best(spark, rows: DataFrame, table: np.ndarray):
    """Strongest units of the (bounded) sample."""
    tb = spark.sparkContext.broadcast(table)

    @c.lean
    def run(batches):
        scores = Scores(tb.value)
        for b in c.slices(batches):
            s, w = strongest(scores, c.column(b, "text"))
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(w, pa.binary()), c.column(b, "y")], ["s", "w", "y"])
    out = [(r.s, bytes(r.w), r.y) for r in rows.mapInArrow(run, "s double, w binary, y int").collect()]
    tb.destroy()
    return out


def score(docs: DataFrame, model) -> DataFrame:
    """All columns of ``docs`` plus ``toxicity_score`` in 0 to 1.

    A null or empty text, and every text if there is no model, scores 0.
    Texts are read whole; repeated rows get equal scores; columns other
    than ``text`` are never inputs."""
    spark = docs.sparkSession
    c.prepare(spark)
    rest = [x for x in docs.columns if x != "toxicity_score"]
    src = docs.select(*rest)
    if model is None:
        return src.withColumn("toxicity_score", F.lit(0.0))
    mb = spark.sparkContext.broadcast(model)

    @c.lean
    def run(batches):
        table, a, b0 = mb.value
        scores = Scores(table)
        for b in c.slices(batches):
            s, _ = strongest(scores, c.column(b, "text"))
            out = np.where(np.isfinite(s), sigmoid(a * np.where(np.isfinite(s), s, 0) + b0), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, "toxicity_score"])
    return src.mapInArrow(run, src.withColumn("toxicity_score", F.lit(0.0)).schema)
