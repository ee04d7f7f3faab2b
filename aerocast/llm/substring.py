"""Substring dedup by De Bruijn compaction.

Edges are windows of WINDOW words, nodes their overlaps.  A run of
successive windows with the same minimizer (the leftmost smallest hash of
MIN_WORDS words inside a window) is a nonbranching path of one document; its edges
are written as one row: minimizer, hash of the whole run's words, source
coordinates, number of windows.  Equal windows have equal minimizers, so
rows of one minimizer meet in one partition of one shuffle:

- runs with equal words compact to one path, of which all occurrences but
  the first are repeats;
- a minimizer with several different runs is where paths branch: the first
  occurrence of each is expanded to its windows from the source text, and
  these are compared one by one (minimizer and window hash, 128 bits).

Rows of the same path in one task meet there before the shuffle, so a
passage that a third of all documents share sends a row per task, and the
sorted partitions are scanned as streams, never held.  Spans go back to
their texts by id; texts without repeats are not shuffled while the key
table is small enough to broadcast.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aerocast.llm import common as c
from aerocast.llm.lines import _SHIFT, keyed

WINDOW, MIN_WORDS = 20, 6
LOCAL_RUNS = 1 << 19    # runs that one task compares before the shuffle

_RUN = "mkey long, whash long, did long, pos long, n int, known boolean"
_SPAN = "mkey long, did long, pos long, n int, again boolean"


def _minimizers(g: np.ndarray, w: int) -> np.ndarray:
    """Place of the leftmost minimum of every w neighbours."""
    at, have = np.arange(len(g)), 1
    while have < w:
        step = min(have, w - have)
        x, y = at[:len(at) - step], at[step:]
        at = np.where(g[x] <= g[y], x, y)
        have += step
    return at


def runs(wh: np.ndarray, first: np.ndarray, k: int, m: int):
    """Text, start, number of windows, minimizer and words' hash of each
    run; wh: word hashes, first: index of each text's first word."""
    nw = np.diff(first)
    if len(wh) < k:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    at = np.arange(len(wh) - m + 1)
    g = c.range_hash(wh, at, at + m)
    low = _minimizers(g, k - m + 1)             # windows that straddle texts are left out below
    doc = np.repeat(np.arange(len(nw)), nw)[:len(low)]
    at = np.arange(len(low))
    ok = at + k <= first[1:][doc]
    edge = ok.copy()
    edge[1:] &= ~ok[:-1] | (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    s = np.flatnonzero(edge)
    stop = np.flatnonzero(ok & np.append(~ok[1:] | edge[1:], True)) + 1
    n = stop - s
    return doc[s], s - first[:-1][doc[s]], n, g[low[s]], c.range_hash(wh, s, stop + k - 1)


def _same_place(same, did, pos, first):
    """Whether a row stands where the first row of its key does: a repeated
    table row is the same occurrence, not a later one.  same: rows that
    share the key of the row before; first: (did, pos) of the key that
    goes on from the batch before, if any."""
    at = np.maximum.accumulate(np.where(same, -1, np.arange(len(same))))
    fd, fp = did[at], pos[at]
    if first is not None:
        fd, fp = np.where(at < 0, first[0], fd), np.where(at < 0, first[1], fp)
    return same & (did == fd) & (pos == fp)


def _local(held: list):
    """Held rows as one batch; what repeats a row of this batch is marked."""
    mk, wh, did, pos, n = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((pos, did, wh, mk))
    a, b = mk[order], wh[order]
    again = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1])) if len(a) else np.zeros(0, bool)
    order = order[~_same_place(again, did[order], pos[order], None)]
    a, b = mk[order], wh[order]
    again = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1])) if len(a) else np.zeros(0, bool)
    # a known repeat needs no comparison: it travels under a key of its own place
    mk = np.where(again, c.mix(pos.astype(np.uint64) + did.astype(np.uint64)).view(np.int64)[order], mk[order])
    return pa.RecordBatch.from_arrays(
        [pa.array(mk), pa.array(wh[order]), pa.array(did[order]), pa.array(pos[order]),
         pa.array(n[order].astype(np.int32)), pa.array(again)], ["mkey", "whash", "did", "pos", "n", "known"])


def _paths(k: int, m: int):
    def run(batches):
        held, size = [], 0
        for b in c.slices(batches):
            data, off = c.text_bytes(c.column(b, "text"))
            s, e, first = c.word_spans(data, off)
            doc, at, n, mk, wh = runs(c.word_hashes(data, s, e), first, k, m)
            held.append((c.i64(mk), c.i64(wh), c.longs(b, "did")[doc], (c.longs(b, "tag")[doc] << _SHIFT) + at, n))
            size += len(n)
            if size >= LOCAL_RUNS:
                yield _local(held)
                held, size = [], 0
        if size:
            yield _local(held)
    return run


def _scan(batches):
    """Rows sorted by (mkey, whash, did, pos), known ones apart: repeats of
    the row before them, and of branching minimizers the firsts.  What is
    carried from batch to batch is one row."""
    last = first = pending = None               # last row's key, its first place, a first not yet known to branch
    for b in batches:
        known = c.column(b, "known").to_numpy(zero_copy_only=False)
        mk, wh, did, pos, n = (c.longs(b, x) for x in ("mkey", "whash", "did", "pos", "n"))
        out = [[(mk[known], did[known], pos[known], n[known], np.ones(int(known.sum()), bool))]]
        mk, wh, did, pos, n = (x[~known] for x in (mk, wh, did, pos, n))
        if len(mk):
            pm, pw = np.append(mk[0], mk[:-1]), np.append(wh[0], wh[:-1])
            if last is None:
                same_m, same = np.zeros(len(mk), bool), np.zeros(len(mk), bool)
                same_m[1:], same[1:] = mk[1:] == pm[1:], (mk[1:] == pm[1:]) & (wh[1:] == pw[1:])
            else:
                pm[0], pw[0] = last
                same_m, same = mk == pm, (mk == pm) & (wh == pw)
            again = same & ~_same_place(same, did, pos, first)
            out.append([(mk[again], did[again], pos[again], n[again], np.ones(int(again.sum()), bool))])
            # groups of firsts: a first whose minimizer has another first is to be expanded
            f = np.flatnonzero(~same)
            group = np.cumsum(~same_m)
            count = np.bincount(group[f], minlength=group[-1] + 1)
            many = count[group[f]] > 1
            if group[0] == 0:                   # the batch goes on with the minimizer of the one before
                head = group[f] == 0
                many[head] = True
                if pending is not None and head.any():
                    out.append([pending])
                    pending = None
            if group[-1] > 0:                   # the last minimizer may go on in the next batch
                pending = None
                if count[group[-1]] == 1:
                    i = f[-1]
                    pending = (mk[i:i + 1], did[i:i + 1], pos[i:i + 1], n[i:i + 1], np.zeros(1, bool))
            x = f[many]
            out.append([(mk[x], did[x], pos[x], n[x], np.zeros(len(x), bool))])
            last = (mk[-1], wh[-1])
            if not same.all():
                i = np.flatnonzero(~same)[-1]
                first = (did[i], pos[i])
        cols = [np.concatenate(x) for x in zip(*[r for part in out for r in part])]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2]),
                                          pa.array(cols[3].astype(np.int32)), pa.array(cols[4])],
                                         ["mkey", "did", "pos", "n", "again"])


def _windows(k: int):
    """The windows of a text's branching runs, one row each."""
    mask = (1 << _SHIFT) - 1

    def run(batches):
        held, size = [], 0
        for b in c.slices(batches):
            data, off = c.text_bytes(c.column(b, "text"))
            s, e, first = c.word_spans(data, off)
            wh = c.word_hashes(data, s, e)
            want = c.column(b, "want")
            per = np.diff(want.offsets.to_numpy())
            w = want.flatten()
            mk, pos, n = (w.field(x).to_numpy(zero_copy_only=False) for x in ("mkey", "pos", "n"))
            doc = np.repeat(np.arange(len(per)), per)
            i = np.repeat(np.arange(len(n)), n)
            pos = pos[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            doc = doc[i]
            at = first[:-1][doc] + (pos & mask)
            held.append((mk[i], c.i64(c.range_hash(wh, at, at + k)), c.longs(b, "did")[doc], pos, np.ones(len(i), np.int64)))
            size += len(i)
            if size >= LOCAL_RUNS:
                yield _local(held)
                held, size = [], 0
        if size:
            yield _local(held)
    return run


def _by_key(rows: DataFrame, *keys: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, *keys).sortWithinPartitions("mkey", "whash", "did", "pos").mapInArrow(_scan, _SPAN))


def repeated_spans(src: DataFrame, k: int = WINDOW, m: int = MIN_WORDS) -> DataFrame:
    """(did, tag, spans): runs of windows that occur earlier, as first word
    and number of windows; src has did, tag, text."""
    spans = c.stored(_by_key(src.mapInArrow(_paths(k, m), _RUN), "mkey"), "substring-paths")
    on = ["did", "tag"]
    tag = F.shiftrightunsigned("pos", _SHIFT).alias("tag")
    want = c.stored(spans.where("not again").groupBy("did", tag)
                    .agg(F.collect_list(F.struct("mkey", "pos", "n")).alias("want")), "substring-branches")
    texts = c.semi_by(src, want.select(*on), on).join(want, on).select("did", "text", "want")
    again = c.stored(_by_key(texts.mapInArrow(_windows(k), _RUN), "mkey", "whash").where("again"), "substring-windows")
    return (spans.where("again").union(again).groupBy("did", tag)
            .agg(F.collect_list(F.struct("pos", "n")).alias("spans")))


def _cut(k: int):
    mask = (1 << _SHIFT) - 1

    def run(batches):
        for b in c.slices(batches):
            data, off = c.text_bytes(c.column(b, "text"))
            s, e, first = c.word_spans(data, off)
            raw = data.tobytes()
            spans = c.column(b, "spans").to_pylist() if "spans" in b.schema.names else [None] * b.num_rows
            words, gone, kept = [], [], []
            for d in range(b.num_rows):
                lo, hi = first[d], first[d + 1]
                stay = np.ones(hi - lo + 1, np.int32)
                if spans[d]:
                    cover = np.zeros(hi - lo + 1, np.int32)
                    a = np.array([x["pos"] & mask for x in spans[d]])
                    np.add.at(cover, a, 1)
                    np.add.at(cover, a + np.array([x["n"] for x in spans[d]]) + k - 1, -1)
                    stay = np.cumsum(cover) == 0
                at = lo + np.flatnonzero(stay[:-1])
                words.append(hi - lo)
                gone.append(hi - lo - len(at))
                kept.append(b" ".join([raw[x:y] for x, y in zip(s[at].tolist(), e[at].tolist())]).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [c.column(b, "doc_id"), pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])
    return run


def dedupe_substrings(docs: DataFrame, k: int = WINDOW, m: int = MIN_WORDS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (the words
    left, joined by single spaces).

    A word goes if a window of k words that covers it also starts earlier
    (smaller id, or the same document, earlier).  Null and empty texts have
    no words (kept is empty); texts with fewer than k words stay; rows that
    repeat id and text are one document and come out alike; texts that
    share an id are ordered by their hash; a null id sorts after all ids;
    other columns are ignored; an empty table gives an empty result.
    """
    c.prepare(docs.sparkSession)
    key = keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    src = key.select("did", "tag", "text")
    spans = c.stored(repeated_spans(src, k, m), "substring-spans")
    on = ["did", "tag"]
    out = "doc_id long, n_words long, n_removed long, kept string"
    hit = c.semi_by(key, spans.select(*on), on).join(spans, on).select("doc_id", "text", "spans")
    same = c.semi_by(key, spans.select(*on), on, "left_anti").select("doc_id", "text")
    return hit.mapInArrow(_cut(k), out).union(same.mapInArrow(_cut(k), out))
