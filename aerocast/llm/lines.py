"""Fuzzy line dedup.

1. A line is normalised to its words (lower case, single spaces).  Equal
   normalised lines are one distinct line.
2. Each distinct line has a 64-bit SimHash of its distinct words.  Two lines are
   candidates within DISTANCE = 3 differing bits.  By the pigeonhole
   principle three of six blocks are then equal: twenty keys of about 32
   bits, so that lines share a key by chance only among billions.
3. Every line is compared with one pivot per shared key (the line with most
   shared keys); keys with more than two lines whose lines are not yet in
   one component are compared across components.  A candidate pair is a
   link if its edit similarity is SIMILAR or more.
4. Connected lines form a group, of which the first occurrence (smallest
   id, then smallest line number) stays.

What the two lines of a pair begin and end with alike is cut off before the
distance is computed, which it does not change.

Edit similarity is 1 - distance / length of the longer line, in characters;
if that line has more than LONG characters, in words (each word stands as
one of 20,000 symbols by its hash), so that a line of any length can be
verified in bounded time.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from aerocast.llm import common as c
from aerocast.llm.components import components

DISTANCE = 3
SIMILAR = 80            # per cent
LONG = 1000
POSTED_LINES = 1 << 16  # distinct lines whose keys one task makes
KEYED_LINES = 1 << 13   # of them, whose keys are made at once
_EDGES = (0, 11, 22, 33, 44, 54, 64)

TAG_BITS = 22           # tells rows of one id with different texts apart
_SHIFT = 40


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with did (no nulls) and tag (bits of the text's hash)."""
    return docs.withColumns({"did": F.coalesce(F.col(id_col).cast("long"), F.lit(c.NO_ID)),
                             "tag": F.xxhash64(text_col).bitwiseAND((1 << TAG_BITS) - 1)})


def line_words(col: pa.Array):
    """Bytes in normal form, word spans, line number of each word in its
    text, text of each word."""
    data, off = c.text_bytes(pc.utf8_lower(col.cast(pa.large_string())))
    s, e, first = c.word_spans(data, off)
    nl = np.concatenate([[0], np.cumsum(data == 10)])
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return data, s, e, nl[s] - nl[off[:-1]][doc], doc


_LANES = np.array([[b >> (7 - k) & 1 for k in range(8)] for b in range(256)], np.uint8).view(np.uint64)[:, 0]   # a byte's bits, a byte each
_WORD_BITS = 40


def simhashes(wh: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash of the distinct words from each start to the next (a column
    mark that is every other word counts once).

    Words count by 40 bits of their hash, sorted beside their line's number.
    Eight sums of one byte each are added in one integer, for up to 255
    words at a time."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(0, len(starts), 1 << 23):                   # lines whose number fits
        some = starts[i:i + (1 << 23)]
        end = starts[i + (1 << 23)] if i + (1 << 23) < len(starts) else len(wh)
        of = np.repeat(np.arange(len(some), dtype=np.uint64), np.diff(np.append(some, end)))
        key = np.sort(of << np.uint64(_WORD_BITS) | wh[some[0]:end] >> np.uint64(64 - _WORD_BITS))
        key = key[np.append(True, key[1:] != key[:-1])]
        of = (key >> np.uint64(_WORD_BITS)).astype(np.int64)
        bits = c.mix((key & np.uint64((1 << _WORD_BITS) - 1)) ^ np.uint64(0xA5A5F00D5EED1234)).view(np.uint8).reshape(-1, 8)
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        n = np.diff(np.append(first, len(key)))
        at = np.arange(len(key)) - np.repeat(first, n)
        piece = np.flatnonzero(at % 255 == 0)                   # runs of at most 255 words of a line
        line = of[piece]
        edge = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
        sign = np.empty((len(first), 8), np.uint8)
        for k in range(8):
            sums = np.add.reduceat(_LANES[bits[:, k]], piece).view(np.uint8).reshape(-1, 8)
            total = np.add.reduceat(sums.astype(np.int64), edge, axis=0) if len(edge) < len(piece) else sums.astype(np.int64)
            sign[:, k] = np.packbits(2 * total > n[:, None], axis=1)[:, 0]
        out[i:i + len(some)] = sign.view(np.uint64)[:, 0]
    return out


_OCC = "lk long, sim long, len long, did long, pos long"


@c.lean
def _occurrences(batches):
    for b in c.slices(batches):
        data, s, e, line, doc = line_words(c.column(b, "text"))
        if not len(s):
            continue
        wh = c.word_hashes(data, s, e)
        at = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])))
        end = np.append(at[1:], len(s))
        lk = c.range_hash(wh, at, end)
        size = np.add.reduceat(e - s + 1, at) - 1
        pos = (c.longs(b, "tag")[doc[at]] << _SHIFT) + line[at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.i64(lk)), pa.array(c.i64(simhashes(wh, at))), pa.array(size.astype(np.int64)),
             pa.array(c.longs(b, "did")[doc[at]]), pa.array(pos)], ["lk", "sim", "len", "did", "pos"])


@c.lean
def _line_texts(batches):
    """Of each text the wanted lines: (lk, line, symbols)."""
    for b in c.slices(batches):
        data, s, e, line, doc = line_words(c.column(b, "text"))
        wh = c.word_hashes(data, s, e)
        want = c.column(b, "want").to_pylist()
        first = np.searchsorted(doc, np.arange(b.num_rows + 1))
        rows = []
        for d, ws in enumerate(want):
            ln = line[first[d]:first[d + 1]]
            for w in ws:
                no = w["pos"] & ((1 << _SHIFT) - 1)
                i, j = (first[d] + np.searchsorted(ln, no, side=x) for x in ("left", "right"))
                if i == j:
                    continue
                text = b" ".join(data[x:y].tobytes() for x, y in zip(s[i:j], e[i:j])).decode("utf-8", "replace")
                symbols = "".join(map(chr, (0x4E00 + (wh[i:j] % np.uint64(20000)).astype(np.int64)).tolist()))
                rows.append((w["lk"], text if len(text) <= 2 * LONG else None, len(text), symbols))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in ((0, pa.int64()), (1, pa.string()), (2, pa.int64()), (3, pa.string()))],
            ["lk", "line", "chars", "symbols"])


def unlike(x: str, y: str) -> tuple[str, str]:
    """Both less their common beginning and their common end."""
    n = min(len(x), len(y))
    lo, hi = 0, n                               # by halves: x[:lo] == y[:lo]
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if x[lo:mid] == y[lo:mid] else (lo, mid - 1)
    x, y, n = x[lo:], y[lo:], n - lo
    tail, hi = 0, n
    while tail < hi:
        mid = (tail + hi + 1) // 2
        tail, hi = (mid, hi) if x[len(x) - mid:] == y[len(y) - mid:] else (tail, mid - 1)
    return (x[:len(x) - tail], y[:len(y) - tail])


def at_most(x: str, y: str) -> int:
    """No less than the distance: what it takes to put word for word, or all
    of one string for the other."""
    p, q = x.split(" "), y.split(" ")
    return sum(max(len(a), len(b)) for a, b in zip(p, q) if a != b) if len(p) == len(q) else max(len(x), len(y))


@c.lean
def _unlike(batches):
    """Pairs of lines → what differs, and the distance that still links;
    nothing differs where at_most tells that they link."""
    for b in batches:
        rows = []
        for la, lb, ka, kb, xa, xb, ya, yb in zip(*(c.column(b, n).to_pylist() for n in ("la", "lb", "ka", "kb", "xa", "xb", "ya", "yb"))):
            p, q = (xa, xb) if max(ka, kb) <= LONG else (ya, yb)
            most = max(len(p), len(q)) * (100 - SIMILAR) // 100
            p, q = unlike(p, q)
            rows.append((la, lb, most, *(("", "") if at_most(p, q) <= most else (p, q))))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()))],
                                         ["la", "lb", "most", "p", "q"])


_BLOCKS = [(lo, (1 << (hi - lo)) - 1) for lo, hi in zip(_EDGES, _EDGES[1:])]
_BLOCK_BITS = 11                                               # of the widest


def block_keys(sim: str = "sim"):
    """Twenty keys: each three of the six blocks with their number."""
    block = [F.shiftrightunsigned(sim, lo).bitwiseAND(mask) for lo, mask in _BLOCKS]
    return F.array(*[F.shiftleft(F.lit(i).cast("long"), 3 * _BLOCK_BITS).bitwiseOR(F.shiftleft(x, 2 * _BLOCK_BITS))
                     .bitwiseOR(F.shiftleft(y, _BLOCK_BITS)).bitwiseOR(z) for i, (x, y, z) in enumerate(combinations(block, 3))])


def sorted_block_keys(sim: np.ndarray) -> np.ndarray:
    """block_keys of many lines, ascending."""
    block = [sim.view(np.uint64) >> np.uint64(lo) & np.uint64(mask) for lo, mask in _BLOCKS]
    w = np.uint64(_BLOCK_BITS)
    return np.concatenate([np.sort(((np.uint64(i) << w | x) << w | y) << w | z)
                           for i, (x, y, z) in enumerate(combinations(block, 3))]).view(np.int64)


@c.lean
def _key_marks(batches):
    """Keys of lines, each once a piece of KEYED_LINES: twice the key, and
    one more if several lines of the piece have it."""
    for b in batches:
        for i in range(0, b.num_rows, KEYED_LINES):
            key = sorted_block_keys(c.longs(b, "sim")[i:i + KEYED_LINES])
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            many = np.diff(np.append(first, len(key))) > 1
            yield pa.RecordBatch.from_arrays([pa.array(key[first] * 2 + many)], ["mark"])


@c.lean
def _shared_keys(batches):
    """Of all marks of some keys, the keys that several lines have."""
    held = [c.longs(b, "mark") for b in batches]
    if not held:
        return
    marks = np.concatenate(held)
    del held
    marks.sort()                                                # in place; looked at piece by piece
    for i in range(0, len(marks), POSTED_LINES):
        end = i + POSTED_LINES
        here, key = marks[i:end], marks[max(0, i - 1):end + 1] >> 1
        alike = np.concatenate([[False] * (i == 0), key[1:] == key[:-1], [False] * (end >= len(marks))]).astype(bool)
        found = here[~alike[1:] & (alike[:-1] | (here & 1 == 1))] >> 1      # at a key's last mark
        yield pa.RecordBatch.from_arrays([pa.array(found)], ["key"])


def line_groups(occ: DataFrame, src: DataFrame) -> DataFrame:
    """(lk, first_did, first_pos) of every distinct line that occurs again
    or is linked: where its group's first occurrence is."""
    at = F.struct("did", "pos")
    d = c.stored(occ.groupBy("lk").agg(F.min("sim").alias("sim"), F.min("len").alias("len"),
                                       F.count("*").alias("cnt"), F.min(at).alias("first")), "lines-distinct")
    # twenty rows a line: dealt to tasks of bounded work before they are made
    deal = max(d.sparkSession.sparkContext.defaultParallelism, -(-d.count() // POSTED_LINES))
    lines = d.select("lk", "sim").repartition(deal, "lk")
    with c.arrow_rows(d.sparkSession, POSTED_LINES):           # of one number each
        shared = c.stored(lines.select("sim").mapInArrow(_key_marks, "mark long").repartition(deal, F.shiftright("mark", 1))
                          .mapInArrow(_shared_keys, "key long"), "lines-shared")
    posts = lines.select("lk", F.explode(block_keys()).alias("key"))
    posts = shared_posts = c.stored(posts.join(F.broadcast(shared) if c.small_enough(shared) else shared, "key"), "lines-shared-posts")
    # the pivot of a key is the line with most shared keys: the one that others are copies of
    posts = posts.join(posts.groupBy("lk").agg(F.count("*").alias("s")), "lk")
    posts = c.stored(posts.join(posts.groupBy("key").agg(F.count("*").alias("k"), F.max(F.struct("s", "lk"))["lk"].alias("pivot")), "key")
                     .drop("s"), "lines-posts")
    c.discard(shared, shared_posts)
    end = lambda p: d.select(F.col("lk").alias("l" + p), F.col("sim").alias("s" + p), F.col("len").alias("n" + p),
                             F.col("first.did").alias("d" + p), F.col("first.pos").alias("p" + p))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        near = c.stored(pairs.select(F.least("la", "lb").alias("la"), F.greatest("la", "lb").alias("lb")).distinct()
                        .join(end("a"), "la").join(end("b"), "lb")
                        .where(F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= DISTANCE), name)
        lines = (near.select(F.col("la").alias("lk"), F.col("da").alias("did"), F.col("pa").alias("pos"))
                 .union(near.select("lb", "db", "pb")).distinct()
                 .groupBy("did", F.shiftrightunsigned("pos", _SHIFT).alias("tag"))
                 .agg(F.collect_list(F.struct("lk", "pos")).alias("want")))
        lines = c.stored(lines, name + "-wanted")
        texts = c.semi_by(src, lines.select("did", "tag"), ["did", "tag"]).join(lines, ["did", "tag"])
        texts = c.stored(texts.select("text", "want").mapInArrow(_line_texts, "lk long, line string, chars long, symbols string")
                         .dropDuplicates(["lk"]), name + "-texts")
        t = lambda p: texts.select(F.col("lk").alias("l" + p), F.col("line").alias("x" + p),
                                   F.col("chars").alias("k" + p), F.col("symbols").alias("y" + p))
        out = c.stored(near.select("la", "lb").join(t("a"), "la").join(t("b"), "lb")
                       .select("la", "lb", "ka", "kb", "xa", "xb", "ya", "yb")
                       .mapInArrow(_unlike, "la long, lb long, most int, p string, q string")
                       .where("greatest(length(p), length(q)) = 0 or levenshtein(p, q, most) >= 0").select("la", "lb"), name + "-links")
        c.discard(near, lines, texts)
        return out

    links = verified(posts.where("lk <> pivot").select(F.col("lk").alias("la"), F.col("pivot").alias("lb")), "lines-star")
    comp = c.stored(components(links.toDF("a", "b"), "lines-cc"), "lines-comp")
    post = (posts.where("k > 2").join(comp, posts.lk == comp.id, "left")
            .select("key", "lk", F.coalesce("comp", "lk").alias("comp")))
    post = post.join(d.select("lk", "sim", "len"), "lk")
    mixed = post.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    post = c.stored(post.join(mixed, "key", "left_semi"), "lines-mixed")
    c.discard(posts)
    kc = post.groupBy("key", "comp").agg(F.min("sim").alias("lo"), F.max("sim").alias("hi"), F.count("*").alias("many"))
    cross = (kc.toDF("key", "cx", "lx", "hx", "mx").join(kc.toDF("key", "cy", "ly", "hy", "my"), "key")
             .where("mx < my or (mx = my and cx < cy)")   # the smaller component is expanded first
             .where(f"lx <> hx or ly <> hy or bit_count(lx ^ ly) <= {DISTANCE}").select("key", "cx", "cy")
             .join(post.select("key", F.col("comp").alias("cx"), F.col("lk").alias("la"), F.col("sim").alias("sx")), ["key", "cx"])
             .join(post.select("key", F.col("comp").alias("cy"), F.col("lk").alias("lb"), F.col("sim").alias("sy")), ["key", "cy"])
             .where(F.bit_count(F.col("sx").bitwiseXOR(F.col("sy"))) <= DISTANCE).select("la", "lb"))
    more = verified(cross, "lines-cross")
    comp = components(comp.where("id <> comp").toDF("a", "b").union(more), "lines-cc2")
    all_ = d.where("cnt > 1").select("lk").union(comp.select("id")).distinct()
    row = (all_.join(d.select("lk", "first"), "lk").join(comp.withColumnRenamed("id", "lk"), "lk", "left")
           .select("lk", "first", F.coalesce("comp", "lk").alias("comp")))
    row = c.stored(row, "lines-rows")
    firsts = row.groupBy("comp").agg(F.min("first").alias("f"))
    return row.join(firsts, "comp").select("lk", F.col("f.did").alias("first_did"), F.col("f.pos").alias("first_pos"))


@c.lean
def _kept(batches):
    mask = (1 << _SHIFT) - 1
    for b in c.slices(batches):
        texts, removed, had = [], [], []
        for text, gone in zip(c.column(b, "text").to_pylist(), c.column(b, "gone").to_pylist()):
            gone = {g & mask for g in gone or ()}
            texts.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone) if gone else text)
            removed.append(len(gone))
            had.append(text.count("\n") + 1)
        names = b.schema.names
        cols = [pa.array(texts, pa.string()) if x == "text" else b.column(i) for i, x in enumerate(names)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(had, pa.int64()), pa.array(removed, pa.int64())], [*names, "lines", "lines_removed"]).select(
            [x for x in names if x != "gone"] + ["lines", "lines_removed"])


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with its text less the lines whose group occurs earlier, and
    ``lines`` (before; a null text has none) and ``lines_removed``.

    Lines end at "\\n".  Lines without words stay.  A null text stays null,
    an empty one empty; a null id sorts after all ids; rows that repeat id
    and text are one document and come out alike; an empty table gives an
    empty result; columns named like the operator's own (did, tag, gone,
    lines, lines_removed) are not supported as ids or texts and are dropped.
    """
    c.prepare(docs.sparkSession)
    docs = docs.drop("did", "tag", "gone", "lines", "lines_removed")
    key = keyed(docs, id_col, text_col)
    src = key.select("did", "tag", F.col(text_col).cast("string").alias("text"))
    occ = c.stored(src.where("text is not null").mapInArrow(_occurrences, _OCC), "lines-occurrences").distinct()
    groups = c.stored(line_groups(occ, src), "lines-groups")
    gone = (occ.join(groups, "lk").where("did <> first_did or pos <> first_pos")
            .groupBy("did", F.shiftrightunsigned("pos", _SHIFT).alias("tag")).agg(F.collect_list("pos").alias("gone")))
    gone = c.stored(gone, "lines-gone")
    on = ["did", "tag"]
    hit = c.semi_by(key, gone.select(*on), on).join(gone, on).withColumn("text", F.col(text_col).cast("string"))
    rest = [x for x in docs.columns if x != text_col]
    hit = hit.select(*rest, "text", "gone")
    text = F.col(text_col).cast("string")
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    many = F.coalesce(breaks + 1, F.lit(0)).cast("long")
    zero = {"lines": F.lit(0).cast("long"), "lines_removed": F.lit(0).cast("long")}
    cut = hit.mapInArrow(_kept, hit.drop("gone").withColumns(zero).schema)
    same = c.semi_by(key, gone.select(*on), on, "left_anti").withColumns(zero | {"lines": many})
    out = [*docs.columns, "lines", "lines_removed"]
    return cut.withColumnRenamed("text", text_col).select(*out).union(same.select(*out))
