"""N-gram Jaccard join by grouped prefixes.

1. One pass finds shingles that are frequent (local counts of 2 and more,
   summed).  The commonest ``HEAVY_ROWS`` of them (1 MB as longs, a fixed
   bound) are sorted behind all others; the order beyond that is the
   shingle's hash.  Any total order gives the same result: this one only
   keeps shared passages out of the prefixes.
2. A document's prefix is its first ``n - ceil(t n) + 1`` shingles: linked
   documents share one.  Documents of equal size and prefix form a group,
   which is posted once.
3. Every group is compared with one pivot per shared prefix shingle, every
   member with its group's representative.  The links give components.
4. What is left are prefix shingles shared by several components, unless
   by two groups of one member each, which the star has compared: only
   pairs of different components are expanded to members and verified, so
   a large group of near copies costs its size, not its square, and still
   no link between components is lost.

A count sketch of 128 bytes bounds a pair's intersection from above and
spares most pairs the rest; verification computes both whole shingle sets
from the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aerocast.llm import common as c
from aerocast.llm.components import components

HEAVY_ROWS = 1 << 17
LOCAL_SHINGLES = 1 << 22
CELLS = 128                 # of a set's count sketch, one byte each
SKETCHED = CELLS * 128      # larger sets have none and are always verified

_DOC = "did long, tag long, sh long, n long, gid long, prefix array<long>, cells binary"


def shingle_sets(col: pa.Array, k: int, heavy: np.ndarray | None = None):
    """Distinct shingles of every text: (doc index, hash) sorted by doc, by
    "is frequent", by hash; and the set sizes.  Texts with fewer than k
    words have their whole sequence as one shingle, without words none."""
    data, off = c.text_bytes(col)
    s, e, first = c.word_spans(data, off)
    wh = c.word_hashes(data, s, e, lower=True)
    nw = np.diff(first)
    count = np.where(nw >= k, nw - k + 1, np.minimum(nw, 1))
    doc = np.repeat(np.arange(len(nw)), count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[:-1][doc]
    h = c.range_hash(wh, at, np.minimum(at + k, first[1:][doc]))
    late = np.isin(h, heavy) if heavy is not None and len(heavy) else np.zeros(len(h), bool)
    order = np.lexsort((h, late, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h = doc[keep], h[keep]
    return doc, h, np.bincount(doc, minlength=len(nw))


def set_hashes(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Order-free 64-bit hash of each set."""
    total = np.zeros(len(n), np.uint64)
    np.add.at(total, doc, c.mix(h ^ np.uint64(0x5851F42D4C957F2D)))
    return c.mix(total + n.astype(np.uint64))


def repeated(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What h holds twice or more, ascending, and how often.  Sorts h in
    place and makes little else: h is most of a task's memory."""
    h.sort()
    same = np.zeros(len(h) + 1, bool)                           # as the one before
    np.equal(h[1:], h[:-1], out=same[1:-1])
    first, last = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])
    return h[first], last - first + 1


def _frequent(k: int):
    @c.lean
    def run(batches):
        held, size = [], 0

        def out():
            h = np.concatenate(held)
            held.clear()
            h, cnt = repeated(h)
            return pa.RecordBatch.from_arrays([pa.array(c.i64(h)), pa.array(cnt)], ["h", "c"])
        for b in c.slices(batches):
            _, h, _ = shingle_sets(c.column(b, "text"), k)
            held.append(h)
            size += len(h)
            if size >= LOCAL_SHINGLES:
                yield out()
                size = 0
        if size:
            yield out()
    return run


def _prefixes(k: int, num: int, den: int, heavy):
    @c.lean
    def run(batches):
        hv = heavy.value
        for b in c.slices(batches):
            doc, h, n = shingle_sets(c.column(b, "text"), k, hv)
            sh = set_hashes(doc, h, n)
            p = n - (num * n + den - 1) // den + 1
            first = np.concatenate([[0], np.cumsum(n)])
            pos = np.arange(len(h)) - first[:-1][doc]
            keys = h[pos < p[doc]]
            p = np.where(n > 0, p, 0)
            off = np.concatenate([[0], np.cumsum(p)])
            gid = c.mix(c.range_hash(keys, off[:-1], off[1:]) + n.astype(np.uint64))
            prefix = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(c.i64(keys)))
            cells = np.bincount(doc * CELLS + (h >> np.uint64(57)).astype(np.int64), minlength=len(n) * CELLS).reshape(-1, CELLS)
            fits = (n <= SKETCHED) & (cells.max(axis=1, initial=0) < 256)
            cells = pa.array([x.tobytes() if ok else None for x, ok in zip(cells.astype(np.uint8), fits)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [c.column(b, "did"), c.column(b, "tag"), pa.array(c.i64(sh)), pa.array(n.astype(np.int64)), pa.array(c.i64(gid)), prefix, cells],
                ["did", "tag", "sh", "n", "gid", "prefix", "cells"])
    return run


def _possible(num: int, den: int):
    """Leave out pairs that cannot link: an intersection has at most the
    smaller count in each of the CELLS cells."""
    @c.lean
    def run(batches):
        for b in batches:
            most = np.full(b.num_rows, 1 << 62, np.int64)
            ca, cb = c.column(b, "ca"), c.column(b, "cb")
            at = np.flatnonzero(ca.is_valid().to_numpy(zero_copy_only=False) & cb.is_valid().to_numpy(zero_copy_only=False))
            if len(at):
                x, y = (np.frombuffer(b"".join(v.take(pa.array(at)).to_pylist()), np.uint8).reshape(-1, CELLS) for v in (ca, cb))
                most[at] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            ok = most >= -(-num * (c.longs(b, "na") + c.longs(b, "nb")) // (den + num))
            yield pa.RecordBatch.from_arrays([pa.array(c.longs(b, x)[ok]) for x in ("sa", "sb", "da", "db")],
                                             ["sa", "sb", "da", "db"])
    return run


def _linked(k: int, num: int, den: int):
    """Pairs of texts → the pairs that link; a text whose set is not the
    expected one (a repeated id) is passed over."""
    @c.lean
    def run(batches):
        for b in c.slices(c.slices(batches, "ta"), "tb"):
            (da, ha, na), (db, hb, nb) = (shingle_sets(c.column(b, x), k) for x in ("ta", "tb"))
            ok = (c.i64(set_hashes(da, ha, na)) == c.longs(b, "sa")) & (c.i64(set_hashes(db, hb, nb)) == c.longs(b, "sb"))
            d, h = np.concatenate([da, db]), np.concatenate([ha, hb])
            order = np.lexsort((h, d))
            d, h = d[order], h[order]
            same = np.bincount(d[1:][(h[1:] == h[:-1]) & (d[1:] == d[:-1])], minlength=len(na))
            ok &= den * same >= num * (na + nb - same)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.longs(b, x)[ok]) for x in ("sa", "sb")], ["sa", "sb"])
    return run


def _resolved(src: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """src: did, tag, text.  (did, tag, sh, n) of every row, and (sh, did, c)
    of every distinct set: its smallest id and its component."""
    spark = src.sparkSession
    heavy = [r.h for r in src.mapInArrow(_frequent(k), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
             .where("c >= 8").orderBy(F.desc("c"), "h").limit(HEAVY_ROWS).select("h").toLocalIterator()]
    heavy = spark.sparkContext.broadcast(np.sort(np.array(heavy, np.int64).view(np.uint64)))
    d = c.stored(src.mapInArrow(_prefixes(k, num, den, heavy), _DOC), "jaccard-docs")

    nodes = c.stored(d.where("n > 0").groupBy("sh", "gid", "n", "cells").agg(F.min("did").alias("did")), "jaccard-nodes")
    groups = nodes.groupBy("gid", "n").agg(F.min("sh").alias("rep"), F.count("*").alias("members"))
    # one row per distinct set posts its prefix; prefixes are not shuffled
    spare = c.stored(d.select("did", "sh").join(nodes.select("sh", F.col("did").alias("first")), "sh")
                     .where("did <> first").select("did", "sh").distinct(), "jaccard-spare")
    posts = (c.semi_by(d.where("n > 0"), spare, ["did", "sh"], "left_anti")
             .select("gid", "n", F.posexplode("prefix").alias("i", "key")))
    shared = c.stored(posts.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key"), "jaccard-shared")
    posts = posts.join(F.broadcast(shared) if c.small_enough(shared) else shared, "key").dropDuplicates(["key", "gid"])
    posts = raw_posts = c.stored(posts, "jaccard-shared-posts")
    rows = c.stored(d.select("did", "tag", "sh", "n"), "jaccard-rows")
    c.discard(d, spare, shared)                 # prefixes and sketches of all rows are not needed any more
    # open: beside the star's pairs of representatives there are others
    posts = posts.join(groups.select("gid", "members"), "gid")
    posts = posts.join(posts.groupBy("key").agg(F.count("*").alias("k"), F.max("members").alias("most")).where("k > 1"), "key")
    posts = posts.withColumn("open", F.expr("k > 2 or most > 1")).drop("k", "most", "members")
    # the pivot of a key is the group with most shared shingles: the text that others are copies of
    posts = posts.join(posts.groupBy("gid").agg(F.count("*").alias("s")), "gid")
    posts = c.stored(posts.join(posts.groupBy("key").agg(F.max(F.struct("s", "gid"))["gid"].alias("pivot")), "key").drop("s"),
                     "jaccard-posts")
    c.discard(raw_posts)

    def sized(x: str, y: str):
        """Whether different sets of these sizes can link: the smaller inside
        the larger, or equal sizes that differ in one shingle."""
        return F.expr(f"case when {x} = {y} then {den} * ({x} - 1) >= {num} * ({x} + 1) "
                      f"else {den} * least({x}, {y}) >= {num} * greatest({x}, {y}) end")

    def reach(a: str, b: str, total: str):
        """Whether a pair whose first shared shingle is followed by a and b
        shingles (itself included) can have enough in common."""
        return F.expr(f"least({a}, {b}) * {den + num} >= {num} * ({total})")

    g = lambda p: groups.select(F.col("gid").alias("g" + p), F.col("rep").alias("s" + p))
    pivots = posts.where("gid = pivot").select("key", F.col("n").alias("pn"), F.col("i").alias("pi"))
    star = (posts.where("gid <> pivot").join(pivots, "key").where(sized("n", "pn")).where(reach("n - i + least(i, pi)", "pn - pi + least(i, pi)", "n + pn"))
            .select(F.col("gid").alias("ga"), F.col("pivot").alias("gb")).distinct()
            .join(g("a"), "ga").join(g("b"), "gb").select("sa", "sb"))
    inner = nodes.join(groups, ["gid", "n"]).where("sh <> rep").where(sized("n", "n")).select(
        F.col("sh").alias("sa"), F.col("rep").alias("sb"))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        end = lambda p: nodes.select(F.col("sh").alias("s" + p), F.col("did").alias("d" + p), F.col("n").alias("n" + p),
                                     F.col("cells").alias("c" + p))
        pairs = c.stored(pairs.select(F.least("sa", "sb").alias("sa"), F.greatest("sa", "sb").alias("sb")).distinct()
                         .join(end("a"), "sa").join(end("b"), "sb")
                         .mapInArrow(_possible(num, den), "sa long, sb long, da long, db long"), name)
        need = pairs.select(F.col("da").alias("did")).union(pairs.select("db")).distinct()
        texts = c.semi_by(src, need, ["did"])
        out = c.stored(
            pairs.join(texts.select(F.col("did").alias("da"), F.col("text").alias("ta")), "da")
            .join(texts.select(F.col("did").alias("db"), F.col("text").alias("tb")), "db")
            .select("sa", "sb", "ta", "tb").mapInArrow(_linked(k, num, den), "sa long, sb long"), name + "-links")
        c.discard(pairs)
        return out

    links = verified(star.union(inner), "jaccard-star")
    comp = components(links.toDF("a", "b"), "jaccard-cc")

    member = c.stored(nodes.join(comp, nodes.sh == comp.id, "left")
                      .select("sh", "gid", "n", "did", F.coalesce("comp", "sh").alias("comp")), "jaccard-members")
    gcomp = member.select("gid", "comp").distinct()
    post = posts.where("open").join(gcomp, "gid").select("key", "gid", "n", "i", "comp")
    mixed = post.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    post = c.stored(post.join(mixed, "key", "left_semi"), "jaccard-mixed")
    c.discard(posts)
    # pairs of components of a key, as far as their sizes and places allow
    kc = post.groupBy("key", "comp").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.expr("n - i")).alias("left"),
                                           F.count("*").alias("many"))
    two = (kc.toDF("key", "cx", "lx", "hx", "rx", "mx").join(kc.toDF("key", "cy", "ly", "hy", "ry", "my"), "key")
           .where("mx < my or (mx = my and cx < cy)")     # the smaller component is expanded first
           .where(f"{den} * hx >= {num} * ly and {den} * hy >= {num} * lx").where(reach("rx", "ry", "lx + ly"))
           .select("key", "cx", "cy"))
    cand = (two.join(post.toDF("key", "gx", "nx", "ix", "cx"), ["key", "cx"])
            .join(post.toDF("key", "gy", "ny", "iy", "cy"), ["key", "cy"])
            .where(sized("nx", "ny")).where(reach("nx - ix", "ny - iy", "nx + ny"))
            .select("gx", "cx", "gy", "cy").distinct())
    m = lambda p: member.select(F.col("gid").alias("g" + p), F.col("comp").alias("c" + p), F.col("sh").alias("s" + p))
    cross = cand.join(m("x"), ["gx", "cx"]).join(m("y"), ["gy", "cy"]).select(F.col("sx").alias("sa"), F.col("sy").alias("sb"))
    torn = member.where(sized("n", "n")).groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("gid")
    torn = member.join(torn, "gid", "left_semi").select("gid", "comp", "sh")
    inside = (torn.toDF("gid", "cx", "sa").join(torn.toDF("gid", "cy", "sb"), "gid").where("cx < cy").select("sa", "sb"))
    more = verified(cross.union(inside), "jaccard-cross")
    final = components(member.where("comp <> sh").select(F.col("sh").alias("a"), F.col("comp").alias("b"))
                       .union(more), "jaccard-cc2")
    where = (member.join(final, member.sh == final.id, "left")
             .select("sh", "did", F.coalesce(final.comp, "sh").alias("c")))
    c.discard(post)
    heavy.destroy()
    return rows, where


def jaccard_components(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased;
    a set holds the distinct k-word shingles.  Two documents link when
    den * |intersection| >= num * |union|; component_id is the smallest id
    reachable.  Null and empty texts have no shingles and link with
    nothing, equal sets link, a null id sorts after all ids (its
    component_id is null only if no other id is reachable), repeated rows
    are repeated in the result, an empty table gives an empty result, and
    other columns of ``docs`` are ignored.
    """
    c.prepare(docs.sparkSession)
    rows, where = _resolved(c.with_did(docs, id_col, text_col).withColumn("tag", F.lit(0).cast("long")), k, num, den)
    ids = where.groupBy("c").agg(F.min("did").alias("component_id"))
    out = rows.join(where.select("sh", "c"), "sh", "left").join(ids, "c", "left")
    null_id = lambda x: F.when(x != c.NO_ID, x)
    return out.select(null_id(F.col("did")).alias("doc_id"), F.col("n").alias("n_shingles"),
                      null_id(F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), "did")).alias("component_id"))


def drop_near_copies(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: that of the smallest id (a null
    id comes last; of one id's texts that of the smallest set hash).

    Rows, not ids, stay or go: a text of its own stays, also if its id
    stands on a copied text as well, and a copy goes, also with a null id.
    Of rows that repeat id and text one stays.  Texts without words are
    linked with nothing; of these too, equal ones of one id are one row.
    An empty table gives an empty result."""
    c.prepare(docs.sparkSession)
    key = docs.withColumns({"_did": c.did(id_col), "_tag": F.xxhash64(text_col)})
    src = key.select(F.col("_did").alias("did"), F.col("_tag").alias("tag"), F.col(text_col).cast("string").alias("text"))
    rows, where = _resolved(src, k, num, den)
    comp = rows.where("n > 0").join(where.select("sh", "c"), "sh")
    first = comp.groupBy("c").agg(F.min(F.struct("did", "sh", "tag")).alias("first"))
    gone = comp.join(first, "c").where("did <> first.did or sh <> first.sh or tag <> first.tag").select(
        F.col("did").alias("_did"), F.col("tag").alias("_tag")).distinct()
    gone = c.stored(gone, "jaccard-gone")
    again = c.stored(rows.groupBy(F.col("did").alias("_did"), F.col("tag").alias("_tag")).count().where("count > 1").select("_did", "_tag")
                     .join(gone, ["_did", "_tag"], "left_anti"), "jaccard-repeated")
    on = ["_did", "_tag"]
    left = c.semi_by(key, gone, on, "left_anti")
    one = c.semi_by(left, again, on).dropDuplicates(on)
    return c.semi_by(left, again, on, "left_anti").union(one).select(*docs.columns)
