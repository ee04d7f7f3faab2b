"""Source divergence audit: how the sources of a language differ in words.

1. Equal texts collapse before anything is counted: a task folds the copies
   it reads into one row per (lang, text, source) with a multiplicity, the
   rows are dealt by language and text hash and sorted, so that all rows of
   a text stand side by side.  A group of copies that holds a third of all
   rows sends one row per task and source.
2. Each text is tokenised once; its terms' counts and its one document each
   are multiplied by the multiplicity of every source and summed per (lang,
   source, term), in the task first.
3. A term stays if the weighted document frequency of its language reaches
   MIN_DOCS.  Smoothed shares p are integers, exact at any size (decimals).
4. Two sources are compared sparsely.  A term that neither has adds the same
   constant, a term that only one has is evaluated once per distinct share
   (terms with equal counts have equal shares), and only terms of both meet
   in a join by term.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from aerocast.llm import common as c

MIN_DOCS, SMOOTH, UNIT, TOP = 30, 5, 1_000_000_000, 50
HELD_BYTES = 16 << 20       # of texts that a task folds or counts at once

#: Bytes that are not part of a term: ASCII other than letters.
_GAP = np.ones(256, bool)
_GAP[65:91] = _GAP[97:123] = _GAP[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_FOLDED = "lang string, text string, source string, n long"
_COUNTS = "lang string, term string, source string, cnt long, docs long"


def _folded(batches):
    """One row for equal rows, among HELD_BYTES of distinct texts."""
    held: dict[tuple, int] = {}
    size = 0

    def out():
        cols = list(zip(*held)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.string()) for x in cols), pa.array(list(held.values()), pa.int64())], ["lang", "text", "source", "n"])
    for b in c.slices(batches):
        for row in zip(*(c.column(b, x).to_pylist() for x in ("lang", "text", "source"))):
            if row in held:
                held[row] += 1
            else:
                held[row] = 1
                size += len(row[1]) + 64
        if size > HELD_BYTES:
            yield out()
            held, size = {}, 0
    if held:
        yield out()


def terms(col: pa.Array):
    """Terms of every text: (text, term number), and the numbered terms."""
    data, off = c.text_bytes(col)
    s, e, first = c.word_spans(data, off, _GAP)
    ends = np.concatenate([[0], np.cumsum(e - s)])
    own = _LOWER[data[~_GAP[data]]]
    words = pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(own)).dictionary_encode()
    text = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return text, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def _runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    new = np.zeros(max(0, len(sorted_keys[0]) - 1), bool)
    for k in sorted_keys:
        new |= k[1:] != k[:-1]
    return np.flatnonzero(np.append(True, new)) if len(sorted_keys[0]) else np.zeros(0, np.int64)


def _weighted(rows: pa.Table) -> pa.RecordBatch | None:
    """Counts of rows in which those of one text are neighbours."""
    rows = rows.combine_chunks()
    lang, text = rows.column("lang").combine_chunks(), rows.column("text").combine_chunks()
    if isinstance(text, pa.ChunkedArray):
        text, lang = pa.concat_arrays(text.chunks), pa.concat_arrays(lang.chunks)
    same = np.zeros(len(text), bool)
    if len(text) > 1:
        same[1:] = (pa.compute.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
                    & pa.compute.equal(lang[1:], lang[:-1]).to_numpy(zero_copy_only=False))
    at = np.flatnonzero(~same)                                  # first row of each text
    of, word, names = terms(text.take(pa.array(at)))
    if not len(of):
        return None
    key = np.sort(of * len(names) + word)
    start = _runs(key)
    tf = np.diff(np.append(start, len(key)))
    of, word = np.divmod(key[start], len(names))                # one entry per text and term
    # every entry once for each source row of its text
    many = np.diff(np.append(at, len(text)))[of]
    entry = np.repeat(np.arange(len(of)), many)
    row = np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many) + at[of][entry]
    n = rows.column("n").to_numpy()[row]
    group = pa.StructArray.from_arrays([lang, rows.column("source").combine_chunks()], ["lang", "source"])
    groups: dict = {}
    number = np.array([groups.setdefault((g["lang"], g["source"]), len(groups)) for g in group.to_pylist()], np.int64)
    key = number[row] * len(names) + word[entry]
    order = np.argsort(key, kind="stable")
    start = _runs(key[order])
    cnt = np.add.reduceat((tf[entry] * n)[order], start)
    docs = np.add.reduceat(n[order], start)
    who, what = np.divmod(key[order][start], len(names))
    held = list(groups)
    take = lambda i: pa.array([g[i] for g in held], pa.string()).take(pa.array(who))
    return pa.RecordBatch.from_arrays([take(0), names.cast(pa.string()).take(pa.array(what)), take(1), pa.array(cnt), pa.array(docs)],
                                      ["lang", "term", "source", "cnt", "docs"])


def _counted(batches):
    held, size = [], 0
    for b in c.slices(batches):
        held.append(b)
        size += c.column(b, "text").nbytes
        if size > HELD_BYTES:
            out = _weighted(pa.Table.from_batches(held))
            held, size = [], 0
            if out is not None:
                yield out
    if held:
        out = _weighted(pa.Table.from_batches(held))
        if out is not None:
            yield out


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, source, cnt, lang_cnt, first): occurrences of every kept
    term in each source that has it and in its language; ``first`` marks one
    row of each (lang, term).  docs: lang, source, text without nulls."""
    folded = docs.select("lang", "text", "source").mapInArrow(_folded, _FOLDED)
    side = (folded.withColumn("h", F.xxhash64("text")).repartition("lang", "h")
            .sortWithinPartitions("lang", "h", "text").drop("h"))
    counts = side.mapInArrow(_counted, _COUNTS)
    term = Window.partitionBy("lang", "term")
    return (counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("cnt").alias("cnt"), F.sum("docs").alias("docs"))
            .withColumns({"lang_docs": F.sum("docs").over(term), "lang_cnt": F.sum("cnt").over(term),
                          "first": (F.min("source").over(term) == F.col("source")).cast("long")})
            .where(F.col("lang_docs") >= min_docs).select("lang", "term", "source", "cnt", "lang_cnt", "first"))


def share(count: str, total: str, terms_: str) -> F.Column:
    """1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * terms)), exact;
    null where there is no term."""
    return F.expr(f"case when {terms_} > 0 then 1 + (cast({UNIT} as decimal(10,0)) * cast({count} + {SMOOTH} as decimal(20,0))) "
                  f"div cast({total} + {SMOOTH} * {terms_} as decimal(20,0)) end")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP,
          text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: for every (lang, source) each other source of the lang
    with the sum of |p - q| over the lang's kept terms, all ranks.  Part
    ``term``: the terms that the source has and uses more than its lang
    (p > q), with p - q, ranks to ``top``.  Ranks run by value, largest
    first, then by item in UTF-8 order.

    Null texts, langs and sources count as ''.  A language without kept
    terms has pairs of value 0 and no terms; a source without terms has
    count 0 for each; a lang of one source has no pairs; repeated rows are
    documents each; other columns are ignored; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    c.prepare(spark)
    docs = docs.select(*(F.coalesce(F.col(x).cast("string"), F.lit("")).alias(n)
                         for x, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    kept = c.stored(term_counts(docs, min_docs), "divergence-terms")
    lang = kept.groupBy("lang").agg(F.sum("cnt").alias("lang_n"), F.sum("first").alias("v"))
    sums = kept.groupBy("lang", "source").agg(F.sum("cnt").alias("n"))
    groups = (docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(lang, "lang", "left")
              .na.fill(0, ["n", "lang_n", "v"]).withColumn("p0", share("0", "n", "v")))
    groups = c.stored(groups, "divergence-groups")
    p = (kept.join(groups, ["lang", "source"]).withColumns({"p": share("cnt", "n", "v"), "q": share("lang_cnt", "lang_n", "v")})
         .select("lang", "source", "term", "p", "q", "p0"))
    p = c.stored(p, "divergence-shares")

    most = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = (p.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("p - q").alias("value"))
            .withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= top))

    a, b = (groups.select("lang", F.col("source").alias(x), F.col("p0").alias(x + "0"), "v") for x in "ab")
    both_ways = a.join(b.drop("v"), "lang").where("a <> b").withColumn("z", F.expr("abs(a0 - b0)"))
    # terms of a, as if b had none of them: one evaluation per distinct share
    alike = p.groupBy("lang", F.col("source").alias("a"), "p", F.col("p0").alias("a0")).agg(F.count("*").alias("m"))
    single = (alike.join(b.drop("v"), "lang").where("a <> b")
              .groupBy("lang", "a", "b").agg(F.sum(F.expr("m * (abs(p - b0) - abs(a0 - b0))")).alias("d")))
    # terms of both: what was added by either side goes, the true difference comes
    x, y = (p.select("lang", "term", F.col("source").alias(n), F.col("p").alias(n + "p"), F.col("p0").alias(n + "0")) for n in "ab")
    shared = (x.join(y, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b")
              .agg(F.sum(F.expr("abs(ap - bp) - abs(ap - b0) - abs(a0 - bp) + abs(a0 - b0)")).alias("d")))
    swap = lambda df: df.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "d")
    change = (single.union(swap(single)).union(shared).union(swap(shared))
              .groupBy("lang", "a", "b").agg(F.sum("d").alias("d")))
    pair = (both_ways.join(change, ["lang", "a", "b"], "left")
            .select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"),
                    F.expr("coalesce(v * z + coalesce(d, 0), 0)").alias("value"))
            .withColumn("rank", F.row_number().over(most)))
    return pair.union(term)
