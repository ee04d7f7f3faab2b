"""Quality rules with an n-gram perplexity.

The n-grams are ORDER consecutive bytes of the UTF-8 text: no word is
unknown, every language and script has the same few symbols, and the tables
grow with what the corpus holds.

1. Counting.  Spark counts all n-grams of all whole texts per language; a
   task adds up sorted codes before it sends anything.  Documents are dealt
   into two folds by a hash of their text, and a document is scored by the
   counts of the other fold, so that no text, and no copy of it, explains
   itself.
2. Interpolated modified Kneser-Ney per language and fold: counts at the
   highest order, numbers of distinct left neighbours (continuation counts)
   below, three discounts per order from the counts of counts.  Contexts and
   suffixes are joins and aggregates on the codes.
3. The model: per language sorted arrays of 64-bit hashes (a bijection of
   the codes, so nothing collides) with the cost of the n-gram, -ln p in
   millionths, for either fold.  Sums of costs are integers.
4. Scoring.  Up to MODEL_ROWS n-grams (64 MB) the arrays are broadcast.
   Beyond, documents are kept in blocks, each block asks for its distinct
   n-grams, and meets the sorted array of just these: nothing grows but the
   number of blocks.
5. Bands.  The median of a language's perplexities (per byte, in thousandths
   of a nat), and the median distance from it, give a lower and an upper
   bound; documents outside are rejected.  The medians are exact, from
   counts per value.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aerocast.llm import common as c

ORDER = 5
MIN_WORDS, WINDOW, REPEATED = 20, 8, 30     # base rules; repeated words in per cent
LOWER, UPPER = 8.0, 8.0                     # width of the band, in median distances
FLOOR = 0.02                                # least median distance, as a share of the median
DISCOUNT = 0.1                              # least discount: some of every context is left to the order below
MODEL_ROWS = 1 << 22
HELD = 1 << 22                              # n-grams that a task adds up before it sends them
BLOCK_BYTES = 32 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(x) for x in "#*$%&|<>"]] = True


# ---- n-grams -------------------------------------------------------------

def codes(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams inside the texts as integers (the first byte lowest), and the
    number per text."""
    many = np.maximum(np.diff(offsets) - order + 1, 0)
    if not many.sum():
        return np.zeros(0, np.int64), many
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.ndarray((len(data),), "<u8", padded, 0, (1,)) & np.uint64((1 << 8 * order) - 1)
    inside = np.ones(len(data), bool)
    for k in range(1, order):                           # the last order - 1 bytes of a text start none
        at = offsets[1:] - k
        inside[at[at >= offsets[:-1]]] = False
    return out[inside].view(np.int64), many


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    g, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(g, kind="stable")
    g = g[order]
    at = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    return g[at], np.add.reduceat(n[order], at)


def _grams(order: int):
    """Counts per (lang, fold) of the n-grams of all texts."""
    def run(batches):
        held: dict[tuple, list] = {}
        size = 0

        def out():
            for (lang, fold), parts in held.items():
                g, n = _added(parts)
                for i in range(0, len(g), 1 << 18):
                    k = len(g[i:i + (1 << 18)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang], pa.string()).take(pa.array(np.zeros(k, np.int64))), pa.array(np.full(k, fold, np.int32)),
                         pa.array(g[i:i + (1 << 18)]), pa.array(n[i:i + (1 << 18)])], ["lang", "fold", "g", "n"])
        for b in c.slices(batches):
            data, off = c.text_bytes(c.column(b, "text"))
            g, many = codes(data, off, order)
            if not len(g):
                continue
            for key, rows in _by_model(b).items():
                mine = np.sort(g[np.repeat(rows, many)])
                if not len(mine):
                    continue
                at = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
                held.setdefault(key, []).append((mine[at], np.diff(np.append(at, len(mine)))))
                size += len(at)
            if size > HELD:
                held = {k: [_added(v)] for k, v in held.items()}
                size = sum(len(v[0][0]) for v in held.values())
                if size > HELD // 2:
                    yield from out()
                    held, size = {}, 0
        yield from out()
    return run


def _by_model(b: pa.RecordBatch) -> dict[tuple, np.ndarray]:
    """(lang, fold) → which rows."""
    lang = c.column(b, "lang").dictionary_encode()
    key = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + c.longs(b, "fold")
    return {(lang.dictionary[int(k) // 2].as_py(), int(k) % 2): key == k for k in np.unique(key)}


# ---- Kneser-Ney ----------------------------------------------------------

def kneser_ney(counts: DataFrame, order: int, name: str = "perplexity") -> DataFrame:
    """(lang, g, a0, a1) counts of n-grams per fold → (lang, g, cost0,
    cost1): -ln p in millionths by either fold's counts.

    A count of counts of zero leaves the discounts 0.5, 1 and 1.5; where a
    context was never seen the next order decides, below all a uniform
    1/256."""
    types = {order: counts}
    for k in range(order - 1, 0, -1):
        types[k] = c.stored(types[k + 1].groupBy("lang", F.shiftright("g", 8).alias("g"))
                            .agg(*(F.sum((F.col(f"a{f}") > 0).cast("long")).alias(f"a{f}") for f in (0, 1))), f"{name}-types-{k}")
    below = None
    for k in range(1, order + 1):
        mask = (1 << 8 * (k - 1)) - 1
        t = types[k].withColumn("ctx", F.col("g").bitwiseAND(F.lit(mask)))
        of = lambda f, i: F.sum((F.col(f"a{f}") == i).cast("long"))
        ctx = t.groupBy("lang", "ctx").agg(*(x for f in (0, 1) for x in (
            F.sum(f"a{f}").alias(f"t{f}"), of(f, 1).alias(f"x{f}"), of(f, 2).alias(f"y{f}"),
            F.sum((F.col(f"a{f}") > 2).cast("long")).alias(f"z{f}"))))
        seen = t.groupBy("lang").agg(*(of(f, i).cast("double").alias(f"n{f}{i}") for f in (0, 1) for i in (1, 2, 3, 4)))
        given = [F.when(F.expr(f"n{f}1 > 0 and n{f}2 > 0 and n{f}3 > 0 and n{f}4 > 0"),
                        F.expr(f"greatest({DISCOUNT}d, least({i}d, {i} - {i + 1} * (n{f}1 / (n{f}1 + 2 * n{f}2)) * n{f}{i + 1} / n{f}{i}))"))
                 .otherwise(F.lit(i / 2)).alias(f"d{f}{i}") for f in (0, 1) for i in (1, 2, 3)]
        t = t.join(ctx, ["lang", "ctx"]).join(seen.select("lang", *given), "lang")
        if below is None:
            t = t.withColumns({f"low{f}": F.lit(1 / 256) for f in (0, 1)})
        else:
            t = t.withColumn("s", F.shiftright("g", 8)).join(below, ["lang", "s"])
        p = [F.expr(f"case when t{f} = 0 then low{f} else (greatest(0d, a{f} - case when a{f} = 0 then 0 when a{f} = 1 then d{f}1 when a{f} = 2 then d{f}2 else d{f}3 end)"
                    f" + (d{f}1 * x{f} + d{f}2 * y{f} + d{f}3 * z{f}) * low{f}) / t{f} end") for f in (0, 1)]
        if k < order:
            below = c.stored(t.select("lang", F.col("g").alias("s"), p[0].alias("low0"), p[1].alias("low1")), f"{name}-{k}")
        else:
            cost = [F.round(F.log(x) * -1_000_000).cast("int").alias(f"cost{f}") for f, x in enumerate(p)]
            return c.stored(t.select("lang", "g", *cost), f"{name}-costs")


# ---- the model -----------------------------------------------------------

class Arrays:
    """Sorted hashes with two costs each, and where each run of leading bits
    begins."""

    def __init__(self, hashes: np.ndarray, costs: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.costs = np.append(hashes[order], np.uint64(2 ** 64 - 1)), costs[:, order]
        self.shift = np.uint64(64 - max(1, len(hashes).bit_length()))
        self.start = np.searchsorted(self.hashes, np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, g: np.ndarray) -> np.ndarray:
        """Where each n-gram stands; every one must be in the arrays."""
        h = c.mix(g.view(np.uint64))
        at = self.start[(h >> self.shift).astype(np.int64)]
        left = np.flatnonzero(self.hashes[at] < h)
        while len(left):
            at[left] += 1
            left = left[self.hashes[at[left]] < h[left]]
        return at


def arrays(rows) -> dict[str, Arrays]:
    """Model of (lang, hashes, cost0, cost1) rows, as bytes."""
    held: dict[str, list] = {}
    for lang, *cols in rows:
        held.setdefault(lang, []).append(cols)
    out = {}
    for lang, parts in held.items():
        h = np.concatenate([np.frombuffer(p[0], np.uint64) for p in parts])
        costs = np.array([np.concatenate([np.frombuffer(p[k], np.int32) for p in parts]) for k in (1, 2)])
        out[lang] = Arrays(h, costs)
    return out


def _hashed(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([c.column(b, "lang"), pa.array(c.i64(c.mix(c.longs(b, "g").view(np.uint64)))), c.column(b, "cost0"),
                                          c.column(b, "cost1")], ["lang", "h", "cost0", "cost1"])


def _packed(batches):
    for b in batches:
        lang = c.column(b, "lang").to_numpy(zero_copy_only=False)
        at = np.flatnonzero(np.append(True, lang[1:] != lang[:-1])) if len(lang) else []
        for i, j in zip(at, np.append(at[1:], len(lang))):
            cut = [np.ascontiguousarray(c.longs(b, n)[i:j]).tobytes() for n in ("h", "cost0", "cost1")]
            yield pa.RecordBatch.from_arrays([pa.array([lang[i]], pa.string()), *(pa.array([x], pa.binary()) for x in cut)],
                                             ["lang", "hashes", "cost0", "cost1"])


def sorted_arrays(costs: DataFrame) -> DataFrame:
    """(lang, hashes, cost0, cost1): the model in pieces sorted by hash."""
    return (costs.mapInArrow(_hashed, "lang string, h long, cost0 int, cost1 int").repartition("lang", F.shiftright("h", 56))
            .sortWithinPartitions("lang", "h").mapInArrow(_packed, "lang string, hashes binary, cost0 binary, cost1 binary"))


# ---- scoring -------------------------------------------------------------

_SCORED = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, grams long, cost long"


def repeat_words(wh: np.ndarray, first: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text the words inside windows that stand twice or more in it."""
    n = np.diff(first)
    starts = np.maximum(n - window + 1, 0)
    doc = np.repeat(np.arange(len(n)), starts)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(starts) - starts, starts) + first[:-1][doc]
    if not len(at):
        return np.zeros(len(n), np.int64)
    h = c.range_hash(wh, at, at + window) ^ c.mix(doc.astype(np.uint64) + np.uint64(1))
    at = at[pd.Series(h).duplicated(keep=False).to_numpy()]
    edge = np.zeros(len(wh) + 1, np.int64)
    edge[:len(wh)] += np.bincount(at, minlength=len(wh))
    edge += np.append(0, -np.bincount(at + window - 1, minlength=len(wh)))
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return covered[first[1:]] - covered[first[:-1]]


def repeat_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def scored(b: pa.RecordBatch, model: dict[str, Arrays], order: int) -> pa.RecordBatch:
    """Base figures of a slice's texts and their cost by the other fold."""
    text = c.column(b, "text")
    data, off = c.text_bytes(text)
    s, e, first = c.word_spans(data, off)
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])       # code points begun so far
    chars = np.concatenate([[0], np.cumsum(letters[e] - letters[s])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    g, many = codes(data, off, order)
    cost = np.zeros(b.num_rows, np.int64)
    if len(g):
        for (lang, fold), rows in _by_model(b).items():
            mine = g[np.repeat(rows, many)]
            if len(mine):
                m = model[lang]
                total = np.concatenate([[0], np.cumsum(m.costs[1 - fold][m.find(mine)], dtype=np.int64)])
                ends = np.cumsum(many[rows])
                cost[rows] = total[ends] - total[ends - many[rows]]
    out = [np.diff(first), chars[first[1:]] - chars[first[:-1]], symbols[off[1:]] - symbols[off[:-1]],
           np.array([repeat_lines(x) if x else 0 for x in text.to_pylist()], np.int64),
           repeat_words(c.word_hashes(data, s, e), first), many, cost]
    return pa.RecordBatch.from_arrays([c.column(b, "doc_id"), c.column(b, "lang"), *(pa.array(x.astype(np.int64)) for x in out)],
                                      [x.split()[0] for x in _SCORED.split(", ")])


def _blocks(batches):
    """Rows numbered by blocks of about BLOCK_BYTES, kept in order."""
    from pyspark import TaskContext
    number, size = TaskContext.get().partitionId() << 32, 0
    for b in c.slices(batches):
        yield b.append_column("block", pa.array(np.full(b.num_rows, number, np.int64)))
        size += c.column(b, "text").nbytes
        if size > BLOCK_BYTES:
            number, size = number + 1, 0


def _wanted(order: int):
    """The distinct n-grams of each block."""
    def run(batches):
        held, block = [], None

        def out():
            keys = sorted({k for part in held for k in part})
            for lang in keys:
                g = np.unique(np.concatenate([p[lang] for p in held if lang in p]))
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(g), np.int64))),
                                                  pa.array(np.full(len(g), block, np.int64)), pa.array(g)], ["lang", "block", "g"])
        for b in c.slices(batches):
            of = c.longs(b, "block")
            for x in np.unique(of):
                part = b.filter(pa.array(of == x))
                if held and x != block:
                    yield from out()
                    held = []
                block = x
                data, off = c.text_bytes(c.column(part, "text"))
                g, many = codes(data, off, order)
                found: dict[str, list] = {}
                for (lang, _), rows in _by_model(part).items():
                    found.setdefault(lang, []).append(g[np.repeat(rows, many)])
                held.append({k: np.unique(np.concatenate(v)) for k, v in found.items()})
        if held:
            yield from out()
    return run


def _block_scores(order: int):
    def run(texts: pd.DataFrame, grams: pd.DataFrame) -> pd.DataFrame:
        model = {lang: Arrays(c.mix(p["g"].to_numpy(np.int64).view(np.uint64)), p[["cost0", "cost1"]].to_numpy(np.int32).T)
                 for lang, p in grams.groupby("lang")}
        table = pa.Table.from_pandas(texts.assign(doc_id=texts["doc_id"].astype("Int64")), preserve_index=False)
        out = [scored(b, model, order) for b in c.slices(table.to_batches())]
        return pa.Table.from_batches(out).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
    return run


def costs_of(docs: DataFrame, order: int = ORDER, model_rows: int = MODEL_ROWS) -> DataFrame:
    """Base figures, number of n-grams and cost of every text; docs: doc_id,
    lang, text (no nulls in the last two), fold."""
    spark = docs.sparkSession
    counts = (docs.select("lang", "fold", "text").mapInArrow(_grams(order), "lang string, fold int, g long, n long")
              .groupBy("lang", "g").agg(*(F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)).alias(f"a{f}") for f in (0, 1))))
    costs = kneser_ney(c.stored(counts, "perplexity-counts"), order)
    if costs.count() <= model_rows:
        model = spark.sparkContext.broadcast([tuple(r) for r in c.stored(sorted_arrays(costs), "perplexity-model").toLocalIterator()])

        def run(batches):
            made = arrays(model.value)
            for b in c.slices(batches):
                yield scored(b, made, order)
        return docs.mapInArrow(run, _SCORED)
    kept = c.stored(docs.mapInArrow(_blocks, "doc_id long, lang string, text string, fold int, block long"), "perplexity-blocks")
    grams = kept.select("lang", "fold", "text", "block").mapInArrow(_wanted(order), "lang string, block long, g long").join(costs, ["lang", "g"])
    return kept.groupBy("block").cogroup(grams.groupBy("block")).applyInPandas(_block_scores(order), _SCORED)


def rules(docs: DataFrame, order: int = ORDER, lower: float = LOWER, upper: float = UPPER, model_rows: int = MODEL_ROWS,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: doc_id, lang, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, grams, nats (thousandths of a
    nat per byte; null without n-grams), low, high, kept.

    ``base_failed``: fewer than MIN_WORDS words, or over REPEATED per cent of
    the words in windows that stand twice in the text.  The bands are those
    of the documents that pass the base rules; kept needs both.  A null text
    counts as empty, a null lang as '', a null id stays null; texts are read
    whole; repeated rows are documents each; other columns are ignored; an
    empty table gives an empty result."""
    spark = docs.sparkSession
    c.prepare(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                      text.alias("text"), (F.substring(F.md5(text), 1, 1) >= "8").cast("int").alias("fold"))
    base = (c.stored(costs_of(src, order, model_rows), "perplexity-scored")
            .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEATED} * n_words"))
            .withColumn("nats", F.expr("case when grams > 0 then cost div (1000 * grams) end")))
    seen = base.where("not base_failed and nats is not null").groupBy("lang", "nats").agg(F.count("*").alias("n"))
    mid = seen.groupBy("lang").agg(F.expr("percentile(nats, 0.5d, n)").alias("mid"))
    band = (seen.join(mid, "lang").groupBy("lang", "mid").agg(F.expr("percentile(abs(nats - mid), 0.5d, n)").alias("off"))
            .withColumn("off", F.greatest("off", F.col("mid") * FLOOR))
            .select("lang", (F.col("mid") - lower * F.col("off")).alias("low"), (F.col("mid") + upper * F.col("off")).alias("high")))
    kept = F.coalesce(~F.col("base_failed") & F.col("nats").between(F.col("low"), F.col("high")), F.lit(False))
    return base.join(band, "lang", "left").select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "grams", "nats", "low", "high",
        kept.alias("kept"))
