import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from statistics import median

import numpy as np
import pyarrow as pa
import pytest

from aerocast.llm import perplexity as px

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def discounts(counts):
    n = [sum(v == i for v in counts.values()) for i in range(5)]
    if not all(n[1:]):
        return [0, 0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    return [0] + [max(px.DISCOUNT, min(i, i - (i + 1) * y * n[i + 1] / n[i])) for i in (1, 2, 3)]


def kneser_ney(texts, order):
    """Probability of an n-gram given the texts, by the textbook."""
    count = {order: Counter(t[i:i + order] for t in texts for i in range(len(t) - order + 1))}
    for k in range(order - 1, 0, -1):
        count[k] = Counter(g[1:] for g in count[k + 1])
    d = {k: discounts(v) for k, v in count.items()}
    after = {k: defaultdict(list) for k in count}
    for k, v in count.items():
        for g, n in v.items():
            after[k][g[:-1]].append(n)

    def p(g):
        k = len(g)
        if not k:
            return 1 / 256
        low, seen = p(g[1:]), after[k].get(g[:-1])
        if not seen:
            return low
        a = count[k].get(g, 0)
        rest = sum(d[k][min(n, 3)] for n in seen)
        return (max(0, a - d[k][min(a, 3)]) + rest * low) / sum(seen)
    return p


def base(text):
    text = text or ""
    w = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    rep = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep),
            len(w) < 20 or 100 * len(rep) > 30 * len(w))


def brute(rows, order, lower, upper):
    """rows: (id, lang, text)."""
    fold = lambda t: int(hashlib.md5((t or "").encode()).hexdigest()[0] >= "8")
    out = {}
    for lang in {la or "" for _, la, _ in rows}:
        mine = [(i, t or "", fold(t)) for i, la, t in rows if (la or "") == lang]
        models = [kneser_ney([t.encode() for _, t, f in mine if f == x], order) for x in (0, 1)]
        nats = {}
        for i, t, f in mine:
            raw = t.encode()
            cost = [round(-1e6 * math.log(models[1 - f](raw[k:k + order]))) for k in range(len(raw) - order + 1)]
            nats[i] = sum(cost) // (1000 * len(cost)) if cost else None
        fit = [nats[i] for i, t, _ in mine if not base(t)[5] and nats[i] is not None]
        if fit:
            mid = median(fit)
            off = max(median(abs(x - mid) for x in fit), px.FLOOR * mid)
        for i, t, _ in mine:
            b = base(t)
            out[i] = (*b, nats[i], not b[5] and nats[i] is not None and mid - lower * off <= nats[i] <= mid + upper * off)
    return out


@pytest.fixture()
def corpus(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, la, "s", 3, 1, "x") for i, la, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, nats int, kept string").repartition(3)
    return make


def invented(seed, n=90):
    rnd = random.Random(seed)
    syl = {"en": ["the", "er", "on", "ing", "at", "sh"], "fr": ["é", "aux", "le", "où", "ça"], None: ["ka", "日", "ne"]}

    def text(lang, k):
        return " ".join("".join(rnd.choices(syl[lang], k=rnd.randint(1, 3))) + rnd.choice(["", "", ",", ".\n"]) for _ in range(k))
    rows = [(la, text(la, rnd.randint(15, 60))) for la in rnd.choices(["en", "en", "fr", None], k=n)]
    rows += [("en", "".join(rnd.choices("QZXJ%#|9", k=200)) + " " + " ".join(rnd.choices("QZXJ%#|9", k=30))), ("en", "the the the the " * 20),
             ("en", "same line here\n" * 9 + text("en", 40)), ("fr", None), ("fr", ""), ("en", "the"), ("xx", text("fr", 30)), ("en", rows[0][1]),
             ("en", text("en", 5000)), ("fr", " \n\t\n "), ("en", "a\x0bb\x0cc\x00d " * 10)]
    return [(i, la, t) for i, (la, t) in enumerate(rows)]


@pytest.mark.parametrize("model_rows", [px.MODEL_ROWS, 0])
def test_against_brute_force(corpus, monkeypatch, model_rows):
    """Broadcast arrays and arrays of blocks give the textbook's figures."""
    rows = invented(1)
    want = brute(rows, 3, 3.0, 3.0)
    got = {r.doc_id: r for r in px.rules(corpus(rows), 3, 3.0, 3.0, model_rows).collect()}
    assert len(got) == len(rows)
    for i, (*figures, failed, nats, kept) in want.items():
        r = got[i]
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed] == [*figures, failed], i
        assert (r.nats, r.kept) == (nats, kept), i
    assert not got[len(rows) - 11].kept                     # rare symbols: above the band


def test_null_and_repeated_ids_and_empty(corpus):
    assert px.rules(corpus([]), 3).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    for model_rows in (px.MODEL_ROWS, 0):
        got = px.rules(corpus([(None, "en", text), (1, "en", text), (1, "en", text)]), 3, model_rows=model_rows).collect()
        assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in got) == [(0, 30, True), (1, 30, True), (1, 30, True)]


def test_codes_stay_inside_texts():
    from aerocast.llm import common as c
    texts = ["abcdef", "", None, "ab", "é日x", "abc"]
    data, off = c.text_bytes(pa.array(texts))
    g, many = px.codes(data, off, 3)
    want = [(t or "").encode() for t in texts]
    assert many.tolist() == [max(0, len(t) - 2) for t in want]
    assert [int(x).to_bytes(3, "little") for x in g] == [t[i:i + 3] for t in want for i in range(len(t) - 2)]


def test_sorted_arrays_find_every_gram():
    g = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 5000))
    from aerocast.llm import common as c
    costs = np.array([np.arange(len(g)), np.arange(len(g)) * 2], np.int32)
    m = px.Arrays(c.mix(g.view(np.uint64)), costs)
    assert (m.costs[0][m.find(g)] == np.arange(len(g))).all() and (np.diff(m.hashes.astype(object)) >= 0).all()
    one = px.Arrays(c.mix(g[:1].view(np.uint64)), costs[:, :1])
    assert one.find(g[:1]).tolist() == [0]


def test_counts_are_added_in_pieces(corpus, monkeypatch):
    rows = invented(3, 40)
    df = corpus(rows).selectExpr("coalesce(lang, '') lang", "cast(doc_id % 2 as int) fold", "coalesce(text, '') text").toArrow()

    def total():
        out = Counter()
        for b in px._grams(4)(iter(df.to_batches(5))):
            for r in b.to_pylist():
                out[r["lang"], r["fold"], r["g"]] += r["n"]
        return out
    whole = total()
    monkeypatch.setattr(px, "HELD", 50)
    assert total() == whole and sum(whole.values()) == sum(max(0, len((t or "").encode()) - 3) for _, _, t in rows)
