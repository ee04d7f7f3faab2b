import random
import re
from collections import Counter, defaultdict

import pytest

from aerocast.llm import divergence

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, top):
    """rows: (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, cnt = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for lang, source, text in rows:
        ws = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in WORD.findall(text)]
        groups[lang].add(source)
        docs[lang].update(set(ws))
        cnt[lang, source].update(ws)
    out = []
    for lang, sources in groups.items():
        kept = [w for w, n in docs[lang].items() if n >= least]
        v = len(kept)
        whole = sum((cnt[lang, s] for s in sources), Counter())

        def shares(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 5) // (n + 5 * v) for w in kept}
        p = {s: shares(cnt[lang, s]) for s in sources}
        q = shares(whole)
        for s in sources:
            pair = [(o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in sources if o != s]
            term = [(w, p[s][w] - q[w]) for w in kept if cnt[lang, s][w] and p[s][w] > q[w]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, f, r + 1) for r, (i, f) in enumerate(items[:most])]
    return sorted(out)


@pytest.fixture()
def corpus(spark):
    def make(rows):
        data = [(i, t, la, s, 3, "x", 1) for i, (la, s, t) in enumerate(rows)]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "term string, n int").repartition(3)
    return make


def invented(seed):
    rnd = random.Random(seed)
    vocab = ["ab", "Éa", "éa", "co-op", "x9y", "ZU", "zu", "[b]", "naïve", "日本", "é", "q"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(160):
        text = " ".join(rnd.choices(vocab[rnd.randrange(12):], k=rnd.randint(0, 40)))
        rows.append((rnd.choice(["en", "fr", None, "de"]), rnd.choice(["a", "b", "c", "É", "z", None]), text))
    rows += [("en", "a", rows[0][2])] * 70 + [("en", "b", rows[0][2])] * 5 + [("fr", "b", rows[0][2])] * 3     # hot copies
    rows += [("en", "lonely", None), ("en", "void", ""), ("xx", "only", "ab"), ("yy", "p", "1 2 3"), ("yy", "q", None)]
    rows += [("fr", "long", "ab zu " * 30_000)]
    return rows


def test_against_brute_force(corpus):
    rows = invented(1)
    for least, top in ((4, 5), (30, 50)):
        got = sorted(tuple(r) for r in divergence.audit(corpus(rows), least, top).collect())
        assert got == brute(rows, least, top)


def test_small_batches_give_the_same(corpus, monkeypatch):
    """Folding and counting in pieces: copies of a text in several pieces."""
    rows = invented(2)
    folded = [b for b in divergence._folded(iter(corpus(rows).na.fill("").select("lang", "source", "text").toArrow().to_batches(7)))]
    monkeypatch.setattr(divergence, "HELD_BYTES", 200)
    pieces = [b for b in divergence._folded(iter(corpus(rows).na.fill("").select("lang", "source", "text").toArrow().to_batches(7)))]
    total = lambda bs: sum((Counter({tuple(r.values())[:3]: r["n"] for r in b.to_pylist()}) for b in bs), Counter())
    assert total(folded) == total(pieces) and len(pieces) > len(folded)
    assert sum(total(folded).values()) == len(rows)


def test_empty_and_no_terms(corpus):
    assert divergence.audit(corpus([])).count() == 0
    got = sorted(tuple(r) for r in divergence.audit(corpus([("en", "a", "some words"), ("en", "b", None)])).collect())
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_shares_are_exact_beyond_longs(spark):
    big = 9_000_000_000_000_000
    row = spark.sql(f"select {big} c, {big * 3} n, 7 v").select(divergence.share("c", "n", "v").alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 5) // (3 * big + 35)
