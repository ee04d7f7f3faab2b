import random

from aerocast.llm import quality, toxicity

INSULTS = ("numbskull", "dirtbag", "wretch")


def texts(rnd, n, toxic):
    rows = []
    for i in range(n):
        w = ["".join(rnd.choices(["ta", "re", "mi", "sol", "ka", "ne"], k=rnd.randint(1, 4))) for _ in range(rnd.randint(5, 60))]
        if toxic:
            w[rnd.randrange(len(w))] = rnd.choice(INSULTS)
        rows.append((i, " ".join(w)))
    return rows


def test_toxicity_learns_and_tolerates_gaps(spark, frame):
    rnd = random.Random(1)
    rows = [(i, t) for i, (_, t) in enumerate(texts(rnd, 150, False) + texts(rnd, 60, True))]
    labels = spark.createDataFrame([(i, 1, int(i >= 150)) for i, _ in rows] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(frame(rows), labels)
    clean, bad = texts(rnd, 100, False), texts(rnd, 100, True)
    new = [(i, t) for i, (_, t) in enumerate(clean + bad)]
    odd = [(300, "tare numb-skull mi"), (301, "re D I R T B A G ta"), (302, "a wretcch"), (303, None), (304, ""), (305, "ta " * 40_000),
           (306, "re " * 40_000 + "Dirtbag!"), (307, "k" * 5000)]
    out = toxicity.score(frame(new + odd), model)
    assert "comp" in out.columns
    got = {r.doc_id: r.toxicity_score for r in out.collect()}
    wrong = sum((got[i] >= 0.5) != (i >= 100) for i, _ in new)
    assert wrong <= 4
    assert [round(got[i], 2) for i in (300, 301, 302, 306) if got[i] < 0.5] == []
    assert [round(got[i], 2) for i in (303, 304, 305) if got[i] >= 0.5] == []
    assert all(0 <= s <= 1 for s in got.values())


def test_no_labels_no_model(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = frame([(1, "a b"), (2, None)])
    assert toxicity.train(rows, none) is None and quality.train(rows, none) is None
    assert [r.toxicity_score for r in toxicity.score(rows, None).collect()] == [0.0, 0.0]
    assert {r.quality_score for r in quality.score(rows, None).collect()} == {0.5}
    assert toxicity.score(frame([]), None).count() == 0 and quality.score(frame([]), None).count() == 0


def test_quality_by_compression(spark, frame):
    rnd = random.Random(2)
    bad = lambda: "!! ".join(rnd.choice(["BUY", "NOW", "FREE", "WIN"]) for _ in range(rnd.randint(20, 200)))
    rows = [(i, t) for i, (_, t) in enumerate(texts(rnd, 80, False))] + [(i, bad()) for i in range(80, 160)]
    labels = spark.createDataFrame([(i, int(i < 80), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = quality.train(frame(rows), labels)
    new = [(i, t) for i, (_, t) in enumerate(texts(rnd, 50, False))] + [(i, bad()) for i in range(50, 100)]
    out = quality.score(frame(new + [(200, None), (201, ""), (202, "ta re " * 30_000)]), model)
    got = {r.doc_id: r.quality_score for r in out.collect()}
    assert sum((got[i] >= 0.7) != (i < 50) for i, _ in new) <= 2
    assert got[200] == got[201] and all(0 <= s <= 1 for s in got.values())


def test_cover_leaves_out_what_copies_share():
    having = {b"insult": {1, 2, 3, 4, 5, 6}, b"copied": {1, 2, 3}, b"other": {7, 8, 9}, b"rare": {9}}
    assert toxicity.cover(having, 2) == [b"insult", b"other"]


def kernel_brute(u: bytes, v: bytes) -> float:
    """Gapped triples within a span, from the definition."""
    def phi(w):
        w = b"\1" + w + b"\2"
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                    t = (w[i], w[j], w[k])
                    out[t] = out.get(t, 0) + toxicity.DECAY ** (k - i + 1)
        return out
    a, b = phi(u), phi(v)
    dot = lambda x, y: sum(n * y.get(t, 0) for t, n in x.items())
    return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5


def test_kernel_is_the_stated_one():
    words = [b"idiot", b"banana", b"aaaaaa", b"idiiot", b"id-iot", b"numbskull", b"re", b"x"]
    for u in words:
        assert abs(toxicity.kernel(u, u) - 1) < 1e-9
        for v in words:
            assert abs(toxicity.kernel(u, v) - kernel_brute(u, v)) < 0.02        # 2**18 buckets: rarely, two triples share one
    assert toxicity.kernel(b"idiot", b"idiiot") < 1


def test_remembered_scores_are_the_same():
    import numpy as np
    import pyarrow as pa
    table = np.random.default_rng(0).normal(size=toxicity.BUCKETS).astype(np.float32)
    col = pa.array(["one two three", "two two one!", None, "", "t w o three"])
    memory = toxicity.Scores(table)
    first, again, fresh = (toxicity.strongest(m, col) for m in (memory, memory, toxicity.Scores(table)))
    assert np.array_equal(first[0], again[0]) and np.array_equal(first[0], fresh[0]) and first[1] == again[1]


def test_units_are_scored_in_bounded_memory():
    import tracemalloc
    import numpy as np
    rnd = np.random.default_rng(2)
    table = rnd.normal(size=toxicity.BUCKETS).astype(np.float32)
    n = rnd.integers(1, 12, 60_000)
    data, e = rnd.integers(97, 123, int(n.sum())).astype(np.uint8), np.cumsum(n)
    tracemalloc.start()
    got = toxicity.unit_scores(table, data, e - n, e)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20                                      # all units at once: 113 MB
    some = [0, 1, toxicity.SCORED_UNITS - 1, toxicity.SCORED_UNITS, 59_999]
    assert np.array_equal(got[some], [toxicity.unit_scores(table, data, (e - n)[i:i + 1], e[i:i + 1])[0] for i in some])
    assert not len(toxicity.unit_scores(table, data, e[:0], e[:0]))
