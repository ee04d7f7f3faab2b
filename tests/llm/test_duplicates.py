import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from aerocast.llm import common as c
from aerocast.llm import lines, ngram_jaccard, substring
from aerocast.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(t):
    return "".join(x.lower() if "A" <= x <= "Z" else x for x in t or "")


def jaccard_brute(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(rnd, n=90, words=60, copies=0.6):
    vocab = [f"w{i}" for i in range(300)] + ["É", "Ab", "the", "THE"]
    passage = " ".join(rnd.choices(vocab, k=25))
    rows, texts = [], []
    for i in range(n):
        if texts and rnd.random() < copies:
            w = rnd.choice(texts).split(" ")
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
        else:
            w = rnd.choices(vocab, k=rnd.choice([1, 2, 3, 4, 5, words, words, 2 * words]))
            if rnd.random() < 0.5:
                w += passage.split(" ")
        texts.append(" ".join(w))
        rows.append((1000 - 3 * i, texts[-1]))
    return rows


def test_words_and_hashes_of_columns():
    texts = ["", None, " a\tb ", "ä b c", "x" * 70_000, "\x0b\x0c"]
    data, off = c.text_bytes(pa.array(texts))
    s, e, first = c.word_spans(data, off)
    got = [[data[s[i]:e[i]].tobytes().decode() for i in range(first[d], first[d + 1])] for d in range(len(texts))]
    assert got == [WORD.findall(t or "") for t in texts]
    h = c.word_hashes(*(lambda d, o: (d, *c.word_spans(d, o)[:2]))(*c.text_bytes(pa.array(["aa bb aa", "bb AA"]))), lower=True)
    assert h[0] == h[2] == h[4] and h[1] == h[3] != h[0]


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(35)] + [(5, 5), (100, 101), (100, 101)]
    edges += [(200 + i, 201 + i) for i in range(30)] + [(500, 501 + i) for i in range(40)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for v in near:
        seen, todo = {v}, [v]
        while todo:
            todo += [x for x in near[todo.pop()] if x not in seen and not seen.add(x)]
        assert got.pop(v) == min(seen)
    assert not got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_join_against_brute_force(spark, frame):
    for seed, (k, num, den) in ((1, (4, 85, 100)), (2, (2, 60, 100))):
        rows = corpus(random.Random(seed))
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_components(frame(rows), k, num, den).collect()}
        assert got == jaccard_brute(rows, k, num, den)


def test_jaccard_join_links_of_members_beside_the_representative(frame):
    """Families of three: a2 is a1 with one word swapped, b is a2 less a
    word.  Where a1 and a2 have one prefix and a1 stands for both, b links
    with a2 alone."""
    rnd, rows, unlinked = random.Random(5), [], 0
    for f in range(60):
        w = [f"f{f}w{i}" for i in range(14)]
        rnd.shuffle(w)
        a2 = [*w[:13], f"f{f}x"]
        texts = [" ".join(x) for x in (w, a2, a2[1:])]
        rows += [(f * 3 + j, t) for j, t in enumerate(texts)]
        doc, h, n = ngram_jaccard.shingle_sets(pa.array(texts), 1)
        sh = c.i64(ngram_jaccard.set_hashes(doc, h, n))
        first = [h[doc == d][:3].tolist() for d in range(2)]
        unlinked += first[0] == first[1] and sh[0] < sh[1]
    assert unlinked >= 5
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_components(frame(rows), 1, 85, 100).collect()}
    assert got == jaccard_brute(rows, 1, 85, 100)
    assert all(got[i][1] == i - i % 3 for i, _ in rows)


def test_jaccard_join_edge_cases(frame):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  two"), (6, "one three"), (7, long), (9, long + " x"),
            (None, "one two"), (8, "a b c d e"), (8, "a b c d e")]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_components(frame(rows)).collect()]
    assert Counter(got) == Counter([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 29_997, 7), (9, 29_998, 7),
                                    (None, 1, 4), (8, 2, 8), (8, 2, 8)])
    assert ngram_jaccard.jaccard_components(frame([])).count() == 0


def substring_brute(rows, k):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - k + 1):
            x = tuple(w[s:s + k])
            if x in seen:
                gone[s:s + k] = [True] * k
            seen.add(x)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def test_substring_dedup_against_brute_force(frame):
    rnd = random.Random(7)
    base = [" ".join(rnd.choices("a b c dd é f".split(), k=rnd.randint(0, 60))) for _ in range(6)]
    rows = [(50 - i, "\n ".join(rnd.choices(base, k=rnd.randint(0, 3)))) for i in range(40)]
    rows += [(60, "a " * 90), (61, None), (62, "")]
    for k, m in ((20, 6), (5, 5)):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.dedupe_substrings(frame(rows), k, m).collect()}
        assert got == substring_brute(rows, k)


def test_substring_dedup_edge_cases(frame):
    p = " ".join(f"p{i}" for i in range(25))
    rows = [(3, p), (3, p), (None, p), (5, "q " + p)]
    got = Counter((r.doc_id, r.n_removed, r.kept) for r in substring.dedupe_substrings(frame(rows)).collect())
    assert got == Counter([(3, 0, p), (3, 0, p), (None, 25, ""), (5, 25, "q")])
    assert substring.dedupe_substrings(frame([])).count() == 0


def test_runs_split_between_batches():
    """The scan gives the same spans however the sorted rows are cut."""
    rnd = random.Random(1)
    rows = sorted((rnd.randrange(6), rnd.randrange(3), rnd.randrange(5), rnd.randrange(50)) for _ in range(60))
    t = pa.table({"mkey": [r[0] for r in rows], "whash": [r[1] for r in rows], "did": [r[2] for r in rows],
                  "pos": [r[3] for r in rows], "n": pa.array([1] * 60, pa.int32()), "known": [False] * 60})
    want = None
    for size in (1000, 1, 2, 7):
        got = Counter((r["mkey"], r["did"], r["pos"], r["again"]) for b in substring._scan(iter(t.to_batches(size))) for r in b.to_pylist())
        want = want or got
        assert got == want


def line_brute(rows):
    occ = []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        for no, x in enumerate((t or "").split("\n")):
            data, s, e, _, _ = lines.line_words(pa.array([x]))
            if len(s):
                wh = c.word_hashes(data, s, e)
                occ.append((i, no, " ".join(data[a:b].tobytes().decode() for a, b in zip(s, e)), int(lines.simhashes(wh, np.array([0]))[0])))
    comp = list(range(len(occ)))

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in range(len(occ)):
        for b in range(a):
            x, y = occ[a], occ[b]
            if bin(x[3] ^ y[3]).count("1") <= 3 and lev(x[2], y[2]) <= max(len(x[2]), len(y[2])) * 20 // 100:
                p, q = sorted((find(a), find(b)))
                comp[q] = p
    gone = {(occ[i][0], occ[i][1]) for i in range(len(occ)) if find(i) != i}
    return {i: None if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if (i, no) not in gone) for i, t in rows}


def test_line_dedup_against_brute_force(frame):
    rnd = random.Random(3)
    vocab = [f"word{i}" for i in range(40)]
    base = [" ".join(rnd.choices(vocab, k=rnd.choice([2, 12, 30]))) for _ in range(12)]
    rows = []
    for i in range(25):
        ls = []
        for _ in range(rnd.randint(0, 5)):
            w = rnd.choice(base).split(" ")
            if rnd.random() < 0.5:
                w[rnd.randrange(len(w))] = rnd.choice(["Word1", "7", "x"])
            ls.append(" ".join(w))
        rows.append((100 - i, "\n".join(ls)))
    got = {r.doc_id: r.text for r in lines.dedupe_lines(frame(rows)).collect()}
    assert got == line_brute(rows)


def test_line_dedup_edge_cases(frame):
    long = " ".join("w" + "".join(chr(97 + int(d)) for d in str(i)) for i in range(4000))   # only words of letters
    rows = [(1, None), (2, ""), (3, "Year 1999 report of things\n\nkeep this"), (4, "  year 2004  report of things \n\n"), (5, long),
            (6, long + " tail"), (7, "same"), (7, "same"), (None, "SAME\nown words here")]
    out = lines.dedupe_lines(frame(rows))
    assert set(out.columns) >= {"doc_id", "text", "lang", "source", "n_chars", "comp", "lines_removed"}
    got = Counter((r.doc_id, r.text, r.lines_removed) for r in out.collect())
    # the year is part of the line: with another one it is another line, unless it is a near copy by candidates and similarity
    assert got == Counter([(1, None, 0), (2, "", 0), (3, rows[2][1], 0), (4, rows[3][1], 0), (5, long, 0), (6, "", 1), (7, "same", 0),
                           (7, "same", 0), (None, "own words here", 1)])
    assert lines.dedupe_lines(frame([])).count() == 0


def test_lines_of_other_numbers_stay(frame):
    rows = [(1, "account 12345678 balance 99887766"), (2, "account 90817263 balance 10293847"), (3, "account 12345678  Balance 99887766")]
    got = {r.doc_id: (r.text, r.lines, r.lines_removed) for r in lines.dedupe_lines(frame(rows)).collect()}
    assert got == {1: (rows[0][1], 1, 0), 2: (rows[1][1], 1, 0), 3: ("", 1, 1)}


def test_lines_are_counted_before(frame):
    rows = [(1, "one and only line"), (2, "one and only line"), (3, "one and only line\n"), (4, None), (5, ""), (6, "a\n\nb")]
    got = {r.doc_id: (r.lines, r.lines_removed, r.text) for r in lines.dedupe_lines(frame(rows)).collect()}
    assert got == {1: (1, 0, rows[0][1]), 2: (1, 1, ""), 3: (2, 1, ""), 4: (0, 0, None), 5: (1, 0, ""), 6: (3, 0, "a\n\nb")}


def test_common_ends_do_not_change_the_distance():
    rnd = random.Random(9)

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]
    for _ in range(400):
        a, b = ("".join(rnd.choices("abé", k=rnd.randint(0, 9))) for _ in range(2))
        p, q = lines.unlike(a, b)
        assert lev(p, q) == lev(a, b) and p in a and q in b
        assert not p or not q or (p[0] != q[0] and p[-1] != q[-1])


def test_near_copies_go_row_by_row(frame):
    """A text of its own stays though its id also stands on a copy; a copy
    goes though its id is null; of repeated rows one stays."""
    a = " ".join(f"a{i}" for i in range(60))
    near, own = a + " more", " ".join(f"o{i}" for i in range(30))
    rows = [(1, a), (5, near), (5, own), (None, a), (None, "quite another text of its own here"), (7, own + " x y z"), (7, own + " x y z"),
            (8, "alone in the world of words"), (8, "alone in the world of words"), (9, None), (10, ""), (2, a.upper())]
    got = Counter((r.doc_id, r.text) for r in ngram_jaccard.drop_near_copies(frame(rows)).collect())
    assert got == Counter([(1, a), (5, own), (None, "quite another text of its own here"),
                           (8, "alone in the world of words"), (9, None), (10, "")])
    assert ngram_jaccard.drop_near_copies(frame([])).count() == 0


def test_bound_of_the_distance_spares_the_computation(spark):
    """Pairs that words put for words already tell to link reach no
    levenshtein; the bound is never below the distance."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(0, 4)))
    pairs = []
    for _ in range(200):
        x = [word() for _ in range(rng.randint(0, 6))]
        y = [word() if rng.random() < 0.3 else w for w in x] + [word()] * rng.randint(0, 1)
        pairs.append((" ".join(x), " ".join(y)))
    got = spark.createDataFrame(pairs, "x string, y string").select("x", "y", F.levenshtein("x", "y").alias("d")).collect()
    assert all(lines.at_most(r.x, r.y) >= r.d for r in got)
    common = "the same words here and there"
    p, q = f"one {common} six", f"two {common} ten"
    b = pa.RecordBatch.from_pylist([{"la": 1, "lb": 2, "ka": len(p), "kb": len(q), "xa": p, "xb": q, "ya": None, "yb": None},
                                    {"la": 1, "lb": 3, "ka": len(p), "kb": len(p) + 2, "xa": p, "xb": f"a {p}", "ya": None, "yb": None},
                                    {"la": 1, "lb": 4, "ka": len(p), "kb": len(p) + 4, "xa": p, "xb": f"six {common} one x y", "ya": None, "yb": None}])
    assert [(r["p"], r["q"]) for r in next(lines._unlike([b])).to_pylist()] == [("", ""), ("", ""), (p, f"six {common} one x y")]


def test_shared_keys_are_those_of_several_lines(spark, monkeypatch):
    """Keys made by numpy are those of the columns; a key counts once a
    piece, and is shared if any two lines have it, of one piece or of two."""
    rng = np.random.default_rng(5)
    sim = rng.integers(-2 ** 63, 2 ** 63 - 1, 300)
    sim = np.concatenate([sim, sim[:40] ^ (1 << 63 - 2), sim[:20]])
    rows = spark.createDataFrame([(int(x),) for x in sim], "sim long").select(F.explode(lines.block_keys()).alias("key")).collect()
    want = Counter(r.key for r in rows)
    assert sorted(r.key for r in rows) == sorted(lines.sorted_block_keys(sim).tolist()) and len(rows) == 20 * len(sim)
    batches = [pa.RecordBatch.from_pydict({"sim": x}) for x in np.array_split(sim, 7)]
    monkeypatch.setattr(lines, "KEYED_LINES", 30)
    for pieces in ([batches], [batches[:3], batches[3:]], [[b] for b in batches], [[]]):
        marks = [m for piece in pieces for m in lines._key_marks(piece)]
        for rows in (1, 2, 7, len(marks) or 1, 1 << 16):
            monkeypatch.setattr(lines, "POSTED_LINES", rows)
            got = [k for b in lines._shared_keys(marks) for k in b.column(0).to_pylist()]
            assert sorted(got) == sorted(k for k, n in want.items() if n > 1 and pieces != [[]])


def test_simhashes_of_lines_of_any_length():
    import numpy as np
    rnd = np.random.default_rng(4)
    wh = rnd.integers(0, 2 ** 63, 5000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    wh[100:400] = wh[100]                       # one word again and again
    starts = np.array([0, 1, 3, 50, 100, 450, 705, 960, 1300, 4990])

    def slow(words):
        h = c.mix(np.unique(words >> np.uint64(24)) ^ np.uint64(0xA5A5F00D5EED1234))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        return int(np.packbits(2 * bits.astype(int).sum(axis=0) > len(h)).view(np.uint64)[0])
    got = lines.simhashes(wh, starts).tolist()
    assert got == [slow(wh[a:b]) for a, b in zip(starts, np.append(starts[1:], len(wh)))]


def test_repeated_shingles_are_found_in_place():
    import tracemalloc
    from aerocast.llm import ngram_jaccard as nj
    h = np.random.default_rng(3).integers(0, 1 << 20, 1 << 20).astype(np.uint64)
    want, cnt = np.unique(h, return_counts=True)
    tracemalloc.start()
    got = nj.repeated(h)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got[0], want[cnt > 1]) and np.array_equal(got[1], cnt[cnt > 1])
    assert peak < 2 * h.nbytes                                  # np.unique: 3
    for x in ([], [5], [5, 5], [7, 5, 7, 7]):
        got = nj.repeated(np.array(x, np.uint64))
        assert list(zip(*(v.tolist() for v in got))) == [(v, x.count(v)) for v in sorted(set(x)) if x.count(v) > 1]


def test_workers_give_freed_memory_back(monkeypatch):
    from aerocast.llm import common as c, lines, toxicity
    given = []
    monkeypatch.setattr(c, "give_back", lambda: given.append(1))
    run = c.lean(lambda batches: (2 * b for b in batches))
    assert list(run(iter([1, 2]))) == [2, 4] and len(given) == 1
    part = run(iter([1, 2]))
    assert next(part) == 2
    part.close()                                                # a task that ends early (a limit)
    assert len(given) == 2
    assert not list(lines._occurrences(iter([]))) and not list(toxicity._unit_rows(iter([]))) and len(given) == 4
