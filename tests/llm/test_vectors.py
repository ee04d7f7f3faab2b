import math

import numpy as np

from aerocast.llm import ann, mtree

ODD = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [math.nan, 0.0, 1.0]), (904, [math.inf, 0.0, 1.0]), (None, [1.0, 1.0, 1.0]),
       (905, [0.0, 0.0, 0.0]), (906, [1.0, 2.0])]


def some(n, dim, seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).astype(np.float32)
    v[n // 2:n // 2 + 5] = v[3]                 # copies: ties
    v[5] = v[4] * np.float32(2)
    return [(int(i), [float(x) for x in r]) for i, r in zip(rng.permutation(n), v)]


def brute(rows, queries, k, score, usable):
    out = []
    for q, v in queries:
        best = sorted((-score(v, w), i) for i, w in rows if i is not None and i != q and usable(w) and len(w) == len(v))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def test_top_k_against_brute_force(vectors):
    rows = some(230, 3, 1) + ODD
    fine = lambda w: bool(w) and all(x is not None and math.isfinite(x) for x in w)
    whole = lambda v: np.floor(np.array(v, float) * 256).astype(int)
    df = vectors(rows)
    got = sorted(tuple(r) for r in mtree.top_k(df, df.where("vec_id % 10 = 0 or vec_id > 900")).collect())
    qs = [(i, v) for i, v in rows if i is not None and (i % 10 == 0 or i > 900) and fine(v)]
    assert got == sorted(brute(rows, qs, 5, lambda a, b: int(whole(a) @ whole(b)), fine))
    assert mtree.top_k(vectors([]), vectors([])).count() == 0 and mtree.top_k(df, vectors([])).count() == 0


def test_mtree_prunes_and_keeps_ties():
    rng = np.random.default_rng(2)
    centres = rng.integers(-3000, 3000, (40, 4))
    v = (centres[rng.integers(0, 40, 8000)] + rng.integers(-20, 20, (8000, 4))).astype(np.int64)
    tree = mtree.MTree(v, np.arange(8000))
    for q in range(0, 8000, 400):
        s = v @ v[q]
        assert tree.search(v[q], 5) == [(int(s[i]), int(i)) for i in np.lexsort((np.arange(8000), -s))[:5]]
    assert tree.computed < 0.5 * 20 * 8000
    same = mtree.MTree(np.ones((700, 2), np.int64), np.arange(700)[::-1].copy())
    assert same.search(np.array([1, 1]), 3, skip=0) == [(2, 1), (2, 2), (2, 3)]


def test_mtree_with_a_hot_vector():
    """A third, a tenth and a twentieth of a block are copies of one vector."""
    for share, dim, seed in ((3, 8, 0), (10, 8, 1), (20, 64, 2)):
        rng = np.random.default_rng(seed)
        v = np.floor(rng.normal(size=(8192, dim)) * 256).astype(np.int64)
        v[rng.permutation(8192)[:8192 // share]] = v[0]
        ids = rng.permutation(8192)
        tree = mtree.MTree(v, ids)

        def widest(page, centre):
            """Every routing object's radius covers all vectors below it."""
            for r in range(len(page.at)):
                if page.radius is not None:
                    below = rows_of(page.child[r])
                    assert mtree._dist(tree.x[below], tree.x[page.at[r]]).max() <= page.radius[r] + 1e-6
                    widest(page.child[r], page.at[r])

        def rows_of(page):
            return page.at if page.radius is None else np.concatenate([rows_of(x) for x in page.child])
        widest(tree.root, None)
        near = v[0] + rng.integers(-40, 40, (100, dim))       # queries about the hot vector and anywhere
        for q in [*v[1:8192:90], *near, v[0], -v[0]]:
            s = v @ q
            assert tree.search(q, 5) == [(int(s[i]), int(ids[i])) for i in np.lexsort((ids, -s))[:5]]
        assert tree.search(v[0], 5, skip=int(ids[0])) == [
            x for x in sorted(((int(v[i] @ v[0]), int(ids[i])) for i in range(8192) if i), key=lambda t: (-t[0], t[1]))[:5]]


def test_nearest_against_brute_force(vectors):
    rows = some(230, 3, 3) + ODD
    fine = lambda w: bool(w) and all(x is not None and math.isfinite(x) for x in w) and any(w)

    def cos(a, b):
        a, b = np.array([a], float), np.array([b], float)
        return float(ann.cosines(a, b)[0])
    df = vectors(rows)
    got = sorted(tuple(r) for r in ann.nearest(df, df.where("vec_id % 10 = 0 or vec_id > 900")).collect())
    qs = [(i, v) for i, v in rows if i is not None and (i % 10 == 0 or i > 900) and fine(v)]
    want = sorted(brute(rows, qs, 5, cos, fine))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, want))
    assert ann.nearest(vectors([]), vectors([])).count() == 0


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(4)
    u, v = (x / np.linalg.norm(x, axis=1)[:, None] for x in rng.normal(size=(2, 300, 64)))
    (a, sa, ea), (b, sb, eb) = ann.quantised(u), ann.quantised(v)
    est = (a @ b.T).astype(float) * sa[:, None] * sb[None]
    err = ea[:, None] + eb[None] * (1 + ea[:, None])
    assert (np.abs(u @ v.T - est) <= err + 1e-9).all() and err.max() < 0.05


def test_a_repeated_query_id_asks_once(vectors):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(rng.normal(size=(60, 4)).astype(np.float32))]
    df = vectors(rows + [rows[10], (10, rows[11][1]), rows[20]])
    for found in (ann.nearest(df, df.where("vec_id % 10 = 0")), mtree.top_k(df, df.where("vec_id % 10 = 0"))):
        got = found.collect()
        assert sorted((r.query_id, r.rank) for r in got) == [(q, k) for q in range(0, 60, 10) for k in range(1, 6)]
        assert all(r.query_id != r.vec_id for r in got)


def test_top_k_of_large_components_is_exact():
    """Scores beyond 2**53 are summed as integers; beyond 2**63 it raises."""
    rng = np.random.default_rng(6)
    v = rng.integers(-2 ** 26, 2 ** 26, (400, 64))
    tree = mtree.MTree(v, np.arange(400))
    for q in v[:20]:
        s = v @ q
        assert tree.search(q, 5) == [(int(s[i]), int(i)) for i in np.lexsort((np.arange(400), -s))[:5]]
    with np.testing.assert_raises(ValueError):
        tree.search(v[0] << 20, 5)


def test_many_dimensions_and_tiles(vectors, monkeypatch):
    rng = np.random.default_rng(7)
    u = rng.normal(size=(5, 1500))
    assert ann.quantised(u)[0].dtype == float and ann.quantised(u[:, :900])[0].dtype == np.float32
    monkeypatch.setattr(ann, "TILE", 16)
    x = rng.normal(size=(300, 6))
    x[50:90] = x[3]
    ids = rng.permutation(300)
    got = ann._answer(5)(ann._prepare(ids, x), ids[:40], x[:40])
    cos = ann.cosines(np.repeat(x[:40], 300, axis=0), np.tile(x, (40, 1))).reshape(40, 300)
    for q in range(40):
        want = sorted((-cos[q, i], int(ids[i])) for i in range(300) if i != q)[:5]
        assert sorted((-s, i) for a, i, s in got if a == ids[q]) == want
