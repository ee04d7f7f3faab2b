import math

import numpy as np
import pytest

from aerocast.llm import ball_kmeans as bk


def lloyd(x, parts, entries, rounds, start):
    """Plain rounds over all entries, in Python integers."""
    n, dim = x.shape
    size = dim // parts
    books, codes, errors = [], [], np.zeros(n, np.int64)
    for p in range(parts):
        part = x[:, p * size:(p + 1) * size]
        book = start[:entries, p * size:(p + 1) * size].copy()
        for r in range(rounds + 1):
            d = ((part[:, None] - book[None]) ** 2).sum(axis=2)
            at = d.argmin(axis=1)
            if r < rounds:
                for e in range(len(book)):
                    mine = part[at == e]
                    if len(mine):
                        book[e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
        books.append(book)
        codes.append(at)
        errors += d[np.arange(n), at]
    return np.array(codes).T, errors, books


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    v = (centres[rng.integers(0, 12, n)] + rng.normal(scale=0.05, size=(n, dim))).astype(np.float32)
    v[n // 2:n // 2 + n // 4] = v[3]                   # a hot vector
    v[7] = v[3]                                       # two equal entries: ties to the lower index
    return v


@pytest.mark.parametrize("entries,seed", [(16, 0), (40, 1), (5, 2)])
def test_against_plain_rounds(spark, vectors, entries, seed):
    v = clustered(400, 8, seed)
    ids = np.random.default_rng(seed).permutation(400)
    odd = [(900, None), (901, [1.0] * 7 + [None]), (902, [math.nan] * 8), (903, [math.inf] + [0.0] * 7), (904, [1.0, 2.0]), (905, [])]
    df = vectors([(int(i), [float(y) for y in r]) for i, r in zip(ids, v)] + odd)
    coded, books = bk.compress(df, 4, entries, 4, keep=("label", "score"))
    got = {r.vec_id: r for r in coded.collect()}
    x = np.floor(v.astype(float) * 1024).astype(np.int64)
    codes, errors, want = lloyd(x, 4, entries, 4, x[np.argsort(ids)])
    assert set(got) == set(ids.tolist()) | {904, 905} and got[904].code is None and got[905].error is None
    assert got[0].label == 7 and got[0].score == 2.0
    assert all((b == w).all() for b, w in zip(books, want))
    for i, code, err in zip(ids.tolist(), codes.tolist(), errors.tolist()):
        assert (got[i].code, got[i].error) == (code, err)


def test_balls_spare_distances_and_stay_exact():
    rng = np.random.default_rng(3)
    centres = rng.integers(-5000, 5000, (64, 4))
    x = centres[rng.integers(0, 64, 6000)] + rng.integers(-60, 60, (6000, 4))
    before = centres + rng.integers(-30, 30, centres.shape)
    at, _ = bk.Book(before).nearest(x)
    book = bk.Book(centres, before)
    got, d = book.reassign(x, at)
    full = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (got == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    assert book.computed < 0.2 * full.size
    still = bk.Book(centres, centres)                 # nothing moved: own distances only
    again, _ = still.reassign(x, got)
    assert (again == got).all() and still.computed == len(x)


def test_large_components_stay_exact():
    x = np.array([[1 << 28, 3], [1 << 28, 4]], np.int64)
    assert bk.distances(x, x[::-1]).tolist() == [[1, 0], [0, 1]]
    with pytest.raises(ValueError):
        bk.distances(x << 3, x)


def test_few_rows_repeats_and_empty(vectors):
    coded, books = bk.compress(vectors([(2, [0.5, -0.5]), (1, [0.25, 0.0]), (1, [0.25, 0.0]), (None, [0.3, 0.1])]), 2, 4)
    assert [b.shape for b in books] == [(2, 1), (2, 1)]
    assert sorted((r.vec_id or 0, tuple(r.code)) for r in coded.collect()) == [(0, (0, 0)), (1, (0, 0)), (1, (0, 0)), (2, (1, 1))]
    coded, books = bk.compress(vectors([]), 2)
    assert coded.count() == 0 and books == [] and bk.digest(books) == bk.digest([])
    with pytest.raises(ValueError):
        bk.compress(vectors([(1, [1.0, 2.0, 3.0])]), 2)


def test_hex_codes(spark):
    df = spark.createDataFrame([([0, 10, 255],), (None,)], "code array<int>")
    assert [r.x for r in df.select(bk.hex_code().alias("x")).collect()] == ["000aff", None]
