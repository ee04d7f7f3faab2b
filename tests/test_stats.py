import math
import random

import numpy as np
from pyspark.sql import functions as F

from aerocast.operators.ranks import quantiles, value_ranks
from aerocast.operators.stats import box_stats, correlation_matrix, describe, mann_whitney


def _midranks(xs):
    order = sorted(xs)
    pos = {}
    i = 0
    while i < len(order):
        j = i
        while j < len(order) and order[j] == order[i]:
            j += 1
        pos[order[i]] = (i + 1 + j) / 2
        i = j
    return pos


def test_mann_whitney_matches_brute_force(spark):
    rnd = random.Random(3)
    a = [round(rnd.expovariate(1 / 20), 1) for _ in range(140)] + [5.0] * 10
    b = [round(rnd.expovariate(1 / 25), 1) for _ in range(210)] + [5.0] * 7
    df = spark.createDataFrame([(x, True) for x in a] + [(x, False) for x in b] + [(1.0, None)],
                               "d double, flag boolean")
    r = mann_whitney(df, "d", F.col("flag") == True, F.col("flag") == False).first()  # noqa: E712
    ranks = _midranks(a + b)
    u1 = sum(ranks[x] for x in a) - len(a) * (len(a) + 1) / 2
    n1, n2 = len(a), len(b)
    n = n1 + n2
    from collections import Counter
    tie = sum(t ** 3 - t for t in Counter(a + b).values())
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - tie / (n * (n - 1))))
    z = (max(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / s
    p = min(1.0, math.erfc(z / math.sqrt(2)))
    assert (r.n1, r.n2) == (n1, n2) and r.u_statistic == u1 and r.tie_sum == tie
    assert abs(r.z - z) < 1e-8 and abs(r.p_value - p) < 1e-12
    ez = (u1 - n1 * n2 / 2) / math.sqrt(n1 * n2 * (n + 1) / 12)
    assert abs(r.effect_r - abs(ez) / math.sqrt(n)) < 1e-8


def test_ranks_and_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    rows = [(g, float(rnd.randint(-50, 400)) / 4) for g in ("a", "b", "c") for _ in range(rnd.randint(1, 300))]
    rows += [("a", 7.0)] * 200   # a hot value
    df = spark.createDataFrame(rows, "g string, v double")
    vr = {(r.g, r.v): (r.cnt, r.below) for r in value_ranks(df, "v", ["g"], per_octave=4).collect()}
    for g in ("a", "b", "c"):
        xs = sorted(v for gg, v in rows if gg == g)
        for v in set(xs):
            assert vr[(g, v)] == (xs.count(v), sum(1 for x in xs if x < v))
    q = {r.g: r for r in quantiles(df, "v", [0.25, 0.5, 0.75], ["g"]).collect()}
    for g in ("a", "b", "c"):
        xs = np.array([v for gg, v in rows if gg == g])
        for p, col in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
            assert abs(getattr(q[g], col) - np.percentile(xs, p * 100)) < 1e-9


def test_describe_and_box(spark):
    xs = [1.25, 2.5, 2.5, 10.0, 40.75, 3.0, 0.5]
    df = spark.createDataFrame([(x,) for x in xs], "v double").select(F.col("v").cast("decimal(18,2)").alias("v"))
    d = describe(df, "v").first()
    a = np.array(xs)
    assert d["count"] == 7 and abs(d["mean"] - round(a.mean(), 6)) < 1e-9
    assert abs(d["std"] - round(a.std(ddof=1), 6)) < 1e-9
    assert d["median"] == float(np.median(a)) and d["q25"] == float(np.percentile(a, 25))
    b = box_stats(df.withColumn("c", F.lit("x")), "v", "c").first()
    q1, q3 = np.percentile(a, 25), np.percentile(a, 75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert b.whisker_high == max(x for x in xs if x <= hi) and b.n_outliers == sum(1 for x in xs if x < lo or x > hi)


def test_correlation_pairwise_complete(spark):
    rows = [(1.0, 2.0, True), (2.0, None, False), (3.0, 7.0, True), (4.0, 8.5, None), (5.0, 9.0, False)]
    df = spark.createDataFrame(rows, "a double, b double, c boolean")
    m = {(r.feature_x, r.feature_y): r.corr for r in correlation_matrix(df, ["a", "b", "c"]).collect()}
    ab = [(a, b) for a, b, _ in rows if b is not None]
    exp = np.corrcoef([x for x, _ in ab], [y for _, y in ab])[0, 1]
    assert abs(m[("a", "b")] - round(exp, 9)) < 1e-9 and m[("b", "a")] == m[("a", "b")]
    assert abs(m[("a", "a")] - 1.0) < 1e-9 and len(m) == 9


def test_correlation_from_shared_moments(spark):
    """The same matrix from one set of exact moments per NULL pattern, also
    where a large mean would cancel the digits of a sum of doubles."""
    rnd = random.Random(11)
    rows = []
    for _ in range(300):
        a, b = round(rnd.gauss(1e6, 0.01), 6), round(rnd.gauss(0, 3), 2)
        rows.append((a, None if rnd.random() < 0.2 else round(a * 2 + b / 100, 6), None if rnd.random() < 0.1 else b > 0, 5.0))
    df = spark.createDataFrame(rows, "a double, b double, c boolean, k double")
    m = {(r.feature_x, r.feature_y): r.corr for r in correlation_matrix(df, ["a", "b", "c", "k"], scale=6).collect()}
    from fractions import Fraction

    def corr(i, j):
        both = [(Fraction(str(float(r[i]))), Fraction(str(float(r[j])))) for r in rows if r[i] is not None and r[j] is not None]
        n, sx, sy = len(both), sum(x for x, _ in both), sum(y for _, y in both)
        cov = n * sum(x * y for x, y in both) - sx * sy
        return float(cov) / math.sqrt(n * sum(x * x for x, _ in both) - sx * sx) / math.sqrt(n * sum(y * y for _, y in both) - sy * sy)
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            assert abs(m[x, y] - corr(i, j)) < 1e-8 and m[x, y] == m[y, x]
    assert math.isnan(m["a", "k"]) and len(m) == 16
    empty = correlation_matrix(df.limit(0), ["a", "b"], scale=6).collect()
    assert [r.corr for r in empty] == [None] * 4


def test_normal_tail(spark):
    from aerocast.operators.stats import erfc
    xs = [0.0, 1e-9, 0.3, 1.0, 1.9999999, 2.0, 2.5, 4.0, 8.0, 20.0, -0.5, -3.0]
    got = [r.y for r in spark.createDataFrame([(x,) for x in xs], "x double").select(erfc(F.col("x")).alias("y")).collect()]
    for x, y in zip(xs, got):
        assert abs(y - math.erfc(x)) <= 1e-13 * max(math.erfc(x), 1e-300) * 100, x


def test_exact_small_sample_p(spark):
    from itertools import combinations
    from aerocast.operators.stats import exact_u_sf
    a, b = [1.5, 3.2, 7.7, 9.1], [0.4, 2.2, 2.9, 4.4, 5.0]
    allv = a + b
    n1, n2 = len(a), len(b)
    # brute force: U of every split of the pooled values
    us = []
    for idx in combinations(range(len(allv)), n1):
        xs = [allv[i] for i in idx]
        ys = [allv[i] for i in range(len(allv)) if i not in idx]
        us.append(sum(1 for x in xs for y in ys if x > y))
    u1 = sum(1 for x in a for y in b if x > y)
    u = max(u1, n1 * n2 - u1)
    p_brute = min(1.0, 2 * sum(1 for v in us if v >= u) / len(us))
    assert abs(exact_u_sf(u, n1, n2) * 2 - p_brute) < 1e-12
    df = spark.createDataFrame([(x, True) for x in a] + [(x, False) for x in b], "d double, flag boolean")
    r = mann_whitney(df, "d", F.col("flag") == True, F.col("flag") == False).first()  # noqa: E712
    assert r.u_statistic == u1 and abs(r.p_value - p_brute) < 1e-12


def test_exact_null_distribution():
    from itertools import combinations
    from math import comb
    from aerocast.operators.stats import exact_u_sf
    for m, n in ((1, 1), (2, 3), (3, 5), (4, 4), (5, 3)):
        us = [sum(x) - m * (m - 1) // 2 for x in combinations(range(m + n), m)]
        for u in range(m * n + 2):
            assert abs(exact_u_sf(u, m, n) - sum(x >= u for x in us) / comb(m + n, m)) < 1e-12
    assert 0 < exact_u_sf(8 * 10 ** 9 // 2 + 5, 8, 10 ** 9) < 0.5001
