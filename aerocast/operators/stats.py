"""Descriptive statistics and rank tests on DataFrames.

Everything is a distributed aggregation; only fixed-size summaries
(one row per test or group) are produced.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from aerocast.functions.exact import half_up_ratio, to_units
from aerocast.session import ship_package
from aerocast.operators.ranks import (
    _join, quantiles, quantiles_from_ranks, ranks_from_counts, value_counts_table, value_ranks,
)

QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, value: str, groups: list[str] | None = None, scale: int = 2,
             weight: str | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25 %, 50 %, 75 %, max per group.
    ``value`` must be exact with ``scale`` decimals; with ``weight`` a row
    stands for that many equal rows.  One pass over the
    input builds the (group, value, count) table; every statistic comes
    from it: the mean exactly (rounded half-up to 6 decimals), the sample
    std from exact sums (rounded to 6 decimals), quantiles by rank."""
    g = list(groups or [])
    src = df if g else df.withColumn("_g", F.lit(0))
    gk = g or ["_g"]
    vc = value_counts_table(src, value, gk, weight=weight)
    units = to_units(F.col("v"), scale)                       # exact integers
    cnt = F.col("cnt").cast("decimal(38,0)")
    base = vc.groupBy(*gk).agg(
        F.sum("cnt").alias("count"), F.sum(cnt * units).alias("_s"),
        F.sum(cnt * units * units).alias("_ss"),
        F.min("v").cast("double").alias("min"), F.max("v").cast("double").alias("max"))
    n = F.col("count").cast("decimal(38,0)")
    var_num = n * F.col("_ss") - F.col("_s") * F.col("_s")      # n·Σx² − (Σx)², exact
    std = F.sqrt(F.try_divide(var_num.cast("double"), (n * (n - 1)).cast("double"))) / F.lit(float(10 ** scale))
    base = base.select(*gk, "count",
                       half_up_ratio(F.col("_s") * F.lit(10 ** (6 - scale)), F.col("count"), 6)
                       .cast("double").alias("mean"),
                       F.round(F.when(F.col("count") > 1, std), 6).alias("std"), "min", "max")
    q = quantiles_from_ranks(ranks_from_counts(vc, gk), QUARTILES, gk)
    out = _join(base, q, gk).select(*gk, "count", "mean", "std", "min", "q25",
                                    F.col("q50").alias("median"), "q75", "max")
    return out if g else out.drop("_g")


EXACT_MAX_SMALL = 8             # scipy's rule: exact when a sample has ≤ 8 values and no ties


def exact_u_sf(u: int, m: int, n: int) -> float:
    """P(U ≥ u) for samples of sizes m, n without ties, in whole numbers.

    U counts like partitions of at most min(m, n) parts of at most max(m, n):
    a quotient of products of 1 − q^k.  The numerator has 2^min(m, n) terms,
    and up to a sum s the reciprocal of the denominator is a sum of
    binomials, one per residue of lcm(1..min(m, n)).  Cost and memory depend
    on the smaller sample only."""
    m, n = min(m, n), max(m, n)
    u = max(u, 0)
    if u > m * n:
        return 0.0
    step = math.lcm(*range(1, m + 1))
    poly = [1]                              # ∏ (1 − q^step) / (1 − q^i), a polynomial
    for i in range(1, m + 1):
        out = [0] * (len(poly) + step - i)
        for k in range(0, step, i):
            for j, x in enumerate(poly):
                out[j + k] += x
        poly = out
    ones = [0] * (len(poly) + step - 1)     # the further 1 / (1 − q) sums up to s
    total = 0
    for j in range(len(ones)):
        total += (poly[j] if j < len(poly) else 0) - (poly[j - step] if j >= step else 0)
        ones[j] = total

    def up_to(s: int) -> int:
        return sum(ones[r] * math.comb((s - r) // step + m, m) for r in range(s % step, min(s, len(ones) - 1) + 1, step))
    terms = {0: 1}
    for i in range(1, m + 1):
        for at, sign in list(terms.items()):
            terms[at + n + i] = terms.get(at + n + i, 0) - sign
    # by symmetry P(U ≥ u) = P(U ≤ mn − u)
    count = sum(sign * up_to(m * n - u - at) for at, sign in terms.items() if m * n - u >= at)
    return count / math.comb(m + n, m)


_SERIES_TERMS, _FRACTION_LEVELS = 60, 120     # enough for double precision on either side of 2


def erfc(x: Column) -> Column:
    """Complementary error function as JVM expressions: below 2 the series
    of erf (all terms positive), from 2 on the continued fraction, which
    keeps its relative accuracy however small the tail is."""
    small, a = F.abs(x) < 2, F.abs(x)
    start = F.struct(a.alias("t"), a.alias("s"))

    def more(acc, n):
        t = acc["t"] * (2 * a * a) / (2 * n + 1)
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(_SERIES_TERMS)), start, more, lambda acc: acc["s"])
    low = 1 - F.lit(2 / math.sqrt(math.pi)) * F.exp(-a * a) * series
    fraction = F.aggregate(F.sequence(F.lit(_FRACTION_LEVELS), F.lit(1), F.lit(-1)), F.lit(0.0), lambda t, k: k / 2 / (a + t))
    high = F.exp(-a * a) / F.lit(math.sqrt(math.pi)) / (a + fraction)
    tail = F.when(small, low).otherwise(high)
    return F.when(x < 0, 2 - tail).otherwise(tail)


@F.pandas_udf(T.DoubleType())
def _exact_p(u1: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    """Two-sided exact p of the tests that need it (one row per test); rows
    of null are other tests."""
    out = []
    for u, m, n in zip(u1, n1, n2):
        if pd.isna(u) or pd.isna(m) or pd.isna(n):
            out.append(None)
        else:
            out.append(min(1.0, 2.0 * exact_u_sf(int(round(max(u, m * n - u))), int(m), int(n))))
    return pd.Series(out, dtype="float64")


def mann_whitney_grouped(samples: DataFrame, value: str, test: str = "test", side: str = "side",
                         with_p: bool = True, weight: str | None = None) -> DataFrame:
    """Two-sided Mann–Whitney U per ``test``: ``side`` is 1 for the first
    sample, 2 for the second (other rows are ignored).  Normal
    approximation with tie and continuity correction; the exact null
    distribution when a sample has ≤ 8 values and there are no ties, which
    is scipy's automatic choice.  One row per test: n1, n2, u_statistic (U of the first
    sample), tie_sum Σ(t³−t), z, p_value and the write-up's effect size
    effect_z = (U1 − n1·n2/2)/√(n1·n2·(N+1)/12), effect_r = |effect_z|/√N.
    With ``weight`` a row stands for that many equal values.  All tests
    share one pass of ``value_ranks`` (no single-partition window); an empty
    sample gives NULL statistics."""
    d = samples.filter(F.col(side).isin(1, 2)).select(
        F.col(test).alias("test"), F.col(value).alias("_v"), F.col(side).alias("_side"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("_n"))
    first = F.sum(F.when(F.col("_side") == 1, F.col("_n")).otherwise(0))
    vr = value_ranks(d, "_v", ["test"], extra_aggs=[first.alias("c1")], weight="_n")
    s = vr.groupBy("test").agg(
        F.sum("c1").alias("n1"), (F.sum("cnt") - F.sum("c1")).alias("n2"),
        F.sum(F.col("c1").cast("decimal(38,0)") * (F.col("below") * 2 + F.col("cnt") + 1)).alias("r1x2"),
        F.sum(_cube_minus(F.col("cnt").cast("decimal(38,0)"))).alias("tie"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    div = F.try_divide
    u1 = ((F.col("r1x2") - F.col("n1").cast("decimal(38,0)") * (F.col("n1") + 1)) / 2).cast("double")
    u2 = n1 * n2 - u1
    sigma = F.sqrt(n1 * n2 / F.lit(12.0) * ((n + 1) - div(F.col("tie").cast("double"), n * (n - 1))))
    z = div(F.greatest(u1, u2) - n1 * n2 / F.lit(2.0) - F.lit(0.5), F.when(sigma > 0, sigma))
    ez = div(u1 - n1 * n2 / F.lit(2.0), F.when(n1 * n2 > 0, F.sqrt(n1 * n2 * (n + 1) / F.lit(12.0))))
    out = s.select("test", F.col("n1").cast("bigint").alias("n1"), F.col("n2").cast("bigint").alias("n2"),
                   u1.alias("u_statistic"), F.col("tie").cast("double").alias("tie_sum"),
                   F.round(z, 9).alias("z"), F.round(ez, 9).alias("effect_z"),
                   F.round(div(F.abs(ez), F.sqrt(n)), 9).alias("effect_r"), z.alias("_z"))
    if with_p:
        ship_package(samples.sparkSession)
        exact = (F.least("n1", "n2") <= EXACT_MAX_SMALL) & (F.col("tie_sum") == 0)
        out = out.withColumn("p_method", F.when(F.least("n1", "n2") > 0, F.when(exact, "exact").otherwise("asymptotic")))
        only = [F.when(F.col("p_method") == "exact", F.col(x).cast("double")) for x in ("u_statistic", "n1", "n2")]
        out = out.withColumn("p_value", F.when(F.col("p_method") == "exact", _exact_p(*only))
                             .when(F.col("p_method") == "asymptotic", F.least(F.lit(1.0), erfc(F.col("_z") / F.lit(math.sqrt(2.0))))))
    return out.drop("_z")


def mann_whitney(df: DataFrame, value: str, first: Column, second: Column, test: str = "test",
                 with_p: bool = True) -> DataFrame:
    """One comparison: rows where ``first`` holds against rows where
    ``second`` holds (see ``mann_whitney_grouped``)."""
    side = F.when(first, F.lit(1)).when(second, F.lit(2))
    samples = df.select(F.lit(test).alias("test"), F.col(value).alias("_value"), side.alias("side"))
    return mann_whitney_grouped(samples, "_value", with_p=with_p)


def _cube_minus(t: Column) -> Column:
    return t * t * t - t


def shared_moments(df: DataFrame, cols: list[str], scale: int) -> list[dict]:
    """Per pattern of NULLs: row count, sums and cross products of the
    columns as whole numbers of 10**-scale, exact (decimals; no value may
    have more decimals).  One aggregation; a row per pattern that occurs
    reaches the driver, of k(k + 3)/2 + 1 numbers each."""
    unit = [F.round(F.col(c).cast("double") * F.lit(10.0 ** scale)).cast("decimal(19,0)") for c in cols]
    d = df.select(*(u.alias(f"x{i}") for i, u in enumerate(unit)))
    pattern = F.concat(*(F.when(F.col(f"x{i}").isNull(), "0").otherwise("1") for i in range(len(cols))))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    rows = d.groupBy(pattern.alias("pattern")).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(len(cols))),
        *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs)).collect()
    return [{"pattern": r["pattern"], "n": r["n"], "s": [int(r[f"s{i}"] or 0) for i in range(len(cols))],
             "p": {(i, j): int(r[f"p{i}_{j}"] or 0) for i, j in pairs}} for r in rows]


def _shared_correlation(df: DataFrame, cols: list[str], digits: int, scale: int) -> DataFrame:
    moments = shared_moments(df, cols, scale)
    rows = []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            both = [m for m in moments if m["pattern"][i] == "1" and m["pattern"][j] == "1"]
            n = sum(m["n"] for m in both)
            si, sj = (sum(m["s"][k] for m in both) for k in (i, j))
            pii, pij, pjj = (sum(m["p"][k] for m in both) for k in ((i, i), (i, j), (j, j)))
            vi, vj = n * pii - si * si, n * pjj - sj * sj                  # exact: no cancellation
            r = None if not n else math.nan if not vi * vj else round((n * pij - si * sj) / math.sqrt(vi) / math.sqrt(vj), digits)
            rows += [(a, cols[j], r)] + ([(cols[j], a, r)] if i != j else [])
    return df.sparkSession.createDataFrame(rows, "feature_x string, feature_y string, corr double")


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 9, scale: int | None = None) -> DataFrame:
    """Pearson correlation of every ordered column pair, pairwise-complete
    (a pair uses the rows where both are non-NULL); booleans count as 0/1.
    One aggregation pass; long format (feature_x, feature_y, corr).

    With ``scale`` (decimals of the values) all pairs share one set of
    exact moments per pattern of NULLs (``shared_moments``); else each pair
    is a correlation of its own over masked columns."""
    if scale is not None:
        return _shared_correlation(df, cols, digits, scale)
    x = {c: F.col(c).cast("double") for c in cols}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = x[a].isNotNull() & x[b].isNotNull()
        aggs.append(F.corr(F.when(both, x[a]), F.when(both, x[b])).alias(f"c{i}"))
    row = df.agg(*aggs)
    entries = []
    for i, (a, b) in enumerate(pairs):
        entries.append(F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"),
                                F.round(F.col(f"c{i}"), digits).alias("corr")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("feature_x"), F.lit(a).alias("feature_y"),
                                    F.round(F.col(f"c{i}"), digits).alias("corr")))
    return row.select(F.inline(F.array(*entries)))


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Box-plot numbers per category: quartiles, IQR, whiskers at the most
    extreme values within 1.5·IQR of the box, outlier count."""
    v = F.col(value).cast("double")
    src = df.select(F.col(by).alias("category"), v.alias("_x")).filter(F.col("_x").isNotNull())
    q = quantiles(src, "_x", QUARTILES, ["category"])
    q = q.select("category", F.col("q25").alias("q1"), F.col("q50").alias("median"),
                 F.col("q75").alias("q3"))
    j = _join(src, q, ["category"])
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    inside = (F.col("_x") >= lo) & (F.col("_x") <= hi)
    return (j.groupBy("category", "q1", "median", "q3")
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
                 F.count(F.when(~inside, 1)).alias("n_outliers"))
            .withColumn("iqr", F.col("q3") - F.col("q1")))


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, one pass."""
    row = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"n{i}")
                   for i, c in enumerate(df.columns)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
        for i, c in enumerate(df.columns)])))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-NULL value, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), col))


def multiplicity_histogram(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur once, twice, …: (rows_per_key, keys)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_per_key"))
            .groupBy("rows_per_key").agg(F.count(F.lit(1)).alias("keys")).orderBy("rows_per_key"))


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns, distinct keys of the first column)."""
    c0 = df.columns[0]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
                  F.countDistinct(c0).alias("distinct_first_column"))
