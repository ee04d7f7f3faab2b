"""Exact ranks and quantiles without a single-partition window.

A global ``rank()`` or exact ``percentile`` funnels every row through
one task.  Here rows are first reduced to distinct values with counts
(map-side partial aggregation, so a value or group holding a third of
all rows is one row per task), distinct values fall into order-preserving
log-scale buckets, and cumulative counts are assembled from per-bucket
totals (a few thousand rows per group at most) plus a running sum of the
distinct values inside each bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

DEFAULT_PER_OCTAVE = 64


def _join(a: DataFrame, b: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` with NULL-safe equality (groups may be NULL).
    The right side's keys are renamed first, so joining two frames of the
    same lineage stays unambiguous."""
    b2 = b.select(*[F.col(f"`{c}`").alias(f"_r_{c}") if c in cols else F.col(f"`{c}`")
                    for c in b.columns])
    cond = reduce(lambda x, y: x & y, [F.col(f"`{c}`").eqNullSafe(F.col(f"_r_{c}")) for c in cols])
    return a.join(b2, cond, how).drop(*[f"_r_{c}" for c in cols])


def order_bucket(v: Column, per_octave: int = 64) -> Column:
    """Order-preserving integer bucket of a number without any pass over
    the data: 0 for zero, ±(2^20 + ⌊log2|v|·per_octave⌋) otherwise.  A
    bucket spans a relative width of 2^(1/per_octave) − 1 (≈ 1.1 % at 64),
    so buckets stay narrow for any scale; log is monotone, which is all
    the ordering needs."""
    x = v.cast("double")
    mag = F.lit(1 << 20) + F.floor(F.log2(F.abs(x)) * F.lit(per_octave))
    return F.when(x > 0, mag).when(x < 0, -mag).otherwise(F.lit(0)).cast("bigint")


def value_counts_table(df: DataFrame, value: str, groups: list[str] | None = None,
                       extra_aggs: list[Column] | None = None, materialize_result: bool = True,
                       weight: str | None = None) -> DataFrame:
    """(groups…, v, cnt, extras…) — the one pass over the input; partial
    aggregation happens before the shuffle.  With ``weight`` a row stands
    for that many equal rows.  The result (distinct values only) is
    checkpointed because ranks, totals and quantiles all read it."""
    g = list(groups or [])
    aggs = [(F.sum(weight) if weight else F.count(F.lit(1))).alias("cnt")] + list(extra_aggs or [])
    vc = df.filter(F.col(value).isNotNull()).groupBy(*g, F.col(value).alias("v")).agg(*aggs)
    if materialize_result:
        from aerocast.session import materialize
        vc = materialize(vc)
    return vc


def ranks_from_counts(vc: DataFrame, groups: list[str] | None = None,
                      per_octave: int = DEFAULT_PER_OCTAVE) -> DataFrame:
    """Adds ``below`` (rows of the group with a smaller value) to a value
    count table."""
    g = list(groups or [])
    vb = vc.withColumn("b", order_bucket(F.col("v"), per_octave))
    totals = vb.groupBy(*g, "b").agg(F.sum("cnt").alias("bt"))
    before = Window.partitionBy(*g).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("boff", F.coalesce(F.sum("bt").over(before), F.lit(0)))
    inside = Window.partitionBy(*g, "b").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    within = vb.withColumn("win", F.coalesce(F.sum("cnt").over(inside), F.lit(0)))
    out = _join(within, offsets.select(*g, "b", "boff"), g + ["b"])
    return out.withColumn("below", F.col("boff") + F.col("win")).drop("boff", "win")


def value_ranks(df: DataFrame, value: str, groups: list[str] | None = None,
                extra_aggs: list[Column] | None = None, per_octave: int = DEFAULT_PER_OCTAVE,
                weight: str | None = None) -> DataFrame:
    """Per group and distinct non-NULL value: ``cnt`` (rows with it),
    ``below`` (rows of the group with a smaller value) and any
    ``extra_aggs`` computed over the value's rows.  ``below + (cnt+1)/2``
    is the tie-averaged rank."""
    return ranks_from_counts(value_counts_table(df, value, groups, extra_aggs, weight=weight), groups, per_octave)


def quantile_name(p: float) -> str:
    return f"q{round(p * 100, 4):g}".replace(".", "_")


def quantiles(df: DataFrame, value: str, probs: list[float], groups: list[str] | None = None,
              per_octave: int = DEFAULT_PER_OCTAVE) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics
    (pandas' default, Spark's ``percentile``): one row per group with
    columns ``quantile_name(p)`` (``q25`` for 0.25).  Only the ≤ 2·|probs| values holding the needed
    order statistics leave the ranked table."""
    g = list(groups or [])
    src = df if g else df.withColumn("_g", F.lit(0))
    gk = g or ["_g"]
    vr = value_ranks(src, value, gk, per_octave=per_octave)
    return quantiles_from_ranks(vr, probs, gk, drop_group=not g)


def quantiles_from_ranks(vr: DataFrame, probs: list[float], gk: list[str], drop_group: bool = False
                         ) -> DataFrame:
    """Quantiles from a ranked value-count table (see ``quantiles``)."""
    n = vr.groupBy(*gk).agg(F.sum("cnt").alias("n"))
    hs = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    karr = F.array_distinct(F.array(*[F.floor(h).cast("bigint") for h in hs],
                                    *[F.ceil(h).cast("bigint") for h in hs]))
    per_group = n.select(*gk, "n", karr.alias("ks"))
    hit = _join(vr.select(*gk, "v", "cnt", "below"), per_group, gk)
    hit = hit.select(*gk, "n", F.col("v").cast("double").alias("x"), F.explode(F.filter(
        "ks", lambda k: (k >= F.col("below")) & (k < F.col("below") + F.col("cnt")))).alias("k"))
    # ≤ 2·|probs| order statistics per group → a small map k → x
    stats = hit.groupBy(*gk, "n").agg(F.map_from_entries(F.collect_list(F.struct("k", "x"))).alias("m"))
    cols = []
    for p in probs:
        h = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h).cast("bigint"), F.ceil(h).cast("bigint")
        x_lo, x_hi = F.element_at("m", lo), F.element_at("m", hi)
        cols.append((x_lo + (x_hi - x_lo) * (h - lo)).alias(quantile_name(p)))
    out = stats.select(*gk, *cols)
    return out.drop("_g") if drop_group else out
