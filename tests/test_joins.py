import datetime as dt
import random

from pyspark.sql import functions as F

from aerocast.operators.interval_join import interval_join, naive_interval_join, nearest_match

T = dt.datetime


def _sets(df):
    return sorted(tuple(r) for r in df.collect())


def test_bucketed_equals_naive_on_random_data(spark):
    rnd = random.Random(7)
    base = T(2026, 1, 1)
    pts = [(i, base + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400))) for i in range(600)]
    pts += [(1000 + i, base + dt.timedelta(hours=h, minutes=30)) for i, h in enumerate(range(0, 40, 3))]
    centers = [(j, base + dt.timedelta(hours=j)) for j in range(72)]
    centers += [(500 + j, base + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400))) for j in range(40)]
    p = spark.createDataFrame(pts, "pid int, pts timestamp_ntz")
    c = spark.createDataFrame(centers, "cid int, cts timestamp_ntz")
    for closed in ("left", "both"):
        for how in ("inner", "left"):
            a = interval_join(p, c, "pts", "cts", 1800, 1800, closed=closed, how=how).select("pid", "cid")
            b = naive_interval_join(p, c, "pts", "cts", 1800, 1800, closed=closed, how=how).select("pid", "cid")
            assert _sets(a) == _sets(b), (closed, how)
    r = interval_join(p, c, "pts", "cts", 1800, 1800, closed="left", how="right", interval_key="cid")
    inner = _sets(interval_join(p, c, "pts", "cts", closed="left").select("cid", "pid"))
    matched = {x[0] for x in inner}
    expect = inner + sorted((cid, None) for cid, _ in centers if cid not in matched)
    assert sorted(_sets(r.select("cid", "pid")), key=str) == sorted(expect, key=str)


def test_boundaries_and_nearest_tie(spark):
    w = spark.createDataFrame([(1, T(2026, 1, 1, 10)), (2, T(2026, 1, 1, 11))], "cid int, cts timestamp_ntz")
    p = spark.createDataFrame([(1, T(2026, 1, 1, 9, 30)), (2, T(2026, 1, 1, 10, 30)), (3, T(2026, 1, 1, 12, 31))],
                              "pid int, pts timestamp_ntz")
    half = _sets(interval_join(p, w, "pts", "cts", closed="left").select("pid", "cid"))
    assert half == [(1, 1), (2, 2)]
    closed = _sets(interval_join(p, w, "pts", "cts", closed="both").select("pid", "cid"))
    assert closed == [(1, 1), (2, 1), (2, 2)]
    j = interval_join(p, w, "pts", "cts", closed="both", how="left")
    n = {r.pid: (r.cid, r.time_diff_seconds) for r in nearest_match(j, "pid", "pts", "cts").collect()}
    assert n[2] == (1, 1800.0) and n[3] == (None, None) and n[1] == (1, 1800.0)


def test_plan_is_equi_join(spark):
    t0 = F.lit(T(2026, 1, 1)).cast("timestamp_ntz")
    p = spark.range(10).select(F.col("id").alias("pid"), F.timestamp_add("MINUTE", F.col("id") * 7, t0).alias("pts"))
    c = spark.range(10).select(F.col("id").alias("cid"), F.timestamp_add("HOUR", F.col("id"), t0).alias("cts"))
    plan = interval_join(p, c, "pts", "cts")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
