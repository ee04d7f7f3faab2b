import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerocast.operators.merge import DuplicateKeyError, keyed_insert, merge_upsert
from aerocast.operators.scd import scd2_snapshot
from aerocast.sinks.tables import merge_into, publish_version, read_current

T = dt.datetime


def test_merge_upsert(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    got = sorted(merge_upsert(t, s, ["k"]).collect(), key=lambda r: (r.k is None, r.k or 0, r.v))
    assert [(r.k, r.v) for r in got] == [(1, "a"), (2, "B"), (3, "C"), (None, "N"), (None, "n")]
    with pytest.raises(DuplicateKeyError):
        merge_upsert(t, s.unionByName(s), ["k"])


def test_keyed_insert_semantics(spark):
    target = spark.createDataFrame([("HKT", "w1", 1)], "a string, w string, n int")
    batch = spark.createDataFrame([("HKT", "w1", 9), ("HKT", "w2", 5), ("HKT", "w2", 3), (None, "w3", 1),
                                   (None, "w3", 2)], "a string, w string, n int")
    add = sorted((tuple(r) for r in keyed_insert(target, batch, ["a", "w"], order=[F.col("n")]).collect()), key=str)
    # existing key skipped, first by order wins, NULL-key rows never conflict
    assert add == sorted([("HKT", "w2", 3), (None, "w3", 1), (None, "w3", 2)], key=str)


def test_scd2_four_cases(spark):
    cols = "airline_key string, callsign string, airline_country string, airline_active boolean"
    v1 = spark.createDataFrame([("k1", "A", "TH", True), ("k2", "B", "TH", True), ("k3", "C", "RU", None)], cols)
    v2 = spark.createDataFrame([("k1", "A", "TH", True), ("k2", "B2", "TH", True), ("k4", "D", "RU", False)], cols)
    check = ["callsign", "airline_country", "airline_active"]
    s1 = scd2_snapshot(None, v1, "airline_key", check, "2026-01-01 00:00:00")
    s2 = scd2_snapshot(s1, v2, "airline_key", check, "2026-02-01 00:00:00")
    rows = {(r.airline_key, r.valid_from.month, r.valid_to.month if r.valid_to else None): r
            for r in s2.collect()}
    assert set(rows) == {("k1", 1, None), ("k2", 1, 2), ("k2", 2, None), ("k3", 1, None), ("k4", 2, None)}
    assert rows[("k2", 2, None)].callsign == "B2"
    # a third identical run changes nothing
    s3 = scd2_snapshot(s2, v2, "airline_key", check, "2026-03-01 00:00:00")
    assert s3.count() == s2.count()


def test_versioned_merge(spark, tmp):
    base = f"{tmp}/fact"
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    merge_into(spark, base, a, ["k"])
    merge_into(spark, base, spark.createDataFrame([(2, "Y"), (3, "z")], "k int, v string"), ["k"])
    cur = sorted(tuple(r) for r in read_current(spark, base).collect())
    assert cur == [(1, "x"), (2, "Y"), (3, "z")]
    assert publish_version(a, base).endswith("v=000003")


def test_partition_wise_merge(spark, tmp):
    import os
    from aerocast.sinks.tables import merge_partitions
    p = f"{tmp}/fact"
    a = spark.createDataFrame([(1, "x", "d1"), (2, "y", "d1"), (3, "z", "d2")], "k int, v string, d string")
    merge_partitions(spark, p, a, ["k"], "d", f"{tmp}/s1")
    before = os.listdir(f"{p}/d=d2")
    b = spark.createDataFrame([(2, "Y", "d1"), (4, "w", "d3")], "k int, v string, d string")
    assert merge_partitions(spark, p, b, ["k"], "d", f"{tmp}/s2") == 2
    got = sorted((r.k, r.v, r.d) for r in spark.read.parquet(p).collect())
    assert got == [(1, "x", "d1"), (2, "Y", "d1"), (3, "z", "d2"), (4, "w", "d3")]
    assert os.listdir(f"{p}/d=d2") == before       # untouched partition not rewritten


def test_merge_partitions_keeps_null_partition(spark, tmp):
    from aerocast.sinks.tables import merge_partitions
    rows = lambda x: spark.createDataFrame(x, "k string, v int, p int")
    merge_partitions(spark, f"{tmp}/t", rows([("a", 1, None), ("b", 1, 1), ("c", 1, None), ("e", 1, 2)]), ["k"], "p", f"{tmp}/s1")
    merge_partitions(spark, f"{tmp}/t", rows([("a", 2, None), ("d", 2, 1)]), ["k"], "p", f"{tmp}/s2")
    merge_partitions(spark, f"{tmp}/t", rows([("e", 3, 2)]), ["k"], "p", f"{tmp}/s3")
    got = sorted((r.k, r.v, r.p) for r in spark.read.parquet(f"{tmp}/t").collect())
    assert got == [("a", 2, None), ("b", 1, 1), ("c", 1, None), ("d", 2, 1), ("e", 3, 2)]


def test_merge_rewrites_only_files_with_matched_keys(spark, tmp):
    import os
    from aerocast.sinks.tables import merge_partitions
    p = f"{tmp}/cow"
    for i in range(3):                                  # three files in one partition
        rows = [(10 * i + j, f"v{i}", 1) for j in range(10)]
        spark.createDataFrame(rows, "k int, v string, d int").coalesce(1).write.mode("append").partitionBy("d").parquet(p)
    files = {f for f in os.listdir(f"{p}/d=1") if f.endswith(".parquet")}
    held = {f: {r.k for r in spark.read.parquet(f"{p}/d=1/{f}").collect()} for f in files}
    changed = spark.createDataFrame([(3, "new", 1), (99, "added", 1), (100, "other", 2), (None, "null", 1)], "k int, v string, d int")
    assert merge_partitions(spark, p, changed, ["k"], "d", f"{tmp}/cow-1") == 2
    left = {f for f in os.listdir(f"{p}/d=1") if f.endswith(".parquet")}
    assert files - left == {f for f, ks in held.items() if 3 in ks} and len(files & left) == 2
    got = {(r.k, r.v, r.d) for r in spark.read.parquet(p).collect()}
    assert got == ({(10 * i + j, f"v{i}", 1) for i in range(3) for j in range(10)} - {(3, "v0", 1)}
                   | {(3, "new", 1), (99, "added", 1), (100, "other", 2), (None, "null", 1)})
    merge_partitions(spark, p, spark.createDataFrame([(None, "again", 1)], "k int, v string, d int"), ["k"], "d", f"{tmp}/cow-2")
    assert spark.read.parquet(p).where("k is null").count() == 2        # NULL keys match nothing
    with pytest.raises(DuplicateKeyError):
        merge_partitions(spark, p, changed.unionByName(changed), ["k"], "d", f"{tmp}/cow-3")
    assert spark.read.parquet(p).count() == 34


def test_cut_short_merge_is_finished(spark, tmp, monkeypatch):
    """The publishing step dies after its plan is written; the next merge
    finishes it first."""
    import aerocast.sinks.tables as tables
    p = f"{tmp}/short"
    rows = lambda x: spark.createDataFrame(x, "k int, v string, d int")
    tables.merge_partitions(spark, p, rows([(1, "a", 1), (2, "b", 1)]), ["k"], "d", f"{tmp}/short-1")

    def dies(*a):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(tables, "_finish_merge", dies)
        with pytest.raises(RuntimeError):
            tables.merge_partitions(spark, p, rows([(2, "B", 1), (3, "c", 2)]), ["k"], "d", f"{tmp}/short-2")
    assert tables.recover_merge(spark, p) and not tables.recover_merge(spark, p)
    assert sorted(tuple(r) for r in spark.read.parquet(p).collect()) == [(1, "a", 1), (2, "B", 1), (3, "c", 2)]


def test_lakehouse_rejects_missing_required_fields(spark, tmp):
    import os
    import pytest
    from aerocast.schemas import RAW_FLIGHT_BATCH
    from aerocast.sinks.tables import write_lakehouse
    import datetime as dt
    ok = ("aerodatabox", "HKT", "IATA", "2025-03-09T00:00", "2025-03-09T12:00", "Both", dt.datetime(2025, 3, 9), "{}")
    write_lakehouse(spark.createDataFrame([ok], RAW_FLIGHT_BATCH), f"{tmp}/lake")
    with pytest.raises(Exception, match="required field is null: to_local"):
        write_lakehouse(spark.createDataFrame([ok[:4] + (None,) + ok[5:]], RAW_FLIGHT_BATCH), f"{tmp}/lake")
    assert spark.read.parquet(f"{tmp}/lake").count() == 1 and os.path.isdir(f"{tmp}/lake/airport_code=HKT")
