"""Wide rows are made late, moved once and staged in compressed columns."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from aerocast.operators.dedupe import latest_per_key
from aerocast.plans import analogues as an


def _tables(spark, folder):
    day = dt.datetime(1995, 1, 2)
    lines = [(1, n, n % 3, n, float(n), 0.0, 0.0, "N", "O", day, float(n)) for n in range(20, 0, -1)] + [(2, 4, None, 1, 1.0, 0.1, 0.1, "N", "O", day, 1.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
                                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz, l_extendedprice double").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(2, 5, day), (2, 5, day), (22, 5, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").union(
        spark.createDataFrame([(1, 5, day)], "a long, b long, c timestamp_ntz")).write.parquet(f"{folder}/orders.parquet")


def test_pages_are_made_from_narrow_lines(spark, tmp):
    _tables(spark, tmp)
    pages = an.fids_batches_with_order(spark, tmp)
    assert "collect_list" not in pages._jdf.queryExecution().toString()
    got = [json.loads(r.payload) for r in pages.where("_ok = 1").collect()]
    numbers = sorted([int(x["number"][1:]) for x in p["departures"]] for p in got)
    assert numbers == [[1, 3, 5, 7], [9, 11, 13, 15], [17, 19]] and all(p["arrivals"] is None for p in got)
    twice = [json.loads(r.payload) for r in pages.where("_ok = 2").collect()]
    assert len(twice) == 1 and [x["number"] for x in twice[0]["arrivals"]] == ["L4", "L4"]
    assert pages.where("_ok = 22").count() == 0


def test_latest_row_is_moved_once(spark):
    rows = [("a", 1, None, "x"), ("a", 2, None, "y"), ("a", 2, 1, "w"), (None, 1, 1, "z"), (None, 1, 1, "q")]
    df = spark.createDataFrame(rows, "k string, t int, u int, v string")
    last = latest_per_key(df, ["k"], [F.col("t")], total=True)
    assert last.columns == df.columns and "max_by" not in last._jdf.queryExecution().toString()
    assert sorted(map(tuple, last.collect()), key=str) == [("a", 2, 1, "w"), (None, 1, 1, "z")]


def test_appends_stage_no_checkpoint(spark, tmp):
    from aerocast.session import shared_dir
    from aerocast.sinks.tables import append_keyed
    found = lambda: {x for p in ("rdd-*", "staged-*", "*/rdd-*") for x in glob.glob(f"{shared_dir(spark).removeprefix('file:')}/{p}")}
    before = found()
    df = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "k int, v string")
    assert [append_keyed(spark, f"{tmp}/t", df, ["k"]) for _ in range(2)] == [2, 0] and found() == before


def test_topic_files_are_compressed(spark, tmp):
    from aerocast.streaming.ingest import publish
    rows = spark.range(3).selectExpr("'HKT' airport_code", "cast(id as string) from_local", "'{}' payload")
    publish(rows, f"{tmp}/topic")
    assert all(f.endswith(".txt.gz") for f in os.listdir(f"{tmp}/topic") if f.startswith("part-")) and spark.read.text(f"{tmp}/topic").count() == 3


def test_landing_and_seed_files_are_compressed(spark, tmp):
    from aerocast.registry import QUERIES
    from aerocast.session import shared_dir
    from aerocast.sources.landing import read_landing
    from aerocast.streaming.ingest import publish
    rows = spark.range(30).selectExpr("'HKT' airport_code", "cast(id as string) from_local", "'{}' payload")
    publish(rows, f"{tmp}/topic", landing_dir=f"{tmp}/land")
    files = [f for _, _, names in os.walk(f"{tmp}/land") for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files) and read_landing(spark, f"{tmp}/land")[0].count() == 30
    _tables(spark, tmp)
    found = lambda name: set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/{name}"))
    seeds, staged = found("variant-*/seed.csv/part-*"), found("landing-*/*/part-*")
    flights = {(r.target, r.board): r.flights for r in QUERIES["raw_source_variant"](spark, tmp).collect()}
    assert flights == {(t, b): n for t in ("ci", "dev") for b, n in (("arrivals", 2), ("departures", 10))}
    new = found("variant-*/seed.csv/part-*") - seeds
    assert new and all(f.endswith(".csv.gz") for f in new)
    assert QUERIES["landing_replay_raw"](spark, tmp).count() == 2
    new = found("landing-*/*/part-*") - staged
    assert new and all(f.endswith(".json.gz") for f in new)


def test_tables_are_written_in_zstd(spark, tmp):
    from aerocast.plans.build import Layers
    from aerocast.sinks.tables import append_keyed, load_to_raw, write_lakehouse
    df = spark.range(3).selectExpr("'HKT' airport_code", "id", "timestamp_ntz'2024-01-02 00:00:00' extracted_at", "'{}' payload")
    load_to_raw(df, f"{tmp}/raw")
    write_lakehouse(df, f"{tmp}/lake")
    append_keyed(spark, f"{tmp}/keyed", df, ["id"])
    Layers(spark, f"{tmp}/build").write("core", "t", df)
    for folder in ("raw", "lake", "keyed", "build"):
        files = [f for _, _, names in os.walk(f"{tmp}/{folder}") for f in names if f.startswith("part-")]
        assert files and all(f.endswith(".zstd.parquet") or f.endswith(".zst.parquet") for f in files), folder
