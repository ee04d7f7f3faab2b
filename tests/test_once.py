"""Pages, their texts and their times are made and parsed once."""

import datetime as dt
import gzip
import json
import os

from pyspark.sql import functions as F

from aerocast.plans import analogues as an

DAY = dt.datetime(1995, 1, 2)
TEXTS = ["N", 'a"b', "c\\d", "é\n", "x\n", "", None, "\t", "日本 /"]


def _tables(spark, folder, n=40):
    lines = [(i // 9 + 2, None if i % 13 == 12 else i, None if i % 7 == 6 else i * 3, None if i % 11 == 10 else i % 7 if i % 5 else 9000,
              None if i % 8 == 7 else float(i), None if i % 6 == 5 else (i % 3) / 10, None if i % 10 == 9 else (i % 2) / 10,
              TEXTS[i % 9], TEXTS[(i // 2) % 9], None if i % 17 == 16 else DAY + dt.timedelta(days=i * 11), float(i)) for i in range(n)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
                                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz, l_extendedprice double").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(k, 5, DAY) for k in range(1, 12)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    return lines


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _expected(line, is_arr):
    """A flight's members as dictionaries; what is None is left out."""
    ok, part, supp, num, qty, disc, tax, flag, status, ship, _ = line
    base = None if ship is None or num is None else dt.datetime(2024, 1, 1) + dt.timedelta(
        days=(ship.timetuple().tm_yday - 1) % 30, hours=num, minutes=part % 4 * 15)

    def pair(t):
        return {} if t is None else {"utc": t.strftime("%Y-%m-%d %H:%MZ"), "local": (t + dt.timedelta(hours=7)).strftime("%Y-%m-%d %H:%M+07:00")}
    some = lambda d: {k: v for k, v in d.items() if v is not None}
    port = an.OTHER_AIRPORTS[4 if supp is None else supp % 5]
    own = some({"terminal": None if num is None else f"T{num % 3}", "scheduledTime": pair(base),
                "revisedTime": pair(base and qty is not None and base + dt.timedelta(minutes=int(qty)) or None) if disc else None})
    other = some({"terminal": None if supp is None else f"D{supp % 4}",
                  "airport": {"iata": port, "icao": f"X{port}", "name": f"Airport {port}", "timeZone": "Asia/Bangkok"},
                  "scheduledTime": pair(base and base + dt.timedelta(hours=-2 if is_arr else 2))})
    return some({"number": f"L{part}", "status": flag, "callSign": None if num is None else f"C{ok}-{num}", "codeshareStatus": status,
                 "isCargo": None if qty is None else qty > 25,
                 "airline": {} if supp is None else {"iata": f"S{supp % 10}", "icao": f"SUP{supp % 10}", "name": f"Supplier {supp}"},
                 "aircraft": {"reg": f"R{part}", "modeS": f"M{part % 997}", "model": f"Model-{part % 5}"} if tax else None,
                 "arrival": own if is_arr else other, "departure": other if is_arr else own})


def test_pages_are_written_as_text(spark, tmp):
    """The pages' JSON, members in order, without structs of it being made."""
    lines = _tables(spark, tmp)
    pages = an.fids_batches_with_order(spark, tmp)
    assert "arrivals#" not in pages._jdf.queryExecution().analyzed().toString()
    text = lambda f: json.dumps(f, ensure_ascii=False, separators=(",", ":"))
    got = [r.payload for r in pages.where("_ok % 10 > 1").collect()]
    flights = {b: sorted(text(f) for p in got for f in json.loads(p)[b]) for b in ("arrivals", "departures")}
    for board, odd in (("arrivals", 0), ("departures", 1)):
        assert flights[board] == sorted(text(_expected(x, not odd)) for x in lines if x[1] is not None and x[1] % 2 == odd)
    assert all(p == text(json.loads(p)) for p in got)


def test_times_without_a_separator_are_not_built_anew(spark):
    from aerocast.functions import parse_utc_text, parse_zoned_text
    times = {"2026-06-30 17:00Z": ("2026-06-30 17:00:00",) * 2, " 2026-06-30T17:00 ": ("2026-06-30 17:00:00",) * 2, "2026-02-30 17:00Z": (None, None),
             "2026-06-30T17:00+07:00": (None, "2026-06-30 10:00:00"), "2026-06-30 17:00:05Z": ("2026-06-30 17:00:05",) * 2, "T": (None, None), None: (None, None)}
    df = spark.createDataFrame([(t,) for t in times], "t string")
    df = df.select("t", parse_utc_text("t").cast("string").alias("u"), parse_zoned_text("t").cast("timestamp_ntz").cast("string").alias("z"))
    assert {r.t: (r.u, r.z) for r in df.collect()} == times and "translate(" not in _plan(df)


def test_a_landed_line_is_parsed_once(spark, tmp):
    from aerocast.sources.landing import read_landing
    os.makedirs(f"{tmp}/land")
    m = [json.dumps({"airport_code": "HKT", "payload": f"{i}"}) for i in range(6)]
    for name, data in (("a", "\n".join(m[:2]) + "\n"), ("b", "\r\n".join(m[2:4]) + "\r\n\r\n"), ("c", m[4] + "\n \n" + m[5] + "\r")):
        with gzip.open(f"{tmp}/land/{name}.json.gz", "wt", newline="") as f:
            f.write(data)
    good, bad = read_landing(spark, f"{tmp}/land")
    assert sorted(r.payload for r in good.collect()) == list("012345") and bad.count() == 0
    plan = _plan(good.select("airport_code", "payload"))
    assert plan.count("from_json(") == 1 and plan.count("lambdafunction(NOT (trim(") == 1


def test_branches_read_pages_made_once(spark, tmp, monkeypatch):
    from aerocast import registry
    made = []
    monkeypatch.setattr(an, "weather_raw", lambda *a: spark.createDataFrame([], "source string, airport_iata string, loaded_at timestamp_ntz, payload string"))
    monkeypatch.setattr(an, "weather_history_raw", lambda *a: spark.createDataFrame([], "_load_dt timestamp_ntz, weather_data string"))
    monkeypatch.setattr(registry, "staged", lambda df, f=registry.staged: made.append(1) or f(df))
    _tables(spark, tmp)
    fact = registry.q_fact_flights_from_raw
    for name in ("raw_airports", "raw_airlines", "raw_aircraft"):
        df = getattr(an, name)(spark, "/root/testdata/sf0.001")
        monkeypatch.setattr(an, name, lambda *a, df=df: df)
    for q in (fact, registry.q_dq_staging_suite):
        made.clear()
        plan = _plan(q(spark, tmp))
        assert made == [1] and "l_shipdate" not in plan
    assert fact(spark, tmp).count() > 20


def test_csv_places_are_found_without_texts(spark, tmp):
    from aerocast.sources.files import quoted_records, read_csv
    with open(f"{tmp}/a.csv", "w", newline="") as f:
        f.write('a,b\r\n\r\n  \r\n1,"x ""y"",\r\n z"\r\n2,""\r\n')
    records = quoted_records(spark, f"{tmp}/a.csv")
    assert sorted(r.filled for r in records.collect()) == [False, False, True, True, True]
    assert sorted((r.a, r.b) for r in read_csv(spark, f"{tmp}/a.csv", na_tokens=None).collect()) == [("1", 'x "y",\r\n z'), ("2", None)]
    places = records.where("filled").groupBy("file").agg(F.min(F.struct("start", "n")))
    scans = [x for x in places._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan parquet" in x]
    assert any("text" not in x.split("ReadSchema")[1] for x in scans)


def test_both_boards_of_a_page_are_parsed_at_once(spark, tmp):
    from aerocast.registry import QUERIES
    _tables(spark, tmp)
    df = QUERIES["raw_source_variant"](spark, tmp)
    assert _plan(df).lower().count("parsejson") + _plan(df).lower().count("parse_json") == 2          # a target each
    rows = {(r.target, r.board): (r.flights, r.content) for r in df.collect()}
    assert len(rows) == 4 and all(rows["ci", b] == rows["dev", b] for b in ("arrivals", "departures"))


def test_known_keys_move_no_payload(spark, tmp, monkeypatch):
    """A batch whose keys are in the table is told by its keys; new keys
    and those that lack a part are inserted as before."""
    from aerocast.sinks import tables
    rows = lambda x: spark.createDataFrame(x, "k string, n int, payload string")
    add = lambda x: tables.append_keyed(spark, f"{tmp}/t", rows(x), ["k", "n"], order=[F.col("payload")], partition_by=("k",))
    assert add([("a", 1, "y"), ("a", 1, "x"), (None, 1, "z"), ("b", 2, "w")]) == 3
    plans = []
    monkeypatch.setattr(tables, "staged", lambda df, f=tables.staged: plans.append(_plan(df)) or f(df))
    assert add([("a", 1, "q"), ("b", 2, "q"), (None, 1, "z")]) == 1
    assert len(plans) == 3 and not any("min_by" in p for p in plans)
    assert add([("a", 1, "q"), ("a", 3, "s"), ("a", 3, "r"), ("b", None, "t")]) == 2
    got = sorted(((r.k, r.n, r.payload) for r in spark.read.parquet(f"{tmp}/t").collect()), key=str)
    assert got == sorted([("a", 1, "x"), ("b", 2, "w"), (None, 1, "z"), (None, 1, "z"), ("a", 3, "r"), ("b", None, "t")], key=str)


def _lines(folder, names):
    os.makedirs(folder, exist_ok=True)
    for name in names:
        with open(f"{folder}/{name}", "w") as f:
            f.writelines(json.dumps({"airport_code": "HKT", "code_type": "IATA", "from_local": f"{name}{i}", "to_local": "x", "direction": "Both",
                                     "payload": "{}"}) + "\n" for i in range(20))


def test_micro_batches_are_bounded_in_bytes(spark, tmp, monkeypatch):
    from aerocast.streaming import ingest as ing
    _lines(f"{tmp}/topic", "abcdef")
    monkeypatch.setattr(ing, "MAX_BYTES", 2 * os.path.getsize(f"{tmp}/topic/a") + 10)
    released = []
    monkeypatch.setattr(ing, "release_shuffles", lambda s: released.append(1))
    _, st = ing.ingest(spark, f"{tmp}/topic", f"{tmp}/raw", f"{tmp}/dlq", f"{tmp}/ck")
    assert st.batches == 3 and st.inserted == 120 and len(released) == 4
    _lines(f"{tmp}/topic", "gh")
    _, st = ing.ingest(spark, f"{tmp}/topic", f"{tmp}/raw", f"{tmp}/dlq", f"{tmp}/ck", options={"maxFilesPerTrigger": 1})
    assert st.batches == 2 and spark.read.parquet(f"{tmp}/raw").count() == 160


def test_shuffle_files_go_with_their_step(spark, tmp):
    """Those of finished jobs, once they are released."""
    import time

    from aerocast.session import release_shuffles
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: sum(f.getName().startswith("shuffle_") and f.getName().endswith(".data") for f in _java(blocks.getAllFiles()))
    release_shuffles(spark)
    time.sleep(1)
    before = held()
    spark.range(100).repartition(3).write.parquet(f"{tmp}/x")
    assert held() > before
    for _ in range(20):
        release_shuffles(spark)
        time.sleep(0.3)
        if held() <= before:
            break
    assert held() <= before


def _java(seq):
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def test_resumed_stream_moves_whole_pages_only_where_few(spark, tmp, monkeypatch):
    from aerocast import registry
    _tables(spark, tmp)
    plans = []
    monkeypatch.setattr(registry, "publish", lambda df, topic, landing_dir=None, f=registry.publish: plans.append(_plan(df)) or f(df, topic, landing_dir))
    monkeypatch.setattr(registry, "staged", lambda df: (df.repartition(9).localCheckpoint(), f"{tmp}/none"))
    n = registry.q_stream_stop_and_resume(spark, tmp).count()
    assert n > 0 and "Repartition 8" not in plans[0]
