"""A third of all rows on one key: results stay whole and exact."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from aerocast.operators.dedupe import latest_per_key
from aerocast.plans.marts import build_weather_flight_impact

T = dt.datetime


def test_hot_slot_impact_matches_brute_force(spark):
    rnd = random.Random(11)
    base = T(2026, 1, 1)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0                                   # one slot holds a third of all flights
        ts = base + dt.timedelta(hours=10) if hot else base + dt.timedelta(minutes=rnd.randrange(0, 24 * 60))
        d = Decimal(rnd.randrange(-500, 4000)) / 100 if i % 7 else None
        st = "unknown" if d is None else ("on_time" if d <= 0 else "minor_delay" if d <= 15 else "delayed")
        rows.append((f"f{i}", "departure", "HKT", "BKK", ts, None, d, None, st, "unknown"))
    ff = spark.createDataFrame(rows, "flight_key string, flight_direction string, airport_departure_iata string, "
                                     "airport_arrival_iata string, scheduled_departure_utc timestamp_ntz, "
                                     "scheduled_arrival_utc timestamp_ntz, departure_delay_minutes decimal(18,2), "
                                     "arrival_delay_minutes decimal(18,2), departure_time_status string, "
                                     "arrival_time_status string").withColumns(
        {"flight_number": F.lit("N"), "airline_iata": F.lit("A")})
    from aerocast.plans.marts import WEATHER_ATTRIBUTES
    w = spark.createDataFrame([(f"w{h}", base + dt.timedelta(hours=h)) for h in range(24)],
                              "weather_key string, weather_time_utc timestamp_ntz")
    for c in WEATHER_ATTRIBUTES:
        if c not in w.columns:
            w = w.withColumn(c, F.lit(None).cast("string"))
    got = {r.weather_key: (r.total_operations, r.avg_delay_minutes, r.delayed_operations)
           for r in build_weather_flight_impact(w, ff).collect()}
    for h in range(24):
        c = base + dt.timedelta(hours=h)
        sel = [r for r in rows if c - dt.timedelta(minutes=30) <= r[4] < c + dt.timedelta(minutes=30)]
        if not sel:
            assert f"w{h}" not in got
            continue
        ds = [r[6] for r in sel if r[6] is not None]
        avg = (sum(ds) / len(ds)).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP") if ds else None
        assert got[f"w{h}"] == (len(sel), avg, sum(1 for r in sel if r[8] == "delayed")), h


def test_hot_key_dedupe(spark):
    rows = [("K", i, T(2026, 1, 1) + dt.timedelta(seconds=i) if i % 5 else None) for i in range(1000)]
    rows += [(f"k{i}", i, T(2026, 1, 2)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, n int, actual timestamp_ntz")
    out = {r.k: r.n for r in latest_per_key(df, [F.col("k")], [F.col("actual"), F.col("n")]).collect()}
    assert len(out) == 501 and out["K"] == 999
