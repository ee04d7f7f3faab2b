import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from aerocast.plans.core import build_fact_flights, to_flight_schema
from aerocast.plans.marts import build_weather_flight_impact, build_weather_impact_summary

T = dt.datetime


def _staged_arrival(spark, rows):
    cols = ("flight_number string, call_sign string, flight_status string, is_cargo boolean, direction string, "
            "airline_iata string, airline_icao string, aircraft_model string, aircraft_registration string, "
            "departure_airport_iata string, airport_code string, scheduled_departure_utc timestamp_ntz, "
            "revised_departure_utc timestamp_ntz, scheduled_arrival_utc timestamp_ntz, "
            "revised_arrival_utc timestamp_ntz, loaded_at timestamp_ntz")
    return spark.createDataFrame(rows, cols)


def test_one_arrival_row(spark):
    """One staged arrival: 31.5 minutes late off the block, 12 early on it."""
    row = ("QX9", "QXX9", "landed", True, "arrival", "QX", "QXX", "Type 7", "T-7", "QQA", "HKT",
           T(2025, 3, 9, 1, 30), T(2025, 3, 9, 2, 1, 30), T(2025, 3, 9, 5, 45), T(2025, 3, 9, 5, 33), T(2025, 3, 10))
    r, = build_fact_flights([to_flight_schema(_staged_arrival(spark, [row]), "arrival")]).collect()
    assert (r.flight_number, r.airport_departure_iata, r.airport_arrival_iata) == ("QX9", "QQA", "HKT")
    assert r.departure_delay_minutes == Decimal("31.50") and r.arrival_delay_minutes == Decimal("-12.00")
    assert r.operation_ts == T(2025, 3, 9, 5, 45) and r.operation_hour == 5 and r.operation_day_of_week == "Sunday   "


def test_survivor_does_not_depend_on_row_order(spark):
    base = ["X1", "C", "s", False, "arrival", "XX", "XXX", "m", "r", "AAA", "HKT", T(2026, 1, 1, 8, 0)]
    a = tuple(base + [None, T(2026, 1, 1, 10, 0), None, T(2026, 1, 2)])
    b = tuple(base[:3] + [True] + base[4:] + [None, T(2026, 1, 1, 11, 0), None, T(2026, 1, 2)])
    got = [[(r.is_cargo, r.scheduled_arrival_utc) for r in
            build_fact_flights([to_flight_schema(_staged_arrival(spark, rows), "arrival")]).collect()]
           for rows in ([a, b], [b, a])]
    assert got[0] == got[1] and len(got[0]) == 1


def test_dedupe_later_actual_wins_nulls_last(spark):
    base = ["X1", "C", "s", False, "arrival", "XX", "XXX", "m", "r", "AAA", "HKT", T(2026, 1, 1, 8, 0)]
    rows = [tuple(base + [T(2026, 1, 1, 8, 5), T(2026, 1, 1, 10, 0), T(2026, 1, 1, 10, 1), T(2026, 1, 2)]),
            tuple(base + [None, T(2026, 1, 1, 10, 0), T(2026, 1, 1, 10, 9), T(2026, 1, 2)]),
            tuple(base + [T(2026, 1, 1, 8, 7), T(2026, 1, 1, 10, 0), None, T(2026, 1, 2)])]
    f = build_fact_flights([to_flight_schema(_staged_arrival(spark, rows), "arrival")]).collect()
    assert len(f) == 1 and f[0].actual_departure_utc == T(2026, 1, 1, 8, 7)
    # ties on actual times: the live feed beats the history file
    tie = [tuple(base + [None, T(2026, 1, 1, 10, 0), None, T(2026, 1, 2)])]
    api = to_flight_schema(_staged_arrival(spark, tie), "arrival", source_rank=2).withColumn("call_sign", F.lit("API"))
    hist = to_flight_schema(_staged_arrival(spark, tie), "arrival", source_rank=1).withColumn("call_sign", F.lit("H"))
    assert build_fact_flights([hist, api]).first().call_sign == "API"


def _weather(spark, rows):
    return spark.createDataFrame(rows, "weather_key string, airport_iata string, weather_time_utc timestamp_ntz, "
                                       "windspeed_10m_ms decimal(18,6)")


def test_impact_half_open_window_and_rates(spark):
    from aerocast.plans.marts import WEATHER_ATTRIBUTES
    w = _weather(spark, [("w10", "HKT", T(2026, 1, 1, 10), Decimal("3")), ("w11", "HKT", T(2026, 1, 1, 11), Decimal("14"))])
    for c in WEATHER_ATTRIBUTES:
        if c not in w.columns:
            w = w.withColumn(c, F.lit(None).cast("boolean") if c.startswith(("is_", "has_")) else F.lit(None).cast("string"))
    w = w.withColumn("is_strong_wind", F.col("windspeed_10m_ms") >= 13.9)
    ff = spark.createDataFrame([
        ("a", "departure", "HKT", "X", T(2026, 1, 1, 9, 30), None, Decimal("20.00"), None, "delayed", "unknown"),
        ("b", "departure", "HKT", "X", T(2026, 1, 1, 10, 29), None, Decimal("-1.00"), None, "on_time", "unknown"),
        ("c", "departure", "HKT", "X", T(2026, 1, 1, 10, 30), None, Decimal("5.00"), None, "minor_delay", "unknown"),
        ("d", "arrival", "X", "HKT", None, T(2026, 1, 1, 11, 0), None, None, "unknown", "unknown"),
        ("e", "arrival", "X", "BKK", None, T(2026, 1, 1, 11, 0), None, Decimal("1.00"), "unknown", "minor_delay"),
    ], "flight_key string, flight_direction string, airport_departure_iata string, airport_arrival_iata string, "
       "scheduled_departure_utc timestamp_ntz, scheduled_arrival_utc timestamp_ntz, "
       "departure_delay_minutes decimal(18,2), arrival_delay_minutes decimal(18,2), "
       "departure_time_status string, arrival_time_status string").withColumns(
        {"flight_number": F.lit("N"), "airline_iata": F.lit("A")})
    m = {(r.weather_key, r.operation_type): r for r in build_weather_flight_impact(w, ff).collect()}
    # 09:30 is in [09:30, 10:30) of the 10:00 hour; 10:30 belongs to 11:00 only
    assert m[("w10", "departure")].total_operations == 2
    assert m[("w10", "departure")].avg_delay_minutes == Decimal("9.50")
    assert m[("w10", "departure")].avg_positive_delay_minutes == Decimal("20.00")
    assert m[("w10", "departure")].delay_rate == Decimal("0.5000")
    assert m[("w11", "departure")].total_operations == 1
    assert m[("w11", "arrival")].unknown_operations == 1 and m[("w11", "arrival")].avg_delay_minutes is None
    assert ("w10", "arrival") not in m
    s = {(r.operation_type, r.weather_condition): r for r in
         build_weather_impact_summary(build_weather_flight_impact(w, ff)).collect()}
    assert s[("departure", "adverse_weather")].total_weather_hours == 1
    assert s[("departure", "normal_weather")].avg_delay_minutes == Decimal("9.50")


def test_weather_airport_option(spark):
    from aerocast.plans.marts import WEATHER_ATTRIBUTES
    w = _weather(spark, [("h", "HKT", T(2026, 1, 1, 10), Decimal("1")), ("b", "BKK", T(2026, 1, 1, 10), Decimal("1"))])
    for c in WEATHER_ATTRIBUTES:
        if c not in w.columns:
            w = w.withColumn(c, F.lit(None).cast("string"))
    ff = spark.createDataFrame([("a", "departure", "HKT", "X", T(2026, 1, 1, 10, 5), None, Decimal("1.00"), None,
                                 "minor_delay", "unknown")],
                               "flight_key string, flight_direction string, airport_departure_iata string, "
                               "airport_arrival_iata string, scheduled_departure_utc timestamp_ntz, "
                               "scheduled_arrival_utc timestamp_ntz, departure_delay_minutes decimal(18,2), "
                               "arrival_delay_minutes decimal(18,2), departure_time_status string, "
                               "arrival_time_status string").withColumns(
        {"flight_number": F.lit("N"), "airline_iata": F.lit("A")})
    # default: weather of every airport meets the home operations (as the reference does)
    assert sorted(r.weather_key for r in build_weather_flight_impact(w, ff).collect()) == ["b", "h"]
    assert [r.weather_key for r in build_weather_flight_impact(w, ff, weather_airport="HKT").collect()] == ["h"]
