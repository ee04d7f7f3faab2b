import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from aerocast.functions import (
    cloudcover_category, code_upper, delay_minutes, delay_status, null_tokens, numeric_or_null,
    parse_utc_text, parse_zoned_text, precipitation_category, rain_category, surrogate_key,
    temperature_category, tri_bool, visibility_category, weather_description, weekday_name,
    wind_category,
)


def _one(spark, values, fn, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_delay_status_boundaries(spark):
    vals = [None, -1.0, 0.0, 0.01, 15.0, 15.01]
    got = _one(spark, vals, lambda c: delay_status(c.cast("decimal(18,2)")))
    assert got == ["unknown", "on_time", "on_time", "minor_delay", "minor_delay", "delayed"]


def test_delay_minutes_exact(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1, 10, 0), dt.datetime(2026, 1, 1, 10, 20)),
                                (dt.datetime(2026, 1, 1, 10, 0), dt.datetime(2026, 1, 1, 9, 59, 59, 700000)),
                                (dt.datetime(2026, 1, 1, 10, 0), None)], "s timestamp_ntz, a timestamp_ntz")
    got = [r[0] for r in df.select(delay_minutes("a", "s")).collect()]
    # 20 min; −0.3 s = −0.005 min → half away from zero → −0.01; NULL
    assert got == [Decimal("20.00"), Decimal("-0.01"), None]


def test_weather_categories_boundaries(spark):
    assert _one(spark, [None, 5.49, 5.5, 10.8, 13.9], wind_category) == \
        ["calm", "calm", "light", "moderate", "strong"]
    assert _one(spark, [None, 0.0, 0.1, 2.5, 10.0], precipitation_category) == \
        ["none", "none", "light", "moderate", "heavy"]
    assert _one(spark, [None, 0.0, 0.1, 2.5, 10.0], rain_category) == \
        ["no_rain", "no_rain", "light_rain", "moderate_rain", "heavy_rain"]
    assert _one(spark, [None, 19.9, 20.0, 25.0, 30.0, 35.0], temperature_category) == \
        ["mild", "mild", "warm", "hot", "very_hot", "extreme_heat"]
    assert _one(spark, [None, 9.0, 10.0, 40.0, 70.0, 90.0], cloudcover_category) == \
        ["clear", "clear", "mostly_clear", "partly_cloudy", "mostly_cloudy", "overcast"]
    assert _one(spark, [None, 999.0, 1000.0, 3000.0, 5000.0, 10000.0], visibility_category) == \
        ["excellent", "very_poor", "poor", "moderate", "good", "excellent"]


def test_weather_description(spark):
    assert _one(spark, [0, 95, 99, 4, None], weather_description, "int") == \
        ["Clear sky", "Thunderstorm", "Heavy thunderstorm with hail", "Unknown", "Unknown"]


def test_surrogate_key_matches_text_concatenation(spark):
    df = spark.createDataFrame([("A", "BC", dt.datetime(2026, 1, 1, 10, 0)), ("AB", "C", None)],
                               "a string, b string, t timestamp_ntz")
    got = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert got[0] == got[1]              # documented collision without separator
    import hashlib
    k = df.select(surrogate_key("a", "t")).first()[0]
    assert k == hashlib.md5(b"A2026-01-01 10:00:00").hexdigest()
    sep = [r[0] for r in df.select(surrogate_key("a", "b", sep="|")).collect()]
    assert sep[0] != sep[1]


def test_weekday_padded(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),)], "t timestamp_ntz")
    assert df.select(weekday_name("t")).first()[0] == "Thursday "


def test_time_texts(spark):
    df = spark.createDataFrame([("2026-06-30 17:00Z", "2026-07-01 00:00+07:00")], "u string, l string")
    r = df.select(parse_utc_text("u").alias("u"), parse_zoned_text("l").cast("timestamp_ntz").alias("l")).first()
    assert r.u == dt.datetime(2026, 6, 30, 17, 0) and r.l == dt.datetime(2026, 6, 30, 17, 0)


def test_cleaning(spark):
    df = spark.createDataFrame([(" x ",), ("\\N",), ("  ",), ("\tx",), (None,)], "s string")
    assert [r[0] for r in df.select(null_tokens("s")).collect()] == ["x", None, None, "\tx", None]
    assert [r[0] for r in df.select(code_upper("s")).collect()] == ["X", None, None, "\tX", None]
    n = spark.createDataFrame([(" 12.5 ",), ("-3",), ("12.",), ("n/a",)], "s string")
    assert [r[0] for r in n.select(numeric_or_null("s")).collect()] == \
        [Decimal("12.500000"), Decimal("-3.000000"), None, None]
    b = spark.createDataFrame([(x,) for x in ["Y", " yes", "1", "N", "false", "maybe", None]], "s string")
    assert [r[0] for r in b.select(tri_bool("s")).collect()] == [True, True, True, False, False, None, None]


def test_null_flag_is_normal_weather(spark):
    from aerocast.functions import weather_condition
    df = spark.createDataFrame([(None, False, False, False, False), (None, True, False, False, False),
                                (False, False, False, False, None)],
                               "is_strong_wind boolean, is_heavy_precipitation boolean, is_heavy_rain boolean, "
                               "has_thunderstorm boolean, is_low_visibility boolean")
    assert [r[0] for r in df.select(weather_condition()).collect()] == \
        ["normal_weather", "adverse_weather", "normal_weather"]
