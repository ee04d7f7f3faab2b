"""Weather categories, flags and code descriptions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_OPS = {
    ">=": lambda c, v: c >= v,
    ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v,
    "<": lambda c, v: c < v,
    "=": lambda c, v: c == v,
}


def range_category(col, rules, default: str) -> Column:
    """First matching ``(operator, value, label)`` rule wins, else
    ``default``.  A NULL input matches no rule and gets the default."""
    c = _c(col)
    out = None
    for op, value, label in rules:
        cond = _OPS[op](c, F.lit(value))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return F.lit(default) if out is None else out.otherwise(default)


# ---- fixed values: category thresholds and labels ----------------------
WIND_RULES = [(">=", 13.9, "strong"), (">=", 10.8, "moderate"), (">=", 5.5, "light")]
WIND_DEFAULT = "calm"
PRECIPITATION_RULES = [(">=", 10, "heavy"), (">=", 2.5, "moderate"), (">", 0, "light")]
PRECIPITATION_DEFAULT = "none"
RAIN_RULES = [(">=", 10, "heavy_rain"), (">=", 2.5, "moderate_rain"), (">", 0, "light_rain")]
RAIN_DEFAULT = "no_rain"
TEMPERATURE_RULES = [(">=", 35, "extreme_heat"), (">=", 30, "very_hot"), (">=", 25, "hot"),
                     (">=", 20, "warm")]
TEMPERATURE_DEFAULT = "mild"
CLOUD_RULES = [(">=", 90, "overcast"), (">=", 70, "mostly_cloudy"), (">=", 40, "partly_cloudy"),
               (">=", 10, "mostly_clear")]
CLOUD_DEFAULT = "clear"
VISIBILITY_RULES = [("<", 1000, "very_poor"), ("<", 3000, "poor"), ("<", 5000, "moderate"),
                    ("<", 10000, "good")]
VISIBILITY_DEFAULT = "excellent"
# flag thresholds
STRONG_WIND_MS = 13.9
HEAVY_PRECIPITATION_MM = 10
HEAVY_RAIN_MM = 10
THUNDERSTORM_CODES = (95, 96, 99)
OVERCAST_PCT = 90
LOW_VISIBILITY_M = 3000

# WMO weather codes and their descriptions, in code order.
WEATHER_CODES = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    56: "Light freezing drizzle",
    57: "Dense freezing drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    66: "Light freezing rain",
    67: "Heavy freezing rain",
    71: "Slight snowfall",
    73: "Moderate snowfall",
    75: "Heavy snowfall",
    77: "Snow grains",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with hail",
    99: "Heavy thunderstorm with hail",
}
UNKNOWN_CODE = "Unknown"
# -------------------------------------------------------------------------


def wind_category(c) -> Column:
    return range_category(c, WIND_RULES, WIND_DEFAULT)


def precipitation_category(c) -> Column:
    return range_category(c, PRECIPITATION_RULES, PRECIPITATION_DEFAULT)


def rain_category(c) -> Column:
    return range_category(c, RAIN_RULES, RAIN_DEFAULT)


def temperature_category(c) -> Column:
    return range_category(c, TEMPERATURE_RULES, TEMPERATURE_DEFAULT)


def cloudcover_category(c) -> Column:
    return range_category(c, CLOUD_RULES, CLOUD_DEFAULT)


def visibility_category(c) -> Column:
    return range_category(c, VISIBILITY_RULES, VISIBILITY_DEFAULT)


def weather_description(code) -> Column:
    """Description of a WMO code; ``Unknown`` for NULL or unlisted codes."""
    code_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(WEATHER_CODES.items())])
    return F.coalesce(F.element_at(code_map, _c(code).cast("int")), F.lit(UNKNOWN_CODE))


def weather_flags(wind="windspeed_10m_ms", precipitation="precipitation_mm", rain="rain_mm",
                  code="weathercode", cloud="cloudcover_pct", visibility="visibility_m") -> dict:
    """The six boolean flags (NULL measure → NULL flag)."""
    return {
        "is_strong_wind": _c(wind) >= STRONG_WIND_MS,
        "is_heavy_precipitation": _c(precipitation) >= HEAVY_PRECIPITATION_MM,
        "is_heavy_rain": _c(rain) >= HEAVY_RAIN_MM,
        "has_thunderstorm": _c(code).cast("int").isin(*THUNDERSTORM_CODES),
        "is_overcast": _c(cloud) >= OVERCAST_PCT,
        "is_low_visibility": _c(visibility) < LOW_VISIBILITY_M,
    }


def weather_condition() -> Column:
    """``adverse_weather`` if any of five flags is true (overcast is not
    one of them), else ``normal_weather``; NULL flags count as false."""
    adverse = (F.col("is_strong_wind") | F.col("is_heavy_precipitation") | F.col("is_heavy_rain")
               | F.col("has_thunderstorm") | F.col("is_low_visibility"))
    return F.when(adverse, "adverse_weather").otherwise("normal_weather")
