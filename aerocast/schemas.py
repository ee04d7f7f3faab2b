"""Explicit schemas for raw tables and JSON payloads."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B, TS, NTZ = T.StringType(), T.DoubleType(), T.BooleanType(), T.TimestampType(), T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TIME_PAIR = _st(("utc", S), ("local", S))
AIRPORT_REF = _st(("iata", S), ("icao", S), ("name", S), ("timeZone", S))
LEG = _st(("terminal", S), ("airport", AIRPORT_REF), ("scheduledTime", TIME_PAIR),
          ("revisedTime", TIME_PAIR))
FLIGHT = _st(("number", S), ("status", S), ("callSign", S), ("codeshareStatus", S), ("isCargo", B),
             ("airline", _st(("iata", S), ("icao", S), ("name", S))),
             ("aircraft", _st(("reg", S), ("modeS", S), ("model", S))),
             ("arrival", LEG), ("departure", LEG))

# The hourly variables requested from the weather API, in
# request order, and the staged column each one becomes.
HOURLY_VARIABLES = [
    ("temperature_2m", "temperature_2m_c", "double"),
    ("apparent_temperature", "apparent_temperature_c", "double"),
    ("dewpoint_2m", "dewpoint_2m_c", "double"),
    ("relativehumidity_2m", "relative_humidity_2m_pct", "double"),
    ("precipitation", "precipitation_mm", "double"),
    ("rain", "rain_mm", "double"),
    ("snowfall", "snowfall_cm", "double"),
    ("cloudcover", "cloudcover_pct", "int"),
    ("cloudcover_low", "cloudcover_low_pct", "int"),
    ("cloudcover_mid", "cloudcover_mid_pct", "int"),
    ("cloudcover_high", "cloudcover_high_pct", "int"),
    ("surface_pressure", "surface_pressure_hpa", "double"),
    ("pressure_msl", "pressure_msl_hpa", "double"),
    ("visibility", "visibility_m", "double"),
    ("windspeed_10m", "windspeed_10m_ms", "double"),
    ("windgusts_10m", "windgusts_10m_ms", "double"),
    ("winddirection_10m", "winddirection_10m_deg", "int"),
    ("weathercode", "weathercode", "int"),
]
# Numbers are parsed as double (an int array holding 85.0 would be NULLed
# whole) and cast per column afterwards.
HOURLY = T.StructType([T.StructField("time", T.ArrayType(S))] +
                      [T.StructField(v, T.ArrayType(D)) for v, _, _ in HOURLY_VARIABLES])
WEATHER_PAYLOAD = _st(("hourly", HOURLY))
HISTORY_RECORDS = T.ArrayType(_st(("source", S), ("airport_iata", S), ("payload", S)))

# Raw flight batches (API table, history parquet, lakehouse rows).
RAW_FLIGHT_BATCH = T.StructType([
    T.StructField("source", S, True), T.StructField("airport_code", S, True),
    T.StructField("code_type", S, True), T.StructField("from_local", S, True),
    T.StructField("to_local", S, True), T.StructField("direction", S, True),
    T.StructField("extracted_at", NTZ, True), T.StructField("payload", S, True),
])
FLIGHT_BATCH_KEY = ["airport_code", "code_type", "from_local", "to_local", "direction"]
LAKEHOUSE_BATCH = T.StructType([T.StructField(f.name, f.dataType, False)
                                for f in RAW_FLIGHT_BATCH.fields])
WEATHER_BATCH_KEY = ["airport_iata", "latitude", "longitude", "start_date", "end_date"]
STREAM_MESSAGE = _st(("airport_code", S), ("code_type", S), ("from_local", S), ("to_local", S),
                     ("direction", S), ("payload", S))
