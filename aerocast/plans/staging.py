"""Staging layer: typed rows from raw batches and reference files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerocast.functions import (
    code_upper, null_tokens, numeric_or_null, parse_utc_text, parse_zoned_text, tri_bool,
    weather_description,
)
from aerocast.functions.clean import AIRLINE_NULL_TOKEN, AIRPORT_NULL_TOKEN
from aerocast.operators.json_ops import explode_json_array, lockstep_explode
from aerocast.schemas import FLIGHT, HISTORY_RECORDS, HOURLY_VARIABLES, WEATHER_PAYLOAD

BATCH_META = ["source", "airport_code", "code_type", "window_from_local", "window_to_local",
              "loaded_at"]


def _batch_meta(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("source").cast("string").alias("source"),
        F.col("airport_code").cast("string").alias("airport_code"),
        F.col("code_type").cast("string").alias("code_type"),
        parse_zoned_text("from_local").alias("window_from_local"),
        parse_zoned_text("to_local").alias("window_to_local"),
        F.col("extracted_at").cast("timestamp_ntz").alias("loaded_at"),
        F.col("payload").cast("string").alias("payload"),
    )


def _leg(f, leg: str, prefix: str, with_airport: bool) -> list:
    x = f[leg]
    cols = []
    if with_airport:
        cols += [x["airport"]["iata"].alias(f"{prefix}_airport_iata"),
                 x["airport"]["icao"].alias(f"{prefix}_airport_icao"),
                 x["airport"]["name"].alias(f"{prefix}_airport_city"),
                 x["airport"]["timeZone"].alias(f"{prefix}_airport_timezone")]
    cols += [x["terminal"].alias(f"{prefix}_terminal"),
             parse_utc_text(x["scheduledTime"]["utc"]).alias(f"scheduled_{prefix}_utc"),
             parse_zoned_text(x["scheduledTime"]["local"]).alias(f"scheduled_{prefix}_local"),
             parse_utc_text(x["revisedTime"]["utc"]).alias(f"revised_{prefix}_utc"),
             parse_zoned_text(x["revisedTime"]["local"]).alias(f"revised_{prefix}_local")]
    return cols


def stage_flights(raw: DataFrame, direction: str) -> DataFrame:
    """Raw flight-board batches → one typed row per arrival (``direction=
    'arrival'``) or departure.  The payload is parsed once; elements keep
    their JSON text in ``<direction>_payload``."""
    key = {"arrival": "arrivals", "departure": "departures"}[direction]
    meta = _batch_meta(raw)
    elems = explode_json_array(meta, "payload", key, "_elem", keep=BATCH_META)
    f = F.from_json(F.col("_elem"), FLIGHT)
    parsed = elems.withColumn("_f", f)
    x = F.col("_f")
    own, other = ("arrival", "departure") if direction == "arrival" else ("departure", "arrival")
    body = [
        F.lit(direction).alias("direction"),
        x["number"].alias("flight_number"), x["status"].alias("flight_status"),
        x["callSign"].alias("call_sign"), x["codeshareStatus"].alias("codeshare_status"),
        x["airline"]["iata"].alias("airline_iata"), x["airline"]["icao"].alias("airline_icao"),
        x["airline"]["name"].alias("airline_name"),
        x["aircraft"]["reg"].alias("aircraft_registration"),
        x["aircraft"]["modeS"].alias("aircraft_modes"), x["aircraft"]["model"].alias("aircraft_model"),
    ]
    if direction == "arrival":
        body += _leg(x, "arrival", "arrival", False) + _leg(x, "departure", "departure", True)
    else:
        body += _leg(x, "departure", "departure", False) + _leg(x, "arrival", "arrival", True)
    body += [x["isCargo"].alias("is_cargo"), F.col("_elem").alias(f"{direction}_payload")]
    del own, other
    return parsed.select(*BATCH_META, *body)


def _typed_hourly(df: DataFrame, weather_tz: str | None = None) -> DataFrame:
    """Typed hourly rows.  The API is asked for local times of the
    airport; by default they are stored unshifted as ``weather_time_utc``
    (as the reference does); ``weather_tz`` converts them to UTC."""
    casts = [F.col(c).cast(t).alias(c) for _, c, t in HOURLY_VARIABLES]
    t = parse_utc_text(F.col("weather_time"))
    if weather_tz:
        t = F.to_utc_timestamp(t.cast("timestamp"), weather_tz).cast("timestamp_ntz")
    return df.select(
        "source", "airport_iata", "loaded_at", t.alias("weather_time_utc"), *casts,
    ).withColumn("weather_description", weather_description(F.col("weathercode")))


def _explode_hourly(df: DataFrame, payload_col: str, keep: list[str]) -> DataFrame:
    h = F.from_json(F.col(payload_col), WEATHER_PAYLOAD)["hourly"]
    arrays = {"weather_time": h["time"]}
    types = {"weather_time": "string"}
    for v, c, _ in HOURLY_VARIABLES:
        arrays[c] = h[v]
        types[c] = "double"
    return df.select(*keep, lockstep_explode(arrays, types))


def stage_weather_api(raw: DataFrame, weather_tz: str | None = None) -> DataFrame:
    """Raw weather payloads (parallel hourly arrays) → one row per hour."""
    base = raw.select("source", "airport_iata", F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
                      "payload")
    return _typed_hourly(_explode_hourly(base, "payload", ["source", "airport_iata", "loaded_at"]), weather_tz)


def stage_weather_history(raw: DataFrame, weather_tz: str | None = None) -> DataFrame:
    """History documents (a list of {source, airport_iata, payload}, the
    payload an object or JSON text) → one row per hour."""
    recs = raw.select(F.col("_load_dt").cast("timestamp_ntz").alias("loaded_at"),
                      F.explode(F.from_json(F.col("weather_data"), HISTORY_RECORDS)).alias("r"))
    flat = recs.select(F.col("r.source").alias("source"), F.col("r.airport_iata").alias("airport_iata"),
                       "loaded_at", F.col("r.payload").alias("payload"))
    return _typed_hourly(_explode_hourly(flat, "payload", ["source", "airport_iata", "loaded_at"]), weather_tz)


def stage_airports(raw: DataFrame) -> DataFrame:
    tok = AIRPORT_NULL_TOKEN
    return raw.select(
        null_tokens("Name", tok).alias("airport_name"),
        null_tokens("City", tok).alias("airport_city"),
        null_tokens("Country", tok).alias("airport_country"),
        code_upper("IATA", tok).alias("airport_iata"),
        code_upper("ICAO", tok).alias("airport_icao"),
        numeric_or_null("Latitude").alias("airport_latitude"),
        numeric_or_null("Longitude").alias("airport_longitude"),
        numeric_or_null("Altitude").alias("airport_altitude"),
        null_tokens("Timezone", tok).alias("airport_timezone_offset"),
        null_tokens("Timezone_1", tok).alias("airport_timezone"),
        F.col("_load_dt").alias("source_loaded_at"),
    )


def stage_airlines(raw: DataFrame) -> DataFrame:
    tok = AIRLINE_NULL_TOKEN
    return raw.select(
        null_tokens("Name", tok).alias("airline_name"),
        null_tokens("IATA", tok).alias("iata_code"),
        null_tokens("ICAO", tok).alias("icao_code"),
        null_tokens("Callsign", tok).alias("callsign"),
        null_tokens("Country", tok).alias("airline_country"),
        tri_bool("Active").alias("airline_active"),
        F.col("_load_dt").alias("source_loaded_at"),
    )


def stage_aircraft(raw: DataFrame) -> DataFrame:
    tok = AIRPORT_NULL_TOKEN
    return raw.select(
        null_tokens("aircraft_type", tok).alias("aircraft_type"),
        null_tokens("manufacturer", tok).alias("manufacturer"),
        F.col("seats").cast("int").alias("seats"),
        F.col("range_km").cast("int").alias("range_km"),
        null_tokens("category", tok).alias("category"),
        F.col("_load_dt").alias("source_loaded_at"),
    )
