"""Core layer: dimensions and the two incremental facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from aerocast.functions import (
    by_direction, cloudcover_category, date_of, delay_minutes, delay_status, hour_of,
    precipitation_category, rain_category, surrogate_key, temperature_category,
    visibility_category, weather_flags, weekday_name, wind_category,
)
from aerocast.operators.dedupe import latest_per_key

# The fifteen columns every flight input is mapped to before the union.
FLIGHT_COLUMNS = [
    "flight_number", "call_sign", "flight_status", "is_cargo", "flight_direction",
    "airline_iata", "airline_icao", "aircraft_model", "aircraft_registration",
    "airport_departure_iata", "airport_arrival_iata",
    "scheduled_departure_utc", "actual_departure_utc",
    "scheduled_arrival_utc", "actual_arrival_utc",
]
# Columns carried only to break dedupe ties deterministically.
TIE_COLUMNS = ["source_rank", "loaded_at"]
# Source priority for ties: the live API feed beats the history file.
SOURCE_RANK = {"api": 2, "parquet": 1}


def to_flight_schema(staged: DataFrame, role: str, source_rank: int = 1) -> DataFrame:
    """Map a staged arrivals/departures frame to the fact input schema.

    ``role='arrival'``: the board airport is the arrival airport and the
    other airport (``departure_airport_iata``) the departure one;
    ``role='departure'`` the reverse.
    """
    if role == "arrival":
        dep, arr = F.col("departure_airport_iata"), F.col("airport_code")
    elif role == "departure":
        dep, arr = F.col("airport_code"), F.col("arrival_airport_iata")
    else:
        raise ValueError(role)
    loaded = F.col("loaded_at") if "loaded_at" in staged.columns else F.lit(None)
    return staged.select(
        "flight_number", "call_sign", "flight_status", "is_cargo",
        F.col("direction").alias("flight_direction"),
        "airline_iata", "airline_icao", "aircraft_model", "aircraft_registration",
        dep.alias("airport_departure_iata"), arr.alias("airport_arrival_iata"),
        "scheduled_departure_utc", F.col("revised_departure_utc").alias("actual_departure_utc"),
        "scheduled_arrival_utc", F.col("revised_arrival_utc").alias("actual_arrival_utc"),
        F.lit(source_rank).alias("source_rank"),
        loaded.cast("timestamp_ntz").alias("loaded_at"),
    )


def flight_fingerprint() -> F.Column:
    """Last tie-breaker but all columns: md5 over the text columns of a
    flight row, as bytes (ordered like its hex text, in half the space)."""
    parts = ["call_sign", "flight_status", "aircraft_registration", "aircraft_model",
             "airline_icao"]
    return F.unhex(F.md5(F.concat_ws("|", *[F.coalesce(F.col(p), F.lit("")) for p in parts])))


def flight_key_parts() -> list:
    """Natural key of a flight version (also the surrogate key's parts)."""
    return [
        "airline_iata", "flight_number",
        F.coalesce(F.col("scheduled_departure_utc"), F.col("scheduled_arrival_utc")),
        "airport_departure_iata", "airport_arrival_iata", "flight_direction",
    ]


def build_fact_flights(inputs: list[DataFrame]) -> DataFrame:
    """Union of the flight inputs → latest version per flight → keys,
    delays, operation time parts and statuses."""
    union = reduce(lambda a, b: a.unionByName(b), inputs)
    deduped = latest_per_key(
        union, keys=flight_key_parts(),
        order_desc=[F.col("actual_departure_utc"), F.col("actual_arrival_utc"),
                    F.col("source_rank"), F.col("loaded_at"), flight_fingerprint()],
        total=True,
    )
    op_ts = by_direction("scheduled_departure_utc", "scheduled_arrival_utc")
    dep_delay = delay_minutes("actual_departure_utc", "scheduled_departure_utc")
    arr_delay = delay_minutes("actual_arrival_utc", "scheduled_arrival_utc")
    out = deduped.select(
        surrogate_key(*flight_key_parts()).alias("flight_key"),
        *FLIGHT_COLUMNS,
        dep_delay.alias("departure_delay_minutes"),
        arr_delay.alias("arrival_delay_minutes"),
        op_ts.alias("operation_ts"),
        date_of(op_ts).alias("operation_date"),
        hour_of(op_ts).alias("operation_hour"),
        weekday_name(op_ts).alias("operation_day_of_week"),
    )
    return out.withColumns({
        "departure_time_status": delay_status("departure_delay_minutes"),
        "arrival_time_status": delay_status("arrival_delay_minutes"),
    })


WEATHER_MEASURES = [
    "temperature_2m_c", "apparent_temperature_c", "dewpoint_2m_c", "relative_humidity_2m_pct",
    "precipitation_mm", "rain_mm", "snowfall_cm", "cloudcover_pct", "visibility_m",
    "windspeed_10m_ms",
]
WEATHER_SOURCE_RANK = {"open-meteo": 2, "history": 1}
MEASURE_TYPE = "decimal(18,6)"


def build_fact_weather(inputs: list[DataFrame]) -> DataFrame:
    """Union of staged weather → one row per (airport, hour), later load
    first then API over history → measures as exact decimals, calendar
    parts, six categories and six flags."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)
    rank = F.coalesce(F.col("source_rank"), F.lit(0)) if "source_rank" in union.columns else F.lit(0)
    union = union.withColumn("source_rank", rank)
    deduped = latest_per_key(
        union, keys=["airport_iata", "weather_time_utc"],
        order_desc=[F.col("loaded_at"), F.col("source_rank")], total=True,
    )
    m = {c: F.col(c).cast(MEASURE_TYPE) for c in WEATHER_MEASURES}
    t = F.col("weather_time_utc")
    base = deduped.select(
        surrogate_key("airport_iata", "weather_time_utc").alias("weather_key"),
        "airport_iata", "weather_time_utc",
        *[m[c].alias(c) for c in WEATHER_MEASURES],
        F.col("winddirection_10m_deg").cast(MEASURE_TYPE).alias("winddirection_10m_deg"),
        F.col("weathercode").cast("int").alias("weathercode"),
        "weather_description",
        date_of(t).alias("weather_date"), hour_of(t).alias("weather_hour"),
        weekday_name(t).alias("weather_day_of_week"),
    )
    flags = weather_flags()
    return base.select(
        "*",
        wind_category("windspeed_10m_ms").alias("wind_category"),
        precipitation_category("precipitation_mm").alias("precipitation_category"),
        rain_category("rain_mm").alias("rain_category"),
        temperature_category("temperature_2m_c").alias("temperature_category"),
        cloudcover_category("cloudcover_pct").alias("cloudcover_category"),
        visibility_category("visibility_m").alias("visibility_category"),
        *[v.alias(k) for k, v in flags.items()],
    )


def build_dim_airports(stg_airports: DataFrame) -> DataFrame:
    return (stg_airports
            .filter(F.col("airport_country").isNotNull() & F.col("airport_name").isNotNull())
            .select(surrogate_key("airport_iata", "airport_icao", "airport_name").alias("airport_key"),
                    "airport_iata", "airport_icao", "airport_name", "airport_country",
                    "airport_city", "airport_latitude", "airport_longitude", "airport_altitude",
                    "airport_timezone", "airport_timezone_offset")
            .distinct())


def airline_key() -> F.Column:
    return surrogate_key("iata_code", "icao_code", "airline_name")


def build_dim_airlines(stg_airlines: DataFrame) -> DataFrame:
    return (stg_airlines
            .select(airline_key().alias("airline_key"), "airline_name", "iata_code", "icao_code",
                    "callsign", "airline_country", "airline_active")
            .distinct())


def build_dim_aircraft(stg_aircraft: DataFrame) -> DataFrame:
    return (stg_aircraft
            .select(surrogate_key("aircraft_type", "manufacturer").alias("aircraft_key"),
                    "aircraft_type", "manufacturer", "seats", "range_km", "category")
            .distinct())
