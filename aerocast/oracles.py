"""DuckDB SQL oracles for the registered queries.

Each string recomputes, from the raw driver tables, what the matching
Spark query returns — same analogue derivation, same rules, exact
integer arithmetic for rounded means (so both engines agree bit-for-bit
on every rounded value).  Decimal outputs are compared as DOUBLE.
"""

from __future__ import annotations

from aerocast.functions.categories import WEATHER_CODES

CODES = ", ".join(str(c) for c in WEATHER_CODES)
DESCRIPTIONS = " ".join(f"WHEN {c} THEN '{d}'" for c, d in WEATHER_CODES.items())


def half_up(num: str, den: str, scale: int) -> str:
    """round(num/den) half away from zero, num already in 10^-scale units."""
    return (f"(CASE WHEN ({den}) > 0 THEN sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den})))"
            f" / {10 ** scale}.0 END)")


FLIGHT_VERSIONS = """
fv_base AS (
  SELECT *,
    date_trunc('hour', ts) + to_minutes(CAST((minute(ts) // 30) * 30 AS BIGINT)) AS slot,
    CASE WHEN event_type <> 'error' THEN (CAST(round(value * 100) AS BIGINT) - 3000) * 600000 END AS delay_us,
    ['HKT', 'BKK', 'DMK'][user_id % 3 + 1] AS board,
    CASE event_type WHEN 'view' THEN 'SVO' WHEN 'click' THEN 'BKK' WHEN 'purchase' THEN 'DMK'
                    WHEN 'signup' THEN 'CNX' END AS other,
    event_id % 2 = 0 AS is_dep
  FROM events),
fv_times AS (
  SELECT *,
    CASE WHEN is_dep THEN slot WHEN event_id % 7 <> 0 THEN slot - INTERVAL 90 MINUTE END AS sdep,
    CASE WHEN is_dep THEN slot + INTERVAL 90 MINUTE ELSE slot END AS sarr
  FROM fv_base),
flight_versions AS (
  SELECT
    upper(substr(event_type, 1, 2)) || ' ' || CAST(user_id % 20 AS VARCHAR) AS flight_number,
    upper(substr(event_type, 1, 3)) || CAST(event_id AS VARCHAR) AS call_sign,
    CASE WHEN event_type = 'error' THEN 'Canceled' WHEN value > 45 THEN 'Delayed' ELSE 'Expected' END AS flight_status,
    (user_id % 10) = 0 AS is_cargo,
    CASE WHEN is_dep THEN 'departure' ELSE 'arrival' END AS flight_direction,
    upper(substr(event_type, 1, 2)) AS airline_iata,
    upper(substr(event_type, 1, 3)) AS airline_icao,
    'Model-' || CAST(user_id % 7 AS VARCHAR) AS aircraft_model,
    'RA-' || CAST(user_id AS VARCHAR) AS aircraft_registration,
    CASE WHEN is_dep THEN board ELSE other END AS airport_departure_iata,
    CASE WHEN is_dep THEN other ELSE board END AS airport_arrival_iata,
    sdep AS scheduled_departure_utc,
    sdep + to_microseconds(delay_us) AS actual_departure_utc,
    sarr AS scheduled_arrival_utc,
    CASE WHEN is_dep AND event_id % 5 = 0 THEN NULL ELSE sarr + to_microseconds(delay_us) END AS actual_arrival_utc,
    CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS source_rank,
    CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-02-15 00:00:00' ELSE ts + INTERVAL 1 DAY END AS loaded_at
  FROM fv_times)"""

FACT_FLIGHTS = FLIGHT_VERSIONS + """,
ff_dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY airline_iata, flight_number, coalesce(scheduled_departure_utc, scheduled_arrival_utc),
                   airport_departure_iata, airport_arrival_iata, flight_direction
      ORDER BY actual_departure_utc DESC NULLS LAST, actual_arrival_utc DESC NULLS LAST,
               source_rank DESC, loaded_at DESC,
               md5(concat_ws('|', coalesce(call_sign, ''), coalesce(flight_status, ''),
                   coalesce(aircraft_registration, ''), coalesce(aircraft_model, ''),
                   coalesce(airline_icao, ''))) DESC) AS rn
    FROM flight_versions) WHERE rn = 1),
ff_delay AS (
  SELECT *,
    date_diff('microsecond', scheduled_departure_utc, actual_departure_utc) AS dep_us,
    date_diff('microsecond', scheduled_arrival_utc, actual_arrival_utc) AS arr_us,
    CASE flight_direction WHEN 'departure' THEN scheduled_departure_utc
                          WHEN 'arrival' THEN scheduled_arrival_utc END AS op_ts
  FROM ff_dedup),
ff_cents AS (
  SELECT *,
    sign(dep_us) * ((2 * abs(dep_us) + 600000) // 1200000) AS dep_cents,
    sign(arr_us) * ((2 * abs(arr_us) + 600000) // 1200000) AS arr_cents
  FROM ff_delay),
fact_flights AS (
  SELECT
    md5(coalesce(airline_iata, '') || coalesce(flight_number, '')
        || coalesce(CAST(coalesce(scheduled_departure_utc, scheduled_arrival_utc) AS VARCHAR), '')
        || coalesce(airport_departure_iata, '') || coalesce(airport_arrival_iata, '')
        || coalesce(flight_direction, '')) AS flight_key,
    flight_number, call_sign, flight_status, is_cargo, flight_direction, airline_iata, airline_icao,
    aircraft_model, aircraft_registration, airport_departure_iata, airport_arrival_iata,
    scheduled_departure_utc, actual_departure_utc, scheduled_arrival_utc, actual_arrival_utc,
    dep_cents / 100.0 AS departure_delay_minutes,
    arr_cents / 100.0 AS arrival_delay_minutes,
    dep_cents, arr_cents,
    op_ts AS operation_ts, CAST(op_ts AS DATE) AS operation_date, hour(op_ts) AS operation_hour,
    rpad(dayname(op_ts), 9, ' ') AS operation_day_of_week,
    CASE WHEN dep_cents IS NULL THEN 'unknown' WHEN dep_cents <= 0 THEN 'on_time'
         WHEN dep_cents <= 1500 THEN 'minor_delay' ELSE 'delayed' END AS departure_time_status,
    CASE WHEN arr_cents IS NULL THEN 'unknown' WHEN arr_cents <= 0 THEN 'on_time'
         WHEN arr_cents <= 1500 THEN 'minor_delay' ELSE 'delayed' END AS arrival_time_status
  FROM ff_cents)"""

FACT_FLIGHT_COLUMNS = """flight_key, flight_number, call_sign, flight_status, is_cargo, flight_direction,
  airline_iata, airline_icao, aircraft_model, aircraft_registration, airport_departure_iata,
  airport_arrival_iata, scheduled_departure_utc, actual_departure_utc, scheduled_arrival_utc,
  actual_arrival_utc, departure_delay_minutes, arrival_delay_minutes, operation_ts, operation_date,
  operation_hour, operation_day_of_week, departure_time_status, arrival_time_status"""


def _hourly_weather(name: str, where: str, source: str, rank: int, loaded: str) -> str:
    return f"""
{name} AS (
  SELECT '{source}' AS source, ['HKT', 'BKK', 'DMK'][user_id % 3 + 1] AS airport_iata,
    TIMESTAMP '{loaded}' AS loaded_at, date_trunc('hour', ts) AS weather_time_utc,
    15.0 + count(*) AS temperature_2m_c, 17.0 + count(*) AS apparent_temperature_c,
    5.0 + count(*) AS dewpoint_2m_c, 40.0 + sum(user_id) % 60 AS relative_humidity_2m_pct,
    count(*) FILTER (WHERE event_type = 'error') * 1.25 AS precipitation_mm,
    count(*) FILTER (WHERE event_type = 'purchase') * 1.25 AS rain_mm,
    0.0 AS snowfall_cm, CAST(sum(user_id) % 101 AS INTEGER) AS cloudcover_pct,
    min(value) * 1000.0 AS visibility_m, max(value) / 10.0 AS windspeed_10m_ms,
    CAST(sum(event_id) % 360 AS INTEGER) AS winddirection_10m_deg,
    [{CODES}][CAST(sum(user_id) % 28 AS INTEGER) + 1] AS weathercode,
    {rank} AS source_rank
  FROM events {where}
  GROUP BY 2, 4)"""


M = "DECIMAL(18,6)"
FACT_WEATHER = (_hourly_weather("w_api", "WHERE event_id % 2 = 0", "open-meteo", 2, "2024-02-01 00:00:00")
                + "," + _hourly_weather("w_hist", "", "history", 1, "2024-01-31 00:00:00") + f""",
w_union AS (SELECT * FROM w_api UNION ALL SELECT * FROM w_hist),
w_dedup AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY airport_iata, weather_time_utc
                                               ORDER BY loaded_at DESC, source_rank DESC) AS rn
                 FROM w_union) WHERE rn = 1),
w_typed AS (
  SELECT md5(coalesce(airport_iata, '') || coalesce(CAST(weather_time_utc AS VARCHAR), '')) AS weather_key,
    airport_iata, weather_time_utc,
    CAST(temperature_2m_c AS {M}) AS temperature_2m_c, CAST(apparent_temperature_c AS {M}) AS apparent_temperature_c,
    CAST(dewpoint_2m_c AS {M}) AS dewpoint_2m_c, CAST(relative_humidity_2m_pct AS {M}) AS relative_humidity_2m_pct,
    CAST(precipitation_mm AS {M}) AS precipitation_mm, CAST(rain_mm AS {M}) AS rain_mm,
    CAST(snowfall_cm AS {M}) AS snowfall_cm, CAST(cloudcover_pct AS {M}) AS cloudcover_pct,
    CAST(visibility_m AS {M}) AS visibility_m, CAST(windspeed_10m_ms AS {M}) AS windspeed_10m_ms,
    CAST(winddirection_10m_deg AS {M}) AS winddirection_10m_deg, CAST(weathercode AS INTEGER) AS weathercode,
    CASE CAST(weathercode AS INTEGER) {DESCRIPTIONS} ELSE 'Unknown' END AS weather_description,
    CAST(weather_time_utc AS DATE) AS weather_date, hour(weather_time_utc) AS weather_hour,
    rpad(dayname(weather_time_utc), 9, ' ') AS weather_day_of_week
  FROM w_dedup),
fact_weather AS (
  SELECT *,
    CASE WHEN windspeed_10m_ms >= 13.9 THEN 'strong' WHEN windspeed_10m_ms >= 10.8 THEN 'moderate'
         WHEN windspeed_10m_ms >= 5.5 THEN 'light' ELSE 'calm' END AS wind_category,
    CASE WHEN precipitation_mm >= 10 THEN 'heavy' WHEN precipitation_mm >= 2.5 THEN 'moderate'
         WHEN precipitation_mm > 0 THEN 'light' ELSE 'none' END AS precipitation_category,
    CASE WHEN rain_mm >= 10 THEN 'heavy_rain' WHEN rain_mm >= 2.5 THEN 'moderate_rain'
         WHEN rain_mm > 0 THEN 'light_rain' ELSE 'no_rain' END AS rain_category,
    CASE WHEN temperature_2m_c >= 35 THEN 'extreme_heat' WHEN temperature_2m_c >= 30 THEN 'very_hot'
         WHEN temperature_2m_c >= 25 THEN 'hot' WHEN temperature_2m_c >= 20 THEN 'warm' ELSE 'mild' END AS temperature_category,
    CASE WHEN cloudcover_pct >= 90 THEN 'overcast' WHEN cloudcover_pct >= 70 THEN 'mostly_cloudy'
         WHEN cloudcover_pct >= 40 THEN 'partly_cloudy' WHEN cloudcover_pct >= 10 THEN 'mostly_clear'
         ELSE 'clear' END AS cloudcover_category,
    CASE WHEN visibility_m < 1000 THEN 'very_poor' WHEN visibility_m < 3000 THEN 'poor'
         WHEN visibility_m < 5000 THEN 'moderate' WHEN visibility_m < 10000 THEN 'good'
         ELSE 'excellent' END AS visibility_category,
    windspeed_10m_ms >= 13.9 AS is_strong_wind, precipitation_mm >= 10 AS is_heavy_precipitation,
    rain_mm >= 10 AS is_heavy_rain, weathercode IN (95, 96, 99) AS has_thunderstorm,
    cloudcover_pct >= 90 AS is_overcast, visibility_m < 3000 AS is_low_visibility
  FROM w_typed)""")

WEATHER_ATTRS = """weather_key, weather_time_utc, weather_date, weather_hour, weather_day_of_week,
  temperature_2m_c, apparent_temperature_c, dewpoint_2m_c, relative_humidity_2m_pct, precipitation_mm,
  rain_mm, snowfall_cm, cloudcover_pct, visibility_m, windspeed_10m_ms, winddirection_10m_deg,
  weathercode, weather_description, wind_category, precipitation_category, rain_category,
  temperature_category, cloudcover_category, visibility_category, is_strong_wind,
  is_heavy_precipitation, is_heavy_rain, has_thunderstorm, is_overcast, is_low_visibility"""

IMPACT = FACT_FLIGHTS + "," + FACT_WEATHER + f""",
ops AS (
  SELECT flight_key, flight_direction AS operation_type, operation_ts,
    CASE flight_direction WHEN 'departure' THEN dep_cents WHEN 'arrival' THEN arr_cents END AS cents,
    CASE flight_direction WHEN 'departure' THEN departure_time_status
                          WHEN 'arrival' THEN arrival_time_status END AS time_status
  FROM fact_flights
  WHERE (airport_departure_iata = 'HKT' AND flight_direction = 'departure')
     OR (airport_arrival_iata = 'HKT' AND flight_direction = 'arrival')),
imp_agg AS (
  SELECT w.weather_key, o.operation_type,
    count(o.flight_key) AS total_operations,
    sum(o.cents) AS sd, count(o.cents) AS nd,
    sum(o.cents) FILTER (WHERE o.cents > 0) AS sp, count(o.cents) FILTER (WHERE o.cents > 0) AS np,
    count(o.flight_key) FILTER (WHERE o.time_status = 'delayed') AS delayed_operations,
    count(o.flight_key) FILTER (WHERE o.time_status = 'minor_delay') AS minor_delay_operations,
    count(o.flight_key) FILTER (WHERE o.time_status = 'on_time') AS ontime_operations,
    count(o.flight_key) FILTER (WHERE o.time_status = 'unknown') AS unknown_operations
  FROM fact_weather w
  JOIN ops o ON o.operation_ts >= w.weather_time_utc - INTERVAL 30 MINUTE
            AND o.operation_ts < w.weather_time_utc + INTERVAL 30 MINUTE
  GROUP BY 1, 2),
mart_weather_flight_impact AS (
  SELECT {WEATHER_ATTRS}, a.operation_type, a.total_operations,
    {half_up('a.sd', 'a.nd', 2)} AS avg_delay_minutes,
    {half_up('a.sp', 'a.np', 2)} AS avg_positive_delay_minutes,
    a.delayed_operations, a.minor_delay_operations, a.ontime_operations, a.unknown_operations,
    {half_up('a.delayed_operations * 10000', 'a.total_operations', 4)} AS delay_rate,
    {half_up('a.ontime_operations * 10000', 'a.total_operations', 4)} AS ontime_rate
  FROM imp_agg a JOIN fact_weather w USING (weather_key))"""


def _avg_sql(c: str, scale: int, in_scale: int) -> str:
    units = f"sum(CAST(round({c} * {10 ** in_scale}) AS HUGEINT))"
    n = f"count({c})"
    if in_scale >= scale:
        return half_up(units, f"{n} * {10 ** (in_scale - scale)}", scale)
    return half_up(f"{units} * {10 ** (scale - in_scale)}", n, scale)


SUMMARY = IMPACT + f""",
summary AS (
  SELECT operation_type,
    CASE WHEN is_strong_wind OR is_heavy_precipitation OR is_heavy_rain OR has_thunderstorm
              OR is_low_visibility THEN 'adverse_weather' ELSE 'normal_weather' END AS weather_condition,
    count(*) AS total_weather_hours, CAST(sum(total_operations) AS BIGINT) AS total_operations,
    CAST(sum(delayed_operations) AS BIGINT) AS delayed_operations,
    CAST(sum(minor_delay_operations) AS BIGINT) AS minor_delay_operations,
    CAST(sum(ontime_operations) AS BIGINT) AS ontime_operations,
    CAST(sum(unknown_operations) AS BIGINT) AS unknown_operations,
    {_avg_sql('avg_delay_minutes', 2, 2)} AS avg_delay_minutes,
    {_avg_sql('avg_positive_delay_minutes', 2, 2)} AS avg_positive_delay_minutes,
    {_avg_sql('delay_rate', 4, 4)} AS delay_rate,
    {_avg_sql('ontime_rate', 4, 4)} AS ontime_rate,
    {_avg_sql('windspeed_10m_ms', 2, 6)} AS avg_wind_speed,
    {_avg_sql('precipitation_mm', 2, 6)} AS avg_precipitation,
    {_avg_sql('temperature_2m_c', 2, 6)} AS avg_temperature,
    {_avg_sql('visibility_m', 0, 6)} AS avg_visibility_m
  FROM mart_weather_flight_impact GROUP BY 1, 2)"""


MEASURES = ["temperature_2m_c", "apparent_temperature_c", "dewpoint_2m_c", "relative_humidity_2m_pct",
            "precipitation_mm", "rain_mm", "snowfall_cm", "cloudcover_pct", "visibility_m", "windspeed_10m_ms",
            "winddirection_10m_deg"]
_DOUBLE_MEASURES = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MEASURES)


def ORACLES() -> dict[str, str]:
    o = {
        "fact_flights": f"WITH {FACT_FLIGHTS} SELECT {FACT_FLIGHT_COLUMNS} FROM fact_flights",
        "fact_weather": f"WITH {FACT_WEATHER} SELECT * EXCLUDE ({', '.join(MEASURES)}), {_DOUBLE_MEASURES} FROM fact_weather",
        "mart_weather_flight_impact": f"WITH {IMPACT} SELECT * EXCLUDE ({', '.join(MEASURES)}), {_DOUBLE_MEASURES} FROM mart_weather_flight_impact",
        "mart_weather_impact_summary": f"WITH {SUMMARY} SELECT * FROM summary",
        "delay_distribution": f"""WITH {FACT_FLIGHTS}
            SELECT departure_time_status, count(*) AS flight_count FROM fact_flights GROUP BY 1""",
    }
    o.update(EXTRA)
    return o


EXTRA: dict[str, str] = {}


# ---- staging ---------------------------------------------------------------

def _stg_flights(direction: str, order_filter: str = "") -> str:
    own, other = ("arrival", "departure") if direction == "arrival" else ("departure", "arrival")
    parity = 0 if direction == "arrival" else 1
    extra = "AND o.o_orderkey % 10 <> 1" if direction == "arrival" else ""
    if order_filter:
        extra += f" AND {order_filter}"
    sign = "-" if direction == "arrival" else "+"
    return f"""
WITH li AS (
  SELECT l.*, o.o_orderkey, o.o_custkey, o.o_orderdate,
    TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(CAST((dayofyear(l.l_shipdate) - 1) % 30 AS BIGINT) * 86400000000
      + CAST(l.l_linenumber AS BIGINT) * 3600000000 + (l.l_partkey % 4) * 900000000) AS base,
    ['SVO', 'BKK', 'DMK', 'CNX', 'KUL'][l.l_suppkey % 5 + 1] AS oth
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_partkey % 2 = {parity} AND o.o_orderkey % 10 <> 0 {extra})
SELECT 'aerodatabox' AS source, ['HKT', 'BKK', 'DMK'][o_custkey % 3 + 1] AS airport_code,
  'IATA' AS code_type,
  o_orderdate + to_minutes(CAST(o_orderkey % 720 AS BIGINT)) AS window_from_local,
  o_orderdate + to_minutes(CAST(o_orderkey % 720 AS BIGINT)) + INTERVAL 12 HOUR AS window_to_local,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((dayofyear(o_orderdate) - 1) % 30 + 1 AS INTEGER)) AS loaded_at,
  '{direction}' AS direction,
  'L' || CAST(l_partkey AS VARCHAR) AS flight_number, l_returnflag AS flight_status,
  'C' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS call_sign,
  l_linestatus AS codeshare_status,
  'S' || CAST(l_suppkey % 10 AS VARCHAR) AS airline_iata,
  'SUP' || CAST(l_suppkey % 10 AS VARCHAR) AS airline_icao,
  'Supplier ' || CAST(l_suppkey AS VARCHAR) AS airline_name,
  CASE WHEN l_tax > 0 THEN 'R' || CAST(l_partkey AS VARCHAR) END AS aircraft_registration,
  CASE WHEN l_tax > 0 THEN 'M' || CAST(l_partkey % 997 AS VARCHAR) END AS aircraft_modes,
  CASE WHEN l_tax > 0 THEN 'Model-' || CAST(l_partkey % 5 AS VARCHAR) END AS aircraft_model,
  'T' || CAST(l_linenumber % 3 AS VARCHAR) AS {own}_terminal,
  base AS scheduled_{own}_utc, base AS scheduled_{own}_local,
  CASE WHEN l_discount > 0 THEN base + to_minutes(CAST(l_quantity AS BIGINT)) END AS revised_{own}_utc,
  CASE WHEN l_discount > 0 THEN base + to_minutes(CAST(l_quantity AS BIGINT)) END AS revised_{own}_local,
  oth AS {other}_airport_iata, 'X' || oth AS {other}_airport_icao,
  'Airport ' || oth AS {other}_airport_city, 'Asia/Bangkok' AS {other}_airport_timezone,
  'D' || CAST(l_suppkey % 4 AS VARCHAR) AS {other}_terminal,
  base {sign} INTERVAL 2 HOUR AS scheduled_{other}_utc, base {sign} INTERVAL 2 HOUR AS scheduled_{other}_local,
  CAST(NULL AS TIMESTAMP) AS revised_{other}_utc, CAST(NULL AS TIMESTAMP) AS revised_{other}_local,
  l_quantity > 25 AS is_cargo
FROM li"""


def _stg_weather(source: str, loaded: str) -> str:
    return f"""
WITH h AS (
  SELECT ['HKT', 'BKK', 'DMK'][user_id % 3 + 1] AS airport_iata, date_trunc('hour', ts) AS weather_time_utc,
    15.0 + count(*) AS t, 17.0 + count(*) AS atmp, 5.0 + count(*) AS dp, 40.0 + sum(user_id) % 60 AS rh,
    count(*) FILTER (WHERE event_type = 'error') * 1.25 AS pr,
    count(*) FILTER (WHERE event_type = 'purchase') * 1.25 AS rn,
    CAST(sum(user_id) % 101 AS INTEGER) AS cc, min(value) * 1000.0 AS vis, max(value) / 10.0 AS ws,
    CAST(sum(event_id) % 360 AS INTEGER) AS wd,
    [{CODES}][CAST(sum(user_id) % 28 AS INTEGER) + 1] AS wc
  FROM events GROUP BY 1, 2)
SELECT '{source}' AS source, airport_iata, {loaded} AS loaded_at, weather_time_utc,
  CAST(t AS DOUBLE) AS temperature_2m_c, CAST(atmp AS DOUBLE) AS apparent_temperature_c,
  CAST(dp AS DOUBLE) AS dewpoint_2m_c, CAST(rh AS DOUBLE) AS relative_humidity_2m_pct,
  CAST(pr AS DOUBLE) AS precipitation_mm, CAST(rn AS DOUBLE) AS rain_mm, 0.0::DOUBLE AS snowfall_cm,
  cc AS cloudcover_pct, CAST(NULL AS INTEGER) AS cloudcover_low_pct, CAST(NULL AS INTEGER) AS cloudcover_mid_pct,
  CAST(NULL AS INTEGER) AS cloudcover_high_pct, CAST(NULL AS DOUBLE) AS surface_pressure_hpa,
  CAST(NULL AS DOUBLE) AS pressure_msl_hpa,
  CASE WHEN day(weather_time_utc) % 5 <> 0 THEN vis END AS visibility_m,
  ws AS windspeed_10m_ms, CAST(NULL AS DOUBLE) AS windgusts_10m_ms, wd AS winddirection_10m_deg,
  wc AS weathercode, CASE wc {DESCRIPTIONS} ELSE 'Unknown' END AS weather_description
FROM h"""


EXTRA.update({
    "stg_flight_arrivals": _stg_flights("arrival"),
    "stg_flight_departures": _stg_flights("departure"),
    "stg_weather_api": _stg_weather("open-meteo", "CAST(weather_time_utc AS DATE) + INTERVAL 1 DAY"),
    "stg_weather_history": _stg_weather("history", "TIMESTAMP '2024-03-01 00:00:00'"),
})


# ---- reference files, dims, keyed writes, SCD2 ------------------------------

RAW_AIRPORTS = r"""
raw_airports AS (
  SELECT
    CASE WHEN c_custkey % 11 = 0 THEN '\N' WHEN c_custkey % 11 = 1 THEN '  ' ELSE ' ' || c_name || ' ' END AS Name,
    CASE WHEN c_custkey % 13 = 0 THEN '' ELSE c_mktsegment END AS City,
    CASE WHEN c_custkey % 17 = 0 THEN '\N' ELSE n_name END AS Country,
    CASE WHEN c_custkey % 7 = 0 THEN '\N' WHEN c_custkey % 19 = 0 THEN ' '
         WHEN c_custkey % 2 = 0 THEN lower(code3) ELSE ' ' || code3 END AS IATA,
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'V' || code3 END AS ICAO,
    CASE WHEN c_custkey % 23 = 0 THEN 'n/a' WHEN c_custkey % 29 = 0 THEN CAST(c_custkey % 90 AS VARCHAR) || '.'
         ELSE (CASE WHEN cents < 0 THEN '-' ELSE '' END) || CAST(abs(cents) // 100 AS VARCHAR) || '.'
              || lpad(CAST(abs(cents) % 100 AS VARCHAR), 2, '0') END AS Latitude,
    ' ' || CAST(c_custkey % 180 AS VARCHAR) || ' ' AS Longitude,
    CASE WHEN c_custkey % 31 = 0 THEN '\N' ELSE CAST(c_nationkey * 10 AS VARCHAR) END AS Altitude,
    CAST(c_nationkey % 12 AS VARCHAR) AS Timezone,
    CASE WHEN c_custkey % 3 = 0 THEN '\N' ELSE 'Asia/Zone' || CAST(c_nationkey AS VARCHAR) END AS Timezone_1,
    TIMESTAMP '2024-03-01 00:00:00' AS _load_dt
  FROM (SELECT c.*, n.n_name, substr(c_mktsegment, 1, 1) || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS code3,
               CAST(round(c_acctbal / 100 * 100) AS BIGINT) AS cents
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)),
stg_airports AS (
  SELECT nullif(nullif(trim(Name), ''), '\N') AS airport_name,
    nullif(nullif(trim(City), ''), '\N') AS airport_city,
    nullif(nullif(trim(Country), ''), '\N') AS airport_country,
    CASE WHEN upper(trim(IATA)) IN ('', '\N') THEN NULL ELSE upper(trim(IATA)) END AS airport_iata,
    CASE WHEN upper(trim(ICAO)) IN ('', '\N') THEN NULL ELSE upper(trim(ICAO)) END AS airport_icao,
    CASE WHEN regexp_matches(trim(Latitude), '^-?[0-9]+(\.[0-9]+)?$') THEN CAST(CAST(trim(Latitude) AS DECIMAL(18,6)) AS DOUBLE) END AS airport_latitude,
    CASE WHEN regexp_matches(trim(Longitude), '^-?[0-9]+(\.[0-9]+)?$') THEN CAST(CAST(trim(Longitude) AS DECIMAL(18,6)) AS DOUBLE) END AS airport_longitude,
    CASE WHEN regexp_matches(trim(Altitude), '^-?[0-9]+(\.[0-9]+)?$') THEN CAST(CAST(trim(Altitude) AS DECIMAL(18,6)) AS DOUBLE) END AS airport_altitude,
    nullif(nullif(trim(Timezone), ''), '\N') AS airport_timezone_offset,
    nullif(nullif(trim(Timezone_1), ''), '\N') AS airport_timezone,
    _load_dt AS source_loaded_at
  FROM raw_airports)"""


def _raw_airlines(version: int) -> str:
    k = "s_suppkey"
    if version == 1:
        name = f"CASE WHEN {k} % 13 = 0 THEN '-' ELSE s_name END"
        cs = f"'CALL' || CAST({k} % 50 AS VARCHAR)"
        act = f"['Y', 'N', 'yes', ' 1 ', 'maybe', '-', 'FALSE'][{k} % 7 + 1]"
    else:
        name = f"CASE WHEN {k} % 7 = 0 THEN s_name || ' NEW' WHEN {k} % 13 = 0 THEN '-' ELSE s_name END"
        cs = f"CASE WHEN {k} % 5 = 0 THEN 'CALL' || CAST({k} % 50 AS VARCHAR) || 'X' ELSE 'CALL' || CAST({k} % 50 AS VARCHAR) END"
        a0 = f"['Y', 'N', 'yes', ' 1 ', 'maybe', '-', 'FALSE'][{k} % 7 + 1]"
        act = f"CASE WHEN {k} % 9 = 0 THEN (CASE WHEN {a0} = 'Y' THEN 'N' ELSE 'Y' END) ELSE {a0} END"
    return f"""
raw_airlines{version} AS (
  SELECT {name} AS Name,
    CASE WHEN {k} % 4 = 0 THEN ' - ' ELSE 'A' || CAST({k} % 26 AS VARCHAR) END AS IATA,
    CASE WHEN {k} % 6 = 0 THEN '' ELSE 'AL' || CAST({k} % 100 AS VARCHAR) END AS ICAO,
    CASE WHEN {k} % 8 = 0 THEN '-' ELSE {cs} END AS Callsign,
    n_name AS Country, {act} AS Active, TIMESTAMP '2024-03-01 00:00:00' AS _load_dt
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
stg_airlines{version} AS (
  SELECT nullif(nullif(trim(Name), ''), '-') AS airline_name,
    nullif(nullif(trim(IATA), ''), '-') AS iata_code,
    nullif(nullif(trim(ICAO), ''), '-') AS icao_code,
    nullif(nullif(trim(Callsign), ''), '-') AS callsign,
    nullif(nullif(trim(Country), ''), '-') AS airline_country,
    CASE WHEN lower(trim(Active)) IN ('y', 'yes', 'true', '1') THEN true
         WHEN lower(trim(Active)) IN ('n', 'no', 'false', '0') THEN false END AS airline_active,
    _load_dt AS source_loaded_at
  FROM raw_airlines{version}),
src_airlines{version} AS (
  SELECT md5(coalesce(iata_code, '') || coalesce(icao_code, '') || coalesce(airline_name, '')) AS airline_key,
    airline_name, iata_code, icao_code, callsign, airline_country, airline_active
  FROM stg_airlines{version})"""


RAW_AIRCRAFT = r"""
stg_aircraft AS (
  SELECT nullif(nullif(trim(CASE WHEN p_partkey % 9 = 0 THEN '\N' ELSE p_type END), ''), '\N') AS aircraft_type,
    nullif(nullif(trim(CASE WHEN p_partkey % 10 = 0 THEN ' ' ELSE p_brand END), ''), '\N') AS manufacturer,
    CAST(p_size AS INTEGER) AS seats, CAST(floor(p_retailprice) AS INTEGER) AS range_km,
    nullif(nullif(trim(CASE WHEN p_partkey % 4 = 0 THEN '\N' ELSE p_name END), ''), '\N') AS category,
    TIMESTAMP '2024-03-01 00:00:00' AS source_loaded_at
  FROM part)"""

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
AIRLINE_COLS = "airline_key, airline_name, iata_code, icao_code, callsign, airline_country, airline_active"
SNP = f"""WITH {_raw_airlines(1)}, {_raw_airlines(2)},
changed AS (
  SELECT a.airline_key FROM src_airlines1 a JOIN src_airlines2 b USING (airline_key)
  WHERE a.callsign IS DISTINCT FROM b.callsign OR a.airline_country IS DISTINCT FROM b.airline_country
     OR a.airline_active IS DISTINCT FROM b.airline_active)
SELECT {AIRLINE_COLS}, md5(airline_key || '|' || '{T1}') AS scd_id, TIMESTAMP '{T1}' AS updated_at,
  TIMESTAMP '{T1}' AS valid_from,
  CASE WHEN airline_key IN (SELECT airline_key FROM changed) THEN TIMESTAMP '{T2}' END AS valid_to
FROM src_airlines1
UNION ALL
SELECT {AIRLINE_COLS}, md5(airline_key || '|' || '{T2}'), TIMESTAMP '{T2}', TIMESTAMP '{T2}', CAST(NULL AS TIMESTAMP)
FROM src_airlines2
WHERE airline_key NOT IN (SELECT airline_key FROM src_airlines1) OR airline_key IN (SELECT airline_key FROM changed)"""

_FF_NAMES = ["fv_base", "fv_times", "flight_versions", "ff_dedup", "ff_delay", "ff_cents", "fact_flights"]


def fact_flights_cte(prefix: str, where: str) -> str:
    s = FACT_FLIGHTS
    for n in sorted(_FF_NAMES, key=len, reverse=True):
        s = s.replace(n, prefix + n)
    return s.replace("FROM events)", f"FROM events WHERE {where})", 1)


MERGE = f"""WITH {fact_flights_cte('t_', "ts < TIMESTAMP '2024-01-20 00:00:00'")},
{fact_flights_cte('s_', "ts >= TIMESTAMP '2024-01-15 00:00:00'")}
SELECT {FACT_FLIGHT_COLUMNS} FROM t_fact_flights WHERE flight_key NOT IN (SELECT flight_key FROM s_fact_flights)
UNION ALL SELECT {FACT_FLIGHT_COLUMNS} FROM s_fact_flights"""

KEYED_INSERT = """WITH b AS (
  SELECT o_orderkey, 'aerodatabox' AS source, ['HKT', 'BKK', 'DMK'][o_custkey % 3 + 1] AS airport_code,
    'IATA' AS code_type,
    strftime(o_orderdate + to_minutes(CAST(o_orderkey % 720 AS BIGINT)), '%Y-%m-%dT%H:%M') AS from_local,
    strftime(o_orderdate + to_minutes(CAST(o_orderkey % 720 AS BIGINT)) + INTERVAL 12 HOUR, '%Y-%m-%dT%H:%M') AS to_local,
    'Both' AS direction, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((dayofyear(o_orderdate) - 1) % 30 + 1 AS INTEGER)) AS extracted_at
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
existing AS (
  SELECT source, airport_code, code_type, from_local, to_local, direction, min(extracted_at) AS extracted_at
  FROM b WHERE o_orderkey % 3 = 0 GROUP BY ALL),
added AS (
  SELECT source, airport_code, code_type, from_local, to_local, direction, min(extracted_at) AS extracted_at
  FROM b GROUP BY ALL)
SELECT * FROM existing
UNION ALL
SELECT a.* FROM added a ANTI JOIN existing e USING (airport_code, code_type, from_local, to_local, direction)"""

EXTRA.update({
    "stg_airports": f"WITH {RAW_AIRPORTS} SELECT * FROM stg_airports",
    "stg_airlines": f"WITH {_raw_airlines(1)} SELECT * FROM stg_airlines1",
    "stg_aircraft": f"WITH {RAW_AIRCRAFT} SELECT * FROM stg_aircraft",
    "dim_airports": f"""WITH {RAW_AIRPORTS}
      SELECT DISTINCT md5(coalesce(airport_iata, '') || coalesce(airport_icao, '') || coalesce(airport_name, '')) AS airport_key,
        airport_iata, airport_icao, airport_name, airport_country, airport_city, airport_latitude,
        airport_longitude, airport_altitude, airport_timezone, airport_timezone_offset
      FROM stg_airports WHERE airport_country IS NOT NULL AND airport_name IS NOT NULL""",
    "dim_airlines": f"WITH {_raw_airlines(1)} SELECT DISTINCT {AIRLINE_COLS} FROM src_airlines1",
    "dim_aircraft": f"""WITH {RAW_AIRCRAFT}
      SELECT DISTINCT md5(coalesce(aircraft_type, '') || coalesce(manufacturer, '')) AS aircraft_key,
        aircraft_type, manufacturer, seats, range_km, category FROM stg_aircraft""",
    "snp_airlines": SNP,
    "fact_flights_merge": MERGE,
    "raw_flight_batches_insert": KEYED_INSERT,
})


# ---- data quality --------------------------------------------------------------

def _dq_suite() -> str:
    cats = {
        "wind_category": ["calm", "light", "moderate", "strong"],
        "precipitation_category": ["none", "light", "moderate", "heavy"],
        "rain_category": ["no_rain", "light_rain", "moderate_rain", "heavy_rain"],
        "temperature_category": ["mild", "warm", "hot", "very_hot", "extreme_heat"],
        "cloudcover_category": ["clear", "mostly_clear", "partly_cloudy", "mostly_cloudy", "overcast"],
        "visibility_category": ["very_poor", "poor", "moderate", "good", "excellent"],
    }
    st = "('unknown', 'on_time', 'minor_delay', 'delayed')"

    def av(t, c, vals):
        return f"(SELECT count(*) FROM (SELECT {c} FROM {t} GROUP BY {c}) WHERE {c} NOT IN {vals})"

    def uq(t, c):
        return f"(SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"

    def nn(t, c):
        return f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)"

    def rel(t, c, p, f):
        return (f"(SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN "
                f"(SELECT {f} FROM {p} WHERE {f} IS NOT NULL))")

    def vds(d, s):
        return (f"(SELECT count(*) FROM fact_flights WHERE ({d} <= 0 AND {s} <> 'on_time') OR "
                f"({d} > 0 AND {d} <= 15 AND {s} <> 'minor_delay') OR ({d} > 15 AND {s} <> 'delayed'))")

    rows = [
        ("fact_flights.valid_delay_status.departure", vds("departure_delay_minutes", "departure_time_status")),
        ("fact_flights.valid_delay_status.arrival", vds("arrival_delay_minutes", "arrival_time_status")),
        ("fact_flights.not_null.flight_key", nn("fact_flights", "flight_key")),
        ("fact_flights.unique.flight_key", uq("fact_flights", "flight_key")),
        ("fact_flights.not_null.flight_number", nn("fact_flights", "flight_number")),
        ("fact_flights.is_uppercase.flight_number",
         "(SELECT count(*) FROM fact_flights WHERE flight_number <> upper(flight_number))"),
        ("fact_flights.not_null.flight_direction", nn("fact_flights", "flight_direction")),
        ("fact_flights.accepted_values.flight_direction",
         av("fact_flights", "flight_direction", "('arrival', 'departure')")),
        ("fact_flights.relationships.airline_iata", rel("fact_flights", "airline_iata", "src_airlines1", "iata_code")),
        ("fact_flights.relationships.airport_departure_iata",
         rel("fact_flights", "airport_departure_iata", "dim_airports", "airport_iata")),
        ("fact_flights.relationships.airport_arrival_iata",
         rel("fact_flights", "airport_arrival_iata", "dim_airports", "airport_iata")),
        ("fact_flights.not_null.operation_ts", nn("fact_flights", "operation_ts")),
        ("fact_flights.accepted_values.departure_time_status", av("fact_flights", "departure_time_status", st)),
        ("fact_flights.accepted_values.arrival_time_status", av("fact_flights", "arrival_time_status", st)),
        ("fact_weather.unique_combination.airport_iata_weather_time_utc",
         "(SELECT count(*) FROM (SELECT airport_iata, weather_time_utc FROM fact_weather GROUP BY ALL HAVING count(*) > 1))"),
        ("fact_weather.not_null.weather_key", nn("fact_weather", "weather_key")),
        ("fact_weather.unique.weather_key", uq("fact_weather", "weather_key")),
        ("fact_weather.not_null.airport_iata", nn("fact_weather", "airport_iata")),
        ("fact_weather.relationships.airport_iata", rel("fact_weather", "airport_iata", "dim_airports", "airport_iata")),
        ("fact_weather.not_null.weather_time_utc", nn("fact_weather", "weather_time_utc")),
        ("fact_weather.accepted_range.temperature_2m_c",
         "(SELECT count(*) FROM fact_weather WHERE NOT (temperature_2m_c >= -80 AND temperature_2m_c <= 60))"),
    ]
    for c, v in cats.items():
        rows.append((f"fact_weather.accepted_values.{c}", av("fact_weather", c, "(" + ", ".join(f"'{x}'" for x in v) + ")")))
    rows += [
        ("dim_airports.not_null.airport_key", nn("dim_airports", "airport_key")),
        ("dim_airports.unique.airport_key", uq("dim_airports", "airport_key")),
        ("dim_airports.unique.airport_iata", uq("dim_airports", "airport_iata")),
        ("dim_airports.not_null.airport_name", nn("dim_airports", "airport_name")),
        ("dim_airports.not_null.airport_country", nn("dim_airports", "airport_country")),
        ("fact_flights.same_departure_arrival_airport",
         "(SELECT count(*) FROM fact_flights WHERE airport_departure_iata = airport_arrival_iata)"),
    ]
    body = "\nUNION ALL ".join(f"SELECT '{n}' AS test_name, {e} AS failures" for n, e in rows)
    return f"""WITH {FACT_FLIGHTS}, {FACT_WEATHER}, {RAW_AIRPORTS}, {_raw_airlines(1)},
dim_airports AS (
  SELECT DISTINCT md5(coalesce(airport_iata, '') || coalesce(airport_icao, '') || coalesce(airport_name, '')) AS airport_key,
    airport_iata, airport_icao, airport_name, airport_country
  FROM stg_airports WHERE airport_country IS NOT NULL AND airport_name IS NOT NULL)
{body}"""


_BATCH_PAGES = """
pages AS (
  SELECT o.o_orderkey, o.o_orderdate, n.c
  FROM orders o JOIN (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1) n ON n.l_orderkey = o.o_orderkey),
page_rows AS (SELECT p.*, g.chunk FROM pages p, LATERAL (SELECT unnest(range(0, CAST(ceil(p.c / 8.0) AS BIGINT))) AS chunk) g)"""

FRESHNESS = f"""WITH {_BATCH_PAGES},
m AS (
  SELECT 'aerodatabox_fids_range' AS source, max(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((dayofyear(o_orderdate) - 1) % 30 + 1 AS INTEGER))) AS max_loaded_at,
         TIMESTAMP '2024-03-04 00:00:00' AS as_of FROM page_rows
  UNION ALL
  SELECT 'weather_raw', max(CAST(CAST(date_trunc('hour', ts) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY),
         TIMESTAMP '2024-03-05 00:00:00' FROM events)
SELECT source, max_loaded_at, date_diff('second', max_loaded_at, as_of) / 86400.0 AS age_days,
  CASE WHEN max_loaded_at IS NULL THEN 'error'
       WHEN date_diff('second', max_loaded_at, as_of) > 35 * 86400 THEN 'error'
       WHEN date_diff('second', max_loaded_at, as_of) > 32 * 86400 THEN 'warn' ELSE 'pass' END AS status
FROM m"""

PAYLOAD_VALIDATION = f"""WITH {_BATCH_PAGES}
SELECT 'aerodatabox_fids_range' AS source_table,
  CASE WHEN o_orderkey % 10 = 0 THEN 'warned' ELSE 'valid' END AS outcome, count(*) AS rows
FROM page_rows GROUP BY ALL
UNION ALL
SELECT 'weather_raw', 'valid', count(*) FROM (
  SELECT DISTINCT ['HKT', 'BKK', 'DMK'][user_id % 3 + 1], CAST(date_trunc('hour', ts) AS DATE) FROM events)"""

EXTRA.update({
    "dq_core_suite": _dq_suite(),
    "dq_source_freshness": FRESHNESS,
    "dq_payload_validation": PAYLOAD_VALIDATION,
})


# ---- analyses and statistics -------------------------------------------------------

BASE = FACT_FLIGHTS + "," + FACT_WEATHER
OPS_HKT = """
hops AS (
  SELECT flight_key, flight_direction AS operation_type, operation_ts,
    CASE flight_direction WHEN 'departure' THEN dep_cents WHEN 'arrival' THEN arr_cents END AS cents
  FROM fact_flights
  WHERE (airport_departure_iata = 'HKT' AND flight_direction = 'departure')
     OR (airport_arrival_iata = 'HKT' AND flight_direction = 'arrival'))"""

WEATHER_LEFT = f"""WITH {BASE}, {OPS_HKT}
SELECT w.weather_key, w.weather_time_utc, o.flight_key, o.operation_type
FROM fact_weather w LEFT JOIN hops o
  ON o.operation_ts >= w.weather_time_utc - INTERVAL 30 MINUTE AND o.operation_ts < w.weather_time_utc + INTERVAL 30 MINUTE"""

PAIRS = """
pairs AS (
  SELECT f.flight_key,
    CASE f.flight_direction WHEN 'departure' THEN f.dep_cents WHEN 'arrival' THEN f.arr_cents END AS cents,
    w.has_thunderstorm, w.is_strong_wind, w.is_low_visibility, w.is_heavy_precipitation,
    w.wind_category, w.visibility_category, w.precipitation_category
  FROM fact_flights f JOIN fact_weather w
    ON f.operation_ts BETWEEN w.weather_time_utc - INTERVAL 30 MINUTE AND w.weather_time_utc + INTERVAL 30 MINUTE)"""

PAIRS_Q = f"""WITH {BASE}, {PAIRS}
SELECT flight_key, cents / 100.0 AS delay_minutes, has_thunderstorm, is_strong_wind, is_low_visibility,
  is_heavy_precipitation, wind_category, visibility_category, precipitation_category FROM pairs"""

FEATS = "temperature_2m_c, relative_humidity_2m_pct, precipitation_mm, visibility_m, cloudcover_pct, windspeed_10m_ms, has_thunderstorm"
FEATS_D = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c != "has_thunderstorm" else c for c in FEATS.split(", "))


def _regression(departures: bool, drop: bool = True) -> str:
    if departures:
        ops = """dops AS (SELECT flight_key, scheduled_departure_utc AS operation_ts, dep_cents AS cents
          FROM fact_flights WHERE flight_direction = 'departure' AND airport_departure_iata = 'HKT'
          AND dep_cents IS NOT NULL)"""
        src = "dops"
        extra = ", wind_category, precipitation_category, visibility_category"
        join = "JOIN"
        cond = ("o.operation_ts >= w.weather_time_utc - INTERVAL 30 MINUTE "
                "AND o.operation_ts < w.weather_time_utc + INTERVAL 30 MINUTE")
    else:
        ops = "dops AS (SELECT flight_key, operation_ts, cents FROM hops WHERE cents IS NOT NULL)"
        src = "dops"
        extra = ""
        join = "LEFT JOIN"
        cond = ("o.operation_ts BETWEEN w.weather_time_utc - INTERVAL 30 MINUTE "
                "AND w.weather_time_utc + INTERVAL 30 MINUTE")
    cols = ["flight_key", "operation_ts", "delay_minutes", "weather_time_utc"] + FEATS.split(", ") \
        + [c.strip() for c in extra.split(",") if c.strip()] + ["time_diff_seconds"]
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    post = f"WHERE rn = 1 AND {notnull}" if drop else "WHERE rn = 1"
    if departures:
        post += " AND cents >= -12000"
    return f"""WITH {BASE}, {OPS_HKT}, {ops},
wh AS (SELECT weather_time_utc, {FEATS_D}{extra} FROM fact_weather WHERE airport_iata = 'HKT'),
j AS (SELECT o.flight_key, o.operation_ts, o.cents, w.* FROM {src} o {join} wh w ON {cond}),
r AS (SELECT *, abs(date_diff('microsecond', weather_time_utc, operation_ts)) AS dus,
        row_number() OVER (PARTITION BY flight_key ORDER BY abs(date_diff('microsecond', weather_time_utc, operation_ts)) NULLS LAST,
                           weather_time_utc NULLS LAST) AS rn
      FROM j),
fr AS (SELECT flight_key, operation_ts, cents / 100.0 AS delay_minutes, weather_time_utc, {FEATS}{extra},
         dus / 1000000.0 AS time_diff_seconds, cents FROM r {post})"""


REG = _regression(False)
DEP = _regression(True)

MULTIPLICITY = f"""WITH {BASE}, {OPS_HKT},
wh AS (SELECT weather_time_utc FROM fact_weather WHERE airport_iata = 'HKT'),
j AS (SELECT o.flight_key FROM hops o LEFT JOIN wh w
      ON o.operation_ts BETWEEN w.weather_time_utc - INTERVAL 30 MINUTE AND w.weather_time_utc + INTERVAL 30 MINUTE
      WHERE o.cents IS NOT NULL),
c AS (SELECT flight_key, count(*) AS rows_per_key FROM j GROUP BY 1)
SELECT rows_per_key, count(*) AS keys FROM c GROUP BY 1"""

_NP_COLS = ["flight_key", "operation_ts", "delay_minutes", "weather_time_utc"] + FEATS.split(", ") + ["time_diff_seconds"]
NULL_PROFILE = _regression(False, drop=False) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM fr" for c in _NP_COLS)

FLAG_COUNTS = REG + "\nSELECT CAST(delay_minutes > 10 AS INTEGER) AS delay_flag, count(*) AS count FROM fr GROUP BY 1"

SAMPLES = """
samp AS (
  SELECT 'thunderstorm' AS test, cents AS v, CASE WHEN has_thunderstorm THEN 1 ELSE 2 END AS side
  FROM pairs WHERE cents > 0 AND has_thunderstorm IS NOT NULL
  UNION ALL
  SELECT 'strong_wind', cents, CASE WHEN is_strong_wind THEN 1 ELSE 2 END
  FROM pairs WHERE cents > 0 AND is_strong_wind IS NOT NULL
  UNION ALL
  SELECT 'precipitation', cents, CASE WHEN precipitation_category <> 'none' THEN 1 ELSE 2 END
  FROM pairs WHERE cents > 0 AND precipitation_category IS NOT NULL)"""

MWU = f"""WITH {BASE}, {PAIRS}, {SAMPLES},
vc AS (SELECT test, v, count(*) AS cnt, count(*) FILTER (WHERE side = 1) AS c1 FROM samp GROUP BY 1, 2),
rk AS (SELECT *, coalesce(sum(cnt) OVER (PARTITION BY test ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM vc),
a AS (SELECT test, sum(c1) AS n1i, sum(cnt) - sum(c1) AS n2i,
        sum(CAST(c1 AS HUGEINT) * (below * 2 + cnt + 1)) AS r1x2,
        sum(CAST(cnt AS HUGEINT) * cnt * cnt - cnt) AS tie FROM rk GROUP BY 1),
b AS (SELECT *, CAST(n1i AS DOUBLE) AS n1, CAST(n2i AS DOUBLE) AS n2,
        CAST(n1i AS DOUBLE) + CAST(n2i AS DOUBLE) AS n,
        CAST((r1x2 - CAST(n1i AS HUGEINT) * (n1i + 1)) AS DOUBLE) / 2 AS u1 FROM a),
c AS (SELECT *, n1 * n2 - u1 AS u2,
        sqrt(n1 * n2 / 12.0 * ((n + 1) - CAST(tie AS DOUBLE) / (n * (n - 1)))) AS sigma,
        (u1 - n1 * n2 / 2.0) / sqrt(n1 * n2 * (n + 1) / 12.0) AS ez FROM b),
t AS (SELECT *, (greatest(u1, u2) - n1 * n2 / 2.0 - 0.5) / sigma / sqrt(2) AS x FROM c),
-- two-sided normal tail: the series of erf below 2, a continued fraction beyond
s AS (SELECT test, 1 - 2 / sqrt(pi()) * exp(-x * x) * list_sum(list_transform(range(0, 61),
        lambda k: x * power(2 * x * x, k) / list_product(list_transform(range(0, k + 1), lambda i: 2.0 * i + 1)))) AS low,
        exp(-x * x) / sqrt(pi()) / (x + list_reduce(list_prepend(0.0::DOUBLE, list_transform(range(120, 0, -1), lambda k: k::DOUBLE)),
          lambda a, k: k / 2 / (x + a))) AS high FROM t)
SELECT test, CAST(n1i AS BIGINT) AS n1, CAST(n2i AS BIGINT) AS n2, u1 AS u_statistic,
  CAST(tie AS DOUBLE) AS tie_sum, round((greatest(u1, u2) - n1 * n2 / 2.0 - 0.5) / sigma, 9) AS z,
  round(ez, 9) AS effect_z, round(abs(ez) / sqrt(n), 9) AS effect_r, 'asymptotic' AS p_method,
  round(least(1, CASE WHEN x < 2 THEN low ELSE high END), 12) AS p_value
FROM t JOIN s USING (test)"""


def _quartiles(src: str, key: str, x: str) -> str:
    """Order-statistic quartiles of {x} per {key} from relation {src}."""
    return f"""
rk_{src} AS (SELECT {key}, {x} AS x, row_number() OVER (PARTITION BY {key} ORDER BY {x}) - 1 AS k,
               count(*) OVER (PARTITION BY {key}) AS n FROM {src} WHERE {x} IS NOT NULL),
tg_{src} AS (SELECT DISTINCT {key}, n, p, (n - 1) * p AS h
             FROM rk_{src}, (VALUES (CAST(0.25 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(0.75 AS DOUBLE))) t(p)),
qv_{src} AS (SELECT t.{key}, t.p, lo.x + (hi.x - lo.x) * (t.h - floor(t.h)) AS q
             FROM tg_{src} t JOIN rk_{src} lo ON lo.{key} = t.{key} AND lo.k = CAST(floor(t.h) AS BIGINT)
             JOIN rk_{src} hi ON hi.{key} = t.{key} AND hi.k = CAST(ceil(t.h) AS BIGINT)),
qq_{src} AS (SELECT {key}, max(q) FILTER (WHERE p = 0.25) AS q1, max(q) FILTER (WHERE p = 0.5) AS median,
               max(q) FILTER (WHERE p = 0.75) AS q3 FROM qv_{src} GROUP BY 1)"""


DESCRIBE = f"""WITH {BASE}, {PAIRS},
ds AS (
  SELECT 'thunderstorm:' || CASE WHEN has_thunderstorm THEN 'yes' ELSE 'no' END AS sample, cents
  FROM pairs WHERE cents > 0 AND has_thunderstorm IS NOT NULL
  UNION ALL SELECT 'strong_wind:' || CASE WHEN is_strong_wind THEN 'yes' ELSE 'no' END, cents
  FROM pairs WHERE cents > 0 AND is_strong_wind IS NOT NULL
  UNION ALL SELECT 'precipitation:' || CASE WHEN precipitation_category <> 'none' THEN 'yes' ELSE 'no' END, cents
  FROM pairs WHERE cents > 0 AND precipitation_category IS NOT NULL),
dsx AS (SELECT sample, cents, cents / 100.0 AS x FROM ds),
{_quartiles('dsx', 'sample', 'x')},
base AS (SELECT sample, count(cents) AS count,
           {half_up('sum(cents) * 10000', 'count(cents)', 6)} AS mean,
           round(stddev_samp(x), 6) AS std, min(x) AS min, max(x) AS max FROM dsx GROUP BY 1)
SELECT b.sample, b.count, b.mean, b.std, b.min, q.q1 AS q25, q.median, q.q3 AS q75, b.max
FROM base b JOIN qq_dsx q USING (sample)"""

_CORR = ["temperature_2m_c", "relative_humidity_2m_pct", "precipitation_mm", "visibility_m",
         "cloudcover_pct", "windspeed_10m_ms", "delay_minutes"]
CORRELATION = DEP + "\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9) AS corr FROM fr"
    for a in _CORR for b in _CORR)

BOX = "WITH " + IMPACT + f""",
bx AS (SELECT wind_category AS category, delay_rate FROM mart_weather_flight_impact WHERE delay_rate IS NOT NULL),
{_quartiles('bx', 'category', 'delay_rate')}
SELECT q.category, q.q1, q.median, q.q3, count(*) AS n,
  min(x.delay_rate) FILTER (WHERE x.delay_rate >= q.q1 - 1.5 * (q.q3 - q.q1) AND x.delay_rate <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_low,
  max(x.delay_rate) FILTER (WHERE x.delay_rate >= q.q1 - 1.5 * (q.q3 - q.q1) AND x.delay_rate <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
  count(*) FILTER (WHERE NOT (x.delay_rate >= q.q1 - 1.5 * (q.q3 - q.q1) AND x.delay_rate <= q.q3 + 1.5 * (q.q3 - q.q1))) AS n_outliers,
  q.q3 - q.q1 AS iqr
FROM bx x JOIN qq_bx q USING (category) GROUP BY q.category, q.q1, q.median, q.q3"""

_REG_COLS = "flight_key, operation_ts, delay_minutes, weather_time_utc, " + FEATS + ", time_diff_seconds"
EXTRA.update({
    "weather_operations_left": WEATHER_LEFT,
    "flight_weather_pairs": PAIRS_Q,
    "regression_frame": REG + f"\nSELECT {_REG_COLS}, CAST(delay_minutes > 10 AS INTEGER) AS delay_flag FROM fr",
    "departure_frame": DEP + f"\nSELECT {_REG_COLS}, wind_category, precipitation_category, visibility_category, CAST(delay_minutes > 10 AS INTEGER) AS delay_flag FROM fr",
    "regression_multiplicity": MULTIPLICITY,
    "regression_null_profile": NULL_PROFILE,
    "delay_flag_counts": FLAG_COUNTS,
    "hypothesis_tests": MWU,
    "group_descriptions": DESCRIBE,
    "weather_delay_correlation": CORRELATION,
    "delay_rate_box_stats": BOX,
})


# ---- sources, sinks, streaming ---------------------------------------------------

_KEYS = """SELECT DISTINCT 'aerodatabox' AS source, ['HKT', 'BKK', 'DMK'][o_custkey % 3 + 1] AS airport_code,
  'IATA' AS code_type,
  strftime(o_orderdate + to_minutes(CAST(o_orderkey % 720 AS BIGINT)), '%Y-%m-%dT%H:%M') AS from_local,
  strftime(o_orderdate + to_minutes(CAST(o_orderkey % 720 AS BIGINT)) + INTERVAL 12 HOUR, '%Y-%m-%dT%H:%M') AS to_local,
  'Both' AS direction
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"""

SWEEP = f"""WITH {_BATCH_PAGES}
SELECT 'aircraft_reference' AS "table", 'loaded' AS status, (SELECT count(*) FROM part) AS rows
UNION ALL SELECT 'airlines', 'loaded', (SELECT count(*) FROM supplier)
UNION ALL SELECT 'airports', 'loaded', (SELECT count(*) FROM customer)
UNION ALL SELECT 'flights_2025', 'loaded', (SELECT count(*) FROM page_rows)
UNION ALL SELECT 'weather_hourly_history', 'loaded', (
  SELECT count(*) FROM (SELECT DISTINCT user_id % 3, year(ts), weekofyear(ts) FROM events))
UNION ALL SELECT 'broken', 'failed', CAST(NULL AS BIGINT)
UNION ALL SELECT 'notes.txt', 'skipped', CAST(NULL AS BIGINT)"""

WINDOWS = """WITH b AS (
  SELECT c_nationkey, CAST(min(o_orderdate) AS DATE) AS start_date, CAST(max(o_orderdate) AS DATE) AS end_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1),
w AS (SELECT *, unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP) + INTERVAL 12 HOUR,
                                       INTERVAL 12 HOUR)) AS ws FROM b)
SELECT c_nationkey, start_date, end_date, strftime(ws, '%Y-%m-%dT%H:%M') AS from_local,
  strftime(ws + INTERVAL 12 HOUR, '%Y-%m-%dT%H:%M') AS to_local FROM w"""

RECENT = """WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS e FROM orders)
SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders FROM orders, m
WHERE CAST(o_orderdate AS DATE) >= e - INTERVAL 30 DAY AND CAST(o_orderdate AS DATE) <= e GROUP BY 1"""

EXTRA.update({
    "raw_file_sweep": SWEEP,
    "stream_ingest_raw": _KEYS,
    "landing_replay_raw": _KEYS,
    "lakehouse_hkt_arrivals": "SELECT * FROM (" + _stg_flights("arrival") + ") WHERE airport_code = 'HKT'",
    "request_windows": WINDOWS,
    "recent_orders_window": RECENT,
})


# ---- the layered monthly build: rows per model ------------------------------------

_LINES = f"""
lo AS (SELECT l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_shipdate, o.o_orderkey, o.o_custkey,
              ['HKT', 'BKK', 'DMK'][o.o_custkey % 3 + 1] AS board,
              ['SVO', 'BKK', 'DMK', 'CNX', 'KUL'][l.l_suppkey % 5 + 1] AS oth,
              TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(CAST((dayofyear(l.l_shipdate) - 1) % 30 AS BIGINT) * 86400000000
                + CAST(l.l_linenumber AS BIGINT) * 3600000000 + (l.l_partkey % 4) * 900000000) AS base
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
staged AS (
  SELECT 'api_arr' AS m, * FROM lo WHERE o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0 AND l_partkey % 2 = 0
  UNION ALL SELECT 'api_dep', * FROM lo WHERE o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0 AND l_partkey % 2 = 1
  UNION ALL SELECT 'pq_arr', * FROM lo WHERE o_orderkey % 2 = 1 AND o_orderkey % 10 <> 1 AND l_partkey % 2 = 0
  UNION ALL SELECT 'pq_dep', * FROM lo WHERE o_orderkey % 2 = 1 AND l_partkey % 2 = 1),
fkeys AS (
  SELECT DISTINCT 'S' || CAST(l_suppkey % 10 AS VARCHAR) AS airline, 'L' || CAST(l_partkey AS VARCHAR) AS num,
    CASE WHEN m LIKE '%arr' THEN base - INTERVAL 2 HOUR ELSE base END AS k_ts,
    CASE WHEN m LIKE '%arr' THEN oth ELSE board END AS dep,
    CASE WHEN m LIKE '%arr' THEN board ELSE oth END AS arr,
    CASE WHEN m LIKE '%arr' THEN 'arrival' ELSE 'departure' END AS direction, base AS op_ts
  FROM staged),
hours AS (
  SELECT ['HKT', 'BKK', 'DMK'][user_id % 3 + 1] AS airport, date_trunc('hour', ts) AS h,
    max(value) / 10.0 >= 13.9 AS strong, count(*) FILTER (WHERE event_type = 'error') * 1.25 >= 10 AS heavy_p,
    count(*) FILTER (WHERE event_type = 'purchase') * 1.25 >= 10 AS heavy_r,
    [{CODES}][CAST(sum(user_id) % 28 AS INTEGER) + 1] IN (95, 96, 99) AS thunder,
    CASE WHEN day(date_trunc('hour', ts)) % 5 <> 0 THEN min(value) * 1000.0 < 3000 END AS low_vis
  FROM events GROUP BY 1, 2),
hkt_ops AS (SELECT DISTINCT direction, op_ts FROM fkeys WHERE (direction = 'departure' AND dep = 'HKT')
                                                   OR (direction = 'arrival' AND arr = 'HKT')),
mart AS (
  SELECT DISTINCT w.airport, w.h, o.direction,
    CASE WHEN w.strong OR w.heavy_p OR w.heavy_r OR w.thunder OR w.low_vis THEN 'adverse' ELSE 'normal' END AS cond
  FROM hours w JOIN hkt_ops o ON o.op_ts >= w.h - INTERVAL 30 MINUTE AND o.op_ts < w.h + INTERVAL 30 MINUTE)"""

MODEL_BUILD = f"""WITH {_BATCH_PAGES}, {RAW_AIRPORTS}, {_raw_airlines(1)}, {RAW_AIRCRAFT}, {_LINES}
SELECT 'aerodatabox_fids_range' AS model, count(*) AS rows FROM page_rows WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'flights_2025', count(*) FROM page_rows WHERE o_orderkey % 2 = 1
UNION ALL SELECT 'weather_raw', count(*) FROM (SELECT DISTINCT airport, CAST(h AS DATE) FROM hours)
UNION ALL SELECT 'weather_hourly_history', count(*) FROM (SELECT DISTINCT airport, year(h), weekofyear(h) FROM hours)
UNION ALL SELECT 'airports', count(*) FROM customer
UNION ALL SELECT 'airlines', count(*) FROM supplier
UNION ALL SELECT 'aircraft_reference', count(*) FROM part
UNION ALL SELECT 'stg_aerodatabox_arrivals', count(*) FROM staged WHERE m = 'api_arr'
UNION ALL SELECT 'stg_aerodatabox_departures', count(*) FROM staged WHERE m = 'api_dep'
UNION ALL SELECT 'stg_parquet_arrivals', count(*) FROM staged WHERE m = 'pq_arr'
UNION ALL SELECT 'stg_parquet_departures', count(*) FROM staged WHERE m = 'pq_dep'
UNION ALL SELECT 'stg_weather_api', count(*) FROM hours
UNION ALL SELECT 'stg_weather_history', count(*) FROM hours
UNION ALL SELECT 'stg_airports', count(*) FROM customer
UNION ALL SELECT 'stg_airlines', count(*) FROM supplier
UNION ALL SELECT 'stg_aircraft_reference', count(*) FROM part
UNION ALL SELECT 'dim_airports', count(*) FROM (
  SELECT DISTINCT airport_iata, airport_icao, airport_name, airport_country, airport_city, airport_latitude,
    airport_longitude, airport_altitude, airport_timezone, airport_timezone_offset
  FROM stg_airports WHERE airport_country IS NOT NULL AND airport_name IS NOT NULL)
UNION ALL SELECT 'dim_airlines', count(*) FROM (SELECT DISTINCT * FROM src_airlines1)
UNION ALL SELECT 'dim_aircraft', count(*) FROM (SELECT DISTINCT aircraft_type, manufacturer, seats, range_km, category FROM stg_aircraft)
UNION ALL SELECT 'fact_flights', count(*) FROM (SELECT DISTINCT airline, num, k_ts, dep, arr, direction FROM fkeys)
UNION ALL SELECT 'fact_weather', count(*) FROM hours
UNION ALL SELECT 'snp_airlines', count(*) FROM src_airlines1
UNION ALL SELECT 'mart_weather_flight_impact', count(*) FROM (SELECT DISTINCT airport, h, direction FROM mart)
UNION ALL SELECT 'mart_weather_impact_summary', count(*) FROM (SELECT DISTINCT direction, cond FROM mart)"""

EXTRA["model_build"] = MODEL_BUILD


EXTRA.update({
    "payload_key_filters": f"""WITH {_BATCH_PAGES}
SELECT o_orderkey % 10 <> 0 AS has_arrivals_key, o_orderkey % 10 NOT IN (0, 1) AS arrivals_not_null,
       o_orderkey % 10 <> 0 AS has_departures_key, o_orderkey % 10 <> 0 AS departures_not_null,
       count(*) AS pages
FROM page_rows GROUP BY ALL""",
    "event_props_extract": """SELECT event_type, count(*) AS events,
  CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
  count(*) FILTER (WHERE json_extract(props, '$.k') IS NULL) AS missing_k
FROM events GROUP BY 1""",
})


def _staging_suite() -> str:
    flights = [("stg_aerodatabox_arrivals", "arrival", "scheduled_arrival_utc", "o.o_orderkey % 2 = 0"),
               ("stg_aerodatabox_departures", "departure", "scheduled_departure_utc", "o.o_orderkey % 2 = 0"),
               ("stg_parquet_arrivals", "arrival", "scheduled_arrival_utc", "o.o_orderkey % 2 = 1"),
               ("stg_parquet_departures", "departure", "scheduled_departure_utc", "o.o_orderkey % 2 = 1")]
    ctes = [f"{n} AS ({_stg_flights(d, f)})" for n, d, _, f in flights]
    wsql = _stg_weather("open-meteo", "CAST(weather_time_utc AS DATE) + INTERVAL 1 DAY")
    ctes.append(f"stg_weather_api AS ({wsql})")
    ctes.append(f"stg_weather_history AS ({_stg_weather('history', chr(39).join(['TIMESTAMP ', '2024-03-01 00:00:00', '']))})")
    rows = []

    def nn(t, c):
        return f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)"
    for n, d, ts, _ in flights:
        rows += [(f"{n}.not_null.{c}", nn(n, c)) for c in ("airport_code", "flight_number", "direction", ts,
                                                           "source", "loaded_at")]
        rows.append((f"{n}.accepted_values.direction",
                     f"(SELECT count(*) FROM (SELECT direction FROM {n} GROUP BY 1) WHERE direction NOT IN ('{d}'))"))
    rows += [("stg_aircraft_reference.not_null.aircraft_type", nn("stg_aircraft", "aircraft_type")),
             ("stg_aircraft_reference.not_null.source_loaded_at", nn("stg_aircraft", "source_loaded_at")),
             ("stg_airlines.not_null.airline_name", nn("stg_airlines1", "airline_name")),
             ("stg_airlines.accepted_values.airline_active",
              "(SELECT count(*) FROM (SELECT airline_active FROM stg_airlines1 GROUP BY 1) WHERE airline_active NOT IN (true, false))"),
             ("stg_airlines.not_null.source_loaded_at", nn("stg_airlines1", "source_loaded_at")),
             ("stg_airports.not_null.airport_name", nn("stg_airports", "airport_name")),
             ("stg_airports.not_null.airport_country", nn("stg_airports", "airport_country")),
             ("stg_airports.unique.airport_iata",
              "(SELECT count(*) FROM (SELECT airport_iata FROM stg_airports WHERE airport_iata IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"),
             ("stg_airports.not_null.source_loaded_at", nn("stg_airports", "source_loaded_at"))]
    for w in ("stg_weather_api", "stg_weather_history"):
        rows += [(f"{w}.not_null.{c}", nn(w, c)) for c in ("airport_iata", "weather_time_utc", "temperature_2m_c",
                                                           "weathercode", "weather_description")]
    rows += [("dim_airlines.not_null.airline_key", nn("dl", "airline_key")),
             ("dim_airlines.unique.airline_key",
              "(SELECT count(*) FROM (SELECT airline_key FROM dl GROUP BY 1 HAVING count(*) > 1))"),
             ("dim_airlines.not_null.airline_name", nn("dl", "airline_name")),
             ("dim_aircraft.not_null.aircraft_key", nn("dc", "aircraft_key")),
             ("dim_aircraft.unique.aircraft_key",
              "(SELECT count(*) FROM (SELECT aircraft_key FROM dc GROUP BY 1 HAVING count(*) > 1))"),
             ("dim_aircraft.not_null.aircraft_type", nn("dc", "aircraft_type")),
             ("dim_aircraft.not_null.manufacturer", nn("dc", "manufacturer"))]
    body = "\nUNION ALL ".join(f"SELECT '{n}' AS test_name, {e} AS failures" for n, e in rows)
    return (f"WITH {', '.join(ctes)}, {RAW_AIRPORTS}, {_raw_airlines(1)}, {RAW_AIRCRAFT},\n"
            f"dl AS (SELECT DISTINCT {AIRLINE_COLS} FROM src_airlines1),\n"
            "dc AS (SELECT DISTINCT md5(coalesce(aircraft_type, '') || coalesce(manufacturer, '')) AS aircraft_key,"
            " aircraft_type, manufacturer, seats, range_km, category FROM stg_aircraft)\n" + body)


EXTRA["dq_staging_suite"] = _staging_suite()


EXTRA["raw_weather_insert"] = """
SELECT DISTINCT 'open-meteo' AS source, ['HKT', 'BKK', 'DMK'][user_id % 3 + 1] AS airport_iata,
  CAST(CASE user_id % 3 WHEN 0 THEN 8.1132 WHEN 1 THEN 13.69 ELSE 13.9126 END AS DOUBLE) AS latitude,
  CAST(CASE user_id % 3 WHEN 0 THEN 98.3169 WHEN 1 THEN 100.7501 ELSE 100.6068 END AS DOUBLE) AS longitude,
  CAST(date_trunc('hour', ts) AS DATE) AS start_date, CAST(date_trunc('hour', ts) AS DATE) AS end_date,
  CAST(CAST(date_trunc('hour', ts) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS loaded_at
FROM events"""


# ---- edges of the models --------------------------------------------------------

EXTRA["fact_merge_null_date"] = """
WITH o AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DOUBLE) AS v,
                  CAST(CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) END AS INTEGER) AS y FROM orders),
src AS (SELECT * FROM (
          SELECT k, CAST(-1.0 AS DOUBLE) AS v, y FROM o WHERE k % 5 = 0
          UNION ALL SELECT k + 10000000, v, y FROM o WHERE k % 11 = 0 AND (y = 1995 OR y IS NULL))
        WHERE y IN (1995, 1996) OR y IS NULL)
SELECT k, v, y FROM o WHERE k NOT IN (SELECT k FROM src)
UNION ALL SELECT k, v, y FROM src"""

EXTRA["summary_rounding_edge"] = """
SELECT o_orderkey, CAST(0 AS BIGINT) AS below, CAST(1 AS BIGINT) AS half, CAST(1 AS BIGINT) AS above,
       CAST(0 AS BIGINT) AS negative_below, CAST(-1 AS BIGINT) AS negative_half
FROM orders"""

EXTRA["csv_cyrillic"] = """
SELECT CAST(c_custkey AS BIGINT) AS id, 'Пулково ' || c_name AS name,
       CASE WHEN c_custkey % 3 <> 0 THEN 'сказал "да",' || chr(10) || c_mktsegment END AS note FROM customer"""

EXTRA["json_shapes"] = """
WITH p AS (SELECT CAST(c_custkey // 100 AS BIGINT) AS a, min(c_name) AS c FROM customer GROUP BY 1)
SELECT 'list.json' AS file, 'a,b' AS cols, CAST(c_custkey AS BIGINT) AS a, '{"c":"' || c_name || '"}' AS b FROM customer
UNION ALL SELECT 'line.json', 'a,b.c', a, c FROM p
UNION ALL SELECT 'pretty.json', 'a,b.c', a, c FROM p
UNION ALL SELECT 'lines.jsonl', 'a,b', CAST(c_custkey AS BIGINT), '{"c":"' || c_name || '"}' FROM customer"""

EXTRA["stream_stop_and_resume"] = _KEYS

EXTRA["stream_poison_messages"] = """
WITH b AS (
  SELECT DISTINCT ['HKT', 'BKK', 'DMK'][o_custkey % 3 + 1] AS airport_code,
    strftime(o_orderdate + to_minutes(CAST(o_orderkey % 720 AS BIGINT)), '%Y-%m-%dT%H:%M') AS from_local, o_orderkey % 7500 = 0 AS named
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
SELECT CASE WHEN named THEN 'dlq' ELSE 'raw' END AS place, airport_code, from_local, named FROM b"""


# ---- further charts and shapes ---------------------------------------------------

_MART = ["delay_rate", "avg_delay_minutes", "total_operations", "temperature_2m_c", "precipitation_mm",
         "windspeed_10m_ms", "visibility_m", "has_thunderstorm"]
EXTRA["mart_correlation"] = "WITH " + IMPACT + "\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9) AS corr "
    "FROM mart_weather_flight_impact" for a in _MART for b in _MART)
for _name, _column in (("precipitation", "precipitation_category"), ("cloudcover", "cloudcover_category"),
                       ("thunderstorm", "CAST(has_thunderstorm AS VARCHAR)")):
    EXTRA[f"delay_rate_box_{_name}"] = BOX.replace("SELECT wind_category AS category", f"SELECT {_column} AS category")
EXTRA["fact_shapes"] = "WITH " + IMPACT + """
SELECT 'fact_flights' AS model, count(*) AS rows, count(DISTINCT flight_key) AS distinct_first_column FROM fact_flights
UNION ALL SELECT 'fact_weather', count(*), count(DISTINCT weather_key) FROM fact_weather
UNION ALL SELECT 'mart_weather_flight_impact', count(*), count(DISTINCT weather_key) FROM mart_weather_flight_impact"""
EXTRA["mart_head"] = "WITH " + IMPACT + """
SELECT weather_time_utc, operation_type, weather_key, total_operations,
       CAST(row_number() OVER (ORDER BY weather_time_utc NULLS LAST, operation_type, weather_key) AS INTEGER) AS position
FROM mart_weather_flight_impact QUALIFY position <= 20"""
EXTRA["lakehouse_departures"] = _stg_flights("departure")


# ---- classifiers: the fit itself, by Newton steps ----------------------------------

def _classifier(frame: str, steps: int = 10) -> str:
    """Split, standardisation, Newton steps (Gauss-Jordan on the Hessian and
    the gradient) and metrics over the frame ``fr``."""
    feats = FEATS.split(", ")
    k = len(feats) + 1
    x = [f"x{i}" for i in range(k)]
    num = ", ".join(f"CAST(CAST({c} AS {'INTEGER' if c == 'has_thunderstorm' else 'DOUBLE'}) AS DOUBLE) AS f{i}" for i, c in enumerate(feats))
    stats = ", ".join(f"avg(f{i}) AS m{i}, stddev_pop(f{i}) AS s{i}" for i in range(k - 1))
    z = ", ".join(f"(f{i} - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END AS x{i}" for i in range(k - 1)) + f", 1.0::DOUBLE AS x{k - 1}"
    dot = " + ".join(f"w{i} * {v}" for i, v in enumerate(x))
    out = [frame + f""",
lab AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY md5('42:' || flight_key)) <= (count(*) OVER () + 4) // 5 AS test, CAST(delay_minutes > 10 AS INTEGER) AS y, {num} FROM fr),
par AS MATERIALIZED (SELECT {stats} FROM lab WHERE NOT test),
grp AS MATERIALIZED (SELECT test, y, count(*) AS n, {", ".join(x)} FROM (SELECT test, y, {z} FROM lab, par) GROUP BY ALL),
w_0 AS MATERIALIZED (SELECT {", ".join(f"0.0::DOUBLE AS w{i}" for i in range(k))})"""]
    for s in range(1, steps + 1):
        cell = lambda i, j: (f"sum(n * p * (1 - p) * x{i} * x{j})" + (" + 1" if i == j < k - 1 else "") if j < k
                             else f"sum(n * (p - y) * x{i})" + (f" + any_value(w{i})" if i < k - 1 else ""))
        names = [f"h{i}_{j}" for i in range(k) for j in range(k + 1)]
        out.append(f"""
g_{s} AS MATERIALIZED (
  SELECT {", ".join(f"{cell(i, j)} AS h{i}_{j}" for i in range(k) for j in range(k + 1))}
  FROM (SELECT *, 1 / (1 + exp(-({dot}))) AS p FROM grp, w_{s - 1} WHERE NOT test)),
e_{s}_0 AS MATERIALIZED (SELECT * FROM g_{s})""")
        for c in range(k):
            sweep = [f"h{c}_{j} / h{c}_{c} AS h{c}_{j}" if i == c else f"h{i}_{j} - h{i}_{c} * h{c}_{j} / h{c}_{c} AS h{i}_{j}"
                     for i in range(k) for j in range(k + 1)]
            out.append(f"e_{s}_{c + 1} AS MATERIALIZED (SELECT {', '.join(sweep)} FROM e_{s}_{c})")
        out.append(f"w_{s} AS MATERIALIZED (SELECT {', '.join(f'w{i} - h{i}_{k} AS w{i}' for i in range(k))} FROM w_{s - 1}, e_{s}_{k})")
    rows = " UNION ALL ".join(f"SELECT '{c}' AS name, w{i} AS w FROM w_{steps}" for i, c in enumerate(feats))
    grad = ", ".join(f"abs(sum(n * (p - y) * x{i}){f' + any_value(w{i})' if i < k - 1 else ''})" for i in range(k))
    avg = "\nUNION ALL ".join(
        f"SELECT '{m}', 'macro avg', sum({m}) / count(*) FROM per UNION ALL SELECT '{m}', 'weighted avg', sum({m} * support) / sum(support) FROM per"
        for m in ("precision", "recall", "f1"))
    out.append(f"""
coef AS MATERIALIZED ({rows}),
pred AS MATERIALIZED (
  SELECT y, CAST({dot} >= 0 AS INTEGER) AS p, sum(n) AS n FROM grp, w_{steps} WHERE test GROUP BY ALL),
cls AS (SELECT y AS c FROM pred UNION SELECT p FROM pred),
hit AS (
  SELECT c, coalesce(sum(n) FILTER (WHERE y = c AND p = c), 0)::DOUBLE AS tp, coalesce(sum(n) FILTER (WHERE p = c), 0)::DOUBLE AS said,
         coalesce(sum(n) FILTER (WHERE y = c), 0)::DOUBLE AS support FROM cls, pred GROUP BY c),
pr AS (SELECT c, support, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM hit),
per AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr),
res AS (
  SELECT greatest({grad}) / sum(n) AS r FROM (SELECT *, 1 / (1 + exp(-({dot}))) AS p FROM grp, w_{steps} WHERE NOT test)),
met AS (
  SELECT 'accuracy' AS section, 'all' AS name, (sum(n) FILTER (WHERE y = p))::DOUBLE / sum(n) AS value FROM pred
  UNION ALL SELECT 'precision', c::VARCHAR, precision FROM per UNION ALL SELECT 'recall', c::VARCHAR, recall FROM per
  UNION ALL SELECT 'f1', c::VARCHAR, f1 FROM per UNION ALL SELECT 'support', c::VARCHAR, support FROM per
  UNION ALL {avg}
  UNION ALL SELECT 'confusion', y || '->' || p, n::DOUBLE FROM pred)
SELECT 'coefficient' AS section, name, round(w, 6) + 0.0 AS value FROM coef
UNION ALL SELECT 'intercept', 'intercept', round(w{k - 1}, 6) + 0.0 FROM w_{steps}
UNION ALL SELECT 'coefficient_rank', name, (row_number() OVER (ORDER BY w DESC))::DOUBLE FROM coef
UNION ALL SELECT 'gradient', 'max_abs_per_row', round(r, 9) + 0.0 FROM res
UNION ALL SELECT section, name, round(value, 9) FROM met""")
    return ",\n".join(out)


EXTRA["delay_classifier"] = _classifier(REG)
EXTRA["departure_classifier"] = _classifier(DEP)


# ---- raw batches to facts, and the two raw sources ----------------------------------

def _staged_versions() -> str:
    """The four staged inputs in the fact's input schema."""
    ctes, union = [], []
    for feed, parity, rank in (("api", 0, 2), ("pq", 1, 1)):
        for direction in ("arrival", "departure"):
            name = f"{feed}_{direction}"
            ctes.append(f"{name} AS ({_stg_flights(direction, f'o.o_orderkey % 2 = {parity}')})")
            dep, arr = ("departure_airport_iata", "airport_code") if direction == "arrival" else ("airport_code", "arrival_airport_iata")
            union.append(f"""SELECT flight_number, call_sign, flight_status, is_cargo, direction AS flight_direction, airline_iata, airline_icao,
    aircraft_model, aircraft_registration, {dep} AS airport_departure_iata, {arr} AS airport_arrival_iata,
    scheduled_departure_utc, revised_departure_utc AS actual_departure_utc, scheduled_arrival_utc, revised_arrival_utc AS actual_arrival_utc,
    {rank} AS source_rank, loaded_at FROM {name}""")
    return ",\n".join(ctes) + ",\nflight_versions AS (" + "\nUNION ALL ".join(union) + ")"


EXTRA["fact_flights_from_raw"] = ("WITH " + _staged_versions() + FACT_FLIGHTS[len(FLIGHT_VERSIONS):]
                                  + f"\nSELECT {FACT_FLIGHT_COLUMNS} FROM fact_flights")

EXTRA["raw_source_variant"] = """
WITH e AS (
  SELECT ['HKT', 'BKK', 'DMK'][o_custkey % 3 + 1] AS airport_code, CASE WHEN l_partkey % 2 = 0 THEN 'arrivals' ELSE 'departures' END AS board,
    concat_ws('|', 'L' || l_partkey, 'C' || l_orderkey || '-' || l_linenumber, l_returnflag, 'S' || (l_suppkey % 10),
              CASE WHEN l_quantity > 25 THEN 'true' ELSE 'false' END) AS x
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderkey % 10 <> 0 AND NOT (o_orderkey % 10 = 1 AND l_partkey % 2 = 0))
SELECT target, airport_code, board, count(*) AS flights, bit_xor(CAST('0x' || substr(md5(x), 1, 15) AS BIGINT)) AS content
FROM e, (VALUES ('ci'), ('dev')) t(target) GROUP BY ALL"""
