"""Marts: weather-hour × operation-type impact and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerocast.functions import by_direction, home_airport_filter, weather_condition
from aerocast.functions.exact import half_up_ratio, to_units
from aerocast.operators.interval_join import interval_join

WEATHER_ATTRIBUTES = [
    "weather_key", "weather_time_utc", "weather_date", "weather_hour", "weather_day_of_week",
    "temperature_2m_c", "apparent_temperature_c", "dewpoint_2m_c", "relative_humidity_2m_pct",
    "precipitation_mm", "rain_mm", "snowfall_cm", "cloudcover_pct", "visibility_m",
    "windspeed_10m_ms", "winddirection_10m_deg", "weathercode", "weather_description",
    "wind_category", "precipitation_category", "rain_category", "temperature_category",
    "cloudcover_category", "visibility_category",
    "is_strong_wind", "is_heavy_precipitation", "is_heavy_rain", "has_thunderstorm",
    "is_overcast", "is_low_visibility",
]
STATUSES = {"delayed": "delayed_operations", "minor_delay": "minor_delay_operations",
            "on_time": "ontime_operations", "unknown": "unknown_operations"}
HOME_AIRPORT = "HKT"      # fixed default of the reference's analysis
WINDOW_SECONDS = 30 * 60  # ± half an hour around each weather hour


def airport_operations(fact_flights: DataFrame, home: str = HOME_AIRPORT) -> DataFrame:
    """Departures from and arrivals at ``home`` with the direction-side
    time, delay and status."""
    return (fact_flights.filter(home_airport_filter(home))
            .select("flight_key", "flight_number", "airline_iata",
                    F.col("flight_direction").alias("operation_type"),
                    by_direction("scheduled_departure_utc", "scheduled_arrival_utc").alias("operation_ts"),
                    by_direction("departure_delay_minutes", "arrival_delay_minutes").alias("delay_minutes"),
                    by_direction("departure_time_status", "arrival_time_status").alias("time_status")))


def _partial_counts(ops: DataFrame) -> DataFrame:
    """Pre-aggregate operations per (operation_ts, operation_type): all
    mart aggregates are sums of these partials, so the interval join sees
    one row per distinct scheduled time instead of one per flight, and a
    peak hour can no longer flood one join task."""
    d = F.col("delay_minutes")
    cnt = lambda cond: F.count(F.when(cond, F.col("flight_key")))
    return (ops.groupBy("operation_ts", "operation_type")
            .agg(F.count("flight_key").alias("n_ops"),
                 F.sum(to_units(d, 2)).alias("sum_delay_units"),
                 F.count(d).alias("n_delay"),
                 F.sum(F.when(d > 0, to_units(d, 2))).alias("sum_pos_units"),
                 F.count(F.when(d > 0, d)).alias("n_pos"),
                 *[cnt(F.col("time_status") == s).alias(f"n_{s}") for s in STATUSES]))


def build_weather_flight_impact(fact_weather: DataFrame, fact_flights: DataFrame,
                                home: str = HOME_AIRPORT, weather_airport: str | None = None
                                ) -> DataFrame:
    """One row per weather hour × operation type with operations within
    ``[hour − 30 min, hour + 30 min)``: counts, exact rounded mean delays,
    status counts and rates.  Weather hours without operations drop out
    (the left join is followed by a not-NULL filter upstream, i.e. inner).
    Weather is not restricted to the home airport unless
    ``weather_airport`` is given."""
    weather = fact_weather
    if weather_airport is not None:
        weather = weather.filter(F.col("airport_iata") == weather_airport)
    partial = _partial_counts(airport_operations(fact_flights, home))
    hours = weather.select("weather_key", "weather_time_utc")
    joined = interval_join(partial, hours.withColumnRenamed("weather_time_utc", "_wt"),
                           point_ts="operation_ts", center_ts="_wt",
                           before=WINDOW_SECONDS, after=WINDOW_SECONDS, closed="left")
    agg = (joined.groupBy("weather_key", "operation_type")
           .agg(F.sum("n_ops").alias("total_operations"),
                F.sum("sum_delay_units").alias("_sd"), F.sum("n_delay").alias("_nd"),
                F.sum("sum_pos_units").alias("_sp"), F.sum("n_pos").alias("_np"),
                *[F.sum(f"n_{s}").alias(name) for s, name in STATUSES.items()]))
    n = F.col("total_operations")
    metrics = agg.select(
        "weather_key", "operation_type", "total_operations",
        half_up_ratio(F.col("_sd"), F.col("_nd"), 2).cast("decimal(18,2)").alias("avg_delay_minutes"),
        half_up_ratio(F.col("_sp"), F.col("_np"), 2).cast("decimal(18,2)").alias("avg_positive_delay_minutes"),
        *STATUSES.values(),
        half_up_ratio(F.col("delayed_operations") * 10_000, n, 4).cast("decimal(18,4)").alias("delay_rate"),
        half_up_ratio(F.col("ontime_operations") * 10_000, n, 4).cast("decimal(18,4)").alias("ontime_rate"),
    )
    attrs = weather.select(*WEATHER_ATTRIBUTES)
    out = metrics.join(attrs, "weather_key")
    cols = WEATHER_ATTRIBUTES[:5] + ["operation_type"] + WEATHER_ATTRIBUTES[5:] + [
        "total_operations", "avg_delay_minutes", "avg_positive_delay_minutes",
        *STATUSES.values(), "delay_rate", "ontime_rate"]
    return out.select(*cols).orderBy(F.asc_nulls_last("weather_time_utc"), "operation_type")


def _avg_half_up(c: str, scale: int, in_scale: int) -> F.Column:
    """round(avg(c), scale) exactly for a decimal column of ``in_scale``."""
    units = F.sum(to_units(F.col(c), in_scale))
    n = F.count(F.col(c))
    if in_scale >= scale:
        num = units
        den = n * F.lit(10 ** (in_scale - scale))
    else:
        num = units * F.lit(10 ** (scale - in_scale))
        den = n
    return half_up_ratio(num, den, scale).cast(f"decimal(18,{scale})")


def build_weather_impact_summary(impact: DataFrame) -> DataFrame:
    """Roll hourly rows up to (operation_type, weather_condition): sums of
    counts and unweighted means of the hourly means and rates."""
    return (impact.withColumn("weather_condition", weather_condition())
            .groupBy("operation_type", "weather_condition")
            .agg(F.count(F.lit(1)).alias("total_weather_hours"),
                 F.sum("total_operations").alias("total_operations"),
                 *[F.sum(c).alias(c) for c in STATUSES.values()],
                 _avg_half_up("avg_delay_minutes", 2, 2).alias("avg_delay_minutes"),
                 _avg_half_up("avg_positive_delay_minutes", 2, 2).alias("avg_positive_delay_minutes"),
                 _avg_half_up("delay_rate", 4, 4).alias("delay_rate"),
                 _avg_half_up("ontime_rate", 4, 4).alias("ontime_rate"),
                 _avg_half_up("windspeed_10m_ms", 2, 6).alias("avg_wind_speed"),
                 _avg_half_up("precipitation_mm", 2, 6).alias("avg_precipitation"),
                 _avg_half_up("temperature_2m_c", 2, 6).alias("avg_temperature"),
                 _avg_half_up("visibility_m", 0, 6).alias("avg_visibility_m"))
            .orderBy("operation_type", "weather_condition"))


def delay_distribution(fact_flights: DataFrame) -> DataFrame:
    """Flights per departure status."""
    return fact_flights.groupBy("departure_time_status").agg(F.count(F.lit(1)).alias("flight_count"))
