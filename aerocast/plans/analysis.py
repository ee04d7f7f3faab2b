"""Analyses of the notebook, as distributed DataFrame jobs: flight ×
weather pairs, hypothesis tests, regression frames and classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerocast.functions import by_direction
from aerocast.operators.interval_join import interval_join, nearest_match
from aerocast.operators.stats import describe, mann_whitney_grouped
from aerocast.session import materialize
from aerocast.plans.marts import HOME_AIRPORT, WINDOW_SECONDS, airport_operations

FEATURES = ["temperature_2m_c", "relative_humidity_2m_pct", "precipitation_mm", "visibility_m",
            "cloudcover_pct", "windspeed_10m_ms", "has_thunderstorm"]
DELAY_FLAG_MINUTES = 10      # fixed label threshold: delay > 10 min
OUTLIER_MIN_DELAY = -120     # departures analysis drops delays below this


def flight_weather_pairs(fact_flights: DataFrame, fact_weather: DataFrame) -> DataFrame:
    """Every flight × every weather hour with the operation time inside
    [hour − 30 min, hour + 30 min] (closed; a flight at hh:30 meets two
    hours).  No airport filter on either side."""
    ops = fact_flights.select(
        "flight_key",
        by_direction("scheduled_departure_utc", "scheduled_arrival_utc").alias("operation_ts"),
        by_direction("departure_delay_minutes", "arrival_delay_minutes").alias("delay_minutes"))
    w = fact_weather.select("weather_time_utc", "has_thunderstorm", "is_strong_wind", "is_low_visibility",
                            "is_heavy_precipitation", "wind_category", "visibility_category",
                            "precipitation_category")
    j = interval_join(ops, w, "operation_ts", "weather_time_utc", WINDOW_SECONDS, WINDOW_SECONDS,
                      closed="both", how="inner")
    return j.select("flight_key", "delay_minutes", "has_thunderstorm", "is_strong_wind",
                    "is_low_visibility", "is_heavy_precipitation", "wind_category",
                    "visibility_category", "precipitation_category")


def hypothesis_groups() -> dict:
    """The three two-sample comparisons: first sample, second sample."""
    return {
        "thunderstorm": (F.col("has_thunderstorm") == True, F.col("has_thunderstorm") == False),   # noqa: E712
        "strong_wind": (F.col("is_strong_wind") == True, F.col("is_strong_wind") == False),       # noqa: E712
        "precipitation": (F.col("precipitation_category") != "none", F.col("precipitation_category") == "none"),
    }


FLAGS = ["has_thunderstorm", "is_strong_wind", "precipitation_category"]


def weighted_samples(fact_flights: DataFrame, fact_weather: DataFrame) -> DataFrame:
    """(test, side, delay_minutes, weight): the samples of the comparisons,
    positive delays of ``flight_weather_pairs``, without building a pair.

    Both sides of the join are counts: operations per (time, delay) and
    weather per (hour, flags), however many airports share an hour.  A
    matching row stands for the product of the two counts, and rows of
    equal delay and flags are added before they enter the comparisons."""
    ops = (fact_flights.select(
        by_direction("scheduled_departure_utc", "scheduled_arrival_utc").alias("operation_ts"),
        by_direction("departure_delay_minutes", "arrival_delay_minutes").alias("delay_minutes"))
        .filter("delay_minutes > 0 and operation_ts is not null")
        .groupBy("operation_ts", "delay_minutes").agg(F.count(F.lit(1)).alias("n_ops")))
    hours = fact_weather.groupBy("weather_time_utc", *FLAGS).agg(F.count(F.lit(1)).alias("n_hours"))
    met = interval_join(ops, hours, "operation_ts", "weather_time_utc", WINDOW_SECONDS, WINDOW_SECONDS, closed="both", how="inner")
    met = met.groupBy("delay_minutes", *FLAGS).agg(F.sum(F.col("n_ops") * F.col("n_hours")).alias("weight"))
    entries = [F.struct(F.lit(name).alias("test"), F.when(a, F.lit(1)).when(b, F.lit(2)).alias("side"))
               for name, (a, b) in hypothesis_groups().items()]
    e = met.select("delay_minutes", "weight", F.explode(F.array(*entries)).alias("e"))
    return e.select("e.test", "e.side", "delay_minutes", "weight").filter(F.col("side").isNotNull())


def hypothesis_tests(fact_flights: DataFrame, fact_weather: DataFrame, with_p: bool = True) -> DataFrame:
    """Mann–Whitney U, p-value and effect size for each comparison."""
    return mann_whitney_grouped(weighted_samples(fact_flights, fact_weather), "delay_minutes", with_p=with_p, weight="weight")


def group_descriptions(fact_flights: DataFrame, fact_weather: DataFrame) -> DataFrame:
    """describe() of positive delays for both sides of each comparison."""
    s = weighted_samples(fact_flights, fact_weather)
    sample = F.concat(F.col("test"), F.when(F.col("side") == 1, ":yes").otherwise(":no"))
    return describe(s.select(sample.alias("sample"), "delay_minutes", "weight"), "delay_minutes", ["sample"], weight="weight")


def regression_pairs(fact_flights: DataFrame, fact_weather: DataFrame, home: str = HOME_AIRPORT,
                     departures_only: bool = False) -> DataFrame:
    """Home-airport operations with a known delay, left-joined to home
    weather hours (closed bounds for all operations; half-open and inner
    for the departures-only variant)."""
    if departures_only:
        ops = (fact_flights.filter((F.col("flight_direction") == "departure")
                                   & (F.col("airport_departure_iata") == home)
                                   & F.col("departure_delay_minutes").isNotNull())
               .select("flight_key", F.col("scheduled_departure_utc").alias("operation_ts"),
                       F.col("departure_delay_minutes").alias("delay_minutes")))
    else:
        ops = (airport_operations(fact_flights, home).select("flight_key", "operation_ts", "delay_minutes")
               .filter(F.col("delay_minutes").isNotNull()))
    cols = ["weather_time_utc"] + FEATURES
    if departures_only:
        cols += ["wind_category", "precipitation_category", "visibility_category"]
    w = fact_weather.filter(F.col("airport_iata") == home).select(*cols)
    return interval_join(ops, w, "operation_ts", "weather_time_utc", WINDOW_SECONDS, WINDOW_SECONDS,
                         closed="left" if departures_only else "both",
                         how="inner" if departures_only else "left")


def regression_frame(fact_flights: DataFrame, fact_weather: DataFrame, home: str = HOME_AIRPORT,
                     departures_only: bool = False, drop_incomplete: bool = True) -> DataFrame:
    """One row per flight: the nearest weather hour (ties → earlier hour),
    rows with any NULL dropped, ``delay_flag`` = delay > 10 min; the
    departures variant also drops delays below −120 min."""
    pairs = regression_pairs(fact_flights, fact_weather, home, departures_only)
    one = nearest_match(pairs, "flight_key", "operation_ts", "weather_time_utc")
    if drop_incomplete:
        one = one.na.drop()
    one = one.withColumn("delay_flag", (F.col("delay_minutes") > DELAY_FLAG_MINUTES).cast("int"))
    if departures_only:
        one = one.filter(F.col("delay_minutes") >= OUTLIER_MIN_DELAY)
    return one


def delay_classifier(frame: DataFrame, features: list[str] | None = None, C: float = 1.0) -> DataFrame:
    """Split 80/20 on the flight key → standardise on train → L2 logistic
    regression → metrics and ranked coefficients (one DataFrame: section,
    name, value).

    The frame is written once; both sides are reduced to (features, label,
    rows): flights of one weather hour have equal features, so the fit's
    steps read a few rows per hour, not the flights."""
    from aerocast.operators.ml import (
        classification_metrics, coefficient_table, exact_split, fit_logistic, standard_params, standardized,
    )
    feats = features or FEATURES
    frame = materialize(frame.select("flight_key", "delay_flag", *feats))
    train, test = exact_split(frame, "flight_key")
    params = standard_params(train, feats)
    train, test = (standardized(side.groupBy("delay_flag", *feats).agg(F.count(F.lit(1)).alias("rows")), params) for side in (train, test))
    zcols = [f + "_z" for f in feats]
    train = materialize(train.select("delay_flag", "rows", *zcols))
    model = fit_logistic(train, zcols, "delay_flag", C=C, weight="rows")
    metrics = classification_metrics(model.predict(test), "delay_flag", weight="rows")
    coefs = coefficient_table(model, feats)
    rows = [("coefficient", f, v) for f, v in coefs] + [("intercept", "intercept", model.intercept)]
    rows = [(s, n, round(v, 6) + 0.0) for s, n, v in rows]
    rows += [("coefficient_rank", f, float(i + 1)) for i, (f, _) in enumerate(coefs)]
    rows.append(("gradient", "max_abs_per_row", round(model.residual, 9) + 0.0))
    coef_df = frame.sparkSession.createDataFrame(rows, "section string, name string, value double")
    m = metrics.select(F.col("metric").alias("section"), F.col("label").alias("name"), F.round("value", 9).alias("value"))
    return coef_df.unionByName(m)
