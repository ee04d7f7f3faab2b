"""Flight and weather inputs derived from the driver's tables.

The verification tables hold no flights or weather, so every model is
exercised on deterministic analogues computed *by Spark from the given
tables* (their size grows with the tables):

* flights  ← ``events``: one flight version per event; direction, feed
  (API / history file), airline, airports and half-hour scheduled slot
  from event columns; delay = ``value − 30`` minutes (unknown for
  ``error`` events).  Repeated (airline, number, slot, airports,
  direction) give real duplicate versions for the dedupe.
* weather  ← ``events`` grouped by (airport, hour): two feeds (API from
  even event ids, history from all) so the same hour arrives twice.
* FIDS payload batches ← ``orders`` ⋈ ``lineitem`` (see ``payloads``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerocast.functions import weather_description
from aerocast.functions.categories import WEATHER_CODES
from aerocast.plans.core import SOURCE_RANK, WEATHER_SOURCE_RANK


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trunc_ntz(unit: str, c: Column) -> Column:
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def add_micros(ts: Column, micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, ts)


# Fixed analogue mappings (also spelled out in the oracle SQL).
HOME_PORTS = ["HKT", "BKK", "DMK"]                     # by user_id % 3
OTHER_PORT = {"view": "SVO", "click": "BKK", "purchase": "DMK", "signup": "CNX"}  # error → NULL
FLIGHT_MINUTES = 90


def _pick(arr: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in arr]), (idx + 1).cast("int"))


def flight_versions(events: DataFrame) -> DataFrame:
    """All flight versions in the fact input schema (+ tie columns)."""
    e = events
    is_dep = (F.col("event_id") % 2) == 0
    feed = F.when((F.col("event_id") % 3) == 0, "parquet").otherwise("api")
    board = _pick(HOME_PORTS, F.col("user_id") % 3)
    other = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in OTHER_PORT.items()])
    slot = add_micros(trunc_ntz("HOUR", F.col("ts")),
                      (F.floor(F.minute("ts") / 30) * 30 * 60_000_000).cast("bigint"))
    delay_us = ((F.round(F.col("value") * 100).cast("bigint") - 3000) * 600_000)
    delay_us = F.when(F.col("event_type") != "error", delay_us)
    leg_us = F.lit(FLIGHT_MINUTES * 60_000_000)
    sched_dep = F.when(is_dep, slot).otherwise(
        F.when((F.col("event_id") % 7) != 0, add_micros(slot, -leg_us)))
    sched_arr = F.when(is_dep, add_micros(slot, leg_us)).otherwise(slot)
    act_dep = add_micros(sched_dep, delay_us)
    act_arr = F.when(is_dep & ((F.col("event_id") % 5) == 0), F.lit(None).cast("timestamp_ntz")) \
        .otherwise(add_micros(sched_arr, delay_us))
    airline = F.upper(F.substring("event_type", 1, 2))
    return e.select(
        F.concat(airline, F.lit(" "), (F.col("user_id") % 20).cast("string")).alias("flight_number"),
        F.concat(F.upper(F.substring("event_type", 1, 3)), F.col("event_id").cast("string")).alias("call_sign"),
        F.when(F.col("event_type") == "error", "Canceled")
         .when(F.col("value") > 45, "Delayed").otherwise("Expected").alias("flight_status"),
        ((F.col("user_id") % 10) == 0).alias("is_cargo"),
        F.when(is_dep, "departure").otherwise("arrival").alias("flight_direction"),
        airline.alias("airline_iata"),
        F.upper(F.substring("event_type", 1, 3)).alias("airline_icao"),
        F.concat(F.lit("Model-"), (F.col("user_id") % 7).cast("string")).alias("aircraft_model"),
        F.concat(F.lit("RA-"), F.col("user_id").cast("string")).alias("aircraft_registration"),
        F.when(is_dep, board).otherwise(other).alias("airport_departure_iata"),
        F.when(is_dep, other).otherwise(board).alias("airport_arrival_iata"),
        sched_dep.alias("scheduled_departure_utc"), act_dep.alias("actual_departure_utc"),
        sched_arr.alias("scheduled_arrival_utc"), act_arr.alias("actual_arrival_utc"),
        F.when(feed == "api", SOURCE_RANK["api"]).otherwise(SOURCE_RANK["parquet"]).alias("source_rank"),
        F.when(feed == "api", add_micros(F.col("ts"), F.lit(86_400_000_000)))
         .otherwise(F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")).alias("loaded_at"),
        feed.alias("_feed"),
    )


def flight_inputs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The four fact inputs: API arrivals, history arrivals, API
    departures, history departures."""
    v = flight_versions(table(spark, sf_dir, "events"))
    out = []
    for direction in ("arrival", "departure"):
        for feed in ("api", "parquet"):
            out.append(v.filter((F.col("flight_direction") == direction) & (F.col("_feed") == feed))
                       .drop("_feed"))
    return out


WEATHER_CODE_LIST = list(WEATHER_CODES)  # 28 codes in code order


def hourly_weather(events: DataFrame, source: str, loaded_at: str) -> DataFrame:
    """Staged-weather rows (one per airport × hour) aggregated from events."""
    cnt = F.count(F.lit(1))
    n_err = F.count(F.when(F.col("event_type") == "error", 1))
    n_buy = F.count(F.when(F.col("event_type") == "purchase", 1))
    su = F.sum("user_id")
    g = (events
         .groupBy(_pick(HOME_PORTS, F.col("user_id") % 3).alias("airport_iata"),
                  trunc_ntz("HOUR", F.col("ts")).alias("weather_time_utc"))
         .agg((F.lit(15.0) + cnt).alias("temperature_2m_c"),
              (F.lit(17.0) + cnt).alias("apparent_temperature_c"),
              (F.lit(5.0) + cnt).alias("dewpoint_2m_c"),
              (F.lit(40.0) + su % 60).cast("double").alias("relative_humidity_2m_pct"),
              (n_err * F.lit(1.25)).alias("precipitation_mm"),
              (n_buy * F.lit(1.25)).alias("rain_mm"),
              F.lit(0.0).alias("snowfall_cm"),
              (su % 101).cast("int").alias("cloudcover_pct"),
              (F.min("value") * F.lit(1000.0)).alias("visibility_m"),
              (F.max("value") / F.lit(10.0)).alias("windspeed_10m_ms"),
              (F.sum("event_id") % 360).cast("int").alias("winddirection_10m_deg"),
              F.element_at(F.array(*[F.lit(c) for c in WEATHER_CODE_LIST]),
                           (su % 28 + 1).cast("int")).alias("weathercode")))
    rest = [c for c in g.columns if c not in ("airport_iata", "weather_time_utc")]
    return g.select(
        F.lit(source).alias("source"), "airport_iata",
        F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"), "weather_time_utc",
        *rest, weather_description(F.col("weathercode")).alias("weather_description"),
        F.lit(WEATHER_SOURCE_RANK.get(source, 0)).alias("source_rank"),
    )


def weather_inputs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    ev = table(spark, sf_dir, "events")
    api = hourly_weather(ev.filter((F.col("event_id") % 2) == 0), "open-meteo", "2024-02-01 00:00:00")
    hist = hourly_weather(ev, "history", "2024-01-31 00:00:00")
    return [api, hist]


# ---- raw payload batches -------------------------------------------------

OTHER_AIRPORTS = ["SVO", "BKK", "DMK", "CNX", "KUL"]   # by l_suppkey % 5
FLIGHT_MONTH_START = "2024-01-01 00:00:00"             # same month as the weather analogue
BATCH_SIZE = 8   # flights per payload page: keeps every collect_list bounded


# A flight's times are whole minutes from the month's start on.  The texts of
# the days about it and of a day's minutes are kept, other days are formatted.
DAY_MINUTES = 1440
KNOWN_DAYS = (-31, 93)                                 # of those kept, from the month's start on
UTC_OFFSET = 7 * 60                                    # local time of the boards


def _constant_list(texts: list[str]) -> Column:
    return F.split(F.lit(",".join(texts)), ",")


def _time_json(at: Column) -> Column:
    """A UTC and a local time as a JSON object, empty without a time; ``at``
    counts minutes from the first day kept."""
    first = dt.datetime.fromisoformat(FLIGHT_MONTH_START)
    days = _constant_list([(first + dt.timedelta(days=d)).strftime("%Y-%m-%d ") for d in range(*KNOWN_DAYS)])
    times = _constant_list([f"{m // 60:02d}:{m % 60:02d}" for m in range(DAY_MINUTES)])

    def kept(m: Column) -> list[Column]:       # NULL outside the lists: before them the minute or the day is negative
        return [F.get(days, F.call_function("div", m, F.lit(DAY_MINUTES)).cast("int")), F.get(times, (m % DAY_MINUTES).cast("int"))]

    def formatted(m: Column) -> list[Column]:
        t = add_micros(F.lit(FLIGHT_MONTH_START).cast("timestamp_ntz"), (m + KNOWN_DAYS[0] * DAY_MINUTES) * 60_000_000)
        return [F.date_format(t, "yyyy-MM-dd HH:mm")]

    def pair(text) -> Column:
        return F.concat(F.lit('{"utc":"'), *text(at), F.lit('Z","local":"'), *text(at + UTC_OFFSET), F.lit('+07:00"}'))
    return F.coalesce(pair(kept), pair(formatted), F.lit("{}"))


def _text_json(c: Column) -> Column:
    """A text as JSON; only what may need an escape goes through the writer."""
    written = F.to_json(F.struct(c.alias("v")))
    return (F.when(c.rlike(r"\A[ !#-\[\]-~]*\z"), F.concat(F.lit('"'), c, F.lit('"')))
            .when(c.isNotNull(), F.substring(written, F.lit(6), F.length(written) - 6)))          # of {"v":…}


def _member(name: str, value: Column) -> Column:
    """A member and the comma behind it; nothing where the value is NULL, as
    ``to_json`` leaves it out."""
    return F.coalesce(F.concat(F.lit(f'"{name}":'), value, F.lit(",")), F.lit(""))


def _timed(x: Column) -> Column:
    """A line with the minutes of its scheduled and its revised time, counted
    from the first day kept."""
    # scheduled time inside the weather month: day-of-year of the ship
    # date modulo 30, plus line-number hours and 15-minute steps
    base = (((F.dayofyear(x["l_shipdate"]) - 1) % 30 - KNOWN_DAYS[0]).cast("bigint") * DAY_MINUTES
            + x["l_linenumber"].cast("bigint") * 60 + (x["l_partkey"] % 4) * 15)
    return F.struct(x.alias("x"), base.alias("base"), (base + x["l_quantity"].cast("int").cast("bigint")).alias("revised"))


def _board_element(line: Column, is_arr: bool) -> Column:
    """A board's flight, as JSON text, made from the numbers of one line
    that has a part.  Written as text piece by piece: structs of the same
    members, made and turned to JSON line by line, took most of the time."""
    x = line["x"]
    suppkey = x["l_suppkey"]
    other_airport = _pick([f'{{"iata":"{a}","icao":"X{a}","name":"Airport {a}","timeZone":"Asia/Bangkok"}}' for a in OTHER_AIRPORTS],
                          F.coalesce(suppkey % 5, F.lit(4)))             # no supplier: the last
    terminal = F.concat(F.lit('"T'), (x["l_linenumber"] % 3).cast("string"), F.lit('"'))
    other_terminal = F.concat(F.lit('"D'), (suppkey % 4).cast("string"), F.lit('"'))
    # the board airport's own leg has no airport object, the other end no
    # revised time
    own_leg = F.concat(F.lit("{"), _member("terminal", terminal), F.lit('"scheduledTime":'), _time_json(line["base"]),
                       F.when(x["l_discount"] > 0, F.concat(F.lit(',"revisedTime":'), _time_json(line["revised"]))).otherwise(F.lit("")),
                       F.lit("}"))
    other_time = line["base"] - 120 if is_arr else line["base"] + 120
    other_leg = F.concat(F.lit("{"), _member("terminal", other_terminal), F.lit('"airport":'), other_airport,
                         F.lit(',"scheduledTime":'), _time_json(other_time), F.lit("}"))
    sk, part = (suppkey % 10).cast("string"), x["l_partkey"].cast("string")
    airline = F.coalesce(F.concat(F.lit('{"iata":"S'), sk, F.lit('","icao":"SUP'), sk, F.lit('","name":"Supplier '),
                                  suppkey.cast("string"), F.lit('"}')), F.lit("{}"))
    aircraft = F.when(x["l_tax"] > 0, F.concat(F.lit('{"reg":"R'), part, F.lit('","modeS":"M'), (x["l_partkey"] % 997).cast("string"),
                                               F.lit('","model":"Model-'), (x["l_partkey"] % 5).cast("string"), F.lit('"}')))
    return F.concat(
        F.lit('{"number":"L'), part, F.lit('",'),
        _member("status", _text_json(x["l_returnflag"])),
        _member("callSign", F.concat(F.lit('"C'), F.col("l_orderkey").cast("string"), F.lit("-"), x["l_linenumber"].cast("string"), F.lit('"'))),
        _member("codeshareStatus", _text_json(x["l_linestatus"])),
        _member("isCargo", (x["l_quantity"] > 25).cast("string")),
        F.lit('"airline":'), airline, F.lit(","), _member("aircraft", aircraft),
        F.lit('"arrival":'), own_leg if is_arr else other_leg,
        F.lit(',"departure":'), other_leg if is_arr else own_leg, F.lit("}"))


def fids_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fids_batches_with_order(spark, sf_dir).drop("_ok")


def fids_batches_with_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight-board batches in the raw API-table layout: one payload page
    per (order, chunk of ≤ 8 lines) with ``arrivals`` (even part keys) and
    ``departures`` (odd); every 10th order answers ``{"flights":[]}`` and
    the next one ``{"arrivals":null, …}``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice")
    from pyspark.sql import Window
    # a page's lines as numbers, picked up by its first line behind one sort;
    # the wide elements are made from them last, so that none is moved or sorted
    li = li.select("l_orderkey", F.struct(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").alias("_line"))
    w = Window.partitionBy("l_orderkey").orderBy("_line")
    page = li.select("l_orderkey", F.row_number().over(w).alias("_n"),
                     F.array("_line", *[F.lead("_line", i).over(w) for i in range(1, BATCH_SIZE)]).alias("_lines"))
    page = page.filter(F.col("_n") % BATCH_SIZE == 1).select("l_orderkey", F.array_compact("_lines").alias("_lines"))
    # equal order rows share a page, which then has each line once for each of them
    o = o.repartition("o_orderkey").groupBy("o_orderkey", "o_custkey", "o_orderdate").agg(F.count(F.lit(1)).cast("int").alias("_same"))
    pages = page.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    every = F.when(F.col("_same") == 1, F.col("_lines")).otherwise(
        F.flatten(F.transform("_lines", lambda x: F.array_repeat(x, F.col("_same")))))
    def board(odd: bool) -> Column:
        lines = F.filter(every, lambda x: (x["l_partkey"] % 2 != 0) if odd else (x["l_partkey"] % 2 == 0))
        return F.array_join(F.transform(F.transform(lines, _timed), lambda x: _board_element(x, not odd)), ",")
    ok10 = F.col("o_orderkey") % 10
    payload = (F.when(ok10 == 0, F.lit('{"flights":[]}'))
               .otherwise(F.concat(F.lit('{"arrivals":'), F.when(ok10 == 1, F.lit("null")).otherwise(F.concat(F.lit("["), board(False), F.lit("]"))),
                                   F.lit(',"departures":['), board(True), F.lit("]}"))))
    start = add_micros(F.col("o_orderdate"), ((F.col("o_orderkey") % 720) * 60_000_000).cast("bigint"))
    # loaded in the month the flights fly: day-of-year of the order date mod 30, plus one day
    extracted = add_micros(F.lit(FLIGHT_MONTH_START).cast("timestamp_ntz"),
                           ((F.dayofyear("o_orderdate") - 1) % 30 + 1).cast("bigint") * 86_400_000_000)
    return pages.select(
        F.lit("aerodatabox").alias("source"),
        _pick(HOME_PORTS, F.col("o_custkey") % 3).alias("airport_code"),
        F.lit("IATA").alias("code_type"),
        F.date_format(start, "yyyy-MM-dd'T'HH:mm").alias("from_local"),
        F.date_format(start + F.expr("INTERVAL 12 HOURS"), "yyyy-MM-dd'T'HH:mm").alias("to_local"),
        F.lit("Both").alias("direction"),
        extracted.alias("extracted_at"),
        payload.alias("payload"),
        F.col("o_orderkey").alias("_ok"),
    )


PAYLOAD_VARIABLES = [  # analogue column → API variable carried in day payloads
    ("temperature_2m_c", "temperature_2m"), ("apparent_temperature_c", "apparent_temperature"),
    ("dewpoint_2m_c", "dewpoint_2m"), ("relative_humidity_2m_pct", "relativehumidity_2m"),
    ("precipitation_mm", "precipitation"), ("rain_mm", "rain"), ("snowfall_cm", "snowfall"),
    ("cloudcover_pct", "cloudcover"), ("visibility_m", "visibility"),
    ("windspeed_10m_ms", "windspeed_10m"), ("winddirection_10m_deg", "winddirection_10m"),
    ("weathercode", "weathercode"),
]


def weather_day_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(airport, day) → hourly parallel-array payload text (≤ 24 hours per
    group); days with day-of-month divisible by 5 omit the visibility
    array.  Columns: airport_iata, day, payload."""
    hours = hourly_weather(table(spark, sf_dir, "events"), "history", "2024-01-31 00:00:00")
    cols = ["weather_time_utc"] + [c for c, _ in PAYLOAD_VARIABLES]
    g = (hours.groupBy("airport_iata", F.to_date("weather_time_utc").alias("day"))
         .agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("h")))
    arrays = [F.transform("h", lambda x: F.date_format(x["weather_time_utc"], "yyyy-MM-dd'T'HH:mm")).alias("time")]
    def field(name):
        return lambda x: x[name].cast("double")
    for c, v in PAYLOAD_VARIABLES:
        arr = F.transform("h", field(c))
        if v == "visibility":
            arr = F.when(F.dayofmonth("day") % 5 != 0, arr)
        arrays.append(arr.alias(v))
    return g.select("airport_iata", "day", F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("payload"))


AIRPORT_COORDS = {"HKT": (8.1132, 98.3169), "BKK": (13.69, 100.7501), "DMK": (13.9126, 100.6068)}


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather API table: one payload per airport-day."""
    p = weather_day_payloads(spark, sf_dir)
    lat = F.coalesce(*[F.when(F.col("airport_iata") == k, F.lit(v[0])) for k, v in AIRPORT_COORDS.items()])
    lon = F.coalesce(*[F.when(F.col("airport_iata") == k, F.lit(v[1])) for k, v in AIRPORT_COORDS.items()])
    return p.select(F.lit("open-meteo").alias("source"), "airport_iata", lat.alias("latitude"),
                    lon.alias("longitude"), F.col("day").alias("start_date"), F.col("day").alias("end_date"),
                    (F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("loaded_at"),
                    "payload")


def weather_history_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw history documents: one per (airport, ISO week) holding a list of
    day records; even days embed the payload as an object, odd days as
    JSON text."""
    p = weather_day_payloads(spark, sf_dir)
    as_text = F.to_json(F.struct(F.lit("history").alias("source"), F.col("airport_iata"),
                                 F.col("payload")))
    as_obj = F.concat(F.lit('{"source":"history","airport_iata":"'), F.col("airport_iata"),
                      F.lit('","payload":'), F.col("payload"), F.lit("}"))
    rec = F.when(F.dayofmonth("day") % 2 == 0, as_obj).otherwise(as_text)
    g = (p.groupBy("airport_iata", F.year("day").alias("y"), F.weekofyear("day").alias("wk"))
         .agg(F.sort_array(F.collect_list(rec)).alias("recs")))
    return g.select(F.concat(F.lit("["), F.array_join("recs", ","), F.lit("]")).alias("weather_data"),
                    F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("_load_dt"),
                    F.concat_ws("-", "airport_iata", "y", "wk").alias("_batch_id"))


# ---- raw reference files with dirty text ---------------------------------

LOAD_DT = "2024-03-01 00:00:00"


def _money_text(c: Column) -> Column:
    """2-decimal double → its decimal text, built from integer cents."""
    cents = F.round(c * 100).cast("bigint")
    a = F.abs(cents)
    return F.concat(F.when(cents < 0, "-").otherwise(""), (a / 100).cast("bigint").cast("string"),
                    F.lit("."), F.lpad((a % 100).cast("string"), 2, "0"))


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports file analogue from ``customer`` ⋈ ``nation`` with null
    tokens, blanks, padding, lower-case codes and malformed numbers."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    code3 = F.concat(F.substring("c_mktsegment", 1, 1), F.lpad((k % 100).cast("string"), 2, "0"))
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.when(k % 11 == 0, "\\N").when(k % 11 == 1, "  ")
         .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).alias("Name"),
        F.when(k % 13 == 0, "").otherwise(F.col("c_mktsegment")).alias("City"),
        F.when(k % 17 == 0, "\\N").otherwise(F.col("n_name")).alias("Country"),
        F.when(k % 7 == 0, "\\N").when(k % 19 == 0, " ")
         .when(k % 2 == 0, F.lower(code3)).otherwise(F.concat(F.lit(" "), code3)).alias("IATA"),
        F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("V"), code3)).alias("ICAO"),
        F.when(k % 23 == 0, "n/a").when(k % 29 == 0, F.concat((k % 90).cast("string"), F.lit(".")))
         .otherwise(_money_text(F.col("c_acctbal") / 100)).alias("Latitude"),
        F.concat(F.lit(" "), (k % 180).cast("string"), F.lit(" ")).alias("Longitude"),
        F.when(k % 31 == 0, "\\N").otherwise((F.col("c_nationkey") * 10).cast("string")).alias("Altitude"),
        (F.col("c_nationkey") % 12).cast("string").alias("Timezone"),
        F.when(k % 3 == 0, "\\N").otherwise(F.concat(F.lit("Asia/Zone"), F.col("c_nationkey").cast("string"))).alias("Timezone_1"),
        F.lit(LOAD_DT).cast("timestamp_ntz").alias("_load_dt"),
    )


ACTIVE_WORDS = ["Y", "N", "yes", " 1 ", "maybe", "-", "FALSE"]   # by s_suppkey % 7


def raw_airlines(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """Airlines file analogue from ``supplier`` ⋈ ``nation``.  ``version=2``
    is a later delivery: ids % 7 == 0 vanish and return renamed (new keys),
    ids % 5 == 0 change call sign, ids % 9 == 0 flip the active flag."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    name = F.when(k % 13 == 0, "-").otherwise(F.col("s_name"))
    callsign = F.concat(F.lit("CALL"), (k % 50).cast("string"))
    active = _pick(ACTIVE_WORDS, k % 7)
    if version == 2:
        name = F.when(k % 7 == 0, F.concat(F.col("s_name"), F.lit(" NEW"))).otherwise(name)
        callsign = F.when(k % 5 == 0, F.concat(callsign, F.lit("X"))).otherwise(callsign)
        active = F.when(k % 9 == 0, F.when(active == "Y", "N").otherwise("Y")).otherwise(active)
    j = s.join(n, s.s_nationkey == n.n_nationkey, "left")
    return j.select(
        name.alias("Name"),
        F.when(k % 4 == 0, " - ").otherwise(F.concat(F.lit("A"), (k % 26).cast("string"))).alias("IATA"),
        F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("AL"), (k % 100).cast("string"))).alias("ICAO"),
        F.when(k % 8 == 0, "-").otherwise(callsign).alias("Callsign"),
        F.col("n_name").alias("Country"),
        active.alias("Active"),
        F.lit(LOAD_DT).cast("timestamp_ntz").alias("_load_dt"),
    )


def raw_aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aircraft reference analogue from ``part``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        F.when(k % 9 == 0, "\\N").otherwise(F.col("p_type")).alias("aircraft_type"),
        F.when(k % 10 == 0, " ").otherwise(F.col("p_brand")).alias("manufacturer"),
        F.col("p_size").alias("seats"),
        F.floor(F.col("p_retailprice")).cast("int").alias("range_km"),
        F.when(k % 4 == 0, "\\N").otherwise(F.col("p_name")).alias("category"),
        F.lit(LOAD_DT).cast("timestamp_ntz").alias("_load_dt"),
    )
