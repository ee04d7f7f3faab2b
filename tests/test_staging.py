import datetime as dt
import json

from aerocast.plans.staging import stage_flights, stage_weather_api, stage_weather_history
from aerocast.schemas import RAW_FLIGHT_BATCH

PAYLOAD = {
    "arrivals": [{"number": "ZQ 4017", "status": "Expected", "airline": {"iata": "ZQ", "icao": "ZQX", "name": "Made-up Air"},
                  "departure": {"airport": {"iata": "QQA", "icao": "QQAA", "name": "Nowhere", "timeZone": "Etc/GMT-5"},
                                "scheduledTime": {"utc": "2025-03-09 04:10Z", "local": "2025-03-09 09:10+05:00"}},
                  "arrival": {"scheduledTime": {"utc": "2025-03-09 06:35Z", "local": "2025-03-09 13:35+07:00"}},
                  "isCargo": False}],
    "departures": [{"number": "QX 88", "status": "Boarding", "airline": {"iata": "QX", "name": "Paper Wings"},
                    "departure": {"scheduledTime": {"utc": "2025-03-09 11:05Z", "local": "2025-03-09 18:05+07:00"},
                                  "airport": {"iata": "QQB"}}}],
}


def _raw(spark, payloads):
    rows = [("aerodatabox", "HKT", "IATA", "2025-03-09T00:00", "2025-03-09T12:00", "Both",
             dt.datetime(2025, 3, 10, 1, 2, 3), p) for p in payloads]
    return spark.createDataFrame(rows, RAW_FLIGHT_BATCH)


def test_board_row(spark):
    raw = _raw(spark, [json.dumps(PAYLOAD)])
    arr = stage_flights(raw, "arrival").collect()
    dep = stage_flights(raw, "departure").collect()
    assert len(arr) == 1 and len(dep) == 1
    a, d = arr[0], dep[0]
    assert (a.flight_number, a.flight_status, a.airline_iata, a.departure_airport_iata) == \
        ("ZQ 4017", "Expected", "ZQ", "QQA")
    assert a.scheduled_arrival_utc == dt.datetime(2025, 3, 9, 6, 35)
    assert a.is_cargo is False and json.loads(a.arrival_payload)["number"] == "ZQ 4017"
    assert (d.flight_number, d.flight_status, d.airline_iata) == ("QX 88", "Boarding", "QX")
    assert d.arrival_airport_iata is None and d.scheduled_departure_utc == dt.datetime(2025, 3, 9, 11, 5)
    assert a.window_from_local is not None and len(a) == 33


def test_edge_payloads_give_no_rows(spark):
    raw = _raw(spark, ['{"flights":[]}', '{"arrivals":[]}', '{"arrivals":null}', '[1,2]', '"x"', 'not json',
                       '{"arrivals":[{"number":"X1"}]}'])
    arr = stage_flights(raw, "arrival").collect()
    assert [r.flight_number for r in arr] == ["X1"]
    assert arr[0].airline_iata is None and arr[0].scheduled_arrival_utc is None
    assert stage_flights(raw, "departure").count() == 0


def _wraw(spark, payloads):
    rows = [("open-meteo", "HKT", dt.datetime(2026, 8, 30), p) for p in payloads]
    return spark.createDataFrame(rows, "source string, airport_iata string, loaded_at timestamp_ntz, payload string")


def test_weather_sample_and_edges(spark):
    sample = '{"hourly":{"time":["2026-08-29T00:00"],"temperature_2m":[25.0]}}'
    rows = stage_weather_api(_wraw(spark, [sample])).collect()
    assert len(rows) == 1 and rows[0].temperature_2m_c == 25.0
    assert rows[0].weather_time_utc == dt.datetime(2026, 8, 29, 0, 0)
    assert rows[0].cloudcover_pct is None and rows[0].weather_description == "Unknown"
    uneven = '{"hourly":{"time":["2026-08-29T00:00","2026-08-29T01:00"],"temperature_2m":[25.0],' \
             '"relativehumidity_2m":[85, 85.0],"weathercode":[95, null]}}'
    r = stage_weather_api(_wraw(spark, [uneven])).orderBy("weather_time_utc").collect()
    assert [x.temperature_2m_c for x in r] == [25.0, None]
    assert [x.relative_humidity_2m_pct for x in r] == [85.0, 85.0]
    assert [x.weathercode for x in r] == [95, None] and r[0].weather_description == "Thunderstorm"
    empty = stage_weather_api(_wraw(spark, ['{"hourly":{}}', '{"daily":{}}', '{}'])).count()
    assert empty == 0


def test_weather_history_object_and_text_payloads(spark):
    p = {"hourly": {"time": ["2026-08-29T00:00"], "temperature_2m": [30.5]}}
    doc = json.dumps([{"source": "h", "airport_iata": "HKT", "payload": p},
                      {"source": "h", "airport_iata": "BKK", "payload": json.dumps(p)}])
    raw = spark.createDataFrame([(doc, dt.datetime(2026, 9, 1), "b1")],
                                "weather_data string, _load_dt timestamp_ntz, _batch_id string")
    rows = stage_weather_history(raw).orderBy("airport_iata").collect()
    assert [(r.airport_iata, r.temperature_2m_c) for r in rows] == [("BKK", 30.5), ("HKT", 30.5)]


def test_seed_csv_source_switch(spark, tmp):
    import csv
    from aerocast.sources.files import raw_flight_source
    path = f"{tmp}/seed.csv"
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["source", "airport_code", "code_type", "from_local", "to_local", "direction", "extracted_at",
                    "payload"])
        w.writerow(["aerodatabox", "HKT", "IATA", "2025-03-09T00:00", "2025-03-09T12:00", "Both",
                    "2025-03-10 04:05:06.789 +0500", json.dumps(PAYLOAD)])
    raw = raw_flight_source(spark, "ci", raw_path="unused", seed_path=path)
    assert raw.first().extracted_at == dt.datetime(2025, 3, 10, 4, 5, 6, 789000)
    arr = stage_flights(raw, "arrival").collect()
    dep = stage_flights(raw, "departure").collect()
    assert [r.flight_number for r in arr] == ["ZQ 4017"] and [r.flight_number for r in dep] == ["QX 88"]
    assert arr[0].loaded_at == dt.datetime(2025, 3, 10, 4, 5, 6, 789000)


def test_weather_tz_option(spark):
    sample = '{"hourly":{"time":["2026-08-29T07:00"],"temperature_2m":[25.0]}}'
    raw = _wraw(spark, [sample])
    assert stage_weather_api(raw).first().weather_time_utc == dt.datetime(2026, 8, 29, 7, 0)
    assert stage_weather_api(raw, weather_tz="Asia/Bangkok").first().weather_time_utc == dt.datetime(2026, 8, 29, 0, 0)
