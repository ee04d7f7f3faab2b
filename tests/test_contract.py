import __spark_entry__ as ent

from conftest import SF


def test_entry_runs(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "total_operations" in df.columns


def test_every_oracle_has_a_query():
    q, o = ent.queries(), ent.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40
    for name, sql in o.items():
        assert "LIMIT" not in sql.upper().split(), name


def test_queries_build_on_smoke_data(spark):
    q = ent.queries()
    for name in ("fact_flights", "stg_flight_arrivals", "hypothesis_tests"):
        assert q[name](spark, SF).limit(1).count() >= 0
