from conftest import SF

from aerocast.plans.build import monthly_build
from aerocast.session import cluster_conf


def test_rebuild_is_idempotent(spark, tmp):
    """A second monthly build over the same data merges into the existing
    facts (partition-wise) and re-runs the snapshot: nothing is duplicated,
    no new snapshot versions appear, and all 87 tests run."""
    base = f"{tmp}/build"
    first, tests = monthly_build(spark, SF, base)
    second, tests2 = monthly_build(spark, SF, base)
    for m in ("fact_flights", "fact_weather", "snp_airlines", "mart_weather_flight_impact"):
        assert second.rows[m] == first.rows[m] > 0, m
    assert tests2.count() == 87
    failing = {r.test_name for r in tests2.filter("failures > 0").collect()}
    assert "fact_flights.unique.flight_key" not in failing and "fact_weather.unique.weather_key" not in failing


def test_cluster_conf_sizes_from_input():
    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(1024, 8)["spark.sql.shuffle.partitions"] == "24"
