"""Headline benchmark.

1. ``model_build``: the reference's monthly build — raw load, 9 staging
   models, 3 dims, 2 merged facts, the SCD2 snapshot, 2 marts and the 87
   data tests — each model written once and read back downstream (the
   reference's 16-model build is the comparison point).
2. The main analyses on top of the built facts (pairs join, regression
   frame, rank tests, correlation), run from the materialised layer.

``phase.*`` entries give the build's wall clock per phase;
``phase.models_staging_to_marts`` is the part comparable to the
reference's 16-model build (its loads are timed separately there too).

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``; prints one JSON line (per-step seconds in
``queries``; ``value`` = total).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from aerocast.session import build_session, scratch_path
    spark = build_session(f"local[{cpus}]", cpus * 2, app_name="aerocast-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aerocast-bench-"))
    from aerocast.plans import analysis as anl
    from aerocast.plans.build import monthly_build
    from aerocast.operators.stats import correlation_matrix

    # warm-up: one full build on the smallest tables (JIT, Python workers)
    monthly_build(spark, "/root/testdata/sf0.001", scratch_path(spark, "bench-warmup"))

    times = {}
    t0 = time.perf_counter()
    layers, tests = monthly_build(spark, sf_dir, scratch_path(spark, "bench-build"))
    times["model_build"] = round(time.perf_counter() - t0, 3)
    for k, v in layers.phases.items():
        times[f"phase.{k}"] = v
    times["phase.models_staging_to_marts"] = round(sum(layers.phases[k] for k in ("staging", "core", "marts")), 3)
    for k, v in layers.timings.items():
        times[f"model_build.{k}"] = v

    ff = spark.read.parquet(layers.path("core", "fact_flights"))
    fw = spark.read.parquet(layers.path("core", "fact_weather"))

    def run(name, build):
        """Time plan construction (which may materialise intermediates)
        and full execution together."""
        t = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)

    pairs = anl.flight_weather_pairs(ff, fw)
    run("flight_weather_pairs", lambda: pairs)
    run("hypothesis_tests", lambda: anl.hypothesis_tests(ff, fw))
    run("group_descriptions", lambda: anl.group_descriptions(ff, fw))
    run("regression_frame", lambda: anl.regression_frame(ff, fw))
    run("weather_delay_correlation", lambda: correlation_matrix(
        anl.regression_frame(ff, fw, departures_only=True),
        ["temperature_2m_c", "relative_humidity_2m_pct", "precipitation_mm", "visibility_m", "cloudcover_pct",
         "windspeed_10m_ms", "delay_minutes"], scale=6))
    headline = [k for k in times if "." not in k]
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "monthly_build_plus_analyses", "value": round(sum(times[k] for k in headline), 3),
                      "unit": "sec", "queries": times, "rows": layers.rows,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
