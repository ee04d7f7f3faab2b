"""aerocast — flight-operations and hourly-weather analytics on Spark.

Layers: ``sources`` (scans), ``functions`` (Column-level rules),
``operators`` (DataFrame-level building blocks: JSON explode, interval
join, dedupe, merge, SCD2, quality, statistics, ML), ``plans`` (the
staging → core → marts models and analyses), ``sinks`` (raw loads,
keyed inserts, layered tables) and ``streaming`` (micro-batch ingest).
"""

__version__ = "0.1.0"
