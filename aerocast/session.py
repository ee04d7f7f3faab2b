"""Session construction and shared-storage helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: times are UTC by convention (naive
# timestamps hold UTC wall clock), AQE re-plans joins/aggregations at
# runtime and splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.scheduler.mode": "FAIR",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "aerocast", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses ``spark.checkpoint.dir`` of the session (the cluster names a
    shared, fault-tolerant location there), else the context's checkpoint
    folder.  Only when neither is set — as in local tests — a scratch
    folder is created and registered as the checkpoint folder.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001
            d = None
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="aerocast-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    base = shared_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Reliable lineage cut for a small intermediate that several later
    steps read: ``checkpoint()`` into the shared checkpoint folder (never
    ``localCheckpoint``, which dies with its executor)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df):
    """A wide intermediate that several later steps read, as compressed
    columns in the shared folder (a checkpoint holds its rows uncompressed):
    (its rows, its folder)."""
    path = scratch_path(df.sparkSession, "staged")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files of jobs that are over are removed once the driver has
    collected their plans, which may be long after: have it collect them now,
    so that the disk holds the files of one step and not of all so far."""
    gc.collect()
    spark._jvm.System.gc()


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict:
    """Settings for a large cluster run, sized from the input volume.

    The initial shuffle width gives ~``target_partition_mb`` per partition
    of the largest input (AQE then coalesces small ones and splits skewed
    ones); scans split files into partitions of the same size.  For 100 TB
    on 1,000 executors × 8 cores this is ≈ 400k initial shuffle partitions,
    coalesced by AQE to what each stage actually carries.
    """
    mb = 1024 * 1024
    parts = max(total_cores * 3, int(input_bytes / (target_partition_mb * mb)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{target_partition_mb * 2}m",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per context,
    for clusters (and working directories) where it is not installed."""
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_aerocast_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="aerocast-py-"), "aerocast.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._aerocast_shipped = True
