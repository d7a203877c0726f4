"""Session helpers.

The library never builds its own session inside an operator: every operator
takes DataFrames and returns DataFrames.  These helpers exist for tests, the
bench and the command line, and for the few places that need a shared
checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerflow") -> SparkSession:
    """Local/test session with the settings the library assumes.

    UTC session time zone (oracle parity), AQE with skew-join and partition
    coalescing, UI off, Arrow on for the few pandas hand-offs.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as-is.  Only local runs (tests, bench) get a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: point it at a shared folder of the cluster")
        current = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")  # local runs only (tests, bench)
        spark.conf.set("spark.checkpoint.dir", current)
        spark.sparkContext.setCheckpointDir(current)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
