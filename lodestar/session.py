"""Session helpers: building a local session for tests/bench and finding the
shared scratch folder for lineage cuts and table writes.

On a cluster the operator never creates its own scratch space: it reads
``spark.checkpoint.dir`` from the session.  Only when that is unset (tests,
local runs) is a fresh folder made under /tmp and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "lodestar") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Wide projections (41-column typed base) generate methods above the
        # JVM's 8 KB JIT limit; fall back to per-operator codegen instead of
        # running them interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Small local inputs: keep post-shuffle parallelism near the core
        # count (clusters tune advisoryPartitionSizeInBytes instead).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, registering a /tmp one only if
    none is configured (local runs and tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "lodestar", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Cut lineage of a small, reused intermediate (e.g. the weekly series)
    with a reliable checkpoint in the shared checkpoint folder, so later
    stages read it back instead of recomputing it from the fact table."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: for a table of many rows that is read more than once, which this
    packs closer than a checkpoint."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers (once a context), so
    that their functions import it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_lodestar_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "lodestar_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("lodestar", os.path.relpath(full, root)))
    sc.addPyFile(archive)
    sc._lodestar_shipped = True
