"""Session settings and the shared lake root.

Every job pins the session time zone to UTC (the payload instants are
UTC and outputs are compared as wall-clock UTC) and keeps ANSI mode on so
bad casts fail loudly, as the warehouse does.  AQE stays on: it coalesces
small shuffle partitions, splits skewed ones and turns a join into a
broadcast join only after it has *measured* the small side at runtime.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every job in this package relies on.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # timestamps as micros: INT96 has no statistics that a reader could skip by
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # landing objects are many small JSON documents: pack them into tasks
    "spark.sql.files.openCostInBytes": str(1 << 20),
    # a raw document is read back whole: split into typed columns, each of its values costs at the write and at every read
    "spark.sql.variant.writeShredding.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this package depends on (idempotent)."""
    for k, v in JOB_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewater") -> SparkSession:
    """Session for tests and the local bench; on a cluster use the cluster's own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for written tables and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the folder the cluster names); only
    when it is unset on a local master - tests, a laptop - make one and
    register it.  A temporary folder of one machine is no shared folder, so a
    cluster without the setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A deterministic sub-folder of the shared root."""
    return "/".join([shared_root(spark), "tidewater", *parts])


def digest(text: str, n: int = 12) -> str:
    return hashlib.sha1(text.encode()).hexdigest()[:n]
