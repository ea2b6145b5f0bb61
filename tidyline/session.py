"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder (``spark.checkpoint.dir``) for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


# Settings for a large cluster (for example 1,000 executors over ~100 TB).
# Shuffle partitions are set high and AQE coalesces them to ~256 MB each at
# run time; input splits of 256 MB keep scan tasks in memory; skewed
# partitions (a label or word holding a third of the rows) are split by AQE.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
}


def configure_cluster(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings of ``CLUSTER_CONF`` to a session
    (static settings must be given when the cluster session is built)."""
    for k, v in CLUSTER_CONF.items():
        if k != "spark.ui.enabled":
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: str = "*", app: str = "tidyline", **conf) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.  Only when the session names
    none (local tests) is a scratch folder set."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidyline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def sized(df):
    """Write a small derived frame to the shared scratch folder and read it back:
    Spark then knows its bytes and broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold``, else shuffles (AQE splits hot keys)."""
    path = scratch_path(df.sparkSession, "sized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, key: str | None = None):
    """Hash-partition a scan by its key when it has fewer splits than the
    cluster has cores (one-row-group files); at scale the scan already has
    enough splits and this is a no-op, so no extra shuffle is planned."""
    spark = df.sparkSession
    par = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= par:
        return df
    return df.repartition(par, key) if key else df.repartition(par)
