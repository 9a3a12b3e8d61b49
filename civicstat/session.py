"""Session construction for local runs and lineage cutting for cluster runs."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast when a side turns out small), coalesces small
# shuffle partitions and splits skewed partitions of inner/semi/anti joins.
# Static broadcast stays size-checked by ``autoBroadcastJoinThreshold``.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "civicstat", cores: int | str = "*",
                shuffle_partitions: int | None = None,
                driver_memory: str = "8g",
                extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (the cluster passes its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(SCALE_CONF)
    conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(
        shuffle_partitions if shuffle_partitions else (8 if cores == "*" else int(cores) * 2))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        # local[...] is one machine; local-cluster[...] has executors that may not share a folder
        return re.match(r"local(\[.*)?$", spark.conf.get("spark.master", "local")) is not None
    except Exception:  # noqa: BLE001 - master not readable (e.g. Connect): treat as cluster
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset (local tests) a fresh scratch folder
    is created and registered.  Works without a SparkContext handle (Spark
    Connect), where the server reads ``spark.checkpoint.dir`` itself.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is unset: on a cluster it must name a shared folder "
                               "(a machine-local scratch folder would not survive a lost executor)")
        configured = tempfile.mkdtemp(prefix="civicstat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # noqa: BLE001 - some deployments reject core confs at runtime
            pass
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where one intermediate frame feeds several later jobs; a lost
    executor then re-reads the checkpoint instead of recomputing the lineage.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
