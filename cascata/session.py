"""Session helpers.

Cluster jobs get their session (and its settings) from the cluster; the
helpers here only fill in what is missing, which in practice means tests
and local benchmarks.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session needs for results to match the SQL oracle and for
# small local runs not to open a web port.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once the DataFrame that wrote them is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cascata", extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a local one when there is none."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming state.

    The cluster names it in ``spark.checkpoint.dir``; only a local-mode
    session (tests, benchmarks) without it gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for checkpoints "
                           "(a machine-local folder is not visible to other executors)")
    local = tempfile.mkdtemp(prefix="cascata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root, deleted when the driver's JVM ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path
