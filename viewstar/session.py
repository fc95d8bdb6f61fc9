"""Session helpers.

The library never creates a session behind the caller's back in cluster
code; these helpers are for tests, the bench and the command line.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours should carry.  Time zone is pinned so that
# event_date / event_hour do not depend on the JVM default.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # HotSpot leaves methods over 8,000 bytes interpreted: such stages (the
    # cleaning is one) run faster as separate operators, whose code is split.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming dedup state on local disk in RocksDB rather than on the JVM
    # heap; fixed per checkpoint at its first run.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "viewstar", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only when the setting is absent and the master is local (tests) do we
    pick a fresh folder of our own and record it in the session, so later
    calls agree; on a cluster the setting is required.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is not shared by executors.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store)")
        path = tempfile.mkdtemp(prefix="viewstar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path not used before under the shared checkpoint dir, for streaming
    state, staging tables or proofs; Spark creates it on that file system."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
