"""Session helpers: building a session for local runs and finding the shared
checkpoint folder.

On a cluster the session comes from the submitter and ``spark.checkpoint.dir``
names a shared folder; everything that cuts lineage or keeps streaming state
lives below it. Only when the setting is missing (local tests) do we create a
scratch folder and set it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SCRATCH_CONF = "spark.logsift.scratchDir"

# Settings for local runs. On a cluster these come from spark-submit.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on proven sizes: no broadcast from static estimates
    # (which do not see row expansion); adaptive execution still broadcasts
    # a side whose materialised size is small, and our own broadcasts are
    # behind row-count checks.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "logsift") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and written tables.

    Read from ``spark.checkpoint.dir``; set a scratch folder only if unset.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # remote session
        pass
    if not root and sc is not None:
        root = sc.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        # Unset (local runs only). The core setting cannot change once the
        # context runs, so the scratch folder is kept under our own key.
        root = spark.conf.get(SCRATCH_CONF, None)
        if not root:
            if sc is None or not sc.master.startswith("local["):
                raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="logsift-ckpt-")
            spark.conf.set(SCRATCH_CONF, root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, *parts, uuid.uuid4().hex)
