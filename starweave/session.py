"""Session construction and shared-storage scratch locations.

Library code never picks a machine-local folder on its own: scratch output
(write-and-read-back, checkpoints, new versions of loaded tables) lives under
the directory the cluster names in ``spark.checkpoint.dir``. Only when that is
unset (tests, a laptop) do we create one under the local temp folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job here relies on. All of them are session
# settings, so they can be applied to a session somebody else built.
RUNTIME_CONF = {
    # Timestamps are rendered, truncated and split in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: runtime broadcast conversion from measured shuffle
    # sizes, partition coalescing and skew-join splitting of hot keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # A side is broadcast only below a size bound; everything larger takes a
    # shuffled (sort-merge) join. The planning-time bound is kept at Spark's
    # 10MB because it is checked against compressed file sizes, which
    # understate the in-memory size; the runtime bound applies to sizes AQE
    # has measured on the materialised shuffle output.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def use_utc(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "starweave",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with UTC, AQE and the UI off.

    ``shuffle_partitions`` should be sized so one partition of the largest
    shuffle fits an executor core's memory at the target scale (about
    128-256 MB each); AQE coalesces it down for small inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **RUNTIME_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return use_utc(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a ``local`` master without one (tests, a
    laptop) gets a fresh folder under the local temp directory; elsewhere
    each executor would write to its own disk, so an unset folder is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="starweave-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/starweave/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables whose last reader is done. Paths outside the scratch folder are an error."""
    root = f"{checkpoint_root(spark)}/starweave/"
    for name in paths:
        if not name.startswith(root):
            raise ValueError(f"{name} is not a scratch table")
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
