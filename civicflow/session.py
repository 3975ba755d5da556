"""Session construction and shared-storage locations.

The library never hard-codes a machine-local scratch folder: everything that
must outlive a task (materialized views, lineage cuts, streaming checkpoints)
lives under the shared folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent (unit tests, a laptop) do we pick one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  They are *defaults*: a
# cluster submit that already sets one of them wins.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small shuffles are dealt to all cores; larger ones are merged up to PARTITION_BYTES.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast threshold of our own: a plan of this package holds dozens of
    # joins, and the relations of all broadcasts of a plan are in the driver and in
    # every executor at once.  AQE measures a built side at runtime and compares it
    # with the cluster's spark.sql.autoBroadcastJoinThreshold.
    "spark.sql.ui.explainMode": "formatted",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Bytes up to which AQE merges shuffle partitions; a cluster's smaller size holds.  They are
#: counted as written, compressed: nested documents and register rows grow some tenfold in a task, and
#: a stage of many joins sorts all its sides at once.  Spark's 64 MB took a gigabyte per task.
PARTITION_BYTES = 8 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def build_session(master: str | None = None, app: str = "civicflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode: the driver JVM is the only executor.
            builder = builder.config("spark.driver.memory", "16g")
    for k, v in {**_DEFAULTS, _ADVISORY: str(PARTITION_BYTES)}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the package's session settings to an existing session."""
    for k, v in _DEFAULTS.items():
        if k == "spark.ui.enabled":
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass
    if _bytes(spark, spark.conf.get(_ADVISORY)) > PARTITION_BYTES:
        spark.conf.set(_ADVISORY, str(PARTITION_BYTES))
    ensure_checkpoint_dir(spark)
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    """Bytes of a size such as ``64MB``, as Spark reads it."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        sc_dir = spark.sparkContext.getCheckpointDir()
        current = sc_dir
    if not current:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            # A machine-local folder would not survive a lost executor.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object "
                               "store) before running civicflow on a cluster")
        # Local runs and tests only: no cluster named a folder.
        current = os.path.join(tempfile.gettempdir(), "civicflow-checkpoints")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder (for tables and views)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([base, "civicflow", *tail])
