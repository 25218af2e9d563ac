"""Session construction and the shared folder used for lineage cuts and sinks."""

from __future__ import annotations

import os
import re
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. UTC makes timestamp <-> epoch conversions exact
# and is what the original data model assumes (all instants are UTC).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Files of DataFrame.checkpoint() go with the DataFrame.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "tempora",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    On a cluster, leave ``master`` unset so spark-submit decides, and let the
    cluster set ``spark.checkpoint.dir``; locally a scratch folder is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a local scratch folder only when unset in local mode.

    On a cluster the setting names a shared (HDFS / object store) folder that
    survives executor loss; it is never overridden here, and a cluster session
    without it is an error rather than a silent machine-local fallback.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder (HDFS / object store) on a cluster")
        current = tempfile.mkdtemp(prefix="tempora-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:  # classic sessions: also the folder used by DataFrame.checkpoint()
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - e.g. a Connect session has no SparkContext
        pass
    return current


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path inside the shared checkpoint folder (for written tables, models, sinks)."""
    base = ensure_checkpoint_dir(spark)
    names = list(parts)
    if unique:
        names.append(uuid.uuid4().hex[:12])
    return os.path.join(base, *names) if "://" not in base else "/".join([base.rstrip("/"), *names])


RUN_NAME = re.compile(r"[0-9a-f]{12}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


def sweep_runs(spark: SparkSession, older_than_seconds: float) -> int:
    """Remove the folders of single runs under the checkpoint folder that nothing has been written to for so long; their number.

    These are ``shared_path(..., unique=True)`` and the folders of ``DataFrame.checkpoint()``. Tables, models and
    checkpoints of streams that jobs keep there under names of their own stay.
    """
    base = ensure_checkpoint_dir(spark)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = (time.time() - older_than_seconds) * 1000

    def folders(path):
        return [s for s in fs.listStatus(path) if s.isDirectory()]

    def newest(status) -> int:
        latest, files = status.getModificationTime(), fs.listFiles(status.getPath(), True)
        while latest <= limit and files.hasNext():
            latest = max(latest, files.next().getModificationTime())
        return latest

    own = os.path.basename(spark.sparkContext.getCheckpointDir() or "")
    found = folders(root)
    runs = [s for s in found if RUN_NAME.fullmatch(s.getPath().getName()) and s.getPath().getName() != own]
    runs += [s for f in found if not RUN_NAME.fullmatch(f.getPath().getName()) for s in folders(f.getPath()) if RUN_NAME.fullmatch(s.getPath().getName())]
    old = [s.getPath() for s in runs if newest(s) <= limit]
    for path in old:
        fs.delete(path, True)
    return len(old)


def scale_conf(input_bytes: int, executor_cores_total: int, target_partition_bytes: int = 256 * 1024 ** 2
               ) -> dict[str, str]:
    """Settings sized to the data: shuffle partitions so that a shuffle partition holds
    about ``target_partition_bytes`` of (uncompressed-ish) input, never fewer than
    two waves of tasks; AQE then coalesces small partitions and splits skewed ones.

    Example: 100 TB of Parquet on 8,000 cores -> 409,600 initial shuffle partitions,
    coalesced at run time to the advisory size.
    """
    parts = max(2 * executor_cores_total, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 * 1024 ** 2)),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        # Large stream state (de-duplication keys, open buckets) off the JVM heap,
        # spilled to local disk and checkpointed incrementally to the shared folder.
        # (Locally, with small state, the default provider starts faster.)
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
