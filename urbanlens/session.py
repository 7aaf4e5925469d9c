"""Session defaults and the shared scratch location.

Everything intermediate that has to outlive a task (lineage cuts, round-trip
files written by the source queries) goes under the cluster's
``spark.checkpoint.dir``.  That folder is shared storage on a real cluster, so
work written there survives the loss of an executor.  A local folder is only
made for a local master whose session names none.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session settings every query here relies on.
DEFAULT_CONF = {
    # All timestamp <-> text conversions are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, switch to broadcast joins from measured shuffle sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the split costs one more
    # shuffle downstream (the grid search groups right after its join).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcast a join side only on its measured size (AQE, after the shuffle
    # map stage ran), never on a file-size estimate made before running.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "urbanlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given; on a cluster spark-submit decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def scale_conf(
    input_bytes: int,
    partition_bytes: int = 256 * 1024 * 1024,
    max_shuffle_partitions: int = 100_000,
) -> dict[str, str]:
    """Partition sizing for a given input size (pass to ``get_session(conf=...)``).

    Scan splits and shuffle partitions are both sized near ``partition_bytes``
    so one task's data fits comfortably in executor memory; AQE coalesces
    shuffle partitions that turn out small (most shuffles here carry partial
    aggregates) and splits skewed ones.  For 100 TB at 256 MB this gives
    about 400,000 scan tasks and the shuffle partition cap.
    """
    shuffle = min(max(200, input_bytes // partition_bytes), max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder, set up if needed.

    Order: a folder already set on the context, then ``spark.checkpoint.dir``
    from the configuration.  With neither, a local master gets a fresh local
    folder; on a cluster that is an error, since executors don't share it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "name a folder that all executors share: --conf spark.checkpoint.dir=... "
                "(a machine-local folder is only made for a local master)")
        configured = tempfile.mkdtemp(prefix="urbanlens-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Each call gets its own folder; nothing is ever cleared or reused.
    """
    base = checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into a new folder of the shared location, and read back.

    Cuts the lineage like a checkpoint.  It cuts Spark's size estimate too: a
    checkpoint keeps it, and estimates multiplied over many joins grow without
    bound.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings_of(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the scans planned inside."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
