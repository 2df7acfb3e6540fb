"""Session settings the operators are designed for."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Skewed joins are split at run time even when a later step wants the same
# partitioning: an extra shuffle costs less than one task holding a third of the rows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# For the live operators: state kept outside the heap, and sessions merged before the
# shuffle so that one busy agent sends sessions and not events.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions of about 128 MB, and at least two per core.

    Set this high rather than low: adaptive execution joins small partitions but cannot
    cut a partition that is too large for its executor before it has been written.
    """
    return max(2 * cores, -(-shuffled_bytes // PARTITION_BYTES))


def build_session(
    app: str, master: str | None = "local[8]", partitions: int | None = 8, **extra: str
) -> SparkSession:
    """A session for local runs.

    On a cluster pass ``master=None`` and ``partitions=shuffle_partitions(...)``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        local = {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        }
        builder = builder.master(master)
        extra = {**local, **extra}
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark

def materialize(df: DataFrame) -> DataFrame:
    """Write a result that several later jobs read, and cut its lineage.

    Uses the shared checkpoint folder the cluster names, so that a lost executor costs a
    read and not a recomputation. Only a local session without one gets a temporary folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            base = tempfile.mkdtemp(prefix="patchloom-")
        context.setCheckpointDir(base)
    return df.checkpoint()
