"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job needs, all changeable on a running session. Shuffle width
# and memory are left to the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The older form of timestamps in Parquet has no minimum and maximum, so
    # that a time range could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The progress reports of a run are summed at its end, so keep them all.
    "spark.sql.streaming.numRecentProgressUpdates": "100000",
}


MAX_SHUFFLE_PARTITIONS = 50_000


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session made elsewhere."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def fit_shuffle(df: DataFrame, bytes_per_partition: int = 128 * 1024 * 1024) -> DataFrame:
    """Let shuffles start with enough partitions for this input.

    Raises the starting number only; adaptive execution merges what turns out
    small. Returns the frame unchanged.
    """
    conf = df.sparkSession.conf
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    have = int(conf.get(name, None) or conf.get("spark.sql.shuffle.partitions"))
    need = min(plan_bytes(df) // bytes_per_partition, MAX_SHUFFLE_PARTITIONS)
    if need > have:
        conf.set(name, str(need))
    return df


def plan_bytes(df: DataFrame) -> int:
    """Spark's own size estimate for a plan. Starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def local_session(cores: int = 8, **settings: str) -> SparkSession:
    """A single-machine session for tests and bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orebed")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="orebed-warehouse-"))
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, as a machine-local folder would not
    survive the loss of a node.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="orebed-shared-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """The name of an unused folder below the shared root."""
    return f"{shared_root(spark)}/orebed-{label}-{uuid.uuid4().hex}"
