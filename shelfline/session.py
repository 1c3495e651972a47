"""Session settings and the shared folder for written intermediate tables."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def local_session(cores: int = 8, app: str = "shelfline", memory: str = "6g", **extra: str) -> SparkSession:
    """A session on this machine with a driver of ``memory``, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would lose data with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfline-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Rows that one task sorts or sums, about.
TASK_ROWS = 500_000
#: Spark's own setting that ends a query's shuffle files with the query.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PARTITIONS = "spark.sql.shuffle.partitions"
#: Shuffled bytes that adaptive execution should give one task, and the most of them within a bulk write.
_ADVISED, TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 32 << 20


@contextmanager
def bulk_write(spark: SparkSession, rows: int) -> Iterator[None]:
    """Settings for writes of about so many rows, which keep them from filling disks.

    Their shuffle files end with them, and not when the driver happens to collect
    its garbage. There are as many shuffle partitions as tasks need to sort their
    rows in memory; adaptive execution merges those that turn out small, but less
    far than by default, as compressed rows are several times larger in memory.
    """
    before = {_CLEANUP: spark.conf.get(_CLEANUP, "false"), **{key: spark.conf.get(key) for key in (_PARTITIONS, _ADVISED)}}
    advised = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[_ADVISED])
    spark.conf.set(_CLEANUP, "true")
    spark.conf.set(_PARTITIONS, str(max(int(before[_PARTITIONS]), rows // TASK_ROWS)))
    spark.conf.set(_ADVISED, f"{min(advised, TASK_BYTES)}b")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner, by its own estimate, would broadcast these rows to join them."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def discard(spark: SparkSession, path: str) -> bool:
    """Delete a folder of intermediate tables, wherever the file system keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it doesn't exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory())


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder in one step; False, with nothing moved, if the target is there already."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(path(target)):
        return False
    system.mkdirs(path(target).getParent())
    return system.rename(path(source), path(target))
