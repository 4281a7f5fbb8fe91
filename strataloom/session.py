"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here relies on.  They can be set on a session that
# somebody else built.  Partition counts follow the input, see ``size_for``.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Keys a stream remembers lie on the executors' disks, not in their heaps, and
    # a micro-batch stores only what changed.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


# Splits grow with the input up to a gigabyte, so that a scan has few hundred
# thousand tasks; a shuffle partition takes a fixed share of the input.
SCAN_TASKS = 200_000
SHUFFLE_BYTES = 512 * 1024 * 1024
SPLIT_BYTES = (128 * 1024 * 1024, 1024 * 1024 * 1024)
# A registered query's rows may widen, or become several rows of an aggregate, in the task
# that gets them: its shuffle partitions take less of the input, up to a number of them,
# and adaptive execution joins small ones up to fewer bytes than it does by itself.
FINE_BYTES = 4 * 1024 * 1024
FINE_TASKS = 200_000
JOINED_BYTES = 16 * 1024 * 1024


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` that can be changed without changing them there."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    return tune(own)


def listed_bytes(df: DataFrame) -> int:
    """The size of what ``df`` reads, as the optimiser knows it from the listing of files.

    Of a join or an aggregate it is the size of the largest scan below, which it may
    fall short of; of a plain table it is the size of its files.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    return max((int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())), default=0)


def size_for(df: DataFrame, fine: bool = False) -> None:
    """Fit the session's splits and shuffles to the input ``df``; settings only grow.

    With ``fine`` a shuffle partition takes ``FINE_BYTES`` of the input instead of
    ``SHUFFLE_BYTES``, and ``JOINED_BYTES`` of a shuffle are one task's at most, unless one
    partition has more: what a task holds then does not grow with the input until there
    are ``FINE_TASKS`` partitions.

    Call it on a session of one's own, see ``own_session``.

    The size comes from the file listing.  Adaptive execution joins the shuffle
    partitions again where a stage turns out smaller, so the number is set for the
    largest stage, and only for batch queries: a stream's state keeps its own.
    """
    spark = df.sparkSession
    nbytes = listed_bytes(df)
    split = min(max(SPLIT_BYTES[0], nbytes // SCAN_TASKS), SPLIT_BYTES[1])
    name = "spark.sql.files.maxPartitionBytes"
    if split > spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)):
        spark.conf.set(name, str(split))
    if fine:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(JOINED_BYTES))
    partitions = min(nbytes // FINE_BYTES, max(FINE_TASKS, nbytes // SHUFFLE_BYTES)) if fine else nbytes // SHUFFLE_BYTES
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if partitions > int(spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(name, str(partitions))


def local_session(cores: str | int = 8, app: str = "strataloom", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


# Temporary folders of applications on this machine alone, by application id.
_LOCAL_ROOTS: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``.  Only a local application
    that has none falls back to a temporary folder of this machine, the same for all
    its sessions; the setting itself cannot be changed while an application runs.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.get(app) or _LOCAL_ROOTS.setdefault(app, tempfile.mkdtemp(prefix="strataloom-"))
    return f"{_scratch_root(spark, root)}/{label}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession, root: str) -> str:
    return f"{root.rstrip('/')}/strataloom/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application.

    Results that were not written elsewhere cannot be read any more, so call it at
    the end of a job.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_ROOTS.get(spark.sparkContext.applicationId)
    if root:
        delete(spark, _scratch_root(spark, root))


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, on any file system Spark knows."""
    fs, hadoop = _file_system(spark, path)
    return fs.exists(hadoop)


def delete(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder of any file system Spark knows; false if there is none."""
    fs, hadoop = _file_system(spark, path)
    if not fs.exists(hadoop):
        return False
    if not fs.delete(hadoop, True):
        raise OSError(f"cannot delete {path}")
    return True


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage, survives a lost executor, and lets every later pass
    read only the columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
