"""Session settings and the few helpers that touch the session itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Months of all years 1..9999: the most rows a frame with one row per month can have.
MONTHS_IN_CALENDAR = 12 * 9999

RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when the split costs the aggregate above it a new shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on contract and month may keep rows that already are by contract where they are.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
# Rows of a few bytes become a row per month after a shuffle, some ninety times their size in a
# task's memory. So shuffles are cut finely and joined again to small parts: what a task holds stays
# the same on more input. A session that names a number of cuts of its own keeps it. Files are read in
# small splits for the same reason: a task that reads holds what it aggregates, sorts or is to send.
PART_SIZE = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.files.maxPartitionBytes": "4m",
}
# Rows that come sorted by their group are combined one group after the other, without a table of groups.
IN_ORDER = {"spark.sql.execution.replaceHashWithSortAgg": "true"}
FINEST_CUT = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000"}
SETTINGS = {
    **RUNTIME,
    **PART_SIZE,
    **IN_ORDER,
    **FINEST_CUT,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Spark keeps the map output of lost executors reachable through migration.
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def open_session(app: str = "duebook", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session. ``extra`` holds further settings, dots written as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {name.replace("__", "."): value for name, value in extra.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def open_local(cores: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks: no UI, as many shuffle partitions as cores."""
    local = {
        "spark__ui__enabled": "false",
        "spark__sql__shuffle__partitions": str(cores),
        "spark__sql__adaptive__coalescePartitions__initialPartitionNum": str(cores),
        "spark__sql__adaptive__coalescePartitions__parallelismFirst": "true",
    }
    return open_session("duebook-local", f"local[{cores}]", **(local | extra))


def use_runtime_settings(spark: SparkSession) -> None:
    """Give a session opened elsewhere the planner settings these plans are made for."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)


def use_small_parts(spark: SparkSession) -> None:
    """Let tasks read and hold little each, for plans that spread rows over months."""
    for name, value in (PART_SIZE | IN_ORDER).items():
        spark.conf.set(name, value)
    for name, value in FINEST_CUT.items():
        spark.conf.set(name, spark.conf.get(name, None) or value)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, unique folder for intermediate tables, below the cluster's shared folder.

    The shared folder is the one named by ``spark.checkpoint.dir``. Only a local session may run
    without that setting; it then gets a temporary folder of its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="duebook-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def with_columns(schema: StructType, ddl: str) -> StructType:
    """``schema`` with the columns of ``ddl`` added at the end."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at ``path``, on whatever file system it names?"""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if there is no such path."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote and nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def settle_down(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts the lineage, and makes every later use see the same rows even where ``df`` depends on
    how rows were spread over tasks.
    """
    folder = scratch_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def broadcast_if_small(df: DataFrame, max_rows: int = MONTHS_IN_CALENDAR) -> DataFrame:
    """Mark ``df`` for broadcasting when it has at most ``max_rows`` rows.

    A larger frame is returned without a hint, so the planner is free to shuffle both sides.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
