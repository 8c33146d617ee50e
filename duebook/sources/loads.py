"""Tables made of numbered loads: append, replace, upsert, read as of a load, load files once.

Rows live below ``<folder>/rows/_load_version=<n>``; ``<folder>/log`` has one row per finished
load. Rows are written first and logged after, so a load that dies halfway is invisible and the
next try overwrites it. Loads are columns and folders of ordinary Parquet: Spark prunes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from duebook.operators.matching import merge_rows
from duebook.session import path_exists, settle_down

VERSION = "_load_version"
_LOG = "version BIGINT, timestamp TIMESTAMP, operation STRING, base BIGINT, columns STRING"


class LoadedTable:
    """A table of numbered loads. One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def exists(self) -> bool:
        return bool(self._log_rows())

    def history(self) -> DataFrame:
        """Grain: one row per load: ``version``, ``timestamp``, ``operation``."""
        return self.spark.read.schema(_LOG).json(f"{self.folder}/log").select(
            "version", "timestamp", "operation"
        )

    def read(self, as_of: int | None = None) -> DataFrame:
        """Rows as of a load (default: the latest). Only the folders needed are read."""
        log = [r for r in self._log_rows() if as_of is None or r.version <= as_of]
        if not log:
            raise ValueError(f"{self.folder} has no load {'' if as_of is None else as_of}")
        last = max(log, key=lambda r: r.version)
        rows = self.spark.read.schema(f"{last.columns}, {VERSION} BIGINT").parquet(
            f"{self.folder}/rows"
        )
        return rows.where(F.col(VERSION).between(last.base, last.version)).drop(VERSION)

    def append(self, df: DataFrame, operation: str = "append") -> int:
        """Add rows, creating the table on first use.

        New columns are added to the table; known ones are cast to the types they have there.
        """
        log = self._log_rows()
        if not log:
            return self._load(df, 0, 0, operation, df.schema)
        last = max(log, key=lambda r: r.version)
        known = StructType.fromDDL(last.columns)
        types = {field.name.lower(): field.dataType for field in known.fields}
        new = [field for field in df.schema.fields if field.name.lower() not in types]
        fitted = df.select(
            *(F.col(c).cast(types[c.lower()]) if c.lower() in types else c for c in df.columns)
        )
        merged = StructType([*known.fields, *new])
        return self._load(fitted, last.version + 1, last.base, operation, merged)

    def replace(self, df: DataFrame, operation: str = "replace") -> int:
        """Make ``df`` the whole content; earlier loads stay readable by number."""
        number = max((r.version for r in self._log_rows()), default=-1) + 1
        return self._load(df, number, number, operation, df.schema)

    def upsert(self, updates: DataFrame, keys: Sequence[str]) -> int:
        """Update matching rows, insert the others; keys compare null-safe.

        The result is a new load, so the rows being read are never overwritten.
        """
        if not self.exists():
            return self.append(updates, "create")
        return self.replace(merge_rows(self.read(), updates, keys), "merge")

    def _load(self, df: DataFrame, number: int, base: int, operation: str, schema) -> int:
        df.write.mode("overwrite").parquet(f"{self.folder}/rows/{VERSION}={number}")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        (
            self.spark.range(1)
            .select(
                F.lit(number).cast("bigint").alias("version"),
                F.current_timestamp().alias("timestamp"),
                F.lit(operation).alias("operation"),
                F.lit(base).cast("bigint").alias("base"),
                F.lit(ddl).alias("columns"),
            )
            .coalesce(1)
            .write.mode("append")
            .json(f"{self.folder}/log")
        )
        return number

    def _log_rows(self) -> list:
        # One row per load ever made: small, and read to find folders, like a file listing.
        log = f"{self.folder}/log"
        if not path_exists(self.spark, log):
            return []
        return self.spark.read.schema(_LOG).json(log).collect()


def files_in(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files below a folder. Grain: one row per file: ``path``, ``length``. Contents stay unread."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length")
    )


def load_new_files(
    spark: SparkSession, table: LoadedTable, folder: str, pattern: str = "*.csv"
) -> int:
    """Load the CSV files of ``folder`` that no earlier call has loaded; returns their number.

    Columns go by name: files may differ in the order and number of their columns. Types are
    inferred from the files and new columns are merged into the table. The names of
    the loaded files are written inside the load, before it is logged: rows and names become
    visible together, and finding new files never reads the rows.
    """
    found = files_in(spark, folder, pattern)
    names_of = LoadedTable(spark, f"{table.folder}/files")
    if table.exists():
        done = max(r.version for r in table._log_rows())
        loaded = names_of.read().where(F.col("in_load") <= done)
        found = found.join(loaded, "path", "left_anti")
        number = done + 1
    else:
        number = 0
    found = settle_down(found.join(headers_of(spark, folder, pattern), "path"), "new-files")
    rows = None
    # One read per different header: within it, columns have the same order in all files. The
    # reader takes the file names as arguments; Spark's own file index holds the same list.
    for kind in found.select("header").distinct().orderBy("header").collect():
        same_header = found.where(F.col("header") == kind.header).select("path")
        part = (
            spark.read.option("header", True)
            .option("inferSchema", True)
            .csv([row.path for row in same_header.collect()])
            .withColumn("_source_file", F.col("_metadata.file_path"))
        )
        rows = part if rows is None else union_widened(rows, part)
    if rows is None:
        return 0
    listed = found.select("path", F.lit(number).cast("bigint").alias("in_load"))
    if names_of.exists():
        # Names of a load that died before it was logged are dropped here.
        earlier = names_of.read().where(F.col("in_load") < number)
        listed = earlier.unionByName(listed)
    names_of.replace(listed, "list")
    table.append(rows, "load")
    return found.count()


def headers_of(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """The first line of each file. Grain: one row per file that is not empty: ``path``, ``header``."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(folder)
        .where("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("_at"), "value")
    )
    first = lines.groupBy("path").agg(F.min("_at").alias("_at"))
    return lines.join(first, ["path", "_at"]).select("path", F.col("value").alias("header"))


def union_widened(one: DataFrame, other: DataFrame) -> DataFrame:
    """Union by name with missing columns as nulls; a column whose types clash becomes text."""
    kinds = {f.name: f.dataType for f in one.schema.fields}
    clashes = [
        f.name
        for f in other.schema.fields
        if f.name in kinds
        and f.dataType != kinds[f.name]
        and not (isinstance(f.dataType, NumericType) and isinstance(kinds[f.name], NumericType))
    ]
    text = {name: F.col(name).cast("string") for name in clashes}
    return one.withColumns(text).unionByName(other.withColumns(text), allowMissingColumns=True)
