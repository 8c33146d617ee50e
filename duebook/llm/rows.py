"""Reading documents, naming rows and cutting lineage: what all operators here share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.session import scratch_folder, use_runtime_settings

#: White space that separates words: space, and tab to carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``docs`` in one struct ``row``, beside ``columns``.

    Operators that return the rows they were given work on this form, so no column of theirs can
    clash with one of the caller's.
    """
    return docs.select(F.struct("*").alias("row"), *(c.alias(n) for n, c in columns.items()))


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``text_key``, a hash of the text.

    A document is the pair of its id and its text: rows that repeat both are copies of one
    document, rows that share the id alone are different ones.
    """
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "*", F.xxhash64("text").alias("text_key")
    )


def in_fold(doc_id: str, folds: int) -> Column:
    """Is the row held out: crc32 of the id as text is divisible by ``folds``; no id: held out."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text) % folds == 0


def prepare(spark: SparkSession) -> None:
    """Planner settings, and Arrow batches of few rows and bytes: a row holds a whole text, and each task
    has several batches in memory, in the JVM as well as in Python. Operators run many queries one after
    the other and write what they keep, so shuffle files go with the query that made them; else they
    stay until the driver collects its garbage, and the disk holds those of many rounds at once."""
    use_runtime_settings(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there, partitions and order kept."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_folder(spark, "checkpoint"))
    return df.checkpoint()


def shuffle_tasks(spark: SparkSession) -> int:
    """Tasks for a shuffle whose number of partitions has to be named."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
