"""Incremental ingestion: drain what has landed, stop, and continue from there next time."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.session import path_exists
from duebook.sources.files import stream_csv, stream_json, stream_lines
from duebook.sources.headers import first_lines, header_came_late


def drain(stream: DataFrame, folder: str, checkpoint: str) -> int:
    """Append everything a stream has to a Parquet folder and wait; returns the rows added.

    The checkpoint remembers the files read, and the sink commits each batch once: a rerun adds
    only new files, and a rerun after a failure repeats no row.
    """
    spark = stream.sparkSession
    before = _stored(stream, folder)
    query = (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _stored(stream, folder) - before


def _stored(stream: DataFrame, folder: str) -> int:
    """Rows of the stream's sink, from the footers of its files; 0 if there is none yet."""
    spark = stream.sparkSession
    if not path_exists(spark, f"{folder}/_spark_metadata"):
        return 0
    return spark.read.schema(stream.schema).parquet(folder).count()


def ingest_csv(
    spark: SparkSession, landing: str, folder: str, checkpoint: str, schema: StructType, **pace
) -> int:
    """Land-to-raw for CSV files. Grain: one row per source row, delivery columns added.

    First a small stream of its own keeps the header of every new file below ``checkpoint``; then
    the rows are read by these headers. A file that lands in between stops the second stream
    before it writes, and both go on with it.
    """
    while True:
        headers = keep_headers(spark, landing, f"{checkpoint}/headers")
        try:
            stream = stream_csv(spark, landing, schema, headers=headers, **pace)
            return drain(stream, folder, f"{checkpoint}/rows")
        except StreamingQueryException as stopped:
            if not header_came_late(stopped):
                raise


def keep_headers(spark: SparkSession, landing: str, folder: str) -> DataFrame:
    """The first line of every file landed so far, new ones added to those in ``folder``.

    Each batch of new files has a folder of its own; a repeated batch overwrites it.
    """

    def keep(batch: DataFrame, number: int) -> None:
        first_lines(batch).write.mode("overwrite").parquet(f"{folder}/kept/batch={number}")

    query = (
        stream_lines(spark, landing)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not path_exists(spark, f"{folder}/kept"):
        return spark.createDataFrame([], "_path STRING, _header STRING")
    kept = spark.read.schema("_path STRING, _header STRING, batch BIGINT").parquet(f"{folder}/kept")
    return kept.drop("batch")


def ingest_json(
    spark: SparkSession, landing: str, folder: str, checkpoint: str, schema: StructType, **pace
) -> int:
    """Land-to-raw for JSON-lines files. Grain: one row per event."""
    return drain(stream_json(spark, landing, schema, **pace), folder, checkpoint)


def rows_per_file(raw: DataFrame) -> DataFrame:
    """Rows by source file, in file order. Grain: one row per file."""
    return raw.groupBy("_source_file").agg(F.count("*").alias("rows")).orderBy("_source_file")
