"""Physical layouts of a table: scattered, clustered, partitioned, z-ordered.

All writers store the same rows in about the same number of files. Where a layout puts equal
keys next to each other, a spreading column is the last part of the range key, so a key that
holds a large share of all rows is cut into several files instead of filling one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

_SPREAD = "_spread"


def _row_hash(df: DataFrame) -> Column:
    """A hash of the whole row (maps left out): the same wherever and however often it is computed."""
    return F.xxhash64(*(f.name for f in df.schema if not isinstance(f.dataType, MapType)))


def _ranged(df: DataFrame, files: int, keys: Sequence[str]) -> DataFrame:
    return (
        df.withColumn(_SPREAD, _row_hash(df))
        .repartitionByRange(files, *keys, _SPREAD)
        .sortWithinPartitions(*keys)
        .drop(_SPREAD)
    )


def write_scattered(df: DataFrame, folder: str, files: int, key: str) -> None:
    """No layout: rows spread by the hash of ``key``.

    A key with more rows than a file should hold is spread over all files by the hash of its
    rows. There are fewer such keys than files, so their list is small enough to broadcast.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    rows = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where(F.col("_n") > max(1, rows // files)).select(F.col(key).alias("_k"))
    marked = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), F.col(key).eqNullSafe(F.col("_k")), "left")
    place = F.when(F.col("_hot"), _row_hash(df)).otherwise(F.xxhash64(key))
    number = F.pmod(place, F.lit(files)).cast("int")
    marked.repartitionById(files, number).drop("_k", "_hot").write.parquet(folder)


def write_clustered(df: DataFrame, folder: str, files: int, keys: Sequence[str]) -> None:
    """Files with disjoint ranges of ``keys``, sorted inside: readers skip by the first key."""
    _ranged(df, files, keys).write.parquet(folder)


def write_partitioned(df: DataFrame, folder: str, files: int, column: str) -> None:
    """One folder per value of ``column``, few files in each: readers prune whole folders."""
    _ranged(df, files, [column]).write.partitionBy(column).parquet(folder)


def write_zordered(
    df: DataFrame, folder: str, files: int, keys: Sequence[str], bits: int | None = None
) -> None:
    """Files along the z-order curve of ``keys``: readers skip by any of the keys.

    ``bits`` per key: by default so many that the curve has at least 16 cells per file.
    """
    if bits is None:
        bits = max(6, ceil(log2(16 * max(files, 1)) / len(keys)))
    curve = df.withColumn("_z", z_value(df, keys, bits))
    _ranged(curve, files, ["_z"]).drop("_z").write.parquet(folder)


def z_value(df: DataFrame, keys: Sequence[str], bits: int = 6) -> Column:
    """Interleaved bits of the rank buckets of ``keys``.

    Each key is cut into 2**bits buckets at its approximate quantiles (one pass over ``df``;
    the driver gets 2**bits numbers per key), so uneven values still fill all buckets.
    """
    steps = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*(F.percentile_approx(k, steps).alias(k) for k in keys)).first()
    z = F.lit(0).cast("bigint")
    for position, key in enumerate(keys):
        rank = _rank_bucket(F.col(key), sorted(set(cuts[key] or [])), 2**bits)
        for bit in range(bits):
            # Bit b of key p goes to bit b * len(keys) + (last key - p).
            target = bit * len(keys) + len(keys) - 1 - position
            moved = F.shiftleft(F.shiftright(rank.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint")), target)
            z = z.bitwiseOR(moved)
    return z


def _rank_bucket(value: Column, cuts: Sequence[object], buckets: int) -> Column:
    """Number of ``cuts`` below ``value``, stretched over all ``buckets``.

    Found by halving, so a row makes log2(cuts) comparisons. Stretching lets a key of few values
    use the high bits too, so it shapes the curve as much as a key of many values.
    """

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low * buckets // (len(cuts) + 1))
        middle = (low + high) // 2
        return F.when(value <= F.lit(cuts[middle]), between(low, middle)).otherwise(
            between(middle + 1, high)
        )

    return F.when(value.isNull(), 0).otherwise(between(0, len(cuts)))


def file_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Number and total size of the data files below ``folder``. Grain: one row.

    Lists the files only; their content is not read.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def file_spans(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and the least and greatest value of some columns in each file of a file table.

    Grain: one row per file: ``file``, ``rows``, ``low_<column>``, ``high_<column>``. One pass with a
    combine in each task; what readers know of a file before they open it.
    """
    file = F.col("_metadata.file_path").alias("file")
    spans = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
    return df.groupBy(file).agg(F.count("*").alias("rows"), *spans)


def skipping(spans: DataFrame, **wanted: tuple[str, object, object]) -> DataFrame:
    """What range filters read of a file table with the given ``file_spans``.

    Grain: one row per filter: ``filter``, ``files_read``, ``files_pruned``, ``rows_read``.
    ``wanted`` maps a filter's name to a column and its least and greatest wanted value.
    """
    one = []
    for name, (column, low, high) in wanted.items():
        meets = (F.col(f"high_{column}") >= F.lit(low)) & (F.col(f"low_{column}") <= F.lit(high))
        one.append(
            spans.agg(
                F.lit(name).alias("filter"),
                F.count_if(meets).alias("files_read"),
                F.count_if(~F.ifnull(meets, F.lit(False))).alias("files_pruned"),
                F.ifnull(F.sum(F.when(meets, F.col("rows"))), F.lit(0)).alias("rows_read"),
            )
        )
    return reduce(DataFrame.unionByName, one)


def files_with_rows(df: DataFrame, **filters: Column) -> DataFrame:
    """How many files of a file table hold rows of each filter. Grain: one row."""
    # A group per file first, so the second aggregate sees files and not rows.
    hit = {name: F.bool_or(condition).alias(f"{name}_files") for name, condition in filters.items()}
    per_file = df.groupBy(F.col("_metadata.file_path").alias("_file")).agg(*hit.values())
    return per_file.agg(*(F.count_if(f"{name}_files").alias(f"{name}_files") for name in hit))
