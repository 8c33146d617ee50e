"""Deduplication, key lookups and upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column] | None = None
) -> DataFrame:
    """Keep the newest row of every key.

    Grain: one row per ``keys``. Default order: load time, file, then a hash of the whole row, so
    the choice never depends on how rows are spread. The top-1 filter is applied before the
    shuffle too (WindowGroupLimit), so a key with very many copies sends one row per task.
    """
    order = newest_first or [
        F.desc("_ingested_at"),
        F.desc("_source_file"),
        F.xxhash64(*df.columns).desc(),
    ]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def mark_known(
    df: DataFrame, reference: DataFrame, key: str, flag: str, reference_key: str | None = None
) -> DataFrame:
    """Add the boolean ``flag``: does ``key`` occur in ``reference``? A null key does not.

    Grain: unchanged; the reference is reduced to distinct keys first.
    """
    known = (
        reference.select(F.col(reference_key or key).alias(key))
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    return df.join(known, key, "left").withColumn(flag, F.col(flag).isNotNull())


def without_match(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is missing in ``reference``; null keys never match."""
    return df.join(reference.select(*keys), list(keys), "left_anti")


def shadowed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rename ``keys`` to their shadow names, for a join with ``same_keys``."""
    return df.withColumnsRenamed({key: f"_k_{key}" for key in keys})


def same_keys(keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` and their shadows; a hash or merge join can use it."""
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))


def merge_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with matching rows replaced by ``updates`` and new ones added.

    Grain: one row per ``keys`` when both inputs have it. Keys compare null-safe.
    """
    arrived = shadowed(updates.select(*keys), keys)
    return target.join(arrived, same_keys(keys), "left_anti").unionByName(updates)
