"""Replay of stored payments as ordered JSON batches, and corrected redeliveries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.fixed_values import CORRECTION_FACTOR, MARRIED, NOT_MARRIED
from duebook.operators.in_order import numbered


def sample_of_keys(df: DataFrame, key: str, modulus: int) -> DataFrame:
    """Sampling by key: all rows of the keys divisible by ``modulus``. Grain: unchanged."""
    return df.where(F.pmod(key, F.lit(modulus)) == 0)


def typed_from_text(df: DataFrame, ddl: str) -> DataFrame:
    """Give text columns the types of ``ddl``: empty is null, ``"6.0"`` is the integer 6."""
    typed = []
    for field in StructType.fromDDL(ddl):
        filled = F.nullif(F.col(field.name), F.lit(""))
        typed.append(filled.cast("double").cast(field.dataType).alias(field.name))
    return df.select(*typed)


def replay_order(df: DataFrame, paid_day: str, due_day: str) -> list[Column]:
    """Order of replay: payment day, else due day, then every column; nulls come last."""
    columns = (F.col(c) for c in df.columns)
    return [F.asc_nulls_last(c) for c in (F.ifnull(paid_day, due_day), *columns)]


def cut_into_batches(
    df: DataFrame, order: Sequence[Column], size: int, first_batches: int | None = None
) -> DataFrame:
    """Number rows in ``order`` and cut them into consecutive batches of ``size`` rows.

    Grain: unchanged; adds ``position`` and ``batch``, both from 0. The last batch holds the
    rest. ``first_batches`` keeps only so many batches.
    """
    if size < 1:
        raise ValueError(f"a batch needs at least one row, not {size}")
    batched = numbered(df, order, "position").withColumn(
        "batch", F.floor(F.col("position") / size).cast("bigint")
    )
    return batched if first_batches is None else batched.where(F.col("batch") < first_batches)


def write_batches(batched: DataFrame, folder: str) -> None:
    """Write one JSON-lines file per batch, in row order, below ``folder``/batch=<n>/."""
    (
        batched.repartition("batch")
        .sortWithinPartitions("batch", "position")
        .drop("position")
        .write.partitionBy("batch")
        .option("ignoreNullFields", "false")
        .json(folder)
    )


def corrected(df: DataFrame, amount: str, category: str) -> DataFrame:
    """Redelivery with the amount raised by a tenth (half-even to 3 decimals) and the category
    flipped; all other columns stay. Grain: unchanged."""
    raised = F.bround(F.col(amount).cast("decimal(18,3)") * F.lit(CORRECTION_FACTOR).cast("decimal(2,1)"), 3)
    flipped = F.when(F.col(category).eqNullSafe(F.lit(MARRIED)), NOT_MARRIED).otherwise(MARRIED)
    return df.withColumns({amount: raised.cast("decimal(18,3)"), category: flipped})


def first_rows(df: DataFrame, order: Iterable[Column], n: int) -> DataFrame:
    """The first ``n`` rows in ``order`` (the top-n itself is the feature)."""
    return df.orderBy(*order).limit(n)
