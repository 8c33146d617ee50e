"""The four layout queries, medians, and small profile aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.fixed_values import DEFAULT_FROM_DAYS
from duebook.operators.columns import stack_labelled
from duebook.operators.in_order import numbered


def rows_of_key(df: DataFrame, key: str, value: object) -> DataFrame:
    """All rows of one key."""
    return df.where(F.col(key) == F.lit(value))


def month_range(df: DataFrame, first: date, last: date, amount: str = "exposure_amount") -> DataFrame:
    """Rows and sum of ``amount`` between two months. Grain: one row."""
    return df.where(F.col("month").between(F.lit(first), F.lit(last))).agg(
        F.count("*").alias("n"), F.sum(amount).alias("total")
    )


def worst_by_attribute(
    df: DataFrame, dimension: DataFrame, key: str, attribute: str, dpd: str = "dpd"
) -> DataFrame:
    """Rows and worst days past due by an attribute of another table.

    Grain: one row per value. Facts are combined by key before the join, so the join sees one
    row per key however many rows a key has.
    """
    by_key = df.groupBy(key).agg(F.count("*").alias("_n"), F.max(dpd).alias("_worst"))
    return (
        by_key.join(dimension.select(key, attribute), key)
        .groupBy(attribute)
        .agg(F.sum("_n").alias("n"), F.max("_worst").alias("max_dpd"))
    )


def defaults_by_month(df: DataFrame, dpd: str = "dpd") -> DataFrame:
    """Rows and rows in default by month. Grain: one row per month."""
    return df.groupBy("month").agg(
        F.count("*").alias("n"), F.count_if(F.col(dpd) >= DEFAULT_FROM_DAYS).alias("n_default")
    )


def middle_key(df: DataFrame, key: str, accuracy: int = 100_000) -> DataFrame:
    """Approximate median of ``key`` from a mergeable sketch. Grain: one row."""
    return df.agg(F.percentile_approx(key, 0.5, accuracy).alias(key))


def medians(df: DataFrame, groups: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Exact median of each metric per group, cut to whole numbers.

    Grain: one row per group. The median is read off a distributed sort at its position, so no
    task holds all values of a group.
    """
    long = stack_labelled(
        {metric: _median(df.select(*groups, metric), groups, metric) for metric in metrics},
        "_metric",
    )
    return long.groupBy(*groups).pivot("_metric", list(metrics)).agg(F.max("_median"))


def _median(df: DataFrame, groups: Sequence[str], metric: str) -> DataFrame:
    placed = numbered(df, [*map(F.asc, groups), F.asc_nulls_last(metric)])
    spans = placed.groupBy(*groups).agg(
        F.min("_position").alias("_first"), F.count(metric).alias("_n")
    )
    middle = [F.col("_first") + F.floor((F.col("_n") - d) / 2) for d in (1, 0)]
    wanted = spans.where("_n > 0").select(
        *groups, F.explode(F.array_distinct(F.array(*middle))).alias("_position")
    )
    # Positions are unique, so this join has no hot key.
    return (
        wanted.join(placed.select("_position", metric), "_position")
        .groupBy(*groups)
        .agg(F.avg(metric).cast("bigint").alias("_median"))
    )


def profile(df: DataFrame, **conditions: Column | str) -> DataFrame:
    """Count of all rows and of the rows under each condition. Grain: one row, one pass."""
    return df.agg(
        F.count("*").alias("rows"),
        *(
            F.count_if(F.expr(c) if isinstance(c, str) else c).alias(name)
            for name, c in conditions.items()
        ),
    )
