"""Row-wise column work: naming, blank tokens, sentinels, types, order. Grain never changes.

Every operator here is a plain projection, so all of them run on streams as well.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from duebook.fixed_values import DELIVERY_COLUMNS


def lower_names(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case all column names; ``renames`` then maps lower-case names to better ones."""
    better = dict(renames or {})
    return df.withColumnsRenamed(
        {name: better.get(name.lower(), name.lower()) for name in df.columns}
    )


def blank_to_null(
    df: DataFrame, tokens: Iterable[str], spare: Iterable[str] = DELIVERY_COLUMNS
) -> DataFrame:
    """Replace exact ``tokens`` by null in every string column outside ``spare``."""
    spared = set(spare)
    texts = [
        f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name not in spared
    ]
    if not texts:
        return df
    return df.replace({token: None for token in tokens}, subset=texts)


def sentinel_to_null(
    df: DataFrame, sentinels: Mapping[str, int], suffix: str = "_anomaly"
) -> DataFrame:
    """Replace each column's sentinel by null and add ``<column><suffix>``: was it there?"""
    changed = {}
    for column, sentinel in sentinels.items():
        hit = F.col(column).eqNullSafe(F.lit(sentinel))
        changed[column + suffix] = hit
        changed[column] = F.when(hit, None).otherwise(F.col(column))
    return df.withColumns(changed)


def retype(df: DataFrame, types: Mapping[str, Iterable[str]]) -> DataFrame:
    """Cast columns, given as type -> columns; all others pass through."""
    return df.withColumns(
        {c: F.col(c).cast(dtype) for dtype, columns in types.items() for c in columns}
    )


def columns_with_prefix(names: Iterable[str], prefix: str) -> list[str]:
    """Lower-case names of the columns that start with ``prefix`` (any case)."""
    return [name.lower() for name in names if name.lower().startswith(prefix.lower())]


def lead_with(df: DataFrame, first: Iterable[str]) -> DataFrame:
    """Put ``first`` in front, all other columns after it in their order."""
    head = list(first)
    return df.select(*head, *(c for c in df.columns if c not in head))


def without_prefix(df: DataFrame, prefix: str = "_") -> DataFrame:
    """Drop all columns whose name starts with ``prefix``."""
    return df.drop(*(c for c in df.columns if c.startswith(prefix)))


def stack_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name of batch or streaming frames; a column that a frame lacks becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_labelled(frames: Mapping[object, DataFrame], label: str) -> DataFrame:
    """Union by name with a constant column ``label`` that tells the frames apart."""
    return stack_by_name(df.withColumn(label, F.lit(value)) for value, df in frames.items())
