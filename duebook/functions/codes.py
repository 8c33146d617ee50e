"""Decoding of status codes and labelling of numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_label(value: Column, edges: Sequence[tuple[int, str]]) -> Column:
    """Label of the last edge not above ``value``; ``edges`` ascend, null and lower give null."""
    label = F.lit(None).cast("string")
    for edge, name in edges:
        # Wrapped from the lowest edge outwards, so the highest edge is tested first.
        label = F.when(value >= edge, F.lit(name)).otherwise(label)
    return label


def ordinal(code: Column, highest: int) -> Column:
    """A one-digit code 0..``highest`` as a number; every other code gives null."""
    return F.when(code.isin([str(n) for n in range(highest + 1)]), code.try_cast("int"))


def is_code(code: Column, wanted: str) -> Column:
    """True for exactly ``wanted``; false for every other code and for null."""
    return code.eqNullSafe(F.lit(wanted))
