"""Calendar arithmetic on day and month offsets. Months are the DATE of their first day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_at(offset: Column, anchor: date) -> Column:
    """The day ``offset`` days from ``anchor``; fractions round down, null stays null."""
    return F.dateadd(F.lit(anchor), F.floor(offset).cast("int"))


def month_at(offset: Column, anchor: date) -> Column:
    """The month ``offset`` months from the month of ``anchor``."""
    return F.add_months(F.lit(anchor.replace(day=1)), offset.cast("int"))


def month_of(day: Column | str) -> Column:
    """The month that holds ``day``."""
    return F.trunc(day, "month")


def months_from_to(first: Column, last: Column) -> Column:
    """Array of all months from the month of ``first`` to the month of ``last``, both included."""
    return F.sequence(month_of(first), month_of(last), F.make_ym_interval(F.lit(0), F.lit(1)))


def month_from_text(text: Column) -> Column:
    """Month of a ``yyyy-MM`` text; quarters, days and anything else give null."""
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM")))
