"""Monthly series: cleaning, gap-free months, publication lags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.fixed_values import DELIVERY_COLUMNS, SERIES_KEY, SERIES_PREFIX
from duebook.functions.calendar import month_from_text, months_from_to
from duebook.operators.columns import lower_names, stack_labelled
from duebook.operators.matching import newest_per_key

_RAW = ("KEY", "TIME_PERIOD", "OBS_VALUE", "OBS_STATUS", *DELIVERY_COLUMNS)


def clean_series(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Stack raw series tables (name -> table) into typed observations.

    Grain: one row per series and period text; a later delivery replaces an earlier one. Periods
    that are not months and values that are not numbers become null and are left to the rules.
    """
    shaped = {
        name: lower_names(df.select(*_RAW), {"key": "series_key"}) for name, df in raw.items()
    }
    period = F.col("time_period").cast("string")
    typed = stack_labelled(shaped, "series").withColumns(
        {
            "time_period": period,
            "period_month": month_from_text(period),
            "obs_value": F.col("obs_value").try_cast("double"),
        }
    )
    return newest_per_key(typed, SERIES_KEY).select(
        "series",
        "period_month",
        "obs_value",
        "obs_status",
        "time_period",
        "series_key",
        *DELIVERY_COLUMNS,
    )


def month_spine(df: DataFrame, month: str, name: str = "month") -> DataFrame:
    """All months from the first to the last ``month`` of ``df``. Grain: one row per month."""
    ends = df.agg(F.min(month).alias("_first"), F.max(month).alias("_last"))
    return ends.select(F.explode(months_from_to(F.col("_first"), F.col("_last"))).alias(name))


def lagged_series(
    observations: DataFrame,
    lags: Mapping[str, int],
    prefix: str = SERIES_PREFIX,
    series: str = "series",
    period: str = "period_month",
    value: str = "obs_value",
) -> DataFrame:
    """Wide monthly table of the series as they were known in each month.

    Grain: one row per month, from the first to the last month in which anything is published.
    An observation of period P is known from month P + lag on and stays the latest one until the
    next is published; series without a lag are left out. Every observation is spread over the
    months it is the latest in, so no inequality join is needed, and observations are combined
    by series and month first, so a series has at most as many rows as there are months.
    """
    lag = F.create_map(*(F.lit(x) for pair in lags.items() for x in pair))[F.col(series)]
    published = (
        observations.where(F.col(series).isin(*lags))
        .groupBy(F.col(series).alias("_series"), F.add_months(period, lag).alias("_known_from"))
        # One group holds one period of one series. Of several values the largest counts, so the
        # result does not depend on row order.
        .agg(F.max(value).alias("_value"))
        .where("_known_from IS NOT NULL")
    )
    until_next = F.add_months(
        F.lead("_known_from").over(Window.partitionBy("_series").orderBy("_known_from")), -1
    )
    last_known = published.agg(F.max("_known_from")).scalar()
    months = months_from_to(F.col("_known_from"), F.ifnull("_until", last_known))
    wide = (
        published.withColumn("_until", until_next)
        .withColumn("month", F.explode(months))
        .groupBy("month")
        .pivot("_series", list(lags))
        .agg(F.max("_value"))
    )
    return wide.select("month", *(F.col(name).alias(prefix + name) for name in lags))
