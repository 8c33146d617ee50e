"""The cleaned tables, each built from its ``TableSpec`` by one chain of operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.fixed_values import (
    AMOUNT,
    ANCHOR_DAY,
    BLANK_TOKENS,
    BUREAU_CLOSED,
    BUREAU_HIGHEST_BUCKET,
    BUREAU_UNKNOWN,
    DELIVERY_COLUMNS,
    SERIES_LAG_MONTHS,
    TABLES,
    TableSpec,
)
from duebook.functions.calendar import day_at, month_at
from duebook.functions.codes import is_code, ordinal
from duebook.operators.columns import (
    blank_to_null,
    lead_with,
    lower_names,
    retype,
    sentinel_to_null,
    stack_labelled,
)
from duebook.operators.matching import mark_known, newest_per_key
from duebook.operators.series import clean_series


def tidy_rows(spec: TableSpec, raw: Mapping[str, DataFrame]) -> DataFrame:
    """Clean delivered rows one by one.

    Grain: one row per delivered row, so a key delivered again appears again. Only projections:
    runs on batch and streaming input alike. Columns of the spec that the input lacks are skipped.
    """
    frames = {spec.raw[0] == name: raw[name] for name in spec.raw}
    df = stack_labelled(frames, spec.source_flag) if spec.source_flag else raw[spec.raw[0]]
    df = lower_names(df, spec.renames)
    if spec.blank_tokens:
        df = blank_to_null(df, BLANK_TOKENS)
    if spec.sentinels:
        df = sentinel_to_null(df, {c: v for c, v in spec.sentinels.items() if c in df.columns})
    wanted = {
        "bigint": spec.longs,
        AMOUNT: spec.amounts,
        "int": spec.ints,
        "string": spec.strings,
    }
    have = set(df.columns)
    df = retype(df, {dtype: [c for c in names if c in have] for dtype, names in wanted.items()})
    derived = {
        name: day_at(F.col(offset), ANCHOR_DAY)
        for name, offset in spec.day_columns.items()
        if offset in have
    }
    if spec.month_offset:
        derived["month"] = month_at(F.col(spec.month_offset), ANCHOR_DAY)
    if spec.status:
        derived |= status_columns(spec.status)
    if derived:
        df = df.withColumns(derived)
    return lead_with(df, spec.leading) if spec.leading else df


def status_columns(status: str) -> dict:
    """Bucket and flags of a monthly bureau status; other codes get a null bucket, no flag."""
    code = F.col(status)
    return {
        "dpd_bucket": ordinal(code, BUREAU_HIGHEST_BUCKET),
        "is_closed": is_code(code, BUREAU_CLOSED),
        "is_unknown": is_code(code, BUREAU_UNKNOWN),
    }


def business_columns(spec: TableSpec, raw: Mapping[str, DataFrame]) -> list[str]:
    """Cleaned names of the delivered columns, without the delivery columns."""
    names = {c.lower(): None for name in spec.raw for c in raw[name].columns}
    return [spec.renames.get(c, c) for c in names if c not in DELIVERY_COLUMNS]


def tidy_table(name: str, raw: Mapping[str, DataFrame], parent: DataFrame | None = None) -> DataFrame:
    """One cleaned table.

    Grain: one row per key of its spec (the newest delivery); without a key, one row per distinct
    business row, compared after the casts. ``parent`` is the cleaned parent table, if any.
    """
    spec = TABLES[name]
    keys = list(spec.key) or business_columns(spec, raw)
    df = newest_per_key(tidy_rows(spec, raw), keys)
    if spec.parent:
        _, key, flag = spec.parent
        df = mark_known(df, parent, key, flag)
    return df


def tidy_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All cleaned tables, parents before children. ``raw`` also holds the series tables."""
    done: dict[str, DataFrame] = {}
    for name, spec in TABLES.items():
        done[name] = tidy_table(name, raw, done[spec.parent[0]] if spec.parent else None)
    done["macro_observation"] = clean_series({s: raw[s] for s in SERIES_LAG_MONTHS if s in raw})
    return done
