"""Invariants of finished tables. Every check returns counts or offending rows, never raises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.fixed_values import VALID_FROM, VALID_TO
from duebook.operators.columns import stack_labelled
from duebook.operators.matching import same_keys, shadowed, without_match


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Grain: one row per repeated key, with ``copies``."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and rows of repeated keys. Grain: one row."""
    copies = df.groupBy(*keys).agg(F.count("*").alias("_copies"))
    return copies.agg(
        F.sum("_copies").alias("rows"),
        F.count("*").alias("keys"),
        F.count_if(F.col("_copies") > 1).alias("repeated"),
    )


def coverage(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables side by side. Grain: one row per table."""
    return stack_labelled(
        {name: df.agg(F.count("*").alias("rows")) for name, df in parts.items()}, "part"
    ).select("part", "rows")


def keys_covered(output: DataFrame, sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Keys of ``output`` against the distinct union of the keys of its sources.

    Grain: one row: ``output_keys``, ``source_keys``, ``only_output``, ``only_source``.
    """
    sides = [(output, "_output")] + [(s, "_source") for s in sources]
    tagged = [
        df.select(
            *keys,
            *(F.lit(name == side).alias(name) for name in ("_output", "_source")),
        )
        for df, side in sides
    ]
    # One group per key replaces a distinct per source and a join: flags tell who has the key.
    seen = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy(*keys)
        .agg(F.bool_or("_output").alias("_output"), F.bool_or("_source").alias("_source"))
    )
    return seen.agg(
        F.count_if("_output").alias("output_keys"),
        F.count_if("_source").alias("source_keys"),
        F.count_if(F.col("_output") & ~F.col("_source")).alias("only_output"),
        F.count_if(F.col("_source") & ~F.col("_output")).alias("only_source"),
    )


def orphan_count(df: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a parent. Grain: one row."""
    return without_match(df, parent, keys).agg(F.count("*").alias("orphans"))


def sums_preserved(
    before: DataFrame, after: DataFrame, pairs: Mapping[str, tuple[Column, Column]]
) -> DataFrame:
    """Totals before and after an aggregation.

    Grain: one row per total; ``pairs`` maps a name to its expression on either side.
    """

    def long(df: DataFrame, side: int) -> DataFrame:
        sums = df.agg(*(F.sum(p[side]).cast("decimal(38,3)").alias(n) for n, p in pairs.items()))
        rows = (F.struct(F.lit(n).alias("total"), F.col(n).alias("_sum")) for n in pairs)
        return sums.select(F.inline(F.array(*rows)))

    left = long(before, 0).withColumnRenamed("_sum", "before")
    right = long(after, 1).withColumnRenamed("_sum", "after")
    return left.join(right, "total").withColumn("same", F.col("before").eqNullSafe(F.col("after")))


def flag_recomputed(
    table: DataFrame, recomputed: DataFrame, keys: Sequence[str], flag: str, start: str, month: str
) -> DataFrame:
    """Stored flags against values computed again from the source.

    Grain: one row: wrong flags, wrong starts, wrong maxima, flagged rows. ``recomputed`` has the
    keys, ``expected_max`` and ``expected_flag``.
    """
    joined = table.join(recomputed, list(keys), "left")
    bad_start = (F.col(flag) != F.col(start).isNotNull()) | (F.col(start) > F.col(month))
    return joined.agg(
        F.count_if(F.col(flag) != F.ifnull("expected_flag", F.lit(False))).alias("wrong_flag"),
        F.count_if(F.ifnull(bad_start, F.lit(False))).alias("wrong_start"),
        F.count_if(~F.col("max_dpd").eqNullSafe(F.col("expected_max"))).alias("wrong_max"),
        F.count_if(flag).alias("flagged"),
    )


def broken_episodes(
    table: DataFrame,
    key: str = "sk_id_curr",
    month: str = "month",
    flag: str = "default_flag",
    start: str = "default_start_month",
) -> DataFrame:
    """Flagged months whose start does not continue the flagged month before, or open a new run.

    Grain: the offending rows. Each month is joined to the one before it by shifting the key.
    """
    before = table.where(flag).select(
        key, F.add_months(month, 1).alias(month), F.col(start).alias("_start_before")
    )
    joined = table.where(flag).join(before, [key, month], "left")
    expected = F.ifnull("_start_before", month)
    return joined.where(~F.col(start).eqNullSafe(expected)).select(*table.columns)


def version_problems(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Problems of a version history.

    Grain: one row: keys, versions, keys without exactly one open version, intervals that do not
    meet the next one, intervals of no length. The meeting of intervals is a join of each end
    with the start of the next version, so a key with many versions needs no window of its own.
    """
    open_ends = versions.groupBy(*keys).agg(F.count_if(F.col(VALID_TO).isNull()).alias("_open"))
    per_key = open_ends.agg(
        F.count("*").alias("keys"), F.count_if(F.col("_open") != 1).alias("not_one_open")
    )
    starts = versions.select(*keys, F.col(VALID_FROM).alias("_at"), F.lit(1).alias("_starts"))
    ends = versions.where(F.col(VALID_TO).isNotNull()).select(
        *keys, F.col(VALID_TO).alias("_at"), F.lit(1).alias("_ends")
    )
    # Every end must be the start of exactly one version; all starts but the first have an end.
    borders = (
        starts.unionByName(ends, allowMissingColumns=True)
        .groupBy(*keys, "_at")
        .agg(F.count("_starts").alias("_starts"), F.count("_ends").alias("_ends"))
        .groupBy(*keys)
        .agg(
            F.count_if((F.col("_ends") > 0) & (F.col("_starts") != F.col("_ends"))).alias("_gaps"),
            F.count_if((F.col("_starts") > 0) & (F.col("_ends") == 0)).alias("_firsts"),
        )
        .agg(F.sum(F.col("_gaps") + F.abs(F.col("_firsts") - 1)).alias("not_meeting"))
    )
    lengths = versions.agg(
        F.count("*").alias("versions"),
        F.count_if(F.col(VALID_TO) <= F.col(VALID_FROM)).alias("no_length"),
    )
    return lengths.select(
        per_key.select("keys").scalar().alias("keys"),
        "versions",
        per_key.select("not_one_open").scalar().alias("not_one_open"),
        borders.scalar().alias("not_meeting"),
        "no_length",
    )


def open_versions_match(
    versions: DataFrame, table: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Open versions against the current table. Grain: one row: table, open and matching rows."""
    current = versions.where(F.col(VALID_TO).isNull())
    compared = [*keys, *tracked]
    matching = table.join(
        shadowed(current.select(*compared), compared), same_keys(compared), "left_semi"
    )
    return table.agg(F.count("*").alias("table_rows")).select(
        "table_rows",
        current.agg(F.count("*")).scalar().alias("open_rows"),
        matching.agg(F.count("*")).scalar().alias("matching_rows"),
    )


def gapless(df: DataFrame, group: str, month: str) -> DataFrame:
    """Months and span of months per group. Grain: one row per group."""
    first, last = F.min(month), F.max(month)
    span = (F.months_between(last, first) + 1).cast("bigint")
    return df.groupBy(group).agg(
        F.count("*").alias("observations"),
        span.alias("months"),
        (F.count("*") == span).alias("is_gapless"),
    )


def lag_shift(
    observations: DataFrame, wide: DataFrame, lags: Mapping[str, int], prefix: str
) -> DataFrame:
    """Observations against the wide month they must appear in (period + lag).

    Grain: one row per series: ``compared``, ``mismatches``.
    """
    names = list(lags)
    lag = F.create_map(*(F.lit(x) for pair in lags.items() for x in pair))[F.col("series")]
    long = wide.select(
        "month",
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(n).alias("series"), F.col(prefix + n).alias("shown"))
                    for n in names
                )
            )
        ),
    )
    return (
        observations.where(F.col("series").isin(*names))
        .withColumn("month", F.add_months("period_month", lag))
        .join(long, ["series", "month"])
        .groupBy("series")
        .agg(
            F.count("*").alias("compared"),
            F.count_if(~F.col("shown").eqNullSafe(F.col("obs_value"))).alias("mismatches"),
        )
    )


def attached_equal(
    table: DataFrame, source: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Attached columns against their source. Grain: one row: rows, covered and equal rows."""
    # The attached values repeat per key, so distinct combinations are counted before the join.
    combos = table.groupBy(key, *columns).agg(F.count("*").alias("_n"))
    shown = source.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    n = F.col("_n")
    present = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    equal = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns))
    return combos.join(shown, key, "left").agg(
        F.sum(n).alias("rows"),
        F.sum(F.when(present, n).otherwise(0)).alias("covered"),
        F.sum(F.when(equal, n).otherwise(0)).alias("equal"),
    )


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows only in ``a`` and only in ``b``, copies counted. Grain: one row.

    Copies are counted per distinct row before anything is compared, so a row with very many
    copies travels as one row per task.
    """
    b = b.select(*a.columns)
    both = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    surplus = both.groupBy(*a.columns).agg(F.sum("_n").alias("_n"))
    return surplus.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 0, F.col("_n"))), F.lit(0)).alias("only_first"),
        F.coalesce(F.sum(F.when(F.col("_n") < 0, -F.col("_n"))), F.lit(0)).alias("only_second"),
    )


def tables_with_column(tables: Mapping[str, DataFrame], column: str) -> dict[str, bool]:
    """Which of the tables have ``column`` (from their schemas; nothing is read)."""
    return {name: column in df.columns for name, df in tables.items()}
