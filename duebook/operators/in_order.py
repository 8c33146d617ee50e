"""Row order within a key, safe for keys that hold a large share of all rows.

A window partitioned by a key puts all rows of that key in one task. The operators here cut the
rows of a hot key into consecutive parts at quantiles of the order column, run the window inside
the parts, and carry the values across part borders with one small row per part. Results are the
same with and without cuts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.operators.matching import same_keys, shadowed
from duebook.session import settle_down

# A key is hot when it holds more rows than FLOOR and more than 1/SHARE of all rows. So there are
# fewer than SHARE hot keys and at most 2 * SHARE parts, whatever the size of the data: the cut
# table and the border rows can be broadcast.
FLOOR = 1_000_000
SHARE = 20_000


@dataclass(frozen=True)
class Cuts:
    """Cut points of the hot keys: one row per hot key with an ascending array ``_cuts``."""

    keys: tuple[str, ...]
    on: str
    table: DataFrame

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of ordinary keys and rows of hot keys."""
        hot = F.broadcast(shadowed(self.table.select(*self.keys), self.keys))
        same = same_keys(self.keys)
        return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")

    def tag(self, df: DataFrame) -> DataFrame:
        """Add ``_part``, the number of the part a row of a hot key belongs to."""
        below = F.size(F.filter("_cuts", lambda cut: cut < F.col(self.on)))
        return _lookup(df, self.table, self.keys).withColumn("_part", below).drop("_cuts")


def _lookup(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a broadcast table of bounded size on null-safe keys."""
    joined = df.join(F.broadcast(shadowed(small, keys)), same_keys(keys), "left")
    return joined.drop(*(f"_k_{k}" for k in keys))


def cuts_for_hot_keys(
    df: DataFrame, keys: Sequence[str], on: str, floor: int = FLOOR, share: int = SHARE
) -> Cuts | None:
    """Find the hot keys of ``df`` and cut their rows by quantiles of the column ``on``.

    Returns None when no key is hot. Rows that are equal in ``on`` stay in one part, so ``on``
    should be (nearly) unique within a key.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    rows, top = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    limit = max(floor, (rows or 0) // share)
    if not rows or top <= limit:
        return None
    hot = counts.where(F.col("_rows") > limit)
    steps = ceil(top / limit)
    quantiles = [step / steps for step in range(1, steps)]
    # Every stride-th quantile is enough for a hot key smaller than the largest one.
    stride = F.greatest(F.lit(1), F.floor(F.lit(steps) / F.ceil(F.col("_rows") / limit)))
    picked = F.filter("_cuts", lambda _, i: (i + 1) % stride == 0)
    names = [f.name for f in df.schema if f.name in keys]
    table = (
        _lookup(df.select(*names, on), hot, names)
        .where("_rows IS NOT NULL")
        .groupBy(*names)
        .agg(
            F.first("_rows").alias("_rows"),
            F.percentile_approx(on, quantiles, max(10_000, 10 * steps)).alias("_cuts"),
        )
        .withColumn("_cuts", F.array_distinct(picked))
        .drop("_rows")
    )
    # The cuts are approximate: pinned as literal rows, so all uses agree on the parts.
    pinned = df.sparkSession.createDataFrame(table.collect(), table.schema)
    return Cuts(tuple(names), on, pinned)


def per_heat(
    df: DataFrame,
    keys: Sequence[str],
    on: str,
    hot_rows: int | None,
    build: Callable[[DataFrame, Cuts | None], DataFrame],
) -> DataFrame:
    """Apply ``build`` to ordinary keys as they are, and to hot keys with their cuts.

    ``hot_rows`` is the least size of a hot key; None means that there are none, which saves the
    pass that looks for them.
    """
    cuts = None if hot_rows is None else cuts_for_hot_keys(df, keys, on, floor=hot_rows)
    if cuts is None:
        return build(df, None)
    ordinary, hot = cuts.split(df)
    return build(ordinary, None).unionByName(build(hot, cuts))


def _inside(keys: Sequence[str], cuts: Cuts | None, order: Sequence[str]):
    parts = ["_part"] if cuts else []
    return Window.partitionBy(*keys, *parts).orderBy(*order)


def _fill(
    df: DataFrame, borders: DataFrame, keys: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Fill nulls of ``names`` with the values ``_<name>`` carried over the part borders."""
    carried = borders.select(*keys, "_part", *(f"_{n}" for n in names))
    filled = {n: F.coalesce(n, f"_{n}") for n in names}
    return _lookup(df, carried, [*keys, "_part"]).withColumns(filled).drop(*map("_{}".format, names))


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    before: str,
    after: str,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add ``value`` of the previous row (``before``) and of the next row (``after``) of the key.

    ``value`` must not be null (wrap it in a struct), so null means that there is no neighbour.
    With ``cuts``, all keys of ``df`` must be hot ones. Grain: unchanged.
    """
    tagged = (cuts.tag(df) if cuts else df).withColumn("_value", value)
    inside = _inside(keys, cuts, order)
    out = tagged.withColumns(
        {before: F.lag("_value").over(inside), after: F.lead("_value").over(inside)}
    ).drop("_value")
    if cuts:
        # Written once: the rows at the part ends are then a cheap filter, not a second sort.
        out = settle_down(out, "parts")
        ends = out.where(F.col(before).isNull() | F.col(after).isNull())
        borders = ends.groupBy(*keys, "_part").agg(
            F.first(F.when(F.col(before).isNull(), value), True).alias("_low"),
            F.first(F.when(F.col(after).isNull(), value), True).alias("_high"),
        )
        parts = Window.partitionBy(*keys).orderBy("_part")
        borders = borders.withColumns(
            {f"_{before}": F.lag("_high").over(parts), f"_{after}": F.lead("_low").over(parts)}
        )
        out = _fill(out, borders, keys, [before, after])
    return out.drop("_part")


def with_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    marker: Column,
    name: str,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add the latest non-null ``marker`` of the key up to and including the row itself.

    With ``cuts``, all keys of ``df`` must be hot ones. Grain: unchanged.
    """
    tagged = (cuts.tag(df) if cuts else df).withColumn("_marker", marker)
    inside = _inside(keys, cuts, order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = tagged.withColumn(name, F.last("_marker", ignorenulls=True).over(so_far))
    if cuts:
        is_end = F.lead(F.lit(1)).over(inside).isNull()
        out = settle_down(out.withColumn("_end", is_end), "parts")
        earlier = (
            Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        )
        borders = out.where("_end").select(
            *keys, "_part", F.last(name, ignorenulls=True).over(earlier).alias(f"_{name}")
        )
        out = _fill(out, borders, keys, [name])
    return out.drop("_marker", "_part", "_end")


# Copies of one row that are written out at once, in one task.
COPIES = 10_000


def _each_copy(df: DataFrame) -> DataFrame:
    """The rows of ``df`` with two hashes of the whole row and a number ``_copy`` among equal rows.

    The numbers do not depend on how rows were spread. Rows are counted first, with a combine in
    each task; of a row with very many copies, lots of copies are written out by different tasks.
    """
    names = df.columns
    counted = df.groupBy(*names).agg(F.count("*").alias("_copies"))
    hashed = counted.withColumns({"_h1": F.xxhash64(*names), "_h2": F.xxhash64(F.lit(1), *names)})
    few = hashed.where(F.col("_copies") <= COPIES)
    few = few.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")))
    lots = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / COPIES))
    many = hashed.where(F.col("_copies") > COPIES).withColumn("_lot", F.explode(lots))
    last = F.least((F.col("_lot") + 1) * COPIES, F.col("_copies"))
    many = many.repartition("_h1", "_lot").withColumn(
        "_copy", F.explode(F.sequence(F.col("_lot") * COPIES + 1, last))
    )
    return few.unionByName(many.drop("_lot")).drop("_copies")


def numbered(df: DataFrame, order: Sequence[Column], name: str = "_position") -> DataFrame:
    """Number all rows 0, 1, 2, ... in a global order without a global window.

    Rows are range-partitioned by ``order``, numbered inside the partitions, and shifted by the
    sizes of the earlier partitions (one number per partition goes through the driver). Ties are
    ordered by hashes of the whole row and equal rows by their number among each other: the
    result is the same however rows were spread, also when a lost task is repeated, and many
    copies of one row do not meet in one task. Columns must be ones that can be grouped by.
    """
    local_bits = 33  # low bits of monotonically_increasing_id count rows within a partition
    ties = ("_h1", "_h2", "_copy")
    ranged = (
        _each_copy(df)
        .repartitionByRange(*order, *ties)
        .sortWithinPartitions(*order, *ties)
        .withColumn("_slot", F.monotonically_increasing_id())
        .drop(*ties)
    )
    # Written once: every use below has to see the same partition of a row.
    pinned = settle_down(ranged, "numbered").withColumns(
        {
            "_chunk": F.shiftright("_slot", local_bits),
            "_local": F.col("_slot").bitwiseAND((1 << local_bits) - 1),
        }
    )
    sizes = pinned.groupBy("_chunk").count().orderBy("_chunk").collect()
    offsets, total = [], 0
    for chunk, count in sizes:
        offsets.append((chunk, total))
        total += count
    starts = df.sparkSession.createDataFrame(offsets, "_chunk BIGINT, _start BIGINT")
    return (
        pinned.join(F.broadcast(starts), "_chunk")
        .withColumn(name, F.col("_start") + F.col("_local"))
        .drop("_chunk", "_local", "_slot", "_start")
    )
