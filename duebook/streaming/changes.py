"""Version history kept from a stream of deliveries, at the cost of what arrives.

Row windows do not run on streams, so every micro-batch is handled as a table. What a batch needs of
the past is one row per key: the open version (``open``). Deliveries later than the last one of
their key only continue or close that version. A delivery that comes late re-opens its key from
the start of the version it falls into: closed versions from there on are cut, and only deliveries from
there on are read from the log.

Below ``folder``: ``log`` (deliveries), ``open`` (the open versions of a bucket of keys, rewritten by the
batches that touch it), ``closed`` (closed versions), ``cuts`` (from where on earlier closed
versions of a key no longer hold), ``base`` (closed versions after compaction), ``done`` and
``schema``. Every batch writes folders of its own number and reads those of earlier batches, so
a repeated batch overwrites its own folders and nothing is counted twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.fixed_values import DELIVERY_COLUMNS, VALID_FROM, VALID_TO, Rule
from duebook.operators.history import build_versions
from duebook.operators.in_order import FLOOR
from duebook.operators.matching import same_keys, shadowed
from duebook.operators.rules import BrokenRules, holds, of_action
from duebook.session import path_exists, remove_folder, settle_down, subfolders, with_columns

BATCH = "_batch"
BUCKET = "_bucket"
_SINCE = "_since"


class VersionedStream:
    """Maintains the history of ``keys`` below ``folder``."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        keys: Sequence[str],
        sequence: str = "_ingested_at",
        untracked: Iterable[str] = DELIVERY_COLUMNS,
        rules: Iterable[Rule] = (),
        buckets: int = 64,
        newest_first: Sequence[Column] | None = None,
        hot_rows: int | None = FLOOR,
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.keys = list(keys)
        self.sequence = sequence
        self.untracked = list(untracked)
        self.rules = list(rules)
        self.buckets = buckets
        self.newest_first = newest_first
        self.hot_rows = hot_rows
        self._schema: StructType | None = None

    def run(self, changes: DataFrame) -> None:
        """Process what the stream ``changes`` has and stop. Raises on a broken fail rule."""
        self._schema = changes.schema
        if not path_exists(self.spark, f"{self.folder}/schema"):
            doc = self.spark.createDataFrame([(changes.schema.json(),)], "doc STRING")
            doc.coalesce(1).write.json(f"{self.folder}/schema")
        query = (
            changes.writeStream.foreachBatch(self._batch)
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def versions(self) -> DataFrame:
        """Grain: one row per key and version, as of the last batch that came to its end."""
        last = max(self._numbers("done"), default=-1)
        every = [*range(self.buckets)]
        open_ = self._open(every, last)
        return self._closed(last).drop(BATCH, BUCKET).unionByName(open_)

    def compact(self) -> None:
        """Fold the closed versions and cuts of all batches so far into one folder by bucket."""
        last = max(self._numbers("done"), default=-1)
        if last < 0 or last in self._numbers("base"):
            return
        self._write(self._closed(last).drop(BATCH), "base", last)
        for part in ("closed", "cuts"):
            for number in self._numbers(part):
                if number <= last:
                    remove_folder(self.spark, f"{self.folder}/{part}/{BATCH}={number}")
        for number in self._numbers("base"):
            if number < last:
                remove_folder(self.spark, f"{self.folder}/base/{BATCH}={number}")

    # What a batch does

    def _batch(self, batch: DataFrame, number: int) -> None:
        self._log(batch, number)
        arrived = self._read("log", self._columns()).where(F.col(BATCH) == number).drop(BATCH)
        # At most ``buckets`` numbers: they name the folders that can hold the keys.
        touched = [row[0] for row in arrived.select(BUCKET).distinct().collect()]
        if touched:
            self._apply(arrived.drop(BUCKET), touched, number)
        done = self.spark.createDataFrame([(number,)], "number BIGINT").coalesce(1)
        done.write.mode("overwrite").json(f"{self.folder}/done/{BATCH}={number}")

    def _log(self, batch: DataFrame, number: int) -> None:
        """Write the batch's rows that rules let through; stop at a broken fail rule."""
        stopping = of_action(self.rules, "fail")
        seen = Observation()
        broken = [F.count_if(~holds(rule)).alias(rule.name) for rule in stopping]
        kept = batch.observe(seen, F.count(F.lit(1)).alias("_rows"), *broken)
        for rule in of_action(self.rules, "drop"):
            kept = kept.where(holds(rule))
        self._write(kept.withColumn(BUCKET, self._bucket()), "log", number)
        # A batch that stops here is tried again under the same number and overwrites its folder.
        found = {rule.name: seen.get[rule.name] for rule in stopping}
        if any(found.values()):
            raise BrokenRules({name: count for name, count in found.items() if count})

    def _apply(self, arrived: DataFrame, touched: list[int], number: int) -> None:
        same = same_keys(self.keys)
        at = F.col(self.sequence)
        current = self._open(touched, number - 1)
        last = self._beside(
            current.select(*self.keys, at.alias("_last"), F.col(VALID_FROM).alias(_SINCE)).withColumn(
                "_known", F.lit(True)
            )
        )
        placed = arrived.join(last, same, "left")
        late = placed.where(F.col("_known") & ~F.ifnull(at > F.col("_last"), F.lit(False)))
        late = settle_down(
            late.groupBy(*self.keys).agg(
                F.when(F.count_if(at.isNull()) == 0, F.min(at)).alias("_first")
            ),
            "late",
        )
        again = self._beside(late.select(*self.keys))
        on_time = arrived.join(again, same, "left_anti")
        arrived_keys = self._beside(on_time.select(*self.keys).distinct())
        going_on = current.join(arrived_keys, same, "left_semi").select(*arrived.columns)
        built = self._build(on_time.unionByName(going_on)).join(last, same, "left")
        # The open version goes on: it began where it began, not at its last delivery.
        began = F.when(F.col(VALID_FROM) == F.col("_last"), F.col(_SINCE)).otherwise(F.col(VALID_FROM))
        fresh = built.withColumn(VALID_FROM, began).select(*arrived.columns, VALID_FROM, VALID_TO)
        if not late.isEmpty():
            fresh = fresh.unionByName(self._reopened(late, current, number))
        fresh = settle_down(fresh.withColumn(BUCKET, self._bucket()), "versions")
        self._write(fresh.where(F.col(VALID_TO).isNotNull()), "closed", number)
        # Exactly one version of each key is open, so these are all keys of the batch.
        opened = fresh.where(F.col(VALID_TO).isNull())
        others = current.join(self._beside(opened.select(*self.keys)), same, "left_anti")
        whole = opened.unionByName(others.withColumn(BUCKET, self._bucket()))
        (
            whole.withColumn(BATCH, F.lit(number))
            .hint("rebalance", BUCKET)  # few files per bucket, and several for a large one
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET, BATCH)
            .parquet(f"{self.folder}/open")
        )

    def _reopened(self, late: DataFrame, current: DataFrame, number: int) -> DataFrame:
        """Versions of the keys in ``late``, from the start of the one the first late delivery is in.

        Writes from where on their earlier closed versions no longer hold.
        """
        same = same_keys(self.keys)
        buckets = [r[0] for r in late.select(self._bucket()).distinct().collect()]
        closed = self._closed(number - 1).where(F.col(BUCKET).isin(buckets))
        spans = closed.select(*self.keys, VALID_FROM).unionByName(current.select(*self.keys, VALID_FROM))
        before = spans.join(self._beside(late), same).where(F.col(VALID_FROM) < F.col("_first"))
        starts = before.groupBy(*self.keys).agg(F.max(VALID_FROM).alias("_from"))
        starts = late.join(self._beside(starts), same, "left").select(*self.keys, "_from")
        # No start: the delivery is earlier than all versions, and everything of the key is read.
        self._write(starts.withColumn(BUCKET, self._bucket()), "cuts", number)
        cuts = self._read("cuts", self._cut_columns()).where(F.col(BATCH) == number)
        least, from_first = cuts.agg(F.min("_from"), F.bool_or(F.col("_from").isNull())).first()
        log = self._read("log", self._columns()).where(
            (F.col(BATCH) <= number) & F.col(BUCKET).isin(buckets)
        )
        if not from_first:
            # Reaches the scan: files and row groups of older deliveries are skipped.
            log = log.where(F.col(self.sequence) >= F.lit(least))
        held = F.col("_from").isNull() | (F.col(self.sequence) >= F.col("_from"))
        rows = log.drop(BATCH, BUCKET).join(self._beside(cuts.drop(BATCH, BUCKET)), same).where(held)
        return self._build(rows.select(*self._schema.names))

    def _build(self, deliveries: DataFrame) -> DataFrame:
        return build_versions(
            deliveries, self.keys, self.sequence, self.untracked, self.newest_first, self.hot_rows
        )

    # What is stored

    def _open(self, buckets: Sequence[int], upto: int) -> DataFrame:
        """Open versions of some buckets, from the newest batch up to ``upto`` that wrote each."""
        paths = []
        for bucket in buckets:
            root = f"{self.folder}/open/{BUCKET}={bucket}"
            numbers = [_number(name) for name in subfolders(self.spark, root)]
            newest = max((n for n in numbers if n <= upto), default=None)
            if newest is not None:
                paths.append(f"{root}/{BATCH}={newest}")
                for number in numbers:
                    if number < newest - 1:  # no batch can be repeated that far back
                        remove_folder(self.spark, f"{root}/{BATCH}={number}")
        schema = with_columns(self._delivered(), self._span())
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _closed(self, upto: int) -> DataFrame:
        """Closed versions that hold after batch ``upto``, with the batch that wrote them."""
        columns = with_columns(self._delivered(), f"{self._span()}, {BATCH} BIGINT, {BUCKET} INT")
        base = max((n for n in self._numbers("base") if n <= upto), default=-1)
        span = F.col(BATCH).between(base + 1, upto)
        rows = self._read("closed", columns).where(span)
        if base >= 0:
            rows = rows.unionByName(self._read("base", columns).where(F.col(BATCH) == base))
        cuts = self._read("cuts", self._cut_columns()).where(span)
        cuts = self._beside(cuts.drop(BUCKET).withColumnRenamed(BATCH, "_cut_in"))
        gone = F.col("_from").isNull() | F.ifnull(F.col(VALID_FROM) >= F.col("_from"), F.lit(False))
        return rows.join(cuts, same_keys(self.keys) & (F.col(BATCH) < F.col("_cut_in")) & gone, "left_anti")

    def _write(self, df: DataFrame, part: str, number: int) -> None:
        """Write a batch's own folder, by bucket."""
        target = f"{self.folder}/{part}/{BATCH}={number}"
        df.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(target)

    def _read(self, part: str, schema: StructType) -> DataFrame:
        if not subfolders(self.spark, f"{self.folder}/{part}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{part}")

    def _numbers(self, part: str) -> list[int]:
        """Numbers of the batches whose folder in ``part`` was written to its end."""
        root = f"{self.folder}/{part}"
        names = subfolders(self.spark, root)
        return [_number(n) for n in names if path_exists(self.spark, f"{root}/{n}/_SUCCESS")]

    def _beside(self, df: DataFrame) -> DataFrame:
        """``df`` for a join with ``same_keys``, both sides shuffled.

        It grows with the keys, and files small enough to broadcast make many rows for the driver.
        """
        return shadowed(df, self.keys).hint("merge")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _delivered(self) -> StructType:
        if self._schema is None:
            kept = self.spark.read.schema("doc STRING").json(f"{self.folder}/schema").first()
            self._schema = StructType.fromJson(json.loads(kept.doc))
        return self._schema

    def _span(self) -> str:
        at = self._delivered()[self.sequence].dataType.simpleString()
        return f"{VALID_FROM} {at}, {VALID_TO} {at}"

    def _columns(self) -> StructType:
        return with_columns(self._delivered(), f"{BATCH} BIGINT, {BUCKET} INT")

    def _cut_columns(self) -> StructType:
        kinds = self._delivered()
        at = kinds[self.sequence].dataType.simpleString()
        keys = StructType([kinds[k] for k in self.keys])
        return with_columns(keys, f"_from {at}, {BATCH} BIGINT, {BUCKET} INT")


def _number(name: str) -> int:
    return int(name.rsplit("=", 1)[1])
