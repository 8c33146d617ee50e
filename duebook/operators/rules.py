"""Quality rules: counting, quarantine, stopping, and the report over many updates.

A rule is a named SQL condition with an action. A condition that is null counts as broken, for
every action. All rules see the same input rows, before anything is dropped.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from duebook.fixed_values import Rule
from duebook.session import scratch_folder, with_columns

BROKEN = "_failed_rules"
REPORT_KEY = ("update_id", "dataset", "expectation")

# Where an event holds its counters, and their shape.
_COUNTERS_PATH = "$.flow_progress.data_quality.expectations"
_COUNTERS = "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"


class BrokenRules(Exception):
    """Rows broke rules that stop the update; ``counts`` maps rule name to broken rows."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(", ".join(f"{name}: {n} rows" for name, n in sorted(counts.items())))
        self.counts = counts


def of_action(rules: Iterable[Rule], *actions: str) -> list[Rule]:
    """The rules with one of ``actions``, by name."""
    return sorted(rule for rule in rules if rule.action in actions)


def holds(rule: Rule) -> Column:
    """True where the rule is kept; false where it is broken or null."""
    return F.ifnull(F.expr(f"({rule.condition})"), F.lit(False))


def broken_names(rules: Iterable[Rule]) -> Column:
    """Sorted array of the names of the broken rules."""
    named = [F.when(~holds(rule), F.lit(rule.name)) for rule in sorted(rules)]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def split_by_rules(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """Kept and quarantined rows under the drop rules; every row is in exactly one of them.

    Grain: unchanged. Quarantined rows carry the broken rules in ``_failed_rules``.
    """
    dropping = of_action(rules, "drop")
    kept = df
    for rule in dropping:
        kept = kept.where(holds(rule))
    return kept, df.withColumn(BROKEN, broken_names(dropping)).where(F.size(BROKEN) > 0)


def count_by_rule(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Kept and broken rows of every rule, from one aggregate over ``df``.

    Grain: one row per rule: ``expectation``, ``action``, ``passed_records``, ``failed_records``.
    """
    rules = sorted(rules)
    sums = df.agg(
        F.count("*").alias("_rows"),
        *(F.count_if(holds(rule)).alias(f"_kept{i}") for i, rule in enumerate(rules)),
    )
    lines = F.array(
        *(
            F.struct(
                F.lit(rule.name).alias("expectation"),
                F.lit(rule.action).alias("action"),
                F.col(f"_kept{i}").alias("passed_records"),
                (F.col("_rows") - F.col(f"_kept{i}")).alias("failed_records"),
            )
            for i, rule in enumerate(rules)
        )
    )
    return sums.select(F.inline(lines))


class Screened:
    """Result of ``screen``: the written rows, split by the drop rules, and the counters."""

    def __init__(self, written: DataFrame, rules: list[Rule], counts: dict[str, int], rows: int):
        self._written = written
        self.rules = rules
        self.broken = counts
        self.rows = rows

    @property
    def kept(self) -> DataFrame:
        return self._written.where(~F.col("_quarantined")).drop(BROKEN, "_quarantined")

    @property
    def quarantined(self) -> DataFrame:
        return self._written.where("_quarantined").drop("_quarantined")

    def counters(self) -> DataFrame:
        """Grain: one row per rule."""
        rows = [
            (r.name, r.action, self.rows - self.broken[r.name], self.broken[r.name])
            for r in self.rules
        ]
        schema = "expectation STRING, action STRING, passed_records BIGINT, failed_records BIGINT"
        return self._written.sparkSession.createDataFrame(rows, schema)


def screen(df: DataFrame, rules: Iterable[Rule], label: str = "screened") -> Screened:
    """Write ``df`` once to a staging folder while counting all rules; raise on a fail rule.

    One pass: the counters are observed while the rows are written, and nothing is published
    before they are known. Kept and quarantined rows are separate partitions of the staging
    folder. Raises ``BrokenRules`` when any row breaks a fail rule.
    """
    rules = sorted(rules)
    seen = Observation()
    counts = [F.count_if(~holds(rule)).alias(rule.name) for rule in rules]
    folder = scratch_folder(df.sparkSession, label)
    (
        df.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts)
        .withColumn(BROKEN, broken_names(of_action(rules, "drop")))
        .withColumn("_quarantined", F.size(BROKEN) > 0)
        .write.partitionBy("_quarantined")
        .parquet(folder)
    )
    found = dict(seen.get)
    rows = found.pop("_rows")
    stopping = {r.name: found[r.name] for r in rules if r.action == "fail" and found[r.name]}
    if stopping:
        raise BrokenRules(stopping)
    schema = with_columns(df.schema, f"{BROKEN} array<string>, _quarantined boolean")
    return Screened(df.sparkSession.read.schema(schema).parquet(folder), rules, found, rows)


def progress_events(
    counters: DataFrame, update_id: str, dataset: str, at: datetime | Column
) -> DataFrame:
    """Turn counters into an event row: ``origin``, ``timestamp``, ``event_type``, ``details``.

    Grain: one row per update and dataset. The rules of one dataset fit one row.
    """
    line = F.struct(
        F.col("expectation").alias("name"),
        F.lit(dataset).alias("dataset"),
        "passed_records",
        "failed_records",
    )
    packed = counters.agg(F.array_sort(F.collect_list(line)).alias("expectations"))
    quality = F.struct(F.struct("expectations").alias("data_quality"))
    return packed.select(
        F.struct(F.lit(update_id).alias("update_id")).alias("origin"),
        (at if isinstance(at, Column) else F.lit(at).cast("timestamp")).alias("timestamp"),
        F.lit("flow_progress").alias("event_type"),
        F.to_json(F.struct(quality.alias("flow_progress"))).alias("details"),
    )


def report(events: DataFrame) -> DataFrame:
    """Counters of every rule in every update, from the event log.

    Grain: one row per update, dataset and rule. The time of an update is its first event of any
    type; its counters may come in several events and are added up. Events are combined by
    update, dataset and rule first, so the time window sees a few rows per update only.
    """
    is_progress = F.col("event_type") == "flow_progress"
    lines = F.when(
        is_progress, F.from_json(F.get_json_object("details", _COUNTERS_PATH), _COUNTERS)
    )
    combined = (
        events.select(
            F.col("origin.update_id").alias("update_id"), "timestamp", lines.alias("_lines")
        )
        .where("update_id IS NOT NULL")
        # An event without counters keeps one row, for its time.
        .select("update_id", "timestamp", F.explode_outer("_lines").alias("_line"))
        .groupBy(
            "update_id",
            F.col("_line.dataset").alias("dataset"),
            F.col("_line.name").alias("expectation"),
            F.col("_line").isNotNull().alias("_counted"),
        )
        .agg(
            F.min("timestamp").alias("_first"),
            F.sum("_line.passed_records").alias("passed_records"),
            F.sum("_line.failed_records").alias("failed_records"),
        )
    )
    evaluated = F.col("passed_records") + F.col("failed_records")
    return (
        combined.withColumn("update_ts", F.min("_first").over(Window.partitionBy("update_id")))
        .where("_counted")
        .select(
            *REPORT_KEY,
            "update_ts",
            "passed_records",
            "failed_records",
            F.try_divide("passed_records", evaluated).alias("pass_rate"),
        )
    )


def latest_violations(results: DataFrame) -> DataFrame:
    """Broken rules of the latest update. Grain: one row per dataset and rule, in that order."""
    latest = results.agg(F.max("update_ts")).scalar()
    return (
        results.where((F.col("update_ts") == latest) & (F.col("failed_records") > 0))
        .select("dataset", "expectation", "passed_records", "failed_records", "pass_rate")
        .orderBy("dataset", "expectation")
    )


def not_evaluated(counters: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected rules without a counter, and fail rules that were broken.

    Grain: one row per dataset and rule with a problem. ``expected`` has ``dataset``,
    ``expectation`` and ``action``.
    """
    joined = expected.join(
        counters.select("dataset", "expectation", "failed_records"),
        ["dataset", "expectation"],
        "left",
    )
    problem = F.when(F.col("failed_records").isNull(), "not evaluated").when(
        (F.col("action") == "fail") & (F.col("failed_records") > 0), "broken"
    )
    return joined.withColumn("problem", problem).where("problem IS NOT NULL")
