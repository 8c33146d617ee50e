"""The whole update: raw tables to cleaned tables, installments, contract and client months.

Every table is screened by its rules while it is written to a staging folder, and published only
if no fail rule is broken. Published tables are numbered loads, clustered for their readers.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.fixed_values import (
    ANCHOR_DAY,
    LAST_OBSERVED_DAY_OFFSET,
    RULES,
    SERIES_CLUSTER_BY,
    SERIES_LAG_MONTHS,
    TABLES,
)
from duebook.operators.columns import stack_by_name
from duebook.operators.delinquency import overdue_by_month, settle_installments
from duebook.operators.exposure import bureau_months, client_months, contract_months
from duebook.operators.rules import progress_events, screen
from duebook.operators.series import clean_series, lagged_series
from duebook.plans.entities import tidy_table
from duebook.sources.loads import LoadedTable

LAST_OBSERVED_DAY = ANCHOR_DAY + timedelta(days=LAST_OBSERVED_DAY_OFFSET)

CLUSTER_BY = {
    **{name: spec.cluster_by for name, spec in TABLES.items()},
    "macro_observation": SERIES_CLUSTER_BY,
    "installments": ("sk_id_curr", "sk_id_prev"),
    "contract_month": ("sk_id_curr", "month"),
    "client_month": ("sk_id_curr", "month"),
    "macro_month": ("month",),
}


@dataclass
class Update:
    """One update of all tables below ``folder``."""

    spark: SparkSession
    folder: str
    update_id: str
    started: datetime
    events: list[DataFrame] = field(default_factory=list)

    def table(self, name: str) -> LoadedTable:
        return LoadedTable(self.spark, f"{self.folder}/{name}")

    def publish(self, name: str, df: DataFrame) -> DataFrame:
        """Screen, store and return one table; its quarantine goes to ``<name>_quarantine``."""
        rules = RULES[name]
        result = screen(df, rules, name)
        spread = F.monotonically_increasing_id()
        keys = CLUSTER_BY[name]
        kept = result.kept.withColumn("_spread", spread)
        kept = kept.repartitionByRange(*keys, "_spread").drop("_spread").sortWithinPartitions(*keys)
        self.table(name).replace(kept, "update")
        if any(rule.action == "drop" for rule in rules):
            self.table(f"{name}_quarantine").replace(result.quarantined, "update")
        self.events.append(progress_events(result.counters(), self.update_id, name, self.started))
        return self.table(name).read()

    def run(self, raw: Mapping[str, DataFrame]) -> DataFrame:
        """Build everything from the raw tables; returns the client months."""
        clean: dict[str, DataFrame] = {}
        for name, spec in TABLES.items():
            parent = clean[spec.parent[0]] if spec.parent else None
            clean[name] = self.publish(name, tidy_table(name, raw, parent))
        series = clean_series({s: raw[s] for s in SERIES_LAG_MONTHS})
        observations = self.publish("macro_observation", series)
        installments = self.publish(
            "installments", settle_installments(clean["installments_payments"])
        )
        contract_month = self.publish(
            "contract_month",
            contract_months(
                clean["pos_cash_balance"],
                clean["credit_card_balance"],
                overdue_by_month(installments, LAST_OBSERVED_DAY),
                clean["previous_application"],
            ),
        )
        macro_month = self.publish("macro_month", lagged_series(observations, SERIES_LAG_MONTHS))
        result = self.publish(
            "client_month",
            client_months(
                contract_month,
                bureau_months(clean["bureau_balance"], clean["bureau"]),
                macro_month,
            ),
        )
        self.log_events()
        return result

    def log_events(self) -> None:
        """Append the rule events of this update to the event table."""
        created = (
            self.spark.range(1)
            .select(
                F.struct(F.lit(self.update_id).alias("update_id")).alias("origin"),
                F.lit(self.started).cast("timestamp").alias("timestamp"),
                F.lit("create_update").alias("event_type"),
                F.lit("{}").alias("details"),
            )
        )
        self.table("event_log").append(stack_by_name([created, *self.events]))
        self.events.clear()
