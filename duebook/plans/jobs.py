"""Jobs next to the update: quality report, validation snapshot, payment stream, layout copies."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.fixed_values import RULES, TABLES, TYPE_HINTS
from duebook.operators import layout
from duebook.operators.columns import stack_by_name
from duebook.operators.history import snapshot_manifest, snapshot_rows
from duebook.operators.rules import REPORT_KEY, latest_violations, of_action, report
from duebook.plans.entities import tidy_rows
from duebook.sources.files import hinted_schema
from duebook.sources.loads import LoadedTable
from duebook.streaming.changes import VersionedStream
from duebook.streaming.ingest import ingest_csv, ingest_json


def ingest_folder(
    spark: SparkSession,
    entity: str,
    landing: str,
    raw: str,
    state: str,
    form: str = "csv",
    sampling: float = 1.0,
) -> int:
    """Drain the new files of one landing folder into its raw table folder.

    ``state`` keeps the checkpoint and the schema; hints come from the entity, or from the series
    when the entity is not one of the loan files. ``sampling`` is the share of the first files
    that type inference looks at; what does not fit the types found is rescued, never lost.
    """
    hints = TYPE_HINTS.get(entity, TYPE_HINTS["series"])
    schema = hinted_schema(spark, landing, hints, form, f"{state}/schema", sampling)
    ingest = ingest_csv if form == "csv" else ingest_json
    return ingest(spark, landing, raw, f"{state}/checkpoint", schema)


def quality_report(spark: SparkSession, events: LoadedTable, results: LoadedTable) -> DataFrame:
    """Merge the counters of all logged updates into the report table.

    Returns the violations of the latest update. A rerun adds only updates made since.
    """
    results.upsert(report(events.read()), REPORT_KEY)
    return latest_violations(results.read())


def keep_history(
    spark: SparkSession, entity: str, raw: Mapping[str, DataFrame], folder: str, key: str
) -> VersionedStream:
    """Bring the version history of a cleaned table up to date from its raw streams."""
    rules = of_action(RULES[entity], "fail", "drop")
    kept = VersionedStream(spark, folder, [key], rules=rules)
    kept.run(tidy_rows(TABLES[entity], raw))
    return kept


def take_snapshot(
    dataset: LoadedTable,
    manifest: LoadedTable,
    client_month: DataFrame,
    versions: DataFrame,
    logs: Mapping[str, DataFrame],
    snapshot_id: str,
    as_of_month: date,
    snapshot_ts: datetime,
) -> DataFrame:
    """Append one snapshot, then record the table versions it was made from.

    The dataset is appended first, so the version recorded for it already holds the snapshot.
    ``logs`` maps the other tables to their version logs. Returns the manifest rows.
    """
    rows = snapshot_rows(client_month, versions, snapshot_id, as_of_month, snapshot_ts)
    dataset.append(rows)
    lines = snapshot_manifest(
        {"validation_dataset": dataset.history(), **logs},
        dataset.read(),
        snapshot_id,
        as_of_month,
        snapshot_ts,
    )
    manifest.append(lines)
    return manifest.read().where(f"snapshot_id = '{snapshot_id}'")


LAYOUTS = ("scattered", "clustered", "partitioned", "zordered")


def write_layouts(
    df: DataFrame,
    folder: str,
    files: int = 16,
    contract: str = "sk_id_prev",
    keys: tuple[str, str] = ("sk_id_curr", "month"),
) -> DataFrame:
    """Write one copy of ``df`` per layout; returns files and bytes of each copy."""
    layout.write_scattered(df, f"{folder}/scattered", files, contract)
    layout.write_clustered(df, f"{folder}/clustered", files, keys)
    layout.write_partitioned(df, f"{folder}/partitioned", files, keys[1])
    layout.write_zordered(df, f"{folder}/zordered", files, keys)
    return layout_stats(df.sparkSession, folder)


def layout_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Grain: one row per layout: ``layout``, ``files``, ``bytes``."""
    return stack_by_name(
        layout.file_stats(spark, f"{folder}/{name}").select(
            F.lit(name).alias("layout"), "files", "bytes"
        )
        for name in LAYOUTS
    )
