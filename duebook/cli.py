"""Command line of the jobs: ``python -m duebook <job> --root <folder> ...``.

One root folder holds ``landing/<table>``, ``raw/<table>``, ``state/<table>``, ``tables/<table>``
and ``history/<table>``.
"""

from __future__ import annotations

import argparse
import uuid
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

from duebook.fixed_values import HISTORY_KEYS, SERIES_LAG_MONTHS, SOURCE_FILES, TABLES
from duebook.plans import jobs
from duebook.plans.loanbook import Update
from duebook.session import open_session
from duebook.sources.loads import LoadedTable, load_new_files
from duebook.streaming.ingest import rows_per_file

RAW = (*SOURCE_FILES, *SERIES_LAG_MONTHS)


def month(text: str) -> date:
    day = date.fromisoformat(text)
    if day.day != 1:
        raise argparse.ArgumentTypeError(f"{text!r} is not the first day of a month")
    return day


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="duebook", description="Loan-performance jobs.")
    parser.add_argument("--root", required=True)
    sub = parser.add_subparsers(dest="job", required=True)
    sub.add_parser("ingest", help="drain the landed files of all raw tables")
    sub.add_parser("update", help="rebuild, screen and publish all tables")
    sub.add_parser("history", help="bring the version histories up to date")
    sub.add_parser("report", help="merge rule counters and show the latest violations")
    sub.add_parser("payments", help="drain the payment event stream")
    bulk = sub.add_parser("bulk", help="load files of one raw table that were not loaded yet")
    bulk.add_argument("--table", default="bureau", choices=RAW)
    snapshot = sub.add_parser("snapshot", help="append a validation snapshot")
    snapshot.add_argument("--as-of-month", type=month, required=True)
    snapshot.add_argument("--snapshot-id", required=True)
    layouts = sub.add_parser("layouts", help="write layout copies of the contract months")
    layouts.add_argument("--files", type=int, default=16)
    return parser


def run(spark: SparkSession, options: argparse.Namespace) -> DataFrame | None:
    """Run one job; returns what there is to show."""
    root = options.root.rstrip("/")
    started = datetime.now(UTC)

    def raw(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/raw/{name}")

    def table(name: str) -> LoadedTable:
        return LoadedTable(spark, f"{root}/tables/{name}")

    def histories() -> dict:
        kept = {}
        for entity, key in HISTORY_KEYS.items():
            streams = {
                name: spark.readStream.schema(raw(name).schema).parquet(f"{root}/raw/{name}")
                for name in TABLES[entity].raw
            }
            folder = f"{root}/history/{entity}"
            kept[entity] = jobs.keep_history(spark, entity, streams, folder, key)
        return kept

    def land(name: str, landing: str, form: str = "csv") -> None:
        jobs.ingest_folder(spark, name, landing, f"{root}/raw/{landing_name(landing)}",
                           f"{root}/state/{landing_name(landing)}", form)

    match options.job:
        case "ingest":
            for name in RAW:
                land(name, f"{root}/landing/{name}")
        case "payments":
            land("installments_payments", f"{root}/landing/payment_events", "json")
            return rows_per_file(raw("payment_events"))
        case "update":
            update = Update(spark, f"{root}/tables", uuid.uuid4().hex, started)
            update.run({name: raw(name) for name in RAW})
        case "history":
            for entity, kept in histories().items():
                table(f"{entity}_scd2").replace(kept.versions(), "history")
        case "report":
            return jobs.quality_report(spark, table("event_log"), table("expectation_result"))
        case "bulk":
            count = load_new_files(
                spark, table(f"{options.table}_bulk"), f"{root}/landing/{options.table}"
            )
            return spark.createDataFrame([(options.table, count)], "table STRING, files BIGINT")
        case "snapshot":
            logs = {f"{entity}_scd2": table(f"{entity}_scd2").history() for entity in HISTORY_KEYS}
            return jobs.take_snapshot(
                table("validation_dataset"),
                table("validation_snapshot"),
                table("client_month").read(),
                table("application_scd2").read(),
                logs,
                options.snapshot_id,
                options.as_of_month,
                started,
            )
        case "layouts":
            folder = f"{root}/layouts/{uuid.uuid4().hex}"
            return jobs.write_layouts(table("contract_month").read(), folder, options.files)
    return None


def landing_name(folder: str) -> str:
    return folder.rstrip("/").rsplit("/", 1)[-1]


def main(argv: list[str] | None = None) -> None:
    options = arguments().parse_args(argv)
    shown = run(open_session(), options)
    if shown is not None:
        shown.show(100, truncate=False)
