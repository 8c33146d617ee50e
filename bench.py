"""Headline queries on local[$BENCH_CPUS]; prints one JSON line with the seconds of each."""

from __future__ import annotations

import json
import os
import sys
import time

from duebook.operators import measures
from duebook.plans.jobs import LAYOUTS, write_layouts
from duebook.session import open_local, scratch_folder
from duebook.workload import adapters, catalogue, layouts, loans

QUERIES = (
    "dedup_latest",
    "dedup_whole_row",
    "settle_installments",
    "delinquency_by_month",
    "contract_month",
    "client_month",
    "asof_lagged_pivot",
    "scd2_build",
    "scd2_interval_join",
    "rules_apply",
    "rule_results",
    "stream_ingest",
    "bulk_load_once",
)


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    memory = os.environ.get("BENCH_MEMORY", "12g")
    spark = open_local(cores, spark__driver__memory=memory, spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalogue.queries()
    seconds: dict[str, float] = {}
    registered["month_spine"](spark, sf_dir).collect()  # starts the session's threads
    for name in QUERIES:
        seconds[name] = timed(lambda: registered[name](spark, sf_dir))

    # The four layout queries on stored copies of the contract months, as in the baseline.
    folder = scratch_folder(spark, "bench")
    start = time.perf_counter()
    loans.contract_month(spark, sf_dir).write.parquet(f"{folder}/base")
    stats = write_layouts(spark.read.parquet(f"{folder}/base"), folder).collect()
    seconds["write_layouts"] = round(time.perf_counter() - start, 3)
    customer = adapters.table(spark, sf_dir, "customer")
    client = measures.middle_key(customer, "c_custkey").first()[0]
    clients = layouts.client_dimension(spark, sf_dir)
    for name in LAYOUTS:
        copy = spark.read.parquet(f"{folder}/{name}")  # listed once, like a table of a catalog
        runs = {
            "client_lookup": lambda: measures.rows_of_key(copy, "sk_id_curr", client),
            "month_range": lambda: measures.month_range(copy, *layouts.RANGE),
            "client_join": lambda: measures.worst_by_attribute(
                copy, clients, "sk_id_curr", "c_mktsegment"
            ),
            "month_aggregate": lambda: measures.defaults_by_month(copy),
        }
        for query, build in runs.items():
            seconds[f"{query}_{name}"] = sorted(timed(build) for _ in range(3))[1]
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "files": {row.layout: row.files for row in stats},
    }
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    sys.exit(main())
