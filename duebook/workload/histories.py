"""Queries: version history, point-in-time reads, snapshots, loads."""

from datetime import date, datetime

from pyspark.sql import functions as F

from duebook.operators import checks
from duebook.operators import history as h
from duebook.operators.matching import newest_per_key
from duebook.session import scratch_folder
from duebook.sources.loads import LoadedTable
from duebook.workload import adapters as a
from duebook.workload.loans import client_month
from duebook.workload.registry import Columns, query

VERSION = Columns(
    ints="sk_id_curr delivery", nums="price", days="valid_from valid_to", texts="status"
)
SNAPSHOT_MONTH = date(2000, 6, 1)
SNAPSHOT_TIME = datetime(2000, 6, 15, 12)
_SNAPSHOT_SQL = "DATE '2000-06-15'"


def versions(spark, sf):
    return h.build_versions(
        a.deliveries(spark, sf),
        ["sk_id_curr"],
        "delivered_on",
        a.DELIVERY_UNTRACKED,
        [F.desc("delivery")],
    )


def named(df):
    return df.withColumnsRenamed({h.VALID_FROM: "valid_from", h.VALID_TO: "valid_to"})


@query("scd2_build", VERSION, "SELECT * FROM versions", "versions")
def scd2_build(spark, sf):
    return named(versions(spark, sf))


@query(
    "scd2_as_of",
    VERSION,
    f"""SELECT * FROM versions WHERE valid_from <= {_SNAPSHOT_SQL}
         AND (valid_to IS NULL OR valid_to > {_SNAPSHOT_SQL})""",
    "versions",
)
def scd2_as_of(spark, sf):
    return named(h.valid_at(versions(spark, sf), F.lit(SNAPSHOT_TIME.date())))


@query(
    "scd2_interval_join",
    Columns(
        ints="sk_id_prev sk_id_curr num_instalment_number",
        nums="amt_payment",
        days="instalment_date",
        texts="status",
    ),
    """SELECT p.sk_id_prev, p.sk_id_curr, num_instalment_number, amt_payment, instalment_date, status
       FROM payments p LEFT JOIN versions v ON v.sk_id_curr = p.sk_id_curr
        AND v.valid_from <= p.instalment_date
        AND (v.valid_to IS NULL OR v.valid_to > p.instalment_date)""",
    "payments versions",
)
def scd2_interval_join(spark, sf):
    facts = a.payments(spark, sf).select(
        "sk_id_prev", "sk_id_curr", "num_instalment_number", "amt_payment", "instalment_date"
    )
    return h.attach_valid(
        facts, versions(spark, sf), ["sk_id_curr"], "instalment_date", ["status"]
    )


@query(
    "snapshot_dataset",
    Columns(
        ints="sk_id_curr max_dpd n_contracts delivery",
        nums="exposure_amount price",
        days="as_of_month default_start_month",
        flags="default_flag",
        texts="snapshot_id status",
    ),
    f"""SELECT 's1' AS snapshot_id, month AS as_of_month, c.*, v.status, v.price, v.delivery
       FROM client_month c LEFT JOIN (
         SELECT * FROM versions WHERE valid_from <= {_SNAPSHOT_SQL}
           AND (valid_to IS NULL OR valid_to > {_SNAPSHOT_SQL})) v USING (sk_id_curr)
       WHERE month = DATE '2000-06-01'""",
    "client_month versions",
)
def snapshot_dataset(spark, sf):
    return h.snapshot_rows(
        client_month(spark, sf),
        versions(spark, sf).drop("delivered_on"),
        "s1",
        SNAPSHOT_MONTH,
        SNAPSHOT_TIME,
    )


@query(
    "snapshot_manifest",
    Columns(
        ints="table_version n_dataset_rows", days="as_of_month", texts="snapshot_id table_name"
    ),
    """SELECT 's2' AS snapshot_id, DATE '2000-07-01' AS as_of_month, unnest([
           {'table_name': 'dataset', 'table_version': 1}, {'table_name': 'history', 'table_version': 0}
         ], recursive := true), (SELECT count(*) FROM client_month WHERE month = DATE '2000-07-01')
         AS n_dataset_rows""",
    "client_month",
)
def snapshot_manifest(spark, sf):
    """Two snapshots of one dataset table; the manifest of the second one."""
    folder = scratch_folder(spark, "snapshots")
    dataset, history = (LoadedTable(spark, f"{folder}/{n}") for n in ("dataset", "history"))
    history.append(versions(spark, sf).drop("delivered_on"), "create")
    monthly = LoadedTable(spark, f"{folder}/months")
    monthly.append(client_month(spark, sf))
    for name, month in (("s1", SNAPSHOT_MONTH), ("s2", date(2000, 7, 1))):
        dataset.append(
            h.snapshot_rows(monthly.read(), history.read(), name, month, SNAPSHOT_TIME)
        )
    logs = {"dataset": dataset.history(), "history": history.history()}
    return h.snapshot_manifest(logs, dataset.read(), "s2", date(2000, 7, 1), SNAPSHOT_TIME)


@query(
    "read_as_of_version",
    Columns(ints="as_of rows status_o", nums="price"),
    """SELECT * FROM (
         SELECT 0 AS as_of, count(*) AS rows, count(*) FILTER (o_orderstatus = 'O') AS status_o,
                max(o_totalprice) AS price FROM orders WHERE o_orderstatus = 'O'
         UNION ALL SELECT 1, count(*), count(*) FILTER (o_orderstatus = 'O'), max(o_totalprice)
                FROM orders
         UNION ALL SELECT 2, count(*), 0, max(o_totalprice) FROM orders WHERE o_orderstatus = 'F')""",
)
def read_as_of_version(spark, sf):
    """Three loads (append, append, replace), each read as of its number."""
    orders = a.table(spark, sf, "orders")
    kept = LoadedTable(spark, scratch_folder(spark, "loads"))
    kept.append(orders.where("o_orderstatus = 'O'"))
    kept.append(orders.where("o_orderstatus <> 'O'"))
    kept.replace(orders.where("o_orderstatus = 'F'"))
    states = [
        kept.read(as_of=n).agg(
            F.lit(n).alias("as_of"),
            F.count("*").alias("rows"),
            F.count_if(F.col("o_orderstatus") == "O").alias("status_o"),
            F.max("o_totalprice").alias("price"),
        )
        for n in range(3)
    ]
    return states[0].union(states[1]).union(states[2])


@query(
    "check_scd2",
    Columns(ints="keys versions not_one_open not_meeting no_length open_rows matching_rows"),
    """SELECT count(DISTINCT sk_id_curr) AS keys, count(*) AS versions, 0 AS not_one_open,
         0 AS not_meeting, 0 AS no_length, count(*) FILTER (valid_to IS NULL) AS open_rows,
         count(*) FILTER (valid_to IS NULL) AS matching_rows FROM versions""",
    "versions",
)
def check_scd2(spark, sf):
    """Contiguity of the history, and its open versions against the latest deliveries."""
    built = versions(spark, sf)
    latest = newest_per_key(
        a.deliveries(spark, sf), ["sk_id_curr"], [F.desc("delivered_on"), F.desc("delivery")]
    )
    match = checks.open_versions_match(built, latest, ["sk_id_curr"], ["status", "price"])
    problems = checks.version_problems(built, ["sk_id_curr"])
    return problems.select(
        "*",
        match.select("open_rows").scalar().alias("open_rows"),
        match.select("matching_rows").scalar().alias("matching_rows"),
    )
