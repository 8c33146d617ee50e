"""What queries leave on the disk: shuffles and written tables, on rows that the tests make."""

import glob
import gzip
import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from duebook.operators.delinquency import settle_installments
from duebook.operators.exposure import by_client, client_months
from duebook.sources.loads import LoadedTable
from duebook.workload import adapters, delivery, histories
from tests.helpers import rows, same

MONTHS = "sk_id_prev BIGINT, sk_id_curr BIGINT, month DATE, dpd INT, source_dpd_def INT, is_active BOOLEAN, exposure_amount DECIMAL(18,3)"
BUREAU = "sk_id_curr BIGINT, month DATE, bureau_max_dpd_bucket INT, n_bureau_active_contracts INT, bureau_default_flag BOOLEAN"
JAN, FEB, MAR, APR = (date(2018, m, 1) for m in (1, 2, 3, 4))


@pytest.fixture
def own(spark):
    """A session that plans as for tables too large to be broadcast."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    session.conf.set("spark.sql.adaptive.enabled", "false")
    return session


def shuffled_bytes(df):
    """Bytes written by the shuffles of an executed plan that has no adaptive parts."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if "ShuffleExchange" in node.getClass().getSimpleName():
            found += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_placing_by_client_keeps_every_value(own):
    days = [None, 0, 1, -3, 45, 2**31 - 1, -(2**31)]
    months = [None, JAN, FEB, date(2020, 2, 29), date(1, 1, 1), date(9999, 12, 1)]
    made = [(c, m, d) for c in (None, 1, 2) for m in months for d in days] * 2
    df = own.createDataFrame(made, "sk_id_curr BIGINT, month DATE, dpd INT")
    same(by_client(df), made)
    assert by_client(df).schema == df.schema
    assert by_client(df.drop("dpd")).columns == ["sk_id_curr", "month"]


def test_rows_of_overdue_contracts_travel_small(own):
    """Contracts overdue month after month: the rows of one shrink to its first and its months."""
    month = F.add_months(F.lit(JAN), F.col("m"))
    contracts = own.range(4000).select(F.col("id").alias("sk_id_curr"), F.explode(F.sequence(F.lit(0), F.lit(36))).alias("m"))
    due = F.date_add(F.lit(date(2017, 1, 1)), (F.xxhash64("sk_id_curr") % 300).cast("int"))
    df = contracts.select("sk_id_curr", month.alias("month"), F.datediff(F.last_day(month), due).alias("dpd"))
    plain = shuffled_bytes(df.repartition("sk_id_curr"))
    assert shuffled_bytes(by_client(df)) < 0.8 * plain


def client_table(session):
    contracts = [
        (1, 10, JAN, 95, 0, True, None), (1, 10, FEB, 120, 0, True, Decimal("1")), (1, 10, APR, 150, 0, False, Decimal("2")),
        (2, None, JAN, 100, 0, True, None), (2, None, FEB, 130, 0, True, None), (2, None, None, 200, 0, True, None), (3, 30, None, 95, 0, True, None),
    ]
    bureau = [(10, MAR, 2, 1, False), (10, FEB, 5, 1, True), (None, JAN, 1, 1, False), (None, MAR, 1, 1, False), (20, JAN, 0, 1, False), (30, None, 3, 1, False)]
    monthly = session.createDataFrame([(JAN, 1.5)], "month DATE, macro_urgent DOUBLE")
    return client_months(session.createDataFrame(contracts, MONTHS), session.createDataFrame(bureau, BUREAU), monthly)


def test_bureau_months_neither_join_nor_cut_episodes(own):
    same(
        client_table(own),
        [
            (10, JAN, 95, True, JAN, None), (10, FEB, 120, True, JAN, 5), (10, MAR, None, False, None, 2), (10, APR, 150, True, APR, None),
            (20, JAN, None, False, None, 0), (30, None, 95, True, None, None), (30, None, None, False, None, 3),
            (None, JAN, 100, True, JAN, None), (None, FEB, 130, True, JAN, None), (None, None, 200, True, None, None),
            (None, JAN, None, False, None, 1), (None, MAR, None, False, None, 1),
        ],
        "sk_id_curr", "month", "max_dpd", "default_flag", "default_start_month", "bureau_max_dpd_bucket",
    )


def moves_after_full_join(df):
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    joined = next(i for i, line in enumerate(lines) if "FullOuter" in line)
    return [line for line in lines[:joined] if "Exchange hashpartitioning" in line]


def test_client_months_move_nothing_after_the_full_join(own):
    assert not moves_after_full_join(client_table(own))
    lines = client_table(own)._jdf.queryExecution().executedPlan().toString().splitlines()
    assert len([line for line in lines if "REPARTITION_BY_COL" in line and "sk_id_curr" in line]) == 1


def write_tables(own, tables):
    day = F.timestamp_seconds(946684800 + 86400 * (F.col("id") % 50))
    own.range(400).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(10.0).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{tables}/orders.parquet")
    flag = F.when(F.col("id") % 3 == 0, "O").otherwise("F")
    own.range(1200).select(
        (F.col("id") % 400).alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"), (F.col("id") % 31).cast("double").alias("l_quantity"),
        (F.col("id") * 1.25).alias("l_extendedprice"), F.lit("R").alias("l_returnflag"), flag.alias("l_linestatus"), day.alias("l_shipdate"),
    ).write.parquet(f"{tables}/lineitem.parquet")


def test_replayed_payments_are_stored_compressed(own, tmp_path, monkeypatch):
    tables, kept = str(tmp_path / "tables"), str(tmp_path / "kept")
    write_tables(own, tables)
    monkeypatch.setattr(delivery, "scratch_folder", lambda spark, label: kept)
    got = delivery.stream_equals_batch(own, tables)
    same(got, rows(settle_installments(adapters.payments(own, tables))))
    files = glob.glob(f"{kept}/in/part-*")
    text = sum(len(gzip.open(f).read()) for f in files if f.endswith(".gz"))
    assert text > 0 and sum(map(os.path.getsize, files)) < text / 4


def test_months_of_a_snapshot_move_nothing_after_the_full_join(own, tmp_path, monkeypatch):
    tables, moves = str(tmp_path / "tables"), []
    write_tables(own, tables)

    class Watched(LoadedTable):
        def append(self, df, operation="append"):
            if self.folder.endswith("/months"):
                moves.append(moves_after_full_join(df))
            return super().append(df, operation)

    monkeypatch.setattr(histories, "LoadedTable", Watched)
    found = histories.snapshot_manifest(own, tables)
    same(found, [("dataset", 1), ("history", 0)], "table_name", "table_version")
    assert found.first().n_dataset_rows > 0
    assert moves == [[]]
