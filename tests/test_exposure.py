import tempfile
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from duebook.operators.exposure import (
    bureau_months,
    client_months,
    contract_months,
    with_episode_start,
)
from duebook.operators.series import clean_series, lagged_series, month_spine
from tests.helpers import plan, rows, same

JAN, FEB, MAR, APR = (date(2018, m, 1) for m in (1, 2, 3, 4))
POS = (
    "sk_id_prev BIGINT, sk_id_curr BIGINT, month DATE, name_contract_status STRING, sk_dpd INT, "
    "sk_dpd_def INT, cnt_instalment_future INT, has_previous_application BOOLEAN"
)
CARD = POS.replace("cnt_instalment_future INT", "amt_balance DECIMAL(18,3)")
OVERDUE = (
    "sk_id_prev BIGINT, month DATE, sk_id_curr BIGINT, installment_dpd INT, "
    "has_previous_application BOOLEAN"
)


def test_contract_months(spark):
    pos = spark.createDataFrame(
        [
            (1, 10, JAN, "Active", 0, 0, 5, True),
            (1, 10, FEB, None, 95, 3, 4, True),
            (7, 70, JAN, "Completed", 0, 0, 2, False),  # no contract row: no estimate
        ],
        POS,
    )
    card = spark.createDataFrame([(2, 10, JAN, "Signed", 1, 1, Decimal("-3.5"), True)], CARD)
    overdue = spark.createDataFrame(
        [(1, FEB, 10, 120, True), (1, MAR, 10, 150, True), (8, JAN, 80, 0, False)], OVERDUE
    )
    contracts = spark.createDataFrame(
        [(1, Decimal("100.5")), (2, Decimal("9"))], "sk_id_prev BIGINT, amt_annuity DECIMAL(18,3)"
    )
    same(
        contract_months(pos, card, overdue, contracts),
        [
            (1, JAN, "pos_cash", 0, None, 0, "balance", True, Decimal("502.500"), True),
            (1, FEB, "pos_cash", 95, 120, 95, "balance", False, Decimal("402.000"), True),
            (1, MAR, None, None, 150, 150, "installments", True, None, True),
            (2, JAN, "credit_card", 1, None, 1, "balance", True, Decimal("-3.500"), True),
            (7, JAN, "pos_cash", 0, None, 0, "balance", False, None, False),
            (8, JAN, None, None, 0, 0, "installments", True, None, False),
        ],
        "sk_id_prev", "month", "contract_type", "source_dpd", "installment_dpd", "dpd",
        "dpd_source", "is_active", "exposure_amount", "has_previous_application",
    )


def test_bureau_months(spark):
    statuses = spark.createDataFrame(
        [(1, JAN, 3), (2, JAN, 4), (1, FEB, None), (9, JAN, 5)],
        "sk_id_bureau BIGINT, month DATE, dpd_bucket INT",
    )
    bureau = spark.createDataFrame([(1, 10), (2, 10)], "sk_id_bureau BIGINT, sk_id_curr BIGINT")
    same(bureau_months(statuses, bureau), [(10, JAN, 4, 2, True), (10, FEB, None, 0, False)])


def test_episodes_end_at_gaps_and_paid_months(spark):
    flags = [
        (1, date(2017, 12, 1), True), (1, JAN, True), (1, FEB, False), (1, MAR, True),
        (2, JAN, True), (2, MAR, True), (2, APR, True), (3, JAN, False),
    ]
    df = spark.createDataFrame(flags, "sk_id_curr INT, month DATE, default_flag BOOLEAN")
    dec = date(2017, 12, 1)
    same(
        with_episode_start(df),
        [
            (1, dec, dec), (1, JAN, dec), (1, FEB, None), (1, MAR, MAR),
            (2, JAN, JAN), (2, MAR, MAR), (2, APR, MAR), (3, JAN, None),
        ],
        "sk_id_curr", "month", "default_start_month",
    )


CONTRACT_MONTH = (
    "sk_id_prev BIGINT, sk_id_curr BIGINT, month DATE, dpd INT, source_dpd_def INT, "
    "is_active BOOLEAN, exposure_amount DECIMAL(18,3)"
)
BUREAU = (
    "sk_id_curr BIGINT, month DATE, bureau_max_dpd_bucket INT, n_bureau_active_contracts INT, "
    "bureau_default_flag BOOLEAN"
)


def client_table(spark, extra=()):
    contracts = spark.createDataFrame(
        [
            (1, 10, JAN, 89, 0, True, Decimal("5")),
            (2, 10, JAN, 3, 2, False, Decimal("7")),
            (1, 10, FEB, 90, 0, True, None),
            (1, 10, MAR, 95, 0, True, Decimal("1")),
            *extra,
        ],
        CONTRACT_MONTH,
    )
    bureau = spark.createDataFrame([(10, JAN, 2, 1, False), (20, JAN, 5, 1, True)], BUREAU)
    macro = spark.createDataFrame([(JAN, 1.5)], "month DATE, macro_hicp_yoy DOUBLE")
    return client_months(contracts, bureau, macro)


def test_client_months(spark):
    same(
        client_table(spark),
        [
            (10, JAN, 89, 2, "60-89", False, None, Decimal("5.000"), 1, 2, 2, False, 1, 1.5),
            (10, FEB, 90, 0, "90+", True, FEB, None, 1, 1, None, False, 0, None),
            (10, MAR, 95, 0, "90+", True, FEB, Decimal("1.000"), 1, 1, None, False, 0, None),
            (20, JAN, None, None, None, False, None, None, 0, 0, 5, True, 1, 1.5),
        ],
    )


def test_client_months_do_not_look_ahead(spark):
    later = [(1, 10, APR, 0, 0, True, None), (5, 10, APR, 200, 0, True, None)]
    before = rows(client_table(spark).where(F.col("month") <= MAR))
    assert rows(client_table(spark, later).where(F.col("month") <= MAR)) == before


OBSERVED = "series STRING, period_month DATE, obs_value DOUBLE"


def test_lagged_series_carry_over_gaps(spark):
    df = spark.createDataFrame(
        [("a", JAN, 1.0), ("a", MAR, 3.0), ("b", JAN, 10.0), ("other", JAN, 99.0)], OBSERVED
    )
    out = lagged_series(df, {"a": 1, "b": 0})
    assert out.columns == ["month", "macro_a", "macro_b"]
    same(out, [(JAN, None, 10.0), (FEB, 1.0, 10.0), (MAR, 1.0, 10.0), (APR, 3.0, 10.0)])
    assert "NestedLoop" not in plan(out) and "CartesianProduct" not in plan(out)


def test_lagged_series_do_not_look_ahead(spark):
    base = [("a", JAN, 1.0), ("b", JAN, 10.0)]
    later = [("a", MAR, 7.0), ("b", APR, 8.0)]
    lags = {"a": 1, "b": 0}
    short = rows(lagged_series(spark.createDataFrame(base, OBSERVED), lags))
    long = rows(lagged_series(spark.createDataFrame(base + later, OBSERVED), lags).where("month <= '2018-02-01'"))
    assert long[: len(short)] == short


def test_clean_series_keeps_the_latest_revision(spark):
    schema = (
        "KEY STRING, FREQ STRING, TIME_PERIOD STRING, OBS_VALUE STRING, OBS_STATUS STRING, "
        "_rescued_data STRING, _ingested_at TIMESTAMP, _source_file STRING"
    )
    from datetime import datetime

    old, new = datetime(2026, 1, 1), datetime(2026, 2, 1)
    df = spark.createDataFrame(
        [
            ("k", "M", "2018-01", "1.5", "P", None, old, "f1"),
            ("k", "M", "2018-01", "1.7", "A", None, new, "f2"),
            ("k", "M", "2018-Q1", "x", "A", None, old, "f1"),
        ],
        schema,
    )
    same(
        clean_series({"a": df}),
        [("a", JAN, 1.7, "A", "2018-01"), ("a", None, None, "A", "2018-Q1")],
        "series", "period_month", "obs_value", "obs_status", "time_period",
    )


def test_month_spine_crosses_years(spark):
    df = spark.createDataFrame([(date(2017, 11, 20),), (date(2018, 2, 3),), (None,)], "d DATE")
    same(month_spine(df, "d"), [(date(2017, 11, 1),), (date(2017, 12, 1),), (JAN,), (FEB,)])


def test_months_travel_to_their_client_once(spark):
    """The check of flags uses the client months' own placing, and the same rows of it."""
    from duebook.workload import catalogue, registry

    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.adaptive.enabled", "false")
    catalogue.queries()
    check = registry.QUERIES["check_flag"].build
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    day = F.timestamp_seconds(946684800 + 86400 * F.col("id"))
    folder = tempfile.mkdtemp()
    own.range(40).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 4).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"), F.lit(10.0).alias("o_totalprice"),
        day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{folder}/orders.parquet")
    own.range(80).select(
        (F.col("id") % 40).alias("l_orderkey"), F.col("id").alias("l_partkey"),
        F.col("id").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.lit(3.0).alias("l_quantity"), F.lit(5.0).alias("l_extendedprice"),
        F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), day.alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    df = check(own, folder)
    found = df.first()
    assert (found.wrong_flag, found.wrong_start, found.wrong_max) == (0, 0, 0) and found.flagged > 0
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    by_month = [x for x in lines if "Exchange hashpartitioning(sk_id_curr" in x and ", month" in x.split("),")[0]]
    placed = [x for x in lines if "REPARTITION_BY_COL" in x and "hashpartitioning(sk_id_curr" in x]
    assert not [x for x in by_month if "Reused" not in x]
    assert placed
