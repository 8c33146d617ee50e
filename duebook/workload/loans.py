"""Queries: payments to installments, contract months, client months, series."""

from pyspark.sql import functions as F

from duebook.operators import delinquency, exposure, series
from duebook.plans.entities import tidy_table
from duebook.workload import adapters as a
from duebook.workload.registry import Columns, query

INSTALLMENT = Columns(
    ints="sk_id_prev sk_id_curr num_instalment_number num_instalment_version days_instalment "
    "n_payments dpd_at_settlement",
    nums="amt_instalment amt_paid",
    days="instalment_date first_payment_date last_payment_date paid_in_full_date",
    flags="is_paid_in_full has_previous_application",
)
CONTRACT_MONTH = Columns(
    ints="sk_id_prev sk_id_curr source_dpd source_dpd_def installment_dpd dpd",
    nums="exposure_amount",
    days="month",
    flags="is_active has_previous_application",
    texts="contract_type name_contract_status dpd_source",
)
CLIENT_MONTH = Columns(
    ints="sk_id_curr max_dpd max_dpd_def n_active_contracts n_contracts bureau_max_dpd_bucket "
    "n_bureau_active_contracts",
    nums="exposure_amount macro_urgent macro_high macro_medium",
    days="month default_start_month",
    flags="default_flag bureau_default_flag",
    texts="dpd_bucket",
)


def installments(spark, sf):
    return delinquency.settle_installments(a.payments(spark, sf))


def overdue(spark, sf):
    return delinquency.overdue_by_month(installments(spark, sf), a.LAST_DAY)


def contract_month(spark, sf):
    return exposure.contract_months(
        a.pos_cash(spark, sf), a.cards(spark, sf), overdue(spark, sf), a.contracts(spark, sf)
    )


def bureau_month(spark, sf):
    raw = {"bureau_balance": a.raw_bureau_balance(spark, sf)}
    bureau = a.bureau(spark, sf)
    return exposure.bureau_months(tidy_table("bureau_balance", raw, bureau), bureau)


def macro_month(spark, sf):
    return series.lagged_series(a.observations(spark, sf), a.LAGS)


def client_month(spark, sf):
    return exposure.client_months(
        contract_month(spark, sf), bureau_month(spark, sf), macro_month(spark, sf)
    )


@query(
    "running_settlement",
    Columns(
        ints="sk_id_prev num_instalment_number num_instalment_version",
        nums="paid_so_far",
        days="entry_payment_date",
    ),
    """SELECT DISTINCT sk_id_prev, num_instalment_number, num_instalment_version,
         entry_payment_date, paid_so_far FROM running""",
    "running",
)
def running_settlement(spark, sf):
    return delinquency.paid_by_day(a.payments(spark, sf))


query("settle_installments", INSTALLMENT, "SELECT * FROM installments", "installments")(installments)

query(
    "delinquency_by_month",
    Columns(
        ints="sk_id_prev sk_id_curr installment_dpd", days="month", flags="has_previous_application"
    ),
    "SELECT * FROM overdue",
    "overdue",
)(overdue)

query("contract_month", CONTRACT_MONTH, "SELECT * FROM contract_month", "contract_month")(
    contract_month
)

query(
    "bureau_month",
    Columns(
        ints="sk_id_curr bureau_max_dpd_bucket n_bureau_active_contracts",
        days="month",
        flags="bureau_default_flag",
    ),
    "SELECT * FROM bureau_month",
    "bureau_month",
)(bureau_month)

query("client_month", CLIENT_MONTH, "SELECT * FROM client_month", "client_month")(client_month)


@query(
    "full_outer_month",
    Columns(ints="sk_id_prev source_dpd installment_dpd", days="month", texts="side"),
    """SELECT sk_id_prev, month, source_dpd, installment_dpd,
         CASE WHEN bp IS NULL THEN 'installments' WHEN op IS NULL THEN 'balance' ELSE 'both' END
           AS side FROM contract_month""",
    "contract_month",
)
def full_outer_month(spark, sf):
    side = (
        F.when(F.col("contract_type").isNull(), "installments")
        .when(F.col("installment_dpd").isNull(), "balance")
        .otherwise("both")
    )
    return contract_month(spark, sf).select(
        "sk_id_prev", "month", "source_dpd", "installment_dpd", side.alias("side")
    )


@query(
    "default_episodes",
    Columns(ints="sk_id_curr", days="month default_start_month", flags="default_flag"),
    """SELECT sk_id_curr, month, default_flag, CASE WHEN default_flag THEN
         min(month) OVER (PARTITION BY sk_id_curr, default_flag, island) END AS default_start_month
       FROM (SELECT *, year(month) * 12 + month(month)
               - row_number() OVER (PARTITION BY sk_id_curr, default_flag ORDER BY month) AS island
             FROM (SELECT sk_id_curr, month, coalesce(max(sk_dpd) >= 90, false) AS default_flag
                   FROM balances GROUP BY 1, 2))""",
    "balances",
)
def default_episodes(spark, sf):
    rows = exposure.stack_balances(a.pos_cash(spark, sf), a.cards(spark, sf))
    flags = rows.groupBy("sk_id_curr", "month").agg(
        F.ifnull(F.max("sk_dpd") >= 90, F.lit(False)).alias("default_flag")
    )
    return exposure.with_episode_start(flags)


@query(
    "reconcile_dpd",
    Columns(ints="n_months", flags="source_default installment_default matches"),
    """SELECT source_dpd >= 90 AS source_default, installment_dpd >= 90 AS installment_default,
         coalesce((installment_dpd >= 90) = (source_dpd >= 90), true) AS matches,
         count(*) AS n_months FROM contract_month GROUP BY 1, 2, 3""",
    "contract_month",
)
def reconcile_dpd(spark, sf):
    source, computed = F.col("source_dpd") >= 90, F.col("installment_dpd") >= 90
    return contract_month(spark, sf).groupBy(
        source.alias("source_default"),
        computed.alias("installment_default"),
        F.ifnull(computed == source, F.lit(True)).alias("matches"),
    ).agg(F.count("*").alias("n_months"))


@query(
    "month_spine",
    Columns(days="month"),
    """SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)),
         date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS month FROM orders""",
)
def month_spine(spark, sf):
    days = a.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return series.month_spine(days, "day")


query(
    "asof_lagged_pivot",
    Columns(nums="macro_urgent macro_high macro_medium", days="month"),
    "SELECT * FROM macro_month",
    "macro_month",
)(macro_month)
