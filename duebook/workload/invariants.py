"""Queries: invariants of the finished tables."""

from pyspark.sql import functions as F

from duebook.fixed_values import RULES
from duebook.operators import checks, measures
from duebook.operators.columns import stack_labelled
from duebook.operators.exposure import by_client
from duebook.operators.rules import split_by_rules
from duebook.plans.entities import tidy_table
from duebook.workload import adapters as a
from duebook.workload import loans
from duebook.workload.quality import screened_payments
from duebook.workload.registry import Columns, query

PREFIX = "macro_"


@query(
    "check_unique_key",
    Columns(ints="rows keys repeated", texts="table_name"),
    """SELECT 'client_month' AS table_name, count(*) AS rows, count(*) AS keys, 0 AS repeated
         FROM client_month
       UNION ALL SELECT 'contract_month', count(*), count(*), 0 FROM contract_month
       UNION ALL SELECT 'installments', count(*), count(*), 0 FROM installments
       UNION ALL SELECT 'payments', count(*), count(DISTINCT (sk_id_prev, num_instalment_number)),
         (SELECT count(*) FROM (SELECT 1 FROM payments GROUP BY sk_id_prev, num_instalment_number
                                HAVING count(*) > 1)) FROM payments""",
    "client_month contract_month installments",
)
def check_unique_key(spark, sf):
    profiled = {
        "client_month": (loans.client_month(spark, sf), ["sk_id_curr", "month"]),
        "contract_month": (loans.contract_month(spark, sf), ["sk_id_prev", "month"]),
        "installments": (
            loans.installments(spark, sf),
            ["sk_id_prev", "num_instalment_number", "num_instalment_version"],
        ),
        "payments": (a.payments(spark, sf), ["sk_id_prev", "num_instalment_number"]),
    }
    return stack_labelled(
        {name: checks.key_profile(df, keys) for name, (df, keys) in profiled.items()}, "table_name"
    )


@query(
    "check_repeated_keys",
    Columns(ints="sk_id_prev num_instalment_number copies"),
    """SELECT sk_id_prev, num_instalment_number, count(*) AS copies FROM payments
       GROUP BY 1, 2 HAVING count(*) > 1""",
    "payments",
)
def check_repeated_keys(spark, sf):
    return checks.repeated_keys(a.payments(spark, sf), ["sk_id_prev", "num_instalment_number"])


@query(
    "check_coverage",
    Columns(ints="rows", texts="part"),
    """SELECT 'kept' AS part, count(*) FILTER (_rescued_data IS NULL
             AND num_instalment_number IS NOT NULL) AS rows FROM screened
       UNION ALL SELECT 'quarantined', count(*) FILTER (_rescued_data IS NOT NULL
             OR num_instalment_number IS NULL) FROM screened
       UNION ALL SELECT 'source', count(*) FROM lineitem""",
    "screened",
)
def check_coverage(spark, sf):
    source = screened_payments(spark, sf)
    kept, broken = split_by_rules(source, RULES["installments_payments"])
    return checks.coverage({"kept": kept, "quarantined": broken, "source": source})


@query(
    "check_keys_covered",
    Columns(ints="output_keys source_keys only_output only_source"),
    """SELECT count(*) AS output_keys, (SELECT count(*) FROM (
           SELECT sk_id_curr, month FROM contract_month UNION
           SELECT sk_id_curr, month FROM bureau_month)) AS source_keys,
         0 AS only_output, 0 AS only_source FROM client_month""",
    "client_month contract_month bureau_month",
)
def check_keys_covered(spark, sf):
    keys = ["sk_id_curr", "month"]
    # Placed like the client months, which Spark then moves once for both sides.
    sources = [by_client(loans.contract_month(spark, sf).select(*keys)), loans.bureau_month(spark, sf)]
    return checks.keys_covered(loans.client_month(spark, sf), sources, keys)


@query(
    "check_orphans",
    Columns(ints="orphans"),
    """SELECT count(*) AS orphans FROM lineitem
       WHERE l_orderkey NOT IN (SELECT sk_id_prev FROM contracts)""",
    "contracts",
)
def check_orphans(spark, sf):
    payments = a.payments(spark, sf)
    return checks.orphan_count(payments, a.contracts(spark, sf), ["sk_id_prev"])


@query(
    "check_sum_preserved",
    Columns(nums="before after", flags="same", texts="total"),
    """SELECT 'paid' AS total, sum(amt_payment) AS before, sum(amt_payment) AS after, true AS same
         FROM payments
       UNION ALL SELECT 'payments', count(entry_payment_date), count(entry_payment_date), true
         FROM payments""",
    "payments",
)
def check_sum_preserved(spark, sf):
    dated = F.col("entry_payment_date").isNotNull().cast("int")
    return checks.sums_preserved(
        a.payments(spark, sf),
        loans.installments(spark, sf),
        {
            "paid": (F.col("amt_payment"), F.col("amt_paid")),
            "payments": (dated, F.col("n_payments")),
        },
    )


@query(
    "check_flag",
    Columns(ints="wrong_flag wrong_start wrong_max flagged"),
    """SELECT 0 AS wrong_flag, 0 AS wrong_start, 0 AS wrong_max,
         count(*) FILTER (default_flag) AS flagged FROM client_month""",
    "client_month",
)
def check_flag(spark, sf):
    worst = F.max("dpd")
    # Placed like the client months: the join finds both sides where they are.
    placed = by_client(loans.contract_month(spark, sf).select("sk_id_curr", "month", "dpd"))
    recomputed = placed.groupBy("sk_id_curr", "month").agg(
        worst.alias("expected_max"), F.ifnull(worst >= 90, F.lit(False)).alias("expected_flag")
    )
    return checks.flag_recomputed(
        loans.client_month(spark, sf),
        recomputed,
        ["sk_id_curr", "month"],
        "default_flag",
        "default_start_month",
        "month",
    )


@query(
    "check_episode_chain",
    Columns(ints="broken flagged"),
    """SELECT 0 AS broken, count(*) FILTER (default_flag) AS flagged FROM client_month""",
    "client_month",
)
def check_episode_chain(spark, sf):
    table = loans.client_month(spark, sf)
    broken = checks.broken_episodes(table).agg(F.count("*")).scalar()
    return table.agg(F.count_if("default_flag").alias("flagged")).withColumn("broken", broken)


@query(
    "check_gapless",
    Columns(ints="observations months", flags="is_gapless", texts="series"),
    """SELECT series, count(*) AS observations,
         date_diff('month', min(period_month), max(period_month)) + 1 AS months,
         count(*) = date_diff('month', min(period_month), max(period_month)) + 1 AS is_gapless
       FROM observations GROUP BY 1""",
    "observations",
)
def check_gapless(spark, sf):
    return checks.gapless(a.observations(spark, sf), "series", "period_month")


@query(
    "check_lag_shift",
    Columns(ints="compared mismatches", texts="series"),
    "SELECT series, count(*) AS compared, 0 AS mismatches FROM observations GROUP BY 1",
    "observations",
)
def check_lag_shift(spark, sf):
    observed = a.observations(spark, sf)
    return checks.lag_shift(observed, loans.macro_month(spark, sf), a.LAGS, PREFIX)


@query(
    "check_attach",
    Columns(ints="rows covered equal"),
    """SELECT count(*) AS rows, count(*) FILTER (macro_urgent IS NOT NULL
           AND macro_high IS NOT NULL AND macro_medium IS NOT NULL) AS covered,
         count(*) AS equal FROM client_month""",
    "client_month",
)
def check_attach(spark, sf):
    return checks.attached_equal(
        loans.client_month(spark, sf),
        loans.macro_month(spark, sf),
        "month",
        [PREFIX + name for name in a.LAGS],
    )


@query(
    "profile_counts",
    Columns(ints="rows bucketed closed unknown other orphans urgent_text"),
    """SELECT count(*) AS rows, count(dpd_bucket) AS bucketed, count(*) FILTER (is_closed) AS closed,
         count(*) FILTER (is_unknown) AS unknown,
         count(*) FILTER (status = '9' OR status IS NULL) AS other,
         count(*) FILTER (NOT has_bureau_record) AS orphans,
         (SELECT count(*) FROM orders WHERE o_orderpriority LIKE '%URGENT') AS urgent_text
       FROM bureau_balance""",
    "bureau_balance",
)
def profile_counts(spark, sf):
    raw = {"bureau_balance": a.raw_bureau_balance(spark, sf)}
    statuses = tidy_table("bureau_balance", raw, a.bureau(spark, sf))
    urgent = measures.profile(
        a.table(spark, sf, "orders"), n=F.col("o_orderpriority").endswith("URGENT")
    )
    return measures.profile(
        statuses,
        bucketed="dpd_bucket IS NOT NULL",
        closed="is_closed",
        unknown="is_unknown",
        other="dpd_bucket IS NULL AND NOT is_closed AND NOT is_unknown",
        orphans="NOT has_bureau_record",
    ).withColumn("urgent_text", urgent.select("n").scalar())
