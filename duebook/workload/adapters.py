"""The test tables in the shape of loan tables, in Spark and as oracle SQL pieces.

Both sides use the same expressions. Every adapter reads whole tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.fixed_values import AMOUNT
from duebook.functions.calendar import month_of
from duebook.workload.registry import cte

LAST_DAY = date(2002, 3, 31)
LAGS = {"urgent": 1, "high": 2, "medium": 0}
_PRIORITY = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_day() -> Column:
    return F.col("o_orderdate").cast("date")


# ---- payments ----------------------------------------------------------------------------------


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain: one row per payment (line item)."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    due = F.date_add(_order_day(), 30 * F.col("l_linenumber"))
    open_line = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    paid = F.date_add("instalment_date", 4 * F.col("l_quantity").cast("int") - 60)
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .withColumn("instalment_date", due)
        .select(
            F.col("l_orderkey").alias("sk_id_prev"),
            F.col("o_custkey").alias("sk_id_curr"),
            F.col("l_linenumber").alias("num_instalment_number"),
            (F.col("l_linenumber") % 2).alias("num_instalment_version"),
            F.datediff("instalment_date", F.lit("2018-05-01")).alias("days_instalment"),
            "instalment_date",
            F.when(~open_line, paid).alias("entry_payment_date"),
            (20000 + 5000 * F.col("l_linenumber")).cast(AMOUNT).alias("amt_instalment"),
            F.when(~open_line, F.col("l_extendedprice").cast(AMOUNT)).alias("amt_payment"),
            (F.col("o_orderpriority") != "5-LOW").alias("has_previous_application"),
        )
    )


cte(
    "payments",
    """SELECT *, instalment_date - DATE '2018-05-01' AS days_instalment,
       CASE WHEN NOT open_line THEN instalment_date + (4 * qty - 60) END AS entry_payment_date,
       CASE WHEN NOT open_line THEN price END AS amt_payment
FROM (SELECT l_orderkey AS sk_id_prev, o_custkey AS sk_id_curr,
             l_linenumber AS num_instalment_number, l_linenumber % 2 AS num_instalment_version,
             CAST(o_orderdate AS DATE) + 30 * l_linenumber AS instalment_date,
             CAST(l_quantity AS INTEGER) AS qty,
             CAST(20000 + 5000 * l_linenumber AS DECIMAL(18,3)) AS amt_instalment,
             CAST(l_extendedprice AS DECIMAL(18,3)) AS price,
             l_returnflag = 'R' AND l_linestatus = 'O' AS open_line,
             o_orderpriority <> '5-LOW' AS has_previous_application
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
)
cte(
    "running",
    """SELECT *, sum(amt_payment) OVER (
         PARTITION BY sk_id_prev, num_instalment_number, num_instalment_version
         ORDER BY entry_payment_date NULLS FIRST) AS paid_so_far
FROM payments""",
    "payments",
)
cte(
    "installments",
    """SELECT *, coalesce(amt_paid >= amt_instalment, false) AS is_paid_in_full,
       CASE WHEN paid_in_full_date IS NOT NULL
            THEN greatest(paid_in_full_date - instalment_date, 0) END AS dpd_at_settlement
FROM (SELECT sk_id_prev, num_instalment_number, num_instalment_version,
             min(sk_id_curr) AS sk_id_curr, min(days_instalment) AS days_instalment,
             min(instalment_date) AS instalment_date, max(amt_instalment) AS amt_instalment,
             coalesce(sum(amt_payment), 0) AS amt_paid,
             count(entry_payment_date) AS n_payments,
             min(entry_payment_date) AS first_payment_date,
             max(entry_payment_date) AS last_payment_date,
             min(CASE WHEN paid_so_far >= amt_instalment THEN entry_payment_date END)
               AS paid_in_full_date,
             bool_or(has_previous_application) AS has_previous_application
      FROM running GROUP BY 1, 2, 3)""",
    "running",
)
cte(
    "overdue",
    """SELECT sk_id_prev, month, min(sk_id_curr) AS sk_id_curr,
       max(least(last_day(month), until) - instalment_date) AS installment_dpd,
       bool_or(has_previous_application) AS has_previous_application
FROM (SELECT *, CAST(unnest(generate_series(date_trunc('month', instalment_date),
                                            date_trunc('month', until),
                                            INTERVAL 1 MONTH)) AS DATE) AS month
      FROM (SELECT *, greatest(instalment_date,
                     CASE WHEN is_paid_in_full THEN coalesce(paid_in_full_date, instalment_date)
                          ELSE DATE '2002-03-31' END) AS until
            FROM installments))
GROUP BY 1, 2""",
    "installments",
)

# ---- balances and contracts --------------------------------------------------------------------


def _balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, k = F.col("o_orderkey"), F.col("k")
    status = F.element_at(
        F.array(*map(F.lit, ("Active", "Signed", "Demand", "Completed")), F.lit(None)),
        ((key + k) % 5 + 1).cast("int"),
    )
    dpd = F.when(key % 3 == 0, (key * 7 + 37 * k) % 140).otherwise(0).cast("int")
    return orders.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5)))).select(
        key.alias("sk_id_prev"),
        F.col("o_custkey").alias("sk_id_curr"),
        F.add_months(month_of(_order_day()), k).alias("month"),
        status.alias("name_contract_status"),
        dpd.alias("sk_dpd"),
        F.floor(dpd / 2).cast("int").alias("sk_dpd_def"),
        (6 - k).alias("cnt_instalment_future"),
        F.col("o_totalprice").cast(AMOUNT).alias("amt_balance"),
        (F.col("o_orderpriority") != "5-LOW").alias("has_previous_application"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("_card"),
    )


def pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain: one row per contract and month."""
    return _balances(spark, sf_dir).where("NOT _card").drop("_card", "amt_balance")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain: one row per contract and month."""
    return _balances(spark, sf_dir).where("_card").drop("_card", "cnt_instalment_future")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain: one row per contract."""
    known = table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'")
    return known.select(
        F.col("o_orderkey").alias("sk_id_prev"),
        F.col("o_custkey").alias("sk_id_curr"),
        (F.col("o_totalprice") / 10).cast(AMOUNT).alias("amt_annuity"),
    )


cte(
    "balances",
    """SELECT o_orderkey AS sk_id_prev, o_custkey AS sk_id_curr,
       CAST(date_trunc('month', o_orderdate) + to_months(k) AS DATE) AS month,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'credit_card' ELSE 'pos_cash' END
         AS contract_type,
       CASE (o_orderkey + k) % 5 WHEN 0 THEN 'Active' WHEN 1 THEN 'Signed' WHEN 2 THEN 'Demand'
            WHEN 3 THEN 'Completed' END AS name_contract_status,
       CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey * 7 + 37 * k) % 140 ELSE 0 END AS sk_dpd,
       CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey * 7 + 37 * k) % 140 ELSE 0 END // 2
         AS sk_dpd_def,
       CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 6 - k END
         AS cnt_instalment_future,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
            THEN CAST(o_totalprice AS DECIMAL(18,3)) END AS amt_balance,
       o_orderpriority <> '5-LOW' AS has_previous_application
FROM orders CROSS JOIN (SELECT CAST(unnest(range(6)) AS INTEGER) AS k)""",
)
cte(
    "contracts",
    """SELECT o_orderkey AS sk_id_prev, o_custkey AS sk_id_curr,
       CAST(o_totalprice / 10 AS DECIMAL(18,3)) AS amt_annuity
FROM orders WHERE o_orderpriority <> '5-LOW'""",
)
cte(
    "contract_month",
    """SELECT b.sk_id_prev AS bp, o.sk_id_prev AS op,
       coalesce(b.sk_id_prev, o.sk_id_prev) AS sk_id_prev,
       coalesce(b.sk_id_curr, o.sk_id_curr) AS sk_id_curr,
       coalesce(b.month, o.month) AS month, contract_type, name_contract_status,
       sk_dpd AS source_dpd, sk_dpd_def AS source_dpd_def, installment_dpd,
       coalesce(sk_dpd, installment_dpd) AS dpd,
       CASE WHEN sk_dpd IS NOT NULL THEN 'balance'
            WHEN installment_dpd IS NOT NULL THEN 'installments' END AS dpd_source,
       CASE WHEN contract_type IS NOT NULL
            THEN coalesce(name_contract_status IN ('Active', 'Signed', 'Demand'), false)
            ELSE true END AS is_active,
       CAST(CASE WHEN contract_type = 'credit_card' THEN amt_balance
                 WHEN contract_type = 'pos_cash' THEN cnt_instalment_future * amt_annuity END
            AS DECIMAL(18,3)) AS exposure_amount,
       coalesce(b.has_previous_application, o.has_previous_application)
         AS has_previous_application
FROM balances b
FULL JOIN overdue o ON b.sk_id_prev = o.sk_id_prev AND b.month = o.month
LEFT JOIN contracts c ON c.sk_id_prev = coalesce(b.sk_id_prev, o.sk_id_prev)""",
    "balances",
    "overdue",
    "contracts",
)

# ---- bureau ------------------------------------------------------------------------------------


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain: one row per bureau contract (order). Low-priority orders have no bureau record."""
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderpriority <> '5-LOW'")
        .select(
            F.col("o_orderkey").alias("sk_id_bureau"), F.col("o_custkey").alias("sk_id_curr")
        )
    )


def raw_bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw monthly statuses. Grain: one row per line item; contract-months repeat."""
    lines = table(spark, sf_dir, "lineitem")
    ship = month_of(F.col("l_shipdate").cast("date"))
    code = F.col("l_partkey") % 10
    status = (
        F.when(code <= 5, code.cast("string")).when(code == 6, "C").when(code == 7, "X")
        .when(code == 8, "9")
    )
    line = (F.col("l_partkey") * 100 + F.col("l_suppkey")) * 10 + F.col("l_linenumber")
    return lines.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        F.months_between(ship, F.lit("2018-05-01").cast("date")).cast("int").alias("MONTHS_BALANCE"),
        status.alias("STATUS"),
        F.lit(None).cast("string").alias("_rescued_data"),
        F.timestamp_seconds(line).alias("_ingested_at"),
        F.lpad(F.hex((F.col("l_extendedprice") * 100).cast("bigint")), 12, "0").alias(
            "_source_file"
        ),
    )


cte(
    "bureau",
    """SELECT o_orderkey AS sk_id_bureau, o_custkey AS sk_id_curr
FROM orders WHERE o_orderpriority <> '5-LOW'""",
)
cte(
    "bureau_balance",
    """SELECT *, CASE WHEN status IN ('0','1','2','3','4','5') THEN CAST(status AS INTEGER) END
         AS dpd_bucket,
       coalesce(status = 'C', false) AS is_closed, coalesce(status = 'X', false) AS is_unknown,
       sk_id_bureau IN (SELECT sk_id_bureau FROM bureau) AS has_bureau_record
FROM (SELECT l_orderkey AS sk_id_bureau, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
             CASE WHEN l_partkey % 10 <= 5 THEN CAST(l_partkey % 10 AS VARCHAR)
                  WHEN l_partkey % 10 = 6 THEN 'C' WHEN l_partkey % 10 = 7 THEN 'X'
                  WHEN l_partkey % 10 = 8 THEN '9' END AS status,
             row_number() OVER (
               PARTITION BY l_orderkey, date_trunc('month', l_shipdate)
               ORDER BY (l_partkey * 100 + l_suppkey) * 10 + l_linenumber DESC,
                        l_extendedprice DESC) AS rn
      FROM lineitem)
WHERE rn = 1""",
    "bureau",
)
cte(
    "bureau_month",
    """SELECT sk_id_curr, month, max(dpd_bucket) AS bureau_max_dpd_bucket,
       count(dpd_bucket) AS n_bureau_active_contracts,
       coalesce(max(dpd_bucket) >= 4, false) AS bureau_default_flag
FROM bureau_balance JOIN bureau USING (sk_id_bureau) GROUP BY 1, 2""",
    "bureau_balance",
    "bureau",
)

# ---- series ------------------------------------------------------------------------------------


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain: one row per series and month; every fifth month of a year is missing."""
    month = month_of(_order_day())
    name = F.create_map(*(F.lit(x) for n, p in _PRIORITY.items() for x in (p, n)))
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority").isin(*_PRIORITY.values()) & (F.month(month) % 5 != 0))
        .groupBy(name[F.col("o_orderpriority")].alias("series"), month.alias("period_month"))
        .agg(F.max("o_totalprice").alias("obs_value"))
    )


cte(
    "observations",
    """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
            ELSE 'medium' END AS series,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS period_month,
       max(o_totalprice) AS obs_value
FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND month(o_orderdate) % 5 <> 0
GROUP BY 1, 2""",
)
cte(
    "macro_month",
    """SELECT month,
       max_by(obs_value, period_month) FILTER (WHERE series = 'urgent') AS macro_urgent,
       max_by(obs_value, period_month) FILTER (WHERE series = 'high') AS macro_high,
       max_by(obs_value, period_month) FILTER (WHERE series = 'medium') AS macro_medium
FROM (SELECT CAST(unnest(generate_series(CAST(min(known) AS TIMESTAMP), CAST(max(known) AS TIMESTAMP),
                                         INTERVAL 1 MONTH)) AS DATE) AS month FROM published)
JOIN published ON known <= month GROUP BY 1""",
    "published",
)
cte(
    "published",
    """SELECT *, CAST(period_month + to_months(CASE series WHEN 'urgent' THEN 1 WHEN 'high' THEN 2
                                             ELSE 0 END) AS DATE) AS known
FROM observations""",
    "observations",
)
cte(
    "client_month",
    """SELECT f.*, CASE WHEN default_flag THEN
         max(CASE WHEN default_flag AND NOT continues THEN month END) OVER (
           PARTITION BY sk_id_curr ORDER BY month) END AS default_start_month,
       macro_urgent, macro_high, macro_medium
FROM (SELECT *, coalesce(lag(default_flag) OVER w
                         AND lag(month) OVER w = CAST(month - INTERVAL 1 MONTH AS DATE), false)
               AS continues
      FROM (SELECT coalesce(c.sk_id_curr, b.sk_id_curr) AS sk_id_curr,
                   coalesce(c.month, b.month) AS month, max_dpd, max_dpd_def,
                   CASE WHEN max_dpd >= 90 THEN '90+' WHEN max_dpd >= 60 THEN '60-89'
                        WHEN max_dpd >= 30 THEN '30-59' WHEN max_dpd >= 1 THEN '1-29'
                        WHEN max_dpd >= 0 THEN '0' END AS dpd_bucket,
                   coalesce(max_dpd >= 90, false) AS default_flag, exposure_amount,
                   coalesce(n_active, 0) AS n_active_contracts, coalesce(n, 0) AS n_contracts,
                   bureau_max_dpd_bucket,
                   coalesce(bureau_default_flag, false) AS bureau_default_flag,
                   coalesce(n_bureau_active_contracts, 0) AS n_bureau_active_contracts
            FROM (SELECT sk_id_curr, month, max(dpd) AS max_dpd, max(source_dpd_def) AS max_dpd_def,
                         sum(exposure_amount) FILTER (WHERE is_active) AS exposure_amount,
                         count(*) FILTER (WHERE is_active) AS n_active, count(*) AS n
                  FROM contract_month GROUP BY 1, 2) c
            FULL JOIN bureau_month b ON c.sk_id_curr = b.sk_id_curr AND c.month = b.month)
      WINDOW w AS (PARTITION BY sk_id_curr ORDER BY month)) f
LEFT JOIN macro_month USING (month)""",
    "contract_month",
    "bureau_month",
    "macro_month",
)

# ---- deliveries --------------------------------------------------------------------------------


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of client attributes. Grain: one row per order; days can repeat per client."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("sk_id_curr"),
        _order_day().alias("delivered_on"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("delivery"),
    )


DELIVERY_UNTRACKED = ("price", "delivery")

cte(
    "versions",
    """SELECT sk_id_curr, status, arg_max(price, delivered_on) AS price,
       arg_max(delivery, delivered_on) AS delivery, min(delivered_on) AS valid_from,
       lead(min(delivered_on)) OVER (PARTITION BY sk_id_curr ORDER BY min(delivered_on)) AS valid_to
FROM (SELECT *, sum(opens) OVER (PARTITION BY sk_id_curr ORDER BY delivered_on) AS change
      FROM (SELECT *, CASE WHEN lag(status) OVER w IS NOT DISTINCT FROM status
                            AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS opens
            FROM (SELECT o_custkey AS sk_id_curr, CAST(o_orderdate AS DATE) AS delivered_on,
                         o_orderstatus AS status, o_totalprice AS price, o_orderkey AS delivery,
                         row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                                            ORDER BY o_orderkey DESC) AS rn
                  FROM orders)
            WHERE rn = 1 WINDOW w AS (PARTITION BY sk_id_curr ORDER BY delivered_on)))
GROUP BY sk_id_curr, change, status""",
)

# ---- rule events -------------------------------------------------------------------------------


def rule_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event log: one progress event per stored event, one start event per day."""
    stored = table(spark, sf_dir, "events")
    good = (F.col("value") >= 10).cast("int")
    counters = F.to_json(
        F.struct(
            F.struct(
                F.struct(
                    F.array(
                        F.struct(
                            F.lit("value_large").alias("name"),
                            F.col("event_type").alias("dataset"),
                            good.alias("passed_records"),
                            (1 - good).alias("failed_records"),
                        )
                    ).alias("expectations")
                ).alias("data_quality")
            ).alias("flow_progress")
        )
    )
    day = F.col("ts").cast("date").cast("string")
    at = F.col("ts").cast("timestamp")
    origin = F.struct(day.alias("update_id")).alias("origin")
    progress = stored.select(
        origin,
        at.alias("timestamp"),
        F.lit("flow_progress").alias("event_type"),
        counters.alias("details"),
    )
    starts = (
        stored.groupBy(day.alias("update_id"))
        .agg((F.min(at) - F.expr("INTERVAL 1 HOUR")).alias("timestamp"))
        .select(
            F.struct("update_id").alias("origin"),
            "timestamp",
            F.lit("create_update").alias("event_type"),
            F.lit("{}").alias("details"),
        )
    )
    return progress.unionByName(starts)


cte(
    "rule_report",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS update_id, event_type AS dataset,
       'value_large' AS expectation, count(*) FILTER (WHERE value >= 10) AS passed_records,
       count(*) FILTER (WHERE value >= 10 IS NOT TRUE) AS failed_records,
       count(*) FILTER (WHERE value >= 10) / count(*) AS pass_rate
FROM events GROUP BY 1, 2""",
)
