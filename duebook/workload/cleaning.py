"""Queries: cleaning operators and the cleaned tables."""

from pyspark.sql import functions as F

from duebook.fixed_values import AMOUNT, ANCHOR_DAY, BLANK_TOKENS, DPD_EDGES
from duebook.functions.calendar import day_at, month_at
from duebook.functions.codes import bucket_label
from duebook.operators import columns as cols
from duebook.operators.exposure import stack_balances
from duebook.operators.matching import mark_known, newest_per_key
from duebook.operators.replay import corrected
from duebook.operators.series import clean_series
from duebook.plans.entities import tidy_table
from duebook.workload import adapters as a
from duebook.workload.registry import Columns, query


@query(
    "clean_standardize",
    Columns(ints="c_custkey c_nationkey", nums="balance", texts="c_name c_mktsegment"),
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer""",
)
def clean_standardize(spark, sf):
    raw = a.table(spark, sf, "customer")
    raw = raw.toDF(*(c.upper() for c in raw.columns))
    return cols.lower_names(raw, {"c_acctbal": "balance"})


@query(
    "clean_null_tokens",
    Columns(ints="c_custkey", texts="c_name segment _source_file"),
    """SELECT c_custkey, c_name, 'XNA' AS _source_file,
         CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN NULL
              WHEN 'FURNITURE' THEN 'xna' ELSE c_mktsegment END AS segment FROM customer""",
)
def clean_null_tokens(spark, sf):
    segment = F.col("c_mktsegment")
    raw = a.table(spark, sf, "customer").select(
        "c_custkey",
        "c_name",
        F.when(segment == "MACHINERY", "XNA").when(segment == "BUILDING", "XAP")
        .when(segment == "FURNITURE", "xna").otherwise(segment).alias("segment"),
        F.lit("XNA").alias("_source_file"),
    )
    return cols.blank_to_null(raw, BLANK_TOKENS)


@query(
    "clean_sentinel",
    Columns(ints="o_orderkey days", flags="days_anomaly"),
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1) THEN NULL
              ELSE -(o_orderkey % 1000) END AS days, o_orderkey % 7 = 0 AS days_anomaly
       FROM orders""",
)
def clean_sentinel(spark, sf):
    key = F.col("o_orderkey")
    days = F.when(key % 7 == 0, 365243).when(key % 7 > 1, -(key % 1000))
    raw = a.table(spark, sf, "orders").select("o_orderkey", days.alias("days"))
    return cols.sentinel_to_null(raw, {"days": 365243})


@query(
    "clean_cast",
    Columns(ints="l_orderkey l_linenumber qty", nums="amt_price amt_tax"),
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS qty,
         CAST(l_extendedprice AS DECIMAL(18,3)) AS amt_price,
         CAST(l_tax AS DECIMAL(18,3)) AS amt_tax FROM lineitem""",
)
def clean_cast(spark, sf):
    raw = a.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("AMT_price"),
        F.col("l_tax").alias("AMT_tax"),
    )
    amounts = cols.columns_with_prefix(raw.columns, "AMT_")
    return cols.retype(cols.lower_names(raw), {AMOUNT: amounts, "int": ["qty"]})


def _applications(spark, sf):
    """Two deliveries of train clients, one of the others, in raw spelling."""
    customer = a.table(spark, sf, "customer")
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")
    segment = F.col("c_mktsegment")

    def delivery(df, day, factor):
        return df.select(
            F.col("c_custkey").alias("SK_ID_CURR"),
            (nation % 2).alias("TARGET"),
            F.when(segment == "MACHINERY", "XNA").otherwise(segment).alias("NAME_CONTRACT_TYPE"),
            nation.cast("double").alias("CNT_CHILDREN"),
            F.when(nation == 3, 365243).otherwise(-100 * nation).alias("DAYS_EMPLOYED"),
            (balance * factor).alias("AMT_CREDIT"),
            F.lit(None).cast("string").alias("_rescued_data"),
            F.timestamp_seconds(F.lit(86400 * day)).alias("_ingested_at"),
            F.lit(f"file{day}.csv").alias("_source_file"),
        )

    train = customer.where("c_acctbal >= 0")
    return {
        "application_train": delivery(train, 1, 1).unionByName(delivery(train, 2, 2)),
        "application_test": delivery(customer.where("c_acctbal < 0"), 1, 1).drop("TARGET"),
    }


@query(
    "clean_entity",
    Columns(
        ints="sk_id_curr target cnt_children days_employed",
        nums="amt_credit",
        flags="is_train days_employed_anomaly",
        texts="name_contract_type",
    ),
    """SELECT c_custkey AS sk_id_curr, c_acctbal >= 0 AS is_train,
         CASE WHEN c_acctbal >= 0 THEN c_nationkey % 2 END AS target,
         nullif(c_mktsegment, 'MACHINERY') AS name_contract_type, c_nationkey AS cnt_children,
         CASE WHEN c_nationkey <> 3 THEN -100 * c_nationkey END AS days_employed,
         c_nationkey = 3 AS days_employed_anomaly,
         CAST(CASE WHEN c_acctbal >= 0 THEN c_acctbal * 2 ELSE c_acctbal END AS DECIMAL(18,3))
           AS amt_credit FROM customer""",
)
def clean_entity(spark, sf):
    return tidy_table("application", _applications(spark, sf))


@query(
    "status_decode",
    Columns(
        ints="sk_id_bureau dpd_bucket",
        days="month",
        flags="is_closed is_unknown has_bureau_record",
        texts="status",
    ),
    "SELECT * FROM bureau_balance",
    "bureau_balance",
)
def status_decode(spark, sf):
    raw = {"bureau_balance": a.raw_bureau_balance(spark, sf)}
    return tidy_table("bureau_balance", raw, a.bureau(spark, sf))


@query(
    "offset_calendar",
    Columns(ints="l_orderkey l_linenumber", days="day half_day month"),
    """SELECT l_orderkey, l_linenumber, DATE '2018-05-01' - CAST(l_quantity AS INTEGER) AS day,
         DATE '2018-05-01' - CAST(l_quantity AS INTEGER) - 1 AS half_day,
         CAST(DATE '2018-05-01' - to_months(l_linenumber * 7) AS DATE) AS month FROM lineitem""",
)
def offset_calendar(spark, sf):
    offset = -F.col("l_quantity")
    return a.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        day_at(offset, ANCHOR_DAY).alias("day"),
        day_at(offset - 0.5, ANCHOR_DAY).alias("half_day"),
        month_at(F.col("l_linenumber") * -7, ANCHOR_DAY).alias("month"),
    )


@query(
    "union_sources",
    Columns(ints="party", nums="balance", texts="segment kind"),
    """SELECT c_custkey AS party, c_acctbal AS balance, c_mktsegment AS segment,
              'customer' AS kind FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, NULL, 'supplier' FROM supplier""",
)
def union_sources(spark, sf):
    customers = a.table(spark, sf, "customer").selectExpr(
        "c_custkey AS party", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    suppliers = a.table(spark, sf, "supplier").selectExpr(
        "s_acctbal AS balance", "s_suppkey AS party"
    )
    return cols.stack_labelled({"customer": customers, "supplier": suppliers}, "kind")


@query(
    "union_balances",
    Columns(
        ints="sk_id_prev sk_id_curr sk_dpd sk_dpd_def cnt_instalment_future",
        nums="amt_balance",
        days="month",
        flags="has_previous_application",
        texts="contract_type name_contract_status",
    ),
    "SELECT * FROM balances",
    "balances",
)
def union_balances(spark, sf):
    return stack_balances(a.pos_cash(spark, sf), a.cards(spark, sf))


@query(
    "bucketize",
    Columns(ints="sk_id_prev sk_dpd", days="month", texts="dpd_bucket"),
    """SELECT sk_id_prev, month, CASE WHEN name_contract_status IS NOT NULL THEN sk_dpd END AS sk_dpd,
         CASE WHEN name_contract_status IS NULL THEN NULL WHEN sk_dpd >= 90 THEN '90+'
              WHEN sk_dpd >= 60 THEN '60-89' WHEN sk_dpd >= 30 THEN '30-59'
              WHEN sk_dpd >= 1 THEN '1-29' ELSE '0' END AS dpd_bucket FROM balances""",
    "balances",
)
def bucketize(spark, sf):
    days = F.when(F.col("name_contract_status").isNotNull(), F.col("sk_dpd"))
    rows = stack_balances(a.pos_cash(spark, sf), a.cards(spark, sf))
    return rows.select(
        "sk_id_prev", "month", days.alias("sk_dpd"), bucket_label(days, DPD_EDGES).alias("dpd_bucket")
    )


@query(
    "dedup_latest",
    Columns(ints="user_id event_id", nums="value", texts="event_type"),
    """SELECT user_id, event_id, value, event_type FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM events) WHERE rn = 1""",
)
def dedup_latest(spark, sf):
    events = a.table(spark, sf, "events")
    return newest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query(
    "dedup_whole_row",
    Columns(
        ints="sk_id_prev sk_id_curr num_instalment_version num_instalment_number days_instalment "
        "days_entry_payment",
        nums="amt_instalment amt_payment",
        days="instalment_date entry_payment_date",
        flags="has_previous_application",
    ),
    """SELECT DISTINCT sk_id_prev, sk_id_curr, num_instalment_version, num_instalment_number,
         days_instalment, entry_payment_date - DATE '2018-05-01' AS days_entry_payment,
         amt_instalment, amt_payment, instalment_date, entry_payment_date,
         has_previous_application FROM payments""",
    "payments",
)
def dedup_whole_row(spark, sf):
    parents = a.contracts(spark, sf)
    return tidy_table("installments_payments", {"installments_payments": _raw_payments(spark, sf)}, parents)


def _raw_payments(spark, sf):
    """All payments, delivered twice; the second delivery differs below the third decimal."""
    rows = a.payments(spark, sf)

    def delivery(day, noise):
        return rows.select(
            F.col("sk_id_prev").alias("SK_ID_PREV"),
            F.col("sk_id_curr").alias("SK_ID_CURR"),
            F.col("num_instalment_version").cast("double").alias("NUM_INSTALMENT_VERSION"),
            F.col("num_instalment_number").alias("NUM_INSTALMENT_NUMBER"),
            F.col("days_instalment").cast("double").alias("DAYS_INSTALMENT"),
            F.datediff("entry_payment_date", F.lit("2018-05-01")).cast("double").alias(
                "DAYS_ENTRY_PAYMENT"
            ),
            F.col("amt_instalment").cast("double").alias("AMT_INSTALMENT"),
            (F.col("amt_payment").cast("double") + noise).alias("AMT_PAYMENT"),
            F.lit(None).cast("string").alias("_rescued_data"),
            F.timestamp_seconds(F.lit(86400 * day)).alias("_ingested_at"),
            F.lit(f"file{day}.csv").alias("_source_file"),
        )

    return delivery(1, 0.0).unionByName(delivery(2, 0.0001))


@query(
    "flag_parent",
    Columns(ints="o_orderkey o_custkey", flags="has_rich_client"),
    """SELECT o_orderkey, o_custkey, o_custkey IN (
         SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS has_rich_client FROM orders""",
)
def flag_parent(spark, sf):
    orders = a.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    rich = a.table(spark, sf, "customer").where("c_acctbal > 0")
    return mark_known(orders, rich, "o_custkey", "has_rich_client", "c_custkey")


@query(
    "clean_series",
    Columns(nums="obs_value", days="period_month", texts="series time_period series_key obs_status"),
    """SELECT series, CASE WHEN strlen(time_period) = 7 AND time_period NOT LIKE '%Q%'
              THEN CAST(time_period || '-01' AS DATE) END AS period_month,
         CASE WHEN v % 50 <> 0 THEN v + 0.5 END AS obs_value, time_period,
         'K' AS series_key, 'A' AS obs_status
       FROM (SELECT *, row_number() OVER (PARTITION BY series, time_period ORDER BY v DESC) AS rn
             FROM (SELECT CASE o_orderkey % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS series,
                     CASE WHEN o_orderkey % 5 = 0
                          THEN CAST(year(o_orderdate) AS VARCHAR) || '-Q' || quarter(o_orderdate)
                          WHEN o_orderkey % 5 = 1 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
                          ELSE strftime(o_orderdate, '%Y-%m') END AS time_period,
                     o_orderkey AS v FROM orders)) WHERE rn = 1""",
)
def clean_series_query(spark, sf):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    period = (
        F.when(key % 5 == 0, F.concat(F.year(day), F.lit("-Q"), F.quarter(day)))
        .when(key % 5 == 1, day.cast("string"))
        .otherwise(F.date_format(day, "yyyy-MM"))
    )
    raw = a.table(spark, sf, "orders").select(
        (key % 2).alias("_side"),
        F.lit("K").alias("KEY"),
        period.alias("TIME_PERIOD"),
        F.when(key % 50 == 0, "n/a").otherwise(F.concat(key, F.lit(".5"))).alias("OBS_VALUE"),
        F.lit("A").alias("OBS_STATUS"),
        F.lit(None).cast("string").alias("_rescued_data"),
        F.timestamp_seconds(key).alias("_ingested_at"),
        F.lit("f").alias("_source_file"),
    )
    return clean_series({"even": raw.where("_side = 0"), "odd": raw.where("_side = 1")})


@query(
    "correction_overlay",
    Columns(ints="c_custkey", nums="c_acctbal", texts="status"),
    """SELECT c_custkey, CAST(round_even(c_acctbal * 1.1, 3) AS DECIMAL(18,3)) AS c_acctbal,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'Single / not married' ELSE 'Married' END
           AS status FROM customer""",
)
def correction_overlay(spark, sf):
    segment = F.col("c_mktsegment")
    raw = a.table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", F.when(segment == "BUILDING", "Married").otherwise(segment).alias("status")
    )
    return corrected(raw, "c_acctbal", "status")


def _delivered(df, day=1):
    """The rows of one delivery, with its delivery columns."""
    return df.withColumns(
        {
            "_rescued_data": F.lit(None).cast("string"),
            "_ingested_at": F.timestamp_seconds(F.lit(86400 * day)),
            "_source_file": F.lit(f"file{day}.csv"),
        }
    )


@query(
    "clean_bureau",
    Columns(
        ints="sk_id_bureau sk_id_curr days_credit",
        nums="amt_credit_sum",
        days="credit_date credit_end_date credit_end_fact_date",
        texts="credit_type",
    ),
    """SELECT o_orderkey AS sk_id_bureau, o_custkey AS sk_id_curr, -(o_orderkey % 900) AS days_credit,
         o_totalprice AS amt_credit_sum,
         DATE '2018-05-01' - CAST(o_orderkey % 900 AS INTEGER) AS credit_date,
         DATE '2018-05-01' + CAST(o_orderkey % 30000 AS INTEGER) AS credit_end_date,
         CASE WHEN o_orderkey % 3 <> 0 THEN DATE '2018-05-01' - CAST(o_orderkey % 500 AS INTEGER) END
           AS credit_end_fact_date,
         nullif(o_orderstatus, 'P') AS credit_type FROM orders""",
)
def clean_bureau(spark, sf):
    """Bureau contracts delivered twice, with four dates made from day offsets."""
    key = F.col("o_orderkey")
    rows = a.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        key.cast("double").alias("SK_ID_BUREAU"),
        F.when(F.col("o_orderstatus") == "P", "XAP").otherwise(F.col("o_orderstatus")).alias("CREDIT_TYPE"),
        (-(key % 900)).cast("double").alias("DAYS_CREDIT"),
        (key % 30000).cast("double").alias("DAYS_CREDIT_ENDDATE"),
        F.when(key % 3 != 0, -(key % 500)).cast("double").alias("DAYS_ENDDATE_FACT"),
        F.col("o_totalprice").alias("AMT_CREDIT_SUM"),
    )
    earlier = rows.where(F.col("SK_ID_BUREAU") % 2 == 0).withColumn("AMT_CREDIT_SUM", F.lit(0.0))
    return tidy_table("bureau", {"bureau": _delivered(rows, 2).unionByName(_delivered(earlier, 1))})


@query(
    "clean_previous_application",
    Columns(
        ints="sk_id_prev sk_id_curr days_decision days_last_due sellerplace_area",
        nums="amt_annuity",
        days="decision_date",
        flags="days_last_due_anomaly sellerplace_area_anomaly",
        texts="code_reject_reason name_contract_status",
    ),
    """SELECT o_orderkey AS sk_id_prev, o_custkey AS sk_id_curr, -(o_orderkey % 300) AS days_decision,
         CASE WHEN o_orderkey % 5 <> 0 THEN -(o_orderkey % 100) END AS days_last_due,
         o_orderkey % 5 = 0 AS days_last_due_anomaly,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 50 END AS sellerplace_area,
         o_orderkey % 7 = 0 AS sellerplace_area_anomaly, o_totalprice AS amt_annuity,
         DATE '2018-05-01' - CAST(o_orderkey % 300 AS INTEGER) AS decision_date,
         CASE WHEN o_orderkey % 2 <> 0 THEN 'HC' END AS code_reject_reason,
         o_orderstatus AS name_contract_status FROM orders""",
)
def clean_previous_application(spark, sf):
    """Earlier contracts: sentinels of several columns, tokens, and a date from an offset."""
    key = F.col("o_orderkey")
    rows = a.table(spark, sf, "orders").select(
        key.alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderstatus").alias("NAME_CONTRACT_STATUS"),
        F.when(key % 2 == 0, "XAP").otherwise("HC").alias("CODE_REJECT_REASON"),
        (-(key % 300)).alias("DAYS_DECISION"),
        F.when(key % 5 == 0, 365243.0).otherwise(-(key % 100)).alias("DAYS_LAST_DUE"),
        F.when(key % 7 == 0, -1).otherwise(key % 50).alias("SELLERPLACE_AREA"),
        F.col("o_totalprice").alias("AMT_ANNUITY"),
    )
    return tidy_table("previous_application", {"previous_application": _delivered(rows)})


_MONTHLY_SQL = """SELECT l_orderkey AS sk_id_prev, l_suppkey AS sk_id_curr, -l_linenumber AS months_balance,
       CAST(l_quantity AS INTEGER) AS sk_dpd, {more},
       CAST(DATE '2018-05-01' - to_months(CAST(l_linenumber AS INTEGER)) AS DATE) AS month,
       nullif(l_returnflag, 'N') AS name_contract_status,
       l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') AS has_previous_application
     FROM (SELECT l_orderkey, l_linenumber, max(l_suppkey) AS l_suppkey, max(l_quantity) AS l_quantity,
             max(l_returnflag) AS l_returnflag, max(l_extendedprice) AS l_extendedprice, max(l_tax) AS l_tax
           FROM lineitem GROUP BY ALL)"""


def _monthly(spark, sf, entity, **more):
    """A monthly balance table of contracts, some of which are not among the earlier contracts."""
    status = F.when(F.col("l_returnflag") == "N", "XNA").otherwise(F.col("l_returnflag"))
    values = ("l_suppkey", "l_quantity", "l_returnflag", "l_extendedprice", "l_tax")
    lines = a.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber")
    rows = lines.agg(*(F.max(c).alias(c) for c in values)).select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("l_suppkey").alias("SK_ID_CURR"),
        (-F.col("l_linenumber")).alias("MONTHS_BALANCE"),
        status.alias("NAME_CONTRACT_STATUS"),
        F.col("l_quantity").cast("double").alias("SK_DPD"),
        *(F.col(column).alias(name) for name, column in more.items()),
    )
    known = a.table(spark, sf, "orders").where("o_orderstatus = 'O'")
    return tidy_table(entity, {entity: _delivered(rows)}, known.select(F.col("o_orderkey").alias("sk_id_prev")))


@query(
    "clean_pos_cash",
    Columns(
        ints="sk_id_prev sk_id_curr months_balance sk_dpd cnt_instalment_future",
        days="month",
        flags="has_previous_application",
        texts="name_contract_status",
    ),
    _MONTHLY_SQL.format(more="l_linenumber AS cnt_instalment_future"),
)
def clean_pos_cash(spark, sf):
    return _monthly(spark, sf, "pos_cash_balance", CNT_INSTALMENT_FUTURE="l_linenumber")


@query(
    "clean_credit_card",
    Columns(
        ints="sk_id_prev sk_id_curr months_balance sk_dpd",
        nums="amt_balance amt_receivable",
        days="month",
        flags="has_previous_application",
        texts="name_contract_status",
    ),
    _MONTHLY_SQL.format(more="l_extendedprice AS amt_balance, l_tax AS amt_receivable"),
)
def clean_credit_card(spark, sf):
    return _monthly(spark, sf, "credit_card_balance", AMT_BALANCE="l_extendedprice", AMT_RECIVABLE="l_tax")
