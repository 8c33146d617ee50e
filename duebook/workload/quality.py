"""Queries: quality rules, quarantine, report, upsert."""

from pyspark.sql import functions as F

from duebook.fixed_values import RULES, Rule
from duebook.operators import checks
from duebook.operators import rules as r
from duebook.operators.matching import merge_rows
from duebook.session import scratch_folder
from duebook.sources.loads import LoadedTable
from duebook.workload import adapters as a
from duebook.workload.loans import client_month
from duebook.workload.registry import Columns, cte, query

_PAYMENT = Columns(
    ints="sk_id_prev sk_id_curr num_instalment_number num_instalment_version",
    nums="amt_payment amt_instalment",
    days="instalment_date entry_payment_date",
    texts="_rescued_data",
)


def screened_payments(spark, sf):
    """Payments with rescued values and missing numbers, for the rules of that table."""
    number = F.col("num_instalment_number")
    return a.payments(spark, sf).withColumns(
        {
            "num_instalment_number": F.when(number != 7, number),
            "days_entry_payment": F.datediff("entry_payment_date", F.lit("2018-05-01")),
            "_rescued_data": F.when(F.col("sk_id_prev") % 13 == 0, '{"X":"?"}'),
        }
    )


cte(
    "screened",
    """SELECT * REPLACE (nullif(num_instalment_number, 7) AS num_instalment_number),
         CASE WHEN sk_id_prev % 13 = 0 THEN '{"X":"?"}' END AS _rescued_data FROM payments""",
    "payments",
)


@query(
    "rules_apply",
    _PAYMENT,
    "SELECT * FROM screened WHERE _rescued_data IS NULL AND num_instalment_number IS NOT NULL",
    "screened",
)
def rules_apply(spark, sf):
    return r.screen(screened_payments(spark, sf), RULES["installments_payments"]).kept


@query(
    "quarantine",
    Columns(
        ints="sk_id_prev num_instalment_number num_instalment_version",
        nums="amt_payment",
        days="instalment_date entry_payment_date",
        texts="failed_rules",
    ),
    """SELECT *, concat_ws(',', CASE WHEN num_instalment_number IS NULL
           THEN 'instalment_identified' END,
         CASE WHEN _rescued_data IS NOT NULL THEN 'no_rescued_data' END) AS failed_rules
       FROM screened WHERE _rescued_data IS NOT NULL OR num_instalment_number IS NULL""",
    "screened",
)
def quarantine(spark, sf):
    _, broken = r.split_by_rules(screened_payments(spark, sf), RULES["installments_payments"])
    return broken.withColumn("failed_rules", F.array_join(r.BROKEN, ","))


@query(
    "rule_counters",
    Columns(ints="passed_records failed_records", texts="dataset expectation action"),
    """SELECT * FROM (
         SELECT 'client_month' AS dataset, unnest([
           {'expectation': 'sk_id_curr_not_null', 'action': 'fail',
            'passed_records': count(sk_id_curr), 'failed_records': count(*) - count(sk_id_curr)},
           {'expectation': 'month_not_null', 'action': 'fail',
            'passed_records': count(month), 'failed_records': count(*) - count(month)},
           {'expectation': 'default_flag_matches_max_dpd', 'action': 'fail',
            'passed_records': count(*) FILTER (default_flag = coalesce(max_dpd >= 90, false)),
            'failed_records': count(*) FILTER (default_flag <> coalesce(max_dpd >= 90, false))},
           {'expectation': 'default_start_month_matches_flag', 'action': 'fail',
            'passed_records': count(*) FILTER (default_flag = (default_start_month IS NOT NULL)
                                               AND coalesce(default_start_month <= month, true)),
            'failed_records': count(*) - count(*) FILTER (
              default_flag = (default_start_month IS NOT NULL)
              AND coalesce(default_start_month <= month, true))},
           {'expectation': 'exposure_amount_not_negative', 'action': 'warn',
            'passed_records': count(*) FILTER (exposure_amount IS NULL OR exposure_amount >= 0),
            'failed_records': count(*) FILTER (exposure_amount < 0)},
           {'expectation': 'macro_columns_present', 'action': 'warn',
            'passed_records': count(*) FILTER (macro_urgent IS NOT NULL AND macro_high IS NOT NULL
                                               AND macro_medium IS NOT NULL),
            'failed_records': count(*) FILTER (macro_urgent IS NULL OR macro_high IS NULL
                                               OR macro_medium IS NULL)}], recursive := true)
         FROM client_month
         UNION ALL
         SELECT 'installments_payments', unnest([
           {'expectation': 'sk_id_prev_not_null', 'action': 'fail',
            'passed_records': count(*), 'failed_records': 0},
           {'expectation': 'sk_id_curr_not_null', 'action': 'fail',
            'passed_records': count(*), 'failed_records': 0},
           {'expectation': 'no_rescued_data', 'action': 'drop',
            'passed_records': count(*) - count(_rescued_data),
            'failed_records': count(_rescued_data)},
           {'expectation': 'instalment_identified', 'action': 'drop',
            'passed_records': count(num_instalment_number),
            'failed_records': count(*) - count(num_instalment_number)},
           {'expectation': 'previous_application_exists', 'action': 'warn',
            'passed_records': count(*) FILTER (has_previous_application),
            'failed_records': count(*) FILTER (NOT has_previous_application)},
           {'expectation': 'amt_instalment_positive', 'action': 'warn',
            'passed_records': count(*) FILTER (amt_instalment > 0),
            'failed_records': count(*) FILTER (amt_instalment <= 0)},
           {'expectation': 'payment_recorded', 'action': 'warn',
            'passed_records': count(entry_payment_date),
            'failed_records': count(*) - count(entry_payment_date)}], recursive := true)
         FROM screened)""",
    "client_month screened",
)
def rule_counters(spark, sf):
    monthly = [
        Rule(x.name, x.action, "macro_urgent IS NOT NULL AND macro_high IS NOT NULL "
             "AND macro_medium IS NOT NULL") if x.name == "macro_columns_present" else x
        for x in RULES["client_month"]
    ]
    counted = {
        "client_month": r.count_by_rule(client_month(spark, sf), monthly),
        "installments_payments": r.count_by_rule(
            screened_payments(spark, sf), RULES["installments_payments"]
        ),
    }
    return counted["client_month"].withColumn("dataset", F.lit("client_month")).unionByName(
        counted["installments_payments"].withColumn("dataset", F.lit("installments_payments"))
    )


@query(
    "rule_results",
    Columns(
        ints="passed_records failed_records",
        nums="pass_rate",
        texts="update_id dataset expectation update_ts",
    ),
    """SELECT rule_report.*, CAST(first_ts - INTERVAL 1 HOUR AS VARCHAR) AS update_ts
       FROM rule_report JOIN (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS update_id,
                                     min(ts) AS first_ts FROM events GROUP BY 1) USING (update_id)""",
    "rule_report",
)
def rule_results(spark, sf):
    return r.report(a.rule_events(spark, sf))


@query(
    "latest_violations",
    Columns(
        ints="passed_records failed_records", nums="pass_rate", texts="dataset expectation"
    ),
    """SELECT * FROM rule_report WHERE failed_records > 0
         AND update_id = (SELECT max(update_id) FROM rule_report)""",
    "rule_report",
)
def latest_violations(spark, sf):
    return r.latest_violations(r.report(a.rule_events(spark, sf)))


@query(
    "upsert_null_safe",
    Columns(ints="part n", texts="segment"),
    """SELECT segment, part, n FROM (
         SELECT nullif(o_orderstatus, 'P') AS segment, o_custkey AS part, -count(*) AS n
         FROM orders GROUP BY 1, 2
         UNION ALL
         SELECT nullif(o_orderstatus, 'P'), o_custkey, count(*) FROM orders GROUP BY 1, 2
         HAVING NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
       ) QUALIFY row_number() OVER (PARTITION BY segment, part ORDER BY
           (n < 0) = (EXISTS (SELECT 1 FROM customer WHERE c_custkey = part AND c_acctbal > 0)) DESC,
           n DESC) = 1""",
)
def upsert_null_safe(spark, sf):
    """Counts by a key with nulls; the rows of rich clients are updated to negative counts."""
    orders = a.table(spark, sf, "orders")
    rich = a.table(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey")
    key = [F.expr("nullif(o_orderstatus, 'P')").alias("segment"), F.col("o_custkey").alias("part")]
    counts = orders.groupBy(*key).agg(F.count("*").alias("n"))
    updates = counts.join(rich, counts.part == rich.c_custkey, "left_semi")
    updates = updates.withColumn("n", -F.col("n"))
    target = LoadedTable(spark, scratch_folder(spark, "upsert"))
    target.upsert(counts, ["segment", "part"])
    target.upsert(updates, ["segment", "part"])
    return target.read()


@query(
    "check_rules_evaluated",
    Columns(texts="dataset expectation action problem", ints="failed_records"),
    """SELECT c.kind AS dataset, 'value_large' AS expectation, 'fail' AS action,
         CASE WHEN failed_records IS NULL THEN 'not evaluated' ELSE 'broken' END AS problem,
         failed_records
       FROM (SELECT DISTINCT event_type AS kind FROM events
             UNION ALL SELECT DISTINCT c_mktsegment FROM customer) c
       LEFT JOIN (SELECT * FROM rule_report
                  WHERE update_id = (SELECT max(update_id) FROM rule_report)) ON dataset = c.kind
       WHERE failed_records IS NULL OR failed_records > 0""",
    "rule_report",
)
def check_rules_evaluated(spark, sf):
    """Expected: one fail rule per event type and per market segment (those have no counters)."""
    kinds = a.table(spark, sf, "events").select(F.col("event_type").alias("dataset")).distinct()
    segments = a.table(spark, sf, "customer").select("c_mktsegment").distinct()
    expected = kinds.union(segments).withColumns(
        {"expectation": F.lit("value_large"), "action": F.lit("fail")}
    )
    results = r.report(a.rule_events(spark, sf))
    latest = results.where(F.col("update_ts") == results.agg(F.max("update_ts")).scalar())
    return r.not_evaluated(latest, expected)


@query(
    "merge_report",
    Columns(
        ints="passed_records failed_records", nums="pass_rate", texts="update_id dataset expectation"
    ),
    "SELECT * FROM rule_report",
    "rule_report",
)
def merge_report(spark, sf):
    """The report merged onto an older state of itself: counters replaced, new updates added."""
    results = r.report(a.rule_events(spark, sf))
    stale = results.where("dataset <> 'click'").withColumn("passed_records", F.lit(0).cast("bigint"))
    return merge_rows(stale, results, r.REPORT_KEY)




@query(
    "check_report",
    Columns(ints="rows keys repeated only_report only_log"),
    """SELECT count(*) AS rows, count(*) AS keys, 0 AS repeated, 0 AS only_report, 0 AS only_log
       FROM rule_report""",
    "rule_report",
)
def check_report(spark, sf):
    """The report's key is unique, and its counters are those of the event log, counted another way."""
    events = a.rule_events(spark, sf)
    results = r.report(events)
    keys = checks.key_profile(results, r.REPORT_KEY)
    # The same counters straight from the rows the events were made of.
    good = (F.col("value") >= 10).cast("bigint")
    day = F.col("ts").cast("date").cast("string")
    plain = (
        a.table(spark, sf, "events")
        .groupBy(day.alias("update_id"), F.col("event_type").alias("dataset"))
        .agg(F.sum(good).alias("passed_records"), F.sum(1 - good).alias("failed_records"))
    )
    differ = checks.multiset_difference(results.select(plain.columns), plain)
    return keys.crossJoin(
        F.broadcast(differ.withColumnsRenamed({"only_first": "only_report", "only_second": "only_log"}))
    )
