"""Queries: physical layouts, the four layout queries, medians."""

from datetime import date

from pyspark.sql import functions as F

from duebook.operators import layout, measures
from duebook.operators.columns import stack_labelled
from duebook.operators.exposure import stack_balances
from duebook.plans.jobs import LAYOUTS, write_layouts
from duebook.session import scratch_folder
from duebook.workload import adapters as a
from duebook.workload.loans import contract_month
from duebook.workload.registry import Columns, query

KEYS = ("sk_id_curr", "month")
FILES = 16
RANGE = (date(2000, 1, 1), date(2000, 3, 1))
_ROWS = Columns(ints="sk_id_prev sk_id_curr sk_dpd", days="month", texts="contract_type")
_SQL = "SELECT sk_id_prev, sk_id_curr, month, sk_dpd, contract_type FROM balances"


def balances(spark, sf):
    return stack_balances(a.pos_cash(spark, sf), a.cards(spark, sf))


def _layout_query(name, write):
    def build(spark, sf):
        folder = scratch_folder(spark, name)
        write(balances(spark, sf), folder)
        return spark.read.parquet(folder)

    query(name, _ROWS, _SQL, "balances")(build)


_layout_query("layout_scatter", lambda df, to: layout.write_scattered(df, to, FILES, "sk_id_prev"))
_layout_query("layout_range", lambda df, to: layout.write_clustered(df, to, FILES, KEYS))
_layout_query("layout_partitioned", lambda df, to: layout.write_partitioned(df, to, FILES, "month"))
_layout_query("layout_zorder", lambda df, to: layout.write_zordered(df, to, FILES, KEYS))


@query(
    "layout_stats",
    Columns(ints="rows", flags="skips_clients skips_months few_files", texts="layout"),
    """SELECT layout, n AS rows, layout IN ('clustered', 'zordered') AS skips_clients,
         layout IN ('partitioned', 'zordered') AS skips_months, true AS few_files
       FROM (SELECT count(*) AS n FROM balances),
         (SELECT unnest(['scattered', 'clustered', 'partitioned', 'zordered']) AS layout)""",
    "balances",
)
def layout_stats(spark, sf):
    """Of each copy: its rows, whether the two selective queries skip a quarter of its files or more,
    and whether it has no more files than asked.

    What is compared are facts that follow from the layouts; the figures themselves (files, bytes,
    files read and pruned) are those of ``layout_figures``.
    """
    figures = layout_figures(spark, sf)
    per_copy = figures.groupBy("layout").agg(
        F.max("rows").alias("rows"),
        F.bool_or((F.col("filter") == "client") & (F.col("files_read") * 4 <= F.col("files") * 3)).alias("skips_clients"),
        F.bool_or((F.col("filter") == "range") & (F.col("files_read") * 4 <= F.col("files") * 3)).alias("skips_months"),
        # A copy by month has a folder per month and the hot months' files in several tasks.
        F.bool_and((F.col("files") <= FILES) | (F.col("layout") == "partitioned")).alias("few_files"),
    )
    return per_copy


def layout_figures(spark, sf):
    """Files and bytes of each copy, and what the two selective queries read of it.

    Grain: one row per copy and query.
    """
    folder = scratch_folder(spark, "layouts")
    stats = write_layouts(balances(spark, sf), folder, FILES)
    client = measures.middle_key(a.table(spark, sf, "customer"), "c_custkey").first()[0]
    wanted = {"client": ("sk_id_curr", client, client), "range": ("month", *RANGE)}
    found = {}
    for name in LAYOUTS:
        spans = layout.file_spans(spark.read.parquet(f"{folder}/{name}"), KEYS)
        rows = spans.agg(F.sum("rows").alias("rows"))
        found[name] = layout.skipping(spans, **wanted).crossJoin(F.broadcast(rows))
    return stats.join(stack_labelled(found, "layout"), "layout")


def client_dimension(spark, sf):
    return a.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("sk_id_curr"), "c_mktsegment"
    )


@query(
    "bench_lookup",
    Columns(ints="sk_id_prev sk_id_curr dpd", nums="exposure_amount", days="month"),
    """SELECT * FROM contract_month
       WHERE sk_id_curr = (SELECT quantile_disc(c_custkey, 0.5) FROM customer)""",
    "contract_month",
)
def bench_lookup(spark, sf):
    client = measures.middle_key(a.table(spark, sf, "customer"), "c_custkey").first()[0]
    return measures.rows_of_key(contract_month(spark, sf), "sk_id_curr", client)


@query(
    "bench_month_range",
    Columns(ints="n", nums="total"),
    """SELECT count(*) AS n, sum(exposure_amount) AS total FROM contract_month
       WHERE month BETWEEN DATE '2000-01-01' AND DATE '2000-03-01'""",
    "contract_month",
)
def bench_month_range(spark, sf):
    return measures.month_range(contract_month(spark, sf), *RANGE)


@query(
    "bench_join",
    Columns(ints="n max_dpd", texts="c_mktsegment"),
    """SELECT c_mktsegment, count(*) AS n, max(dpd) AS max_dpd
       FROM contract_month JOIN customer ON c_custkey = sk_id_curr GROUP BY 1""",
    "contract_month",
)
def bench_join(spark, sf):
    return measures.worst_by_attribute(
        contract_month(spark, sf), client_dimension(spark, sf), "sk_id_curr", "c_mktsegment"
    )


@query(
    "bench_month_agg",
    Columns(ints="n n_default", days="month"),
    """SELECT month, count(*) AS n, count(*) FILTER (dpd >= 90) AS n_default
       FROM contract_month GROUP BY 1""",
    "contract_month",
)
def bench_month_agg(spark, sf):
    return measures.defaults_by_month(contract_month(spark, sf))


@query(
    "bench_summary",
    Columns(ints="layout k second", texts="event_type"),
    """SELECT event_type, user_id % 4 AS layout,
         CAST(floor(median(CAST(props::JSON->>'k' AS INTEGER))) AS BIGINT) AS k,
         CAST(floor(median(CAST(floor(epoch(ts)) AS BIGINT) % 3600)) AS BIGINT) AS second
       FROM events GROUP BY 1, 2""",
)
def bench_summary(spark, sf):
    """Medians of two measures by two labels, cut to whole numbers."""
    events = a.table(spark, sf, "events").select(
        "event_type",
        (F.col("user_id") % 4).alias("layout"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (60 * F.minute("ts") + F.second("ts")).alias("second"),
    )
    return measures.medians(events, ["event_type", "layout"], ["k", "second"])


@query(
    "approx_median",
    Columns(ints="o_orderkey"),
    "SELECT quantile_disc(o_orderkey, 0.5) AS o_orderkey FROM orders",
)
def approx_median(spark, sf):
    return measures.middle_key(a.table(spark, sf, "orders"), "o_orderkey")
