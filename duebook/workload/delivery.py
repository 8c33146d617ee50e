"""Queries: delivered files, streams, bulk loads, replay.

Each query first writes whole test tables as the files it then ingests, below the scratch folder.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.fixed_values import BLANK_TOKENS, Rule
from duebook.operators import checks, measures, replay
from duebook.operators.columns import blank_to_null, lower_names, retype, stack_by_name, stack_labelled
from duebook.operators.delinquency import settle_installments
from duebook.session import scratch_folder
from duebook.sources import files as f
from duebook.sources.loads import LoadedTable, load_new_files
from duebook.streaming.changes import VersionedStream
from duebook.streaming.ingest import drain, ingest_csv, rows_per_file
from duebook.workload import adapters as a
from duebook.workload.histories import VERSION, named
from duebook.workload.loans import INSTALLMENT
from duebook.workload.registry import Columns, query

_ORDERS = Columns(
    ints="o_orderkey o_custkey", nums="o_totalprice", texts="o_orderstatus o_orderpriority"
)
_HINTS = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING"


def _orders(spark, sf):
    return a.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


def _write_csv(df, folder):
    df.write.option("header", True).csv(folder)


@query(
    "schema_with_hints",
    Columns(ints="place", texts="name type"),
    """SELECT unnest([{'place': 0, 'name': 'o_orderkey', 'type': 'bigint'},
         {'place': 1, 'name': 'o_custkey', 'type': 'bigint'},
         {'place': 2, 'name': 'o_orderstatus', 'type': 'string'},
         {'place': 3, 'name': 'o_totalprice', 'type': 'double'},
         {'place': 4, 'name': 'o_orderpriority', 'type': 'string'}], recursive := true)""",
)
def schema_with_hints(spark, sf):
    folder = scratch_folder(spark, "csv")
    _write_csv(_orders(spark, sf), f"{folder}/in")
    f.hinted_schema(spark, f"{folder}/in", _HINTS, keep_at=f"{folder}/schema")
    schema = f.hinted_schema(spark, f"{folder}/in", _HINTS, keep_at=f"{folder}/schema")
    rows = [(i, c.name, c.dataType.simpleString()) for i, c in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "place INT, name STRING, type STRING")


@query(
    "rescue_columns",
    Columns(
        ints="o_orderkey o_custkey", nums="o_totalprice", texts="o_orderstatus _rescued_data"
    ),
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey,
         o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 77 = 0
              THEN '{"o_custkey":"x' || o_custkey || '","o_totalprice":"much"}'
              WHEN o_orderkey % 11 = 0 THEN '{"o_custkey":"x' || o_custkey || '"}'
              WHEN o_orderkey % 7 = 0 THEN '{"o_totalprice":"much"}' END AS _rescued_data
       FROM orders""",
)
def rescue_columns(spark, sf):
    """CSV with some values that do not fit their types."""
    key = F.col("o_orderkey")
    custkey, price = F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string")
    text = _orders(spark, sf).withColumns(
        {
            "o_custkey": F.when(key % 11 == 0, F.concat(F.lit("x"), custkey)).otherwise(custkey),
            "o_totalprice": F.when(key % 7 == 0, "much").otherwise(price),
        }
    )
    folder = scratch_folder(spark, "csv")
    _write_csv(text, folder)
    return f.read_csv(spark, folder, f.hinted_schema(spark, folder, _HINTS))


_CHANGED_SQL = """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
         o_totalprice, o_orderstatus,
         CASE WHEN o_orderstatus = 'F' THEN '{"o_orderpriority":"' || o_orderpriority || '"}' END AS _rescued_data,
         kind FROM orders, (SELECT unnest(['batch', 'stream']) AS kind)"""


@query(
    "rescue_changed_header",
    Columns(ints="o_orderkey o_custkey", nums="o_totalprice", texts="o_orderstatus _rescued_data kind"),
    _CHANGED_SQL,
)
def rescue_changed_header(spark, sf):
    """Files with reordered, additional and missing columns, read at once and as a stream."""
    folder = scratch_folder(spark, "headers")
    orders = _orders(spark, sf)
    headers = {
        "O": ["o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey"],
        "F": ["o_orderkey", "o_orderpriority", "o_custkey", "o_orderstatus", "o_totalprice"],
        "P": ["o_orderstatus", "o_orderkey", "o_totalprice"],
    }
    schema = StructType.fromDDL(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    )
    landing, raw, state = (f"{folder}/{n}" for n in ("landing", "raw", "state"))
    for status, columns in headers.items():
        part = orders.where(F.col("o_orderstatus") == status).select(columns)
        part.write.option("header", True).mode("append").csv(landing)
        ingest_csv(spark, landing, raw, state, schema)
    batch = f.read_csv(spark, landing, schema).withColumn("kind", F.lit("batch"))
    return batch.unionByName(spark.read.parquet(raw).withColumn("kind", F.lit("stream")))


@query(
    "rescue_json_fields",
    Columns(ints="event_id user_id", nums="value", texts="event_type _rescued_data"),
    """SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN user_id END AS user_id, value, event_type,
         CASE WHEN event_id % 9 = 0 AND event_id % 4 = 0
              THEN '{"user_id":"u' || user_id || '","props":"' || replace(props, '"', '\\"') || '"}'
              WHEN event_id % 9 = 0 THEN '{"user_id":"u' || user_id || '"}'
              WHEN event_id % 4 = 0 THEN '{"props":"' || replace(props, '"', '\\"') || '"}'
         END AS _rescued_data FROM events""",
)
def rescue_json_fields(spark, sf):
    """JSON lines with values that do not fit and a field that the schema does not know."""
    key, user = F.col("event_id"), F.col("user_id").cast("string")
    text = a.table(spark, sf, "events").select(
        "event_id",
        F.when(key % 9 == 0, F.concat(F.lit("u"), user)).otherwise(user).alias("user_id"),
        "event_type",
        "value",
        F.when(key % 4 == 0, F.col("props")).alias("props"),
    )
    folder = scratch_folder(spark, "json")
    text.write.json(folder)
    schema = StructType.fromDDL("event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    return f.read_json(spark, folder, schema)


@query(
    "ingest_metadata",
    Columns(ints="o_orderkey", flags="has_time has_file"),
    "SELECT o_orderkey, true AS has_time, true AS has_file FROM orders",
)
def ingest_metadata(spark, sf):
    path = f"{sf}/orders.parquet"
    return f.with_delivery_columns(spark.read.parquet(path)).select(
        "o_orderkey",
        F.col("_ingested_at").isNotNull().alias("has_time"),
        F.col("_source_file").endswith("orders.parquet").alias("has_file"),
    )


@query(
    "landing_check",
    Columns(ints="data_rows", texts="file missing problem"),
    """SELECT 'absent.csv' AS file, NULL AS missing, NULL AS data_rows, 'not landed' AS problem
       UNION ALL SELECT 'customer.csv', 'period', count(*), 'columns missing' FROM customer
       UNION ALL SELECT 'empty.csv', '', 0, 'no data rows'
       UNION ALL SELECT 'orders.csv', '', count(*), NULL FROM orders""",
)
def landing_check(spark, sf):
    """A good file, one without a required column, an empty one, and one that never came."""
    folder = scratch_folder(spark, "landing")
    orders = a.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.lit("2018-01").alias("period")
    )
    customer = a.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    for name, df in (
        ("orders", orders),
        ("customer", customer),
        ("empty", orders.where("key IS NULL")),
    ):
        df.write.option("header", True).csv(f"{folder}/{name}")
    part = F.regexp_extract("path", "/([^/]+)/part-", 1)
    found = f.landing_problems(
        spark, f"{folder}/*", ["key", "period"], ["absent", "orders", "customer", "empty"], part
    )
    return found.select(
        F.concat("file", F.lit(".csv")).alias("file"),
        F.array_join("missing_columns", ",").alias("missing"),
        "data_rows",
        "problem",
    )


@query(
    "bulk_load_once",
    Columns(ints="loaded_files o_orderkey", nums="o_totalprice", texts="o_orderstatus"),
    "SELECT 0 AS loaded_files, o_orderkey, o_totalprice, o_orderstatus FROM orders",
)
def bulk_load_once(spark, sf):
    """Two deliveries, the second with a new column; a last call finds nothing new."""
    folder = scratch_folder(spark, "bulk")
    orders = _orders(spark, sf)
    target = LoadedTable(spark, f"{folder}/table")
    _write_csv(
        orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice"), f"{folder}/in/a"
    )
    load_new_files(spark, target, f"{folder}/in")
    rest = orders.where("o_orderstatus <> 'O'")
    _write_csv(rest.select("o_orderkey", "o_totalprice", "o_orderstatus"), f"{folder}/in/b")
    load_new_files(spark, target, f"{folder}/in")
    again = load_new_files(spark, target, f"{folder}/in")
    return target.read().select(
        F.lit(again).alias("loaded_files"),
        "o_orderkey",
        "o_totalprice",
        F.ifnull("o_orderstatus", F.lit("O")).alias("o_orderstatus"),
    )


@query(
    "bulk_load_mixed_headers",
    Columns(ints="o_orderkey o_custkey", nums="o_totalprice", texts="o_orderstatus"),
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice, o_orderstatus FROM orders",
)
def bulk_load_mixed_headers(spark, sf):
    """One call over files with a reordered, an additional and a missing column."""
    folder = scratch_folder(spark, "bulk")
    orders = _orders(spark, sf)
    headers = {
        "O": ["o_orderkey", "o_totalprice", "o_orderstatus"],
        "F": ["o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey"],
        "P": ["o_orderstatus", "o_orderkey"],
    }
    for status, columns in headers.items():
        _write_csv(orders.where(F.col("o_orderstatus") == status).select(columns), f"{folder}/in/{status}")
    target = LoadedTable(spark, f"{folder}/table")
    load_new_files(spark, target, f"{folder}/in")
    types = {f.name: f.dataType.simpleString() for f in target.read().schema.fields}
    assert types["o_totalprice"] == "double" and types["o_orderkey"] in ("int", "bigint"), types
    return target.read()


@query(
    "stream_ingest",
    _ORDERS,
    "SELECT * FROM orders",
)
def stream_ingest(spark, sf):
    """CSV drained twice: after the first delivery and after the second one."""
    folder = scratch_folder(spark, "stream")
    landing, raw, state = (f"{folder}/{n}" for n in ("landing", "raw", "checkpoint"))
    orders = _orders(spark, sf)
    schema = StructType.fromDDL(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderpriority STRING"
    )
    for status in ("'O'", "'F', 'P'"):
        part = orders.where(f"o_orderstatus IN ({status})")
        part.write.mode("append").option("header", True).csv(landing)
        ingest_csv(spark, landing, raw, state, schema, files_per_batch=100)
        ingest_csv(spark, landing, raw, state, schema)  # nothing new: adds no row
    return spark.read.parquet(raw)


@query("rows_per_file", Columns(ints="rows"), "SELECT count(*) AS rows FROM events")
def rows_per_file_query(spark, sf):
    """Events drained from JSON lines, counted by source file and added up again."""
    folder = scratch_folder(spark, "stream")
    a.table(spark, sf, "events").select("event_id", "user_id", "value").write.json(f"{folder}/in")
    schema = StructType.fromDDL("event_id BIGINT, user_id BIGINT, value DOUBLE")
    drain(f.stream_json(spark, f"{folder}/in", schema), f"{folder}/raw", f"{folder}/checkpoint")
    per_file = rows_per_file(spark.read.parquet(f"{folder}/raw"))
    return per_file.agg(F.sum("rows").alias("rows"))


def _version_stream(spark, folder, **more):
    return VersionedStream(
        spark,
        folder,
        ["sk_id_curr"],
        "delivered_on",
        a.DELIVERY_UNTRACKED,
        newest_first=[F.desc("delivery")],
        buckets=8,
        **more,
    )


@query("scd2_stream", VERSION, "SELECT * FROM versions", "versions")
def scd2_stream(spark, sf):
    """The version history kept from a stream in five batches, each with deliveries that come late."""
    folder = scratch_folder(spark, "changes")
    deliveries = a.deliveries(spark, sf)
    kept = _version_stream(spark, f"{folder}/history")
    turn = F.pmod(F.floor(F.col("delivery") / 32) + F.floor(F.dayofyear("delivered_on") / 120), F.lit(5))
    for number in range(5):
        deliveries.where(turn == number).write.mode("append").parquet(f"{folder}/in")
        kept.run(spark.readStream.schema(deliveries.schema).parquet(f"{folder}/in"))
        if number == 2:
            kept.compact()
    return named(kept.versions())


@query(
    "scd2_stream_rules",
    VERSION,
    """SELECT *, latest.p AS price, latest.k AS delivery FROM (
       SELECT sk_id_curr, status, arg_max({'p': price, 'k': delivery}, delivered_on) AS latest,
         min(delivered_on) AS valid_from, lead(min(delivered_on)) OVER (PARTITION BY sk_id_curr ORDER BY min(delivered_on)) AS valid_to
       FROM (SELECT *, sum(opens) OVER (PARTITION BY sk_id_curr ORDER BY delivered_on) AS change
             FROM (SELECT *, CASE WHEN lag(status) OVER w IS NOT DISTINCT FROM status
                                   AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS opens
                   FROM (SELECT * FROM (
                     SELECT o_custkey AS sk_id_curr, CAST(o_orderdate AS DATE) AS delivered_on,
                       CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS status,
                       CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS price,
                       o_orderkey AS delivery FROM orders
                     WHERE o_orderstatus <> 'O' OR o_totalprice < 200000)
                   QUALIFY row_number() OVER (PARTITION BY sk_id_curr, delivered_on ORDER BY delivery DESC) = 1)
                   WINDOW w AS (PARTITION BY sk_id_curr ORDER BY delivered_on)))
       GROUP BY sk_id_curr, change, status)""",
)
def scd2_stream_rules(spark, sf):
    """Two streams with different columns, cleaned row by row, united, screened, and kept as history."""
    folder = scratch_folder(spark, "changes")
    raw = a.deliveries(spark, sf).select(
        F.col("sk_id_curr").cast("string").alias("SK_ID_CURR"),
        F.col("delivered_on").cast("string").alias("DELIVERED_ON"),
        F.when(F.col("delivery") % 13 == 0, BLANK_TOKENS[0]).otherwise(F.col("status")).alias("STATUS"),
        F.col("price").alias("PRICE"),
        F.col("delivery").alias("DELIVERY"),
    )
    is_open = F.col("OPEN") == 1
    marked = raw.join(
        a.table(spark, sf, "orders").select(F.col("o_orderkey").alias("DELIVERY"), (F.col("o_orderstatus") == "O").cast("int").alias("OPEN")),
        "DELIVERY",
    )
    feeds = {"with_price": marked.where(is_open).drop("OPEN"), "without": marked.where(~is_open).drop("OPEN", "PRICE")}
    rules = [
        Rule("sk_id_curr_not_null", "fail", "sk_id_curr IS NOT NULL"),
        Rule("price_in_range", "drop", "price IS NULL OR price < 200000"),
    ]
    kept = _version_stream(spark, f"{folder}/history", rules=rules)
    types = {"bigint": ["sk_id_curr", "delivery"], "date": ["delivered_on"]}
    for late in (False, True):
        streams = []
        for name, feed in feeds.items():
            part = feed.where((F.dayofmonth("DELIVERED_ON") > 20) == late)
            part.write.mode("append").parquet(f"{folder}/{name}")
            streams.append(spark.readStream.schema(feed.schema).parquet(f"{folder}/{name}"))
        kept.run(retype(blank_to_null(lower_names(stack_by_name(streams)), BLANK_TOKENS), types))
    return named(kept.versions())


@query("stream_equals_batch", INSTALLMENT, "SELECT * FROM installments", "installments")
def stream_equals_batch(spark, sf):
    """Payments replayed as JSON lines and settled from the streamed table.

    The lines are compressed: as plain text they take some ten times the disk of the tables.
    """
    folder = scratch_folder(spark, "events")
    payments = a.payments(spark, sf)
    payments.write.option("compression", "gzip").json(f"{folder}/in")
    stream = f.stream_json(spark, f"{folder}/in", payments.schema)
    drain(stream, f"{folder}/raw", f"{folder}/checkpoint")
    return settle_installments(spark.read.parquet(f"{folder}/raw"))




@query(
    "replay_batches",
    Columns(ints="batch SK_ID_PREV NUM DAY DUE", nums="PAID"),
    """SELECT *, CAST(floor((row_number() OVER (ORDER BY coalesce(DAY, DUE) NULLS LAST,
         SK_ID_PREV, NUM, DAY NULLS LAST, DUE, PAID NULLS LAST) - 1) / 5000) AS BIGINT) AS batch
       FROM (SELECT sk_id_prev AS SK_ID_PREV, num_instalment_number AS NUM,
               entry_payment_date - DATE '2018-05-01' AS DAY, days_instalment AS DUE,
               CAST(amt_payment AS DOUBLE) AS PAID FROM payments)""",
    "payments",
)
def replay_batches(spark, sf):
    """All payments as text, typed, put in replay order, cut, and written as JSON batches."""
    text = a.payments(spark, sf).select(
        F.col("sk_id_prev").cast("string").alias("SK_ID_PREV"),
        F.col("num_instalment_number").cast("double").cast("string").alias("NUM"),
        F.ifnull(
            F.datediff("entry_payment_date", F.lit("2018-05-01")).cast("double").cast("string"),
            F.lit(""),
        ).alias("DAY"),
        F.col("days_instalment").cast("string").alias("DUE"),
        F.ifnull(F.col("amt_payment").cast("string"), F.lit("")).alias("PAID"),
    )
    schema = "SK_ID_PREV BIGINT, NUM INT, DAY INT, DUE INT, PAID DOUBLE"
    events = replay.typed_from_text(text, schema)
    batched = replay.cut_into_batches(events, replay.replay_order(events, "DAY", "DUE"), 5000)
    folder = scratch_folder(spark, "batches")
    replay.write_batches(batched, folder)
    return spark.read.schema(f"{schema}, batch BIGINT").json(folder)


@query(
    "replay_sample",
    Columns(ints="sk_id_prev num_instalment_number", nums="amt_payment"),
    """SELECT sk_id_prev, num_instalment_number, amt_payment FROM payments
       WHERE sk_id_prev % 50 = 0""",
    "payments",
)
def replay_sample(spark, sf):
    """The sampling operator itself: all payments of the keys divisible by a number."""
    return replay.sample_of_keys(a.payments(spark, sf), "sk_id_prev", 50)


@query(
    "reconcile_multiset",
    Columns(ints="only_first only_second"),
    """SELECT (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem EXCEPT ALL
                 SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 5)) AS only_first,
              (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem
                 WHERE l_quantity > 5 EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem))
                AS only_second""",
)
def reconcile_multiset(spark, sf):
    """All line items against those of more than five pieces."""
    lines = a.table(spark, sf, "lineitem")
    keys = lines.select("l_orderkey", "l_linenumber")
    return checks.multiset_difference(
        keys, lines.where("l_quantity > 5").select("l_orderkey", "l_linenumber")
    )


@query(
    "raw_delivery",
    Columns(ints="rows rescued without_time without_file foreign_files tables_with_time"),
    """SELECT count(*) AS rows, count(*) FILTER (o_orderkey % 11 = 0) AS rescued, 0 AS without_time,
         0 AS without_file, 0 AS foreign_files, 1 AS tables_with_time FROM orders""",
)
def raw_delivery(spark, sf):
    """A raw table after its drain: rescued values, delivery columns, and files from elsewhere."""
    folder = scratch_folder(spark, "raw")
    key, custkey = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    misfit = F.when(key % 11 == 0, F.concat(F.lit("x"), custkey)).otherwise(custkey)
    _write_csv(_orders(spark, sf).withColumn("o_custkey", misfit), f"{folder}/landing/orders")
    schema = StructType.fromDDL(f"{_HINTS}, o_orderstatus STRING")
    ingest_csv(spark, f"{folder}/landing/orders", f"{folder}/raw", f"{folder}/state", schema)
    raw = spark.read.parquet(f"{folder}/raw")
    counts = measures.profile(
        raw,
        rescued="_rescued_data IS NOT NULL",
        without_time="_ingested_at IS NULL",
        without_file="_source_file IS NULL",
        foreign_files=~F.col("_source_file").contains("/landing/orders/"),
    )
    timed = checks.tables_with_column({"raw": raw, "landed": spark.read.text(f"{folder}/landing")}, "_ingested_at")
    return counts.withColumn("tables_with_time", F.lit(sum(timed.values())))


_FIRST_SQL = """SELECT 'batches' AS kind, l_orderkey, l_linenumber FROM (
         SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 200)
       UNION ALL SELECT 'rows', l_orderkey, l_linenumber FROM (
         SELECT * FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 50)"""


@query("first_batches", Columns(ints="l_orderkey l_linenumber", texts="kind"), _FIRST_SQL)
def first_batches(spark, sf):
    """The first two batches of a hundred line items by day, and the fifty dearest ones."""
    lines = a.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    by_day = [F.asc(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber")]
    batches = replay.cut_into_batches(lines, by_day, 100, first_batches=2)
    by_price = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    top = replay.first_rows(lines, by_price, 50)
    kinds = {"batches": batches.select("l_orderkey", "l_linenumber"), "rows": top.select("l_orderkey", "l_linenumber")}
    return stack_labelled(kinds, "kind")
