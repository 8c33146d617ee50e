from datetime import date

import pytest
from pyspark.sql import functions as F

from duebook.operators import checks, layout, measures, replay
from duebook.plans.jobs import LAYOUTS, write_layouts
from tests.helpers import plan, rows, same


@pytest.fixture(scope="module")
def table(spark):
    """10 000 rows, 12 months; client 7 holds a third of all rows."""
    return spark.range(10_000).select(
        F.col("id").alias("sk_id_prev"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("sk_id_curr"),
        F.add_months(F.lit(date(2017, 1, 1)), (F.col("id") % 12).cast("int")).alias("month"),
        (F.col("id") % 120).cast("int").alias("dpd"),
    )


@pytest.fixture(scope="module")
def copies(spark, table):
    from duebook.session import scratch_folder

    folder = scratch_folder(spark, "layouts")
    write_layouts(table, folder, files=8)
    return folder


def test_all_layouts_hold_the_same_rows(spark, table, copies):
    for name in LAYOUTS:
        [diff] = checks.multiset_difference(table, spark.read.parquet(f"{copies}/{name}")).collect()
        assert tuple(diff) == (0, 0), name


def test_a_hot_key_is_spread_over_files(spark, copies):
    sizes = (
        spark.read.parquet(f"{copies}/clustered").groupBy(F.col("_metadata.file_name")).count().collect()
    )
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * 10_000 / 8


def test_layouts_read_fewer_files_for_selective_filters(spark, copies):
    filters = {
        "client": F.col("sk_id_curr") == 250,
        "months": F.col("month").between(F.lit(date(2017, 3, 1)), F.lit(date(2017, 4, 1))),
    }
    hit = {
        name: tuple(layout.files_with_rows(spark.read.parquet(f"{copies}/{name}"), **filters).first())
        for name in LAYOUTS
    }
    assert hit["scattered"][0] >= 5 and hit["scattered"][1] == 8
    assert hit["clustered"][0] == 1
    assert hit["partitioned"][1] <= 5
    assert hit["zordered"][0] <= 3 and hit["zordered"][1] <= 6


def test_month_filter_prunes_partitions(spark, copies):
    df = spark.read.parquet(f"{copies}/partitioned").where(F.col("month") == F.lit(date(2017, 3, 1)))
    assert "PartitionFilters: [isnotnull(month" in plan(df)


def test_file_stats(spark, copies):
    [stats] = layout.file_stats(spark, f"{copies}/clustered").collect()
    assert stats.files == 8 and stats.bytes > 0


def test_layout_queries(spark, table):
    assert measures.rows_of_key(table, "sk_id_curr", 250).count() == 13
    clients = table.select("sk_id_curr").distinct().withColumn("kind", F.col("sk_id_curr") % 2)
    plain = table.join(clients, "sk_id_curr").groupBy("kind").agg(
        F.count("*").alias("n"), F.max("dpd").alias("max_dpd")
    )
    assert rows(measures.worst_by_attribute(table, clients, "sk_id_curr", "kind")) == rows(plain)
    assert measures.defaults_by_month(table).agg(F.sum("n_default")).first()[0] == table.where("dpd >= 90").count()


def test_medians(spark):
    data = [("a", None, 1), ("a", None, 2), ("a", None, 9), ("a", None, 10), ("b", 1, 7), ("b", 1, None), ("c", 1, None)]
    df = spark.createDataFrame(data, "q STRING, l INT, ms INT").withColumn("files", F.col("ms") * 2)
    same(measures.medians(df, ["q", "l"], ["ms", "files"]), [("a", None, 5, 11), ("b", 1, 7, 14)])


def test_replay(spark, folder):
    text = spark.createDataFrame(
        [("2", "6.0", "-5", "10.5"), ("1", "1.0", "", "3"), ("1", "2.0", "-9", ""), ("3", "", "", "")],
        "ID STRING, DUE STRING, PAID STRING, AMT STRING",
    )
    events = replay.typed_from_text(text, "ID BIGINT, DUE INT, PAID INT, AMT DOUBLE")
    same(events, [(2, 6, -5, 10.5), (1, 1, None, 3.0), (1, 2, -9, None), (3, None, None, None)])
    batched = replay.cut_into_batches(events, replay.replay_order(events, "PAID", "DUE"), 3)
    same(batched, [(1, 0, 0), (2, 1, 0), (1, 2, 0), (3, 3, 1)], "ID", "position", "batch")
    replay.write_batches(batched, folder)
    lines = spark.read.text(f"{folder}/batch=0").collect()
    assert [r.value for r in lines] == [
        '{"ID":1,"DUE":2,"PAID":-9,"AMT":null}',
        '{"ID":2,"DUE":6,"PAID":-5,"AMT":10.5}',
        '{"ID":1,"DUE":1,"PAID":null,"AMT":3.0}',
    ]
    assert replay.cut_into_batches(events, replay.replay_order(events, "PAID", "DUE"), 3, 1).count() == 3
    with pytest.raises(ValueError):
        replay.cut_into_batches(events, [F.asc("ID")], 0)
    same(replay.sample_of_keys(events, "ID", 2).select("ID"), [(2,)])
    same(replay.first_rows(events, [F.asc("ID"), F.asc("DUE")], 2).select("ID", "DUE"), [(1, 1), (1, 2)])


def test_correction(spark):
    from decimal import Decimal

    df = spark.createDataFrame([("1.005", "Married"), (None, "Widow"), ("10", None)], "a STRING, s STRING")
    same(
        replay.corrected(df, "a", "s"),
        [(Decimal("1.106"), "Single / not married"), (None, "Married"), (Decimal("11.000"), "Married")],
    )


def test_checks_find_broken_tables(spark, table):
    same(checks.repeated_keys(table.where("sk_id_prev < 9"), ["sk_id_curr"]), [(7, 4)])
    source = spark.createDataFrame([(1,), (2,), (3,)], "k INT")
    same(checks.keys_covered(spark.createDataFrame([(1,), (2,), (9,)], "k INT"), [source, source], ["k"]), [(3, 3, 1, 1)])
    same(checks.orphan_count(source, source.where("k > 1"), ["k"]), [(1,)])
    chain = spark.createDataFrame(
        [
            (1, date(2018, 1, 1), True, date(2018, 1, 1)), (1, date(2018, 2, 1), True, date(2018, 2, 1)),
            (1, date(2018, 4, 1), True, date(2018, 1, 1)), (2, date(2018, 1, 1), False, None),
        ],
        "sk_id_curr INT, month DATE, default_flag BOOLEAN, default_start_month DATE",
    )
    same(checks.broken_episodes(chain), [(date(2018, 2, 1),), (date(2018, 4, 1),)], "month")
    a = spark.createDataFrame([(1, None)] * 3 + [(2, "x")], "i INT, s STRING")
    b = spark.createDataFrame([(1, None), (3, "y")], "i INT, s STRING")
    same(checks.multiset_difference(a, b), [(3, 1)])
    assert checks.tables_with_column({"a": a, "source": source}, "s") == {"a": True, "source": False}


def test_a_hot_key_of_the_scattered_copy_is_spread(spark, folder):
    """Half of all rows on one key, which may be null."""
    for number, hot in enumerate((5, None)):
        key = F.when(F.col("id") % 2 == 0, F.lit(hot).cast("bigint")).otherwise(F.col("id"))
        df = spark.range(20_000).select("id", key.alias("k"))
        layout.write_scattered(df, f"{folder}/{number}", 8, "k")
        sizes = sorted(r.rows for r in layout.file_spans(spark.read.parquet(f"{folder}/{number}"), ["k"]).collect())
        assert sum(sizes) == 20_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2], sizes


def test_skipping_by_spans(spark):
    spans = spark.createDataFrame([("a", 3, 1, 5), ("b", 4, 6, 9), ("c", 2, None, None)], "file STRING, rows INT, low_k INT, high_k INT")
    same(layout.skipping(spans, one=("k", 5, 5), wide=("k", 0, 7), none=("k", 10, 11)), [("one", 1, 2, 3), ("wide", 2, 1, 7), ("none", 0, 3, 0)],
         "filter", "files_read", "files_pruned", "rows_read")
