import pytest

from duebook.cli import arguments, run
from duebook.sources.loads import LoadedTable
from tests.helpers import rows, same
from tests.test_loanbook import FILES, MACRO


def land(spark, root, name, text):
    lines = [(line,) for line in text.split("\n")]
    spark.createDataFrame(lines, "value STRING").coalesce(1).write.text(f"{root}/landing/{name}/f1.csv")


def job(spark, root, *words):
    return run(spark, arguments().parse_args(["--root", root, *words]))


def test_months_must_be_first_days():
    with pytest.raises(SystemExit):
        arguments().parse_args(["--root", "x", "snapshot", "--snapshot-id", "s", "--as-of-month", "2018-04-02"])


def test_payment_events_and_bulk_load(spark, folder):
    event = (
        '{"SK_ID_PREV": 5000, "SK_ID_CURR": 1, "NUM_INSTALMENT_VERSION": 1.0, "NUM_INSTALMENT_NUMBER": 6, '
        '"DAYS_INSTALMENT": -30.0, "DAYS_ENTRY_PAYMENT": null, "AMT_INSTALMENT": 10.5, "AMT_PAYMENT": null}'
    )
    land(spark, folder, "payment_events", f"{event}\n{event}")
    assert rows(job(spark, folder, "payments"), "rows") == [(2,)]
    assert rows(job(spark, folder, "payments"), "rows") == [(2,)]
    raw = spark.read.parquet(f"{folder}/raw/payment_events")
    assert raw.schema["DAYS_ENTRY_PAYMENT"].dataType.simpleString() == "double"
    same(raw.select("SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "_rescued_data").distinct(), [(5000, 6, None)])

    land(spark, folder, "bureau", FILES["bureau"])
    header, *lines = FILES["bureau"].split("\n")
    table = spark.createDataFrame([tuple(x.split(",")) for x in lines], header.split(","))
    table.coalesce(1).write.option("header", True).csv(f"{folder}/landing/bureau/f2")
    same(job(spark, folder, "bulk"), [("bureau", 1)])
    same(job(spark, folder, "bulk"), [("bureau", 0)])
    assert LoadedTable(spark, f"{folder}/tables/bureau_bulk").read().count() == 2


def test_layout_copies(spark, folder):
    df = spark.range(100).selectExpr(
        "id AS sk_id_prev", "id % 9 AS sk_id_curr", "add_months(DATE '2018-01-01', CAST(id % 3 AS INT)) AS month"
    )
    LoadedTable(spark, f"{folder}/tables/contract_month").append(df)
    stats = rows(job(spark, folder, "layouts", "--files", "2"), "layout", "files")
    assert dict(stats)["scattered"] == 2 and len(stats) == 4


def test_ingest_covers_every_raw_table(spark, folder, monkeypatch):
    from duebook import cli

    monkeypatch.setattr(cli, "RAW", ("bureau_balance", "hicp_yoy"))
    land(spark, folder, "bureau_balance", FILES["bureau_balance"])
    land(spark, folder, "hicp_yoy", MACRO)
    job(spark, folder, "ingest")
    assert spark.read.parquet(f"{folder}/raw/bureau_balance").count() == 6
    raw = spark.read.parquet(f"{folder}/raw/hicp_yoy")
    same(raw.select("TIME_PERIOD", "_rescued_data"), [("2017-11", None), ("2018-01", None), ("2018-Q1", None)])
