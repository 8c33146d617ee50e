from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType
import pytest

from duebook.operators.matching import newest_per_key
from duebook.sources import files as f
from duebook.sources.loads import LoadedTable, load_new_files
from duebook.streaming.ingest import ingest_csv, ingest_json, rows_per_file
from tests.helpers import plan, rows, same


def lines(spark, folder, name, *text):
    spark.createDataFrame([(t,) for t in text], "value STRING").coalesce(1).write.text(f"{folder}/{name}")


SCHEMA = StructType().add("ID", LongType()).add("STATUS", StringType()).add("AMT", DoubleType())


def test_hints_win_over_inference_and_the_kept_schema_over_new_files(spark, folder):
    lines(spark, folder, "in/a", "ID,STATUS,N", "1,0,5", "2,1,6")
    schema = f.hinted_schema(spark, f"{folder}/in/a", "STATUS STRING, ID BIGINT", keep_at=f"{folder}/kept")
    assert [x.dataType.simpleString() for x in schema] == ["bigint", "string", "int"]
    lines(spark, folder, "in/b", "ID,STATUS,N", "x,C,y")
    again = f.hinted_schema(spark, f"{folder}/in/*", "STATUS STRING", keep_at=f"{folder}/kept")
    assert again == schema


def test_json_hints_add_columns_not_seen_yet(spark, folder):
    lines(spark, folder, "a", '{"A": 1}')
    schema = f.hinted_schema(spark, f"{folder}/a", "A INT, B STRING", "json")
    assert schema.simpleString() == "struct<A:int,B:string>"


def test_csv_rescue(spark, folder):
    lines(spark, folder, "a", "ID,STATUS,AMT", "1,C,2.5", "x,X,much", ",,", "4,0,1.0,extra")
    df = f.read_csv(spark, f"{folder}/a", SCHEMA)
    assert df.columns == ["ID", "STATUS", "AMT", "_rescued_data", "_ingested_at", "_source_file"]
    same(
        df.select("ID", "STATUS", "AMT", "_rescued_data"),
        [
            (1, "C", 2.5, None),
            (None, "X", None, '{"ID":"x","AMT":"much"}'),
            (None, None, None, None),
            (4, "0", 1.0, '{"_line":"4,0,1.0,extra"}'),
        ],
    )
    assert df.where("_ingested_at IS NULL OR _source_file IS NULL").count() == 0


def test_csv_with_another_header_is_refused_where_asked(spark, folder):
    lines(spark, folder, "a", "STATUS,ID,AMT", "C,1,2.5")
    with pytest.raises(Exception, match="(?i)header"):
        f.read_csv(spark, f"{folder}/a", SCHEMA, strict=True).collect()


CHANGED = {
    "a": ["ID,STATUS,AMT", "1,C,2.5", "x,X,1", "", "2,0"],
    "b": ["amt,Id,NEW,STATUS", '3.5,3,"n, 3",C', "4.5,4,,D", "5,5,n5,E,more"],
    "c": ["STATUS", "only"],
    "d": ["ID,NEW,NEW,STATUS,AMT,ID", "6,p,q,F,6.5,77", "ID,NEW,NEW,STATUS,AMT,ID"],
    "e": ["ID,AMT"],
    "f": [],
}
EXPECTED = [
    (1, "C", 2.5, None),
    (None, "X", 1.0, '{"ID":"x"}'),
    (2, "0", None, '{"_line":"2,0"}'),
    (3, "C", 3.5, '{"NEW":"n, 3"}'),
    (4, "D", 4.5, None),
    (5, "E", 5.0, '{"NEW":"n5","_line":"5,5,n5,E,more"}'),
    (None, "only", None, None),
    (6, "F", 6.5, '{"NEW":"p","NEW#3":"q","ID#6":"77"}'),
]


def test_csv_with_changed_headers(spark, folder):
    """Reordered, additional, missing and repeated columns; a header without rows, an empty file."""
    for name, text in CHANGED.items():
        lines(spark, folder, f"in/{name}", *text)
    columns = ("ID", "STATUS", "AMT", "_rescued_data")
    same(f.read_csv(spark, f"{folder}/in", SCHEMA).select(*columns), EXPECTED)
    assert ingest_csv(spark, f"{folder}/in/*", f"{folder}/raw", f"{folder}/state", SCHEMA, files_per_batch=2) == len(EXPECTED)
    same(spark.read.parquet(f"{folder}/raw").select(*columns), EXPECTED)
    lines(spark, folder, "in/g", "AMT,ID", "9.5,9")
    assert ingest_csv(spark, f"{folder}/in/*", f"{folder}/raw", f"{folder}/state", SCHEMA) == 1
    same(spark.read.parquet(f"{folder}/raw").select(*columns), [*EXPECTED, (9, None, 9.5, None)])


def test_a_file_that_lands_between_the_two_streams(spark, folder, monkeypatch):
    from duebook.streaming import ingest

    lines(spark, folder, "in/a", "ID,STATUS,AMT", "1,C,2.5")
    plain, calls = ingest.keep_headers, []

    def keep(*args):
        out = plain(*args)
        if not calls:
            lines(spark, folder, "in/b", "AMT,ID", "3.5,3")
        calls.append(1)
        return out

    monkeypatch.setattr(ingest, "keep_headers", keep)
    assert ingest_csv(spark, f"{folder}/in/*", f"{folder}/raw", f"{folder}/state", SCHEMA) == 2
    assert len(calls) == 2
    same(spark.read.parquet(f"{folder}/raw").select("ID", "STATUS", "AMT"), [(1, "C", 2.5), (3, None, 3.5)])


def test_json_rescue(spark, folder):
    lines(
        spark, folder, "a",
        '{"ID": 1, "STATUS": "C", "AMT": 2.5}',
        '{"ID": "x", "STATUS": 5, "NEW": {"a": 1}}',
        "not json",
    )
    same(
        f.read_json(spark, f"{folder}/a", SCHEMA).select("ID", "STATUS", "AMT", "_rescued_data"),
        [
            (1, "C", 2.5, None),
            (None, "5", None, '{"ID":"x","NEW":"{\\"a\\":1}"}'),
            (None, None, None, '{"_line":"not json"}'),
        ],
    )


def test_landing_check_sorts_no_lines(spark, folder):
    lines(spark, folder, "a", "KEY,OBS", *(f"{i},1" for i in range(200)))
    assert "SortAggregate" not in plan(f.landing_problems(spark, f"{folder}/*", ["KEY"]))


def test_landing_problems(spark, folder):
    lines(spark, folder, "ok", '"KEY",TIME_PERIOD,OBS', "a,2018-01,1")
    lines(spark, folder, "short", "KEY,OBS", "a,1")
    lines(spark, folder, "bare", "KEY,TIME_PERIOD")
    name = F.regexp_extract("path", "/([^/]+)/part-", 1)
    out = f.landing_problems(spark, f"{folder}/*", ["KEY", "TIME_PERIOD"], ["ok", "gone", "bare", "short"], name)
    same(
        out.withColumn("missing_columns", F.array_join("missing_columns", ",")),
        [
            ("ok", "", 1, None), ("short", "TIME_PERIOD", 1, "columns missing"),
            ("bare", "", 0, "no data rows"), ("gone", None, None, "not landed"),
        ],
    )


def test_loads_append_replace_upsert_and_read_back(spark, folder):
    table = LoadedTable(spark, folder)
    assert not table.exists()
    assert table.append(spark.createDataFrame([(1, "a")], "id INT, v STRING")) == 0
    assert table.append(spark.createDataFrame([(2, "b", 5)], "id INT, v STRING, extra INT")) == 1
    assert table.upsert(spark.createDataFrame([(2, "B", 6), (None, "n", 0)], "id INT, v STRING, extra INT"), ["id"]) == 2
    assert table.upsert(spark.createDataFrame([(None, "N", 1)], "id INT, v STRING, extra INT"), ["id"]) == 3
    same(table.read(0), [(1, "a")])
    same(table.read(1), [(1, "a", None), (2, "b", 5)])
    same(table.read(2), [(1, "a", None), (2, "B", 6), (None, "n", 0)])
    same(table.read(), [(1, "a", None), (2, "B", 6), (None, "N", 1)])
    same(table.history().select("version", "operation"), [(0, "append"), (1, "append"), (2, "merge"), (3, "merge")])


def test_a_load_that_was_not_logged_is_invisible(spark, folder):
    table = LoadedTable(spark, folder)
    df = spark.createDataFrame([(1,)], "id INT")
    table.append(df)
    df.write.parquet(f"{folder}/rows/_load_version=1")  # died before the log entry
    assert table.read().count() == 1
    table.append(spark.createDataFrame([(2,)], "id INT"))
    same(table.read(), [(1,), (2,)])


def test_bulk_load_reads_every_file_once(spark, folder):
    table = LoadedTable(spark, f"{folder}/t")
    lines(spark, folder, "in/a", "ID,V", "1,x", "2,y")
    pattern = "part-*"
    assert load_new_files(spark, table, f"{folder}/in", pattern) == 1
    assert load_new_files(spark, table, f"{folder}/in", pattern) == 0
    lines(spark, folder, "in/b", "ID,V,W", "3,z,9")
    assert load_new_files(spark, table, f"{folder}/in", pattern) == 1
    assert load_new_files(spark, table, f"{folder}/in", pattern) == 0
    same(table.read().select("ID", "V", "W"), [(1, "x", None), (2, "y", None), (3, "z", 9)])


def test_streams_read_every_file_once(spark, folder):
    landing, raw, state = (f"{folder}/{n}" for n in ("in", "raw", "state"))
    lines(spark, landing, "a", "ID,STATUS,AMT", "1,C,2.5", "x,X,1")
    assert ingest_csv(spark, landing, raw, state, SCHEMA) == 2
    assert ingest_csv(spark, landing, raw, state, SCHEMA) == 0
    lines(spark, landing, "b", "ID,STATUS,AMT", "3,0,3")
    assert ingest_csv(spark, landing, raw, state, SCHEMA) == 1
    table = spark.read.parquet(raw)
    same(table.select("ID", "_rescued_data"), [(1, None), (None, '{"ID":"x"}'), (3, None)])
    assert rows(rows_per_file(table), "rows") == [(1,), (2,)]


def test_json_stream_equals_batch_read(spark, folder):
    lines(spark, folder, "in/a", '{"ID": 1, "STATUS": "C"}', '{"ID": 2, "AMT": "bad"}')
    ingest_json(spark, f"{folder}/in", f"{folder}/raw", f"{folder}/state", SCHEMA)
    columns = ("ID", "STATUS", "AMT", "_rescued_data")
    assert rows(spark.read.parquet(f"{folder}/raw"), *columns) == rows(
        f.read_json(spark, f"{folder}/in/*", SCHEMA), *columns
    )
    assert newest_per_key(spark.read.parquet(f"{folder}/raw"), ["ID"]).count() == 2


def test_one_load_of_files_with_different_headers(spark, folder):
    lines(spark, folder, "in/a.csv", "id,amt", "1,10.5", "2,20.5")
    lines(spark, folder, "in/b.csv", "amt,id,more", "30.5,3,x")
    lines(spark, folder, "in/c.csv", "id", "4")
    table = LoadedTable(spark, f"{folder}/table")
    assert load_new_files(spark, table, f"{folder}/in", "part-*") == 3
    assert load_new_files(spark, table, f"{folder}/in", "part-*") == 0
    out = table.read()
    assert {f.name: f.dataType.simpleString() for f in out.schema.fields if f.name[0] != "_"} == {
        "id": "int", "amt": "double", "more": "string",
    }
    same(out.select("id", "amt", "more"), [(1, 10.5, None), (2, 20.5, None), (3, 30.5, "x"), (4, None, None)])


def test_rows_of_more_batches_than_spark_remembers(spark, folder):
    for i in range(6):
        lines(spark, folder, f"in/f{i}", "ID,STATUS,AMT", f"{i},C,1.0")
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        added = ingest_csv(spark, f"{folder}/in", f"{folder}/raw", f"{folder}/state", SCHEMA, files_per_batch=1)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert added == 6
