import random
from datetime import datetime

import pytest

from duebook.fixed_values import Rule
from duebook.operators.history import build_versions
from duebook.streaming.changes import VersionedStream
from tests.helpers import plan, rows

SCHEMA = "id INT, colour STRING, _rescued_data STRING, _ingested_at TIMESTAMP, _source_file STRING"
DAY = [datetime(2026, 1, d) for d in range(1, 29)]
RULES = [
    Rule("id_not_null", "fail", "id IS NOT NULL"),
    Rule("no_rescued_data", "drop", "_rescued_data IS NULL"),
]


def land(spark, folder, *data):
    df = spark.createDataFrame([(i, c, r, t, "f") for i, c, r, t in data], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return df


def run(spark, folder):
    kept = VersionedStream(spark, f"{folder}/h", ["id"], rules=RULES, buckets=4)
    kept.run(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"))
    return kept


def test_late_deliveries_fall_into_place(spark, folder):
    all_rows = land(spark, folder, (1, "A", None, DAY[1]), (2, "Z", None, DAY[1]))
    run(spark, folder)
    all_rows = all_rows.union(land(spark, folder, (1, "A", None, DAY[5]), (3, "Q", "{}", DAY[2])))
    run(spark, folder)
    all_rows = all_rows.union(land(spark, folder, (1, "B", None, DAY[3])))
    kept = run(spark, folder)
    expected = build_versions(all_rows.where("_rescued_data IS NULL"), ["id"])
    assert rows(kept.versions()) == rows(expected)
    assert [r[1] for r in rows(kept.versions().where("id = 1").orderBy("__START_AT"))].count("A") == 2
    run(spark, folder)  # nothing new
    assert rows(kept.versions()) == rows(expected)


def test_fail_rules_stop_the_stream(spark, folder):
    land(spark, folder, (1, "A", None, DAY[1]))
    run(spark, folder)
    land(spark, folder, (None, "A", None, DAY[2]))
    with pytest.raises(Exception, match="id_not_null"):
        run(spark, folder)


def history(spark, folder, batches, **more):
    """Lands ``batches`` one by one and runs after each; returns the stream and all rows."""
    total, kept = None, None
    for data in batches:
        one = land(spark, folder, *data)
        total = one if total is None else total.union(one)
        kept = VersionedStream(spark, f"{folder}/h", ["id"], buckets=4, **more)
        kept.run(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"))
    return kept, total


def test_many_batches_with_late_rows_and_compaction(spark, folder):
    rnd = random.Random(5)
    batches = []
    for n in range(4):
        data = [(rnd.choice([1, 2, 3, None]), rnd.choice("AB"), None, DAY[rnd.randint(3 * n, 3 * n + 5)]) for _ in range(6)]
        if n > 1:
            data += [(rnd.choice([1, 2, 9]), rnd.choice("ABC"), None, DAY[rnd.randint(0, 3 * n)]) for _ in range(3)]
        batches.append([(i, c, f"{k}", t) for k, (i, c, _, t) in enumerate(data)])
    batches.append([(2, "Z", None, DAY[0]), (3, "Z", None, None), (7, "N", None, None), (7, "N", None, DAY[4])])
    kept, total = history(spark, folder, batches[:3])
    assert rows(kept.versions()) == rows(build_versions(total, ["id"]))
    kept.compact()
    kept.compact()  # nothing left to fold
    assert rows(kept.versions()) == rows(build_versions(total, ["id"]))
    kept, more = history(spark, folder, batches[3:])
    total = total.union(more)
    assert rows(kept.versions()) == rows(build_versions(total, ["id"]))
    # A stream opened only to read knows the columns from its folder.
    fresh = VersionedStream(spark, f"{folder}/h", ["id"], buckets=4)
    assert rows(fresh.versions()) == rows(build_versions(total, ["id"]))
    fresh.compact()
    assert rows(fresh.versions()) == rows(build_versions(total, ["id"]))


def test_a_repeated_batch_changes_nothing(spark, folder):
    kept, total = history(spark, folder, [[(1, "A", None, DAY[1])], [(1, "B", None, DAY[4]), (2, "A", None, DAY[4])]])
    again = land(spark, folder, (1, "C", None, DAY[2]), (2, "B", None, DAY[9]))
    for _ in range(2):
        kept._batch(again, 2)
        assert rows(kept.versions()) == rows(build_versions(total.union(again), ["id"]))


def test_a_batch_does_not_read_the_log(spark, folder, monkeypatch):
    """Rows on time meet the open versions only; a late row reads from its own version on."""
    batches = [[(k, f"{n}", None, DAY[n]) for k in range(20)] for n in range(4)]
    kept, total = history(spark, folder, batches)
    read = []
    plain = VersionedStream._read

    def seen(self, part, schema):
        read.append(part)
        return plain(self, part, schema)

    monkeypatch.setattr(VersionedStream, "_read", seen)
    built = []
    monkeypatch.setattr(VersionedStream, "_build", lambda self, df, old=VersionedStream._build: (built.append(df.count()), old(self, df))[1])
    _, more = history(spark, folder, [[(k, "x", None, DAY[20]) for k in range(20)]])
    # The log is opened once, for the rows just written, and nothing of earlier batches is built.
    assert read.count("log") == 1 and "closed" not in read[:1] and built == [40]
    read.clear(), built.clear()
    kept, late = history(spark, folder, [[(3, "y", None, DAY[2].replace(hour=5))]])
    # Key 3 is read from the start of the version that the late row splits: days 2, 3, 20 and the row.
    assert built == [0, 4]
    total = total.union(more).union(late)
    assert rows(kept.versions()) == rows(build_versions(total, ["id"]))


def test_what_grows_with_the_keys_is_not_broadcast(spark, folder):
    """A broadcast is built in the driver; cuts and open versions grow with the keys."""
    kept, _ = history(
        spark, folder, [[(1, "A", None, DAY[1]), (1, "B", None, DAY[6])], [(1, "C", None, DAY[3])]]
    )
    assert "BroadcastHashJoin" not in plan(kept.versions())
