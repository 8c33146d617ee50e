import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from duebook.fixed_values import Rule
from duebook.operators import rules as r
from tests.helpers import rows, same

RULES = [
    Rule("id_not_null", "fail", "id IS NOT NULL"),
    Rule("positive", "drop", "v > 0"),
    Rule("even", "drop", "v % 2 = 0"),
    Rule("small", "warn", "v < 100"),
]


def frame(spark, data):
    return spark.createDataFrame(data, "id INT, v INT")


def test_kept_and_quarantined_are_complements(spark):
    df = frame(spark, [(1, 2), (2, -1), (3, None), (4, 3), (5, 200)])
    kept, broken = r.split_by_rules(df, RULES)
    same(kept, [(1, 2), (5, 200)])
    same(
        broken.withColumn("_failed_rules", F.array_join("_failed_rules", ",")),
        [(2, -1, "even,positive"), (3, None, "even,positive"), (4, 3, "even")],
    )


def test_counters_see_all_rows_and_null_is_broken(spark):
    df = frame(spark, [(1, 2), (2, -1), (3, None), (4, 3), (5, 200)])
    expected = [
        ("even", "drop", 2, 3), ("id_not_null", "fail", 5, 0), ("positive", "drop", 3, 2), ("small", "warn", 3, 2),
    ]
    same(r.count_by_rule(df, RULES), expected)
    screened = r.screen(df, RULES)
    same(screened.counters(), expected)
    same(screened.kept, [(1, 2), (5, 200)])
    assert rows(screened.quarantined, "id") == [(2,), (3,), (4,)]
    assert screened.kept.columns == ["id", "v"]


def test_fail_rules_stop_even_for_rows_that_would_be_dropped(spark):
    with pytest.raises(r.BrokenRules) as stopped:
        r.screen(frame(spark, [(1, 2), (None, -5)]), RULES)
    assert stopped.value.counts == {"id_not_null": 1}


def test_screen_without_rules_or_rows(spark):
    screened = r.screen(frame(spark, []), [])
    assert screened.kept.count() == 0 and screened.quarantined.count() == 0


EVENTS = "origin STRUCT<update_id: STRING>, timestamp TIMESTAMP, event_type STRING, details STRING"


def event(update, minute, kind, *lines):
    text = json.dumps({"flow_progress": {"data_quality": {"expectations": [
        {"name": n, "dataset": d, "passed_records": p, "failed_records": f} for n, d, p, f in lines
    ]}}})
    return ((update,), datetime(2026, 1, 1, 0, minute), kind, text)


def test_report_adds_up_events_of_an_update(spark):
    events = spark.createDataFrame(
        [
            event("u1", 5, "create_update"),
            event("u1", 7, "flow_progress", ("a", "t", 3, 1), ("b", "t", 0, 0)),
            event("u1", 9, "flow_progress", ("a", "t", 2, 0)),
            event("u1", 9, "other", ("a", "t", 100, 100)),
            event("u2", 20, "flow_progress", ("a", "t", 1, 3)),
            event(None, 1, "flow_progress", ("a", "t", 9, 9)),
        ],
        EVENTS,
    )
    results = r.report(events)
    t1, t2 = datetime(2026, 1, 1, 0, 5), datetime(2026, 1, 1, 0, 20)
    same(
        results,
        [
            ("u1", "t", "a", t1, 5, 1, 5 / 6),
            ("u1", "t", "b", t1, 0, 0, None),
            ("u2", "t", "a", t2, 1, 3, 0.25),
        ],
    )
    same(r.latest_violations(results), [("t", "a", 1, 3, 0.25)])
    expected = spark.createDataFrame(
        [("t", "a", "fail"), ("t", "c", "warn")], "dataset STRING, expectation STRING, action STRING"
    )
    latest = results.where("update_id = 'u2'")
    same(r.not_evaluated(latest, expected), [("t", "a", "broken"), ("t", "c", "not evaluated")],
         "dataset", "expectation", "problem")


def test_counters_survive_the_event_log(spark):
    df = frame(spark, [(1, 2), (2, -1)])
    events = r.progress_events(r.count_by_rule(df, RULES), "u", "t", datetime(2026, 1, 1))
    back = r.report(events)
    same(back.select("expectation", "passed_records", "failed_records"),
         [("even", 1, 1), ("id_not_null", 2, 0), ("positive", 1, 1), ("small", 2, 0)])
