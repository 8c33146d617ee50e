import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from duebook.operators.in_order import cuts_for_hot_keys, numbered, with_latest, with_neighbours
from tests.helpers import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one key, another third in the null key."""
    rng = random.Random(7)
    start = datetime(2026, 1, 1)
    data = []
    for i in range(900):
        key = [1, None, rng.randrange(2, 60)][i % 3]
        data.append((key, start + timedelta(minutes=i), rng.choice([None, "a", "b", "c"])))
    return spark.createDataFrame(data, "k INT, t TIMESTAMP, v STRING").repartition(5)


def test_hot_keys_are_found_and_cut(spark, skewed):
    cuts = cuts_for_hot_keys(skewed, ["k"], "t", floor=50, share=20)
    assert {r.k for r in cuts.table.collect()} == {1, None}
    ordinary, hot = cuts.split(skewed)
    assert ordinary.count() == 300 and ordinary.where("k = 1 OR k IS NULL").count() == 0
    sizes = cuts.tag(hot).groupBy("k", "_part").count().collect()
    assert len(sizes) >= 10 and max(r["count"] for r in sizes) <= 100
    assert cuts_for_hot_keys(skewed, ["k"], "t") is None


def test_cuts_do_not_change_results(spark, skewed):
    cuts = cuts_for_hot_keys(skewed, ["k"], "t", floor=50, share=20)
    value, marker = F.struct("v"), F.when(F.col("v") == "a", F.col("t"))

    _, hot = cuts.split(skewed)

    def look(c):
        around = with_neighbours(hot, ["k"], ["t"], value, "before", "after", c)
        return rows(with_latest(around, ["k"], ["t"], marker, "last_a", c))

    assert look(cuts) == look(None)


def test_dates_can_be_cut_too(spark, skewed):
    daily = skewed.select("k", F.expr("date_add(DATE '2020-01-01', minute(t) + 60 * hour(t))").alias("d"), "v")
    daily = daily.dropDuplicates(["k", "d"])
    cuts = cuts_for_hot_keys(daily, ["k"], "d", floor=40, share=20)
    assert cuts is not None
    marker = F.when(F.col("v") == "b", F.col("d"))
    _, hot = cuts.split(daily)
    with_cuts = rows(with_latest(hot, ["k"], ["d"], marker, "m", cuts))
    assert with_cuts == rows(with_latest(hot, ["k"], ["d"], marker, "m"))


def test_empty_input(spark, skewed):
    assert cuts_for_hot_keys(skewed.where("false"), ["k"], "t") is None


def test_numbering_is_a_total_order(spark):
    data = [(i % 7, "same") for i in range(500)] + [(3, "same")] * 500
    df = spark.createDataFrame(data, "a INT, b STRING").repartition(6)
    out = numbered(df, [F.asc("a"), F.asc("b")]).orderBy("_position").collect()
    assert [r._position for r in out] == list(range(1000))
    assert [r.a for r in out] == sorted(a for a, _ in data)


def test_numbers_do_not_depend_on_how_rows_are_spread(spark, monkeypatch):
    """Ties and very many copies of a row, in lots of 50."""
    from duebook.operators import in_order

    monkeypatch.setattr(in_order, "COPIES", 50)
    data = [(i % 7, f"x{i % 11}", float(i % 3)) for i in range(300)] + [(3, "copy", None)] * 730
    df = spark.createDataFrame(data, "a INT, b STRING, c DOUBLE")
    found = []
    for parts in (1, 3, 8):
        out = numbered(df.repartition(parts), [F.desc("a")]).collect()
        assert sorted(r._position for r in out) == list(range(len(data)))
        found.append(sorted((r._position, r.a, r.b, str(r.c)) for r in out))
    assert found[0] == found[1] == found[2]
    assert [r[1] for r in found[0]] == sorted((a for a, _, _ in data), reverse=True)
