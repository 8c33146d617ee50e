import random
import re
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from duebook.operators.delinquency import overdue_by_month, settle_installments
from duebook.plans.loanbook import LAST_OBSERVED_DAY
from duebook.workload import registry
from tests.helpers import rows, same

SCHEMA = (
    "sk_id_prev BIGINT, sk_id_curr BIGINT, num_instalment_number INT, num_instalment_version INT, "
    "instalment_date DATE, entry_payment_date DATE, amt_instalment DECIMAL(18,3), "
    "amt_payment DECIMAL(18,3), days_instalment INT, has_previous_application BOOLEAN"
)


def payments(spark, data):
    typed = [
        (p, c, n, v, due, paid, a and Decimal(a), x and Decimal(x), (due - date(2018, 5, 1)).days if due else None, True)
        for p, c, n, v, due, paid, a, x in data
    ]
    return spark.createDataFrame(typed, SCHEMA)


def monthly(spark, data):
    return overdue_by_month(settle_installments(payments(spark, data)), LAST_OBSERVED_DAY).select(
        "sk_id_prev", "month", "installment_dpd"
    )


# Installment 3 of contract 40 is due on the 24th of August 2016, later ones every four weeks.
def due(number):
    return date(2016, 8, 24) + timedelta(days=28 * (number - 3))


def paid(number, late, amount, of="84.20", version=2, contract=40, client=77):
    """A payment ``late`` days after the installment is due (None: no date)."""
    day = None if late is None else due(number) + timedelta(days=late)
    return (contract, client, number, version, due(number), day, of, amount)


def test_settlement(spark):
    data = [
        # In three parts, the second of which arrives before the first; a fourth one is too much.
        paid(3, 9, "30.10"), paid(3, -4, "20.10"), paid(3, 31, "34.00"), paid(3, 60, "5"),
        # One day, three payments.
        *[paid(4, -1, part) for part in ("80", "4.199", "0.001")],
        # Never quite enough.
        paid(5, 3, "84.1"), paid(5, 200, "0.099"),
        # The plan was changed: two versions of one number.
        paid(6, 6, "84.20"), paid(6, 7, "12", of="12.5", version=3),
        # Waived before anything was paid.
        paid(7, None, None, of="0.000"),
        # Money of an unknown day is there from the start; only dated payments are counted.
        paid(8, None, "84.19"), paid(8, 2, "0.005"), paid(8, 4, "0.005"),
    ]
    amount = Decimal
    same(
        settle_installments(payments(spark, data)),
        [
            (3, 2, amount("89.200"), 4, due(3) + timedelta(days=31), True, 31),
            (4, 2, amount("84.200"), 3, due(4) - timedelta(days=1), True, 0),
            (5, 2, amount("84.199"), 2, None, False, None),
            (6, 2, amount("84.200"), 1, due(6) + timedelta(days=6), True, 6),
            (6, 3, amount("12.000"), 1, None, False, None),
            (7, 2, amount("0.000"), 0, None, True, None),
            (8, 2, amount("84.200"), 2, due(8) + timedelta(days=4), True, 4),
        ],
        "num_instalment_number", "num_instalment_version", "amt_paid", "n_payments",
        "paid_in_full_date", "is_paid_in_full", "dpd_at_settlement",
    )


def test_days_grow_from_month_end_to_month_end(spark):
    """Never paid: the days at each month's end, up to the last observed day's month."""
    got = {m: days for _, m, days in rows(monthly(spark, [paid(20, None, None)]))}
    months = [date(2017, 12, 1), *(date(2018, m, 1) for m in range(1, 5))]
    assert [*got] == months
    for m in months:
        assert got[m] == (min(next_month(m) - timedelta(days=1), LAST_OBSERVED_DAY) - due(20)).days


def test_a_settled_installment_has_no_later_months(spark):
    got = rows(monthly(spark, [paid(3, 70, "84.20"), paid(10, -11, "84.20")]))
    ends = [(date(2016, m, 1), days) for m, days in ((8, 7), (9, 37), (10, 68), (11, 70))]
    # The one paid early is seen in its own month, with no days.
    assert got == [(40, m, days) for m, days in ends] + [(40, month_start(due(10)), 0)]


def test_what_happens_later_does_not_change_a_month(spark):
    """However an installment ends, the months before that look alike."""
    ways = [paid(6, None, None), paid(6, 75, "84.20"), paid(6, 300, "84.20"), paid(6, 90, "1")]
    early = [rows(monthly(spark, [one]).where(f"month <= '{due(6) + timedelta(days=30)}'")) for one in ways]
    assert early[0] and all(one == early[0] for one in early)


def month_start(day):
    return day.replace(day=1)


def next_month(day):
    return (day.replace(day=28) + timedelta(days=4)).replace(day=1)


def brute_force(data, last_day):
    """Row by row over plain Python values."""
    groups = {}
    for p, c, n, v, due, paid, a, x in data:
        groups.setdefault((p, n, v), []).append((due, paid, Decimal(a), Decimal(x) if x else None))
    result = {}
    for (p, _, _), parts in groups.items():
        due = min(x[0] for x in parts)
        total = sum(x[3] or 0 for x in parts)
        settled = None
        for day in sorted({x[1] for x in parts if x[1]}):
            so_far = sum(x[3] or 0 for x in parts if x[1] is None or x[1] <= day)
            if any(x[1] == day and so_far >= x[2] for x in parts):
                settled = day
                break
        full = total >= max(x[2] for x in parts)
        end = max(due, (settled or due) if full else last_day)
        month = month_start(due)
        while month <= end:
            days = (min(next_month(month) - timedelta(days=1), end) - due).days
            result[p, month] = max(result.get((p, month), 0), days)
            month = next_month(month)
    return sorted((p, m, d) for (p, m), d in result.items())


def test_against_brute_force(spark):
    rng = random.Random(3)
    start, data = date(2016, 1, 1), []
    due_days = {}
    for _ in range(600):
        p, n = rng.randrange(12), rng.randrange(8)
        due = due_days.setdefault((p, n), start + timedelta(days=rng.randrange(600)))
        paid = None if rng.random() < 0.2 else due + timedelta(days=rng.randrange(-40, 300))
        amount = str(rng.choice([10, 40, 100, 130])) if paid or rng.random() < 0.3 else None
        # Rows of one installment may disagree on the amount due.
        data.append((p, 5, n, 1, due, paid, rng.choice(["90", "100", "100", "120"]), amount))
    data += [(99, 5, n, 1, start + timedelta(days=17 * n), None, "100", None) for n in range(30)]
    assert sorted(tuple(r) for r in monthly(spark, data).collect()) == brute_force(data, LAST_OBSERVED_DAY)


def test_a_contract_that_changes_its_client(spark):
    """Each month shows the client of the installment that is longest overdue by then."""
    data = [paid(18, None, None, client=8), paid(21, None, None, client=3)]
    out = overdue_by_month(settle_installments(payments(spark, data)), LAST_OBSERVED_DAY)
    seen = rows(out, "month", "sk_id_curr", "installment_dpd")
    assert {r[1] for r in seen if r[0] < month_start(due(21))} == {8}
    assert {r[1] for r in seen if r[0] >= month_start(due(21))} == {3}
    for m, _, days in seen:
        assert days == (min(next_month(m) - timedelta(days=1), LAST_OBSERVED_DAY) - due(18)).days


def test_tasks_stay_small_however_few_partitions_a_session_asks_for(spark, monkeypatch):
    """Spreading over months multiplies rows, so the rows before it go to more tasks as they grow."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "2")

    def spread(session, _):
        due = F.date_add(F.lit(date(2018, 1, 1)), F.pmod(F.xxhash64("id"), F.lit(700)).cast("int"))
        installments = session.range(400_000).select(
            F.xxhash64("id").alias("sk_id_prev"),
            F.xxhash64("id", "id").alias("sk_id_curr"),
            due.alias("instalment_date"),
            F.lit(False).alias("is_paid_in_full"),
            F.lit(None).cast("date").alias("paid_in_full_date"),
            F.lit(True).alias("has_previous_application"),
        )
        months = overdue_by_month(installments, date(2019, 12, 31))
        return months.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("rows"))

    monkeypatch.setitem(registry.QUERIES, "spread", registry.Query(spread, None, None))
    tasks = registry.runnable("spread")(own, "").collect()
    assert len(tasks) > 2


def test_files_are_read_in_small_splits(spark, folder, monkeypatch):
    """A task that reads holds what it aggregates, so its rows must not grow with the file."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    ids = own.range(1_500_000).select(F.xxhash64("id").alias("id")).coalesce(1)
    ids.write.option("parquet.block.size", 1 << 20).parquet(folder)
    assert own.read.parquet(folder).rdd.getNumPartitions() == 1  # 12 MB

    def read(session, path):
        return session.read.parquet(path).groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("rows"))

    monkeypatch.setitem(registry.QUERIES, "read", registry.Query(read, None, None))
    tasks = registry.runnable("read")(own, folder).collect()
    assert len(tasks) >= 3
    assert sum(t.rows for t in tasks) == 1_500_000


def test_months_of_a_contract_are_sorted_and_not_held_in_tables_of_groups(spark, monkeypatch, capsys):
    """Many operators share a task, so none of them may hold all months besides the sort the join needs."""
    own = spark.newSession()

    def joined(session, _):
        settled = settle_installments(payments(session, [paid(3, 5, "84.20"), paid(4, None, "10.00")]))
        months = overdue_by_month(settled, LAST_OBSERVED_DAY)
        return months.join(months.select("sk_id_prev", "month"), ["sk_id_prev", "month"], "full")

    monkeypatch.setitem(registry.QUERIES, "joined", registry.Query(joined, None, None))
    registry.runnable("joined")(own, "").explain()
    plan = re.sub(r"#\d+L?", "", capsys.readouterr().out)
    assert "HashAggregate(keys=[sk_id_prev, month]" not in plan
    # The running sum sorts by installment: groups are closed one after the other.
    assert "HashAggregate(keys=[sk_id_prev, num_instalment_number, num_instalment_version]" not in plan
    assert "SortAggregate(key=[sk_id_prev, num_instalment_number, num_instalment_version]" in plan


def test_each_month_of_overlapping_installments_comes_once(spark):
    """Also for rows without a contract, and where installments end in different months."""
    columns = "sk_id_prev bigint, sk_id_curr bigint, instalment_date date, is_paid_in_full boolean, paid_in_full_date date, has_previous_application boolean"
    installments = [
        (1, 7, date(2018, 1, 10), True, date(2018, 3, 5), False),
        (1, 6, date(2018, 2, 20), True, date(2018, 2, 25), True),
        (1, 7, date(2018, 3, 1), True, date(2018, 3, 20), None),
        (None, 9, date(2018, 1, 31), True, date(2018, 1, 31), None),
        (None, None, date(2018, 1, 1), True, date(2018, 2, 1), None),
        (2, 5, None, False, None, True),
    ]
    out = overdue_by_month(spark.createDataFrame(installments, columns), date(2019, 12, 31))
    found = {tuple(r) for r in out.select("sk_id_prev", "month", "sk_id_curr", "installment_dpd", "has_previous_application").collect()}
    assert out.count() == len(found)
    assert found == {
        (1, date(2018, 1, 1), 7, 21, False),
        (1, date(2018, 2, 1), 6, 49, True),
        (1, date(2018, 3, 1), 7, 54, False),
        (None, date(2018, 1, 1), 9, 30, None),
        (None, date(2018, 2, 1), None, 31, None),
    }
