"""Installments from partial payments, and days past due by contract and month."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.fixed_values import AMOUNT
from duebook.functions.calendar import month_of, months_from_to


@dataclass(frozen=True)
class PaymentColumns:
    """Column names of the payment and installment tables."""

    contract: str = "sk_id_prev"
    client: str = "sk_id_curr"
    parts: tuple[str, ...] = ("num_instalment_number", "num_instalment_version")
    due_offset: str = "days_instalment"
    due_day: str = "instalment_date"
    due_amount: str = "amt_instalment"
    paid_day: str = "entry_payment_date"
    paid_amount: str = "amt_payment"
    known: str = "has_previous_application"

    @property
    def installment(self) -> list[str]:
        return [self.contract, *self.parts]


def paid_by_day(payments: DataFrame, cols: PaymentColumns = PaymentColumns()) -> DataFrame:
    """Payments of one installment on one day, with the sum paid up to the end of that day.

    Grain: one row per installment and payment day (the null day holds payments without a date
    and comes first). Adding up days before the running sum makes payments of one day count
    together, and bounds the rows of an installment by the calendar however many payments it has.
    """
    key = cols.installment
    daily = payments.groupBy(*key, cols.paid_day).agg(
        F.sum(cols.paid_amount).alias("paid_on_day"),
        F.count(cols.paid_day).alias("payments_on_day"),
        F.min(cols.due_amount).alias("least_due"),
        F.max(cols.due_amount).alias(cols.due_amount),
        F.min(cols.client).alias(cols.client),
        F.min(cols.due_offset).alias(cols.due_offset),
        F.min(cols.due_day).alias(cols.due_day),
        F.bool_or(cols.known).alias(cols.known),
    )
    up_to_day = (
        Window.partitionBy(*key)
        .orderBy(F.asc_nulls_first(cols.paid_day))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumn("paid_so_far", F.sum("paid_on_day").over(up_to_day))


def settle_installments(payments: DataFrame, cols: PaymentColumns = PaymentColumns()) -> DataFrame:
    """Turn partial payments into installments with their settlement day.

    Grain: one row per contract, number and version. An installment is settled on the first day
    on which the payments so far cover the amount due; what is paid later does not move that day.
    Nothing due and nothing paid is settled too, without a day. Two shuffles: payments by
    installment and day (combined before it), days by installment.
    """
    settled_on = F.when(F.col("paid_so_far") >= F.col("least_due"), F.col(cols.paid_day))
    paid = F.coalesce(F.sum("paid_on_day"), F.lit(0)).cast(AMOUNT)
    late = F.datediff("paid_in_full_date", cols.due_day)
    merged = (
        paid_by_day(payments, cols)
        .groupBy(*cols.installment)
        .agg(
            F.min(cols.client).alias(cols.client),
            F.min(cols.due_offset).alias(cols.due_offset),
            F.min(cols.due_day).alias(cols.due_day),
            F.max(cols.due_amount).alias(cols.due_amount),
            paid.alias("amt_paid"),
            F.sum("payments_on_day").cast("int").alias("n_payments"),
            F.min(cols.paid_day).alias("first_payment_date"),
            F.max(cols.paid_day).alias("last_payment_date"),
            F.min(settled_on).alias("paid_in_full_date"),
            F.bool_or(cols.known).alias(cols.known),
        )
    )
    return merged.select(
        cols.contract,
        cols.client,
        *cols.parts,
        cols.due_offset,
        cols.due_day,
        cols.due_amount,
        "amt_paid",
        "n_payments",
        "first_payment_date",
        "last_payment_date",
        "paid_in_full_date",
        F.ifnull(F.col("amt_paid") >= F.col(cols.due_amount), F.lit(False)).alias(
            "is_paid_in_full"
        ),
        # Paid before it was due counts as no delay; what is not settled has no days at all.
        F.when(late < 0, 0).otherwise(late).alias("dpd_at_settlement"),
        cols.known,
    )


def overdue_until(cols: PaymentColumns, last_day: Column) -> Column:
    """Last day an installment counts: its settlement, else ``last_day``; never before due."""
    due = F.col(cols.due_day)
    closed = F.when(F.col("is_paid_in_full"), F.ifnull("paid_in_full_date", due))
    return F.greatest(due, F.ifnull(closed, last_day))


def overdue_by_month(
    installments: DataFrame, last_day: date, cols: PaymentColumns = PaymentColumns()
) -> DataFrame:
    """Highest days past due of a contract in every month it has an open or due installment.

    Grain: one row per contract and month. A month sees an installment at the month's last day,
    or at the settlement day in the month of settlement, so nothing after the month matters.

    Of installments that end in the same month the one due first covers the months of all others
    and is the most overdue in each of them; only in the ending month itself can another one be
    further past due. So installments are first combined by ending month, and only the combined
    rows are spread over months: a contract that stopped paying spreads one row, not one row per
    open installment. Combined rows (a contract has about as many as there are months) move to
    their contract before they are spread, so the spread rows need no shuffle of their own. Spread
    rows are sorted by contract and month and combined in that order: the full join with balances
    needs that sort anyway, and grouping would hold all months of a task twice besides it.
    """
    due = F.col(cols.due_day)
    until = overdue_until(cols, F.lit(last_day))
    spans = (
        installments.where(due.isNotNull())
        .withColumn("_until", until)
        .groupBy(cols.contract, cols.client, cols.known, month_of("_until").alias("_last_month"))
        .agg(
            F.min(due).alias("_first_due"),
            F.max(F.datediff("_until", due)).alias("_days_at_end"),
        )
        .repartition(cols.contract)
    )
    month = F.col("month")
    days = F.when(month == F.col("_last_month"), F.col("_days_at_end")).otherwise(
        F.datediff(F.last_day(month), "_first_due")
    )
    # All rows of a month see the same values, so any one of them stands for it.
    by_month = Window.partitionBy(cols.contract, "month").orderBy("_last_month")
    whole = by_month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        spans.withColumn(
            "month", F.explode(months_from_to(F.col("_first_due"), F.col("_last_month")))
        )
        .select(
            cols.contract,
            "month",
            F.min(cols.client).over(whole).alias(cols.client),
            F.max(days).over(whole).alias("installment_dpd"),
            F.bool_or(cols.known).over(whole).alias(cols.known),
            F.row_number().over(by_month).alias("_nth"),
        )
        .where("_nth = 1")
        .drop("_nth")
    )
