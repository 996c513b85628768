"""Loan terms, repayment schedules, payment status and progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.draws import draw, weighted_bucket
from ..functions.money import AMOUNT

STATUS_WEIGHTS = (("OnTime", 90), ("Late", 7), ("Partial", 3))


def loan_terms(df: DataFrame, principal: str, rate: str, months: str) -> DataFrame:
    """Simple interest: total = principal x (1 + rate/100 x months/12); equal installments."""
    growth = F.lit(1).cast("decimal(3,0)") + (
        F.col(rate).cast("decimal(5,2)") * F.col(months).cast("decimal(4,0)") / F.lit(1200).cast("decimal(4,0)")
    ).cast("decimal(12,8)")
    return (
        df.withColumn("total_repayment", (F.col(principal) * growth).cast(AMOUNT))
        .withColumn("monthly_repayment", (F.col("total_repayment") / F.col(months).cast("decimal(4,0)")).cast(AMOUNT))
        .withColumn("interest_amount", (F.col("total_repayment") - F.col(principal)).cast(AMOUNT))
    )


def repayment_schedule(loans: DataFrame, date: str, months: str) -> DataFrame:
    """One row per installment; due dates keep to the month's end."""
    return loans.withColumn("installment", F.explode(F.sequence(F.lit(1), F.col(months).cast("int")))).withColumn(
        "due_date", F.add_months(F.col(date), F.col("installment"))
    )


def payment_status(
    schedule: DataFrame, key: str, scheduled: str, weights: Sequence[tuple[str, int]] = STATUS_WEIGHTS, salt: str = "status"
) -> DataFrame:
    """One draw decides the status; amount and days late follow from it, so they cannot disagree."""
    part = (draw(salt + "-part", 16, key, "installment") + 80).cast("decimal(4,0)") * F.lit("0.01").cast("decimal(3,2)")
    with_status = schedule.withColumn("payment_status", weighted_bucket(salt, weights, key, "installment"))
    partial: Column = F.col("payment_status") == "Partial"
    return with_status.withColumns(
        {
            "actual_amount": F.when(partial, (F.col(scheduled) * part).cast(AMOUNT)).otherwise(F.col(scheduled)),
            "days_late": F.when(
                F.col("payment_status") != "OnTime", (draw(salt + "-late", 5, key, "installment") + 1).cast("int")
            ),
        }
    )


def loan_progress(loans: DataFrame, payments: DataFrame, key: str, total: str, months: str, as_of: Column | None = None) -> DataFrame:
    """Paid so far, remaining balance and whether the loan is settled.

    Installments are rounded to cents, so half a cent per installment may stay open on a settled loan.
    """
    due = payments if as_of is None else payments.filter(F.col("due_date") <= as_of)
    paid = due.groupBy(F.col(key).alias("_k")).agg(F.sum("actual_amount").cast("decimal(22,2)").alias("_paid"), F.count("*").alias("_n"))
    out = loans.join(paid, F.col(key) == F.col("_k"), "left")
    zero = F.lit(0).cast("decimal(22,2)")
    slack = F.col(months).cast("decimal(4,0)") * F.lit("0.005").cast("decimal(4,3)")
    return (
        out.withColumn("payments_made", F.coalesce("_n", F.lit(0)))
        .withColumn("repaid_to_date", F.coalesce("_paid", zero))
        .withColumn("remaining_balance", F.greatest(F.col(total) - F.col("repaid_to_date"), zero).cast(AMOUNT))
        .withColumn("is_fully_repaid", F.col("remaining_balance") <= slack)
        .drop("_k", "_n", "_paid")
    )
