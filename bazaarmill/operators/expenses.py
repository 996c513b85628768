"""Recurring, monthly and ad-hoc expense postings per store.

Stores may be many; the calendar is short. Postings are generated on the store row and find their
calendar day by an equi-join on a number, never by pairing stores with all days.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.draws import draw, weighted_bucket
from ..functions.money import AMOUNT
from .calendar import numbered_open_days


@dataclass(frozen=True)
class Recurring:
    category: str
    description: str
    due_day: int
    method: str
    low: int
    high: int


# The two monthly templates, the utilities ranges and the ad-hoc bands.
RECURRING = (
    Recurring("Rent", "Monthly shop rent", 1, "Transfer", 150_000, 150_000),
    Recurring("Staff", "Staff salaries (2 employees)", 25, "Cash", 200_000, 400_999),
)
UTILITY_RANGES = {True: (50_000, 31_000), False: (30_000, 21_000)}  # high season, other months
HIGH_SEASON = (3, 4, 5, 6, 7, 8, 9)
TRANSPORT_BANDS = (("Transportation for supplies/errands", 100, 12_000, 1),)
OTHER_BANDS = (
    ("Shop repairs and maintenance", 30, 20_000, 81_000),
    ("Shop supplies (hangers, bags, tags)", 30, 10_000, 41_000),
    ("Marketing and promotions", 25, 15_000, 86_000),
    ("Miscellaneous business expenses", 15, 10_000, 41_000),
)

COLUMNS = ["expense_date_key", "expense_category", "expense_description", "amount", "is_recurring", "payment_method"]


def recurring_expenses(stores: DataFrame, store: str, cal: DataFrame, templates: Sequence[Recurring] = RECURRING) -> DataFrame:
    """Postings of each template on its due day, when the store is open that day."""
    spark = stores.sparkSession
    rows = [(r.category, r.description, r.due_day, r.method, r.low, r.high - r.low + 1) for r in templates]
    table = spark.createDataFrame(
        rows, "expense_category string, text string, due_day int, payment_method string, low int, spread int"
    )
    due = (
        cal.filter("is_open")
        .join(F.broadcast(table), F.dayofmonth("full_date") == F.col("due_day"))
        .select("month", "month_name", F.col("date_key").alias("expense_date_key"), *[c for c in table.columns if c != "due_day"])
    )
    each = stores.select(store).withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    amount = F.col("low") + draw("recurring", F.col("spread"), store, "expense_date_key", "expense_category")
    return each.join(F.broadcast(due), "month").select(
        store,
        "expense_date_key",
        "expense_category",
        F.concat("text", F.lit(" - "), "month_name").alias("expense_description"),
        amount.cast(AMOUNT).alias("amount"),
        F.lit(True).alias("is_recurring"),
        "payment_method",
    )


def monthly_variable(stores: DataFrame, store: str, cal: DataFrame, day_range: tuple[int, int] = (5, 10)) -> DataFrame:
    """One posting per store and month, on a drawn open day of the range; the amount depends on the season."""
    days = numbered_open_days(cal.filter(F.dayofmonth("full_date").between(*day_range)), ["year", "month"])
    months = days.groupBy("year", "month").agg(F.max("day_count").alias("day_count"))
    each = stores.select(store).withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    asked = each.join(F.broadcast(months), "month").withColumn(
        "day_index", draw("utility-day", F.col("day_count"), store, "year", "month")
    )
    high = F.col("month").isin(*HIGH_SEASON)

    def amount(range_: tuple[int, int]) -> Column:
        return F.lit(range_[0]) + draw("utility-amount", range_[1], store, "year", "month")

    found = asked.join(
        F.broadcast(days.select("year", "month", "day_index", "date_key", "month_name")), ["year", "month", "day_index"]
    )
    return found.select(
        store,
        F.col("date_key").alias("expense_date_key"),
        F.lit("Utilities").alias("expense_category"),
        F.concat(F.lit("Electricity, water, internet - "), "month_name").alias("expense_description"),
        F.when(high, amount(UTILITY_RANGES[True])).otherwise(amount(UTILITY_RANGES[False])).cast(AMOUNT).alias("amount"),
        F.lit(False).alias("is_recurring"),
        F.when(draw("utility-method", 100, store, "year", "month") < 70, "Transfer").otherwise("Cash").alias("payment_method"),
    )


def adhoc_expenses(
    stores: DataFrame,
    store: str,
    cal: DataFrame,
    category: str,
    count: tuple[int, int],
    bands: Sequence[tuple[str, int, int, int]],
    cash_pct: int,
) -> DataFrame:
    """A drawn number of postings per store, each on a drawn open day, with an amount by band."""
    days = numbered_open_days(cal, [])
    open_days = days.agg(F.count("*").alias("n")).scalar()
    low, high = count
    n = (draw(f"{category}-count", high - low + 1, store) + low).cast("int")
    postings = (
        stores.select(store)
        .withColumn("posting_no", F.explode(F.sequence(F.lit(1), n)))
        .withColumn("day_index", draw(f"{category}-day", open_days, store, "posting_no"))
        .withColumn("expense_description", weighted_bucket(f"{category}-band", [(b[0], b[1]) for b in bands], store, "posting_no"))
    )
    lows = F.create_map(*[x for b in bands for x in (F.lit(b[0]), F.lit(b[2]))])
    spreads = F.create_map(*[x for b in bands for x in (F.lit(b[0]), F.lit(b[3]))])
    amount = F.element_at(lows, F.col("expense_description")) + draw(
        f"{category}-amount", F.element_at(spreads, F.col("expense_description")), store, "posting_no"
    )
    cash = draw(f"{category}-method", 100, store, "posting_no") < cash_pct
    return postings.join(F.broadcast(days.select("day_index", "date_key")), "day_index").select(
        store,
        F.col("date_key").alias("expense_date_key"),
        F.lit(category).alias("expense_category"),
        "expense_description",
        amount.cast(AMOUNT).alias("amount"),
        F.lit(False).alias("is_recurring"),
        F.when(cash, "Cash").otherwise("Transfer").alias("payment_method"),
    )
