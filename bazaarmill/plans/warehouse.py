"""Building the whole star schema: five dimensions, seven facts, loaded in reference order.

Sources: a customer takes a loan, a part is a bulk purchase, a supplier is a store with expenses. All
other values are drawn from the keys, so a second build gives the same rows. Each fact is written
before the next one reads it, as a load does; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import date_key, date_of
from ..functions.draws import draw, number_between, weighted_bucket
from ..functions.money import AMOUNT, TOTAL, UNIT
from ..operators import baskets, expenses, ledger, loans, pricing
from ..operators.calendar import YEAR_2024, calendar, next_date
from ..operators.constraints import all_rules, row_rules, set_rules
from ..operators.keys import with_surrogate_key
from ..operators.ordered import running
from ..operators.picks import preferred_pick
from ..operators.quality import dq_report
from ..schemas import TABLES as DECLARED, literal_dimension, schema
from ..session import freeze, partitions
from ..sources.guards import Guard
from ..sources.sinks import full_refresh, run_folder
from ..sources.tables import Tables

FIRST_DAY, LAST_DAY, LAST_DUE = "2024-01-04", "2024-12-31", "2025-12-31"

# Shares of categories, sizes and funding; price factors by size, category and quarter.
CATEGORY_WEIGHTS = ((1, 25), (2, 30), (3, 15), (4, 20), (5, 10))
SIZE_WEIGHTS = ((1, 25), (2, 45), (3, 30))
SIZE_FACTORS = {1: (70, 11), 2: (90, 21), 3: (120, 21)}
CATEGORY_FACTORS = {1: (85, 21), 2: (95, 21), 3: (110, 21), 4: (80, 21), 5: (100, 21)}
QUARTER_FACTORS = {1: (90, 16), 2: (95, 16), 3: (105, 16), 4: (110, 16)}
SEASON = {1: "0.85", 2: "1.05", 3: "1.20", 4: "1.35"}
#: Mark-ups in percent: least and greatest of the draw, and that of the top tier. The score above which an item sells.
MARKUP, SELL_ABOVE = (20, 30, 50), "0.60"
OPENING = {"Profits": "250000.00", "Operations": "100000.00"}


def _day(text: str):
    return F.lit(text).cast("date")


def dimensions(t: Tables) -> dict[str, DataFrame]:
    out = {n: literal_dimension(t.spark, n) for n in ("categories", "subcategories", "bell_sizes", "item_grades")}
    out["dates"] = calendar(t.spark, "2024-01-01", LAST_DUE, YEAR_2024)
    return out


def build_loans(t: Tables, dates: DataFrame) -> DataFrame:
    keyed = with_surrogate_key(t.customer.select("c_custkey"), ["c_custkey"], "loan_id")
    terms = keyed.select(
        "loan_id",
        F.date_add(_day("2024-01-08"), draw("loan-day", 315, "loan_id").cast("int")).alias("_asked"),
        (number_between("principal", 4, 16, "loan_id") * 500_000).cast(AMOUNT).alias("principal_amount"),
        F.when(draw("months", 2, "loan_id") == 0, 6).otherwise(12).alias("duration_months"),
        number_between("rate", 12, 18, "loan_id").cast("decimal(5,2)").alias("effective_interest_rate"),
    )
    dated = next_date(terms, "_asked", dates, name="loan_date")
    return loans.loan_terms(dated, "principal_amount", "effective_interest_rate", "duration_months")


def build_repayments(loan_rows: DataFrame) -> DataFrame:
    """Installments; keys follow from loan and installment, so no numbering pass is needed."""
    due = loans.repayment_schedule(loan_rows, "loan_date", "duration_months")
    paid = loans.payment_status(due, "loan_id", "monthly_repayment")
    return paid.select(
        (F.col("loan_id") * 100 + F.col("installment")).alias("repayment_id"),
        "loan_id",
        date_key("due_date").alias("repayment_date_key"),
        "due_date",
        F.col("monthly_repayment").alias("scheduled_amount"),
        "actual_amount",
        "payment_status",
        "days_late",
    )


def settle_loans(loan_rows: DataFrame, repayments: DataFrame) -> DataFrame:
    state = loans.loan_progress(loan_rows, repayments, "loan_id", "total_repayment", "duration_months", _day(LAST_DAY))
    return state.withColumns(
        {
            "loan_date_key": date_key("loan_date"),
            "repaid_to_date": F.least("repaid_to_date", "total_repayment"),
        }
    )


def build_bells(t: Tables, loan_rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One purchase per part: funded by a loan or from profit, on an open day, with allocated transport."""
    loan_count = loan_rows.agg(F.count("*")).scalar()
    bell = with_surrogate_key(t.part.select("p_partkey"), ["p_partkey"], "bell_id").select(
        "bell_id",
        weighted_bucket("category", CATEGORY_WEIGHTS, "bell_id").alias("category_id"),
        weighted_bucket("size", SIZE_WEIGHTS, "bell_id").alias("bell_size_id"),
        (draw("funding", 100, "bell_id") >= 60).alias("is_profit_funded"),
        (number_between("sellable", 65, 90, "bell_id").cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(5,2)").alias("sellable_percentage"),
    )
    funded = bell.withColumn("loan_id", F.when(~F.col("is_profit_funded"), draw("loan", loan_count, "bell_id") + 1))
    # only purchases with a loan look one up; the others would all meet at the missing key
    by_loan = funded.filter(~F.col("is_profit_funded")).join(loan_rows.select("loan_id", "loan_date"), "loan_id", "left")
    dated = by_loan.unionByName(funded.filter("is_profit_funded").withColumn("loan_date", F.lit(None).cast("date")))
    trip_day = F.date_add(_day("2024-01-05"), draw("trip", 355, "bell_id").cast("int"))
    asked = dated.withColumn(
        "_asked",
        F.when(F.col("is_profit_funded"), trip_day).otherwise(F.date_add("loan_date", draw("after-loan", 5, "bell_id").cast("int"))),
    )
    open_days = next_date(asked, "_asked", dims["dates"], name="purchase_date").withColumn(
        "trip_id",
        # a loan makes one trip per purchase day; profit pays for one trip per open day
        F.when(F.col("is_profit_funded"), date_key("purchase_date").cast("bigint")).otherwise(
            F.col("loan_id") * 100_000_000 + date_key("purchase_date")
        ),
    )
    picked = preferred_pick(open_days, dims["subcategories"], "category_id", "bell_id", "subcategory_id", "is_fast_moving").withColumnRenamed(
        "picked", "subcategory_id"
    )
    sized = picked.join(F.broadcast(dims["bell_sizes"]), "bell_size_id").withColumn(
        "total_items", (F.col("min_items") + draw("items", F.col("max_items") - F.col("min_items") + 1, "bell_id")).cast("int")
    )
    factors = [
        pricing.stepped_factor("size-factor", "bell_size_id", SIZE_FACTORS, "bell_id"),
        pricing.stepped_factor("category-factor", "category_id", CATEGORY_FACTORS, "bell_id"),
        pricing.stepped_factor("season-factor", F.quarter("purchase_date"), QUARTER_FACTORS, "bell_id"),
    ]
    costed = pricing.factor_cost(sized, 500_000, factors, 350_000, 850_000, "bell_cost")
    units = pricing.unit_cost(costed, "bell_cost", "total_items", F.col("sellable_percentage"))
    moved = pricing.allocate_cost(units, ["trip_id"], 12_000, "transport_cost")
    return moved.withColumn("purchase_date_key", date_key("purchase_date"))


#: Purchases of a segment, at most: about 250,000 items, which one task sorts in memory.
SEGMENT_BELLS = 1_000


def in_segments(bells: DataFrame) -> tuple[DataFrame, int]:
    """Purchases with their segment (``_segment``, a range of ``bell_id``), one partition for each segment, and their number."""
    last = bells.agg(F.coalesce(F.max("bell_id"), F.lit(0))).first()[0]
    width = min(SEGMENT_BELLS, last // (4 * partitions(bells.sparkSession)) + 1)
    count = last // width + 1
    return bells.withColumn("_segment", F.floor(F.col("bell_id") / width)).repartition(count, "_segment"), count


def build_items(bells: DataFrame, dims: dict[str, DataFrame], keep: Sequence[str] = ()) -> DataFrame:
    """One row per sellable item: grade, tier, price, sale date, discount. Linked to sales later.

    With ``keep``, columns of the purchases that stay, the items are in the partitions of their purchases. Items are drawn from their
    keys, so they can be computed again instead of stored; a filter on them draws twice, as it is pushed down.
    """
    fast = F.broadcast(dims["subcategories"].select("subcategory_id", "is_fast_moving"))
    bought = (
        bells.select("bell_id", "category_id", "subcategory_id", "cost_per_item", "purchase_date_key", "sellable_items", *keep)
        .join(fast, "subcategory_id")
        .withColumn("date_added", date_of("purchase_date_key"))
    )

    def d(x):
        return F.lit(x).cast("decimal(5,2)")

    def sell_factors(price):
        quarter = F.quarter("date_added")
        return [
            F.when(F.col("is_fast_moving"), d("0.95")).otherwise(d("0.75")),
            reduce(lambda acc, q: acc.when(quarter == q, d(SEASON[q])), (2, 3, 4), F.when(quarter == 1, d(SEASON[1]))),
            F.when(price < 3000, d("1.55")).when(price <= 6000, d("1.30")).otherwise(d("1.10")),
        ]

    # prices and what they ask of the last factor, for each mark-up: by purchase, so that an item only looks them up
    tables = bought.withColumn("_prices", pricing.price_table("cost_per_item", *MARKUP)).withColumn(
        "_leasts", F.transform("_prices", lambda price: pricing.least_chance(sell_factors(price), SELL_ABOVE))
    )
    one = F.when(F.array_min("_leasts") == F.array_max("_leasts"), F.element_at("_leasts", 1))
    units = pricing.explode_units(tables.withColumn("_least", one), "sellable_items", spread_by=None if keep else "bell_id")
    numbered = units.withColumn("item_id", F.col("bell_id") * 1000 + F.col("unit_no")).withColumn("_item", F.col("item_id").cast("string"))  # for all draws
    item = numbered.withColumn("grade_id", F.when(draw("grade", 100, "_item") < 70, 1).otherwise(2))
    top = (F.col("grade_id") == 1) & (draw("tier", 100, "_item") < 15)
    priced = pricing.markup(item, "cost_per_item", top, *MARKUP, "_item", prices="_prices").withColumn(
        "_need", F.coalesce(F.col("_least"), F.element_at("_leasts", F.col("markup_place")))  # often no mark-up need be drawn to know it
    )
    chance = draw("sell", 50, "_item") + 50
    last = (chance.cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(5,2)")
    scored = pricing.sell_score(priced, [*sell_factors(F.col("selling_price")), last], SELL_ABOVE, ("_need", chance, 50, 99))
    days = F.when(F.col("is_fast_moving"), number_between("days-fast", 5, 45, "_item")).otherwise(number_between("days", 10, 90, "_item"))
    dated = pricing.assign_sale_date(scored, "date_added", days, dims["dates"], "will_sell", _day(LAST_DAY))
    sale_days = dims["dates"].filter(F.col("is_sale") & (F.col("full_date") <= _day(LAST_DAY)))
    aged = pricing.age_discount(
        dated, "date_added", "selling_price", "is_sold", ((90, 25), (120, 40), (180, 50)), _day(LAST_DAY), sale_days.agg(F.max("full_date")).scalar()
    )
    return pricing.final_price(aged).select(
        "item_id",
        "bell_id",
        "category_id",
        "subcategory_id",
        "grade_id",
        "cost_per_item",
        F.col("selling_price").alias("base_price"),
        "is_top_tier",
        F.col("markup_percent").alias("actual_markup_percent"),
        "selling_price",
        F.col("purchase_date_key").alias("date_added_key"),
        date_key("sold_date").alias("date_sold_key"),
        "days_in_inventory",
        "is_sold",
        "is_in_discount",
        "discount_percent",
        "discounted_price",
        F.col("final_price").cast(UNIT).alias("final_sale_price"),
        *keep,
    )


def packed_items(bells: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """All items with the basket number and key of their sale (null if unsold).

    The key of a sale is its day and basket number: unique, ascending in load order, and known to the
    items without a join back.
    """
    parts, count = in_segments(bells)
    packed = baskets.pack_segments(build_items(parts, dims, ["_segment"]), "_segment", "date_sold_key", ["item_id"], count)
    key = F.col("date_sold_key").cast("bigint") * 10_000_000_000 + F.col("basket_no")
    return packed.drop("_segment").withColumn("sale_transaction_id", key)


def build_sales(packed: DataFrame) -> DataFrame:
    """Sales from the packed items of each day; items without a sale are left out."""
    key = (F.col("date_sold_key").cast("bigint") * 10_000_000_000 + F.col("basket_no")).alias("sale_transaction_id")
    totals = baskets.basket_totals(packed, "date_sold_key", "selling_price", "final_sale_price").filter("total IS NOT NULL")  # only sold items have a total
    totals = totals.withColumn("_sale", F.concat_ws(":", "date_sold_key", "basket_no"))
    day = date_of("date_sold_key")
    seed = ("_sale",)  # text of both, for all draws
    at = F.make_timestamp_ntz(
        F.year(day), F.month(day), F.dayofmonth(day), number_between("hour", 9, 20, *seed).cast("int"),
        draw("minute", 60, *seed).cast("int"), draw("second", 60, *seed).cast("decimal(16,6)"),
    )
    return totals.select(
        key,
        F.col("date_sold_key").alias("sale_date_key"),
        at.alias("sale_datetime"),
        F.col("total_items").cast("int").alias("total_items"),
        F.col("subtotal").alias("subtotal_amount"),
        F.col("discount").alias("discount_amount"),
        F.col("total").alias("total_amount"),
        weighted_bucket("payment", (("Cash", 30), ("Transfer", 45), ("POS", 25)), *seed).alias("payment_method"),
        (draw("returning", 100, *seed) < 35).alias("is_recurring_customer"),
    )


def sales_by_day(items: DataFrame) -> DataFrame:
    """What the sales of each day amount to: each sold item is in one sale, so no baskets are needed."""
    sums = freeze(items.groupBy("date_sold_key").agg(F.sum("final_sale_price").cast(TOTAL).alias("total_amount")))
    return sums.filter("date_sold_key IS NOT NULL").withColumnRenamed("date_sold_key", "sale_date_key")


def build_expenses(t: Tables, dates: DataFrame) -> DataFrame:
    year = dates.filter(F.col("year") == 2024)
    stores = t.supplier_spread.select("s_suppkey")
    rows = (
        expenses.recurring_expenses(stores, "s_suppkey", year)
        .unionByName(expenses.monthly_variable(stores, "s_suppkey", year))
        .unionByName(expenses.adhoc_expenses(stores, "s_suppkey", year, "Transport", (30, 40), expenses.TRANSPORT_BANDS, 100))
        .unionByName(expenses.adhoc_expenses(stores, "s_suppkey", year, "Other", (40, 60), expenses.OTHER_BANDS, 40))
    )
    # equal postings of one store and day are counted apart, so that the load order is unique
    order = ["s_suppkey", "expense_date_key", "expense_category", "expense_description", "amount", "payment_method"]
    alike = rows.groupBy(*order, "is_recurring").agg(F.count("*").cast("int").alias("_n"))
    single = alike.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return with_surrogate_key(single, [*order, "_copy"], "expense_id").drop("_n", "_copy")


def build_cash_movements(t: Tables, w: dict[str, DataFrame]) -> DataFrame:
    """Ledger of the business: opening, daily movements, deficit corrections, year-end sweep, balances."""

    def by_day(df: DataFrame, key: str, **sums) -> DataFrame:
        g = df.groupBy(key).agg(*[F.sum(c).cast("decimal(22,2)").alias(n) for n, c in sums.items()])
        return g.withColumn("day", date_of(key)).drop(key)

    paid_by_loan = F.when(~F.col("is_profit_funded"), F.col("bell_cost")).otherwise(F.lit(0).cast(AMOUNT))
    paid_by_profit = F.when(F.col("is_profit_funded"), F.col("bell_cost")).otherwise(F.lit(0).cast(AMOUNT))
    movements = ledger.build_movements(
        by_day(w["sales"], "sale_date_key", amount=F.col("total_amount")),
        w["loans"].select("loan_id", date_of("loan_date_key").alias("day"), F.col("principal_amount").alias("amount")),
        by_day(w["bells"], "purchase_date_key", loan_cost=paid_by_loan, profit_cost=paid_by_profit, transport=F.col("transport_cost")),
        by_day(w["expenses"], "expense_date_key", amount=F.col("amount")),
        by_day(w["loan_repayments"], "repayment_date_key", amount=F.col("actual_amount")),
    ).filter(F.col("day") >= _day(FIRST_DAY))
    seed = ledger.opening_balance(t.spark.range(1).select(), [], _day(FIRST_DAY), OPENING)
    base = freeze(seed.unionByName(movements))
    # The year is corrected and swept; what is due later, such as instalments, follows on the swept accounts.
    year = base.filter(F.col("day") <= _day(LAST_DAY))
    fixed = freeze(year.unionByName(ledger.deficit_cascade(year, [])))
    swept = fixed.unionByName(ledger.year_end_sweep(fixed, [], _day(LAST_DAY)))
    later = freeze(swept.unionByName(base.filter(F.col("day") > _day(LAST_DAY))))
    balanced = running(later.unionByName(ledger.deficit_cascade(later, [])), ["account"], ledger.ORDER, {"running_balance": ledger.signed()})
    return with_surrogate_key(balanced, [*ledger.ORDER, "account"], "cash_movement_id").select(
        "cash_movement_id",
        date_key("day").alias("movement_date_key"),
        F.col("account").alias("account_type"),
        F.col("kind").alias("movement_type"),
        "amount",
        F.col("source").alias("source_account"),
        F.col("destination").alias("destination_account"),
        "description",
        "running_balance",
    )


def build_warehouse(t: Tables, path: str | None = None) -> dict[str, DataFrame]:
    """All twelve tables, written below ``path`` (a new run folder by default) and read back."""
    root = path or run_folder(t.spark, "warehouse")

    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return t.spark.read.schema(df.schema).parquet(f"{root}/{name}")

    w: dict[str, DataFrame] = {}

    def load(name: str, df: DataFrame) -> DataFrame:
        """Types, row rules, keys and references hold before the table is put in place."""
        unique, references = set_rules(name)
        full_refresh(df, f"{root}/{name}", schema(name) if name in DECLARED else None, row_rules(name), Guard(unique, references, w))
        w[name] = t.spark.read.parquet(f"{root}/{name}")
        return w[name]

    for n, df in dimensions(t).items():
        load(n, df)
    loan_rows = store("stage_loans", build_loans(t, w["dates"]))
    payments = store("stage_repayments", build_repayments(loan_rows))
    load("loans", settle_loans(loan_rows, payments))
    load("loan_repayments", payments)
    load("bells", build_bells(t, loan_rows, w))
    packed = store("stage_items", packed_items(w["bells"], w))
    load("sales", build_sales(packed))
    load("items", packed.drop("basket_no"))
    load("expenses", build_expenses(t, w["dates"]))
    load("cash_movements", build_cash_movements(t, w))
    return w


def warehouse_report(w: dict[str, DataFrame]) -> DataFrame:
    """Every key, reference and check of the star schema, with its number of violations."""
    return dq_report(w, all_rules())
