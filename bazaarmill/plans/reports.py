"""Verification and business reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.dates import date_key, date_of
from ..functions.draws import draw as draw_col
from ..functions.money import AMOUNT, TOTAL, mean as mean_col, naira, share as share_col, total
from ..operators import ledger
from ..operators.calendar import EVERY_YEAR, calendar_for
from ..registry import query
from .domain import (
    CASCADE, DATED, E_SQL, LOANS, PAYMENTS, POSTING_CALENDAR, PROGRESS, discounted_items, event_postings, full_ledger, loan_book,
    loan_payments, loan_state, money, _posting_calendar as posting_calendar,
)
from .sqltext import CAL_ORDERS, EVENTS, LINEITEM, ORDERS, PART, SUPPLIER, dbl, draw, key_of, mean, share, txt


def pct_by(g: DataFrame, name: str = "pct", n: str = "n") -> DataFrame:
    """Share of each row in the total of an aggregated (small) table."""
    return g.withColumn(name, share_col(n, F.sum(n).over(W.partitionBy())))


# Calendar

# The labels of the calendar report.
METRICS = {
    "Total Days in 2024": "true",
    "Store Open Days": "is_open",
    "Store Closed Days": "NOT is_open",
    "Sundays (Closed)": "day_name = 'Sunday'",
    "Peak Period Days": "is_peak",
    "Sales Period Days": "is_sale",
    "Weekend Days (Sat + Sun)": "is_weekend",
}


@query(
    "calendar_metrics",
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, count(*) AS days, CAST(coalesce(sum(postings), 0) AS BIGINT) AS postings FROM {POSTING_CALENDAR} WHERE {c}" for m, c in METRICS.items()
    ),
)
def calendar_metrics(t):
    one = posting_calendar(t).agg(
        *[F.count_if(F.expr(c)).alias(f"d{i}") for i, c in enumerate(METRICS.values())],
        *[F.coalesce(F.sum(F.when(F.expr(c), F.col("postings"))), F.lit(0)).alias(f"p{i}") for i, c in enumerate(METRICS.values())],
    )
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(f"d{i}").alias("days"), F.col(f"p{i}").alias("postings"))
        for i, m in enumerate(METRICS)
    ]
    return one.select(F.inline(F.array(*rows)))


@query(
    "opening_schedule",
    f"""SELECT date_key, {txt('full_date')} AS full_date, day_name, is_open, CASE WHEN NOT is_open AND day_name = 'Sunday' THEN 'Closed - Sunday'
    WHEN NOT is_open AND full_date < DATE '2024-01-04' THEN 'Closed - Before Opening' WHEN is_open THEN 'OPEN' ELSE 'Closed - Other' END AS status, postings
    FROM {POSTING_CALENDAR} WHERE month = 1 ORDER BY date_key""",
)
def opening_schedule(t):
    status = (
        F.when(~F.col("is_open") & (F.col("day_name") == "Sunday"), "Closed - Sunday")
        .when(~F.col("is_open") & (F.col("full_date") < "2024-01-04"), "Closed - Before Opening")
        .when(F.col("is_open"), "OPEN")
        .otherwise("Closed - Other")
    )
    return (
        posting_calendar(t)
        .filter("month = 1")
        .select("date_key", "full_date", "day_name", "is_open", status.alias("status"), "postings")
        .orderBy("date_key")
    )


@query(
    "holiday_closures",
    f"""SELECT date_key, day_name, CASE WHEN full_date < DATE '2024-01-04' THEN 'Pre-Opening (Jan 1-3)' WHEN full_date = DATE '2024-03-29' THEN 'Good Friday'
    WHEN full_date = DATE '2024-04-01' THEN 'Easter Monday' WHEN full_date BETWEEN DATE '2024-12-25' AND DATE '2024-12-27' THEN 'Christmas Period' END AS holiday, postings
    FROM {POSTING_CALENDAR} WHERE NOT is_open AND day_name <> 'Sunday'""",
)
def holiday_closures(t):
    d = F.col("full_date")
    label = (
        F.when(d < "2024-01-04", "Pre-Opening (Jan 1-3)")
        .when(d == "2024-03-29", "Good Friday")
        .when(d == "2024-04-01", "Easter Monday")
        .when(d.between("2024-12-25", "2024-12-27"), "Christmas Period")
    )
    return posting_calendar(t).filter("NOT is_open AND day_name <> 'Sunday'").select("date_key", "day_name", label.alias("holiday"), "postings")


@query(
    "sales_period_summary",
    f"""SELECT CAST(year AS INTEGER) AS year, CASE month WHEN 2 THEN 'February Sales' WHEN 6 THEN 'June Sales' WHEN 11 THEN 'November Sales' END AS period, {key_of('min(full_date)')} AS start_key,
    {key_of('max(full_date)')} AS end_key, count(*) AS days, CAST(sum(CASE WHEN is_open THEN 1 ELSE 0 END) AS BIGINT) AS open_days, CAST(sum(coalesce(n, 0)) AS BIGINT) AS orders
    FROM {CAL_ORDERS} c LEFT JOIN (SELECT o_date, count(*) AS n FROM {ORDERS} GROUP BY 1) o ON o.o_date = c.full_date WHERE is_sale GROUP BY year, month""",
)
def sales_period_summary(t):
    cal = calendar_for(t.orders, "o_orderdate", EVERY_YEAR).filter("is_sale")
    per_day = t.orders.groupBy("o_date").agg(F.count("*").alias("n"))
    names = F.when(F.col("month") == 2, "February Sales").when(F.col("month") == 6, "June Sales").when(F.col("month") == 11, "November Sales")
    return (
        cal.join(per_day, F.col("full_date") == F.col("o_date"), "left")
        .groupBy("year", "month")
        .agg(
            date_key(F.min("full_date")).alias("start_key"),
            date_key(F.max("full_date")).alias("end_key"),
            F.count("*").alias("days"),
            F.count_if("is_open").alias("open_days"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orders"),
        )
        .withColumn("period", names)
        .drop("month")
    )


@query(
    "monthly_open_days",
    f"""SELECT CAST(month AS INTEGER) AS month, month_name, count(*) AS days, count(*) FILTER (is_open) AS open_days, count(*) FILTER (NOT is_open) AS closed_days,
    count(*) FILTER (is_peak) AS peak_days, count(*) FILTER (is_sale) AS sale_days, CAST(sum(postings) AS BIGINT) AS postings FROM {POSTING_CALENDAR} GROUP BY month, month_name ORDER BY month""",
)
def monthly_open_days(t):
    return (
        posting_calendar(t)
        .groupBy("month", "month_name")
        .agg(
            F.count("*").alias("days"),
            F.count_if("is_open").alias("open_days"),
            F.count_if(~F.col("is_open")).alias("closed_days"),
            F.count_if("is_peak").alias("peak_days"),
            F.count_if("is_sale").alias("sale_days"),
            F.sum("postings").alias("postings"),
        )
        .orderBy("month")
    )


# Purchases

TIER_SQL = "CASE WHEN p_size <= 15 THEN 'Small' WHEN p_size <= 35 THEN 'Medium' ELSE 'Large' END"


def tier() -> Column:
    return F.when(F.col("p_size") <= 15, "Small").when(F.col("p_size") <= 35, "Medium").otherwise("Large")


def lines_with_part(t) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))


@query(
    "category_cost_mix",
    f"""WITH g AS (SELECT p_type, count(*) AS n, min(l_extendedprice) AS a, max(l_extendedprice) AS b, {mean('l_extendedprice')} AS avg_cost FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey GROUP BY 1)
    SELECT p_type, n, {share('n', 'sum(n) OVER ()')} AS pct, {dbl('a')} AS min_cost, {dbl('b')} AS max_cost, avg_cost FROM g ORDER BY n DESC, p_type""",
)
def category_cost_mix(t):
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.count("*").alias("c"),
        F.min("l_extendedprice").alias("lo"),
        F.max("l_extendedprice").alias("hi"),
        total("l_extendedprice").alias("amount"),
    )
    g = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(
        F.sum("c").alias("n"),
        F.min("lo").alias("min_cost"),
        F.max("hi").alias("max_cost"),
        (F.sum("amount").cast("double") / F.sum("c")).alias("avg_cost"),
    )
    return pct_by(g).orderBy(F.desc("n"), "p_type")


@query(
    "size_tier_profile",
    f"""SELECT {TIER_SQL} AS tier, count(*) AS purchases, min(l_quantity) AS min_items, max(l_quantity) AS max_items, CAST(sum(l_quantity) AS DOUBLE) / count(*) AS avg_items,
    CAST(sum(65 + {draw('sellable', 26, 'l_row')}) AS DOUBLE) / count(*) AS avg_sellable_pct FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey GROUP BY 1""",
)
def size_tier_profile(t):
    """Averages are exact doubles, not the truncated integers of an integer average."""
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.count("*").alias("c"),
        F.min("l_quantity").alias("lo"),
        F.max("l_quantity").alias("hi"),
        F.sum("l_quantity").alias("q"),
        F.sum(draw_col("sellable", 26, "l_row") + 65).alias("ok"),
    )
    return per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(tier().alias("tier")).agg(
        F.sum("c").alias("purchases"),
        F.min("lo").alias("min_items"),
        F.max("hi").alias("max_items"),
        (F.sum("q").cast("double") / F.sum("c")).alias("avg_items"),
        (F.sum("ok").cast("double") / F.sum("c")).alias("avg_sellable_pct"),
    )


FUNDED = f"{draw('funding', 100, 'l_row')} < 60"


@query(
    "funding_mix",
    f"""SELECT 'Total purchases' AS metric, count(*) AS n FROM {LINEITEM} UNION ALL SELECT 'Loan-funded', count(*) FROM {LINEITEM} WHERE {FUNDED}
    UNION ALL SELECT 'Profit-funded', count(*) FROM {LINEITEM} WHERE NOT {FUNDED}""",
)
def funding_mix(t):
    by_loan = t.lineitem.select((draw_col("funding", 100, "l_row") < 60).alias("by_loan"))
    one = by_loan.agg(F.count("*").alias("total"), F.count_if("by_loan").alias("loan"), F.count_if(~F.col("by_loan")).alias("profit"))
    rows = [F.struct(F.lit(a).alias("metric"), F.col(b).alias("n")) for a, b in (("Total purchases", "total"), ("Loan-funded", "loan"), ("Profit-funded", "profit"))]
    return one.select(F.inline(F.array(*rows)))


FIRST = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "bell_detail",
    f"""SELECT l_row, {key_of('l_date')} AS date_key, p_type, p_brand, {TIER_SQL} AS tier, s_name, l_quantity, {dbl('l_extendedprice')} AS cost FROM {LINEITEM}
    JOIN {PART} p ON p_partkey = l_partkey JOIN {SUPPLIER} s ON s_suppkey = l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 25""",
)
def bell_detail(t):
    """The first 25 rows that have both labels: a row without one does not count."""
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .orderBy(*FIRST)
        .limit(25)
        .select(
            "l_row", date_key("l_date").alias("date_key"), "p_type", "p_brand", tier().alias("tier"), "s_name", "l_quantity",
            F.col("l_extendedprice").alias("cost"),
        )
    )


# Items


@query("item_status_mix", f"SELECT CASE WHEN l_linestatus = 'F' THEN 'Items Sold' ELSE 'Items Unsold' END AS status, count(*) AS n, {share('count(*)', f'(SELECT count(*) FROM {LINEITEM})')} AS pct FROM {LINEITEM} GROUP BY 1")
def item_status_mix(t):
    label = F.when(F.col("l_linestatus") == "F", "Items Sold").otherwise("Items Unsold")
    return pct_by(t.lineitem.groupBy(label.alias("status")).agg(F.count("*").alias("n")))


@query(
    "grade_mix",
    f"WITH g AS (SELECT CASE WHEN {draw('grade', 100, 'p_partkey')} < 70 THEN 'Grade 1' ELSE 'Grade 2' END AS grade, count(*) AS n FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey GROUP BY 1) SELECT grade, n, {share('n', 'sum(n) OVER ()')} AS pct FROM g",
)
def grade_mix(t):
    """Items are counted per product before the grade is looked up."""
    per_part = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("m"))
    grades = t.part.select("p_partkey", F.when(draw_col("grade", 100, "p_partkey") < 70, "Grade 1").otherwise("Grade 2").alias("grade"))
    return pct_by(per_part.join(grades, F.col("l_partkey") == F.col("p_partkey")).groupBy("grade").agg(F.sum("m").alias("n")))


@query("discounted_items", f"WITH {DATED} SELECT 'Discounted items' AS metric, count(*) FILTER (in_discount) AS n, 'Items 90+ days old with a sale period ahead' AS note FROM disc")
def discounted_items_report(t):
    return discounted_items(t).agg(F.count_if("is_in_discount").alias("n")).select(
        F.lit("Discounted items").alias("metric"), "n", F.lit("Items 90+ days old with a sale period ahead").alias("note")
    )


@query(
    "item_sample",
    f"""SELECT l_row, p_type, {dbl('l_extendedprice')} AS price, CASE WHEN l_linestatus = 'F' THEN 'Sold' ELSE 'Unsold' END AS status,
    CASE WHEN l_discount >= 0.05 THEN CAST(CAST(l_discount * 100 AS INTEGER) AS VARCHAR) || '%' ELSE '-' END AS discount
    FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20""",
)
def item_sample(t):
    off = F.concat((F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).orderBy(*FIRST).limit(20).select(
        "l_row",
        "p_type",
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linestatus") == "F", "Sold").otherwise("Unsold").alias("status"),
        F.when(F.col("l_discount") >= F.lit("0.05").cast("decimal(4,2)"), off).otherwise("-").alias("discount"),
    )


# Sales

PAY_SQL = "CASE o_orderstatus WHEN 'F' THEN 'Cash' WHEN 'O' THEN 'Transfer' WHEN 'P' THEN 'POS' END"


def payment() -> Column:
    s = F.col("o_orderstatus")
    return F.when(s == "F", "Cash").when(s == "O", "Transfer").when(s == "P", "POS")


@query(
    "sales_summary",
    f"""SELECT 'Total transactions' AS metric, (SELECT count(*) FROM {ORDERS}) AS n, (SELECT {dbl('sum(o_totalprice)')} FROM {ORDERS}) AS revenue,
    (SELECT {mean('o_totalprice')} FROM {ORDERS}) AS avg_transaction, (SELECT {dbl('sum(CAST(l_extendedprice * l_discount AS DECIMAL(12,2)))')} FROM {LINEITEM}) AS discounts""",
)
def sales_summary(t):
    """Two one-row aggregates side by side: sales and their lines are not joined."""
    off = t.lineitem.agg(total((F.col("l_extendedprice") * F.col("l_discount")).cast(AMOUNT)).alias("x")).scalar()
    return t.orders.agg(
        F.count("*").alias("n"), total("o_totalprice").alias("revenue"), mean_col("o_totalprice").alias("avg_transaction")
    ).select(F.lit("Total transactions").alias("metric"), "n", "revenue", "avg_transaction", off.alias("discounts"))


BAND_SQL = "CASE WHEN k = 1 THEN '1 item' WHEN k BETWEEN 2 AND 4 THEN '2-4 items' WHEN k BETWEEN 5 AND 8 THEN '5-8 items' WHEN k BETWEEN 9 AND 10 THEN '9-10 items' ELSE '11+ items' END"


def lines_per_order(t) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("items"))


def sales_with_items(t) -> DataFrame:
    return t.orders.join(lines_per_order(t), F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn(
        "items", F.coalesce("items", F.lit(0))
    )


@query(
    "basket_size_bands",
    f"""WITH b AS (SELECT o_orderkey, o_totalprice, count(*) AS k FROM {ORDERS} JOIN {LINEITEM} l ON l_orderkey = o_orderkey GROUP BY ALL),
    g AS (SELECT {BAND_SQL} AS band, min(k) AS lo, count(*) AS n, {mean('o_totalprice')} AS avg_value FROM b GROUP BY 1) SELECT band, n, {share('n', 'sum(n) OVER ()')} AS pct, avg_value FROM g ORDER BY lo""",
)
def basket_size_bands(t):
    k = F.col("items")
    labels = ["1 item", "2-4 items", "5-8 items", "9-10 items", "11+ items"]
    rank = F.when(k == 1, 0).when(k <= 4, 1).when(k <= 8, 2).when(k <= 10, 3).otherwise(4)
    sold = t.orders.join(lines_per_order(t), F.col("o_orderkey") == F.col("l_orderkey"))
    g = sold.groupBy(rank.alias("r")).agg(F.count("*").alias("n"), mean_col("o_totalprice").alias("avg_value"))
    return pct_by(g).orderBy("r").select(F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("r") + 1).alias("band"), "n", "pct", "avg_value")


@query(
    "payment_mix",
    f"""SELECT {PAY_SQL} AS payment_method, count(*) AS n, {share('count(*)', f'(SELECT count(*) FROM {ORDERS})')} AS pct, {dbl('sum(o_totalprice)')} AS amount FROM {ORDERS} GROUP BY 1 ORDER BY n DESC""",
)
def payment_mix(t):
    g = t.orders.groupBy(payment().alias("payment_method")).agg(F.count("*").alias("n"), total("o_totalprice").alias("amount"))
    return pct_by(g).orderBy(F.desc("n"), "payment_method")


@query(
    "recurring_mix",
    f"WITH g AS (SELECT CASE WHEN {draw('returning', 100, 'o_orderkey')} < 35 THEN 'Recurring' ELSE 'New' END AS customer_type, count(*) AS n FROM {ORDERS} GROUP BY 1) SELECT customer_type, n, {share('n', 'sum(n) OVER ()')} AS pct FROM g",
)
def recurring_mix(t):
    label = F.when(draw_col("returning", 100, "o_orderkey") < 35, "Recurring").otherwise("New")
    return pct_by(t.orders.groupBy(label.alias("customer_type")).agg(F.count("*").alias("n")))


@query(
    "monthly_sales",
    f"""SELECT CAST(c.year AS INTEGER) AS year, CAST(c.month AS INTEGER) AS month, c.month_name, count(*) AS transactions, CAST(sum(coalesce(k, 0)) AS BIGINT) AS items_sold,
    {dbl('sum(o_totalprice)')} AS revenue, {mean('o_totalprice')} AS avg_transaction FROM {ORDERS} o
    LEFT JOIN (SELECT l_orderkey, count(*) AS k FROM {LINEITEM} GROUP BY 1) l ON l_orderkey = o_orderkey JOIN {CAL_ORDERS} c ON c.full_date = o.o_date GROUP BY ALL ORDER BY 1, 2""",
)
def monthly_sales(t):
    """Orders are reduced to one row per day before they meet the calendar."""
    cal = calendar_for(t.orders, "o_orderdate", EVERY_YEAR).select("full_date", "year", "month", "month_name")
    daily = sales_with_items(t).groupBy("o_date").agg(
        F.count("*").alias("sales"), F.sum("items").alias("items"), total("o_totalprice").alias("amount")
    )
    return (
        daily.join(cal, F.col("o_date") == F.col("full_date"))
        .groupBy("year", "month", "month_name")
        .agg(
            F.sum("sales").alias("transactions"),
            F.sum("items").alias("items_sold"),
            total("amount").alias("revenue"),
            (F.sum("amount").cast("double") / F.sum("sales")).alias("avg_transaction"),
        )
        .orderBy("year", "month")
    )


@query(
    "transaction_sample",
    f"""SELECT o_orderkey, {key_of('o_date')} AS date_key, day_name, {dbl('o_totalprice')} AS total_amount, {PAY_SQL} AS payment_method,
    CASE WHEN {draw('returning', 100, 'o_orderkey')} < 35 THEN 'Yes' ELSE 'No' END AS recurring FROM {ORDERS} JOIN {CAL_ORDERS} c ON full_date = o_date ORDER BY o_orderkey LIMIT 10""",
)
def transaction_sample(t):
    cal = calendar_for(t.orders, "o_orderdate", EVERY_YEAR).select("full_date", "day_name")
    return t.orders.join(cal, F.col("o_date") == F.col("full_date")).orderBy("o_orderkey").limit(10).select(
        "o_orderkey",
        date_key("o_date").alias("date_key"),
        "day_name",
        F.col("o_totalprice").alias("total_amount"),
        payment().alias("payment_method"),
        F.when(draw_col("returning", 100, "o_orderkey") < 35, "Yes").otherwise("No").alias("recurring"),
    )


@query(
    "first_transaction_items",
    f"""SELECT l_row, p_type, p_brand, {dbl('l_extendedprice')} AS price FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey WHERE l_orderkey = (SELECT min(l_orderkey) FROM {LINEITEM})""",
)
def first_transaction_items(t):
    first = t.lineitem.agg(F.min("l_orderkey")).scalar()
    return lines_with_part(t).filter(F.col("l_orderkey") == first).select("l_row", "p_type", "p_brand", F.col("l_extendedprice").alias("price"))


@query(
    "monthly_revenue_sell_through",
    f"""SELECT CAST(year(o_date) AS INTEGER) AS year, CAST(month(o_date) AS INTEGER) AS month, count(DISTINCT o_orderkey) AS transactions, {dbl('sum(o_totalprice)')} AS revenue_per_item_row,
    {share("sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)", 'count(*)')} AS sell_through_pct,
    {dbl('sum(CASE WHEN rn = 1 THEN o_totalprice ELSE 0 END)')} AS revenue FROM {ORDERS} JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_row) AS rn FROM {LINEITEM}) l ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def monthly_revenue_sell_through(t):
    """Revenue as the joined sum gives it (each sale counted once per item) and without that fan-out.

    Items are counted per sale first, so the repeated sum is a multiplication.
    """
    per_sale = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("k"), F.count_if(F.col("l_linestatus") == "F").alias("sold"))
    j = t.orders.join(per_sale, F.col("o_orderkey") == F.col("l_orderkey"))
    return (
        j.groupBy(F.year("o_date").alias("year"), F.month("o_date").alias("month"))
        .agg(
            F.count("*").alias("transactions"),
            F.sum(F.col("o_totalprice") * F.col("k").cast("decimal(10,0)")).cast(TOTAL).alias("revenue_per_item_row"),
            total("o_totalprice").alias("revenue"),
            F.sum("sold").alias("s"),
            F.sum("k").alias("n"),
        )
        .withColumn("sell_through_pct", share_col("s", "n"))
        .drop("s", "n")
    )


# Expenses: the event log read as expense records

CATEGORY = {"purchase": "Rent", "signup": "Staff", "click": "Utilities", "view": "Transport", "error": "Other"}
CATEGORY_SQL = "CASE event_type" + "".join(f" WHEN '{k}' THEN '{v}'" for k, v in CATEGORY.items()) + " END"
EXPENSE_VIEW = f"""(SELECT event_id, e_date, {CATEGORY_SQL} AS category, value, event_type IN ('purchase', 'signup') AS is_recurring,
  CASE WHEN {draw('method', 100, 'event_id')} < 40 THEN 'Cash' ELSE 'Transfer' END AS method FROM {EVENTS})"""


def expense_view(t) -> DataFrame:
    names = F.create_map(*[F.lit(x) for kv in CATEGORY.items() for x in kv])
    return t.events.select(
        "event_id",
        "e_date",
        F.try_element_at(names, F.col("event_type")).alias("category"),
        "value",
        F.col("event_type").isin("purchase", "signup").alias("is_recurring"),
        F.when(draw_col("method", 100, "event_id") < 40, "Cash").otherwise("Transfer").alias("method"),
    )


@query("expense_summary", f"SELECT 'Total expense records' AS metric, count(*) AS n, {dbl('sum(value)')} AS amount FROM {EXPENSE_VIEW}")
def expense_summary(t):
    return expense_view(t).agg(F.count("*").alias("n"), total("value").alias("amount")).select(F.lit("Total expense records").alias("metric"), "n", "amount")


@query("expense_by_category", f"SELECT category, count(*) AS n, {dbl('sum(value)')} AS amount, {mean('value')} AS avg_amount FROM {EXPENSE_VIEW} GROUP BY 1 ORDER BY amount DESC")
def expense_by_category(t):
    return (
        expense_view(t)
        .groupBy("category")
        .agg(F.count("*").alias("n"), total("value").alias("amount"), mean_col("value").alias("avg_amount"))
        .orderBy(F.desc("amount"))
    )


@query("expense_by_type", f"SELECT CASE WHEN is_recurring THEN 'Recurring' ELSE 'Variable' END AS expense_type, count(*) AS n, {dbl('sum(value)')} AS amount FROM {EXPENSE_VIEW} GROUP BY 1")
def expense_by_type(t):
    label = F.when(F.col("is_recurring"), "Recurring").otherwise("Variable")
    return expense_view(t).groupBy(label.alias("expense_type")).agg(F.count("*").alias("n"), total("value").alias("amount"))


@query("expense_by_method", f"SELECT method, count(*) AS n, {dbl('sum(value)')} AS amount FROM {EXPENSE_VIEW} GROUP BY 1")
def expense_by_method(t):
    return expense_view(t).groupBy("method").agg(F.count("*").alias("n"), total("value").alias("amount"))


@query("expense_sample", f"SELECT event_id, {txt('e_date')} AS expense_date, category, {dbl('value')} AS amount, method FROM {EXPENSE_VIEW} ORDER BY e_date, event_id LIMIT 20")
def expense_sample(t):
    keyed = expense_view(t).withColumn("date_key", date_key("e_date"))
    return keyed.orderBy("date_key", "event_id").limit(20).select(
        "event_id", date_of("date_key").alias("expense_date"), "category", F.col("value").alias("amount"), "method"
    )


# Cash

NO_DEFICIT = "text NOT ILIKE '%deficit%'"


@query("final_balances", f"WITH RECURSIVE {CASCADE} SELECT user_id, account, {money('sum(sign * c)')} AS balance FROM led GROUP BY ALL")
def final_balances(t):
    """The balance after the last posting is the sum of all postings, which needs no ordering."""
    return ledger.closing_balances(full_ledger(t), ["user_id"])


@query(
    "monthly_cash_flow",
    f"""WITH RECURSIVE {CASCADE} SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, account, {money('sum(CASE WHEN sign > 0 THEN c ELSE 0 END)')} AS inflows,
    {money('sum(CASE WHEN sign < 0 THEN c ELSE 0 END)')} AS outflows FROM led WHERE kind <> 'Transfer' OR {NO_DEFICIT} GROUP BY ALL""",
)
def monthly_cash_flow(t):
    kept = full_ledger(t).filter((F.col("kind") != "Transfer") | ~F.col("description").ilike("%deficit%"))
    effect, zero = ledger.signed(), F.lit(0).cast(AMOUNT)
    return kept.groupBy(F.year("day").alias("year"), F.month("day").alias("month"), "account").agg(
        F.sum(F.when(effect > 0, F.col("amount")).otherwise(zero)).cast(TOTAL).alias("inflows"),
        F.sum(F.when(effect < 0, F.col("amount")).otherwise(zero)).cast(TOTAL).alias("outflows"),
    )


@query(
    "deficit_count",
    f"WITH RECURSIVE {CASCADE} SELECT count(*) FILTER (text ILIKE '%deficit correction%') AS correction_rows, count(*) FILTER (text LIKE 'Deficit correction%') AS corrections FROM led",
)
def deficit_count(t):
    """Each correction has two postings; both match without regard to case, one with regard to it."""
    text = F.col("description")
    return full_ledger(t).agg(
        F.count_if(text.ilike("%deficit correction%")).alias("correction_rows"),
        F.count_if(text.like("Deficit correction%")).alias("corrections"),
    )


@query(
    "cash_flow_by_account",
    f"WITH {E_SQL} SELECT account, {money('sum(CASE WHEN kind = ' + repr('Deposit') + ' THEN c ELSE 0 END)')} AS inflows, {money('sum(CASE WHEN kind = ' + repr('Withdrawal') + ' THEN c ELSE 0 END)')} AS outflows FROM mv GROUP BY 1",
)
def cash_flow_by_account(t):
    kind, zero = F.col("kind"), F.lit(0).cast(AMOUNT)
    return event_postings(t).groupBy("account").agg(
        F.sum(F.when(kind == "Deposit", F.col("amount")).otherwise(zero)).cast(TOTAL).alias("inflows"),
        F.sum(F.when(kind == "Withdrawal", F.col("amount")).otherwise(zero)).cast(TOTAL).alias("outflows"),
    )


# Sell-through, loans, dimensions


@query(
    "category_sell_through",
    f"""SELECT p_type, count(*) AS items, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS sold, {share("sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)", 'count(*)')} AS sell_through_pct
    FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey GROUP BY 1 ORDER BY items DESC, p_type""",
)
def category_sell_through(t):
    per_part = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("c"), F.count_if(F.col("l_linestatus") == "F").alias("s"))
    g = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(
        F.sum("c").alias("items"), F.sum("s").alias("sold")
    )
    return g.withColumn("sell_through_pct", share_col("sold", "items")).orderBy(F.desc("items"), "p_type")


@query(
    "loan_dashboard",
    f"""WITH {PROGRESS} SELECT loan_id, {money('principal')} AS principal, months, {dbl('rate')} AS rate, n AS payments_made, {money('paid')} AS total_repaid,
    CASE WHEN remaining * 2 <= months THEN 'Closed' ELSE 'Active' END AS status FROM prog""",
)
def loan_dashboard(t):
    return loan_state(t).select(
        "loan_id", "principal", "months", "rate", "payments_made", F.col("repaid_to_date").alias("total_repaid"),
        F.when(F.col("is_fully_repaid"), "Closed").otherwise("Active").alias("status"),
    )


@query(
    "inventory_aging",
    f"""WITH {DATED} SELECT p_type, count(*) AS items, CAST(sum(CASE WHEN sold_date IS NOT NULL THEN days ELSE age END) AS DOUBLE) / count(*) AS avg_age,
    count(*) FILTER (sold_date IS NOT NULL) AS sold, count(*) FILTER (in_discount) AS discounted FROM disc GROUP BY 1 ORDER BY avg_age DESC""",
)
def inventory_aging(t):
    """Unsold items age until the end of the calendar; counting them as zero days would hide old stock."""
    as_of = calendar_for(t.lineitem, "l_shipdate", EVERY_YEAR).agg(F.max("full_date")).scalar()
    age = F.coalesce("days_in_inventory", F.datediff(as_of, "l_date"))
    return (
        discounted_items(t)
        .groupBy("p_type")
        .agg(
            F.count("*").alias("items"),
            (F.sum(age).cast("double") / F.count("*")).alias("avg_age"),
            F.count_if("is_sold").alias("sold"),
            F.count_if("is_in_discount").alias("discounted"),
        )
        .orderBy(F.desc("avg_age"))
    )


@query(
    "loan_list",
    f"""WITH {LOANS} SELECT loan_id, {txt('loan_date')} AS loan_date, {money('principal')} AS principal, months, {money('monthly')} AS monthly_payment, {money('total')} AS total_to_repay,
    {money('interest')} AS interest, CAST(rate AS VARCHAR) || '.00%' AS annual_rate FROM terms ORDER BY loan_date, loan_id""",
)
def loan_list(t):
    keyed = loan_book(t).withColumn("loan_date_key", date_key("loan_date"))
    return keyed.orderBy("loan_date_key", "loan_id").select(
        "loan_id",
        date_of("loan_date_key").alias("loan_date"),
        "principal",
        "months",
        F.col("monthly_repayment").alias("monthly_payment"),
        F.col("total_repayment").alias("total_to_repay"),
        F.col("interest_amount").alias("interest"),
        F.concat(F.col("rate").cast("string"), F.lit("%")).alias("annual_rate"),
    )


@query(
    "loan_summary",
    f"""WITH {LOANS} SELECT count(*) AS loans, {mean('principal')} / 100 AS avg_principal, {money('sum(principal)')} AS total_principal, {money('sum(interest)')} AS total_interest,
    {mean('months')} AS avg_months, {mean('rate')} AS avg_rate, '₦' || format('{{:,}}', CAST(sum(principal) // 100 AS BIGINT)) || '.' || lpad(CAST(CAST(sum(principal) % 100 AS BIGINT) AS VARCHAR), 2, '0') AS total_shown FROM terms""",
)
def loan_summary(t):
    cents = (F.col("principal") * 100).cast("bigint")
    return loan_book(t).agg(
        F.count("*").alias("loans"),
        (F.sum(cents).cast("double") / F.count("*") / 100).alias("avg_principal"),
        total("principal").alias("total_principal"),
        total("interest_amount").alias("total_interest"),
        (F.sum("months").cast("double") / F.count("*")).alias("avg_months"),
        mean_col("rate").alias("avg_rate"),
        naira(total("principal")).alias("total_shown"),
    )


@query(
    "repayment_by_status",
    f"WITH {PAYMENTS}, g AS (SELECT status, count(*) AS n, CAST(sum(actual) AS DOUBLE) / 100 / count(*) AS avg_amount FROM pay GROUP BY 1) SELECT status AS payment_status, n, {share('n', 'sum(n) OVER ()')} AS pct, avg_amount FROM g",
)
def repayment_by_status(t):
    g = loan_payments(t).groupBy("payment_status").agg(F.count("*").alias("n"), mean_col("actual_amount").alias("avg_amount"))
    return pct_by(g)


@query(
    "loan_completion",
    f"""WITH {PAYMENTS} SELECT t.loan_id, t.months, count(p.k) AS repayments, {money('t.total')} AS total_due, {money('sum(p.actual)')} AS total_paid, {money('t.total - sum(p.actual)')} AS shortfall
    FROM terms t LEFT JOIN pay p ON p.loan_id = t.loan_id GROUP BY t.loan_id, t.months, t.total""",
)
def loan_completion(t):
    paid = loan_payments(t).groupBy(F.col("loan_id").alias("k")).agg(F.count("*").alias("n"), total("actual_amount").alias("total_paid"))
    return loan_book(t).join(paid, F.col("loan_id") == F.col("k"), "left").select(
        "loan_id",
        "months",
        F.coalesce("n", F.lit(0)).alias("repayments"),
        F.col("total_repayment").alias("total_due"),
        "total_paid",
        (F.col("total_repayment") - F.col("total_paid")).alias("shortfall"),
    )


GENDER_SQL = f"CASE WHEN {draw('gender', 100, 'p_brand')} < 30 THEN 'Female' WHEN {draw('gender', 100, 'p_brand')} < 35 THEN 'Male' ELSE 'Both' END"
VARIANTS = f"(SELECT p_type, p_brand, max(p_size) >= 49 AS fast, {GENDER_SQL} AS gender FROM {PART} GROUP BY ALL)"


def variants(t) -> DataFrame:
    g = draw_col("gender", 100, "p_brand")
    gender = F.when(g < 30, "Female").when(g < 35, "Male").otherwise("Both")
    return t.part.groupBy("p_type", "p_brand").agg((F.max("p_size") >= 49).alias("fast")).withColumn("gender", gender)


@query(
    "subcategory_stats",
    f"""WITH v AS (SELECT * FROM {VARIANTS}) SELECT 'Total subcategories' AS metric, count(*) AS n FROM v UNION ALL SELECT 'Fast-moving', count(*) FROM v WHERE fast
    UNION ALL SELECT 'Male-specific', count(*) FROM v WHERE gender = 'Male' UNION ALL SELECT 'Female-specific', count(*) FROM v WHERE gender = 'Female' UNION ALL SELECT 'Gender-neutral', count(*) FROM v WHERE gender = 'Both'""",
)
def subcategory_stats(t):
    one = variants(t).agg(
        F.count("*").alias("Total subcategories"),
        F.count_if("fast").alias("Fast-moving"),
        F.count_if(F.col("gender") == "Male").alias("Male-specific"),
        F.count_if(F.col("gender") == "Female").alias("Female-specific"),
        F.count_if(F.col("gender") == "Both").alias("Gender-neutral"),
    )
    return one.unpivot([], one.columns, "metric", "n")


@query("subcategory_list", f"SELECT p_type, p_brand, fast, gender FROM {VARIANTS} ORDER BY p_type, p_brand")
def subcategory_list(t):
    return variants(t).orderBy("p_type", "p_brand")


@query("grade_label", f"SELECT p_partkey, CASE WHEN {draw('grade', 100, 'p_partkey')} < 70 THEN 'Eligible for 50% markup' ELSE 'Max 30% markup' END AS label FROM {PART}")
def grade_label(t):
    ok = draw_col("grade", 100, "p_partkey") < 70
    return t.part.select("p_partkey", F.when(ok, "Eligible for 50% markup").otherwise("Max 30% markup").alias("label"))
