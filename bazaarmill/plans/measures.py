"""Business measures: revenue, sell-through, profit, inventory, loans and their trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.dates import date_key, date_of
from ..functions.money import AMOUNT, TOTAL, share as share_col, total
from ..operators import ledger
from ..operators.calendar import EVERY_YEAR, calendar_for
from ..registry import query
from .domain import (
    CASCADE, DATED, EXPENSES, PAYMENTS, PROGRESS, SCORED, dated_items, full_ledger, loan_payments, loan_state, money,
    sales_by_day, scored_items, store_expenses,
)
from .sqltext import LINEITEM, ORDERS, PART, dbl, key_of, share, txt

COST_SQL = "CAST(l_extendedprice * 0.60 AS DECIMAL(12,2))"


def cost() -> Column:
    """Cost of a line: sixty percent of its price."""
    return (F.col("l_extendedprice") * F.lit("0.60").cast("decimal(3,2)")).cast(AMOUNT)


def ratio_pct(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.try_divide(a.cast("double"), b.cast("double")) * 100


# Revenue


@query("total_revenue", f"SELECT {dbl('sum(o_totalprice)')} AS total_revenue FROM {ORDERS}")
def total_revenue(t):
    return t.orders.agg(total("o_totalprice").alias("total_revenue"))


@query(
    "ytd_revenue",
    f"SELECT {key_of('d')} AS date_key, {dbl('r')} AS revenue, {dbl('sum(r) OVER (PARTITION BY year(d) ORDER BY d)')} AS ytd_revenue FROM (SELECT o_date AS d, sum(o_totalprice) AS r FROM {ORDERS} GROUP BY 1)",
)
def ytd_revenue(t):
    """Running total over at most 366 daily rows per year."""
    w = W.partitionBy(F.year("day")).orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    return sales_by_day(t).select(
        date_key("day").alias("date_key"), F.col("amount").alias("revenue"), F.sum("amount").over(w).cast("decimal(38,2)").alias("ytd_revenue")
    )


@query("sell_through_pct", f"SELECT CAST(count(*) FILTER (l_linestatus = 'F') AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS sell_through_pct FROM {LINEITEM}")
def sell_through_pct(t):
    return t.lineitem.agg(ratio_pct(F.count_if(F.col("l_linestatus") == "F"), F.count("*")).alias("sell_through_pct"))


@query("avg_transaction_value", f"SELECT CAST(sum(o_totalprice) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_transaction_value FROM {ORDERS}")
def avg_transaction_value(t):
    return t.orders.agg(F.try_divide(F.sum("o_totalprice").cast("double"), F.count("*").cast("double")).alias("avg_transaction_value"))


GROSS_SQL = f"(SELECT r, r - c AS g FROM (SELECT sum(o_totalprice) AS r FROM {ORDERS}), (SELECT sum({COST_SQL}) AS c FROM {LINEITEM}))"


def gross(t) -> DataFrame:
    """Sales and item costs are summed apart: joining them would repeat each sale per item."""
    spent = t.lineitem.agg(total(cost()).alias("x")).scalar()
    return t.orders.agg(total("o_totalprice").alias("revenue")).withColumn("gross_profit", (F.col("revenue") - spent).cast(TOTAL))


@query("gross_profit", f"SELECT {dbl('r')} AS revenue, {dbl('g')} AS gross_profit FROM {GROSS_SQL}")
def gross_profit(t):
    return gross(t)


@query("profit_margin_pct", f"SELECT {dbl('g')} / {dbl('r')} * 100 AS profit_margin_pct FROM {GROSS_SQL}")
def profit_margin_pct(t):
    return gross(t).select(ratio_pct("gross_profit", "revenue").alias("profit_margin_pct"))


@query(
    "revenue_trend",
    f"""SELECT grain, {txt('CAST(p AS DATE)')} AS period_start, {dbl('sum(r)')} AS revenue, count(*) AS days FROM (SELECT r, v.grain, CASE v.grain WHEN 'day' THEN d WHEN 'week' THEN date_trunc('week', d) ELSE date_trunc('month', d) END AS p
    FROM (SELECT o_date AS d, sum(o_totalprice) AS r FROM {ORDERS} GROUP BY 1) CROSS JOIN (VALUES ('day'), ('week'), ('month')) v(grain)) GROUP BY ALL""",
)
def revenue_trend(t):
    """One pass over the orders; the three grains are built from the daily sums."""
    grains = [F.struct(F.lit(g).alias("grain"), F.trunc("day", g).alias("p")) for g in ("week", "month")]
    grains.append(F.struct(F.lit("day").alias("grain"), F.col("day").alias("p")))
    return (
        sales_by_day(t)
        .withColumn("g", F.explode(F.array(*grains)))
        .groupBy(F.col("g.grain").alias("grain"), F.col("g.p").alias("period_start"))
        .agg(total("amount").alias("revenue"), F.count("*").alias("days"))
    )


@query(
    "top_subcategories",
    f"SELECT p_type, p_brand, CAST(sum(l_quantity) AS BIGINT) AS units, {dbl('sum(l_extendedprice)')} AS amount FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey GROUP BY ALL ORDER BY units DESC, p_type, p_brand LIMIT 10",
)
def top_subcategories(t):
    per_part = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("u"), total("l_extendedprice").alias("a"))
    return (
        per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type", "p_brand")
        .agg(F.sum("u").alias("units"), total("a").alias("amount"))
        .orderBy(F.desc("units"), "p_type", "p_brand")
        .limit(10)
    )


# Inventory


@query("avg_days_in_inventory", f"WITH {DATED} SELECT CAST(sum(days) FILTER (sold_date IS NOT NULL) AS DOUBLE) / count(*) FILTER (sold_date IS NOT NULL) AS avg_days FROM dated")
def avg_days_in_inventory(t):
    return dated_items(t).agg((F.sum("days_in_inventory").cast("double") / F.count("days_in_inventory")).alias("avg_days"))


@query("current_inventory_value", f"WITH {DATED} SELECT {money('sum(cost) FILTER (sold_date IS NULL)')} AS inventory_value FROM dated")
def current_inventory_value(t):
    return dated_items(t).filter("NOT is_sold").agg(total("cost").alias("inventory_value"))


BUCKET_SQL = "CASE WHEN age < 90 THEN '0-89' WHEN age < 120 THEN '90-119' WHEN age < 180 THEN '120-179' ELSE '180+' END"


def unsold_with_age(t) -> DataFrame:
    as_of = calendar_for(t.lineitem, "l_shipdate", EVERY_YEAR).agg(F.max("full_date")).scalar()
    return dated_items(t).filter("NOT is_sold").withColumn("age", F.datediff(as_of, "l_date"))


@query("aging_buckets", f"WITH {DATED} SELECT {BUCKET_SQL} AS bucket, count(*) AS items, {money('sum(cost)')} AS value FROM disc WHERE sold_date IS NULL GROUP BY 1")
def aging_buckets(t):
    a = F.col("age")
    bucket = F.when(a < 90, "0-89").when(a < 120, "90-119").when(a < 180, "120-179").otherwise("180+")
    return unsold_with_age(t).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("items"), total("cost").alias("value"))


@query("slow_movers", f"WITH {DATED} SELECT l_row, p_type, CAST(age AS INTEGER) AS age FROM disc WHERE sold_date IS NULL AND age >= 180")
def slow_movers(t):
    return unsold_with_age(t).filter("age >= 180").select("l_row", "p_type", "age")


# Profit


@query(
    "profit_and_loss",
    f"""SELECT year_month, {dbl('sum(revenue)')} AS revenue, {dbl('sum(cost)')} AS cost, {dbl('sum(expense)')} AS expenses, {dbl('sum(revenue) - sum(cost) - sum(expense)')} AS profit FROM (
    SELECT CAST(year(o_date) * 100 + month(o_date) AS INTEGER) AS year_month, sum(o_totalprice) AS revenue, CAST(0 AS DECIMAL(22,2)) AS cost, CAST(0 AS DECIMAL(22,2)) AS expense FROM {ORDERS} GROUP BY 1
    UNION ALL SELECT CAST(year(l_date) * 100 + month(l_date) AS INTEGER), 0, sum({COST_SQL}), 0 FROM {LINEITEM} GROUP BY 1
    UNION ALL SELECT CAST(expense_date_key // 100 AS INTEGER), 0, 0, sum(amount) FROM {EXPENSES} GROUP BY 1) GROUP BY 1""",
)
def profit_and_loss(t):
    """Each source is summed to months before the union."""

    def month(d):
        return (F.year(d) * 100 + F.month(d)).alias("year_month")

    zero = F.lit(0).cast(TOTAL)
    names = ("revenue", "cost", "expenses")

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("year_month", *[(F.col("v") if n == name else zero).alias(n) for n in names])

    parts = [
        part(t.orders.groupBy(month("o_date")).agg(total("o_totalprice").alias("v")), "revenue"),
        part(t.lineitem.groupBy(month("l_date")).agg(total(cost()).alias("v")), "cost"),
        part(store_expenses(t).groupBy(month(date_of("expense_date_key"))).agg(total("amount").alias("v")), "expenses"),
    ]
    return (
        parts[0].unionByName(parts[1]).unionByName(parts[2])
        .groupBy("year_month")
        .agg(*[total(n).alias(n) for n in names])
        .withColumn("profit", (F.col("revenue") - F.col("cost") - F.col("expenses")).cast(TOTAL))
    )


@query(
    "balances_over_time",
    f"""WITH RECURSIVE {CASCADE}, n AS (SELECT user_id, account, day, sum(sign * c) AS net FROM led GROUP BY ALL),
    b AS (SELECT user_id, account, day, sum(net) OVER (PARTITION BY user_id, account ORDER BY day) AS bal, lead(day) OVER (PARTITION BY user_id, account ORDER BY day) AS nxt FROM n),
    cal AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT min(day) AS a, max(day) AS z FROM led))
    SELECT user_id, account, {key_of('d')} AS date_key, {money('bal')} AS balance FROM b JOIN cal ON d >= day AND (nxt IS NULL OR d < nxt)""",
)
def balances_over_time(t):
    return ledger.balances_over_time(full_ledger(t), ["user_id"]).select("user_id", "account", date_key("day").alias("date_key"), "balance")


# Loans


@query("loan_outstanding", f"WITH {PROGRESS} SELECT count(*) FILTER (remaining * 2 > months) AS active, count(*) FILTER (remaining * 2 <= months) AS closed, {money('sum(remaining)')} AS outstanding FROM prog")
def loan_outstanding(t):
    return loan_state(t).agg(
        F.count_if(~F.col("is_fully_repaid")).alias("active"), F.count_if("is_fully_repaid").alias("closed"), total("remaining_balance").alias("outstanding")
    )


@query(
    "cumulative_repayments",
    f"WITH {PAYMENTS} SELECT year_month, {money('a')} AS repaid, {money('sum(a) OVER (ORDER BY year_month)')} AS cumulative FROM (SELECT CAST(year(due_date) * 100 + month(due_date) AS INTEGER) AS year_month, sum(actual) AS a FROM pay GROUP BY 1)",
)
def cumulative_repayments(t):
    """The window runs over one row per month."""
    monthly = loan_payments(t).groupBy((F.year("due_date") * 100 + F.month("due_date")).alias("year_month")).agg(total("actual_amount").alias("repaid"))
    w = W.orderBy("year_month").rowsBetween(W.unboundedPreceding, 0)
    return monthly.withColumn("cumulative", F.sum("repaid").over(w).cast("decimal(38,2)"))


@query("ontime_pct", f"WITH {PAYMENTS} SELECT count(*) AS payments, {share('sum(CASE WHEN r < 90 THEN 1 ELSE 0 END)', 'count(*)')} AS ontime_pct FROM pay")
def ontime_pct(t):
    return loan_payments(t).agg(
        F.count("*").alias("payments"), share_col(F.count_if(F.col("payment_status") == "OnTime"), F.count("*")).alias("ontime_pct")
    )


# Efficiency


@query(
    "bell_roi",
    f"""SELECT l_partkey, {dbl('c')} AS cost, {dbl('r')} AS revenue, {dbl('r - c')} / {dbl('c')} * 100 AS roi_pct FROM (SELECT l_partkey, sum({COST_SQL}) AS c,
    sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(12,2)) ELSE 0 END) AS r FROM {LINEITEM} GROUP BY 1)""",
)
def bell_roi(t):
    net = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(AMOUNT)
    g = t.lineitem.groupBy("l_partkey").agg(
        total(cost()).alias("cost"), total(F.when(F.col("l_linestatus") == "F", net).otherwise(F.lit(0).cast(AMOUNT))).alias("revenue")
    )
    return g.withColumn("roi_pct", ratio_pct(F.col("revenue") - F.col("cost"), "cost"))


@query(
    "category_profitability",
    f"""SELECT p_type, {dbl('sum(l_extendedprice)')} AS revenue, {dbl(f'sum({COST_SQL})')} AS cost, {dbl(f'sum(l_extendedprice) - sum({COST_SQL})')} AS profit FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey GROUP BY 1""",
)
def category_profitability(t):
    per_part = t.lineitem.groupBy("l_partkey").agg(total("l_extendedprice").alias("r"), total(cost()).alias("c"))
    g = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(
        total("r").alias("revenue"), total("c").alias("cost")
    )
    return g.withColumn("profit", (F.col("revenue") - F.col("cost")).cast(TOTAL))


@query(
    "discount_effect",
    f"""SELECT CASE WHEN l_discount = 0 THEN 'none' WHEN l_discount < 0.05 THEN 'low' ELSE 'high' END AS band, count(*) AS items,
    {share("sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)", 'count(*)')} AS sell_through_pct FROM {LINEITEM} GROUP BY 1""",
)
def discount_effect(t):
    d = F.col("l_discount")
    band = F.when(d == 0, "none").when(d < F.lit("0.05").cast("decimal(4,2)"), "low").otherwise("high")
    return t.lineitem.groupBy(band.alias("band")).agg(
        F.count("*").alias("items"), share_col(F.count_if(F.col("l_linestatus") == "F"), F.count("*")).alias("sell_through_pct")
    )


@query("markup_effect", f"WITH {SCORED} SELECT {dbl('pct')} AS markup_percent, count(*) AS items, {share('sum(CASE WHEN score > 60000000 THEN 1 ELSE 0 END)', 'count(*)')} AS sell_through_pct FROM scored GROUP BY pct")
def markup_effect(t):
    return scored_items(t).groupBy("markup_percent").agg(
        F.count("*").alias("items"), share_col(F.count_if("will_sell"), F.count("*")).alias("sell_through_pct")
    )


@query(
    "date_hierarchy",
    f"""SELECT CAST(y AS INTEGER) AS year, CAST(q AS INTEGER) AS quarter, CAST(m AS INTEGER) AS month, CAST(d AS INTEGER) AS day, count(*) AS sales, {dbl('sum(o_totalprice)')} AS revenue
    FROM (SELECT year(o_date) AS y, quarter(o_date) AS q, month(o_date) AS m, day(o_date) AS d, o_totalprice FROM {ORDERS}) GROUP BY ROLLUP (y, q, m, d)""",
)
def date_hierarchy(t):
    """Daily sums first, so the roll-up multiplies days instead of orders."""
    daily = t.orders.groupBy("o_date").agg(F.count("*").alias("n"), total("o_totalprice").alias("a"))
    levels = daily.select(F.year("o_date").alias("year"), F.quarter("o_date").alias("quarter"), F.month("o_date").alias("month"), F.dayofmonth("o_date").alias("day"), "n", "a")
    return levels.rollup("year", "quarter", "month", "day").agg(F.sum("n").alias("sales"), total("a").alias("revenue"))
