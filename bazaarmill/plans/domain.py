"""Domain operators bound to the source tables.

Roles: an order is a sale header, a line is a purchase or an item, a part is a product variant, a
customer is a loan, a supplier is a store, a user of the event log is a ledger entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import date_key, date_of
from ..functions.draws import draw as draw_col, draw_of, weighted_bucket
from ..functions.money import AMOUNT, TOTAL, UNIT, clamp, total
from ..operators import baskets, expenses, ledger, loans, pricing
from ..operators.calendar import EVERY_YEAR, YEAR_2024, calendar_for
from ..operators.picks import preferred_pick
from ..registry import query
from ..session import freeze
from ..sources.ledgerstore import LedgerStore
from ..sources.sinks import run_folder
from .sqltext import (
    CAL_EVENTS, CAL_ITEMS, CAL_ORDERS, CUSTOMER, EVENTS, LINEITEM, ORDERS, PART, SUPPLIER, cents_div, dbl, draw, key_of, txt,
)

CENTS = "CAST(l_extendedprice * 100 AS BIGINT)"


def money(cents: str) -> str:
    return f"({dbl(cents)} / 100)"


def year_calendar(t, table: str, column: str) -> DataFrame:
    """Calendar of the years of a table's dates, made and stored once for all plans that are built on ``t``."""
    made = t.__dict__.setdefault("_calendars", {})
    if (table, column) not in made:
        made[table, column] = freeze(calendar_for(getattr(t, table), column, EVERY_YEAR))
    return made[table, column]


# Draws and picks

SEGMENT_WEIGHTS = (("Tops", 25), ("Bottoms", 30), ("Outerwear", 15), ("Activewear", 20), ("Dresses", 10))


@query(
    "weighted_bucket",
    f"""WITH d AS (SELECT c_custkey, {draw('category', 100, 'c_custkey')} AS r, {draw('size', 100, 'c_custkey')} AS s FROM {CUSTOMER})
    SELECT c_custkey, CASE WHEN r < 25 THEN 'Tops' WHEN r < 55 THEN 'Bottoms' WHEN r < 70 THEN 'Outerwear' WHEN r < 90 THEN 'Activewear' ELSE 'Dresses' END AS category,
    CASE WHEN s < 25 THEN 1 WHEN s < 70 THEN 2 ELSE 3 END AS size_tier FROM d""",
)
def weighted_bucket_query(t):
    return t.customer.select(
        "c_custkey",
        weighted_bucket("category", SEGMENT_WEIGHTS, "c_custkey").alias("category"),
        weighted_bucket("size", ((1, 25), (2, 45), (3, 30)), "c_custkey").alias("size_tier"),
    )


@query(
    "preferred_pick",
    f"""WITH kids AS (SELECT p_type, p_brand, max(p_size) >= 49 AS fast FROM {PART} GROUP BY ALL),
    num AS (SELECT p_type, p_brand, CAST(fast AS INTEGER) AS f, row_number() OVER (PARTITION BY p_type, fast ORDER BY p_brand) - 1 AS i FROM kids
      UNION ALL SELECT p_type, p_brand, 2, row_number() OVER (PARTITION BY p_type ORDER BY p_brand) - 1 FROM kids),
    cnt AS (SELECT p_type, f, count(*) AS n FROM num GROUP BY ALL),
    want AS (SELECT o_orderkey, ['ECONOMY','STANDARD','LARGE','SMALL','MEDIUM','PROMO'][{draw('type', 6, 'o_orderkey')} + 1] AS p_type,
      CASE WHEN {draw('prefer', 100, 'o_orderkey')} < 60 THEN 1 ELSE 0 END AS w FROM {ORDERS}),
    asked AS (SELECT w.*, coalesce(c.n, 0) = 0 AS used_fallback FROM want w LEFT JOIN cnt c ON c.p_type = w.p_type AND c.f = w.w),
    a2 AS (SELECT o_orderkey, p_type, used_fallback, CASE WHEN used_fallback THEN 2 ELSE w END AS w2 FROM asked)
    SELECT o_orderkey, a2.p_type, num.p_brand AS picked, used_fallback FROM a2 JOIN cnt ON cnt.p_type = a2.p_type AND cnt.f = a2.w2
    JOIN num ON num.p_type = a2.p_type AND num.f = a2.w2 AND num.i = {draw('prefer-index', 'cnt.n', 'o_orderkey')}""",
)
def preferred_pick_query(t):
    children = t.part.groupBy("p_type", "p_brand").agg((F.max("p_size") >= 49).alias("fast"))
    types = F.array(*[F.lit(x) for x in ("ECONOMY", "STANDARD", "LARGE", "SMALL", "MEDIUM", "PROMO")])
    parents = t.orders_spread.select(
        "o_orderkey", F.element_at(types, (draw_col("type", 6, "o_orderkey") + 1).cast("int")).alias("p_type")
    )
    return preferred_pick(parents, children, "p_type", "o_orderkey", "p_brand", "fast")


# Calendar flags: every day of the posting years, with the postings of the day


def _posting_calendar(t) -> DataFrame:
    per_day = t.events.groupBy(F.col("e_date").alias("full_date")).agg(F.count("*").alias("n"), total("value").alias("v"))
    cal = calendar_for(t.events, "ts", YEAR_2024)
    return cal.join(per_day, "full_date", "left").withColumns({"postings": F.coalesce("n", F.lit(0)), "amount": F.coalesce("v", F.lit(0).cast("decimal(22,2)"))})


POSTING_CALENDAR = f"""(SELECT c.*, coalesce(e.n, 0) AS postings, coalesce(e.v, 0) AS amount FROM {CAL_EVENTS} c
  LEFT JOIN (SELECT e_date, count(*) AS n, sum(value) AS v FROM {EVENTS} GROUP BY 1) e ON e.e_date = c.full_date)"""


@query("open_day_calendar", f"SELECT date_key, day_name, is_open, postings FROM {POSTING_CALENDAR}")
def open_day_calendar(t):
    return _posting_calendar(t).select("date_key", "day_name", "is_open", "postings")


@query("peak_flag", f"SELECT date_key, is_peak, {dbl('amount')} AS amount FROM {POSTING_CALENDAR}")
def peak_flag(t):
    return _posting_calendar(t).select("date_key", "is_peak", "amount")


@query("sale_period_flag", f"SELECT {key_of('o_date')} AS date_key, is_sale, count(*) AS orders FROM {ORDERS} JOIN {CAL_ORDERS} c ON full_date = o_date GROUP BY ALL")
def sale_period_flag(t):
    cal = calendar_for(t.orders, "o_orderdate", EVERY_YEAR).select("full_date", "date_key", "is_sale")
    per_day = t.orders.groupBy("o_date").agg(F.count("*").alias("orders"))
    return per_day.join(cal, F.col("o_date") == F.col("full_date")).select("date_key", "is_sale", "orders")


# Cost allocation


@query(
    "trip_cost_allocation",
    f"SELECT l_row, {money(cents_div('1200000', 'count(*) OVER (PARTITION BY l_orderkey)'))} AS transport_cost FROM {LINEITEM}",
)
def trip_cost_allocation(t):
    out = pricing.allocate_cost(t.lineitem.select("l_orderkey", "l_row"), ["l_orderkey"], 12000, "transport_cost")
    return out.select("l_row", "transport_cost")


@query(
    "unit_cost",
    f"""WITH s AS (SELECT l_row, {CENTS} AS cents, l_quantity AS q, greatest((l_quantity * (65 + {draw('sellable', 26, 'l_row')})) // 100, 1) AS ok FROM {LINEITEM})
    SELECT l_row, CAST(ok AS INTEGER) AS sellable_items, CAST(q - ok AS INTEGER) AS unsellable_items, {money(cents_div('cents', 'ok'))} AS cost_per_item FROM s""",
)
def unit_cost_query(t):
    pct = ((draw_col("sellable", 26, "l_row") + 65).cast("decimal(4,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(5,2)")
    rows = t.lineitem_spread.select("l_row", "l_extendedprice", "l_quantity")
    return pricing.unit_cost(rows, "l_extendedprice", "l_quantity", pct).select(
        "l_row", "sellable_items", "unsellable_items", "cost_per_item"
    )


# Lowest factor in hundredths and the number of drawn steps, per label.
SIZE_FACTORS = {1: (70, 11), 2: (90, 21), 3: (120, 21)}
TYPE_FACTORS = {"ECONOMY": (85, 21), "STANDARD": (95, 21), "LARGE": (110, 21), "SMALL": (80, 21), "MEDIUM": (100, 21), "PROMO": (100, 21)}
QUARTER_FACTORS = {1: (90, 16), 2: (95, 16), 3: (105, 16), 4: (110, 16)}


def case(expr: str, values: dict, index: int) -> str:
    return "CASE " + expr + "".join(f" WHEN {repr(k)} THEN {v[index]}" for k, v in values.items()) + " END"


def factor_sql(salt: str, expr: str, values: dict) -> str:
    return f"({case(expr, values, 0)} + {draw(salt, case(expr, values, 1), 'l_row')})"


@query(
    "factor_cost",
    f"""WITH x AS (SELECT l_row, p_type, quarter(l_date) AS q, CASE WHEN p_size <= 15 THEN 1 WHEN p_size <= 35 THEN 2 ELSE 3 END AS tier
      FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey),
    c AS (SELECT l_row, 50 * {factor_sql('size-factor', 'tier', SIZE_FACTORS)} * {factor_sql('type-factor', 'p_type', TYPE_FACTORS)} * {factor_sql('season-factor', 'q', QUARTER_FACTORS)} AS cents FROM x)
    SELECT l_row, {money('least(greatest(cents, 35000000), 85000000)')} AS cost FROM c""",
)
def factor_cost_query(t):
    rows = t.lineitem_spread.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_row",
        "p_type",
        F.quarter("l_date").alias("q"),
        F.when(F.col("p_size") <= 15, 1).when(F.col("p_size") <= 35, 2).otherwise(3).alias("tier"),
    )
    factors = [
        pricing.stepped_factor("size-factor", "tier", SIZE_FACTORS, "l_row"),
        pricing.stepped_factor("type-factor", "p_type", TYPE_FACTORS, "l_row"),
        pricing.stepped_factor("season-factor", "q", QUARTER_FACTORS, "l_row"),
    ]
    return pricing.factor_cost(rows, 500000, factors, 350000, 850000).select("l_row", "cost")


@query(
    "unit_explosion",
    f"""WITH u AS (SELECT l_partkey, l_row, unnest(generate_series(1, l_quantity)) AS unit_no FROM {LINEITEM})
    SELECT l_partkey, count(*) AS units, count(*) FILTER ({draw('grade', 100, 'l_row', 'unit_no')} < 70) AS grade_1 FROM u GROUP BY 1""",
)
def unit_explosion(t):
    """Every unit gets its own grade; counted per product."""
    lines = t.lineitem_spread.select("l_partkey", F.concat("l_row", F.lit(":")).alias("line"), "l_quantity")
    units = pricing.explode_units(lines, "l_quantity")
    grade = draw_of(F.concat("line", F.col("unit_no").cast("string"), F.lit(":grade")), 100)  # draw("grade", 100, l_row, unit_no)
    return units.groupBy("l_partkey").agg(F.count("*").alias("units"), F.count_if(grade < 70).alias("grade_1"))


# Pricing and selling of items, as a chain of steps on the same rows

PRICED = f"""base AS (SELECT l_row, l_orderkey, l_date, p_type, p_size <= 20 AS fast, quarter(l_date) AS q, {cents_div(CENTS, 'l_quantity')} AS cost,
    {draw('grade', 100, 'l_row')} < 70 AND {draw('tier', 100, 'l_row')} < 15 AS is_top FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey),
  marked AS (SELECT *, CASE WHEN is_top THEN 50 ELSE 20 + {draw('markup', 11, 'l_row')} END AS pct FROM base),
  priced AS (SELECT *, {cents_div('cost * (100 + pct)', '100')} AS price FROM marked)"""
SCORED = f"""{PRICED}, scored AS (SELECT *, CASE WHEN fast THEN 95 ELSE 75 END * CASE q WHEN 1 THEN 85 WHEN 2 THEN 105 WHEN 3 THEN 120 ELSE 135 END
    * CASE WHEN price < 300000 THEN 155 WHEN price <= 600000 THEN 130 ELSE 110 END * (50 + {draw('sell', 50, 'l_row')}) AS score FROM priced)"""
DAYS_SQL = f"CASE WHEN fast THEN 5 + {draw('days-fast', 41, 'l_row')} ELSE 10 + {draw('days', 81, 'l_row')} END"
DATED = f"""{SCORED}, nxt AS (SELECT full_date AS f, min(CASE WHEN is_open THEN full_date END) OVER (ORDER BY full_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM {CAL_ITEMS}),
  dated AS (SELECT s.*, {DAYS_SQL} AS days, CASE WHEN n <= make_date(year(l_date), 12, 31) THEN n END AS sold_date
    FROM scored s LEFT JOIN nxt ON score > 60000000 AND f = CAST(l_date + CAST({DAYS_SQL} AS INTEGER) AS DATE)),
  lim AS (SELECT max(full_date) AS as_of, max(CASE WHEN is_sale THEN full_date END) AS last_sale FROM {CAL_ITEMS}),
  aged AS (SELECT d.*, date_diff('day', l_date, as_of) AS age, sold_date IS NULL AND date_diff('day', l_date, as_of) >= 90 AND l_date + 90 <= last_sale AS in_discount FROM dated d CROSS JOIN lim),
  disc AS (SELECT *, CASE WHEN NOT in_discount THEN NULL WHEN age >= 180 THEN 50 WHEN age >= 120 THEN 40 ELSE 25 END AS off FROM aged)"""


def priced_items(t) -> DataFrame:
    rows = t.lineitem_spread.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_row",
        "l_orderkey",
        "l_date",
        "p_type",
        (F.col("p_size") <= 20).alias("fast"),
        F.quarter("l_date").alias("q"),
        (F.col("l_extendedprice") / F.col("l_quantity").cast("decimal(10,0)")).cast(UNIT).alias("cost"),
    )
    top = (draw_col("grade", 100, "l_row") < 70) & (draw_col("tier", 100, "l_row") < 15)
    return pricing.markup(rows, "cost", top, 20, 30, 50, "l_row")


def hundredths(whens: list, otherwise: int):
    """Condition ladder of factors given in hundredths."""
    c = F
    for cond, v in whens:
        c = c.when(cond, F.lit(v))
    return c.otherwise(F.lit(otherwise)).cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)")


def scored_items(t) -> DataFrame:
    price, q = F.col("selling_price"), F.col("q")
    factors = [
        hundredths([(F.col("fast"), 95)], 75),
        hundredths([(q == 1, 85), (q == 2, 105), (q == 3, 120)], 135),
        hundredths([(price < 3000, 155), (price <= 6000, 130)], 110),
        (draw_col("sell", 50, "l_row") + 50).cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)"),
    ]
    return pricing.sell_score(priced_items(t), factors, "0.60")


def dated_items(t) -> DataFrame:
    cal = year_calendar(t, "lineitem", "l_shipdate")
    days = F.when(F.col("fast"), draw_col("days-fast", 41, "l_row") + 5).otherwise(draw_col("days", 81, "l_row") + 10)
    year_end = F.make_date(F.year("l_date"), F.lit(12), F.lit(31))
    return pricing.assign_sale_date(scored_items(t), "l_date", days, cal, "will_sell", year_end)


def discounted_items(t) -> DataFrame:
    cal = year_calendar(t, "lineitem", "l_shipdate")
    as_of = cal.agg(F.max("full_date")).scalar()
    last_sale = cal.filter("is_sale").agg(F.max("full_date")).scalar()
    return pricing.age_discount(
        dated_items(t), "l_date", "selling_price", "is_sold", ((90, 25), (120, 40), (180, 50)), as_of, last_sale
    )


@query("markup_price", f"WITH {PRICED} SELECT l_row, is_top AS is_top_tier, {dbl('pct')} AS markup_percent, {money('price')} AS selling_price FROM priced")
def markup_price(t):
    return priced_items(t).select("l_row", "is_top_tier", "markup_percent", "selling_price")


@query("sell_through_score", f"WITH {SCORED} SELECT l_row, {dbl('score')} / 100000000 AS score, score > 60000000 AS will_sell FROM scored")
def sell_through_score(t):
    return scored_items(t).select("l_row", "score", "will_sell")


@query("days_to_sale_date", f"WITH {DATED} SELECT l_row, {txt('sold_date')} AS sold_date, sold_date IS NOT NULL AS is_sold, CAST(CASE WHEN sold_date IS NOT NULL THEN days END AS INTEGER) AS days_in_inventory FROM dated")
def days_to_sale_date(t):
    return dated_items(t).select("l_row", "sold_date", "is_sold", "days_in_inventory")


@query(
    "age_discount",
    f"""WITH {DATED} SELECT l_row, in_discount AS is_in_discount, {dbl('off')} AS discount_percent,
    {money(cents_div('price * (100 - off)', '100'))} AS discounted_price FROM disc""",
)
def age_discount_query(t):
    return discounted_items(t).select("l_row", "is_in_discount", "discount_percent", "discounted_price")


@query("final_price", f"WITH {DATED} SELECT l_row, {money('CASE WHEN sold_date IS NOT NULL THEN price END')} AS final_price FROM disc")
def final_price_query(t):
    return pricing.final_price(discounted_items(t)).select("l_row", "final_price")


# Baskets: the orders of a day are its items

BASKETS = f"""it AS (SELECT o_orderkey, {key_of('o_date')} AS day, CAST(o_totalprice * 100 AS BIGINT) AS cents, o_orderpriority,
    row_number() OVER (PARTITION BY o_date ORDER BY o_orderkey) AS item_rank FROM {ORDERS}),
  cnt AS (SELECT day, count(*) AS n FROM it GROUP BY 1),
  ks AS (SELECT day, n, unnest(generate_series(1, n)) AS k FROM cnt),
  dr AS (SELECT *, {draw('basket-band', 100, 'day', 'k')} AS b, {draw('basket-size', 1000003, 'day', 'k')} AS s FROM ks),
  sz AS (SELECT *, CASE WHEN b < 45 THEN 1 WHEN b < 70 THEN 2 + s % 3 WHEN b < 85 THEN 5 + s % 4 WHEN b < 95 THEN 9 + s % 2 ELSE 11 + s % 40 END AS size FROM dr),
  cum AS (SELECT *, CAST(sum(size) OVER (PARTITION BY day ORDER BY k) AS BIGINT) AS e FROM sz),
  bk AS (SELECT day, k AS basket_no, e - size + 1 AS first_rank, least(e, n) AS last_rank FROM cum WHERE e - size + 1 <= n),
  pk AS (SELECT it.*, basket_no FROM it JOIN bk ON bk.day = it.day AND item_rank BETWEEN first_rank AND last_rank)"""


def day_items(t) -> DataFrame:
    final = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).otherwise(
        (F.col("o_totalprice") * F.lit("0.75").cast("decimal(3,2)")).cast(AMOUNT)
    )
    return t.orders.select("o_orderkey", date_key("o_date").alias("day"), "o_totalprice", final.alias("final"))


@query("basket_packing", f"WITH {BASKETS} SELECT o_orderkey, day, item_rank, basket_no FROM pk")
def basket_packing(t):
    return baskets.pack_baskets(day_items(t), "day", ["o_orderkey"]).select("o_orderkey", "day", "item_rank", "basket_no")


@query(
    "basket_totals",
    f"""WITH {BASKETS}, f AS (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN cents ELSE {cents_div('cents * 75', '100')} END AS fin FROM pk)
    SELECT day, basket_no, count(*) AS total_items, {money('sum(cents)')} AS subtotal, {money('sum(cents - fin)')} AS discount, {money('sum(fin)')} AS total FROM f GROUP BY ALL""",
)
def basket_totals_query(t):
    packed = baskets.pack_baskets(day_items(t), "day", ["o_orderkey"])
    return baskets.basket_totals(packed, "day", "o_totalprice", "final")


@query("range_join", f"WITH {BASKETS} SELECT o_orderkey, basket_no FROM pk")
def range_join(t):
    """Rank between first and last of the same day, as a bucketed range join."""
    items = day_items(t)
    ranked = baskets.rank_items(items.select("o_orderkey", "day"), "day", ["o_orderkey"])
    plan = baskets.plan_baskets(items.groupBy("day").agg(F.count("*").alias("n")), "day", "n")
    return baskets.join_ranges(ranked, plan, "day").select("o_orderkey", "basket_no")


@query("range_to_equi", f"WITH {BASKETS} SELECT o_orderkey, basket_no FROM pk")
def range_to_equi(t):
    """The same answer by opening each range to its ranks."""
    return baskets.pack_baskets(day_items(t).select("o_orderkey", "day"), "day", ["o_orderkey"]).select("o_orderkey", "basket_no")


# Loans: one per customer with orders, on the day of the first order

LOANS = f"""ln AS (SELECT c_custkey AS loan_id, loan_date, least(greatest(abs(CAST(c_acctbal * 100 AS BIGINT)) * 1000, 200000000), 800000000) AS principal,
    CASE WHEN {draw('months', 2, 'c_custkey')} = 0 THEN 6 ELSE 12 END AS months, 12 + {draw('rate', 7, 'c_custkey')} AS rate
    FROM {CUSTOMER} JOIN (SELECT o_custkey, min(o_date) AS loan_date FROM {ORDERS} GROUP BY 1) ON o_custkey = c_custkey),
  tm AS (SELECT *, {cents_div('principal * (1200 + rate * months)', '1200')} AS total FROM ln),
  terms AS (SELECT *, {cents_div('total', 'months')} AS monthly, total - principal AS interest FROM tm)"""
PAYMENTS = f"""{LOANS}, sch AS (SELECT *, unnest(generate_series(1, months)) AS k FROM terms),
  due AS (SELECT *, CAST(loan_date + to_months(CAST(k AS INTEGER)) AS DATE) AS due_date, {draw('status', 100, 'loan_id', 'k')} AS r FROM sch),
  pay AS (SELECT *, CASE WHEN r < 90 THEN 'OnTime' WHEN r < 97 THEN 'Late' ELSE 'Partial' END AS status,
    CASE WHEN r < 97 THEN monthly ELSE {cents_div("monthly * (80 + " + draw('status-part', 16, 'loan_id', 'k') + ")", '100')} END AS actual,
    CASE WHEN r >= 90 THEN 1 + {draw('status-late', 5, 'loan_id', 'k')} END AS late FROM due)"""
PROGRESS = f"""{PAYMENTS}, paid AS (SELECT loan_id, sum(actual) AS paid, count(*) AS n FROM pay WHERE due_date <= (SELECT max(o_date) FROM {ORDERS}) GROUP BY 1),
  prog AS (SELECT t.*, coalesce(paid, 0) AS paid, coalesce(n, 0) AS n, greatest(total - coalesce(paid, 0), 0) AS remaining FROM terms t LEFT JOIN paid USING (loan_id))"""


def loan_book(t) -> DataFrame:
    first = t.orders.groupBy("o_custkey").agg(F.min("o_date").alias("loan_date"))
    book = t.customer_spread.join(first, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("loan_id"),
        "loan_date",
        clamp(F.abs("c_acctbal") * 1000, 2000000, 8000000).cast(AMOUNT).alias("principal"),
        F.when(draw_col("months", 2, "c_custkey") == 0, 6).otherwise(12).alias("months"),
        (draw_col("rate", 7, "c_custkey") + 12).cast("decimal(5,2)").alias("rate"),
    )
    return loans.loan_terms(book, "principal", "rate", "months")


def loan_payments(t) -> DataFrame:
    return loans.payment_status(loans.repayment_schedule(loan_book(t), "loan_date", "months"), "loan_id", "monthly_repayment")


def loan_state(t) -> DataFrame:
    last = t.orders.agg(F.max("o_date")).scalar()
    return loans.loan_progress(loan_book(t), loan_payments(t), "loan_id", "total_repayment", "months", last)


@query(
    "loan_terms",
    f"""WITH {LOANS} SELECT loan_id, {key_of('loan_date')} AS loan_date_key, {money('principal')} AS principal, months, {dbl('rate')} AS rate,
    {money('total')} AS total_repayment, {money('monthly')} AS monthly_repayment, {money('interest')} AS interest_amount FROM terms""",
)
def loan_terms_query(t):
    return loan_book(t).withColumn("loan_date_key", date_key("loan_date")).drop("loan_date")


@query("repayment_schedule", f"WITH {PAYMENTS} SELECT loan_id, CAST(k AS INTEGER) AS installment, {key_of('due_date')} AS due_key, {money('monthly')} AS scheduled FROM pay")
def repayment_schedule_query(t):
    return loans.repayment_schedule(loan_book(t), "loan_date", "months").select(
        "loan_id", "installment", date_key("due_date").alias("due_key"), F.col("monthly_repayment").alias("scheduled")
    )


@query("payment_status", f"WITH {PAYMENTS} SELECT loan_id, CAST(k AS INTEGER) AS installment, status AS payment_status, {money('actual')} AS actual_amount, CAST(late AS INTEGER) AS days_late FROM pay")
def payment_status_query(t):
    return loan_payments(t).select("loan_id", "installment", "payment_status", "actual_amount", "days_late")


@query(
    "loan_progress",
    f"WITH {PROGRESS} SELECT loan_id, n AS payments_made, {money('paid')} AS repaid_to_date, {money('remaining')} AS remaining_balance, remaining * 2 <= months AS is_fully_repaid FROM prog",
)
def loan_progress_query(t):
    return loan_state(t).select("loan_id", "payments_made", "repaid_to_date", "remaining_balance", "is_fully_repaid")


# Expenses of stores

RECURRING = f"""(SELECT s_suppkey, c.date_key AS expense_date_key, v.category AS expense_category, v.text || ' - ' || c.month_name AS expense_description,
  v.low + {draw('recurring', 'v.spread', 's_suppkey', 'c.date_key', 'v.category')} AS amount, TRUE AS is_recurring, v.method AS payment_method FROM {SUPPLIER} s
  CROSS JOIN (VALUES ('Rent', 'Monthly shop rent', 1, 'Transfer', 150000, 1), ('Staff', 'Staff salaries (2 employees)', 25, 'Cash', 200000, 201000)) v(category, text, due_day, method, low, spread)
  JOIN {CAL_ORDERS} c ON c.is_open AND day(c.full_date) = v.due_day)"""
MONTHLY = f"""(SELECT s_suppkey, d.date_key AS expense_date_key, 'Utilities' AS expense_category, 'Electricity, water, internet - ' || d.month_name AS expense_description,
  CASE WHEN m.month BETWEEN 3 AND 9 THEN 50000 + {draw('utility-amount', 31000, 's_suppkey', 'm.year', 'm.month')} ELSE 30000 + {draw('utility-amount', 21000, 's_suppkey', 'm.year', 'm.month')} END AS amount,
  FALSE AS is_recurring, CASE WHEN {draw('utility-method', 100, 's_suppkey', 'm.year', 'm.month')} < 70 THEN 'Transfer' ELSE 'Cash' END AS payment_method
  FROM {SUPPLIER} s CROSS JOIN (SELECT year, month, count(*) AS n FROM {CAL_ORDERS} WHERE is_open AND day(full_date) BETWEEN 5 AND 10 GROUP BY ALL) m
  JOIN (SELECT year, month, date_key, month_name, row_number() OVER (PARTITION BY year, month ORDER BY full_date) - 1 AS i FROM {CAL_ORDERS} WHERE is_open AND day(full_date) BETWEEN 5 AND 10) d
  ON d.year = m.year AND d.month = m.month AND d.i = {draw('utility-day', 'm.n', 's_suppkey', 'm.year', 'm.month')})"""


def adhoc_sql(category: str, low: int, high: int, bands, cash: int) -> str:
    upto, labels, amounts = 0, "", ""
    for text, pct, a, spread in bands:
        upto += pct
        labels += f" WHEN r < {upto} THEN '{text}'"
        amounts += f" WHEN r < {upto} THEN {a} + {draw(category + '-amount', spread, 's_suppkey', 'j')}"
    return f"""(SELECT s_suppkey, date_key AS expense_date_key, '{category}' AS expense_category, CASE{labels} END AS expense_description, CASE{amounts} END AS amount,
      FALSE AS is_recurring, CASE WHEN {draw(category + '-method', 100, 's_suppkey', 'j')} < {cash} THEN 'Cash' ELSE 'Transfer' END AS payment_method
      FROM (SELECT *, {draw(category + '-band', 100, 's_suppkey', 'j')} AS r FROM (SELECT s_suppkey, unnest(generate_series(1, {low} + {draw(category + '-count', high - low + 1, 's_suppkey')})) AS j FROM {SUPPLIER})) p
      JOIN (SELECT date_key, row_number() OVER (ORDER BY full_date) - 1 AS i, count(*) OVER () AS n FROM {CAL_ORDERS} WHERE is_open) d
        ON d.i = {draw(category + '-day', f'(SELECT count(*) FROM {CAL_ORDERS} WHERE is_open)', 's_suppkey', 'j')})"""


ADHOC = f"""(SELECT * FROM {adhoc_sql('Transport', 30, 40, expenses.TRANSPORT_BANDS, 100)} UNION ALL SELECT * FROM {adhoc_sql('Other', 40, 60, expenses.OTHER_BANDS, 40)})"""
EXPENSES = f"(SELECT * FROM {RECURRING} UNION ALL SELECT * FROM {MONTHLY} UNION ALL SELECT * FROM {ADHOC})"


def expense_columns(src: str) -> str:
    return f"SELECT s_suppkey, expense_date_key, expense_category, expense_description, {dbl('amount')} AS amount, is_recurring, payment_method FROM {src}"


@query("recurring_expenses", expense_columns(RECURRING))
def recurring_expenses(t):
    return expenses.recurring_expenses(t.supplier_spread, "s_suppkey", year_calendar(t, "orders", "o_orderdate"))


@query("monthly_variable_expense", expense_columns(MONTHLY))
def monthly_variable_expense(t):
    return expenses.monthly_variable(t.supplier_spread, "s_suppkey", year_calendar(t, "orders", "o_orderdate"))


@query("adhoc_expenses", expense_columns(ADHOC))
def adhoc_expenses(t):
    cal = year_calendar(t, "orders", "o_orderdate")
    return expenses.adhoc_expenses(
        t.supplier_spread, "s_suppkey", cal, "Transport", (30, 40), expenses.TRANSPORT_BANDS, 100
    ).unionByName(expenses.adhoc_expenses(t.supplier_spread, "s_suppkey", cal, "Other", (40, 60), expenses.OTHER_BANDS, 40))


def store_expenses(t) -> DataFrame:
    return recurring_expenses(t).unionByName(monthly_variable_expense(t)).unionByName(adhoc_expenses(t))


# Movements of the whole business


def sales_by_day(t) -> DataFrame:
    return t.orders.groupBy(F.col("o_date").alias("day")).agg(total("o_totalprice").alias("amount"))


SALES_BY_DAY = f"(SELECT o_date AS day, sum(o_totalprice) AS amount FROM {ORDERS} GROUP BY 1)"
POSTING_SELECT = "SELECT {day} AS date_key, {no} AS process_order, '{account}' AS account, '{kind}' AS kind, {amount} AS amount, {src} AS source, {dst} AS destination, {text} AS description FROM {frm}"


def stream_sql(no, account, kind, amount, text, frm, src="NULL", dst="NULL", day="day") -> str:
    q = lambda x: x if x == "NULL" else f"'{x}'"
    return POSTING_SELECT.format(
        day=key_of(day), no=no, account=account, kind=kind, amount=amount, src=f"CAST({q(src)} AS VARCHAR)", dst=f"CAST({q(dst)} AS VARCHAR)", text=text, frm=frm
    )


def split_streams(frm: str) -> list[str]:
    ops, debts = dbl("CAST(amount * 0.70 AS DECIMAL(12,2))"), dbl("CAST(amount * 0.70 * 0.65 AS DECIMAL(12,2))")
    return [
        stream_sql(6, "Profits", "Deposit", dbl("amount"), "'Daily sales revenue'", frm),
        stream_sql(7, "Profits", "Transfer", ops, "'70% of daily sales to Operations'", frm, "Profits", "Operations"),
        stream_sql(7, "Operations", "Transfer", ops, "'Receive 70% from Profits'", frm, "Profits", "Operations"),
        stream_sql(8, "Operations", "Transfer", debts, "'65% of Operations inflow to Debts'", frm, "Operations", "Debts"),
        stream_sql(8, "Debts", "Transfer", debts, "'Receive 65% from Operations'", frm, "Operations", "Debts"),
    ]


def movement_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("date_key", date_key("day")).drop("day", "at", "posting_no")


@query("fund_split", " UNION ALL ".join(split_streams(SALES_BY_DAY)))
def fund_split(t):
    return movement_columns(ledger.fund_split(sales_by_day(t), [], "day", "amount"))


BELLS_BY_DAY = f"""(SELECT l_date AS day, sum(CASE WHEN funded < 60 THEN l_extendedprice ELSE 0 END) AS loan_cost, sum(CASE WHEN funded >= 60 THEN l_extendedprice ELSE 0 END) AS profit_cost,
  sum(trip) AS trip FROM (SELECT l_date, l_extendedprice, {draw('funding', 100, 'l_row')} AS funded, {cents_div('1200000', 'count(*) OVER (PARTITION BY l_orderkey)')} AS trip FROM {LINEITEM}) GROUP BY 1)"""
DAY_OF_KEY = "make_date(CAST(expense_date_key // 10000 AS BIGINT), CAST(expense_date_key // 100 % 100 AS BIGINT), CAST(expense_date_key % 100 AS BIGINT))"


@query(
    "movement_build",
    f"WITH {PAYMENTS} "
    + " UNION ALL ".join(
        [
            stream_sql(1, "Debts", "Deposit", money("principal"), "'Loan disbursement (Loan ID: ' || loan_id || ')'", "terms", day="loan_date"),
            stream_sql(2, "Debts", "Withdrawal", dbl("loan_cost"), "'Loan-funded bell purchases'", f"{BELLS_BY_DAY} WHERE loan_cost > 0"),
            stream_sql(3, "Operations", "Withdrawal", dbl("profit_cost"), "'Profit-funded bell purchases'", f"{BELLS_BY_DAY} WHERE profit_cost > 0"),
            stream_sql(4, "Operations", "Withdrawal", money("trip"), "'Transport costs'", BELLS_BY_DAY),
            stream_sql(5, "Operations", "Withdrawal", dbl("amount"), "'Daily expenses'", f"(SELECT {DAY_OF_KEY} AS day, sum(amount) AS amount FROM {EXPENSES} GROUP BY 1)"),
            *split_streams(SALES_BY_DAY),
            stream_sql(9, "Debts", "Withdrawal", money("amount"), "'Loan repayment'", "(SELECT due_date AS day, sum(actual) AS amount FROM pay GROUP BY 1)"),
        ]
    ),
)
def movement_build(t):
    """Eleven streams, each summed to the day before it becomes postings."""
    trips = pricing.allocate_cost(
        t.lineitem.select("l_orderkey", "l_date", "l_extendedprice", "l_row"), ["l_orderkey"], 12000, "trip"
    ).withColumn("by_loan", draw_col("funding", 100, "l_row") < 60)
    zero = F.lit(0).cast(AMOUNT)
    bells = trips.groupBy(F.col("l_date").alias("day")).agg(
        F.sum(F.when(F.col("by_loan"), F.col("l_extendedprice")).otherwise(zero)).alias("loan_cost"),
        F.sum(F.when(~F.col("by_loan"), F.col("l_extendedprice")).otherwise(zero)).alias("profit_cost"),
        F.sum("trip").alias("transport"),
    )
    spent = store_expenses(t).groupBy(date_of("expense_date_key").alias("day")).agg(F.sum("amount").alias("amount"))
    paid = loan_payments(t).groupBy(F.col("due_date").alias("day")).agg(F.sum("actual_amount").alias("amount"))
    lent = loan_book(t).select("loan_id", F.col("loan_date").alias("day"), F.col("principal").alias("amount"))
    return movement_columns(ledger.build_movements(sales_by_day(t), lent, bells, spent, paid))


# Ledger: one per user of the event log; opening amounts are small, like the event values

OPENING = {"Profits": "250.00", "Operations": "100.00"}
ROLES = {
    "purchase": ("Profits", "Deposit"),
    "signup": ("Debts", "Deposit"),
    "click": ("Operations", "Withdrawal"),
    "view": ("Debts", "Withdrawal"),
}
E_SQL = f"""ev AS (SELECT user_id, e_date AS day, ts, event_id, event_type, CAST(value * 100 AS BIGINT) AS c FROM {EVENTS}),
  mv AS (SELECT user_id, day, ts AS tm, event_id AS no, 5 AS po, 'Profits' AS account, 'Deposit' AS kind, c, 1 AS sign, 'Sale' AS text FROM ev WHERE event_type = 'purchase'
    UNION ALL SELECT user_id, day, ts, event_id, 5, 'Debts', 'Deposit', c, 1, 'Loan' FROM ev WHERE event_type = 'signup'
    UNION ALL SELECT user_id, day, ts, event_id, 5, 'Operations', 'Withdrawal', c, -1, 'Expense' FROM ev WHERE event_type = 'click'
    UNION ALL SELECT user_id, day, ts, event_id, 5, 'Debts', 'Withdrawal', c, -1, 'Repayment' FROM ev WHERE event_type = 'view'
    UNION ALL SELECT user_id, day, ts, event_id, 5, 'Operations', 'Transfer', c, -1, 'Debt funding' FROM ev WHERE event_type = 'error'
    UNION ALL SELECT user_id, day, ts, event_id, 5, 'Debts', 'Transfer', c, 1, 'Receive debt funding' FROM ev WHERE event_type = 'error'),
  op AS (SELECT user_id, CAST((SELECT min(day) FROM ev) - 1 AS DATE) AS day, NULL::TIMESTAMP AS tm, v.no, 0 AS po, v.account, 'Deposit' AS kind, v.c, 1 AS sign, 'Opening balance' AS text
    FROM (SELECT DISTINCT user_id FROM ev) CROSS JOIN (VALUES ('Profits', 0, 25000), ('Operations', 1, 10000)) v(account, no, c)),
  base AS (SELECT * FROM op UNION ALL SELECT * FROM mv)"""
CASCADE = f"""{E_SQL},
  net AS (SELECT user_id, day, sum(CASE WHEN account = 'Profits' THEN sign * c ELSE 0 END)::BIGINT AS p, sum(CASE WHEN account = 'Operations' THEN sign * c ELSE 0 END)::BIGINT AS o,
    sum(CASE WHEN account = 'Debts' THEN sign * c ELSE 0 END)::BIGINT AS d, row_number() OVER (PARTITION BY user_id ORDER BY day) AS i FROM base GROUP BY user_id, day),
  fold AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS i, NULL::DATE AS day, CAST(0 AS BIGINT) AS p, CAST(0 AS BIGINT) AS o, CAST(0 AS BIGINT) AS d, CAST(0 AS BIGINT) AS f0, CAST(0 AS BIGINT) AS f1 FROM net
    UNION ALL
    SELECT user_id, i, day, p - f1, o1 + f1, d + f0, f0, f1 FROM (SELECT *, CASE WHEN o1 < 0 THEN (-o1 * 110 + 50) // 100 + 100000 ELSE 0 END AS f1 FROM
      (SELECT *, o - f0 AS o1 FROM (SELECT *, CASE WHEN d < 0 THEN (-d * 110 + 50) // 100 + 100000 ELSE 0 END AS f0 FROM
        (SELECT n.user_id, n.i, n.day, f.p + n.p AS p, f.o + n.o AS o, f.d + n.d AS d FROM fold f JOIN net n ON n.user_id = f.user_id AND n.i = f.i + 1))))),
  fix AS (SELECT user_id, day, NULL::TIMESTAMP AS tm, CAST(s.no AS BIGINT) AS no, s.po, s.account, 'Transfer' AS kind, CASE WHEN s.step = 0 THEN f0 ELSE f1 END AS c, s.sign, s.text FROM fold
    CROSS JOIN (VALUES (0, 90, 0, 'Operations', -1, 'Deficit correction to Debts'), (0, 90, 1, 'Debts', 1, 'Receive deficit correction'),
      (1, 91, 2, 'Profits', -1, 'Deficit correction to Operations'), (1, 91, 3, 'Operations', 1, 'Receive deficit correction')) s(step, po, no, account, sign, text)
    WHERE CASE WHEN s.step = 0 THEN f0 ELSE f1 END > 0),
  led AS (SELECT * FROM base UNION ALL SELECT * FROM fix)"""


def event_postings(t) -> DataFrame:
    """Postings in one pass over the events; a transfer opens to its two sides."""
    e = F.col("event_type")

    def side(account: str, kind: str, text: str):
        moves = kind == "Transfer"
        return F.struct(
            F.lit(account).alias("account"),
            F.lit(kind).alias("kind"),
            (F.lit("Operations") if moves else F.lit(None).cast("string")).alias("source"),
            (F.lit("Debts") if moves else F.lit(None).cast("string")).alias("destination"),
            F.lit(text).alias("description"),
        )

    sides = (
        F.when(e == "purchase", F.array(side(*ROLES["purchase"], "Sale")))
        .when(e == "signup", F.array(side(*ROLES["signup"], "Loan")))
        .when(e == "click", F.array(side(*ROLES["click"], "Expense")))
        .when(e == "view", F.array(side(*ROLES["view"], "Repayment")))
        .when(e == "error", F.array(side("Operations", "Transfer", "Debt funding"), side("Debts", "Transfer", "Receive debt funding")))
    )
    return t.events.withColumn("_side", F.explode(sides)).select(
        "user_id",
        F.col("e_date").alias("day"),
        F.lit(5).alias("process_order"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("posting_no"),
        F.col("_side.account").alias("account"),
        F.col("_side.kind").alias("kind"),
        F.col("value").cast(TOTAL).alias("amount"),
        F.col("_side.source").alias("source"),
        F.col("_side.destination").alias("destination"),
        F.col("_side.description").alias("description"),
    )


def opening_postings(t) -> DataFrame:
    people = freeze(t.events.groupBy("user_id").agg(F.min("e_date").alias("first")))  # a row per user
    first = people.agg(F.date_sub(F.min("first"), 1)).scalar()
    return ledger.opening_balance(people, ["user_id"], first, OPENING)


def base_postings(t) -> DataFrame:
    """Opening and event postings as one stored table: the ledger uses them several times, and the events are read once for each kind."""
    return freeze(opening_postings(t).unionByName(event_postings(t)))


def full_ledger(t) -> DataFrame:
    base = base_postings(t)
    return base.unionByName(ledger.deficit_cascade(base, ["user_id"]))


@query("opening_balance", f"WITH {E_SQL} SELECT user_id, {key_of('day')} AS date_key, account, {money('c')} AS amount FROM op")
def opening_balance_query(t):
    return opening_postings(t).select("user_id", date_key("day").alias("date_key"), "account", "amount")


@query(
    "ledger_balance",
    f"""WITH RECURSIVE {CASCADE} SELECT user_id, {key_of('day')} AS date_key, po AS process_order, CAST(no AS BIGINT) AS posting_no, account, kind, {money('c')} AS amount, text AS description,
    {money('sum(sign * c) OVER (PARTITION BY user_id, account ORDER BY day, po, tm NULLS FIRST, no ROWS UNBOUNDED PRECEDING)')} AS balance FROM led""",
)
def ledger_balance(t):
    """All postings with the balance of their account, corrections included."""
    return ledger.running_balance(full_ledger(t), ["user_id"]).select(
        "user_id", date_key("day").alias("date_key"), "process_order", "posting_no", "account", "kind", "amount", "description", "balance"
    )


@query("deficit_cascade", f"WITH RECURSIVE {CASCADE} SELECT user_id, {key_of('day')} AS date_key, account, {money('c')} AS amount, text AS description FROM fix")
def deficit_cascade_query(t):
    return ledger.deficit_cascade(base_postings(t), ["user_id"]).select(
        "user_id", date_key("day").alias("date_key"), "account", "amount", "description"
    )


@query(
    "year_end_sweep",
    f"""WITH RECURSIVE {CASCADE}, fin AS (SELECT user_id, sum(CASE WHEN account = 'Debts' THEN sign * c ELSE 0 END) AS d, sum(CASE WHEN account = 'Operations' THEN sign * c ELSE 0 END) AS o FROM led GROUP BY 1)
    SELECT user_id, 'Debts' AS account, {money('d')} AS amount, 'Year-end sweep: Debts → Profits' AS description FROM fin WHERE d > 0
    UNION ALL SELECT user_id, 'Profits', {money('d')}, 'Year-end sweep: Receive from Debts' FROM fin WHERE d > 0
    UNION ALL SELECT user_id, 'Operations', {money('o - 50000')}, 'Year-end sweep: Operations excess → Profits' FROM fin WHERE o > 50000
    UNION ALL SELECT user_id, 'Profits', {money('o - 50000')}, 'Year-end sweep: Receive from Operations' FROM fin WHERE o > 50000""",
)
def year_end_sweep_query(t):
    """Balances at or before the last day of the year are swept; Operations keeps 500."""
    rows = full_ledger(t)
    last = calendar_for(t.events, "ts", YEAR_2024).agg(F.max("full_date")).scalar()
    return ledger.year_end_sweep(rows, ["user_id"], last, keep="500.00").select("user_id", "account", "amount", "description")


@query("ledger_resumed", f"WITH RECURSIVE {CASCADE} SELECT user_id, {key_of('day')} AS date_key, account, {money('c')} AS amount, text AS description FROM fix")
def ledger_resumed(t):
    """The corrections of a ledger that is continued: all loans come late, in a second batch, and one batch comes twice.

    The late batch folds again what follows its first day; the result is that of one fold over everything.
    """
    rows = base_postings(t)
    store = LedgerStore(t.spark, run_folder(t.spark, "ledger"), {"user_id": "bigint"})
    late = F.col("description") == "Loan"
    store.post(rows.filter(~late), "daily")
    store.post(rows.filter(late), "late loans")
    store.post(rows.filter(late), "late loans")
    return store.corrections().select("user_id", date_key("day").alias("date_key"), "account", "amount", "description")
