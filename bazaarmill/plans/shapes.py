"""Relational shapes: projection, filter, join, aggregation, window, sort, set and update forms."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.dates import date_key, date_of, day_name, month_name, us_week
from ..functions.draws import draw as draw_col
from ..functions.money import TOTAL, clamp, mean as mean_col, naira, share as share_col, total
from ..operators import ordered, skew
from ..operators.calendar import EVERY_YEAR, YEAR_2024, calendar_for, next_date
from ..registry import query
from ..session import partitions
from ..sources.cobuckets import CoBuckets
from ..sources.sinks import run_folder
from .sqltext import (
    CAL_EVENTS, CAL_ITEMS, CAL_ORDERS, CUSTOMER, DAYS, EVENTS, LINEITEM, MONTHS, ORDERS, PART, SUPPLIER,
    cents_div, dbl, draw, key_of, mean, share, txt,
)



# Projections, filters, predicates


@query("computed_projection", f"SELECT l_row, {dbl('l_extendedprice * (1 - l_discount)')} AS net, l_quantity * 2 - 1 AS odd FROM {LINEITEM}")
def computed_projection(t):
    return t.lineitem.select(
        "l_row", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), (F.col("l_quantity") * 2 - 1).alias("odd")
    )


@query("flag_filter", f"SELECT event_id, date_key FROM {EVENTS} JOIN {CAL_EVENTS} c ON full_date = e_date WHERE is_open")
def flag_filter(t):
    cal = calendar_for(t.events, "ts", YEAR_2024).filter("is_open").select("full_date", "date_key")
    return t.events.join(cal, F.col("e_date") == F.col("full_date")).select("event_id", "date_key")


@query("between_filter", f"SELECT o_orderkey, {dbl('o_totalprice')} AS o_totalprice FROM {ORDERS} WHERE o_orderkey BETWEEN 1000 AND 9000 AND o_totalprice BETWEEN 50000 AND 90000")
def between_filter(t):
    return t.orders.filter(F.col("o_orderkey").between(1000, 9000) & F.col("o_totalprice").between(50000, 90000)).select(
        "o_orderkey", "o_totalprice"
    )


@query("in_list_filter", f"SELECT o_orderkey FROM {ORDERS} WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')")
def in_list_filter(t):
    return t.orders.filter(
        F.col("o_orderstatus").isin("F", "O") & ~F.col("o_orderpriority").isin("5-LOW", "4-NOT SPECIFIED")
    ).select("o_orderkey")


@query(
    "null_predicates",
    f"""SELECT CAST(count(*) FILTER (l.k IS NULL) AS BIGINT) AS without_lines, CAST(count(*) FILTER (l.k IS NOT NULL) AS BIGINT) AS with_lines
    FROM {ORDERS} o LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM {LINEITEM}) l ON l.k = o.o_orderkey""",
)
def null_predicates(t):
    keys = t.lineitem.select("l_orderkey").distinct()
    return t.orders.join(keys, F.col("o_orderkey") == F.col("l_orderkey"), "left").agg(
        F.count_if(F.col("l_orderkey").isNull()).alias("without_lines"),
        F.count_if(F.col("l_orderkey").isNotNull()).alias("with_lines"),
    )


@query("or_violation_filter", f"SELECT l_row FROM {LINEITEM} WHERE l_quantity > 49 OR l_discount >= 0.10 OR l_extendedprice < 1000")
def or_violation_filter(t):
    return t.lineitem.filter("l_quantity > 49 OR l_discount >= 0.10 OR l_extendedprice < 1000").select("l_row")


@query("like_filter_ci", f"SELECT p_partkey, p_name FROM {PART} WHERE p_name ILIKE '%WIDGET%' AND p_name NOT ILIKE 'Red%'")
def like_filter_ci(t):
    return t.part.filter(F.col("p_name").ilike("%WIDGET%") & ~F.col("p_name").ilike("Red%")).select("p_partkey", "p_name")


@query("date_part_filter", f"SELECT o_orderkey, {key_of('o_date')} AS date_key FROM {ORDERS} WHERE year(o_date) = 1997 AND month(o_date) = 3 AND day(o_date) BETWEEN 5 AND 10")
def date_part_filter(t):
    """The month is a range on the stored column, so it reaches the scan; only the day is computed."""
    month = (F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit("1997-03-01 00:00:00"))) & (
        F.col("o_orderdate") < F.to_timestamp_ntz(F.lit("1997-04-01 00:00:00"))
    )
    return t.orders.filter(month & F.dayofmonth("o_date").between(5, 10)).select(
        "o_orderkey", date_key("o_date").alias("date_key")
    )


@query(
    "searched_case",
    f"""SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'medium'
    WHEN o_orderpriority = '1-URGENT' THEN 'large urgent' ELSE 'large' END AS band FROM {ORDERS}""",
)
def searched_case(t):
    p = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.when(p < 50000, "small")
        .when(p < 200000, "medium")
        .when(F.col("o_orderpriority") == "1-URGENT", "large urgent")
        .otherwise("large")
        .alias("band"),
    )


@query(
    "simple_case_lookup",
    f"""SELECT p_partkey, {dbl("CASE p_type WHEN 'ECONOMY' THEN 0.85 WHEN 'STANDARD' THEN 0.95 WHEN 'LARGE' THEN 1.10 WHEN 'SMALL' THEN 0.80 WHEN 'MEDIUM' THEN 1.00 END")} AS factor FROM {PART}""",
)
def simple_case_lookup(t):
    factors = {"ECONOMY": "0.85", "STANDARD": "0.95", "LARGE": "1.10", "SMALL": "0.80", "MEDIUM": "1.00"}
    lookup = F.create_map(*[x for k, v in factors.items() for x in (F.lit(k), F.lit(v).cast("decimal(5,2)"))])
    return t.part.select("p_partkey", F.try_element_at(lookup, F.col("p_type")).alias("factor"))


@query(
    "nested_case",
    f"""WITH busy AS (SELECT DISTINCT l_orderkey FROM {LINEITEM} WHERE l_returnflag = 'R')
    SELECT l_row, CASE WHEN l_quantity >= 40 THEN CASE WHEN b.l_orderkey IS NOT NULL THEN 'big, order has returns' ELSE 'big' END
      ELSE 'normal' END AS label FROM {LINEITEM} l LEFT JOIN busy b ON b.l_orderkey = l.l_orderkey""",
)
def nested_case(t):
    """Existence inside a condition becomes a flag per order, so only one row per order is joined back."""
    flags = t.lineitem.groupBy("l_orderkey").agg(
        F.max(F.col("l_returnflag") == "R").alias("has_return"), F.count("*").alias("n")
    )
    rows = skew.attach(t.lineitem.select("l_orderkey", "l_row", "l_quantity"), flags, ["l_orderkey"], "n")
    big = F.when(F.col("has_return"), "big, order has returns").otherwise("big")
    return rows.select("l_row", F.when(F.col("l_quantity") >= 40, big).otherwise("normal").alias("label"))


@query("clamp", f"SELECT l_row, {dbl('least(greatest(l_extendedprice, 3000), 60000)')} AS bounded FROM {LINEITEM}")
def clamp_price(t):
    return t.lineitem.select("l_row", clamp("l_extendedprice", 3000, 60000).cast("decimal(12,2)").alias("bounded"))


@query("distinct_rows", f"SELECT DISTINCT {key_of('o_date')} AS date_key FROM {ORDERS}")
def distinct_rows(t):
    return t.orders.select(date_key("o_date").alias("date_key")).distinct()


@query("literal_label_column", f"SELECT 'Total orders' AS metric, count(*) AS n, '0 expected' AS note FROM {ORDERS} WHERE o_totalprice <= 0")
def literal_label_column(t):
    return t.orders.filter("o_totalprice <= 0").agg(F.count("*").alias("n")).select(
        F.lit("Total orders").alias("metric"), "n", F.lit("0 expected").alias("note")
    )


# Joins and subqueries. Sides that grow with the data carry no broadcast hint: the optimizer
# broadcasts them while their size is under spark.sql.autoBroadcastJoinThreshold and shuffles beyond.


@query("fact_dim_join", f"SELECT l_row, p_type, p_brand FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey")
def fact_dim_join(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_row", "p_type", "p_brand")


@query(
    "multi_dim_join",
    f"""SELECT l_row, p_type, s_name, n_name FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey
    JOIN {SUPPLIER} s ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
)
def multi_dim_join(t):
    sup = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_row", "p_type", "s_name", "n_name")
    )


@query("snowflake_join", f"SELECT c_custkey, n_name, r_name FROM {CUSTOMER} JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def snowflake_join(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query(
    "left_join_agg",
    f"""SELECT o_orderkey, count(l_orderkey) AS lines, {dbl('sum(l_extendedprice)')} AS line_total
    FROM {ORDERS} LEFT JOIN {LINEITEM} l ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def left_join_agg(t):
    """Details are summed before the join: one row per order crosses it instead of all lines."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), total("l_extendedprice").alias("line_total"))
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.coalesce("n", F.lit(0)).alias("lines"), "line_total"
    )


@query("header_detail_join", f"SELECT l_row, o_orderstatus, {dbl('o_totalprice')} AS o_totalprice FROM {ORDERS} JOIN {LINEITEM} l ON l_orderkey = o_orderkey")
def header_detail_join(t):
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select("l_row", "o_orderstatus", "o_totalprice")


@query(
    "header_detail_bucketed",
    f"""SELECT o_orderkey, o_orderstatus, count(*) AS lines, {dbl('sum(l_extendedprice)')} AS line_total, {dbl('max(o_totalprice)')} AS o_totalprice
    FROM {ORDERS} JOIN {LINEITEM} l ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def header_detail_bucketed(t):
    """Orders and lines stored in the same buckets: join and sums per order read bucket by bucket, without a shuffle."""
    pair = CoBuckets(t.spark, run_folder(t.spark, "order_buckets"), {"l_orderkey": "o_orderkey"}, partitions(t.spark))
    pair.write(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), t.lineitem.select("l_orderkey", "l_extendedprice"))
    sums = [F.count("*").alias("lines"), total("l_extendedprice").alias("line_total"), F.max("o_totalprice").alias("o_totalprice")]
    # a key is either hot or not, so both parts of the join can be summed for themselves
    return reduce(DataFrame.unionByName, [part.groupBy("o_orderkey", "o_orderstatus").agg(*sums) for part in pair.parts()])


@query(
    "cross_join_bounded",
    f"""SELECT l_partkey, count(*) AS units, CAST(sum(n) AS BIGINT) AS unit_no_sum
    FROM (SELECT l_partkey, unnest(generate_series(1, l_quantity)) AS n FROM {LINEITEM}) GROUP BY l_partkey""",
)
def cross_join_bounded(t):
    units = t.lineitem_spread.select("l_partkey", F.explode(F.sequence(F.lit(1), "l_quantity")).alias("n"))
    return units.groupBy("l_partkey").agg(F.count("*").alias("units"), F.sum("n").alias("unit_no_sum"))


@query(
    "cross_join_calendar",
    f"""SELECT s_suppkey, c.date_key, v.kind FROM {SUPPLIER} s
    CROSS JOIN (VALUES ('Rent', 1), ('Staff', 25)) v(kind, due_day)
    JOIN {CAL_ORDERS} c ON day(c.full_date) = v.due_day AND c.is_open AND c.year = (SELECT max(year(o_date)) FROM {ORDERS})""",
)
def cross_join_calendar(t):
    """Templates meet the calendar by day of month and stores meet it by month: two equi-joins."""
    cal = calendar_for(t.orders, "o_orderdate", EVERY_YEAR)
    last_year = t.orders.agg(F.year(F.max("o_date"))).scalar()
    templates = t.spark.createDataFrame([("Rent", 1), ("Staff", 25)], "kind string, due_day int")
    due = (
        cal.filter(F.col("is_open") & (F.col("year") == last_year))
        .join(F.broadcast(templates), F.dayofmonth("full_date") == F.col("due_day"))
        .select("month", "date_key", "kind")
    )
    stores = t.supplier.select("s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return stores.join(F.broadcast(due), "month").select("s_suppkey", "date_key", "kind")


@query(
    "composite_key_join",
    f"""WITH g AS (SELECT l_partkey, l_returnflag, l_linestatus, l_quantity, l_discount, count(*) AS same_key FROM {LINEITEM} GROUP BY ALL)
    SELECT l_row, same_key FROM {LINEITEM} l JOIN g USING (l_partkey, l_returnflag, l_linestatus, l_quantity, l_discount)""",
)
def composite_key_join(t):
    """Five-column join to one row per key, so no row is multiplied and none matches by chance."""
    keys = ["l_partkey", "l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    per_key = t.lineitem.groupBy(*keys).agg(F.count("*").alias("same_key"))
    return skew.attach(t.lineitem.select("l_row", *keys), per_key, keys, "same_key").select("l_row", "same_key")


@query(
    "forward_asof",
    f"""WITH c AS (SELECT full_date, min(CASE WHEN is_open THEN full_date END) OVER (ORDER BY full_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM {CAL_ORDERS})
    SELECT o_orderkey, {txt('n')} AS next_open FROM {ORDERS} LEFT JOIN c ON full_date = o_date""",
)
def forward_asof(t):
    cal = calendar_for(t.orders, "o_orderdate", EVERY_YEAR)
    return next_date(t.orders.select("o_orderkey", "o_date"), "o_date", cal, name="next_open").select("o_orderkey", "next_open")


SELL_DAY = draw("days", 81, "l_row")
NEXT_OPEN_ITEMS = f"(SELECT full_date AS f, min(CASE WHEN is_open THEN full_date END) OVER (ORDER BY full_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM {CAL_ITEMS})"


@query(
    "forward_asof_bounded",
    f"""SELECT l_row, {txt('CASE WHEN n <= make_date(year(l_date), 12, 31) THEN n END')} AS sold_on
    FROM {LINEITEM} l LEFT JOIN {NEXT_OPEN_ITEMS} c ON f = CAST(l_date + CAST(10 + {SELL_DAY} AS INTEGER) AS DATE)""",
)
def forward_asof_bounded(t):
    """Days past the end of the year of arrival find no match: the item stays unsold."""
    cal = calendar_for(t.lineitem, "l_shipdate", EVERY_YEAR)
    rows = t.lineitem.select("l_row", "l_date").withColumn(
        "ready", F.date_add("l_date", (draw_col("days", 81, "l_row") + 10).cast("int"))
    )
    year_end = F.make_date(F.year("l_date"), F.lit(12), F.lit(31))
    return next_date(rows, "ready", cal, name="sold_on", upper=year_end).select("l_row", "sold_on")


@query("cross_apply_expr", f"SELECT l_row, {dbl('CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DECIMAL(12,2))')} AS charge, l_extendedprice * (1 - l_discount) > 50000 AS large FROM {LINEITEM}")
def cross_apply_expr(t):
    named = t.lineitem.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return named.select(
        "l_row", (F.col("net") * (1 + F.col("l_tax"))).cast("decimal(12,2)").alias("charge"), (F.col("net") > 50000).alias("large")
    )


@query("correlated_scalar", f"SELECT c_custkey, {dbl(f'(SELECT max(o_totalprice) FROM {ORDERS} o WHERE o.o_custkey = c.c_custkey)')} AS best FROM {CUSTOMER} c")
def correlated_scalar(t):
    best = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("best"))
    return t.customer.join(best, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "best")


TAIL = Decimal(10**19)  # above any 64-bit key


def ranked(rank, key: str):
    """A rank and, for ties, a key of 64 bits as one decimal number, which hash aggregates can hold."""
    return (rank.cast("decimal(18,0)") * F.lit(TAIL) + F.col(key).cast("decimal(19,0)")).cast("decimal(38,0)")


@query(
    "top1_per_key_pick",
    f"""SELECT p_type, p_partkey FROM (SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type
    ORDER BY {draw('pick', 1000003, 'p_partkey')}, p_partkey) AS r FROM {PART}) WHERE r = 1""",
)
def top1_per_key_pick(t):
    """Smallest draw per key as one number with the key in its last digits: a hash aggregate with partial results."""
    best = F.min(ranked(draw_col("pick", 1000003, "p_partkey"), "p_partkey")).alias("best")
    return t.part.groupBy("p_type").agg(best).select("p_type", (F.col("best") % F.lit(TAIL)).cast("bigint").alias("p_partkey"))


@query("exists_semi", f"SELECT o_orderkey FROM {ORDERS} o WHERE EXISTS (SELECT 1 FROM {LINEITEM} l WHERE l.l_orderkey = o.o_orderkey AND l_quantity = 50)")
def exists_semi(t):
    return t.orders.join(
        t.lineitem.filter("l_quantity = 50").select("l_orderkey").distinct(), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"
    ).select("o_orderkey")


@query("not_exists_anti", f"SELECT o_orderkey FROM {ORDERS} o WHERE NOT EXISTS (SELECT 1 FROM {LINEITEM} l WHERE l.l_orderkey = o.o_orderkey)")
def not_exists_anti(t):
    # keys are made distinct first: a key with many lines is one row when it is moved
    keys = t.lineitem.select("l_orderkey").distinct()
    return t.orders.join(keys, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("uncorrelated_scalar", f"SELECT o_orderkey FROM {ORDERS} WHERE o_totalprice > (SELECT min(o_totalprice) + (max(o_totalprice) - min(o_totalprice)) * 0.9 FROM {ORDERS})")
def uncorrelated_scalar(t):
    low, high = F.min("o_totalprice"), F.max("o_totalprice")
    bar = t.orders.agg(low + (high - low) * F.lit("0.9").cast("decimal(2,1)")).scalar()
    return t.orders.filter(F.col("o_totalprice") > bar).select("o_orderkey")


@query("in_subquery", f"SELECT l_row FROM {LINEITEM} WHERE l_partkey IN (SELECT p_partkey FROM {PART} WHERE p_type = 'PROMO')")
def in_subquery(t):
    return t.lineitem.join(t.part.filter("p_type = 'PROMO'"), F.col("l_partkey") == F.col("p_partkey"), "left_semi").select("l_row")


@query("derived_table", f"SELECT orders, count(*) AS customers FROM (SELECT o_custkey, count(*) AS orders FROM {ORDERS} GROUP BY 1) GROUP BY orders")
def derived_table(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders")).groupBy("orders").agg(F.count("*").alias("customers"))


@query(
    "cte_chain",
    f"""WITH daily AS (SELECT o_date, sum(o_totalprice) AS amount FROM {ORDERS} GROUP BY 1),
    monthly AS (SELECT year(o_date) * 100 + month(o_date) AS ym, count(*) AS days, max(amount) AS best FROM daily GROUP BY 1)
    SELECT CAST(ym AS INTEGER) AS year_month, days, {dbl('best')} AS best_day FROM monthly WHERE days >= 28""",
)
def cte_chain(t):
    daily = t.orders.groupBy("o_date").agg(total("o_totalprice").alias("amount"))
    monthly = daily.groupBy((F.year("o_date") * 100 + F.month("o_date")).alias("year_month")).agg(
        F.count("*").alias("days"), F.max("amount").alias("best_day")
    )
    return monthly.filter("days >= 28")


@query(
    "range_exists",
    f"""WITH c AS (SELECT full_date FROM {CAL_ITEMS} WHERE is_sale)
    SELECT l_row, EXISTS (SELECT 1 FROM c WHERE c.full_date >= CAST(l_date + 90 AS DATE)) AS can_discount FROM {LINEITEM}""",
)
def range_exists(t):
    """"Is there a sale day after day 90" compares with one precomputed day, without a range join."""
    last_sale = calendar_for(t.lineitem, "l_shipdate", EVERY_YEAR).filter("is_sale").agg(F.max("full_date")).scalar()
    return t.lineitem.select(
        "l_row", F.coalesce(F.date_add("l_date", 90) <= last_sale, F.lit(False)).alias("can_discount")
    )


@query(
    "fallback_fill",
    f"""SELECT p_type, p_brand, coalesce(min(p_partkey) FILTER (p_size >= 45), min(p_partkey)) AS pick,
    count(*) FILTER (p_size >= 45) = 0 AS used_fallback FROM {PART} GROUP BY ALL""",
)
def fallback_fill(t):
    first = F.min(F.when(F.col("p_size") >= 45, F.col("p_partkey")))
    return t.part.groupBy("p_type", "p_brand").agg(
        F.coalesce(first, F.min("p_partkey")).alias("pick"), first.isNull().alias("used_fallback")
    )


# Aggregations


@query("count_filtered", f"SELECT count(*) AS n FROM {ORDERS} WHERE o_orderstatus = 'P'")
def count_filtered(t):
    return t.orders.filter("o_orderstatus = 'P'").agg(F.count("*").alias("n"))


@query(
    "group_basic",
    f"""SELECT p_type, count(*) AS n, {dbl('min(l_extendedprice)')} AS low, {dbl('max(l_extendedprice)')} AS high, {mean('l_extendedprice')} AS average
    FROM {LINEITEM} JOIN {PART} p ON p_partkey = l_partkey GROUP BY p_type""",
)
def group_basic(t):
    """Lines are reduced to one row per part before the lookup: a part in demand is combined map-side."""
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.count("*").alias("c"),
        F.min("l_extendedprice").alias("lo"),
        F.max("l_extendedprice").alias("hi"),
        total("l_extendedprice").alias("amount"),
    )
    return per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(
        F.sum("c").alias("n"),
        F.min("lo").alias("low"),
        F.max("hi").alias("high"),
        (F.sum("amount").cast("double") / F.sum("c")).alias("average"),
    )


@query(
    "conditional_sum",
    f"""SELECT CAST(year(o_date) AS INTEGER) AS year, {dbl("sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END)")} AS filled,
    CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS urgent FROM {ORDERS} GROUP BY 1""",
)
def conditional_sum(t):
    return t.orders.groupBy(F.year("o_date").alias("year")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0)).cast(TOTAL).alias("filled"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )


@query("count_distinct", f"SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_date) AS days FROM {ORDERS} GROUP BY 1")
def count_distinct(t):
    return t.orders.groupBy("o_orderstatus").agg(
        F.countDistinct("o_custkey").alias("customers"), F.countDistinct("o_date").alias("days")
    )


@query(
    "group_by_expression",
    f"""SELECT CASE WHEN l_quantity = 1 THEN '1' WHEN l_quantity <= 10 THEN '2-10' ELSE '11+' END AS band, count(*) AS n,
    {dbl('sum(l_extendedprice)')} AS amount FROM {LINEITEM} GROUP BY 1""",
)
def group_by_expression(t):
    q = F.col("l_quantity")
    band = F.when(q == 1, "1").when(q <= 10, "2-10").otherwise("11+")
    return t.lineitem.groupBy(band.alias("band")).agg(F.count("*").alias("n"), total("l_extendedprice").alias("amount"))


@query(
    "having_filter",
    f"""SELECT o_orderkey, {dbl('sum(l_extendedprice)')} AS line_total FROM {ORDERS} JOIN {LINEITEM} l ON l_orderkey = o_orderkey
    GROUP BY o_orderkey, o_totalprice HAVING sum(l_extendedprice) > o_totalprice AND count(*) >= 3""",
)
def having_filter(t):
    lines = (
        t.lineitem.groupBy("l_orderkey")
        .agg(total("l_extendedprice").alias("line_total"), F.count("*").alias("n"))
        .filter("n >= 3")
    )
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).filter("line_total > o_totalprice").select(
        "o_orderkey", "line_total"
    )


@query("global_agg", f"SELECT count(*) AS n, {dbl('sum(o_totalprice)')} AS amount, {mean('o_totalprice')} AS average, {dbl('min(o_totalprice)')} AS low, {dbl('max(o_totalprice)')} AS high FROM {ORDERS}")
def global_agg(t):
    return t.orders.agg(
        F.count("*").alias("n"),
        total("o_totalprice").alias("amount"),
        mean_col("o_totalprice").alias("average"),
        F.min("o_totalprice").alias("low"),
        F.max("o_totalprice").alias("high"),
    )


@query("share_of_total_window", f"WITH g AS (SELECT o_orderpriority, count(*) AS n FROM {ORDERS} GROUP BY 1) SELECT o_orderpriority, n, {share('n', 'sum(n) OVER ()')} AS pct FROM g")
def share_of_total_window(t):
    """The window runs over the few aggregated rows, not over the table."""
    g = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return g.withColumn("pct", share_col("n", F.sum("n").over(W.partitionBy())))


@query("share_of_total_subquery", f"SELECT o_orderstatus, count(*) AS n, {share('count(*)', f'(SELECT count(*) FROM {ORDERS})')} AS pct FROM {ORDERS} GROUP BY 1")
def share_of_total_subquery(t):
    g = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    whole = g.agg(F.sum("n")).scalar()  # the counts add up to the table: no second scan
    return g.select("o_orderstatus", "n", share_col("n", whole).alias("pct"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "pivot_conditional_max",
    "SELECT user_id, " + ", ".join(dbl(f"max(CASE WHEN event_type = '{e}' THEN value ELSE 0 END)") + f" AS max_{e}" for e in EVENT_TYPES) + f" FROM {EVENTS} GROUP BY 1",
)
def pivot_conditional_max(t):
    return t.events.groupBy("user_id").agg(
        *[F.max(F.when(F.col("event_type") == e, F.col("value")).otherwise(0)).alias(f"max_{e}") for e in EVENT_TYPES]
    )


@query(
    "min_max_period",
    f"""SELECT CAST(c.month AS INTEGER) AS month, {txt('min(c.full_date)')} AS first_day, {txt('max(c.full_date)')} AS last_day, count(DISTINCT c.full_date) AS days,
    count(o_orderkey) AS orders FROM {CAL_ORDERS} c LEFT JOIN {ORDERS} o ON o_date = c.full_date WHERE c.is_sale GROUP BY 1""",
)
def min_max_period(t):
    """Orders are counted per day before they meet the calendar."""
    per_day = t.orders.groupBy("o_date").agg(F.count("*").alias("n"))
    cal = calendar_for(t.orders, "o_orderdate", EVERY_YEAR).filter("is_sale")
    return cal.join(per_day, F.col("full_date") == F.col("o_date"), "left").groupBy("month").agg(
        F.min("full_date").alias("first_day"),
        F.max("full_date").alias("last_day"),
        F.count("*").alias("days"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orders"),
    )


@query("daily_rollup", f"SELECT {key_of('o_date')} AS date_key, count(*) AS sales, {dbl('sum(o_totalprice)')} AS revenue FROM {ORDERS} GROUP BY 1")
def daily_rollup(t):
    return t.orders.groupBy(date_key("o_date").alias("date_key")).agg(F.count("*").alias("sales"), total("o_totalprice").alias("revenue"))


@query("group_order_by_agg", f"SELECT o_custkey, count(*) AS n, {dbl('sum(o_totalprice)')} AS amount FROM {ORDERS} GROUP BY 1 ORDER BY sum(o_totalprice) DESC, o_custkey")
def group_order_by_agg(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(F.count("*").alias("n"), total("o_totalprice").alias("amount"))
        .orderBy(F.desc("amount"), "o_custkey")
    )


@query("avg_ratio_scaled", f"SELECT l_returnflag, {mean('l_discount')} * 100 AS avg_discount_pct FROM {LINEITEM} GROUP BY 1")
def avg_ratio_scaled(t):
    return t.lineitem.groupBy("l_returnflag").agg((mean_col("l_discount") * 100).alias("avg_discount_pct"))


# Windows


@query("row_number_global", f"SELECT o_orderkey, row_number() OVER (ORDER BY o_date, o_orderkey) AS n FROM {ORDERS}")
def row_number_global(t):
    return ordered.row_numbers(t.orders.select("o_date", "o_orderkey"), [], ["o_date", "o_orderkey"], "n").select("o_orderkey", "n")


@query("row_number_partition", f"SELECT o_orderkey, row_number() OVER (PARTITION BY o_date ORDER BY o_totalprice DESC, o_orderkey) AS day_rank FROM {ORDERS}")
def row_number_partition(t):
    rows = t.orders.select("o_orderkey", "o_date", (-F.col("o_totalprice")).alias("down"))
    return ordered.row_numbers(rows, ["o_date"], ["down", "o_orderkey"], "day_rank").select("o_orderkey", "day_rank")


@query("last_row_per_group", f"SELECT user_id, event_id, {dbl('value')} AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM {EVENTS}) WHERE r = 1")
def last_row_per_group(t):
    """Latest row per key as a hash aggregate with map-side combine: time and id are one number."""
    when = ranked(F.unix_micros(F.col("ts").cast("timestamp")), "event_id")
    return t.events.groupBy("user_id").agg(F.max_by("event_id", when).alias("event_id"), F.max_by("value", when).alias("value"))


@query(
    "pick_one_per_group",
    f"""SELECT CAST(ym AS INTEGER) AS year_month, {txt('o_date')} AS day FROM (SELECT ym, o_date, row_number() OVER (PARTITION BY ym ORDER BY r, o_date) AS n FROM
    (SELECT DISTINCT o_date, year(o_date) * 100 + month(o_date) AS ym, {draw('month-day', 1000003, 'o_date')} AS r FROM {ORDERS} WHERE day(o_date) BETWEEN 5 AND 10)) WHERE n = 1""",
)
def pick_one_per_group(t):
    days = t.orders.filter(F.dayofmonth("o_date").between(5, 10))
    # draw and day as one number; days are counted from the first date that there is
    number = draw_col("month-day", 1000003, "o_date") * 10_000_000 + F.datediff("o_date", F.lit("0001-01-01").cast("date"))
    picked = days.groupBy((F.year("o_date") * 100 + F.month("o_date")).alias("year_month")).agg(F.min(number).alias("best"))
    return picked.select("year_month", F.date_add(F.lit("0001-01-01").cast("date"), (F.col("best") % 10_000_000).cast("int")).alias("day"))


SIGNED = "CASE WHEN event_type IN ('purchase', 'signup') THEN value ELSE -value END"


def signed_value():
    return F.when(F.col("event_type").isin("purchase", "signup"), F.col("value")).otherwise(-F.col("value"))


@query(
    "end_of_day_balance",
    f"""SELECT user_id, {key_of('e_date')} AS date_key, {dbl('balance')} AS balance FROM (SELECT user_id, e_date, sum(net) OVER (PARTITION BY user_id ORDER BY e_date) AS balance
    FROM (SELECT user_id, e_date, sum({SIGNED}) AS net FROM {EVENTS} GROUP BY ALL))""",
)
def end_of_day_balance(t):
    """Last balance of the day: daily nets first, then a window over days only."""
    daily = t.events.groupBy("user_id", "e_date").agg(F.sum(signed_value()).cast(TOTAL).alias("net"))
    w = W.partitionBy("user_id").orderBy("e_date").rowsBetween(W.unboundedPreceding, 0)
    return daily.select("user_id", date_key("e_date").alias("date_key"), F.sum("net").over(w).cast(TOTAL).alias("balance"))


@query("running_balance", f"SELECT event_id, {dbl(f'sum({SIGNED}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)')} AS balance FROM {EVENTS}")
def running_balance(t):
    rows = t.events.select("user_id", "ts", "event_id", signed_value().alias("signed"))
    out = ordered.running(rows, ["user_id"], ["ts", "event_id"], {"balance": F.col("signed")})
    return out.select("event_id", F.col("balance").cast(TOTAL).alias("balance"))


@query("window_total", f"WITH g AS (SELECT year(o_date) AS y, sum(o_totalprice) AS amount FROM {ORDERS} GROUP BY 1) SELECT CAST(y AS INTEGER) AS year, {dbl('amount')} AS amount, {dbl('sum(amount) OVER ()')} AS all_years FROM g")
def window_total(t):
    g = t.orders.groupBy(F.year("o_date").alias("year")).agg(total("o_totalprice").alias("amount"))
    return g.withColumn("all_years", F.sum("amount").over(W.partitionBy()).cast("decimal(38,2)"))


# Sort and top-k


@query("order_multi_key", f"SELECT l_row, l_returnflag, l_linestatus, {dbl('l_extendedprice')} AS l_extendedprice FROM {LINEITEM} ORDER BY l_returnflag, l_linestatus DESC, l_extendedprice DESC, l_row")
def order_multi_key(t):
    return t.lineitem.select("l_row", "l_returnflag", "l_linestatus", "l_extendedprice").orderBy(
        "l_returnflag", F.desc("l_linestatus"), F.desc("l_extendedprice"), "l_row"
    )


@query("order_by_case", f"SELECT o_orderstatus, count(*) AS n FROM {ORDERS} GROUP BY 1 ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END")
def order_by_case(t):
    s = F.col("o_orderstatus")
    return t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")).orderBy(F.when(s == "P", 1).when(s == "O", 2).otherwise(3))


@query("top_n", f"SELECT l_row, {dbl('l_extendedprice')} AS l_extendedprice FROM {LINEITEM} ORDER BY l_extendedprice DESC, l_row LIMIT 20")
def top_n(t):
    return t.lineitem.select("l_row", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_row").limit(20)


@query("top_n_random_sample", f"SELECT o_orderkey FROM {ORDERS} ORDER BY md5(o_orderkey || ':sample'), o_orderkey LIMIT 30")
def top_n_random_sample(t):
    """Ordered by the whole digest, so no two keys tie."""
    return t.orders.select("o_orderkey").orderBy(F.md5(F.concat_ws(":", F.col("o_orderkey").cast("string"), F.lit("sample"))), "o_orderkey").limit(30)


# Set operations


@query(
    "union_all_metrics",
    f"""SELECT 'orders' AS metric, count(*) AS n FROM {ORDERS} UNION ALL SELECT 'filled', count(*) FROM {ORDERS} WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'urgent', count(*) FROM {ORDERS} WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT 'large', count(*) FROM {ORDERS} WHERE o_totalprice > 400000""",
)
def union_all_metrics(t):
    """All metrics in one scan, then turned from columns to rows."""
    one = t.orders.agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("filled"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.count_if(F.col("o_totalprice") > 400000).alias("large"),
    )
    return one.unpivot([], ["orders", "filled", "urgent", "large"], "metric", "n")


@query(
    "union_all_movements",
    f"""WITH d AS (SELECT {key_of('o_date')} AS date_key, sum(o_totalprice) AS amount FROM {ORDERS} GROUP BY 1)
    SELECT date_key, 'Profits' AS account, 'Deposit' AS kind, {dbl('amount')} AS amount, 6 AS process_order FROM d
    UNION ALL SELECT date_key, 'Profits', 'Transfer', {dbl('CAST(amount * 0.70 AS DECIMAL(22,2))')}, 7 FROM d
    UNION ALL SELECT date_key, 'Operations', 'Transfer', {dbl('CAST(amount * 0.70 AS DECIMAL(22,2))')}, 7 FROM d
    UNION ALL SELECT {key_of('l_date')}, 'Operations', 'Withdrawal', {dbl('sum(l_extendedprice)')}, 2 FROM {LINEITEM} GROUP BY 1""",
)
def union_all_movements(t):
    d = t.orders.groupBy(date_key("o_date").alias("date_key")).agg(total("o_totalprice").alias("amount"))
    b = t.lineitem.groupBy(date_key("l_date").alias("date_key")).agg(total("l_extendedprice").alias("amount"))
    part70 = (F.col("amount") * F.lit("0.70").cast("decimal(3,2)")).cast(TOTAL)

    def stream(df, account, kind, amount, order):
        return df.select(
            "date_key", F.lit(account).alias("account"), F.lit(kind).alias("kind"), amount.alias("amount"), F.lit(order).alias("process_order")
        )

    return (
        stream(d, "Profits", "Deposit", F.col("amount"), 6)
        .unionByName(stream(d, "Profits", "Transfer", part70, 7))
        .unionByName(stream(d, "Operations", "Transfer", part70, 7))
        .unionByName(stream(b, "Operations", "Withdrawal", F.col("amount"), 2))
    )


# Scalar functions


@query("date_key_encode", f"SELECT o_orderkey, {key_of('o_date')} AS date_key FROM {ORDERS}")
def date_key_encode(t):
    return t.orders.select("o_orderkey", date_key("o_date").alias("date_key"))


@query("date_key_decode", f"SELECT o_orderkey, {txt('o_date')} AS day FROM {ORDERS}")
def date_key_decode(t):
    keyed = t.orders.select("o_orderkey", date_key("o_date").alias("date_key"))
    return keyed.select("o_orderkey", date_of("date_key").alias("day"))


@query(
    "date_parts",
    f"""SELECT o_orderkey, CAST(year(o_date) AS INTEGER) AS year, CAST(month(o_date) AS INTEGER) AS month, CAST(day(o_date) AS INTEGER) AS day,
    CAST(quarter(o_date) AS INTEGER) AS quarter, CAST((dayofyear(o_date) + dayofweek(date_trunc('year', o_date)) + 6) // 7 AS INTEGER) AS week,
    CAST(dayofweek(o_date) + 1 AS INTEGER) AS weekday, {MONTHS}[month(o_date)] AS month_name, {DAYS}[dayofweek(o_date) + 1] AS day_name FROM {ORDERS}""",
)
def date_parts(t):
    d = F.col("o_date")
    return t.orders.select(
        "o_orderkey",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        us_week(d).alias("week"),
        F.dayofweek(d).alias("weekday"),
        month_name(d).alias("month_name"),
        day_name(d).alias("day_name"),
    )


@query(
    "date_add_diff",
    f"""SELECT o_orderkey, {txt('CAST(o_date + 90 AS DATE)')} AS plus_90_days, {txt('CAST(o_date + INTERVAL 1 MONTH AS DATE)')} AS plus_1_month,
    CAST(date_diff('day', o_date, DATE '2001-12-31') AS INTEGER) AS days_left FROM {ORDERS}""",
)
def date_add_diff(t):
    return t.orders.select(
        "o_orderkey",
        F.date_add("o_date", 90).alias("plus_90_days"),
        F.add_months("o_date", 1).alias("plus_1_month"),
        F.datediff(F.lit("2001-12-31").cast("date"), "o_date").alias("days_left"),
    )


@query("date_from_parts", f"SELECT o_orderkey, {txt('make_date(year(o_date), month(o_date), 8)')} AS eighth FROM {ORDERS}")
def date_from_parts(t):
    return t.orders.select("o_orderkey", F.make_date(F.year("o_date"), F.month("o_date"), F.lit(8)).alias("eighth"))


HOUR, MINUTE, SECOND = (draw(s, m, "o_orderkey") for s, m in (("hour", 12), ("minute", 60), ("second", 60)))


@query(
    "datetime_compose",
    f"""SELECT o_orderkey, {txt(f"make_timestamp(CAST(year(o_date) AS BIGINT), CAST(month(o_date) AS BIGINT), CAST(day(o_date) AS BIGINT), 9 + {HOUR}, {MINUTE}, CAST({SECOND} AS DOUBLE))")} AS sold_at FROM {ORDERS}""",
)
def datetime_compose(t):
    h, m, s = draw_col("hour", 12, "o_orderkey") + 9, draw_col("minute", 60, "o_orderkey"), draw_col("second", 60, "o_orderkey")
    at = F.make_timestamp_ntz(F.year("o_date"), F.month("o_date"), F.dayofmonth("o_date"), h.cast("int"), m.cast("int"), s.cast("decimal(16,6)"))
    return t.orders.select("o_orderkey", at.alias("sold_at"))


@query(
    "abs_mod_round",
    f"""SELECT l_row, {dbl('abs(l_extendedprice - 30000)')} AS distance, l_partkey % 7 AS bucket,
    {dbl('CAST(l_extendedprice AS DECIMAL(12,0))')} AS rounded FROM {LINEITEM}""",
)
def abs_mod_round(t):
    return t.lineitem.select(
        "l_row",
        F.abs(F.col("l_extendedprice") - 30000).alias("distance"),
        (F.col("l_partkey") % 7).alias("bucket"),
        F.round("l_extendedprice", 0).alias("rounded"),
    )


@query(
    "null_guard_divide",
    f"""SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)::BIGINT AS returned,
    CAST(sum(l_quantity) AS DOUBLE) / nullif(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 0) AS ratio FROM {LINEITEM} GROUP BY 1""",
)
def null_guard_divide(t):
    back = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0))
    return t.lineitem.groupBy("l_orderkey").agg(
        back.alias("returned"), (F.sum("l_quantity").cast("double") / F.nullif(back, F.lit(0).cast("bigint"))).alias("ratio")
    )


@query(
    "decimal_cast_round",
    f"""SELECT l_row, {dbl('CAST(l_extendedprice * l_discount AS DECIMAL(12,2))')} AS half_up, CAST(trunc(l_extendedprice * l_discount) AS INTEGER) AS cut,
    {dbl(cents_div('CAST(l_extendedprice * 100 AS BIGINT)', 'l_quantity'))} / 100 AS per_unit FROM {LINEITEM}""",
)
def decimal_cast_round(t):
    x = F.col("l_extendedprice") * F.col("l_discount")
    return t.lineitem.select(
        "l_row",
        x.cast("decimal(12,2)").alias("half_up"),
        x.cast("int").alias("cut"),
        (F.col("l_extendedprice") / F.col("l_quantity").cast("decimal(10,0)")).cast("decimal(12,2)").alias("per_unit"),
    )


@query("string_concat", f"SELECT o_orderkey, 'Order ' || CAST(o_orderkey AS VARCHAR) || ' - ' || {MONTHS}[month(o_date)] AS label FROM {ORDERS}")
def string_concat(t):
    return t.orders.select(
        "o_orderkey", F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" - "), month_name("o_date")).alias("label")
    )


@query(
    "currency_format",
    f"""SELECT o_orderkey, '₦' || format('{{:,}}', CAST(trunc(o_totalprice) AS BIGINT)) || '.' || lpad(CAST(CAST(o_totalprice * 100 AS BIGINT) % 100 AS VARCHAR), 2, '0') AS shown FROM {ORDERS}""",
)
def currency_format(t):
    return t.orders.select("o_orderkey", naira("o_totalprice").alias("shown"))


@query("coalesce_price", f"SELECT l_row, {dbl('coalesce(CASE WHEN l_discount >= 0.05 THEN CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(12,2)) END, l_extendedprice)')} AS price FROM {LINEITEM}")
def coalesce_price(t):
    lower = F.when(F.col("l_discount") >= 0.05, (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(12,2)"))
    return t.lineitem.select("l_row", F.coalesce(lower, "l_extendedprice").alias("price"))


# Update forms


@query("update_column", f"SELECT l_row, {dbl('CAST(l_extendedprice * 1.25 AS DECIMAL(12,2))')} AS l_extendedprice FROM {LINEITEM}")
def update_column(t):
    raised = (F.col("l_extendedprice") * F.lit("1.25").cast("decimal(3,2)")).cast("decimal(12,2)")
    return t.lineitem.withColumn("l_extendedprice", raised).select("l_row", "l_extendedprice")


@query("update_where", f"SELECT l_row, CASE WHEN l_quantity < 5 THEN 'R' ELSE l_returnflag END AS l_returnflag FROM {LINEITEM}")
def update_where(t):
    return t.lineitem.withColumn(
        "l_returnflag", F.when(F.col("l_quantity") < 5, "R").otherwise(F.col("l_returnflag"))
    ).select("l_row", "l_returnflag")


@query(
    "update_from_join",
    f"""SELECT o_orderkey, {dbl('coalesce(l.line_total, o_totalprice)')} AS o_totalprice FROM {ORDERS} LEFT JOIN
    (SELECT l_orderkey, sum(l_extendedprice) AS line_total FROM {LINEITEM} GROUP BY 1) l ON l.l_orderkey = o_orderkey""",
)
def update_from_join(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(total("l_extendedprice").alias("line_total"))
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.coalesce("line_total", "o_totalprice").alias("o_totalprice")
    )


@query(
    "two_phase_update",
    f"""SELECT l_row, sellable, l_quantity - sellable AS unsellable FROM (SELECT l_row, l_quantity,
    CAST(greatest(trunc(l_quantity * (0.65 + l_discount)), 1) AS INTEGER) AS sellable FROM {LINEITEM})""",
)
def two_phase_update(t):
    """The second column reads the new value of the first."""
    share_ok = F.lit("0.65").cast("decimal(4,2)") + F.col("l_discount")
    return (
        t.lineitem.withColumn("sellable", F.greatest((F.col("l_quantity").cast("decimal(10,0)") * share_ok).cast("int"), F.lit(1)))
        .withColumn("unsellable", F.col("l_quantity") - F.col("sellable"))
        .select("l_row", "sellable", "unsellable")
    )
