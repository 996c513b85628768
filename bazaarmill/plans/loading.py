"""Sources, sinks and loading."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..functions.dates import date_key
from ..functions.draws import draw as draw_col
from ..functions.money import TOTAL, total
from ..operators.calendar import YEAR_2024, calendar_for
from ..operators.keys import link_children, with_surrogate_key
from ..registry import query
from ..schemas import literal_dimension
from ..sources import sinks
from ..sources.tables import ALL_NAMES
from .sqltext import CAL_EVENTS, CUSTOMER, LINEITEM, ORDERS, PART, dbl, draw, key_of, txt


@query("scan_project", f"SELECT p_partkey, p_name, p_brand, {dbl('p_retailprice')} AS p_retailprice FROM {PART} ORDER BY p_partkey")
def scan_project(t):
    return t.part.select("p_partkey", "p_name", "p_brand", "p_retailprice").orderBy("p_partkey")


@query(
    "inline_values_dim",
    f"""SELECT v.size_id, v.size_name, v.min_size, v.max_size, count(p_partkey) AS parts
    FROM (VALUES (1, 'Small', 1, 15), (2, 'Medium', 16, 35), (3, 'Large', 36, 50)) v(size_id, size_name, min_size, max_size)
    LEFT JOIN {PART} p ON p.p_size BETWEEN v.min_size AND v.max_size GROUP BY ALL""",
)
def inline_values_dim(t):
    """Literal rows as a dimension, used at once: parts per size tier, counted before the tier lookup."""
    tiers = t.spark.createDataFrame(
        [(1, "Small", 1, 15), (2, "Medium", 16, 35), (3, "Large", 36, 50)],
        "size_id int, size_name string, min_size int, max_size int",
    )
    by_size = t.part.groupBy("p_size").agg(F.count("p_partkey").alias("n"))
    return (
        tiers.withColumn("p_size", F.explode(F.sequence("min_size", "max_size")))
        .join(by_size, "p_size", "left")
        .groupBy("size_id", "size_name", "min_size", "max_size")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("parts"))
    )


SALE_FACT = T.StructType(
    [
        T.StructField("sale_key", T.LongType(), False),
        T.StructField("sale_date_key", T.IntegerType(), False),
        T.StructField("total_amount", T.DecimalType(12, 2), False),
        T.StructField("payment_method", T.StringType(), False),
    ]
)


def sale_fact(orders):
    return orders.select(
        F.col("o_orderkey").alias("sale_key"),
        date_key("o_date").alias("sale_date_key"),
        F.col("o_totalprice").alias("total_amount"),
        F.element_at(
            F.create_map(F.lit("F"), F.lit("Cash"), F.lit("O"), F.lit("Transfer"), F.lit("P"), F.lit("POS")),
            F.col("o_orderstatus"),
        ).alias("payment_method"),
    )


@query(
    "insert_select_load",
    f"""SELECT o_orderkey AS sale_key, {key_of('o_date')} AS sale_date_key, {dbl('o_totalprice')} AS total_amount,
    CASE o_orderstatus WHEN 'F' THEN 'Cash' WHEN 'O' THEN 'Transfer' WHEN 'P' THEN 'POS' END AS payment_method FROM {ORDERS}""",
)
def insert_select_load(t):
    """Typed append of a query result into a fact, then the fact as stored."""
    path = sinks.run_folder(t.spark, "sale_fact")
    sinks.append_fact(sale_fact(t.orders), path, SALE_FACT)
    return t.spark.read.schema(SALE_FACT).parquet(path)


@query(
    "number_sequence",
    f"""SELECT n, count(*) AS rows_with_n, CAST(sum(l_partkey) AS BIGINT) AS part_sum
    FROM (SELECT unnest(generate_series(1, l_quantity)) AS n, l_partkey FROM {LINEITEM}) GROUP BY n""",
)
def number_sequence(t):
    """Numbers 1..quantity for each row, as a generator on the row: no number table, no cross join."""
    return (
        t.lineitem_spread.select(F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("l_quantity").cast("bigint"))).alias("n"), "l_partkey")
        .groupBy("n")
        .agg(F.count(F.lit(1)).alias("rows_with_n"), F.sum("l_partkey").alias("part_sum"))
    )


@query(
    "calendar_dim",
    f"""SELECT c.date_key, {txt('c.full_date')} AS full_date, CAST(c.year AS INTEGER) AS year, CAST(c.month AS INTEGER) AS month,
    c.month_name, CAST(c.quarter AS INTEGER) AS quarter, c.week_of_year, CAST(c.day_of_week AS INTEGER) AS day_of_week, c.day_name,
    c.is_weekend, c.is_open, c.is_peak, c.is_sale, CAST(c.fiscal_year AS INTEGER) AS fiscal_year,
    CAST(c.fiscal_month AS INTEGER) AS fiscal_month, coalesce(e.n, 0) AS postings
    FROM {CAL_EVENTS} c LEFT JOIN (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1) e ON e.d = c.full_date""",
)
def calendar_dim(t):
    """Calendar of the years in the postings, with the number of postings of each day."""
    cal = calendar_for(t.events, "ts", YEAR_2024)
    per_day = t.events.groupBy(F.col("e_date").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    return cal.join(per_day, "full_date", "left").withColumn("postings", F.coalesce("n", F.lit(0))).drop("n")


@query(
    "staged_pipeline",
    f"""WITH header AS (SELECT o_orderkey, o_totalprice FROM {ORDERS} WHERE o_orderstatus = 'F'),
    detail AS (SELECT l_orderkey, count(*) AS lines, sum(l_extendedprice) AS line_total FROM {LINEITEM} GROUP BY l_orderkey),
    joined AS (SELECT h.o_orderkey, h.o_totalprice, coalesce(d.lines, 0) AS lines, d.line_total FROM header h LEFT JOIN detail d ON d.l_orderkey = h.o_orderkey)
    SELECT lines, count(*) AS orders, {dbl('sum(o_totalprice)')} AS header_total, {dbl('coalesce(sum(line_total), 0)')} AS line_total
    FROM joined GROUP BY lines""",
)
def staged_pipeline(t):
    """Named stages in place of temporary tables; nothing is stored between them."""
    header = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    detail = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), total("l_extendedprice").alias("amount"))
    joined = header.join(detail, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn(
        "lines", F.coalesce("n", F.lit(0))
    )
    return joined.groupBy("lines").agg(
        F.count(F.lit(1)).alias("orders"),
        total("o_totalprice").alias("header_total"),
        F.coalesce(total("amount"), F.lit(0).cast(TOTAL)).alias("line_total"),
    )


@query(
    "surrogate_key",
    f"""SELECT row_number() OVER (ORDER BY p_type, p_brand) AS variant_key, p_type, p_brand, parts
    FROM (SELECT p_type, p_brand, count(*) AS parts FROM {PART} GROUP BY ALL)""",
)
def surrogate_key(t):
    variants = t.part.groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("parts"))
    return with_surrogate_key(variants, ["p_type", "p_brand"], "variant_key")


@query(
    "merge_id_map",
    f"""WITH headers AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_date, o_orderkey) AS sale_id FROM {ORDERS})
    SELECT l_row, sale_id FROM {LINEITEM} l LEFT JOIN headers h ON h.o_orderkey = l.l_orderkey""",
)
def merge_id_map(t):
    """New header keys in load order, carried to the child rows by the natural key."""
    headers = with_surrogate_key(t.orders.select("o_date", "o_orderkey"), ["o_date", "o_orderkey"], "sale_id")
    return link_children(t.lineitem.select("l_orderkey", "l_row"), headers, {"l_orderkey": "o_orderkey"}, "sale_id").drop(
        "l_orderkey"
    )


@query("explicit_key_insert", f"SELECT p_partkey AS part_id, p_name, count(*) OVER (PARTITION BY p_partkey) = 1 AS key_is_unique FROM {PART}")
def explicit_key_insert(t):
    """Rows keep the keys they came with; a repeated key is marked instead of renumbered."""
    uses = t.part.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("uses"))
    return t.part.join(uses, "p_partkey").select(
        F.col("p_partkey").alias("part_id"), "p_name", (F.col("uses") == 1).alias("key_is_unique")
    )


@query(
    "add_column_default",
    f"""SELECT p_partkey, 'Both' AS gender, 'Both' IN ('Male', 'Female', 'Both') AS gender_valid FROM {PART}""",
)
def add_column_default(t):
    return t.part.select("p_partkey", F.lit("Both").alias("gender")).withColumn(
        "gender_valid", F.col("gender").isin("Male", "Female", "Both")
    )


@query("full_refresh_overwrite", f"SELECT o_orderkey, {dbl('o_totalprice')} AS o_totalprice FROM {ORDERS}")
def full_refresh_overwrite(t):
    """A second load replaces the first one completely."""
    path = sinks.run_folder(t.spark, "refresh")
    cols = t.orders.select("o_orderkey", "o_totalprice")
    sinks.full_refresh(cols.filter("o_totalprice > 250000"), path)
    sinks.full_refresh(cols, path, cols.schema)
    return t.spark.read.parquet(path)


@query(
    "incremental_refresh",
    f"""SELECT CAST(year(o_date) * 100 + month(o_date) AS INTEGER) AS year_month, count(*) AS sales,
    {dbl('sum(o_totalprice)')} AS revenue FROM {ORDERS} GROUP BY ALL""",
)
def incremental_refresh(t):
    """History first, then two incremental runs of the whole source; the second must add nothing."""
    path = sinks.run_folder(t.spark, "incremental")
    rows = t.orders.select("o_orderkey", "o_date", "o_totalprice")
    cut = rows.agg(F.date_sub(F.max("o_date"), 365).alias("cut")).first()["cut"]
    rows.filter(F.col("o_date") <= F.lit(cut)).write.mode("append").parquet(path)
    for _ in range(2):
        sinks.incremental_append(rows, path, "o_orderkey", "o_date")
    stored = t.spark.read.parquet(path)
    return stored.groupBy((F.year("o_date") * 100 + F.month("o_date")).alias("year_month")).agg(
        F.count(F.lit(1)).alias("sales"), total("o_totalprice").alias("revenue")
    )


@query(
    "partitioned_fact",
    f"""SELECT CAST(year(l_date) AS INTEGER) AS ship_year, count(*) AS items, {dbl('sum(l_extendedprice)')} AS amount
    FROM {LINEITEM} WHERE year(l_date) >= (SELECT max(year(l_date)) - 2 FROM {LINEITEM}) GROUP BY 1""",
)
def partitioned_fact(t):
    """Fact stored by year; the report reads only the folders of the last three years."""
    path = sinks.run_folder(t.spark, "items_by_year")
    fact = t.lineitem.select("l_row", "l_extendedprice", F.year("l_date").alias("ship_year"))
    sinks.write_partitioned(fact, path, "ship_year")
    stored = t.spark.read.parquet(path)
    latest = stored.agg(F.max("ship_year").alias("y")).first()["y"]
    kept, _ = sinks.archive_before(stored, "ship_year", latest - 2)
    return kept.groupBy("ship_year").agg(F.count(F.lit(1)).alias("items"), total("l_extendedprice").alias("amount"))


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in ALL_NAMES) + " ORDER BY table_name",
)
def table_counts(t):
    counts = None
    for name in ALL_NAMES:
        one = t.raw(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts.orderBy("table_name")


# Allowed row counts, as (table, lowest, highest).
RANGES = [
    ("region", 5, 5), ("nation", 25, 25), ("customer", 100, None), ("supplier", 1, None), ("part", 100, None), ("orders", 1000, None),
    ("lineitem", 5000, None), ("events", 1000, None), ("documents", 200, None), ("embeddings", 500, None), ("pages", 50, None),
    ("benchmark", 40, None), ("labels", 50, None), ("conversations", 50, None),
]


@query(
    "expected_range_check",
    f"""WITH r(table_name, low, high) AS (VALUES {', '.join(f"('{n}', CAST({a} AS BIGINT), CAST({'NULL' if b is None else b} AS BIGINT))" for n, a, b in RANGES)}),
    c AS ({' UNION ALL '.join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in ALL_NAMES)})
    SELECT r.table_name, row_count, CASE WHEN row_count >= low AND row_count <= coalesce(high, row_count) THEN 'in range' ELSE 'OUT OF RANGE' END AS status
    FROM r JOIN c ON c.table_name = r.table_name""",
)
def expected_range_check(t):
    ranges = t.spark.createDataFrame(RANGES, "table_name string, low bigint, high bigint")
    ok = (F.col("row_count") >= F.col("low")) & (F.col("row_count") <= F.coalesce("high", "row_count"))
    return ranges.join(table_counts(t), "table_name").select(
        "table_name", "row_count", F.when(ok, "in range").otherwise("OUT OF RANGE").alias("status")
    )


@query(
    "literal_dimensions",
    f"""SELECT c_custkey, {draw('subcategory', 47, 'c_custkey')} + 1 AS subcategory_id FROM {CUSTOMER}""",
)
def literal_dimensions(t):
    """Customers looked up in the literal product variants: every draw finds its row in the dimension."""
    variants = literal_dimension(t.spark, "subcategories").select(F.col("subcategory_id").cast("bigint"))
    picks = t.customer.select("c_custkey", (draw_col("subcategory", 47, "c_custkey") + 1).alias("subcategory_id"))
    return picks.join(F.broadcast(variants), "subcategory_id").select("c_custkey", "subcategory_id")
