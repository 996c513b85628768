"""Loads that come again: changed rows, lasting keys, a sliding archive, keys and references held at the time of writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import ForeignKey, Unique
from ..registry import query
from ..sources import sinks
from ..sources.archive import SlidingArchive
from ..sources.guards import Guard, examine
from ..sources.registry import KeyRegistry
from ..sources.upsert import upsert
from .shapes import total
from .sqltext import LINEITEM, ORDERS, dbl

MONTH = "CAST(year(l_date) * 100 + month(l_date) AS INTEGER)"
SOLD_PRICE = "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(12,2))"


@query(
    "upsert_refresh",
    f"""SELECT l_row, added_month, is_sold, sale_price, version FROM (SELECT *, row_number() OVER (PARTITION BY l_row ORDER BY version DESC, added_month DESC, sale_price DESC NULLS LAST) AS nth
    FROM (SELECT l_row, {MONTH} AS added_month, l_linestatus = 'F' AS is_sold, CASE WHEN l_linestatus = 'F' THEN {dbl(SOLD_PRICE)} END AS sale_price,
      CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1 END AS version FROM {LINEITEM})) WHERE nth = 1""",
)
def upsert_refresh(t):
    """Items are loaded unsold, month by month; a later batch sells some, brings new ones and repeats stale versions of others.

    The batch is loaded twice; only the months it changes are written, and the second time none. A line that occurs twice is one item.
    """
    path = sinks.run_folder(t.spark, "items_upsert")
    month = (F.year("l_date") * 100 + F.month("l_date")).alias("added_month")
    none = F.lit(None).cast("decimal(12,2)")
    rows = t.lineitem.select("l_row", "l_date", "l_linestatus", "l_extendedprice", "l_discount", month)
    cut = rows.agg(F.date_sub(F.max("l_date"), 365).alias("cut")).first()["cut"]

    def state(df, version: int, sold: bool):
        price = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(12,2)") if sold else none
        return df.select("l_row", "added_month", F.lit(sold).alias("is_sold"), price.alias("sale_price"), F.lit(version).alias("version"))

    first = state(rows.filter(F.col("l_date") <= F.lit(cut)), 1, False)
    upsert(first, path, ["l_row"], "version", "added_month")
    sold = state(rows.filter("l_linestatus = 'F'"), 2, True)
    fresh = state(rows.filter(F.col("l_date") > F.lit(cut)), 1, False)
    stale = state(rows.filter("l_linestatus = 'F'"), 0, False)
    batch = sold.unionByName(fresh).unionByName(stale)
    for _ in range(2):
        upsert(batch, path, ["l_row"], "version", "added_month")
    return t.spark.read.schema(batch.schema).parquet(path)


@query(
    "key_registry_loads",
    f"""WITH k AS (SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END, o_date, o_orderkey) AS sale_id FROM {ORDERS})
    SELECT l_row, sale_id FROM {LINEITEM} l LEFT JOIN k ON k.o_orderkey = l.l_orderkey""",
)
def key_registry_loads(t):
    """Finished orders get their keys in a first load, all others in a second, none in a third; lines follow by the natural key."""
    registry = KeyRegistry(t.spark, sinks.run_folder(t.spark, "sale_keys"), ["o_orderkey"], "sale_id", "o_orderkey bigint")
    orders = t.orders.select("o_date", "o_orderkey", "o_orderstatus")
    registry.register(orders.filter("o_orderstatus = 'F'"), ["o_date"])
    registry.register(orders, ["o_date"])
    registry.register(orders, ["o_date"])
    return registry.attach(t.lineitem.select("l_orderkey", "l_row"), ["l_orderkey"]).drop("l_orderkey")


YEARS_KEPT = 2


@query(
    "sliding_archive",
    f"""WITH y AS (SELECT CAST(year(l_date) AS INTEGER) AS ship_year, count(*) AS items, {dbl('sum(l_extendedprice)')} AS amount FROM {LINEITEM} GROUP BY 1),
    m AS (SELECT max(ship_year) AS top FROM y)
    SELECT ship_year, CASE WHEN ship_year >= top - {YEARS_KEPT} OR ship_year = (SELECT min(ship_year) FROM y) THEN 'live' ELSE 'archive' END AS place, items, amount FROM y, m""",
)
def sliding_archive(t):
    """Items by year: all but the last three are archived, in two slides, and the first year is asked back."""
    live, away = sinks.run_folder(t.spark, "items_live"), sinks.run_folder(t.spark, "items_archive")
    fact = t.lineitem.select("l_row", "l_extendedprice", F.year("l_date").alias("ship_year"))
    sinks.write_partitioned(fact, live, "ship_year")
    store = SlidingArchive(t.spark, live, away, "ship_year", fact.schema)
    first, last = store.current().agg(F.min("ship_year"), F.max("ship_year")).first()
    store.slide(last - YEARS_KEPT - 1)
    store.slide(last - YEARS_KEPT)
    store.restore([first])

    def per_year(df, place: str):
        sums = df.groupBy("ship_year").agg(F.count("*").alias("items"), total("l_extendedprice").alias("amount"))
        return sums.select("ship_year", F.lit(place).alias("place"), "items", "amount")

    return per_year(store.current(), "live").unionByName(per_year(store.archived(), "archive"))


@query(
    "guarded_load",
    f"""WITH b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS nth,
      (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM {LINEITEM} WHERE l_returnflag = 'R') AS taken,
      l_orderkey IN (SELECT o_orderkey FROM {ORDERS} WHERE o_orderstatus <> 'P') AS known FROM {LINEITEM} WHERE l_returnflag <> 'R')
    SELECT l_row, concat_ws(',', CASE WHEN NOT known THEN 'line of a known order' END, CASE WHEN taken OR nth > 1 THEN 'line key' END) AS broken_rules FROM b""",
)
def guarded_load(t):
    """Lines are loaded next to returned ones: lines of unknown orders, line keys that are taken and line keys that come again are told apart.

    Rows that break no rule have an empty list.
    """
    key = Unique("line key", "lines", ("l_orderkey", "l_linenumber"))
    known = ForeignKey("line of a known order", "lines", "l_orderkey", "orders", "o_orderkey")
    guard = Guard([key], [known], {"orders": t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey")}, ["l_partkey", "l_suppkey"])
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_row", "l_returnflag")
    good, bad = examine(lines.filter("l_returnflag <> 'R'"), guard, lines.filter("l_returnflag = 'R'"))
    return good.select("l_row", F.lit("").alias("broken_rules")).unionByName(bad.select("l_row", F.array_join("broken_rules", ",").alias("broken_rules")))
