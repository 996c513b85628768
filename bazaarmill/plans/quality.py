"""Data-quality queries over the source tables."""

from __future__ import annotations

from functools import reduce
from math import lcm

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.dates import date_key
from ..functions.money import TOTAL, share as share_col, total
from ..operators.quality import (
    CHI_SQUARE_95, Check, ForeignKey, NotNull, Rule, Unique, dq_report, duplicates, goodness_of_fit, row_violations, split_valid,
)
from ..registry import query
from .shapes import SIGNED, end_of_day_balance
from .sqltext import EVENTS, LINEITEM, ORDERS, PART, dbl, key_of, share

VIEWS = {"orders": ORDERS, "lineitem": LINEITEM, "part": PART, "events": EVENTS}

FOREIGN_KEYS = [
    ForeignKey("lineitem.order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ForeignKey("lineitem.part", "lineitem", "l_partkey", "part", "p_partkey"),
    ForeignKey("lineitem.supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ForeignKey("orders.customer", "orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey("orders.lines", "orders", "o_orderkey", "lineitem", "l_orderkey"),
    ForeignKey("customer.nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ForeignKey("supplier.nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ForeignKey("nation.region", "nation", "n_regionkey", "region", "r_regionkey"),
    ForeignKey("events.customer", "events", "user_id", "customer", "c_custkey"),
]
UNIQUES = [
    Unique("orders key", "orders", ("o_orderkey",)),
    Unique("part key", "part", ("p_partkey",)),
    Unique("events key", "events", ("event_id",)),
    Unique("lineitem order+line", "lineitem", ("l_orderkey", "l_linenumber")),
]
NOT_NULLS = [NotNull(f"orders.{c} is set", "orders", c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")]
RANGES = [
    Check("quantity range", "lineitem", "l_quantity BETWEEN 1 AND 45"),
    Check("price positive", "lineitem", "l_extendedprice > 0"),
    Check("discount range", "lineitem", "l_discount >= 0 AND l_discount <= 0.08"),
    Check("tax range", "lineitem", "l_tax >= 0 AND l_tax <= 0.08"),
    Check("line number", "lineitem", "l_linenumber BETWEEN 1 AND 6"),
]
DOMAINS = [
    Check("status", "orders", "o_orderstatus IN ('F', 'O')"),
    Check("priority", "orders", "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"),
]
STATES = [
    Check("returned implies discount", "lineitem", "NOT (l_returnflag = 'R') OR l_discount > 0"),
    Check("open implies no full tax", "lineitem", "NOT (l_linestatus = 'O') OR l_tax < 0.08"),
]


def counts_sql(rules: list[Rule]) -> str:
    """(rule, table_name, violations) for each rule."""
    parts = []
    for r in rules:
        head = f"SELECT '{r.name}' AS rule, '{r.table}' AS table_name, "
        src = VIEWS.get(r.table, r.table)
        if isinstance(r, Check):
            parts.append(f"{head} count(*) FILTER (({r.condition}) IS FALSE) AS violations FROM {src}")
        elif isinstance(r, NotNull):
            parts.append(f"{head} count(*) FILTER ({r.column} IS NULL) AS violations FROM {src}")
        elif isinstance(r, ForeignKey):
            parts.append(
                f"{head} count(*) AS violations FROM {src} c WHERE c.{r.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {r.parent} p WHERE p.{r.parent_column} = c.{r.column})"
            )
        else:
            cols = ", ".join(r.columns)
            parts.append(f"{head} count(*) AS violations FROM (SELECT {cols} FROM {src} GROUP BY {cols} HAVING count(*) > 1)")
    return " UNION ALL ".join(parts)


def report_sql(rules: list[Rule]) -> str:
    return f"""SELECT rule, table_name, violations, CAST(0 AS BIGINT) AS expected, CASE WHEN violations = 0 THEN 'ok' ELSE 'VIOLATED' END AS status
    FROM ({counts_sql(rules)})"""


def frames(t) -> dict:
    return {n: getattr(t, n) for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")}


@query("dq_foreign_key", report_sql(FOREIGN_KEYS))
def dq_foreign_key(t):
    return dq_report(frames(t), FOREIGN_KEYS)


@query("dq_unique_key", report_sql(UNIQUES))
def dq_unique_key(t):
    return dq_report(frames(t), UNIQUES)


@query("dq_duplicate_rows", f"SELECT l_orderkey, l_linenumber, count(*) AS n FROM {LINEITEM} GROUP BY ALL HAVING count(*) > 1")
def dq_duplicate_rows(t):
    return duplicates(t.lineitem, UNIQUES[3])


@query("dq_not_null", f"SELECT rule, violations FROM ({counts_sql(NOT_NULLS)})")
def dq_not_null(t):
    return row_violations(t.orders, NOT_NULLS)


@query("dq_check_range", f"SELECT rule, violations FROM ({counts_sql(RANGES)})")
def dq_check_range(t):
    return row_violations(t.lineitem, RANGES)


@query("dq_check_domain", f"SELECT rule, violations FROM ({counts_sql(DOMAINS)})")
def dq_check_domain(t):
    return row_violations(t.orders, DOMAINS)


CENTS = "CAST(l_extendedprice * 100 AS BIGINT)"
UNIT_CENTS = f"((2 * {CENTS} + l_quantity) // (2 * l_quantity))"


@query(
    "dq_check_cross_column",
    f"""SELECT 'price = quantity x unit price' AS rule, count(*) FILTER ({UNIT_CENTS} * l_quantity <> {CENTS}) AS violations FROM {LINEITEM}
    UNION ALL SELECT 'net + discount = price', count(*) FILTER (CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(12,2)) + CAST(l_extendedprice * l_discount AS DECIMAL(12,2)) <> l_extendedprice) FROM {LINEITEM}""",
)
def dq_check_cross_column(t):
    rules = [
        Check(
            "price = quantity x unit price",
            "lineitem",
            "CAST(l_extendedprice / CAST(l_quantity AS DECIMAL(10,0)) AS DECIMAL(12,2)) * l_quantity = l_extendedprice",
        ),
        Check(
            "net + discount = price",
            "lineitem",
            "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(12,2)) + CAST(l_extendedprice * l_discount AS DECIMAL(12,2)) = l_extendedprice",
        ),
    ]
    return row_violations(t.lineitem, rules)


@query("dq_check_state", f"SELECT rule, violations FROM ({counts_sql(STATES)})")
def dq_check_state(t):
    return row_violations(t.lineitem, STATES)


TOP_TIER = [Check("top tier only for premium types", "part", "NOT (p_size >= 45) OR p_type IN ('PROMO', 'LARGE')")]


@query("dq_conditional_rule", f"SELECT p_partkey, p_type, p_size FROM {PART} WHERE p_size >= 45 AND p_type NOT IN ('PROMO', 'LARGE')")
def dq_conditional_rule(t):
    """The rows themselves, not only their number."""

    _, rejected = split_valid(t.part.select("p_partkey", "p_type", "p_size"), TOP_TIER)
    return rejected.drop("broken_rules")


@query(
    "reconcile_header_detail",
    f"""SELECT o_orderkey, {dbl('o_totalprice')} AS header_total, {dbl('coalesce(s, 0)')} AS items_total, {dbl('o_totalprice - coalesce(s, 0)')} AS difference,
    CASE WHEN abs(o_totalprice - coalesce(s, 0)) > 0.01 THEN 'MISMATCH' ELSE 'Match' END AS status
    FROM {ORDERS} LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM {LINEITEM} GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def reconcile_header_detail(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(total("l_extendedprice").alias("s"))
    items = F.coalesce("s", F.lit(0).cast(TOTAL))
    diff = F.col("o_totalprice") - items
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey",
        F.col("o_totalprice").alias("header_total"),
        items.alias("items_total"),
        diff.alias("difference"),
        F.when(F.abs(diff) > F.lit("0.01").cast("decimal(3,2)"), "MISMATCH").otherwise("Match").alias("status"),
    )


@query("reconcile_count", f"SELECT l_orderkey, CAST(max(l_linenumber) AS BIGINT) AS declared, count(*) AS actual FROM {LINEITEM} GROUP BY 1 HAVING max(l_linenumber) <> count(*)")
def reconcile_count(t):
    return (
        t.lineitem.groupBy("l_orderkey")
        .agg(F.max("l_linenumber").cast("bigint").alias("declared"), F.count("*").alias("actual"))
        .filter("declared <> actual")
    )


@query("dq_single_date_group", f"SELECT l_orderkey, {key_of('min(l_date)')} AS first_key, {key_of('max(l_date)')} AS last_key FROM {LINEITEM} GROUP BY 1 HAVING count(DISTINCT l_date) > 1")
def dq_single_date_group(t):
    """More than one date in a group means that its lowest and highest date differ: no distinct needed."""

    g = t.lineitem.groupBy("l_orderkey").agg(F.min("l_date").alias("a"), F.max("l_date").alias("b"))
    return g.filter("a < b").select("l_orderkey", date_key("a").alias("first_key"), date_key("b").alias("last_key"))


@query(
    "dq_negative_balance",
    f"""SELECT 'Negative balance check' AS test, count(*) FILTER (balance < 0) AS negative_balances, count(*) AS balances
    FROM (SELECT sum(net) OVER (PARTITION BY user_id ORDER BY e_date) AS balance FROM (SELECT user_id, e_date, sum({SIGNED}) AS net FROM {EVENTS} GROUP BY ALL))""",
)
def dq_negative_balance(t):
    return end_of_day_balance(t).agg(
        F.count_if(F.col("balance") < 0).alias("negative_balances"), F.count("*").alias("balances")
    ).select(F.lit("Negative balance check").alias("test"), "negative_balances", "balances")


@query(
    "dq_linkage",
    f"""SELECT count(*) FILTER (l_linestatus = 'F') AS sold, count(*) FILTER (l_linestatus = 'F' AND o_orderkey IS NULL) AS sold_without_sale,
    count(*) FILTER (o_orderkey IS NOT NULL) AS linked, count(*) FILTER (o_orderstatus = 'F') AS linked_to_filled
    FROM {LINEITEM} LEFT JOIN (SELECT o_orderkey, o_orderstatus FROM orders) ON o_orderkey = l_orderkey""",
)
def dq_linkage(t):
    """Items are counted per order and state first; the join sees one row per order."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.count_if(F.col("l_linestatus") == "F").alias("sold_n"), F.count("*").alias("n"))
    j = per_order.join(t.orders.select("o_orderkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    found = F.col("o_orderkey").isNotNull()

    def add(c):
        return F.coalesce(F.sum(c), F.lit(0))

    return j.agg(
        add("sold_n").alias("sold"),
        add(F.when(~found, F.col("sold_n"))).alias("sold_without_sale"),
        add(F.when(found, F.col("n"))).alias("linked"),
        add(F.when(F.col("o_orderstatus") == "F", F.col("n"))).alias("linked_to_filled"),
    )


ALL = FOREIGN_KEYS + UNIQUES + NOT_NULLS + RANGES + DOMAINS + STATES + TOP_TIER


@query("dq_report", report_sql(ALL))
def dq_report_all(t):
    return dq_report(frames(t), ALL)


TARGETS = [("1-URGENT", 25), ("2-HIGH", 30), ("3-MEDIUM", 15), ("4-NOT SPECIFIED", 20), ("5-LOW", 10)]


@query(
    "dq_distribution_drift",
    f"""WITH g AS (SELECT o_orderpriority, count(*) AS n FROM {ORDERS} GROUP BY 1), s AS (SELECT *, {share('n', 'sum(n) OVER ()')} AS observed_pct FROM g),
    v AS (SELECT * FROM (VALUES {', '.join(str(x) for x in TARGETS)}) v(label, target))
    SELECT label, {dbl('target')} AS target_pct, coalesce(observed_pct, 0) AS observed_pct, CASE WHEN abs(coalesce(observed_pct, 0) - target) > 2 THEN 'drift' ELSE 'ok' END AS status
    FROM v LEFT JOIN s ON s.o_orderpriority = v.label""",
)
def dq_distribution_drift(t):
    targets = t.spark.createDataFrame(TARGETS, "label string, target int")
    g = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    s = g.withColumn("pct", share_col("n", F.sum("n").over(W.partitionBy())))
    observed = F.coalesce("pct", F.lit(0).cast("decimal(5,2)"))
    return targets.join(s, F.col("label") == F.col("o_orderpriority"), "left").select(
        "label",
        F.col("target").cast("double").alias("target_pct"),
        observed.alias("observed_pct"),
        F.when(F.abs(observed - F.col("target")) > 2, "drift").otherwise("ok").alias("status"),
    )


FIT = [
    ("orders", "o_orderpriority", dict(TARGETS), ORDERS),
    ("orders", "o_orderpriority", {k: 20 for k, _ in TARGETS}, ORDERS),
    ("events", "event_type", {"view": 20, "signup": 20, "click": 20, "error": 20, "purchase": 20}, EVENTS),
    ("events", "event_type", {"view": 50, "click": 50}, EVENTS),
]


def _fit_sql(i: int, table: str, label: str, targets: dict, frm: str) -> str:
    scale = lcm(*targets.values())
    weight = " ".join(f"WHEN '{k}' THEN {100 * scale // v}" for k, v in targets.items())
    listed = ", ".join(f"'{k}'" for k in targets)
    bound = CHI_SQUARE_95[len(targets) - 1]
    return f"""SELECT {i} AS test, '{table}.{label}' AS checked, n_rows, unknown, chi_square, CAST({bound} AS DOUBLE) AS bound, CASE WHEN n_rows + unknown = 0 THEN 'no rows' WHEN unknown > 0 OR chi_square > {bound} THEN 'drift' ELSE 'fits' END AS verdict
    FROM (SELECT coalesce(sum(n) FILTER (l IS NOT NULL), 0)::BIGINT AS n_rows, coalesce(sum(n) FILTER (l IS NULL), 0)::BIGINT AS unknown,
      CAST(sum(n::HUGEINT * n * CASE l {weight} END) - sum(n) FILTER (l IS NOT NULL)::HUGEINT * sum(n) FILTER (l IS NOT NULL) * {scale} AS DOUBLE) / CAST(sum(n) FILTER (l IS NOT NULL) * {scale} AS DOUBLE) AS chi_square
      FROM (SELECT CASE WHEN {label} IN ({listed}) THEN {label} END AS l, count(*) AS n FROM {frm} GROUP BY 1))"""


@query("dq_goodness_of_fit", " UNION ALL ".join(_fit_sql(i, *x) for i, x in enumerate(FIT)))
def dq_goodness_of_fit(t):
    """Shares against targets with a chi-square test: what differs more than chance explains."""
    parts = [
        goodness_of_fit(getattr(t, table), label, targets).select(F.lit(i).alias("test"), F.lit(f"{table}.{label}").alias("checked"), "*")
        for i, (table, label, targets, _) in enumerate(FIT)
    ]
    return reduce(DataFrame.unionByName, parts)
