"""Domain operators on small tables, compared with plain Python."""

from __future__ import annotations

import datetime as dt
import re
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal as D

import pytest
from pyspark.sql import functions as F

from bazaarmill.functions.draws import draw, weighted_bucket
from bazaarmill.operators import baskets, expenses, ledger, loans, pricing
from bazaarmill.operators.calendar import calendar
from bazaarmill.operators.picks import preferred_pick
from bazaarmill.plans import domain  # noqa: F401, registers the queries
from bazaarmill.registry import QUERIES

CENT = D("0.01")


def cents(x) -> D:
    return D(x).quantize(CENT, ROUND_HALF_UP)


# Draws


def test_draws_are_stable_and_spread(spark):
    df = spark.range(20000)
    a = df.select(draw("x", 100, "id").alias("d")).groupBy("d").count().toPandas()
    assert len(a) == 100 and a["count"].between(120, 290).all()
    assert df.select(draw("x", 100, "id")).collect() == df.repartition(7).sort("id").select(draw("x", 100, "id")).collect()


def test_weighted_bucket_shares(spark):
    n = 20000
    rows = spark.range(n).groupBy(weighted_bucket("w", (("a", 25), ("b", 45), ("c", 30)), "id").alias("l")).count().collect()
    got = {r.l: r["count"] / n for r in rows}
    assert got["a"] == pytest.approx(0.25, abs=0.02) and got["b"] == pytest.approx(0.45, abs=0.02)
    with pytest.raises(ValueError):
        weighted_bucket("w", (("a", 25),), "id")


def test_preferred_pick(spark):
    children = spark.createDataFrame(
        [("g", f"f{i}", True) for i in range(3)] + [("g", f"s{i}", False) for i in range(2)] + [("h", "only", False)], "grp string, child string, fast boolean"
    )
    parents = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, "h").when(F.col("id") % 4 == 1, "none").otherwise("g").alias("grp"))
    r = preferred_pick(parents, children, "grp", "id", "child", "fast").toPandas()
    assert len(r) == 4000
    g, h = r[r.grp == "g"], r[r.grp == "h"]
    assert g.picked.str.startswith("f").mean() == pytest.approx(0.6, abs=0.04)
    assert (h.picked == "only").all() and h.used_fallback.mean() == pytest.approx(0.6, abs=0.05)
    assert r[r.grp == "none"].picked.isna().all()


# Costs and prices


def test_allocate_cost(spark):
    df = spark.createDataFrame([("t1", i) for i in range(7)] + [("t2", 9)], "trip string, id int")
    for hot in (1, 1000):
        got = pricing.allocate_cost(df, ["trip"], 12000, "c", hot_rows=hot).collect()
        assert {(r.trip, r.c) for r in got} == {("t1", D("1714.29")), ("t2", D("12000.00"))}


def test_unit_cost_keeps_at_least_one_item(spark):
    df = spark.createDataFrame([(1, D("500000.00"), 333, D("0.77")), (2, D("10.00"), 1, D("0.65"))], "id int, cost decimal(12,2), n int, p decimal(5,2)")
    a, b = pricing.unit_cost(df, "cost", "n", F.col("p")).orderBy("id").collect()
    assert (a.sellable_items, a.unsellable_items, a.cost_per_item) == (256, 77, D("1953.13"))
    assert (b.sellable_items, b.unsellable_items, b.cost_per_item) == (1, 0, D("10.00"))


def test_factor_cost_is_clamped(spark):
    df = spark.createDataFrame([(D("0.50"),), (D("1.10"),), (D("9.00"),)], "f decimal(5,2)")
    got = [r.cost for r in pricing.factor_cost(df, 500000, [F.col("f")], 350000, 850000).orderBy("f").collect()]
    assert got == [D("350000.00"), D("550000.00"), D("850000.00")]


def test_markup_bounds(spark):
    df = spark.range(3000).select("id", F.lit(D("1953.13")).cast("decimal(10,2)").alias("c"))
    r = pricing.markup(df, "c", F.col("id") % 10 == 0, 20, 30, 50, "id").toPandas()
    top = r[r.is_top_tier]
    assert (top.markup_percent == 50).all() and (top.selling_price == D("2929.70")).all()
    assert set(int(x) for x in r[~r.is_top_tier].markup_percent) == set(range(20, 31))


def test_age_discount_tiers(spark):
    as_of = dt.date(2024, 12, 31)
    ages = [89, 90, 119, 120, 179, 180, 300]
    rows = [(a, as_of - dt.timedelta(days=a), D("100.00"), False) for a in ages] + [(301, as_of - dt.timedelta(days=301), D("100.00"), True)]
    df = spark.createDataFrame(rows, "age int, added date, price decimal(10,2), sold boolean")
    last_sale = F.lit("2024-11-24").cast("date")
    out = pricing.age_discount(df, "added", "price", "sold", ((90, 25), (120, 40), (180, 50)), F.lit(as_of), last_sale)
    got = {r.age: (r.is_in_discount, r.discount_percent, r.discounted_price) for r in out.collect()}
    no = (False, None, None)
    # the sale ended on Nov 24: items that reach 90 days after it get nothing
    assert got[89] == no and got[90] == no and got[119] == no and got[120] == no and got[301] == no
    assert got[179] == (True, 40, D("60.00")) and got[180] == (True, 50, D("50.00")) and got[300] == (True, 50, D("50.00"))


def test_explode_units(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (3, None), (4, 1)], "id int, q int")
    for by in (None, "id"):
        assert sorted((r.id, r.unit_no) for r in pricing.explode_units(df, "q", spread_by=by).collect()) == [(1, 1), (1, 2), (1, 3), (4, 1)]


# Baskets


def fixed_size(day, number):
    return (F.col(number) % 5 + 1).cast("bigint")


@pytest.mark.parametrize("block", [1, 3, 256])
def test_plan_equals_loop(spark, block):
    days = {1: 1, 2: 5, 3: 47, 4: 1000}
    df = spark.createDataFrame(list(days.items()), "day int, n bigint")
    got = defaultdict(list)
    for r in baskets.plan_baskets(df, "day", "n", fixed_size, block).orderBy("day", "basket_no").collect():
        got[r.day].append((r.basket_no, r.first_rank, r.last_rank))
    for day, n in days.items():
        rank, k, want = 1, 1, []
        while rank <= n:
            last = min(rank + k % 5, n)
            want.append((k, rank, last))
            rank, k = last + 1, k + 1
        assert got[day] == want


def test_every_item_is_packed_once(spark):
    # day 0 holds a third of the items
    items = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20 + 1).alias("day"))
    packed = baskets.pack_baskets(items, "day", ["id"])
    rows = packed.collect()
    assert sorted(r.id for r in rows) == list(range(3000))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.day, r.basket_no] += 1
    assert max(sizes.values()) <= 50 and min(sizes.values()) >= 1
    plan = baskets.plan_baskets(items.groupBy("day").agg(F.count("*").alias("n")), "day", "n")
    ranged = baskets.join_ranges(baskets.rank_items(items, "day", ["id"]), plan, "day")
    assert sorted((r.id, r.basket_no) for r in ranged.collect()) == sorted((r.id, r.basket_no) for r in rows)


@pytest.mark.parametrize("name", ["basket_packing", "basket_totals", "range_to_equi", "range_join"])
def test_opened_ranks_are_not_broadcast(spark, tables, name):
    df = QUERIES[name].build(tables)
    assert len(df.collect()) > 0  # the plan below is the final one
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [day#" in plan
    assert not re.search(r"BroadcastHashJoin \[[^\]]*(item_rank|_bucket)", plan)


@pytest.mark.parametrize("days, near", [({1: 1, 2: 3000, 3: 40}, 1), ({1: 1, 2: 3000, 3: 40}, 50)])
def test_days_of_small_baskets_are_planned_to_the_end(spark, monkeypatch, days, near):
    monkeypatch.setattr(baskets, "NEAR", near)
    df = spark.createDataFrame(list(days.items()), "day int, n bigint")
    got = baskets.plan_baskets(df, "day", "n", lambda day, number: F.lit(1).cast("bigint"), 4)
    assert {r["day"]: r["count"] for r in got.groupBy("day").count().collect()} == days


def test_short_amounts_are_summed_exactly_in_longs(spark):
    cases = ["0.00", "0.01", "0.29", "1.15", "-0.07", "4503599627.37", "9999999999.99", "-9999999999.99", "1234567890.12"]
    rows = spark.createDataFrame([(i % 4, i % 3, p, f if i % 5 else None) for i, (p, f) in enumerate((p, f) for p in cases for f in cases)], "day int, basket_no int, p string, f string")

    def totals(kind):
        return baskets.basket_totals(rows.select("day", "basket_no", *[F.col(c).cast(kind).alias(c) for c in "pf"]), "day", "p", "f")

    short, wide = totals("decimal(12,2)"), totals("decimal(14,2)")
    assert short.schema == wide.schema and sorted(short.collect()) == sorted(wide.collect()) and short.count() == 12
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sum(cast(rint(") == 2


def test_basket_size_shares(spark):
    r = spark.range(20000).select(F.lit(7).alias("day"), F.col("id").alias("k")).select(baskets.basket_size("day", "k").alias("s")).toPandas().s
    shares = [(r == 1).mean(), r.between(2, 4).mean(), r.between(5, 8).mean(), r.between(9, 10).mean(), r.between(11, 50).mean()]
    assert shares == pytest.approx([0.45, 0.25, 0.15, 0.10, 0.05], abs=0.015) and r.max() <= 50


# Loans


def test_loan_terms_and_schedule(spark):
    df = spark.createDataFrame([(1, D("2000000.00"), D("13.00"), 6, dt.date(2024, 8, 31))], "loan_id int, p decimal(12,2), rate decimal(5,2), m int, d date")
    book = loans.loan_terms(df, "p", "rate", "m")
    r = book.first()
    assert (r.total_repayment, r.monthly_repayment, r.interest_amount) == (D("2130000.00"), D("355000.00"), D("130000.00"))
    due = [str(x.due_date) for x in loans.repayment_schedule(book, "d", "m").orderBy("installment").collect()]
    assert due == ["2024-09-30", "2024-10-31", "2024-11-30", "2024-12-31", "2025-01-31", "2025-02-28"]


def test_payment_status_is_consistent(spark):
    sched = spark.range(5000).select(F.col("id").alias("loan_id"), F.lit(1).alias("installment"), F.lit(D("1000.00")).cast("decimal(12,2)").alias("m"))
    r = loans.payment_status(sched, "loan_id", "m").toPandas()
    on, partial = r[r.payment_status == "OnTime"], r[r.payment_status == "Partial"]
    assert on.days_late.isna().all() and (on.actual_amount == 1000).all()
    assert r[r.payment_status != "OnTime"].days_late.between(1, 5).all()
    assert partial.actual_amount.astype(float).between(800, 950).all()
    assert len(on) / 5000 == pytest.approx(0.90, abs=0.02)


def test_loan_progress(spark):
    book = spark.createDataFrame([(1, D("600.00"), 6), (2, D("600.00"), 6), (3, D("100.00"), 3)], "loan_id int, total decimal(12,2), m int")
    pay = spark.createDataFrame(
        [(1, D("100.00"), dt.date(2024, i, 1)) for i in range(1, 7)] + [(2, D("90.00"), dt.date(2024, 1, 1))] + [(3, D("33.33"), dt.date(2024, i, 1)) for i in (1, 2, 3)],
        "loan_id int, actual_amount decimal(12,2), due_date date",
    )
    got = {r.loan_id: (r.payments_made, r.remaining_balance, r.is_fully_repaid) for r in loans.loan_progress(book, pay, "loan_id", "total", "m").collect()}
    assert got == {1: (6, D("0.00"), True), 2: (1, D("510.00"), False), 3: (3, D("0.01"), True)}
    early = loans.loan_progress(book, pay, "loan_id", "total", "m", F.lit("2023-12-31").cast("date")).collect()
    assert all(r.payments_made == 0 and not r.is_fully_repaid for r in early)


# Expenses


def test_expenses_per_store(spark):
    cal = calendar(spark, "2024-01-01", "2024-12-31")
    stores = spark.range(5).withColumnRenamed("id", "s")
    rec = expenses.recurring_expenses(stores, "s", cal).toPandas()
    assert rec.groupby(["s", "expense_category"]).size().unstack().values.tolist() == [[8, 9]] * 5
    assert (rec[rec.expense_category == "Rent"].amount == 150000).all()
    assert rec[rec.expense_category == "Staff"].amount.astype(int).between(200000, 400999).all()
    util = expenses.monthly_variable(stores, "s", cal).toPandas()
    assert len(util) == 60 and (util.expense_date_key % 100).between(5, 10).all()
    summer = (util.expense_date_key // 100 % 100).between(3, 9)
    assert util[summer].amount.astype(int).between(50000, 80999).all() and util[~summer].amount.astype(int).between(30000, 50999).all()
    other = expenses.adhoc_expenses(stores, "s", cal, "Other", (40, 60), expenses.OTHER_BANDS, 40).toPandas()
    assert other.groupby("s").size().between(40, 60).all()
    days = set(cal.filter("is_open").toPandas().date_key)
    assert set(rec.expense_date_key) | set(util.expense_date_key) | set(other.expense_date_key) <= days


# Ledger


def post(spark, rows):
    """(entity, day of January, account, kind, amount, source, destination)"""
    data = [(e, dt.date(2024, 1, d), 5, None, i, a, k, D(x), s, z, "test") for i, (e, d, a, k, x, s, z) in enumerate(rows)]
    return spark.createDataFrame(
        data,
        "e string, day date, process_order int, at timestamp_ntz, posting_no bigint, account string, kind string, amount decimal(22,2), source string, destination string, description string",
    )


def test_deficit_worked_case(spark):
    rows = post(spark, [("x", 1, "Operations", "Deposit", "50000.00", None, None), ("x", 1, "Debts", "Withdrawal", "15000.00", None, None)])
    fix = ledger.deficit_cascade(rows, ["e"]).orderBy("posting_no").collect()
    assert [(r.account, r.amount, r.description) for r in fix] == [
        ("Operations", D("17500.00"), "Deficit correction to Debts"),
        ("Debts", D("17500.00"), "Receive deficit correction"),
    ]
    total = {r.account: r.balance for r in ledger.closing_balances(rows.unionByName(ledger.deficit_cascade(rows, ["e"])), ["e"]).collect()}
    assert total == {"Debts": D("2500.00"), "Operations": D("32500.00")}


def test_deficit_cascade_equals_loop(spark):
    import random

    rnd = random.Random(5)
    rows = []
    for e in ("a", "b", "c"):
        for _ in range(200):
            kind = rnd.choice(["Deposit", "Withdrawal", "Withdrawal", "Transfer"])
            amount = str(D(rnd.randrange(1, 500000)) / 100)
            day = rnd.randrange(1, 29)
            if kind == "Transfer":
                rows += [(e, day, acc, kind, amount, "Operations", "Debts") for acc in ("Operations", "Debts")]
            else:
                rows.append((e, day, rnd.choice(ledger.ACCOUNTS), kind, amount, None, None))
    df = post(spark, rows)
    got = {(r.e, r.day.day, r.account, r.description): r.amount for r in ledger.deficit_cascade(df, ["e"]).collect()}
    want = {}
    for e in ("a", "b", "c"):
        bal = dict.fromkeys(ledger.ACCOUNTS, D(0))
        for day in sorted({r[1] for r in rows if r[0] == e}):
            for _, d, acc, kind, x, _, dst in (r for r in rows if r[0] == e and r[1] == day):
                bal[acc] += D(x) if kind == "Deposit" or (kind == "Transfer" and acc == dst) else -D(x)
            for short, payer in ledger.CHAIN:
                if bal[short] < 0:
                    fix = cents(-bal[short] * D("1.10") + 1000)
                    bal[short] += fix
                    bal[payer] -= fix
                    want[e, day, payer, f"Deficit correction to {short}"] = fix
                    want[e, day, short, "Receive deficit correction"] = fix
            assert bal["Debts"] >= 0 and bal["Operations"] >= 0
    assert got == want and len(want) > 20


def test_running_balance_and_sweep(spark):
    rows = post(spark, [
        ("x", 1, "Debts", "Deposit", "700.00", None, None), ("x", 2, "Debts", "Withdrawal", "100.00", None, None),
        ("x", 2, "Operations", "Deposit", "900.00", None, None), ("x", 3, "Operations", "Transfer", "50.00", "Operations", "Debts"),
        ("x", 3, "Debts", "Transfer", "50.00", "Operations", "Debts"), ("y", 1, "Operations", "Deposit", "10.00", None, None),
    ])
    got = {r.posting_no: r.balance for r in ledger.running_balance(rows, ["e"]).collect()}
    assert got == {0: D("700.00"), 1: D("600.00"), 2: D("900.00"), 3: D("850.00"), 4: D("650.00"), 5: D("10.00")}
    swept = ledger.year_end_sweep(rows, ["e"], F.lit("2024-12-31").cast("date"), keep="500.00")
    final = {(r.e, r.account): r.balance for r in ledger.closing_balances(rows.unionByName(swept), ["e"]).collect()}
    assert final == {("x", "Debts"): D(0), ("x", "Operations"): D("500.00"), ("x", "Profits"): D("1000.00"), ("y", "Operations"): D("10.00")}


def test_fund_split_shares(spark):
    day = spark.createDataFrame([(dt.date(2024, 1, 4), D("1000.01"))], "day date, amount decimal(22,2)")
    got = [(r.process_order, r.account, r.kind, r.amount) for r in ledger.fund_split(day, [], "day", "amount").orderBy("process_order", "posting_no").collect()]
    assert got == [
        (6, "Profits", "Deposit", D("1000.01")), (7, "Profits", "Transfer", D("700.01")), (7, "Operations", "Transfer", D("700.01")),
        (8, "Operations", "Transfer", D("455.00")), (8, "Debts", "Transfer", D("455.00")),
    ]


def test_balances_fill_days_without_postings(spark):
    rows = post(spark, [("x", 1, "Debts", "Deposit", "5.00", None, None), ("x", 4, "Debts", "Withdrawal", "2.00", None, None), ("x", 6, "Operations", "Deposit", "1.00", None, None)])
    got = {(r.account, r.day.day): r.balance for r in ledger.balances_over_time(rows, ["e"]).collect()}
    assert got == {("Debts", d): D("5.00") for d in (1, 2, 3)} | {("Debts", d): D("3.00") for d in (4, 5, 6)} | {("Operations", 6): D("1.00")}


def test_unit_draws_join_the_line_key_once(spark, tables):
    """A unit's text is put together by one plain ``concat``, and its draw is that of the keys."""
    from bazaarmill.functions.draws import draw, draw_of
    from bazaarmill.plans.domain import unit_explosion
    from pyspark.sql import functions as F

    rows = spark.range(200).select(F.concat_ws("-", "id", F.lit(3)).alias("k"), (F.col("id") % 7).cast("int").alias("n"))
    same = draw("grade", 100, "k", "n") == draw_of(F.concat("k", F.lit(":"), F.col("n").cast("string"), F.lit(":grade")), 100)
    assert rows.filter(~same).count() == 0
    plan = unit_explosion(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" not in plan[: plan.index("Generate")]
