"""Ledgers in blocks of days, and ledgers that are continued batch by batch."""

from __future__ import annotations

import datetime as dt
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarmill.operators import ledger
from bazaarmill.operators.quality import goodness_of_fit
from bazaarmill.sources.ledgerstore import LedgerStore

DAY = dt.date(2024, 1, 1)
SCHEMA = f"e int, day date, process_order int, at timestamp_ntz, posting_no bigint, account string, kind string, amount {ledger.TOTAL}, source string, destination string, description string"


def posting(e, day, account, kind, amount, no):
    return (e, DAY + dt.timedelta(day), 5, None, no, account, kind, Decimal(amount), None, None, "x")


def random_postings(entities, days, n, seed=1):
    rng = random.Random(seed)
    return [
        posting(rng.randrange(entities), rng.randrange(days), rng.choice(ledger.ACCOUNTS), rng.choice(["Deposit", "Withdrawal"]), rng.randint(1, 5000), i) for i in range(n)
    ]


def fixes(df):
    return sorted((r.e, r.day, r.account, r.amount, r.description) for r in df.collect())


def plain(rows):
    """The fold day by day, in Python."""
    out = []
    for e in {r[0] for r in rows}:
        bal = dict.fromkeys(ledger.ACCOUNTS, Decimal(0))
        mine = [r for r in rows if r[0] == e]
        for day in sorted({r[1] for r in mine}):
            for r in mine:
                if r[1] == day:
                    bal[r[5]] += r[7] if r[6] == "Deposit" else -r[7]
            for short, payer in ledger.CHAIN:
                if bal[short] < 0:
                    fix = (-bal[short] * Decimal("1.10") + 1000).quantize(Decimal("0.01"), "ROUND_HALF_UP")
                    bal[short] += fix
                    bal[payer] -= fix
                    out += [(e, day, payer, fix, f"Deficit correction to {short}"), (e, day, short, fix, "Receive deficit correction")]
    return sorted(out)


@pytest.mark.parametrize("block", [1, 3, 256])
def test_blocks_give_the_plain_fold(spark, monkeypatch, block):
    monkeypatch.setattr(ledger, "BLOCK_DAYS", block)
    rows = random_postings(6, 40, 500)
    assert fixes(ledger.deficit_cascade(spark.createDataFrame(rows, SCHEMA), ["e"])) == plain(rows)


def test_long_history_is_linear(spark):
    """A century of days of one entity, every day corrected."""

    def took(days):
        rows = spark.range(days).select(
            F.lit(1).alias("e"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("day"), F.lit(5).alias("process_order"),
            F.lit(None).cast("timestamp_ntz").alias("at"), F.col("id").alias("posting_no"), F.lit("Debts").alias("account"), F.lit("Withdrawal").alias("kind"),
            F.lit("999999.00").cast(ledger.TOTAL).alias("amount"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("destination"), F.lit("x").alias("description"),
        )
        start = time.time()
        n = ledger.deficit_cascade(rows, ["e"]).count()
        return n, time.time() - start

    took(100)
    n, short = took(3_650)
    assert n == 4 * 3_650
    n, long = took(36_500)
    assert n == 4 * 36_500
    assert long < 15 * max(short, 1.0)


def test_store_equals_one_fold(spark, tmp_path):
    rows = random_postings(8, 60, 700, seed=4)
    rng = random.Random(6)
    rng.shuffle(rows)  # every batch has late days
    store = LedgerStore(spark, str(tmp_path / "ledger"), {"e": "int"})
    cuts = [0, 400, 650, 690, 700]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        assert store.post(spark.createDataFrame(rows[a:b], SCHEMA), f"b{i}") == i + 1
        assert fixes(store.corrections()) == plain(rows[:b])
    assert store.post(spark.createDataFrame(rows[690:], SCHEMA), "b3") is None  # a known batch
    assert store.post(spark.createDataFrame([], SCHEMA), "empty") is None
    assert fixes(store.corrections()) == plain(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    whole = df.unionByName(ledger.deficit_cascade(df, ["e"])).groupBy("e", "account").agg(F.sum(ledger.signed()).alias("b"))
    want = {(r.e, r.account): r.b for r in whole.collect()}
    last = store.balances().groupBy("e").agg(*[F.max_by(a, "day").alias(a) for a in ledger.ACCOUNTS])
    assert all(r[a] == want.get((r.e, a), 0) for r in last.collect() for a in ledger.ACCOUNTS)


def test_store_folds_only_from_the_first_touched_day(spark, tmp_path):
    rows = [posting(e, d, "Debts", "Withdrawal", 10, d) for e in (1, 2) for d in range(20)]
    store = LedgerStore(spark, str(tmp_path / "ledger"), {"e": "int"})
    store.post(spark.createDataFrame(rows, SCHEMA), "a")
    late = [posting(2, 15, "Debts", "Deposit", 5000, 99)]
    store.post(spark.createDataFrame(late, SCHEMA), "b")
    folded = spark.read.parquet(f"{store.path}/folds/gen=2")
    assert sorted((r.e, r.day) for r in folded.select("e", "day").collect()) == [(2, DAY + dt.timedelta(d)) for d in range(15, 20)]
    assert fixes(store.corrections()) == plain(rows + late)


def test_store_passes_over_a_batch_that_broke_off(spark, tmp_path):
    rows = random_postings(3, 10, 80)
    store = LedgerStore(spark, str(tmp_path / "ledger"), {"e": "int"})
    store.post(spark.createDataFrame(rows[:50], SCHEMA), "a")
    junk = random_postings(3, 10, 30, seed=9)
    nets = ledger.daily_net(spark.createDataFrame(junk, SCHEMA), ["e"])
    nets.write.parquet(f"{store.path}/nets/gen=2")  # written, and never finished
    assert fixes(store.corrections()) == plain(rows[:50])
    assert store.post(spark.createDataFrame(rows[50:], SCHEMA), "b") == 2
    assert fixes(store.corrections()) == plain(rows)


def test_goodness_of_fit(spark):
    def fit(counts, targets):
        rows = [(k,) for k, n in counts.items() for _ in range(n)]
        return goodness_of_fit(spark.createDataFrame(rows, "x string"), "x", targets).first()

    even = fit({"a": 50, "b": 50}, {"a": 50, "b": 50})
    assert (even.n_rows, even.unknown, even.chi_square, even.verdict) == (100, 0, 0.0, "fits")
    off = fit({"a": 70, "b": 30}, {"a": 50, "b": 50})
    assert off.chi_square == 16.0 and off.bound == 3.841 and off.verdict == "drift"
    small = fit({"a": 7, "b": 3}, {"a": 50, "b": 50})  # the same shares, but too few rows to tell
    assert small.chi_square == 1.6 and small.verdict == "fits"
    assert fit({"a": 100}, {"a": 25, "b": 75}).chi_square == 300.0
    other = fit({"a": 50, "b": 50, "z": 1, None: 2}, {"a": 50, "b": 50})
    assert (other.n_rows, other.unknown, other.verdict) == (100, 3, "drift")
    none = fit({}, {"a": 50, "b": 50})
    assert (none.n_rows, none.chi_square, none.verdict) == (0, None, "no rows")
    with pytest.raises(ValueError):
        fit({}, {"a": 50, "b": 49})
