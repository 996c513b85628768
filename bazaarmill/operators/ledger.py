"""Multi-account cash ledger: postings, running balances, deficit corrections and year-end sweeps.

A posting has: entity columns, day, process_order, at, posting_no, account, kind (Deposit, Withdrawal
or Transfer), amount, source, destination, description. Inside an account postings follow
(day, process_order, at, posting_no). Amounts have 22 digits: a posting can be the daily sum of very
many sales.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.money import TOTAL
from . import ordered

ORDER = ["day", "process_order", "at", "posting_no"]
POSTING = [*ORDER, "account", "kind", "amount", "source", "destination", "description"]
ACCOUNTS = ("Profits", "Operations", "Debts")
CHAIN = (("Debts", "Operations"), ("Operations", "Profits"))  # account in deficit, account that pays

# Buffers of a correction, the shares of the daily split, the balance kept at year end.
BUFFER_PCT = "1.10"
BUFFER_ABS = "1000.00"
SPLIT = ("0.70", "0.65")
KEEP_OPERATIONS = "500000.00"


def signed(amount: str = "amount") -> Column:
    """Effect of a posting on its own account."""
    adds = (F.col("kind") == "Deposit") | ((F.col("kind") == "Transfer") & (F.col("account") == F.col("destination")))
    return F.when(adds, F.col(amount)).otherwise(-F.col(amount))


def side(
    process_order: int,
    account: str,
    kind: str,
    amount: Column,
    description: Column | str,
    source: str | None = None,
    destination: str | None = None,
    posting_no: Column | int = 0,
) -> Column:
    """One posting as a struct, to be opened by ``open_postings``."""
    return F.struct(
        F.lit(process_order).alias("process_order"),
        (posting_no if isinstance(posting_no, Column) else F.lit(posting_no)).cast("bigint").alias("posting_no"),
        F.lit(account).alias("account"),
        F.lit(kind).alias("kind"),
        amount.cast(TOTAL).alias("amount"),
        F.lit(source).cast("string").alias("source"),
        F.lit(destination).cast("string").alias("destination"),
        (F.lit(description) if isinstance(description, str) else description).alias("description"),
    )


def transfer(process_order: int, source: str, destination: str, amount: Column, out_text: str, in_text: str, no: int = 0) -> list[Column]:
    """Both sides of a transfer."""
    return [
        side(process_order, account, "Transfer", amount, text, source, destination, no + i)
        for i, (account, text) in enumerate(((source, out_text), (destination, in_text)))
    ]


def open_postings(df: DataFrame, entity: Sequence[str], day: Column, sides: Sequence[Column]) -> DataFrame:
    """All postings of each row, opened in one pass over the input; amounts of zero make none.

    The streams share this schema and can be unioned.
    """
    opened = df.select(*entity, day.cast("date").alias("day"), F.explode(F.array(*sides)).alias("_p")).filter(F.col("_p.amount") > 0)
    return opened.select(
        *entity, "day", "_p.process_order", F.lit(None).cast("timestamp_ntz").alias("at"),
        *[f"_p.{c}" for c in ("posting_no", "account", "kind", "amount", "source", "destination", "description")],
    )


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def opening_balance(entities: DataFrame, entity: Sequence[str], day: Column, amounts: dict[str, str]) -> DataFrame:
    """Seed deposits before the first posting."""
    sides = [side(0, a, "Deposit", F.lit(v), "Opening balance", posting_no=i) for i, (a, v) in enumerate(amounts.items())]
    return open_postings(entities, entity, day, sides)


def fund_split(sales_by_day: DataFrame, entity: Sequence[str], day: str, amount: str, shares: Sequence[str] = SPLIT) -> DataFrame:
    """Daily revenue into Profits, a share of it on to Operations, and a share of that on to Debts."""
    to_ops = F.lit(shares[0]).cast("decimal(3,2)")
    to_debts = F.lit(shares[1]).cast("decimal(3,2)")
    x = F.col(amount)
    sides = [
        side(6, "Profits", "Deposit", x, "Daily sales revenue"),
        *transfer(7, "Profits", "Operations", x * to_ops, "70% of daily sales to Operations", "Receive 70% from Profits"),
        *transfer(8, "Operations", "Debts", x * to_ops * to_debts, "65% of Operations inflow to Debts", "Receive 65% from Operations"),
    ]
    return open_postings(sales_by_day, entity, F.col(day), sides)


def build_movements(
    sales_by_day: DataFrame,
    loans: DataFrame,
    bells_by_day: DataFrame,
    expenses_by_day: DataFrame,
    repayments_by_day: DataFrame,
) -> DataFrame:
    """All eleven movement streams of one business; each input is read once.

    Inputs have ``day`` and amounts, already summed per day (loans: one row per loan).
    """
    d, x = F.col("day"), F.col("amount")
    loan_text = F.concat(F.lit("Loan disbursement (Loan ID: "), F.col("loan_id").cast("string"), F.lit(")"))
    bell_sides = [
        side(2, "Debts", "Withdrawal", F.col("loan_cost"), "Loan-funded bell purchases"),
        side(3, "Operations", "Withdrawal", F.col("profit_cost"), "Profit-funded bell purchases"),
        side(4, "Operations", "Withdrawal", F.col("transport"), "Transport costs"),
    ]
    return union(
        [
            open_postings(loans, [], d, [side(1, "Debts", "Deposit", x, loan_text, posting_no=F.col("loan_id"))]),
            open_postings(bells_by_day, [], d, bell_sides),
            open_postings(expenses_by_day, [], d, [side(5, "Operations", "Withdrawal", x, "Daily expenses")]),
            fund_split(sales_by_day, [], "day", "amount"),
            open_postings(repayments_by_day, [], d, [side(9, "Debts", "Withdrawal", x, "Loan repayment")]),
        ]
    )


def running_balance(postings: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Balance of the account after each posting."""
    out = ordered.running(postings, [*entity, "account"], ORDER, {"balance": signed().cast(TOTAL)})
    return out.withColumn("balance", F.col("balance").cast(TOTAL))


def daily_net(postings: DataFrame, entity: Sequence[str], accounts: Sequence[str] = ACCOUNTS) -> DataFrame:
    """Net change per entity and day, one column per account."""
    zero = F.lit(0).cast(TOTAL)
    return postings.groupBy(*entity, "day").agg(
        *[F.coalesce(F.sum(F.when(F.col("account") == a, signed())).cast(TOTAL), zero).alias(a) for a in accounts]
    )


#: Days that are folded together. A day's log entry is copied once per later corrected day of its block, and a block's log once.
BLOCK_DAYS = 256


def day_vectors(days: DataFrame, entity: Sequence[str], accounts: Sequence[str] = ACCOUNTS, carry: Sequence[str] = ()) -> DataFrame:
    """One row per entity with its days in order (``_days``); ``carry`` are columns that are equal in all rows of an entity.

    The vector has one entry per day, however many postings there are, so it is as long as the calendar.
    """
    return days.groupBy(*entity, *carry).agg(F.sort_array(F.collect_list(F.struct("day", *accounts))).alias("_days"))


def fold_days(
    vectors: DataFrame,
    entity: Sequence[str],
    accounts: Sequence[str] = ACCOUNTS,
    chain: Sequence[tuple[str, str]] = CHAIN,
    buffer_pct: str = BUFFER_PCT,
    buffer_abs: str = BUFFER_ABS,
    start: dict[str, Column] | None = None,
    every_day: bool = False,
) -> DataFrame:
    """(entity, day, accounts, f0, f1 ...): closing balances after corrections and the correction of each link of the chain.

    Only days with a correction, or all with ``every_day``. ``start`` has the balances to go on from, zero by default. A correction
    changes the balances of the days after it, so the days of an entity are a true sequence. They are folded in blocks: the
    balances are carried from block to block, and each block's log is a list of its own, so the time is linear in the days.
    The folds are built-in higher-order functions and run in parallel over entities.
    """
    columns = [f"{a}:{TOTAL}" for a in accounts] + [f"f{i}:{TOTAL}" for i in range(len(chain))]
    entry_type = "struct<day:date," + ",".join(columns) + ">"
    zero = F.lit(0).cast(TOTAL)
    first = {a: (start or {}).get(a, zero).cast(TOTAL) for a in accounts}

    def state(balance: dict[str, Column], log: Column) -> Column:
        return F.struct(*[balance[a].alias(a) for a in accounts], log.alias("log"))

    def day(held: Column, d: Column) -> Column:
        balance = {a: (held[a] + d[a]).cast(TOTAL) for a in accounts}
        fixes = []
        for short, payer in chain:
            needed = (F.abs(balance[short]) * F.lit(buffer_pct).cast("decimal(3,2)") + F.lit(buffer_abs).cast(TOTAL)).cast(TOTAL)
            fix = F.when(balance[short] < 0, needed).otherwise(zero)
            balance[short] = (balance[short] + fix).cast(TOTAL)
            balance[payer] = (balance[payer] - fix).cast(TOTAL)
            fixes.append(fix)
        entry = F.struct(d["day"].alias("day"), *[balance[a].alias(a) for a in accounts], *[f.alias(f"f{i}") for i, f in enumerate(fixes)])
        log = F.concat(held["log"], F.array(entry).cast(f"array<{entry_type}>"))
        found = reduce(lambda x, y: x | y, [f > 0 for f in fixes])
        return state(balance, log if every_day else F.when(found, log).otherwise(held["log"]))

    def block(held: Column, days: Column) -> Column:
        done = F.aggregate(days, state({a: held[a] for a in accounts}, F.array().cast(f"array<{entry_type}>")), day)
        return state({a: done[a] for a in accounts}, F.concat(held["log"], F.array(done["log"]).cast(f"array<array<{entry_type}>>")))

    last = ((F.size("_days") - 1) / F.lit(BLOCK_DAYS)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_days", i * BLOCK_DAYS + 1, F.lit(BLOCK_DAYS)))
    folded = F.aggregate(blocks, state(first, F.array().cast(f"array<array<{entry_type}>>")), block)
    return vectors.select(*entity, F.explode(F.flatten(folded["log"])).alias("_e")).select(*entity, "_e.*")


def correction_postings(fixes: DataFrame, entity: Sequence[str], chain: Sequence[tuple[str, str]] = CHAIN) -> DataFrame:
    """Both sides of the transfers in f0, f1 ...; zero amounts make none."""
    sides = [
        s
        for i, (short, payer) in enumerate(chain)
        for s in transfer(90 + i, payer, short, F.col(f"f{i}"), f"Deficit correction to {short}", "Receive deficit correction", 2 * i)
    ]
    return open_postings(fixes, entity, F.col("day"), sides)


def deficit_cascade(
    postings: DataFrame,
    entity: Sequence[str],
    accounts: Sequence[str] = ACCOUNTS,
    chain: Sequence[tuple[str, str]] = CHAIN,
    buffer_pct: str = BUFFER_PCT,
    buffer_abs: str = BUFFER_ABS,
) -> DataFrame:
    """Correction transfers: an account that ends a day below zero is filled up from the next one."""
    vectors = day_vectors(daily_net(postings, entity, accounts), entity, accounts)
    return correction_postings(fold_days(vectors, entity, accounts, chain, buffer_pct, buffer_abs), entity, chain)


def closing_balances(postings: DataFrame, entity: Sequence[str], until: Column | None = None) -> DataFrame:
    """Balance per entity and account after the last posting (at or before ``until``)."""
    rows = postings if until is None else postings.filter(F.col("day") <= until)
    return rows.groupBy(*entity, "account").agg(F.sum(signed()).cast(TOTAL).alias("balance"))


def year_end_sweep(postings: DataFrame, entity: Sequence[str], day: Column, keep: str = KEEP_OPERATIONS) -> DataFrame:
    """All of Debts, and what Operations holds above ``keep``, go to Profits on the last day."""
    wide = (
        closing_balances(postings, entity, day)
        .groupBy(*entity)
        .agg(*[F.coalesce(F.max(F.when(F.col("account") == a, F.col("balance"))), F.lit(0).cast(TOTAL)).alias(a) for a in ACCOUNTS])
    )
    excess = F.col("Operations") - F.lit(keep).cast(TOTAL)
    sides = [
        *transfer(95, "Debts", "Profits", F.col("Debts"), "Year-end sweep: Debts → Profits", "Year-end sweep: Receive from Debts"),
        *transfer(
            96, "Operations", "Profits", excess, "Year-end sweep: Operations excess → Profits", "Year-end sweep: Receive from Operations"
        ),
    ]
    return open_postings(wide, entity, day, sides)


def balances_over_time(postings: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Closing balance per entity, account and day, also for days without a posting.

    Each balance is stretched to the day before the next one, so nothing is joined to the calendar.
    """
    net = postings.groupBy(*entity, "account", "day").agg(F.sum(signed()).cast(TOTAL).alias("_net"))
    by_account = W.partitionBy(*entity, "account").orderBy("day")
    last = postings.agg(F.max("day")).scalar()
    closing = net.withColumns(
        {
            "balance": F.sum("_net").over(by_account.rowsBetween(W.unboundedPreceding, 0)).cast(TOTAL),
            "_until": F.coalesce(F.date_sub(F.lead("day").over(by_account), 1), last),
        }
    )
    return closing.select(*entity, "account", F.explode(F.sequence("day", "_until")).alias("day"), "balance")
