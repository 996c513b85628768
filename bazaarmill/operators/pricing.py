"""Cost allocation, pricing, sell-through, aging discounts and final prices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.draws import draw
from ..functions.money import AMOUNT, RATE, UNIT, clamp
from ..session import partitions
from . import skew
from .calendar import next_date


def _dec(x: object, kind: str) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast(kind)


def allocate_cost(df: DataFrame, group_cols: list[str], cost: object, name: str = "allocated", hot_rows: int = 1_000_000) -> DataFrame:
    """Split one fixed cost per group evenly over the rows of the group."""
    sizes = df.groupBy(*group_cols).agg(F.count("*").alias("_size"))
    out = skew.attach(df, sizes, group_cols, "_size", hot_rows)
    return out.withColumn(name, (_dec(cost, AMOUNT) / F.col("_size").cast("decimal(18,0)")).cast(UNIT)).drop("_size")


def unit_cost(df: DataFrame, cost: str, total_items: str, sellable_pct: Column) -> DataFrame:
    """Sellable and unsellable items of a purchase, and the cost that each sellable item carries."""
    sellable = F.greatest((F.col(total_items).cast("decimal(10,0)") * sellable_pct).cast("int"), F.lit(1))
    return (
        df.withColumn("sellable_items", sellable)
        .withColumn("unsellable_items", F.col(total_items) - F.col("sellable_items"))
        .withColumn(
            "cost_per_item",
            (F.col(cost) / F.nullif(F.col("sellable_items"), F.lit(0)).cast("decimal(10,0)")).cast(UNIT),
        )
    )


def stepped_factor(salt: str, choice: str | Column, table: dict[object, tuple[int, int]], *keys: str) -> Column:
    """Factor per label: ``low`` hundredths plus a draw of ``spread`` hundredths."""
    label = F.col(choice) if isinstance(choice, str) else choice
    low = F.create_map(*[x for k, (a, _) in table.items() for x in (F.lit(k), F.lit(a))])
    spread = F.create_map(*[x for k, (_, b) in table.items() for x in (F.lit(k), F.lit(b))])
    steps = F.try_element_at(low, label) + draw(salt, F.try_element_at(spread, label), *keys)
    return (steps.cast("decimal(6,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(6,2)")


def factor_cost(df: DataFrame, base: object, factors: Sequence[Column], low: object, high: object, name: str = "cost") -> DataFrame:
    """Base cost times all factors, exact, kept inside [low, high]."""
    raw = reduce(lambda a, f: a * f, factors, _dec(base, "decimal(10,2)"))
    return df.withColumn(name, clamp(raw, low, high).cast(AMOUNT))


def explode_units(df: DataFrame, qty_col: str, name: str = "unit_no", spread_by: str | None = None) -> DataFrame:
    """One row per unit. The generator streams; no number table and no join.

    When a row opens to very many units, ``spread_by`` shuffles the (much smaller) input by a key first,
    with a fixed number of partitions, so that the units are not made by the few tasks that hold it.
    """
    rows = df.filter(F.col(qty_col) >= 1)
    if spread_by:
        rows = rows.repartition(partitions(df.sparkSession), spread_by)
    return rows.withColumn(name, F.explode(F.sequence(F.lit(1), F.col(qty_col).cast("int"))))


def price_table(cost: str, low: int, high: int, top: int) -> Column:
    """Selling prices of a cost at each mark-up from ``low`` to ``high`` and, last, at ``top``: worked out once for all items of that cost."""
    factors = F.array(*[F.lit(f"{(100 + pct) / 100:.2f}").cast("decimal(5,2)") for pct in (*range(low, high + 1), top)])
    return F.transform(factors, lambda f: (F.col(cost) * f).cast(UNIT))


def markup(df: DataFrame, cost: str, tier: Column, low: int, high: int, top: int, *keys: str, salt: str = "markup", prices: str | None = None) -> DataFrame:
    """Fixed mark-up for the top tier, a draw from [low, high] for the rest; price with two decimals.

    With ``prices``, a ``price_table`` of the same bounds, the price is looked up there, at ``markup_place``.
    """
    tiered = df.withColumn("is_top_tier", tier)
    drawn = draw(salt, high - low + 1, *keys)
    if prices:
        percents = F.array(*[F.lit(pct).cast(RATE) for pct in (*range(low, high + 1), top)])
        placed = tiered.withColumn("markup_place", F.when(F.col("is_top_tier"), high - low + 2).otherwise(drawn + 1).cast("int"))
        return placed.withColumns({"markup_percent": F.element_at(percents, F.col("markup_place")), "selling_price": F.element_at(prices, F.col("markup_place"))})
    pct = F.when(F.col("is_top_tier"), F.lit(top)).otherwise(drawn + low).cast(RATE)
    factor = F.lit(1).cast("decimal(3,0)") + F.col("markup_percent") * F.lit("0.01").cast("decimal(3,2)")
    return tiered.withColumn("markup_percent", pct).withColumn("selling_price", (F.col(cost) * factor).cast(UNIT))


def least_chance(factors: Sequence[Column], threshold: str) -> Column:
    """Least whole number of hundredths that, as the last factor after these (of two decimals each), brings the score above the threshold."""
    unit = 100 ** len(factors)
    known = (reduce(lambda a, f: a * f, [f.cast("decimal(5,2)") for f in factors]) * F.lit(unit)).cast("bigint")
    return (F.call_function("div", (F.lit(threshold).cast("decimal(5,2)") * F.lit(unit * 100)).cast("bigint"), F.nullif(known, F.lit(0).cast("bigint"))) + 1).cast("int")


def sell_score(df: DataFrame, factors: Sequence[Column], threshold: str, least: tuple[str, Column, int, int] | None = None) -> DataFrame:
    """Product of the factors, and whether it is above the threshold.

    ``least`` names the column with the ``least_chance`` of the last factor, and gives that factor in hundredths with its bounds: it is
    drawn only where it decides.
    """
    score = reduce(lambda a, f: a * f, [f.cast("decimal(5,2)") for f in factors])
    out = df.withColumn("score", score)
    if least is None:
        return out.withColumn("will_sell", F.col("score") > F.lit(threshold).cast("decimal(5,2)"))
    need, chance, low, high = least
    return out.withColumn("will_sell", F.when(F.col(need) <= low, True).when(F.col(need) > high, False).otherwise(chance >= F.col(need)))


def assign_sale_date(df: DataFrame, added: str, days: Column, cal: DataFrame, sells: str, last: Column) -> DataFrame:
    """First open day after the drawn number of days, up to ``last``; without one the item stays unsold."""
    # drawn once, and only for what sells
    ready = df.withColumn("_days", F.when(F.col(sells), days.cast("int"))).withColumn("_ready", F.date_add(F.col(added), F.col("_days")))
    out = next_date(ready, "_ready", cal, name="sold_date", upper=last)
    return out.withColumns(
        {"is_sold": F.col("sold_date").isNotNull(), "days_in_inventory": F.when(F.col("sold_date").isNotNull(), F.col("_days"))}
    ).drop("_ready", "_days")


def age_discount(
    df: DataFrame, added: str, price: str, is_sold: str, tiers: Sequence[tuple[int, int]], as_of: Column, last_sale_day: Column
) -> DataFrame:
    """Discount of unsold items by age on ``as_of``, if a sale day came after the youngest tier's age.

    ``last_sale_day`` is the last sale day up to ``as_of``: one date instead of a search per item.
    """
    tiers = sorted(tiers, reverse=True)
    youngest = tiers[-1][0]
    age = F.datediff(as_of, F.col(added))
    eligible = F.coalesce(
        ~F.col(is_sold) & (age >= youngest) & (F.date_add(F.col(added), youngest) <= last_sale_day), F.lit(False)
    )
    band = reduce(lambda acc, t: acc.when(age >= t[0], t[1]), tiers[1:], F.when(age >= tiers[0][0], tiers[0][1]))
    out = df.withColumn("is_in_discount", eligible).withColumn(
        "discount_percent", F.when(F.col("is_in_discount"), band).cast(RATE)
    )
    keep = F.lit(1).cast("decimal(3,0)") - F.col("discount_percent") * F.lit("0.01").cast("decimal(3,2)")
    return out.withColumn("discounted_price", (F.col(price) * keep).cast(UNIT))


def final_price(df: DataFrame, sold: str = "is_sold") -> DataFrame:
    """Price of sold items: the discounted one if there is one."""
    return df.withColumn("final_price", F.when(F.col(sold), F.coalesce("discounted_price", "selling_price")))
