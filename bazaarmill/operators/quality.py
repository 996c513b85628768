"""Declared data-quality rules, one report over all of them, and a good/rejected split.

Row rules of one table are counted in a single pass. Key rules count rows per key first, so a key that
owns a large part of a table reaches the join or the final count as a single row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import lcm

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """Row rule in SQL. As in a CHECK constraint, an unknown result passes."""

    name: str
    table: str
    condition: str


@dataclass(frozen=True)
class NotNull:
    name: str
    table: str
    column: str


@dataclass(frozen=True)
class ForeignKey:
    """Every non-null value of ``column`` must exist in the parent."""

    name: str
    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Unique:
    name: str
    table: str
    columns: tuple[str, ...]


Rule = Check | NotNull | ForeignKey | Unique


def violated(rule: Check | NotNull) -> Column:
    if isinstance(rule, NotNull):
        return F.col(rule.column).isNull()
    return F.coalesce(~F.expr(rule.condition), F.lit(False))


def row_violations(df: DataFrame, rules: list[Check | NotNull]) -> DataFrame:
    """(rule, violations) for all row rules of one table, in one scan."""
    counts = df.agg(*[F.count_if(violated(r)).alias(f"v{i}") for i, r in enumerate(rules)])
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(f"v{i}").alias("violations")) for i, r in enumerate(rules)]
    return counts.select(F.inline(F.array(*pairs)))


def orphans(child: DataFrame, parent: DataFrame, rule: ForeignKey) -> DataFrame:
    """Child keys without a parent, with the number of child rows that use them."""
    used = child.filter(F.col(rule.column).isNotNull()).groupBy(F.col(rule.column).alias("key")).agg(F.count("*").alias("n"))
    return used.join(parent.select(F.col(rule.parent_column).alias("key")), "key", "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, rule: ForeignKey) -> DataFrame:
    total = F.coalesce(F.sum("n"), F.lit(0)).alias("violations")
    return orphans(child, parent, rule).agg(total).select(F.lit(rule.name).alias("rule"), "violations")


def duplicates(df: DataFrame, rule: Unique) -> DataFrame:
    return df.groupBy(*rule.columns).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_count(df: DataFrame, rule: Unique) -> DataFrame:
    """Number of keys that occur more than once."""
    return duplicates(df, rule).agg(F.count("*").alias("violations")).select(F.lit(rule.name).alias("rule"), "violations")


def dq_report(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(rule, table_name, violations, expected, status) for every rule."""
    parts: list[DataFrame] = []
    for table in dict.fromkeys(r.table for r in rules):
        df = tables[table]
        mine = [r for r in rules if r.table == table]
        per_row = [r for r in mine if isinstance(r, (Check, NotNull))]
        found = [row_violations(df, per_row)] if per_row else []
        found += [orphan_count(df, tables[r.parent], r) for r in mine if isinstance(r, ForeignKey)]
        found += [duplicate_count(df, r) for r in mine if isinstance(r, Unique)]
        parts += [f.withColumn("table_name", F.lit(table)) for f in found]
    return reduce(DataFrame.unionByName, parts).select(
        "rule",
        "table_name",
        "violations",
        F.lit(0).cast("bigint").alias("expected"),
        F.when(F.col("violations") == 0, "ok").otherwise("VIOLATED").alias("status"),
    )


def split_valid(df: DataFrame, rules: list[Check | NotNull]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all row rules, and the others with the names of the rules they break."""
    names = F.filter(F.array(*[F.when(violated(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    marked = df.withColumn("broken_rules", names)
    return marked.filter("size(broken_rules) = 0").drop("broken_rules"), marked.filter("size(broken_rules) > 0")


def require_valid(df: DataFrame, rules: list[Check | NotNull]) -> DataFrame:
    """Same rows, but the job fails on the first row that breaks a rule. Use right before a write."""
    broken = reduce(lambda acc, r: acc.when(violated(r), F.lit(r.name)), rules[1:], F.when(violated(rules[0]), F.lit(rules[0].name)))
    return df.filter(F.when(broken.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("rule violated: "), broken)).cast("boolean")))


# What the chi-square statistic stays below in 95 of 100 samples that follow the target, by degrees of freedom.
CHI_SQUARE_95 = {1: 3.841, 2: 5.991, 3: 7.815, 4: 9.488, 5: 11.070, 6: 12.592, 7: 14.067, 8: 15.507, 9: 16.919, 10: 18.307}


def goodness_of_fit(df: DataFrame, label: str, targets: dict[str, int]) -> DataFrame:
    """How well the labels follow target percentages (above zero, 100 together), beyond what chance explains.

    One row: rows with a known label, rows with another or none, the chi-square statistic of the known ones, its 95 % bound and
    the verdict: ``fits``, ``drift``, or ``drift`` whenever there are unknown labels; ``no rows`` without any. Labels are counted in one grouped
    pass over at most one group per target and one for the rest. The statistic is one division of whole numbers, so it
    does not depend on the order of rows.
    """
    if sum(targets.values()) != 100 or min(targets.values()) <= 0:
        raise ValueError("targets must be above zero and add up to 100")
    whole = "decimal(38,0)"
    scale = lcm(*targets.values())
    known = F.when(F.col(label).isin(list(targets)), F.col(label))
    counted = df.groupBy(known.alias("label")).agg(F.count("*").alias("n"))
    n = F.col("n").cast("decimal(18,0)")
    weight = reduce(lambda acc, k: acc.when(F.col("label") == k, F.lit(100 * scale // targets[k])), list(targets)[1:], F.when(F.col("label") == next(iter(targets)), F.lit(100 * scale // targets[next(iter(targets))])))
    sums = counted.agg(
        F.coalesce(F.sum(F.when(F.col("label").isNotNull(), F.col("n"))), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("label").isNull(), F.col("n"))), F.lit(0)).alias("unknown"),
        F.sum((n * n).cast("decimal(30,0)") * weight.cast("decimal(8,0)")).cast(whole).alias("_squares"),
    )
    rows = F.col("n_rows").cast("decimal(15,0)")
    over = (F.col("_squares") - (rows * rows).cast("decimal(30,0)") * F.lit(scale).cast("decimal(8,0)")).cast(whole)
    chi = F.when(F.col("n_rows") > 0, over.cast("double") / (F.col("n_rows") * scale).cast("double"))
    bound = CHI_SQUARE_95[len(targets) - 1]
    verdict = (
        F.when((F.col("n_rows") == 0) & (F.col("unknown") == 0), "no rows")
        .when((F.col("unknown") > 0) | (F.col("chi_square") > bound), "drift")
        .otherwise("fits")
    )
    return sums.select("n_rows", "unknown", chi.alias("chi_square")).withColumns({"bound": F.lit(bound), "verdict": verdict})
