"""Keys and references that hold at the time of writing: orphans and duplicates do not get into a table.

A batch is compared with what is there already: its unique keys with the keys of the target, its references with the keys of the parent.
Both may be far larger than the batch. So the batch's distinct keys are written as a bitmap of hashes, and rows of the large
side pass only if their bit is set; what passes is compared exactly. The bitmap is ``BITS_PER_KEY`` bits per key, at most ``MOST_WORDS``
words of 64 bits; beyond that it lets more rows pass, and the exact comparison still decides.

Of rows in the batch with one key the first in a stated order is good. Keys that break a rule are found as distinct keys, so a key with very
many rows is one row until its rows are marked.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.quality import ForeignKey, Unique
from ..session import freeze

BITS_PER_KEY = 16
MOST_WORDS = 1 << 20


@dataclass(frozen=True)
class Guard:
    """Set rules of one table: ``unique`` keys, ``references`` and the ``parents`` they point to, by table name."""

    unique: Sequence[Unique] = ()
    references: Sequence[ForeignKey] = ()
    parents: dict[str, DataFrame] = field(default_factory=dict)
    #: Order in which rows with one key are taken; by default all columns.
    order: Sequence[str] = ()


def _hash(columns: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def may_contain(rows: DataFrame, columns: Sequence[str], keys: DataFrame) -> DataFrame:
    """The rows whose key may be among ``keys`` (distinct, not null, columns named ``k0``, ``k1`` ...). No row with such a key is lost."""
    n = keys.count()
    bits = 64
    while bits < min(n * BITS_PER_KEY, MOST_WORDS * 64):
        bits *= 2
    names = [f"k{i}" for i in range(len(columns))]
    spot = _hash(names, bits)
    words = keys.select(spot.alias("_spot")).select(F.shiftright("_spot", 6).alias("_word"), F.expr("shiftleft(1L, cast(_spot & 63 as int))").alias("_bit"))
    bitmap = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))  # at most MOST_WORDS rows
    mine = rows.withColumn("_spot", _hash(columns, bits))
    met = mine.join(F.broadcast(bitmap), F.shiftright("_spot", 6) == F.col("_word"))
    return met.filter("shiftrightunsigned(_bits, cast(_spot & 63 as int)) & 1 = 1").select(*rows.columns)


def _keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct keys without a null (a null is neither a duplicate nor an orphan), in columns ``k0``, ``k1`` ..."""
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.filter(full).select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)]).distinct()


def orphan_keys(batch: DataFrame, rule: ForeignKey, parent: DataFrame) -> DataFrame:
    """(k0) of the references that the parent does not have."""
    used = freeze(_keys(batch, [rule.column]))
    types = used.schema["k0"].dataType
    there = parent.select(F.col(rule.parent_column).cast(types).alias("k0"))
    return used.join(may_contain(there, ["k0"], used), "k0", "left_anti")


def taken_keys(batch: DataFrame, rule: Unique, target: DataFrame) -> DataFrame:
    """(k0, k1 ...) of the batch's keys that the target has already."""
    new = freeze(_keys(batch, rule.columns))
    names = new.columns
    there = target.select(*[F.col(c).cast(new.schema[n].dataType).alias(n) for c, n in zip(rule.columns, names)])
    return new.join(may_contain(there, names, new), names, "left_semi")


def repeated_keys(batch: DataFrame, rule: Unique) -> DataFrame:
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.columns])
    keys = batch.filter(full).groupBy(*[F.col(c).alias(f"k{i}") for i, c in enumerate(rule.columns)]).agg(F.count("*").alias("_n"))
    return keys.filter("_n > 1").drop("_n")


def _mark(rows: DataFrame, columns: Sequence[str], keys: DataFrame, mark: str) -> DataFrame:
    """Adds a boolean: the row's key is among ``keys``, and the row is not the key's ``_first``. A sort-merge join splits a key with very many rows."""
    first = [c for c in keys.columns if c == "_first"]
    k = keys.select(*[F.col(f"k{i}").alias(f"_k{i}") for i in range(len(columns))], *first, F.lit(True).alias("_hit"))
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(columns)])
    hit = F.coalesce("_hit", F.lit(False))
    return rows.join(k, on, "left").select(*rows.columns, (hit & ~F.col("_any").eqNullSafe(F.col("_first")) if first else hit).alias(mark))


def broken_keys(batch: DataFrame, rule: Unique, order: Sequence[str], target: DataFrame | None) -> DataFrame:
    """(k0, k1 ..., _first) of the keys that come again in the batch or that the target has.

    ``_first`` is the ``_any`` of the row that is good, the least in ``order``; null if the target has the key.
    """
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.columns])
    names = [f"k{i}" for i in range(len(rule.columns))]
    least = F.min(F.struct(*order, "_any"))["_any"].alias("_first")
    keys = batch.filter(full).groupBy(*[F.col(c).alias(n) for c, n in zip(rule.columns, names)]).agg(F.count("*").alias("_n"), least)
    if target is None:
        return keys.filter("_n > 1").drop("_n")
    keys = freeze(keys)
    there = target.select(*[F.col(c).cast(keys.schema[n].dataType).alias(n) for c, n in zip(rule.columns, names)])
    taken = may_contain(there, names, keys.select(*names)).distinct().withColumn("_taken", F.lit(True))
    return keys.join(taken, names, "left").filter("_n > 1 or _taken").select(*names, F.when(F.col("_taken").isNull(), F.col("_first")).alias("_first"))


def examine(batch: DataFrame, guard: Guard, target: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the others with the names of the rules they break (``broken_rules``).

    The rules' broken keys are found first. Rows then meet them once for each rule, and no row is moved to be numbered.
    """
    columns = batch.columns
    source = freeze(batch.withColumn("_any", F.monotonically_increasing_id()))
    rows, names = source, []

    def add(mark: str, name: str) -> None:
        names.append(F.when(F.col(mark), F.lit(name)))

    for i, r in enumerate(guard.references):
        rows = _mark(rows, [r.column], orphan_keys(source, r, guard.parents[r.parent]), f"_r{i}")
        add(f"_r{i}", r.name)
    for i, u in enumerate(guard.unique):
        order = [c for c in (guard.order or columns) if c not in u.columns]
        rows = _mark(rows, u.columns, broken_keys(source, u, order, target), f"_d{i}")
        add(f"_d{i}", u.name)
    found = F.array_distinct(F.filter(F.array(*names), lambda x: x.isNotNull())) if names else F.array().cast("array<string>")
    marked = freeze(rows.select(*columns, found.alias("broken_rules")))
    return marked.filter("size(broken_rules) = 0").drop("broken_rules"), marked.filter("size(broken_rules) > 0")


class SetRuleViolated(ValueError):
    """A batch holds orphans or duplicates; ``counts`` has the rows per rule."""

    def __init__(self, counts: dict[str, int]):
        super().__init__("set rules violated: " + ", ".join(f"{k} ({n} rows)" for k, n in sorted(counts.items())))
        self.counts = counts


def audit(stored: DataFrame, guard: Guard, target: DataFrame | None = None) -> None:
    """Fails with the broken rules and their rows. ``stored`` must be a table: its key columns are read, once per rule.

    Rows are marked and counted only if some key breaks a rule.
    """
    for r in guard.references:
        if not orphan_keys(stored, r, guard.parents[r.parent]).isEmpty():
            break
    else:
        for u in guard.unique:
            if not repeated_keys(stored, u).isEmpty() or target is not None and not taken_keys(stored, u, target).isEmpty():
                break
        else:
            return
    _, bad = examine(stored, guard, target)
    rows = bad.select(F.explode("broken_rules").alias("rule")).groupBy("rule").agg(F.count("*").alias("n")).collect()
    raise SetRuleViolated({r["rule"]: r["n"] for r in rows})


def guarded(batch: DataFrame, guard: Guard | None, target: DataFrame | None = None, rejected: str | None = None) -> DataFrame:
    """The rows to write. Without ``rejected`` any broken rule stops the write; with it, such rows go to that folder instead."""
    if guard is None or not (guard.unique or guard.references):
        return batch
    if rejected is not None:
        good, bad = examine(batch, guard, target)
        bad.write.mode("append").parquet(rejected)
        return good
    rows = freeze(batch)
    audit(rows, guard, target)
    return rows
