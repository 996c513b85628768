"""Refresh of a partitioned fact whose rows change after they are loaded, such as items that are sold later.

A batch holds new rows and newer versions of old ones. Only partitions that a change touches are read whole and written; the
others are neither read (but for the key lookup, two columns) nor rewritten. The result depends on the rows that were ever loaded
and not on their order: per key the highest version stays, and of equal versions the row that sorts last. So late rows
change nothing, a batch that is loaded twice changes nothing, and a load that broke off is made good by loading it again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.quality import Check, NotNull
from ..session import freeze
from . import storage
from .guards import Guard, audit
from .sinks import checked, one_per_key


def latest(rows: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key: the highest version, of equal ones the row that sorts last."""
    rest = [c for c in rows.columns if c not in (*keys, version)]
    return one_per_key(rows, keys, [F.col(c).desc_nulls_last() for c in (version, *rest)])


def _same_key(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def _in(column: str, values: Sequence[object]):
    """The column is one of the values (null included); literals, so the scan skips all other folders."""
    known = [v for v in values if v is not None]
    found = F.col(column).isin(known) if known else F.lit(False)
    return found | F.col(column).isNull() if None in values else found


def upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    version: str,
    by: str,
    rules: Sequence[Check | NotNull] = (),
    moves: bool = True,
    guard: Guard | None = None,
) -> list[object]:
    """Merges the batch into the table at ``path``, partitioned by ``by``; returns the partition values that were written.

    ``guard`` may hold references; an orphan in the batch stops the merge. Keys are unique by the merge itself. ``moves=False`` promises that a key never changes its partition; the lookup of keys in untouched partitions is then left out.
    The partition values of a batch are collected: they are folders, not rows.
    """
    spark, names = batch.sparkSession, batch.columns
    new = freeze(checked(latest(batch, keys, version), batch.schema, rules))
    if guard is not None:
        audit(new, Guard(references=guard.references, parents=guard.parents))
    if not storage.exists(spark, path):
        new.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(path)
        return sorted((r[by] for r in new.select(by).distinct().collect()), key=str)

    old = spark.read.schema(batch.schema).parquet(path).select(*names)
    touched = {r[by] for r in new.select(by).distinct().collect()}
    if moves:
        # partitions that the batch touches anyway are read below; only keys of the others are looked up
        held = old.filter(~F.coalesce(_in(by, list(touched)), F.lit(False))).select(*keys, by)
        touched |= {r[by] for r in held.join(new.select(*keys), _same_key(held, new, keys), "left_semi").select(by).distinct().collect()}
    here = old.filter(_in(by, list(touched)))

    compared = [version, *[c for c in names if c not in (*keys, version)]]

    def row(df: DataFrame):
        return F.struct(*[df[c] for c in compared])

    o = here.select(*[F.col(c).alias(f"_o_{c}") for c in names], F.lit(True).alias("_there"))
    on = F.lit(True)
    for k in keys:
        on = on & new[k].eqNullSafe(o[f"_o_{k}"])
    before = F.struct(*[F.col(f"_o_{c}").alias(c) for c in compared])
    met = new.join(o, on, "left").select(*[new[c] for c in names], F.col(f"_o_{by}").alias("_from"), "_there", (row(new) > before).alias("_newer"))
    effect = freeze(met.filter(F.col("_there").isNull() | F.col("_newer")))
    write = {x for r in effect.select(by, "_from", "_there").distinct().collect() for x in ([r[by], r["_from"]] if r["_there"] else [r[by]])}
    if not write:
        return []

    changed = effect.select(*names).distinct()
    kept = here.filter(_in(by, list(write)))
    merged = kept.join(changed, _same_key(kept, changed, keys), "left_anti").unionByName(changed)
    # written aside in its folders, as it is read from the table that it changes; then the folders take their places
    aside = f"{path}-aside-{uuid.uuid4().hex}"
    merged.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(aside)
    null = storage.partition_folder(spark, by, None)
    filled, written = set(storage.partition_values(spark, aside, by)), storage.folders(spark, aside)
    for name in written:
        storage.remove(spark, f"{path}/{name}")
        storage.move(spark, f"{aside}/{name}", f"{path}/{name}")
    storage.remove(spark, aside)
    texts = {r["t"] for r in effect.select(F.explode(F.array(F.col(by).cast("string"), F.col("_from").cast("string"))).alias("t")).distinct().collect()}
    for value in texts - filled:  # all rows of such a partition moved to others
        if value is not None:
            storage.remove(spark, f"{path}/{storage.partition_folder(spark, by, value)}")
    if None in write and null not in written:
        storage.remove(spark, f"{path}/{null}")
    return sorted(write, key=str)
