"""Writers: typed appends, full refresh, incremental append and partitioned facts.

All write parquet. Each takes a declared schema and row rules: rows are cast and checked before they are written, and a
value that does not fit its type (ANSI casts), a missing required one or a broken rule fails the job. With a guard (see
``guards``) keys and references are checked against the tables that are there, too; rows that break them stop the write, or go
to a folder of rejected rows. Whole partitions are archived by ``archive.SlidingArchive``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from ..operators.quality import Check, NotNull, require_valid
from ..session import run_root
from . import storage
from .guards import Guard, SetRuleViolated, audit, guarded


def run_folder(spark: SparkSession, name: str) -> str:
    """New folder of this run, below the one that ``session.drop_run`` removes."""
    return f"{run_root(spark)}/runs/{name}-{uuid.uuid4().hex}"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema, in its order and types; required columns must not be null."""
    out = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"null in required column {f.name}")).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def checked(df: DataFrame, schema: T.StructType | None = None, rules: Sequence[Check | NotNull] = ()) -> DataFrame:
    """The rows in the declared types; the job fails on a missing required value or on a row that breaks a rule."""
    typed = conform(df, schema) if schema is not None else df
    return require_valid(typed, list(rules)) if rules else typed


def one_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. The rank filter is also applied before the shuffle, so a frequent key sends one row per task."""
    ranked = rows.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def _there(df: DataFrame, path: str) -> DataFrame | None:
    return df.sparkSession.read.parquet(path) if storage.exists(df.sparkSession, path) else None


def append_fact(
    df: DataFrame, path: str, schema: T.StructType, rules: Sequence[Check | NotNull] = (), guard: Guard | None = None, rejected: str | None = None
) -> None:
    guarded(checked(df, schema, rules), guard, _there(df, path) if guard else None, rejected).write.mode("append").parquet(path)


def full_refresh(
    df: DataFrame, path: str, schema: T.StructType | None = None, rules: Sequence[Check | NotNull] = (), guard: Guard | None = None
) -> None:
    """Replaces the table. With a guard the new table is written aside, audited there, and only then takes the old one's place."""
    rows, spark = checked(df, schema, rules), df.sparkSession
    if guard is None:
        rows.write.mode("overwrite").parquet(path)
        return
    aside = f"{path}-aside-{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    try:
        audit(spark.read.schema(rows.schema).parquet(aside), guard)
    except SetRuleViolated:
        storage.remove(spark, aside)
        raise
    storage.remove(spark, path)
    storage.move(spark, aside, path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: str,
    mode: str = "append",
    schema: T.StructType | None = None,
    rules: Sequence[Check | NotNull] = (),
    guard: Guard | None = None,
    rejected: str | None = None,
) -> None:
    """One folder per value of ``by``.

    The rebalance hint groups rows by folder, so a task does not open every folder, and lets the
    runtime split a folder that holds a large part of the table.
    """
    rows = guarded(checked(df, schema, rules), guard, _there(df, path) if guard and mode == "append" else None, rejected)
    rows.hint("rebalance", F.col(by)).write.mode(mode).partitionBy(by).parquet(path)


def incremental_append(
    new: DataFrame,
    path: str,
    key: str,
    watermark: str,
    schema: T.StructType | None = None,
    rules: Sequence[Check | NotNull] = (),
    guard: Guard | None = None,
    rejected: str | None = None,
) -> None:
    """Append the rows whose key the target does not have, each key once; late rows are appended too.

    Of several rows with one key the earliest is taken, of equal ones the row that sorts first, so a rerun takes the same one.
    Target rows from the batch's lowest watermark on take part in the anti-join; that bound is a literal, so it is pushed
    down to the scan. A batch without old rows so reads only the edge of the target. A row keeps its key and its
    watermark, so an earlier target row cannot be the same one. Rows without a watermark are compared with all such rows.
    Rows that change after they are loaded go through ``upsert.upsert``.
    """
    spark = new.sparkSession
    target = spark.read.parquet(path)
    low = new.agg(F.min(watermark).alias("low")).first()["low"]
    touched = F.col(watermark).isNull() if low is None else F.col(watermark).isNull() | (F.col(watermark) >= F.lit(low))
    present = target.filter(touched).select(key).distinct()
    order = [F.col(c).asc_nulls_last() for c in (watermark, *[c for c in new.columns if c not in (key, watermark)])]
    fresh = one_per_key(new.join(present, key, "left_anti"), [key], order)
    guarded(checked(fresh, schema, rules), guard, target if guard else None, rejected).write.mode("append").parquet(path)


def archive_before(df: DataFrame, by: str, first_kept: object) -> tuple[DataFrame, DataFrame]:
    """The rows of a table that a sliding window keeps, and those before it."""
    return df.filter(F.col(by) >= first_kept), df.filter(F.col(by) < first_kept)
