"""Running totals and row numbers that do not put a whole key into one task.

A plain window sends every row of a key to one task, which fails when a key holds a third of the
table. Here the rows are range partitioned on (key, order), so a hot key is cut into as many segments
as its size asks for. Each segment is totalled on its own and starts from the total of the segments
before it. Because segments follow the sort order, only the first key of a segment can have rows in
an earlier one: the carry table never has more rows than there are segments, whatever the data.

The segment number must be the same in both uses of the rows, so they are written to the checkpoint
folder in between; a lost executor then re-reads its segment instead of re-sampling the ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import freeze, partitions

SEGMENT = "_segment"


def segments(df: DataFrame, keys: list[str], order: list[str], count: int | None = None) -> DataFrame:
    """Rows tagged with a stable segment number that follows the (keys, order) sort order."""
    n = count or partitions(df.sparkSession)
    ranged = df.repartitionByRange(n, *keys, *order)
    return freeze(ranged.withColumn(SEGMENT, F.spark_partition_id()))


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, Column],
    count: int | None = None,
) -> DataFrame:
    """Add inclusive running sums per key. ``order`` must be unique within a key."""
    rows = segments(df.withColumns({f"_v_{n}": c for n, c in totals.items()}), keys, order, count)
    per_segment = rows.groupBy(*keys, SEGMENT).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals])
    earlier = W.partitionBy(*keys or [F.lit(0)]).orderBy(SEGMENT)
    carry = (
        per_segment.withColumns(
            {f"_c_{n}": F.sum(f"_s_{n}").over(earlier.rowsBetween(W.unboundedPreceding, -1)) for n in totals}
            | {"_nth": F.row_number().over(earlier)}
        )
        .filter("_nth > 1")  # at most one key per segment
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(SEGMENT).alias("_k_seg"), *[f"_c_{n}" for n in totals])
    )
    inside = W.partitionBy(*keys, SEGMENT).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumns({f"_r_{n}": F.sum(f"_v_{n}").over(inside) for n in totals})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col(SEGMENT) == F.col("_k_seg")]
    joined = local.join(F.broadcast(carry), reduce(lambda a, b: a & b, same), "left")
    types = {f.name: f.dataType for f in rows.schema.fields}
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_r_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0).cast(types[f"_v_{n}"]))).alias(n)
            for n in totals
        ],
    )


def row_numbers(df: DataFrame, keys: list[str], order: list[str], name: str, start: int = 1) -> DataFrame:
    """1, 2, 3 ... per key (or over the whole table when ``keys`` is empty)."""
    out = running(df, keys, order, {name: F.lit(1).cast("bigint")})
    return out if start == 1 else out.withColumn(name, F.col(name) + (start - 1))
