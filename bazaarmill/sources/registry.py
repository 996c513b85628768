"""Surrogate keys that last: a stored registry of natural keys, continued by each load.

A load gives keys only to natural keys that the registry does not have, from its highest key on and in a stated order. Each load is a
folder that is filled aside and then renamed into place, so a load that broke off leaves nothing, and repeating a load gives
the same keys. One writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.keys import with_surrogate_key
from . import storage


class KeyRegistry:
    def __init__(self, spark: SparkSession, path: str, natural: Sequence[str], key: str, schema: str):
        """``schema``: DDL of the natural columns."""
        self.spark, self.path, self.natural, self.key = spark, path, list(natural), key
        self.schema = f"{schema}, {key} bigint"

    def loads(self) -> list[int]:
        return sorted(int(m[1]) for n in storage.folders(self.spark, self.path) if (m := re.fullmatch(r"load=(\d+)", n)))

    def keys(self) -> DataFrame:
        """(natural columns, key, load) of all loads."""
        if not self.loads():
            return self.spark.createDataFrame([], self.schema + ", load int")
        return self.spark.read.schema(self.schema + ", load int").parquet(self.path)

    def _match(self, rows: DataFrame, known: DataFrame, columns: Sequence[str]):
        on = F.lit(True)
        for c, n in zip(columns, self.natural):
            on = on & rows[c].eqNullSafe(known[n])
        return on

    def register(self, rows: DataFrame, order: Sequence[str] | None = None) -> int:
        """Gives keys to the natural keys of ``rows`` that have none yet; returns how many.

        New keys follow ``order`` (columns of ``rows``, by default the natural key); a natural key that comes several times takes its
        first place. Rows with one natural key meet in an aggregate, so a frequent one costs a task no more than another.
        """
        order = [c for c in (order or []) if c not in self.natural]
        first = rows.groupBy(*self.natural).agg(*[F.min(c).alias(c) for c in order], F.count("*").alias("_n")).drop("_n")
        known = self.keys()
        fresh = first.join(known, self._match(first, known, self.natural), "left_anti")
        start = (known.agg(F.max(self.key)).first()[0] or 0) + 1
        keyed = with_surrogate_key(fresh, [*order, *self.natural], self.key, start).select(*self.natural, self.key)
        aside = f"{self.path}/_aside-{uuid.uuid4().hex}"  # readers skip names that start with an underscore
        keyed.write.parquet(aside)
        added = self.spark.read.schema(self.schema).parquet(aside).count()
        if added:
            storage.move(self.spark, aside, f"{self.path}/load={(self.loads() or [0])[-1] + 1}")
        else:
            storage.remove(self.spark, aside)
        return added

    def attach(self, rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """``rows`` with the key of the natural key in ``columns``; null where the registry has none.

        A plain sort-merge join, so the runtime can split a natural key that owns very many rows.
        """
        known = self.keys()
        on = self._match(rows, known, columns or self.natural)
        return rows.join(known, on, "left").select(*[rows[c] for c in rows.columns], known[self.key])
