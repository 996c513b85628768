"""Header and detail tables that are stored ready to be joined.

Both are dealt into the same buckets by the join key and sorted in them, so a join reads bucket by bucket without a shuffle of either
side; it pays the shuffle once, at writing. A bucket is one task, so keys that hold more detail rows than an average bucket are kept
apart: there are at most as many of them as buckets, their headers are broadcast and their details read in any split.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import freeze
from . import storage


class CoBuckets:
    def __init__(self, spark: SparkSession, folder: str, on: dict[str, str], buckets: int):
        """``on``: detail column to header column. Headers have one row per key."""
        self.spark, self.folder, self.on, self.buckets = spark, folder, dict(on), buckets
        self.name = f"cobuckets_{uuid.uuid4().hex}"

    def _bucketed(self, df: DataFrame, part: str, keys: list[str]) -> None:
        """One file per bucket: the shuffle deals rows as the buckets do."""
        out = df.repartition(self.buckets, *keys).write.bucketBy(self.buckets, *keys).sortBy(*keys)
        out.option("path", f"{self.folder}/{part}").format("parquet").saveAsTable(f"{self.name}_{part}")

    def write(self, headers: DataFrame, details: DataFrame) -> None:
        mine, theirs = list(self.on), list(self.on.values())
        full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in mine])
        counts = details.groupBy(*mine).agg(F.count("*").alias("_n"))
        bar = details.agg(F.count("*")).scalar() / F.lit(self.buckets)
        hot = freeze(counts.filter(full & (F.col("_n") > bar)).select(*[F.col(c).alias(f"_h_{i}") for i, c in enumerate(mine)]))  # fewer than buckets

        def split(df: DataFrame, keys: list[str], how: str) -> DataFrame:
            on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_h_{i}") for i, c in enumerate(keys)])
            return df.join(F.broadcast(hot), on, how)

        self._bucketed(split(headers, theirs, "left_anti"), "headers", theirs)
        self._bucketed(split(details, mine, "left_anti"), "details", mine)
        split(headers, theirs, "left_semi").write.parquet(f"{self.folder}/hot_headers")
        split(details, mine, "left_semi").write.parquet(f"{self.folder}/hot_details")

    def parts(self) -> tuple[DataFrame, DataFrame]:
        """The join (inner) of ordinary keys, which needs no shuffle, and that of keys with very many details. No key is in both."""
        read, parquet = self.spark.table, self.spark.read.parquet

        def met(d: DataFrame, h: DataFrame, hint: str) -> DataFrame:
            return d.join(h.hint(hint), reduce(lambda a, b: a & b, [d[x] == h[y] for x, y in self.on.items()]))

        cold = met(read(f"{self.name}_details"), read(f"{self.name}_headers"), "merge")
        # fewer headers than buckets
        return cold, met(parquet(f"{self.folder}/hot_details"), parquet(f"{self.folder}/hot_headers"), "broadcast")

    def join(self) -> DataFrame:
        """Details with their headers (inner)."""
        return reduce(DataFrame.unionByName, self.parts())

    def drop(self) -> None:
        for part in ("headers", "details"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{part}")
        storage.remove(self.spark, self.folder)
