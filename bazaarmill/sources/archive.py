"""Sliding archive: whole partitions move between a live table and its archive.

A partition is a folder, so it moves by a rename and no row is read. A manifest holds every range that was moved: partition, rows (from the
files' footers), files, bytes, direction and state. An entry is written as ``moving`` before the rename and as ``done`` after it;
``recover`` finishes moves that broke off in between. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import storage

MANIFEST = "seq bigint, partition string, direction string, n_rows bigint, files bigint, bytes bigint, state string"


class SlidingArchive:
    def __init__(self, spark: SparkSession, live: str, archive: str, by: str, schema):
        """``schema``: the table's columns, the partition column included."""
        self.spark, self.live, self.archive, self.by, self.schema = spark, live, archive, by, schema

    def _entries(self) -> DataFrame:
        path = f"{self.archive}/_manifest"
        return self.spark.read.schema(MANIFEST).parquet(path) if storage.exists(self.spark, path) else self.spark.createDataFrame([], MANIFEST)

    def manifest(self) -> DataFrame:
        """One row per move, in its last state (``done`` sorts before ``moving``)."""
        e = self._entries()
        return e.groupBy(*[c for c in e.columns if c != "state"]).agg(F.min("state").alias("state"))

    def _note(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.archive}/_manifest")

    def _places(self, direction: str) -> tuple[str, str]:
        return (self.live, self.archive) if direction == "out" else (self.archive, self.live)

    def _move(self, texts: list[str], direction: str) -> list[str]:
        source, target = self._places(direction)
        there = storage.partition_values(self.spark, source, self.by)
        texts = [t for t in texts if t in there]
        if not texts:
            return []
        seq = self._entries().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
        rows = []
        for i, t in enumerate(texts):
            folder = f"{source}/{there[t]}"
            n = self.spark.read.parquet(folder).count()  # answered from the footers
            rows.append((seq + i + 1, t, direction, n, *storage.usage(self.spark, folder), "moving"))
        self._note(rows)
        for t in texts:
            storage.move(self.spark, f"{source}/{there[t]}", f"{target}/{there[t]}")
        self._note([(*r[:-1], "done") for r in rows])
        return texts

    def slide(self, first_kept) -> list[str]:
        """Archives the partitions below ``first_kept``; returns their values as text."""
        kind = dict(self.schema_types())[self.by]
        texts = sorted(storage.partition_values(self.spark, self.live, self.by))
        if not texts:
            return []
        old = self.spark.createDataFrame([(t,) for t in texts], "t string").filter(F.col("t").cast(kind) < F.lit(first_kept).cast(kind))
        return self._move([r["t"] for r in old.orderBy(F.col("t").cast(kind)).collect()], "out")

    def restore(self, values: list) -> list[str]:
        """Brings archived partitions back; values that are not in the archive are passed over."""
        return self._move([str(v) for v in values], "back")

    def recover(self) -> list[str]:
        """Finishes moves that were noted and not done."""
        open_ = [tuple(r) for r in self.manifest().filter("state = 'moving'").orderBy("seq").collect()]
        for r in open_:
            source, target = self._places(r[2])
            name = storage.partition_folder(self.spark, self.by, r[1])
            if storage.exists(self.spark, f"{source}/{name}"):
                storage.move(self.spark, f"{source}/{name}", f"{target}/{name}")
        if open_:
            self._note([(*r[:-1], "done") for r in open_])
        return [r[1] for r in open_]

    def schema_types(self) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in self.schema.fields]

    def _read(self, path: str) -> DataFrame:
        if not storage.partition_values(self.spark, path, self.by):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(path).select(*self.schema.fieldNames())

    def current(self) -> DataFrame:
        return self._read(self.live)

    def archived(self, values: list | None = None) -> DataFrame:
        """Archived rows; with ``values`` only their folders are read."""
        rows = self._read(self.archive)
        return rows if values is None else rows.filter(F.col(self.by).isin(values))
