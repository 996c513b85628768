"""Helpers that the operators share: byte-level words, stored tables, connected components."""

from __future__ import annotations

import sys
import types
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import run_root


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, so that later steps do not repeat the plan above."""
    spark = df.sparkSession
    path = f"{run_root(spark)}/llm/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_in_worker(key: str, make):
    """What ``make`` gives, made once in each Python worker and kept there for its next tasks, until another key is asked for.

    Functions reach a worker by value with each task, so it is kept beside them, in a module of the worker's own.
    """
    place = sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker")).__dict__
    if place.get("key") != key:
        place.pop("value", None)
        place["value"], place["key"] = make(), key
    return place["value"]


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased; null has none.

    ``bytes.lower`` and ``bytes.split`` touch exactly A-Z and exactly these six white-space bytes.
    """
    return utf8(text).lower().split()


def remainder(doc_id, divisor: int) -> int:
    """crc32 of the id as text, modulo ``divisor``: the fixed split of documents into folds. Null counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(int(doc_id)).encode()) % divisor


def fold(column: str, divisor: int):
    """The same split as a column expression."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest member of each connected component: rows (node, component) for every node that has an edge.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type. Large-star and small-star steps alternate: each moves
    edges towards the smallest known neighbour, so a chain of n nodes takes about log n rounds. A round is joins and
    aggregations on the node; its edges are written to the shared folder. A hub's rows meet only its single minimum, so
    skewed joins can be split, and nothing is gathered per node.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        moved = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = stored(moved.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            roots = current.select(F.col("b").alias("node")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component"))
            )
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
