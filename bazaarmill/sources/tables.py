"""Typed views of the source tables.

Money columns become exact decimals on read. Nothing is cached: each query prunes columns and pushes
filters to its own scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.money import amount

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
#: With the tables that no retail query uses, but that counts cover.
ALL_NAMES = (*NAMES, "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def spread(self, name: str, *keys: str) -> DataFrame:
        """The typed view, over all cores when the table's files make fewer splits than there are.

        For work that costs much per row. A table of normal size has far more splits than cores and is
        read as it is, without a shuffle.
        """
        df = self.raw(name)
        cores = self.spark.sparkContext.defaultParallelism
        return TYPED[name](df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys))

    @cached_property
    def region(self) -> DataFrame:
        return self.raw("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.raw("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return customer(self.raw("customer"))

    @cached_property
    def supplier(self) -> DataFrame:
        return supplier(self.raw("supplier"))

    @cached_property
    def part(self) -> DataFrame:
        return part(self.raw("part"))

    @cached_property
    def orders(self) -> DataFrame:
        return orders(self.raw("orders"))

    @cached_property
    def lineitem(self) -> DataFrame:
        return lineitem(self.raw("lineitem"))

    @cached_property
    def events(self) -> DataFrame:
        return events(self.raw("events"))

    @cached_property
    def lineitem_spread(self) -> DataFrame:
        return self.spread("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

    @cached_property
    def orders_spread(self) -> DataFrame:
        return self.spread("orders", "o_orderkey")

    @cached_property
    def customer_spread(self) -> DataFrame:
        return self.spread("customer", "c_custkey")

    @cached_property
    def supplier_spread(self) -> DataFrame:
        return self.spread("supplier", "s_suppkey")


def customer(df: DataFrame) -> DataFrame:
    return df.withColumn("c_acctbal", amount("c_acctbal"))


def supplier(df: DataFrame) -> DataFrame:
    return df.withColumn("s_acctbal", amount("s_acctbal"))


def part(df: DataFrame) -> DataFrame:
    return df.withColumn("p_retailprice", amount("p_retailprice"))


def orders(df: DataFrame) -> DataFrame:
    return df.withColumns({"o_totalprice": amount("o_totalprice"), "o_date": F.to_date("o_orderdate")})


def lineitem(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "l_quantity": F.col("l_quantity").cast("int"),
            "l_extendedprice": amount("l_extendedprice"),
            "l_discount": F.col("l_discount").cast("decimal(4,2)"),
            "l_tax": F.col("l_tax").cast("decimal(4,2)"),
            "l_date": F.to_date("l_shipdate"),
            "l_row": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        }
    )


def events(df: DataFrame) -> DataFrame:
    return df.withColumns({"value": amount("value"), "e_date": F.to_date("ts")})


TYPED = {"customer": customer, "supplier": supplier, "part": part, "orders": orders, "lineitem": lineitem, "events": events}
