"""Skewed keys: results stay exact and the work of the hot key is divided."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from bazaarmill.operators import ordered, skew
from bazaarmill.operators.keys import link_children, with_surrogate_key


def skewed(spark, n=6000):
    """A third of the rows belongs to key 0."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"),
        (F.xxhash64("id") % 1000).alias("o"),
        "id",
        (F.col("id") % 17 - 8).cast("decimal(12,2)").alias("v"),
    )


def test_running_equals_window(spark):
    df = skewed(spark)
    w = W.partitionBy("k").orderBy("o", "id").rowsBetween(W.unboundedPreceding, 0)
    want = {r.id: (r.s, r.n) for r in df.select("id", F.sum("v").over(w).alias("s"), F.row_number().over(w.orderBy("o", "id")).alias("n")).collect()}
    got = {r.id: (r.s, r.n) for r in ordered.running(df, ["k"], ["o", "id"], {"s": F.col("v"), "n": F.lit(1)}, count=16).collect()}
    assert got == want


def test_hot_key_is_cut_into_segments(spark):
    per = ordered.segments(skewed(spark), ["k"], ["o", "id"], count=12).groupBy("k", ordered.SEGMENT).count().toPandas()
    assert (per.k == 0).sum() >= 4  # a third of the rows needs at least four of twelve segments
    assert per["count"].max() < 6000 / 12 * 2


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 3, 7)], "k string, id int, v int")
    got = {r.id: r.s for r in ordered.running(df, ["k"], ["id"], {"s": F.col("v")}, count=3).collect()}
    assert got == {1: 5, 2: 11, 3: 7}


def test_row_numbers_over_the_whole_table(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = {r.x: r.n for r in ordered.row_numbers(df, [], ["x"], "n", start=10).collect()}
    assert got == {i: i + 10 for i in range(1000)}


def test_attach_equals_join(spark):
    df = skewed(spark).unionByName(spark.createDataFrame([(None, 1, -1, None)], skewed(spark).schema))
    per = df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("t"))
    want = {r.k: (r.n, r.t) for r in per.collect()}
    for hot in (0, 100, 10**6):  # all keys hot, some, none
        rows = skew.attach(df.select("k", "id"), per, ["k"], "n", hot_rows=hot).collect()
        assert len(rows) == 6001
        assert all((r.n, r.t) == want[r.k] for r in rows)


def test_attach_keeps_rows_without_a_partner(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    per = spark.createDataFrame([(1, 2, "x")], "k int, n bigint, label string")
    got = sorted(((r.k, r.label) for r in skew.attach(df, per, ["k"], "n", hot_rows=1).collect()), key=str)
    assert got == [(1, "x"), (1, "x"), (2, None)]


def test_surrogate_keys_reach_the_children(spark):
    headers = with_surrogate_key(spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "name string, o int"), ["o"], "hid", start=100)
    children = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "z")], "cid int, parent string")
    got = {r.cid: r.hid for r in link_children(children, headers, {"parent": "name"}, "hid").collect()}
    assert got == {1: 100, 2: 101, 3: 101, 4: None}
