"""Loads that come again: upsert, lasting keys, sliding archive, guards, co-bucketed tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from bazaarmill.operators.quality import Check, ForeignKey, Unique
from bazaarmill.sources import guards, sinks, storage
from bazaarmill.sources.archive import SlidingArchive
from bazaarmill.sources.cobuckets import CoBuckets
from bazaarmill.sources.guards import Guard, SetRuleViolated
from bazaarmill.sources.registry import KeyRegistry
from bazaarmill.sources.upsert import latest, upsert

ITEM = "id int, month int, version int, price int"


def table(spark, path, schema=ITEM):
    return sorted(map(tuple, spark.read.schema(schema).parquet(path).select("id", "month", "version", "price").collect()), key=str)


def files(spark, path):
    return {f"{d}/{n}" for d in storage.folders(spark, path) for n in map(str, _names(spark, f"{path}/{d}"))}


def _names(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]


# Upsert


def test_upsert_changed_new_late_and_equal_rows(spark, tmp_path):
    path = str(tmp_path / "items")
    base = [(i, 202401 + i % 3, 1, 10 * i) for i in range(30)]
    assert upsert(spark.createDataFrame(base, ITEM), path, ["id"], "version", "month") == [202401, 202402, 202403]
    before = files(spark, path)
    batch = [
        (3, 202401, 2, 999),  # changed
        (100, 202404, 1, 1),  # new month
        (0, 202401, 0, -5),  # late: an older version
        (6, 202401, 1, 60),  # equal
        (100, 202404, 1, 1),  # twice in the batch
    ]
    df = spark.createDataFrame(batch, ITEM)
    assert upsert(df, path, ["id"], "version", "month") == [202401, 202404]
    want = sorted([r for r in base if r[0] != 3] + [(3, 202401, 2, 999), (100, 202404, 1, 1)], key=str)
    assert table(spark, path) == want
    after = files(spark, path)
    untouched = lambda names: {n for n in names if n.startswith(("month=202402", "month=202403"))}
    assert untouched(before) == untouched(after)  # other months keep their very files
    assert upsert(df, path, ["id"], "version", "month") == []  # a rerun writes nothing
    assert files(spark, path) == after and table(spark, path) == want


def test_upsert_moves_a_row_to_another_partition(spark, tmp_path):
    path = str(tmp_path / "items")
    upsert(spark.createDataFrame([(1, 1, 1, 5), (2, 2, 1, 6), (3, None, 1, 7)], ITEM), path, ["id"], "version", "month")
    upsert(spark.createDataFrame([(1, 2, 2, 8), (3, 1, 2, 9), (2, 2, 1, 6)], ITEM), path, ["id"], "version", "month")
    assert table(spark, path) == [(1, 2, 2, 8), (2, 2, 1, 6), (3, 1, 2, 9)]
    assert storage.folders(spark, path) == ["month=1", "month=2"]  # the emptied folder of null is gone
    upsert(spark.createDataFrame([(3, None, 3, 1)], ITEM), path, ["id"], "version", "month")
    assert table(spark, path) == [(1, 2, 2, 8), (2, 2, 1, 6), (3, None, 3, 1)]
    assert "month=1" not in storage.folders(spark, path)


def test_upsert_does_not_depend_on_the_order_of_loads(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.randint(0, 12), rng.randint(1, 3), rng.randint(1, 4), rng.randint(0, 3)) for _ in range(60)]
    want, results = {}, []
    for r in rows:
        want[r[0]] = max(want.get(r[0], (r[0], 0, 0, 0)), r, key=lambda x: (x[2], x[1], x[3]))
    for k, order in enumerate((rows, rows[::-1])):
        path = str(tmp_path / f"items{k}")
        for i in range(0, 60, 20):
            upsert(spark.createDataFrame(order[i : i + 20], ITEM), path, ["id"], "version", "month")
        results.append(table(spark, path))
    assert results[0] == results[1] == sorted(want.values(), key=str)


def test_upsert_heals_a_load_that_broke_off(spark, tmp_path):
    """A row was written to its new month, and the old month was not cleared."""
    path = str(tmp_path / "items")
    sinks.write_partitioned(spark.createDataFrame([(1, 1, 1, 5), (1, 2, 2, 8), (2, 1, 1, 6)], ITEM), path, "month")
    upsert(spark.createDataFrame([(1, 2, 2, 8)], ITEM), path, ["id"], "version", "month")
    assert table(spark, path) == [(1, 2, 2, 8), (2, 1, 1, 6)]


def test_upsert_checks_rows_and_reads_only_touched_folders(spark, tmp_path):
    path = str(tmp_path / "items")
    rule = [Check("price", "items", "price >= 0")]
    upsert(spark.createDataFrame([(i, i % 4, 1, i) for i in range(20)], ITEM), path, ["id"], "version", "month", rule)
    with pytest.raises(Exception, match="rule violated: price"):
        upsert(spark.createDataFrame([(1, 1, 2, -1)], ITEM), path, ["id"], "version", "month", rule)
    assert len(table(spark, path)) == 20


def test_upsert_writes_changed_partitions_once(spark, tmp_path):
    """The merged rows are not stored before they are written; partition values of null and of untouched folders are still found."""
    from bazaarmill.session import run_root

    path, root = str(tmp_path / "items"), f"{run_root(spark)}/frozen"
    upsert(spark.createDataFrame([(1, 1, 1, 5), (2, None, 1, 6), (3, 3, 1, 7)], ITEM), path, ["id"], "version", "month")
    before = set(storage.folders(spark, root))
    upsert(spark.createDataFrame([(2, 1, 2, 8), (3, 1, 2, 9)], ITEM), path, ["id"], "version", "month")
    assert len(set(storage.folders(spark, root)) - before) == 2  # the batch and its effect
    assert table(spark, path) == [(1, 1, 1, 5), (2, 1, 2, 8), (3, 1, 2, 9)]
    assert storage.folders(spark, path) == ["month=1"] and [n for n in _names(spark, str(tmp_path)) if "aside" in n] == []


def test_upsert_refuses_orphans(spark, tmp_path):
    path = str(tmp_path / "items")
    months = Guard(references=[ForeignKey("known month", "items", "month", "months", "m")], parents={"months": spark.createDataFrame([(1,), (2,)], "m int")})
    upsert(spark.createDataFrame([(1, 1, 1, 5)], ITEM), path, ["id"], "version", "month", guard=months)
    with pytest.raises(SetRuleViolated, match="known month"):
        upsert(spark.createDataFrame([(1, 9, 2, 5)], ITEM), path, ["id"], "version", "month", guard=months)
    assert table(spark, path) == [(1, 1, 1, 5)]


def test_run_folder_can_be_dropped(spark):
    from bazaarmill import session

    frozen = session.freeze(spark.range(3))
    assert frozen.count() == 3 and storage.exists(spark, session.run_root(spark))
    other = spark.newSession()  # the folder belongs to the application
    assert session.run_root(other) == session.run_root(spark)


def test_latest_filters_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, v, 0) for v in range(50)] + [(2, 1, 1, 3), (2, 1, 1, 4)], ITEM)
    out = latest(df, ["id"], "version")
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2  # before and after the shuffle
    assert sorted(map(tuple, out.collect())) == [(1, 1, 49, 0), (2, 1, 1, 4)]


# Keys


def test_registry_keeps_and_continues_keys(spark, tmp_path):
    def load(*rows):
        return spark.createDataFrame(rows, "type string, brand string, day int")

    r = KeyRegistry(spark, str(tmp_path / "keys"), ["type", "brand"], "variant_key", "type string, brand string")
    assert r.register(load(("b", "x", 1), ("a", "x", 2), ("a", "x", 2)), ["day"]) == 2
    first = {(k.type, k.brand): k.variant_key for k in r.keys().collect()}
    assert first == {("b", "x"): 1, ("a", "x"): 2}
    assert r.register(load(("a", "x", 0), ("c", None, 5), ("a", "y", 9), (None, None, 1)), ["day"]) == 3
    second = {(k.type, k.brand): k.variant_key for k in r.keys().collect()}
    assert second == {**first, (None, None): 3, ("c", None): 4, ("a", "y"): 5}
    assert r.register(load(("a", "y", 9)), ["day"]) == 0 and r.register(load(), ["day"]) == 0
    assert r.loads() == [1, 2]
    children = spark.createDataFrame([("a", "y", 1), ("c", None, 2), ("zz", "q", 3)], "t string, b string, line int")
    got = r.attach(children, ["t", "b"])
    assert {x.line: x.variant_key for x in got.collect()} == {1: 5, 2: 4, 3: None}


def test_registry_ignores_a_load_that_broke_off(spark, tmp_path):
    path = str(tmp_path / "keys")
    r = KeyRegistry(spark, path, ["id"], "key", "id int")
    r.register(spark.createDataFrame([(5,), (3,)], "id int"))
    spark.createDataFrame([(9, 77)], "id int, key bigint").write.parquet(f"{path}/_aside-broken")
    assert sorted(tuple(x)[:2] for x in r.keys().collect()) == [(3, 1), (5, 2)]
    r.register(spark.createDataFrame([(9,)], "id int"))
    assert sorted(tuple(x)[:2] for x in r.keys().collect()) == [(3, 1), (5, 2), (9, 3)]


# Archive


@pytest.fixture
def years(spark, tmp_path):
    df = spark.range(100).select("id", (2000 + F.col("id") % 5).cast("int").alias("year"))
    live, away = str(tmp_path / "live"), str(tmp_path / "away")
    sinks.write_partitioned(df, live, "year")
    return SlidingArchive(spark, live, away, "year", df.schema)


def test_archive_moves_folders_and_brings_them_back(spark, years):
    kept = files(spark, years.live)
    assert years.slide(2002) == ["2000", "2001"] and years.slide(2002) == []
    assert {n for n in kept if n >= "year=2002"} == files(spark, years.live)  # the very files
    assert years.current().count() == 60 and years.archived().count() == 40 and years.archived([2001]).count() == 20
    plan = years.archived([2001])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert years.restore([2001, 1999]) == ["2001"]
    assert years.current().filter("year = 2001").count() == 20 and years.archived().count() == 20
    got = [(r.partition, r.direction, r.n_rows, r.state) for r in years.manifest().orderBy("seq").collect()]
    assert got == [("2000", "out", 20, "done"), ("2001", "out", 20, "done"), ("2001", "back", 20, "done")]
    assert all(r.files > 0 and r.bytes > 0 for r in years.manifest().collect())


def test_archive_finishes_a_move_that_broke_off(spark, years):
    years._note([(1, "2000", "out", 20, 1, 1, "moving"), (2, "2001", "out", 20, 1, 1, "moving")])
    storage.move(spark, f"{years.live}/year=2000", f"{years.archive}/year=2000")
    assert years.recover() == ["2000", "2001"] and years.recover() == []
    assert years.archived().count() == 40 and years.current().count() == 60
    assert {r.state for r in years.manifest().collect()} == {"done"}


def test_archive_everything_and_nothing(spark, years):
    assert years.slide(1990) == [] and years.manifest().count() == 0
    assert len(years.slide(3000)) == 5
    assert years.current().count() == 0 and years.current().columns == ["id", "year"]


# Guards

LINE = "order_id int, line int, amount int"


@pytest.fixture
def guard(spark):
    orders = spark.createDataFrame([(i,) for i in range(1, 11)], "id int")
    return Guard([Unique("line key", "lines", ("order_id", "line"))], [ForeignKey("known order", "lines", "order_id", "orders", "id")], {"orders": orders}, ["amount"])


def test_examine_names_what_is_broken(spark, guard):
    target = spark.createDataFrame([(1, 1, 5), (2, 1, 5)], LINE)
    rows = [(1, 1, 9), (1, 2, 7), (3, 1, 8), (3, 1, 6), (3, 1, 6), (99, 1, 5), (None, 1, 2), (None, 1, 2), (4, None, 1), (4, None, 1)]
    good, bad = guards.examine(spark.createDataFrame(rows, LINE), guard, target)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, 2, 7), (3, 1, 6), (None, 1, 2), (None, 1, 2), (4, None, 1), (4, None, 1)], key=str)
    got = sorted((r.order_id, r.line, r.amount, r.broken_rules) for r in bad.collect())
    assert got == [(1, 1, 9, ["line key"]), (3, 1, 6, ["line key"]), (3, 1, 8, ["line key"]), (99, 1, 5, ["known order"])]


def test_every_writer_refuses_orphans_and_duplicates(spark, guard, tmp_path):
    schema = spark.createDataFrame([], LINE).schema
    good = spark.createDataFrame([(1, 1, 5), (1, 2, 5)], LINE)
    path, parts = str(tmp_path / "lines"), str(tmp_path / "parts")
    sinks.full_refresh(good, path, schema, guard=guard)
    sinks.write_partitioned(good, parts, "line", guard=guard)
    orphan, twice, taken = ([(50, 1, 1)], [(2, 1, 1), (2, 1, 2)], [(1, 1, 6)])
    for rows, rule in ((orphan, "known order"), (twice, "line key"), (taken, "line key")):
        bad = spark.createDataFrame(rows, LINE)
        writers = [lambda: sinks.append_fact(bad, path, schema, guard=guard), lambda: sinks.write_partitioned(bad, parts, "line", guard=guard)]
        if rows is not taken:  # a refresh replaces the table, so nothing is taken
            writers.append(lambda: sinks.full_refresh(bad, path, schema, guard=guard))
        if rows is orphan:  # an incremental append skips keys it has
            writers.append(lambda: sinks.incremental_append(bad, path, "amount", "line", schema, guard=guard))
        for write in writers:
            with pytest.raises(SetRuleViolated, match=rule) as e:
                write()
            assert e.value.counts == {rule: 1}
    assert spark.read.parquet(path).count() == spark.read.parquet(parts).count() == 2
    assert not [n for n in storage.folders(spark, str(tmp_path)) if "aside" in n]


def test_rejected_rows_are_split_off(spark, guard, tmp_path):
    schema = spark.createDataFrame([], LINE).schema
    path, rejected = str(tmp_path / "lines"), str(tmp_path / "rejected")
    sinks.append_fact(spark.createDataFrame([(1, 1, 5), (77, 1, 5), (1, 1, 8)], LINE), path, schema, guard=guard, rejected=rejected)
    sinks.append_fact(spark.createDataFrame([(1, 1, 4), (2, 9, 5)], LINE), path, schema, guard=guard, rejected=rejected)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, 1, 5), (2, 9, 5)]
    assert sorted((r.order_id, r.amount, *r.broken_rules) for r in spark.read.parquet(rejected).collect()) == [(1, 4, "line key"), (1, 8, "line key"), (77, 5, "known order")]


@pytest.mark.parametrize("n", [0, 1, 7, 3000])
def test_bitmap_loses_no_key(spark, n):
    keys = spark.range(n).select((F.col("id") * 977).alias("k0"))
    rows = spark.range(100_000).withColumnRenamed("id", "k0")
    got = guards.may_contain(rows, ["k0"], keys)
    assert keys.join(rows, "k0").join(got, "k0", "left_anti").count() == 0
    assert got.count() <= n + 0.15 * 100_000 and (n or got.count() == 0)


def test_hot_keys_are_marked(spark, guard):
    rows = spark.range(5000).select(F.lit(3).alias("order_id"), F.lit(1).alias("line"), F.col("id").cast("int").alias("amount"))
    good, bad = guards.examine(rows, guard)
    assert [tuple(r) for r in good.collect()] == [(3, 1, 0)] and bad.count() == 4999


def test_rows_are_read_once_to_be_marked(spark, guard, monkeypatch):
    frozen, freeze = [], guards.freeze
    monkeypatch.setattr(guards, "freeze", lambda df: frozen.append(df) or freeze(df))
    target = spark.createDataFrame([(1, 1, 5)], LINE)
    good, bad = guards.examine(spark.createDataFrame([(1, 1, 9), (3, 1, 8), (3, 1, 6), (2, 1, 4)], LINE), guard, target)
    assert sorted(map(tuple, good.collect())) == [(2, 1, 4), (3, 1, 6)] and bad.count() == 2
    leaves = frozen[-1]._jdf.queryExecution().optimizedPlan().collectLeaves()
    stored = [x for x in map(leaves.apply, range(leaves.size())) if x.nodeName() == "LogicalRelation"]
    assert sum("amount" in x.output().toString() for x in stored) == 1


# Co-buckets


def test_cobuckets_join_without_a_shuffle(spark, tmp_path):
    headers = spark.range(200).select(F.col("id").alias("h"), (F.col("id") * 2).alias("v"))
    many = spark.range(3000).select(F.lit(7).cast("long").alias("d"), F.col("id").alias("line"))  # one key with most details
    details = spark.range(1000).select((F.col("id") % 250).alias("d"), F.col("id").alias("line")).unionByName(many)
    details = details.unionByName(spark.createDataFrame([(None, -1)], "d long, line long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pair = CoBuckets(spark, str(tmp_path / "pair"), {"d": "h"}, 8)
        pair.write(headers, details)
        cold, hot = pair.parts()
        plan = cold._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        got = pair.join()
        want = details.join(headers, details["d"] == headers["h"])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert hot.select("h").distinct().collect()[0][0] == 7
        summed = cold.groupBy("h").agg(F.count("*"))
        assert "Exchange" not in summed._jdf.queryExecution().executedPlan().toString()
        pair.drop()
        assert not storage.exists(spark, str(tmp_path / "pair"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
