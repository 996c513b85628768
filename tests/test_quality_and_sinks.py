from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from bazaarmill.operators.constraints import CHECKS, REFERENCES, all_rules, row_rules
from bazaarmill.operators.quality import Check, ForeignKey, NotNull, Unique, dq_report, require_valid, split_valid
from bazaarmill.schemas import schema
from bazaarmill.sources import sinks

ROWS = [(1, 10, 5, "Cash"), (2, 10, None, "Card"), (2, None, -1, "Cash"), (4, 77, 3, None)]
RULES = [
    Check("amount", "sales", "amount > 0"),
    Check("method", "sales", "method IN ('Cash', 'Transfer')"),
    NotNull("day set", "sales", "day"),
    Unique("key", "sales", ("id",)),
    ForeignKey("day known", "sales", "day", "days", "day"),
]


@pytest.fixture(scope="module")
def frames(spark):
    return {"sales": spark.createDataFrame(ROWS, "id int, day int, amount int, method string"), "days": spark.createDataFrame([(10,)], "day int")}


def test_report_counts_violations(frames):
    got = {r.rule: (r.violations, r.status) for r in dq_report(frames, RULES).collect()}
    # an unknown check passes, a null reference is not an orphan
    assert got == {"amount": (1, "VIOLATED"), "method": (1, "VIOLATED"), "day set": (1, "VIOLATED"), "key": (1, "VIOLATED"), "day known": (1, "VIOLATED")}


def test_split_names_the_broken_rules(frames):
    good, bad = split_valid(frames["sales"], RULES[:3])
    assert sorted(r.id for r in good.collect()) == [1, 4]
    assert sorted((r.amount or 0, r.broken_rules) for r in bad.collect()) == [(-1, ["amount", "day set"]), (0, ["method"])]


def test_require_valid_stops_the_job(frames):
    assert require_valid(frames["sales"].filter("id = 1"), RULES[:3]).count() == 1
    with pytest.raises(PySparkException, match="rule violated: method"):
        require_valid(frames["sales"].filter("method = 'Card'"), RULES[:3]).collect()


def test_declared_constraints_are_complete():
    assert len(CHECKS) == 32 and len(REFERENCES) == 19
    assert len([r for r in all_rules() if isinstance(r, Unique)]) == 12 + 4


def test_state_rules(spark):
    rows = [(True, 20240105, 7), (True, 20240105, None), (False, None, None), (False, 20240105, None)]
    df = spark.createDataFrame(rows, "is_sold boolean, date_sold_key int, sale_transaction_id bigint")
    rule = [r for r in row_rules("items") if r.name == "items.sold_logic"]
    good, bad = split_valid(df, rule)
    assert good.count() == 2 and bad.count() == 2
    late = spark.createDataFrame([("OnTime", None), ("OnTime", 2), ("Late", 1), ("Partial", None)], "payment_status string, days_late int")
    good, bad = split_valid(late, [r for r in row_rules("loan_repayments") if r.name.endswith("late_logic")])
    assert good.count() == 2 and bad.count() == 2


def test_conform_rejects_missing_and_oversized_values(spark):
    good = spark.createDataFrame([("1", "A", None)], "category_id string, category_name string, category_description string")
    assert sinks.conform(good, schema("categories")).schema["category_id"].dataType.simpleString() == "int"
    with pytest.raises(PySparkException, match="null in required column category_name"):
        sinks.conform(good.withColumn("category_name", F.lit(None).cast("string")), schema("categories")).collect()
    with pytest.raises(PySparkException):
        sinks.conform(good.withColumn("category_id", F.lit("99999999999")), schema("categories")).collect()


def test_incremental_append(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(i, dt.date(2024, 1, 1 + i // 2)) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, day date")
    df.filter("id < 5").write.parquet(path)
    sinks.incremental_append(df, path, "id", "day")
    sinks.incremental_append(df, path, "id", "day")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(10))
    late = spark.createDataFrame([(99, dt.date(2024, 1, 4))], "id int, day date")
    sinks.incremental_append(late.union(late), path, "id", "day")
    sinks.incremental_append(late, path, "id", "day")
    assert spark.read.parquet(path).filter("id = 99").count() == 1


def test_every_writer_refuses_a_bad_row(spark, tmp_path):
    rule = [Check("amount", "sales", "amount > 0")]
    good = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5)], "id int, day date, amount int")
    bad = spark.createDataFrame([(2, dt.date(2024, 1, 2), -5)], "id int, day date, amount int")
    path = str(tmp_path / "fact")
    sinks.full_refresh(good, path, good.schema, rule)
    for write in (
        lambda: sinks.full_refresh(bad, str(tmp_path / "other"), bad.schema, rule),
        lambda: sinks.append_fact(bad, path, bad.schema, rule),
        lambda: sinks.write_partitioned(bad, str(tmp_path / "parts"), "day", "append", bad.schema, rule),
        lambda: sinks.incremental_append(bad, path, "id", "day", bad.schema, rule),
    ):
        with pytest.raises(PySparkException, match="rule violated: amount"):
            write()
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "parts")
    sinks.write_partitioned(spark.range(100).withColumn("y", F.col("id") % 4), path, "y")
    kept, archived = sinks.archive_before(spark.read.parquet(path), "y", 2)
    assert kept.count() == archived.count() == 50
    assert "PartitionFilters: [isnotnull(y" in kept._jdf.queryExecution().executedPlan().toString()
