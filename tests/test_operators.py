"""Operators against the plain SQL they replace, and their plans."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from orestar.operators import sequence
from orestar.operators.anti_join import anti_join_null_aware
from orestar.operators.latest import latest_by_key
from orestar.operators.sequence import with_next
from orestar.operators.surrogate import surrogate_key


def same_rows(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    return Counter(map(tuple, left.select(columns).collect())) == Counter(map(tuple, right.select(columns).collect()))


def test_latest_by_key(spark):
    day = dt.date
    rows = [
        (1, day(2020, 1, 1), "old"), (1, day(2021, 1, 1), "new"),
        (2, None, "undated"), (2, day(1990, 1, 1), "dated"),
        (3, day(2020, 1, 1), "a"), (3, day(2020, 1, 1), "b"),
        (4, None, "only"), (None, day(2020, 1, 1), "no key"),
    ]
    df = spark.createDataFrame(rows, "k int, d date, v string")
    got = {r.k: r.v for r in latest_by_key(df, "k", "d").collect()}
    assert got == {1: "new", 2: "dated", 3: "b", 4: "only"}


def test_latest_by_key_equals_row_number(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice([None, *range(40)]), rng.choice([None, *range(5)]), rng.choice([None, "x", "y"]), rng.randrange(3))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "k int, d int, a string, b int")
    df.createOrReplaceTempView("records")
    twin = spark.sql(
        "SELECT k, d, a, b FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d DESC, a DESC, b DESC) AS n"
        " FROM records WHERE k IS NOT NULL) WHERE n = 1"
    )
    assert same_rows(latest_by_key(df, "k", "d"), twin)


LEAD = "SELECT *, lead(o) OVER (PARTITION BY k ORDER BY o, v) AS nxt FROM rows"


@pytest.mark.parametrize("seed", range(4))
def test_with_next_equals_lead(spark, seed):
    """NULL keys and orders, ties, whole-row copies and one key with most of the rows."""
    rng = random.Random(seed)
    keys = [None, "hot", "hot", "hot", *"abcdef"]
    rows = [(rng.choice(keys), rng.choice([None, *range(12)]), rng.choice([None, *"xyz"])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    df.createOrReplaceTempView("rows")
    assert same_rows(with_next(df, "k", "o", "nxt"), spark.sql(LEAD))


@pytest.mark.parametrize("seed", range(3))
def test_with_next_inside_days_equals_lead(spark, seed):
    rng = random.Random(seed)
    start = dt.datetime(2020, 1, 1)
    moments = [None, *[start + dt.timedelta(hours=rng.randrange(24 * 30)) for _ in range(60)]]
    rows = [(rng.choice([None, "hot", "hot", "a", "b"]), rng.choice(moments), rng.randrange(4)) for _ in range(1200)]
    df = spark.createDataFrame(rows, "k string, o timestamp_ntz, v int").withColumn("day", F.to_date("o"))
    df.createOrReplaceTempView("rows")
    twin = spark.sql("SELECT *, lead(o) OVER (PARTITION BY k ORDER BY o, v) AS nxt FROM rows")
    assert same_rows(with_next(df, "k", "o", "nxt", day="day"), twin)


def test_copies_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(sequence, "_COPIES_PER_TASK_ROW", 10)
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 437)], "v string, n int")
    repeated = sequence.repeat_rows(df, "n")
    assert {r.v: r["count"] for r in repeated.groupBy("v").count().collect()} == {"a": 1, "b": 10, "c": 11, "d": 437}
    rows = [("k", 1, "copy")] * 437 + [("k", 1, "a"), ("k", 2, "z"), ("k", 2, "z")]
    copies = spark.createDataFrame(rows, "k string, o int, v string")
    copies.createOrReplaceTempView("rows")
    assert same_rows(with_next(copies, "k", "o", "nxt"), spark.sql(LEAD))


RIGHT_SIDES = {
    "plain": [1, 2, 2],
    "with_null": [1, None],
    "only_null": [None],
    "disjoint": [8, 9],
    "empty": [],
}


@pytest.mark.parametrize("case", RIGHT_SIDES)
def test_anti_join_equals_not_in(spark, case):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(k,) for k in RIGHT_SIDES[case]], "r int")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    assert same_rows(
        anti_join_null_aware(left, right, "k", "r"), spark.sql("SELECT * FROM l WHERE k NOT IN (SELECT r FROM r)")
    )


def test_anti_join_does_not_force_a_broadcast(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    left, right = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "r")
    plan = plan_of(anti_join_null_aware(left, right, "k", "r"))
    assert "SortMergeJoin" in plan
    assert "Broadcast" not in plan
    assert "CartesianProduct" not in plan


def test_surrogate_key_equals_global_row_number(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(50)]), rng.choice([None, *"abcdefgh"]), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "d int, k string, i int").repartition(7)
    df.createOrReplaceTempView("members")
    twin = spark.sql("SELECT CAST(row_number() OVER (ORDER BY d, k, i) AS bigint) AS n, * FROM members")
    numbered = surrogate_key(df, ["d", "k"], "n")
    assert same_rows(numbered, twin)
    assert numbered.schema["n"].dataType.simpleString() == "bigint"
    assert dict(numbered.groupBy("n").count().where("count > 1").collect()) == {}


def test_surrogate_key_of_nothing(spark):
    assert surrogate_key(spark.range(0), ["id"], "n").collect() == []


def test_numbered_rows_never_meet_in_one_task(spark):
    """The only single-partition step works on partition sizes, not on rows."""
    numbered = surrogate_key(spark.range(10_000).repartition(8), ["id"], "n")
    plan = plan_of(numbered)
    rows_side = plan[: plan.index("BroadcastExchange")]
    assert "SinglePartition" not in rows_side


def test_failed_tasks_do_not_change_keys(spark):
    """Numbers come from stored rows, so two reads agree."""
    numbered = surrogate_key(spark.range(5_000).selectExpr("id % 97 AS a", "id AS b"), ["a"], "n")
    assert same_rows(numbered, numbered.select("*"))
    assert numbered.selectExpr("min(n)", "max(n)", "count(DISTINCT n)").first() == (1, 5000, 5000)
