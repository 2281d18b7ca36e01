"""Points in intervals by blocks, against the comparison it replaces."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from orestar.operators.interval_index import covering_blocks, enclosing_blocks, join_in_interval, levels
from orestar.plans.reports import sales_point_in_time

DAY0 = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def test_blocks_cover_exactly_the_interval(spark):
    """Every interval of a calendar of 40 days: its days, once each, in two blocks a level at most."""
    pairs = [(a, b) for a in range(40) for b in range(a - 2, 40)]
    df = spark.createDataFrame(pairs, "a int, b int").withColumn("top", F.expr(levels("40")))
    for a, b, blocks in df.selectExpr("a", "b", covering_blocks("a", "b", "top")).collect():
        days = [d for level, block in blocks for d in range(block << level, (block + 1) << level)]
        assert sorted(days) == list(range(a, b + 1))
        assert all(sum(x.level == k for x in blocks) <= 2 for k in range(6))


def test_a_day_has_a_block_of_each_level(spark):
    (row,) = spark.sql(f"SELECT {enclosing_blocks('37', levels('40'))} AS b").collect()
    assert [tuple(b) for b in row.b] == [(0, 37), (1, 18), (2, 9), (3, 4), (4, 2), (5, 1)]


def _joined(spark, points, intervals):
    points = spark.createDataFrame([(k, day(n)) for k, n in points], "k string, day date")
    intervals = spark.createDataFrame([(k, day(a), day(b), i) for i, (k, a, b) in enumerate(intervals)], "key string, since date, upto date, i int")
    span = points.selectExpr("struct(min(day) AS a, max(day) AS b)").scalar()
    met = join_in_interval(points, intervals, [("k", "key")], "day", "since", "upto", (span.getField("a"), span.getField("b")))
    assert met.columns == ["k", "day", "key", "since", "upto", "i"]
    return met


def test_pairs_are_those_of_the_comparison(spark):
    rng = random.Random(4)
    points = [(rng.choice("xyz"), rng.choice([None, *range(-20, 90)])) for _ in range(120)]
    points += [("x", 30_000), (None, 5)]
    intervals = [(rng.choice("xyw"), rng.choice([None, *range(-40, 100)]), rng.choice([None, *range(-40, 120)])) for _ in range(80)]
    intervals += [("x", 29_999, None), (None, 0, 10), ("y", -500, 5), ("y", 99_999, None)]
    found = sorted((r.k, r.day, r.i) for r in _joined(spark, points, intervals).collect())
    expected = sorted(
        (k, day(n), i) for k, n in points for i, (key, a, b) in enumerate(intervals)
        if k is not None and k == key and n is not None and a is not None and a <= n and (b is None or n <= b)
    )
    assert found == expected and len(found) > 200


@pytest.mark.parametrize(("points", "intervals"), [([], [("x", 0, 5)]), ([("x", 3)], []), ([("x", None)], [("x", 0, None)])])
def test_nothing_to_join(spark, points, intervals):
    assert _joined(spark, points, intervals).count() == 0


def test_one_day_in_all(spark):
    assert [r.i for r in _joined(spark, [("x", 3)], [("x", 0, 5), ("x", 4, 9), ("x", 3, 3)]).orderBy("i").collect()] == [0, 2]


def _sales(spark, days):
    rows = [(f"SO{i}", "P", d, 1, 1) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "sls_ord_num string, sls_prd_key string, sls_order_dt date, sls_sales int, sls_quantity int")


def test_an_outlying_date_adds_a_handful_of_rows(spark):
    """The rows both sides send to the join, with and without a sale of the year 2099."""
    versions = [(i, "P", day(30 * i), day(30 * i + 29) if i < 40 else None, i) for i in range(41)]
    versions = spark.createDataFrame(versions, "prd_id int, prd_key string, prd_start_dt date, prd_end_dt date, prd_cost int")

    def blocks(days):
        first, last = min(days), max(days)
        top = levels(str((last - first).days + 1))
        begin = f"DATE '{first}'"
        cut = f"least(coalesce(datediff(prd_end_dt, {begin}), {(last - first).days}), {(last - first).days})"
        covers = versions.selectExpr(f"size({covering_blocks(f'greatest(datediff(prd_start_dt, {begin}), 0)', cut, top)}) AS n")
        return [r.n for r in covers.collect()], spark.sql(f"SELECT size({enclosing_blocks('0', top)}) AS n").first().n

    usual = [day(n) for n in range(0, 1300, 7)]
    outlying = [*usual, dt.date(2099, 12, 31)]
    (before, level_before), (after, level_after) = blocks(usual), blocks(outlying)
    assert max(after) <= 34 and level_after <= 17
    assert sum(after) - sum(before) <= 10 and level_after - level_before <= 6
    found = sales_point_in_time(_sales(spark, outlying), versions).collect()
    assert len(found) == len(outlying)
    assert all(r.cost_at_sale == min((r.order_date - DAY0).days // 30, 40) for r in found)


def test_the_join_is_on_the_block_alone(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(_joined(spark, [("x", 3)], [("x", 0, 5)]))
    (join,) = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert join.rstrip().endswith("Inner") and "point_block" in join
