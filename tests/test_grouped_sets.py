"""Several groupings from one pass against a plain aggregation of each."""

from __future__ import annotations

import random

import pytest

from conftest import plan_of
from test_operators import same_rows
from orestar.operators.grouped_sets import grouped_sets


SETS = {"a": ["a"], "ab": ["a", "b"], "b": ["b"], "c": ["c"], "all": []}
SUMS = {"total": "x", "twice": "2 * x"}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    found = [
        # A third of all rows share every value; counted values, values and summands may be NULL.
        (1, "p", True, "hot", 1) if rng.random() < 0.33 else
        (rng.choice([None, 1, 2]), rng.choice([None, "p", "q"]), rng.choice([None, True]), rng.choice([None, "o1", "o2", "o3"]), rng.choice([None, 3, -4]))
        for _ in range(900)
    ]
    return spark.createDataFrame([*found, (9, None, None, None, None)], "a int, b string, c boolean, o string, x int")


def test_equal_to_single_groupings(spark, rows):
    rows.createOrReplaceTempView("grouped_rows")
    found = grouped_sets(rows, SETS, "o", SUMS, ["a", "ab", "all"])
    assert found.columns == ["grouped_by", "a", "b", "c", "n_counted", "total", "twice"]
    for name, own in SETS.items():
        by = "".join(f"{column}, " for column in own)
        n = "count(DISTINCT o)" if name in ("a", "ab", "all") else "0L"
        expected = spark.sql(
            f"SELECT {by} {n} AS n_counted, sum(x) AS total, sum(2 * x) AS twice FROM grouped_rows" + (f" GROUP BY {by[:-2]}" if own else "")
        )
        assert same_rows(found.where(f"grouped_by = '{name}'").select(*expected.columns), expected), name


def test_cells_are_multiplied_and_not_rows(rows):
    plan = plan_of(grouped_sets(rows, SETS, "o", SUMS, ["a"]))
    below = plan[plan.index("Expand") :]
    # Rows are summed to cells, in tasks and after the shuffle, before the Expand.
    assert plan.count("Expand") == 1 and below.count("HashAggregate") >= 2


def test_no_rows_and_equal_sets(rows):
    assert grouped_sets(rows.where("false"), SETS, "o", SUMS, ["a"]).count() == 0
    with pytest.raises(ValueError, match="same columns"):
        grouped_sets(rows, {"a": ["a"], "again": ["a"]}, "o", SUMS, [])


def test_counted_values_are_not_multiplied(rows):
    expand = next(line for line in plan_of(grouped_sets(rows, SETS, "o", SUMS, ["a", "b", "ab"])).splitlines() if "Expand" in line)
    # A counted value is sent once with its masks, not once per set: the cells that are multiplied lack it.
    assert "o#" not in expand and "a#" in expand


@pytest.mark.parametrize("most_masked", [1024, 100, 0])
@pytest.mark.parametrize("together", [(), [["k", "all"], ["m", "km", "k_sums"]]])
def test_many_values(spark, most_masked, together):
    rng = random.Random(5)
    # 64, 65 and more values: masks of one word, of two and of many; one counted value is in most rows.
    made = [
        (rng.choice([None, *range(64)]), rng.randrange(64), "hot" if rng.random() < 0.6 else rng.choice([None, f"o{rng.randrange(40)}"]), i)
        for i in range(3000)
    ]
    rows = spark.createDataFrame(made, "k int, m int, o string, x int")
    rows.createOrReplaceTempView("many_values")
    sets = {"k": ["k"], "m": ["m"], "km": ["k", "m"], "all": [], "k_sums": ["k"]}
    found = grouped_sets(rows, sets, "o", {"total": "x"}, ["k", "m", "km", "all"], together, most_masked).cache()
    for name, own in sets.items():
        by = "".join(f"{column}, " for column in own)
        n = "0L" if name == "k_sums" else "count(DISTINCT o)"
        expected = spark.sql(f"SELECT {by} {n} AS n_counted, sum(x) AS total FROM many_values" + (f" GROUP BY {by[:-2]}" if own else ""))
        assert same_rows(found.where(f"grouped_by = '{name}'").select(*expected.columns), expected), name


def test_sets_left_out_of_the_groups(rows):
    with pytest.raises(ValueError, match="one group"):
        grouped_sets(rows, SETS, "o", SUMS, [], [["a", "b"]])
