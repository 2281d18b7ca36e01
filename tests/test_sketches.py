"""Distinct counts from united sketches."""

from __future__ import annotations

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from orestar.operators.sketches import sketch_cells, standard_error, united_counts, within_error


@pytest.fixture(scope="module")
def rows(spark):
    """Half of the rows in one cell; values shared between cells; NULLs."""
    return spark.range(0, 400_000, numPartitions=8).selectExpr(
        "if(id % 2 = 0, 0, id % 24) AS month", "id % 3 AS line", "if(id % 5 = 0, NULL, id % 30011) AS v", "1 AS q"
    )


def test_united_cells_keep_the_stated_error(rows):
    cells = sketch_cells(rows, ["month", "line"], {"v": "v"}, {"q": "q"})
    for by in (["month"], ["line"], []):
        exact = rows.groupBy(*by).agg(F.expr("count(DISTINCT v) AS exact"), F.expr("sum(q) AS rows"))
        about = united_counts(cells, by, ["v"], ["q"]).withColumnsRenamed({name: f"e_{name}" for name in by})
        met = exact.join(about, F.expr(" AND ".join([f"{n} = e_{n}" for n in by] or ["true"])))
        assert met.where(f"NOT {within_error('v', 'exact')} OR q <> rows").count() == 0
        assert met.count() == exact.count()


def test_union_is_the_sketch_of_the_whole(rows):
    """Months united are the year sketched at once, but for the way both are estimated."""
    cells = sketch_cells(rows, ["month"], {"v": "v"})
    united = united_counts(cells, [], ["v"]).first().v
    whole = united_counts(sketch_cells(rows, [], {"v": "v"}), [], ["v"]).first().v
    assert abs(united - whole) <= standard_error() * whole


def test_only_sketches_are_shuffled(rows):
    plan = plan_of(sketch_cells(rows, ["month"], {"v": "v"}))
    assert "partial_hll_sketch_agg" in plan and plan.count("Exchange") == 1


def test_nulls_and_no_rows(spark):
    nothing = spark.createDataFrame([], "k string, v int")
    cells = sketch_cells(nothing, ["k"], {"v": "v"})
    assert cells.count() == 0 and united_counts(cells, [], ["v"]).first().v == 0
    nulls = spark.createDataFrame([(None, None), ("a", None), (None, 7)], "k string, v int")
    found = {r.k: r.v for r in united_counts(sketch_cells(nulls, ["k"], {"v": "v"}), ["k"], ["v"]).collect()}
    assert found == {None: 1, "a": 0}
