"""One pass per table for predicates and value lists, against the checks one by one."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from orestar.operators.profile import Listing, Profile, profile, profile_results
from orestar.operators.quality import Check, run_checks, union_all
from orestar.plans import checks, silver
from orestar.sources import feeds

AS_OF = dt.date(2026, 1, 1)
WANTED = Profile(
    [Check("c1", "negative", "v < 0", "FAIL"), Check("c2", "by_rule", "v < 0", null_when_empty=True), Check("c3", "rows")],
    [Listing("l1", "a", "A: "), Listing("l2", "a", counted=False), Listing("l3", "b", "B: ")],
)
ROWS = [("x", None, -1), ("x", 3, 2), (None, 3, -4), (None, None, None)]


def results(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_predicates_and_values_of_one_pass(spark):
    df = spark.createDataFrame(ROWS, "a string, b int, v int")
    listed = [
        ("l1", "t", "A: x", 2, "INFO"), ("l1", "t", "A: NULL", 2, "INFO"), ("l2", "t", "x", 1, "INFO"), ("l2", "t", "NULL", 1, "INFO"),
        ("l3", "t", "B: 3", 2, "INFO"), ("l3", "t", "B: NULL", 2, "INFO"),
    ]
    expected = listed + [tuple(r) for r in run_checks(df, "t", WANTED.checks).collect()]
    assert results(profile_results({"t": df}, {"t": WANTED})) == sorted(expected, key=repr)


def test_no_rows(spark):
    df = spark.createDataFrame([], "a string, b int, v int")
    expected = results(run_checks(df, "t", WANTED.checks))
    assert results(profile_results({"t": df}, {"t": WANTED})) == expected


@pytest.mark.parametrize("wanted", [Profile(WANTED.checks), Profile(listings=WANTED.listings)])
def test_either_alone(spark, wanted):
    df = spark.createDataFrame(ROWS, "a string, b int, v int")
    whole = results(profile_results({"t": df}, {"t": WANTED}))
    kind = "c" if wanted.checks else "l"
    assert results(profile_results({"t": df}, {"t": wanted})) == [r for r in whole if r[0].startswith(kind)]


def test_a_table_is_scanned_and_shuffled_once(spark, tmp_path):
    spark.createDataFrame(ROWS * 100, "a string, b int, v int").withColumn("unused", F.lit("u")).write.parquet(f"{tmp_path}/t")
    plan = plan_of(profile(spark.read.parquet(f"{tmp_path}/t"), "t", WANTED))
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1 and plan.count("Exchange") == 1
    assert "unused" not in plan


def test_the_full_suite_is_that_of_single_checks(spark, sf_dir):
    bronze = feeds.raw_layer_with_repeats(spark, sf_dir)
    clean = silver.silver_layer(bronze, AS_OF, "all")
    single = union_all([checks.quality_suite(bronze, clean, AS_OF), checks.listing_metrics(bronze, clean)])
    assert results(checks.full_suite(bronze, clean, AS_OF)) == results(single)
