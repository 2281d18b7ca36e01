from __future__ import annotations

import datetime as dt

from conftest import plan_of
from orestar.operators.quality import Check, run_checks, value_counts
from orestar.plans import checks, gold, silver
from orestar.schemas import RAW

CHECKS = [
    Check("c1", "negative", "v < 0"),
    Check("c2", "by_rule", "v < 0", null_when_empty=True),
    Check("c3", "rows_checked"),
    Check("c4", "scoped", "v < 0", "FAIL", within="k = 'a'"),
]


def test_one_pass_over_the_table(spark):
    df = spark.createDataFrame([("a", -1), ("b", -2), ("a", None), ("b", 4)], "k string, v int")
    results = run_checks(df, "t", CHECKS)
    assert plan_of(results).count("Exchange") == 1
    assert [tuple(r) for r in results.collect()] == [
        ("c1", "t", "negative", 2, "WARN"),
        ("c2", "t", "by_rule", 2, "WARN"),
        ("c3", "t", "rows_checked", 4, "INFO"),
        ("c4", "t", "scoped", 1, "FAIL"),
    ]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert [(r.value, r.status) for r in run_checks(empty, "t", CHECKS).collect()] == [
        (0, "PASS"), (None, "PASS"), (0, "INFO"), (0, "PASS"),
    ]


def test_value_counts(spark):
    df = spark.createDataFrame([("x", None), ("x", "n")], "a string, b string")
    got = {(r.label, r.value): r.row_count for r in value_counts(df, {"a": "A", "b": "B"}).collect()}
    assert got == {("A", "x"): 2, ("B", None): 1, ("B", "n"): 1}


def test_duplicate_and_null_ids(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "prd_id int")
    assert {r.prd_id: r.duplicate_count for r in checks.duplicate_keys(df, "prd_id", True).collect()} == {1: 2, None: 1}
    assert checks.duplicate_keys(df, "prd_id", False).count() == 1
    assert checks.duplicate_rows(df, "prd_id", "v7", "t").first().value == 3


def test_ties_on_the_start_date_show_as_early_ends(spark):
    at = dt.datetime(2020, 1, 1)
    raw = spark.createDataFrame(
        [(1, "AC-HE-A", None, 1, None, at, None), (2, "AC-HE-A", None, 1, None, at, None)], RAW["crm_prd_info"]
    )
    found = checks.predicate_check("v9", {}, {"crm_prd_info": silver.clean_products(raw)}).first()
    assert (found.value, found.status) == (1, "WARN")


def test_preview_of_chosen_products(spark):
    at = dt.datetime
    rows = [(1, "AC-HE-HL-U509", at(2020, 1, 1)), (2, "AC-HE-HL-U509", at(2020, 1, 1, 12)), (3, "other", at(2020, 1, 1))]
    raw = spark.createDataFrame([(i, k, None, 1, None, s, None) for i, k, s in rows], RAW["crm_prd_info"])
    preview = checks.validity_preview({"crm_prd_info": raw}, checks.SAMPLE_PRODUCTS)
    assert {r.prd_id: r.next_start_dt for r in preview.collect()} == {1: at(2020, 1, 1, 12), 2: None}


def test_a_null_in_the_list_is_reported(spark):
    """NOT IN finds nothing once the list has a NULL; the metric says so."""
    products = spark.createDataFrame([(1, "AC-HE-A", None, 1, None, None, None)], RAW["crm_prd_info"])
    categories = spark.createDataFrame([("XX_XX", "c", "s", "Yes"), (None, "c", "s", "Yes")], RAW["erp_pc_cat_g1v2"])
    found = checks.missing_categories({"crm_prd_info": products, "erp_pc_cat_g1v2": categories}, {})
    assert {r.metric: r.value for r in found.collect()} == {
        "affected_products": 0, "affected_rows": 0, "null_keys_in_list": 1,
    }


def test_several_date_columns(spark):
    sales = spark.createDataFrame([("o", "p", 1, 20200101, 5, 20991231, 1, 1, 1)], RAW["crm_sales_details"])
    by_table = checks.table_checks(int_dates=("sls_order_dt", "sls_ship_dt", "sls_due_dt"))
    results = run_checks(sales, "bronze.crm_sales_details", by_table["bronze.crm_sales_details"]).collect()
    found = {(r.check_id, r.metric): r.value for r in results}
    assert found["v14", "invalid_dates"] == 1
    assert found["v15", "sls_order_dt_wrong_length"] == 0
    assert found["v15", "sls_ship_dt_wrong_length"] == 1
    assert found["v15", "sls_due_dt_future_date"] == 1


def test_verdict_comes_from_the_results(spark):
    rows = [("v1", "PASS"), ("v2", "WARN"), ("v2", "FAIL"), ("v3", "INFO"), ("v3", "WARN")]
    results = spark.createDataFrame(rows, "check_id string, status string")
    assert {r.check_id: r.status for r in checks.suite_verdict(results).collect()} == {
        "v1": "PASS", "v2": "FAIL", "v3": "WARN",
    }


def test_fan_out_counts_added_rows(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "r string")
    added = gold.fan_out(left, right, "x", "k", "r").first().extra_rows
    assert added == left.join(right, left.k == right.r, "left").count() - left.count() == 4
