"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from compare import difference, duck


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


OWN = [name for name in driver.queries() if name not in driver.training_data_queries()]


def test_every_query_has_a_twin():
    assert set(OWN) == driver.oracle_sql().keys() - driver.training_data_queries().keys()


@pytest.mark.parametrize("name", OWN)
def test_same_result(spark, sf_dir, connection, name):
    assert difference(driver.queries()[name](spark, sf_dir), connection, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["country", "total_sales", "orders", "units"]


# Known results at sf0.01.
EXPECTED_METRICS = {
    ("v1", "null_customer_ids"): 15,
    ("v2", "duplicate_ids"): 0,
    ("v4", "affected_products"): 42,
    ("v4", "affected_rows"): 42,
    ("v5", "affected_rows"): 111,
    ("v7", "affected_rows"): 133,
    ("v8", "invalid_date_ranges"): 1334,
    ("v9", "invalid_date_ranges"): 42,
    ("v10", "cost_issues"): 281,
    ("v14", "invalid_dates"): 3293,
    ("v15", "zero_or_negative"): 1176,
    ("v15", "wrong_length"): 2335,
    ("v15", "future_date"): 958,
    ("v15", "past_date"): 2335,
    ("v16", "inconsistent_rows"): 14516,
    ("v17", "null_sales"): 3421,
    ("v17", "null_price"): 2031,
    ("v17", "null_quantity"): 1392,
    ("v17", "non_positive_sales"): 3055,
    ("v17", "non_positive_quantity"): 1494,
    ("v17", "non_positive_price"): 1902,
    ("v17", "calculation_mismatch"): 7845,
    ("v18", "invalid_date_order"): 28502,
    ("v19", "order_after_ship"): 28502,
    ("v19", "order_after_due"): 27741,
    ("v19", "rows_checked"): 57665,
    ("v20", "duplicate_count"): 1487,
    ("v21", "birthdates_out_of_range"): 7,
    ("v22", "rows_checked"): 113,
    ("v27", "unwanted_spaces"): 20,
    ("v28", "category_spaces"): 10,
    ("v28", "subcategory_spaces"): 6,
    ("v28", "maintenance_spaces"): 6,
    ("v32", "products_without_valid_category"): 42,
    ("v33", "unknown_products"): 1,
    ("v34", "unknown_customers"): 155,
}


def test_known_metrics(spark):
    results = driver.queries()["quality_suite"](spark, "/root/testdata/sf0.01").collect()
    found = {(r.check_id, r.metric): r.value for r in results}
    assert {key: found[key] for key in EXPECTED_METRICS} == EXPECTED_METRICS


def test_known_totals(spark):
    run = {name: query(spark, "/root/testdata/sf0.01") for name, query in driver.queries().items() if "report_" in name}
    country = {r.country: r.total_sales for r in run["report_sales_by_country"].collect()}
    assert country["Germany"] == 602324641
    assert country["United States"] == 1002347762
    assert country[None] == 49757643
    profit = {r.category: r.profit for r in run["report_profit"].collect()}
    assert profit["LARGE"] == 306036512
    assert profit[None] == 19733149
    customers = run["report_customers"].selectExpr("count(*)", "sum(orders)", "max(total_sales)").first()
    assert tuple(customers) == (1487, 14488, 4896497)
    products = run["report_products"].selectExpr("count(*)", "sum(buyers)", "max(total_sales)").first()
    assert tuple(products) == (1945, 56433, 2756794)


def test_faults_that_only_some_feeds_have(spark):
    def rows(name):
        return driver.queries()[name](spark, "/root/testdata/sf0.01").collect()

    assert len(rows("check_v6")) == 45
    assert len(rows("check_v2_stored_repeats")) == 149
    assert {r.join_name: r.extra_rows for r in rows("gold_join_guard_repeats")} == {
        "customer_demographics": 30, "customer_location": 30, "product_category": 587, "sales_product": 6435, "sales_customer": 0,
    }
    assert {r.metric: r.value for r in rows("check_v4_null_listed")} == {"affected_products": 0, "affected_rows": 0, "null_keys_in_list": 1}
    assert {r.metric: r.value for r in rows("check_v4_empty_list")} == {"affected_products": 3912, "affected_rows": 4001, "null_keys_in_list": 0}
    assert len(rows("fact_sales_point_in_time_overlaps")) == 66062
