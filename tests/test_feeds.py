"""Feeds over tables with keys longer than their printed width."""

from __future__ import annotations

import pytest

from orestar.plans import silver
from orestar.sources import feeds

LONG_KEYS = [1, 1_000_000, 10_000_000, 10_000_001, 100_000_000, 800_000_000, 3_000_000_000, 12_345_678_901]


@pytest.fixture(scope="module")
def long_keys(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("long_keys"))
    ids = ", ".join(f"({k})" for k in LONG_KEYS)
    tables = {
        "customer": "SELECT CAST(k AS bigint) AS c_custkey, 0 AS c_nationkey",
        "nation": "SELECT DISTINCT 0 AS n_nationkey, 'X' AS n_name",
        "supplier": "SELECT CAST(k AS bigint) AS s_suppkey",
        "part": "SELECT CAST(k AS bigint) AS p_partkey, 'n' AS p_name, 'Brand#1' AS p_brand, 'LARGE' AS p_type, 1 AS p_size, 9D AS p_retailprice",
        "orders": "SELECT CAST(k AS bigint) AS o_orderkey, CAST(k AS bigint) AS o_custkey, TIMESTAMP_NTZ '1996-01-01 00:00:00' AS o_orderdate",
        "lineitem": "SELECT CAST(k AS bigint) AS l_orderkey, CAST(k AS bigint) AS l_partkey, 1D AS l_quantity, 5D AS l_extendedprice,"
        " TIMESTAMP_NTZ '1996-01-02 00:00:00' AS l_shipdate",
    }
    for name, columns in tables.items():
        spark.sql(f"{columns} FROM VALUES {ids} AS v(k)").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_no_two_ids_share_a_key(spark, long_keys):
    layer = feeds.raw_layer(spark, long_keys)
    keys = lambda table, column: [r[0] for r in layer[table].select(column).distinct().collect()]
    assert len(keys("crm_prd_info", "prd_key")) == len(LONG_KEYS)
    assert len(keys("crm_cust_info", "cst_key")) == len(LONG_KEYS)
    assert len(keys("erp_cust_az12", "cid")) == 2 * len(LONG_KEYS)
    assert len(keys("erp_loc_a101", "cid")) == len(LONG_KEYS)
    known = [k for k in LONG_KEYS if k % 211 and k % 37]
    assert len(set(keys("crm_sales_details", "sls_prd_key")) - {"ZZ-UNKNOWN"}) == len(known)
    assert {abs(k) for k in keys("crm_sales_details", "sls_cust_id")} >= {k for k in LONG_KEYS if k % 101}


def test_long_keys_join(spark, long_keys):
    clean = silver.silver_layer(feeds.raw_layer(spark, long_keys))
    products = {r.prd_key for r in clean["crm_prd_info"].collect()}
    sold = {r.sls_prd_key for r in clean["crm_sales_details"].collect()} - {"ZZ-UNKNOWN"}
    assert sold and sold <= products


def test_short_keys_are_padded_as_before(spark, sf_dir):
    rows = feeds.product_feed(spark, sf_dir).where("prd_key LIKE '%-P0000012'")
    assert rows.count() > 0


def test_unknown_customers_have_ids_no_customer_can_have(spark, sf_dir):
    ids = feeds.sales_feed(spark, sf_dir).where("sls_cust_id < 0").count()
    assert ids > 0
    assert feeds.customer_feed(spark, sf_dir).where("cst_id < 0").count() == 0
