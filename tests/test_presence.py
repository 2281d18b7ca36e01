"""Containment checks from presence masks, against the checks one by one."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from orestar.operators.presence import Holder, has, not_in, only_in, presence
from orestar.operators.quality import union_all
from orestar.plans import checks, silver
from orestar.sources import feeds

AS_OF = dt.date(2026, 1, 1)


def test_masks_and_counts(spark):
    one = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    two = spark.createDataFrame([(1, "b"), (2, "c"), (2, None)], "i int, k string")
    masks = presence([Holder(one, [("d", 0, "k")]), Holder(two, [("d", 1, "k"), ("e", 0, "i")])])
    assert plan_of(masks).count("Exchange hashpartitioning") == 1
    assert sorted((tuple(r) for r in masks.collect()), key=repr) == sorted([
        ("d", "a", 1, 2, 0, 0, 0), ("d", "b", 3, 1, 1, 0, 0), ("d", None, 3, 1, 1, 0, 0),
        ("d", "c", 2, 0, 1, 0, 0), ("e", "1", 1, 1, 0, 0, 0), ("e", "2", 1, 2, 0, 0, 0),
    ], key=repr)


def test_a_domain_has_four_bits(spark):
    with pytest.raises(ValueError, match="4 bits"):
        presence([Holder(spark.range(1), [("d", 4, "id")])])


@pytest.mark.parametrize("listed", [["b", "c"], ["b", None], [], [None]])
def test_not_in_as_sql_has_it(spark, listed):
    keys = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    list_ = spark.createDataFrame([(x,) for x in listed], "l string")
    masks = presence([Holder(keys, [("d", 0, "k")]), Holder(list_, [("d", 1, "l")])])
    empty, has_null = str(not listed).lower(), str(None in listed).lower()
    found = {r.key for r in masks.where(not_in(0, has(1), empty, has_null)).collect()}
    keys.createOrReplaceTempView("presence_keys")
    list_.createOrReplaceTempView("presence_list")
    expected = {r.k for r in spark.sql("SELECT k FROM presence_keys WHERE k NOT IN (SELECT l FROM presence_list)").collect()}
    assert found == expected
    anti = {r.k for r in keys.join(list_, F.expr("k = l"), "left_anti").collect()}
    assert {r.key for r in masks.where(only_in(0, 1)).collect()} == anti


def _layers(spark, sf_dir, change):
    raw = feeds.raw_layer_with_repeats(spark, sf_dir)
    raw = raw.replaced(**{name: f(raw[name]) for name, f in change.items()})
    return raw, silver.silver_layer(raw, AS_OF, "all")


NO_ROWS = {"crm_sales_details": lambda d: d.where("false"), "erp_pc_cat_g1v2": lambda d: d.where("false"), "crm_prd_info": lambda d: d.where("false")}
CHANGES = {
    "as given": {},
    "null in the lists": {
        "erp_pc_cat_g1v2": lambda d: d.withColumn("id", F.expr("if(id LIKE 'L%', NULL, id)")),
        "crm_sales_details": lambda d: d.withColumn("sls_prd_key", F.expr("if(sls_quantity = 3, NULL, sls_prd_key)")),
    },
    "empty lists": {name: NO_ROWS[name] for name in ("crm_sales_details", "erp_pc_cat_g1v2")},
    "nothing checked": {name: NO_ROWS[name] for name in ("crm_prd_info",)},
}


@pytest.mark.parametrize("name", CHANGES)
def test_same_as_the_single_checks(spark, sf_dir, name):
    bronze, clean = _layers(spark, sf_dir, CHANGES[name])
    single = union_all([checks.CROSS_TABLE[i](bronze, clean) for i in checks.CONTAINMENTS])
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(checks.containment_checks(bronze, clean)) == rows(single)


def test_sales_are_read_once_a_layer(spark, tmp_path):
    """A key in half of the sales goes into the shuffle once per task."""
    hot = spark.range(0, 40_000, numPartitions=8).selectExpr("if(id % 2 = 0, 'HOT', concat('P', id % 500)) AS k", "id % 700 AS c")
    hot.write.parquet(f"{tmp_path}/sales")
    sales = spark.read.parquet(f"{tmp_path}/sales")
    known = spark.range(500).selectExpr("concat('P', id) AS k")
    masks = presence([Holder(sales, [("product", 0, "k"), ("customer", 0, "c")]), Holder(known, [("product", 1, "k")])])
    plan = plan_of(masks)
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "partial_bit_or" in plan
    found = {r.key: (r.mask, r.n0) for r in masks.where("domain = 'product' AND key IN ('HOT', 'P1')").collect()}
    assert found == {"HOT": (1, 20_000), "P1": (3, 80)}
