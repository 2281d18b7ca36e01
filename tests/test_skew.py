"""One key with a third of the rows or more: same results, split work."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from conftest import plan_of
from orestar.operators.anti_join import anti_join_null_aware
from orestar.operators.latest import latest_by_key
from orestar.operators.sequence import with_next
from orestar import session
from orestar.plans import checks, gold, reports
from test_operators import same_rows


@pytest.fixture(scope="module")
def sales(spark):
    """Half of the sales are of one product; a third name no customer."""
    return spark.range(0, 60_000, numPartitions=8).selectExpr(
        "concat('SO', id div 3) AS sls_ord_num",
        "if(id % 2 = 0, 'HOT', concat('P', id % 500)) AS sls_prd_key",
        "CAST(if(id % 3 = 0, NULL, id % 700) AS int) AS sls_cust_id",
        "date_add(DATE '2020-01-01', CAST(id % 900 AS int)) AS sls_order_dt",
        "CAST(NULL AS date) AS sls_ship_dt",
        "CAST(NULL AS date) AS sls_due_dt",
        "CAST(id % 50 AS int) AS sls_sales",
        "1 AS sls_quantity",
        "CAST(id % 50 AS int) AS sls_price",
    )


@pytest.fixture
def products(spark):
    return spark.createDataFrame([("HOT", 0)] + [(f"P{i}", i) for i in range(500)], "product_number string, product_key int")


@pytest.fixture
def customers(spark):
    return spark.range(700).selectExpr("CAST(id AS int) AS customer_id", "id AS customer_key", "id % 9 AS country")


@pytest.fixture
def small_partitions(settings):
    """Joins that may not broadcast, and a skew limit that test data reaches."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
    )


def test_the_star_join_splits_hot_keys(spark, sales, products, customers, small_partitions):
    fact = gold.star(sales, products, customers).select("order_number", "product_key", "customer_key", "quantity")
    rows = fact.collect()
    assert len(rows) == 60_000
    assert sum(r.product_key == 0 for r in rows) == 30_000
    assert sum(r.customer_key is None for r in rows) == 20_000
    assert "SortMergeJoin(skew=true)" in plan_of(fact)


def test_two_lookups_on_one_hot_key_are_split(spark, small_partitions):
    """A third of the customers share a key; both lookups use that key."""
    customers = spark.range(0, 30_000, numPartitions=8).selectExpr(
        "CAST(id AS int) AS cst_id", "if(id % 3 = 0, 'HOT', concat('K', id)) AS cst_key", "sha2(CAST(id AS string), 256) AS cst_firstname",
        "'l' AS cst_lastname", "'n/a' AS cst_material_status", "'n/a' AS cst_gndr", "DATE '2020-01-01' AS cst_create_date",
    )
    ids = spark.range(30_000).where("id = 0 OR id % 3 <> 0").selectExpr("if(id = 0, 'HOT', concat('K', id)) AS cid")
    people = ids.selectExpr("cid", "DATE '1990-01-01' AS bdate", "'Male' AS gen")
    places = ids.selectExpr("cid", "'Germany' AS cntry")
    members = gold.customer_members(customers, people, places)
    assert len(members.collect()) == 30_000
    assert "skew=true" in plan_of(members)
    assert members.where("gender = 'Male' AND country = 'Germany'").count() == 30_000


def test_not_in_with_hot_keys_on_both_sides(spark, small_partitions):
    left = spark.range(0, 60_000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, -1, id) AS k", "sha2(CAST(id AS string), 256) AS v"
    )
    right = spark.range(0, 60_000, numPartitions=8).selectExpr("if(id % 3 = 1, -2, 2 * id) AS r")
    unlisted = anti_join_null_aware(left, right, "k", "r")
    found = unlisted.collect()
    listed = {-2} | {2 * i for i in range(60_000) if i % 3 != 1}
    assert sorted(r.k for r in found) == sorted(k for k in (-1 if i % 3 == 0 else i for i in range(60_000)) if k not in listed)
    assert "SortMergeJoin(skew=true)" in plan_of(unlisted)


def test_orphans_with_mostly_null_keys(spark, sales, products, customers, small_partitions):
    fact = gold.star(sales, products, customers).select("order_number", "customer_key", "quantity")
    orphans = gold.orphan_facts(fact, customers.where("customer_key <> 7"), "customer_key")
    lost = fact.where("customer_key = 7").count()
    assert lost > 0
    assert orphans.count() == 20_000 + lost
    assert orphans.columns == fact.columns


def test_distinct_counts_do_not_meet_by_group(spark, sales, products, customers):
    """Distinct orders are reduced by (group, order) before they meet by group."""
    report = reports.sales_by_country(gold.star(sales, products, customers))
    plan = plan_of(report)
    assert "hashpartitioning(country" in plan and "order_number" in plan[plan.rindex("hashpartitioning(country") :]
    assert sum(r.total_sales for r in report.collect()) == sales.selectExpr("sum(sls_sales)").first()[0]


def test_latest_reduces_a_key_before_the_shuffle(spark):
    df = spark.range(0, 50_000, numPartitions=8).selectExpr("if(id % 3 = 0, 1, id) AS k", "id AS d", "id % 5 AS v")
    latest = latest_by_key(df, "k", "d")
    plan = plan_of(latest)
    assert plan.count("Aggregate") >= 2 and "Window" not in plan
    assert latest.where("k = 1").first().d == 49_998


def test_the_window_sees_one_row_per_day(spark):
    """30,000 versions of one product on 40 days reach the window as 40 rows."""
    df = spark.range(0, 30_000, numPartitions=8).selectExpr(
        "'HOT' AS k", "date_add(DATE '2020-01-01', CAST(id % 40 AS int)) AS o", "id AS v"
    )
    df.createOrReplaceTempView("rows")
    twin = spark.sql("SELECT *, lead(o) OVER (PARTITION BY k ORDER BY o, v) AS nxt FROM rows")
    assert same_rows(with_next(df, "k", "o", "nxt"), twin)


def versions(spark, rng):
    start, rows, i = dt.date(2019, 12, 1), [], 0
    for key in ["HOT", "P1", "P3", "P5"]:
        for category in ("A", "B") if key == "HOT" else ("A",):
            days = sorted(rng.sample(range(900), 150 if key == "HOT" else 3))
            for day, following in zip(days, [*days[1:], None]):
                i += 1
                begin = start + dt.timedelta(days=day)
                end = None if following is None else start + dt.timedelta(days=following - 1)
                rows.append((i, category, key, day, begin, end))
    rows.append((0, "A", "P1", 1, start, start - dt.timedelta(days=1)))
    return spark.createDataFrame(
        rows, "prd_id int, cat_id string, prd_key string, prd_cost int, prd_start_dt date, prd_end_dt date"
    )


def test_point_in_time_of_a_hot_product(spark, sales):
    """Half of the sales and 300 overlapping versions are of one product: a plain join on the period gives the same."""
    table = versions(spark, random.Random(5))
    found = reports.sales_point_in_time(sales, table)
    assert "Window" not in plan_of(found) and "BroadcastNestedLoop" not in plan_of(found)
    sales.createOrReplaceTempView("pit_sales")
    table.createOrReplaceTempView("pit_versions")
    twin = spark.sql(
        "SELECT sls_ord_num AS order_number, sls_prd_key, sls_order_dt AS order_date, sls_sales AS sales_amount, sls_quantity AS quantity,"
        " prd_id AS product_id, prd_start_dt AS version_start, prd_end_dt AS version_end, prd_cost AS cost_at_sale"
        " FROM pit_sales LEFT JOIN pit_versions ON prd_key = sls_prd_key AND sls_order_dt >= prd_start_dt"
        " AND (prd_end_dt IS NULL OR sls_order_dt <= prd_end_dt)"
    )
    assert same_rows(found, twin)
    assert found.where("cost_at_sale IS NOT NULL").count() > 30_000


def test_point_in_time_without_sales(spark, sales):
    table = versions(spark, random.Random(5))
    assert reports.sales_point_in_time(sales.where("false"), table).count() == 0


def test_point_in_time_matches_days_on_which_versions_turn(spark, sales, monkeypatch):
    """What is matched with the versions grows with the versions, not with the days sold on."""
    matched, join = [], reports.join_in_interval
    monkeypatch.setattr(reports, "join_in_interval", lambda points, *rest: matched.append(points) or join(points, *rest))
    table = versions(spark, random.Random(5))
    reports.sales_point_in_time(sales, table)
    assert 0 < matched[0].count() <= 2 * table.count() < sales.select("sls_prd_key", "sls_order_dt").distinct().count()


def test_point_in_time_of_odd_versions(spark):
    """Missing keys and days, copies, versions of one day, versions that end before they begin, sales on every border."""
    day = lambda n: None if n is None else dt.date(2020, 1, 1) + dt.timedelta(days=n)
    rng = random.Random(8)
    spans = [(rng.choice([None, *range(30)]), rng.choice([None, *range(30)])) for _ in range(40)]
    rows = [(i, rng.choice(["a", "b", None]), i, day(a), day(b)) for i, (a, b) in enumerate(spans)]
    rows += [(90, "c", 1, day(4), day(4)), (90, "c", 1, day(4), day(4)), (91, "c", 2, day(5), dt.date(9999, 12, 31)), (92, "d", 3, None, day(9))]
    table = spark.createDataFrame(rows, "prd_id int, prd_key string, prd_cost int, prd_start_dt date, prd_end_dt date")
    sold = [(f"SO{n}", k, day(n)) for n in [None, *range(-2, 35), 30_000] for k in ("a", "b", "c", "d", "e", None)]
    sold = spark.createDataFrame(sold, "sls_ord_num string, sls_prd_key string, sls_order_dt date").selectExpr("*", "1 AS sls_sales", "1 AS sls_quantity")
    found = reports.sales_point_in_time(sold, table)
    sold.createOrReplaceTempView("odd_sales")
    table.createOrReplaceTempView("odd_versions")
    twin = spark.sql(
        "SELECT sls_ord_num AS order_number, sls_prd_key, sls_order_dt AS order_date, sls_sales AS sales_amount, sls_quantity AS quantity,"
        " prd_id AS product_id, prd_start_dt AS version_start, prd_end_dt AS version_end, prd_cost AS cost_at_sale"
        " FROM odd_sales LEFT JOIN odd_versions ON prd_key = sls_prd_key AND sls_order_dt >= prd_start_dt"
        " AND (prd_end_dt IS NULL OR sls_order_dt <= prd_end_dt)"
    )
    assert same_rows(found, twin)


def test_tasks_read_bounded_parts(spark, settings):
    """Sizes of a session that would let one task sort gigabytes are lowered; smaller ones stay."""
    advisory, threshold = session.LARGEST_READS
    for given, kept in (("64MB", "16m"), ("1g", "16m"), (str(1 << 30), "16m"), ("8m", "8m"), ("20k", "20k"), ("4096b", "4096b")):
        settings(**{advisory.replace(".", "__"): given, threshold.replace(".", "__"): "256MB"})
        session.prepare(spark)
        assert spark.conf.get(advisory) == kept
        assert spark.conf.get(threshold) == "48m"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor") == "2"


def hot_rows(spark, key):
    """Half of 60,000 rows share one key; the rest of each row does not compress."""
    return spark.range(0, 60_000, numPartitions=8).selectExpr(
        f"if(id % 2 = 0, 'HOT', concat('K', id)) AS {key}", "sha2(CAST(id AS string), 256) AS filler"
    )


@pytest.mark.parametrize(
    "check",
    [
        lambda rows, keys: checks.already_in_crm({"erp_cust_az12": keys("cid")}, {"crm_cust_info": rows("cst_key")}),
        lambda rows, keys: checks.uncategorised_products({}, {"crm_prd_info": keys("cat_id"), "erp_pc_cat_g1v2": rows("id")}),
        lambda rows, keys: checks.products_not_in_catalogue({}, {"crm_sales_details": keys("sls_prd_key"), "crm_prd_info": rows("prd_key")}),
    ],
)
def test_hot_keys_on_the_right_shrink_before_the_join(spark, small_partitions, check):
    found = check(lambda key: hot_rows(spark, key), lambda key: hot_rows(spark, key).select(key))
    plan = plan_of(found)
    # The listed side is aggregated by key and part, not by key alone.
    assert "listed_key" in plan and "part#" in plan
    assert found.count() > 0


def test_product_report_tells_sums_apart_not_sales(spark, sales, products, customers):
    report = reports.products(gold.star(sales, products.selectExpr("*", "'n' AS product_name"), customers))
    plan = plan_of(report)
    # Operators are listed from the result down: the sums per cell lie below the Expand.
    assert plan.index("Expand") < plan.rindex("HashAggregate")
    below = plan[plan.index("Expand") :]
    assert "order_number" in below and below.count("HashAggregate") >= 2
    assert sum(r.total_sales for r in report.collect()) == sales.selectExpr("sum(sls_sales)").first()[0]
