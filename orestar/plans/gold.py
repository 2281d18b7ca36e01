"""Silver to gold: two dimensions, one fact, and the audits between them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestar.functions.cleansing import UNKNOWN
from orestar.operators.quality import union_all
from orestar.operators.surrogate import surrogate_key

FACT_COLUMNS = [
    "order_number", "product_key", "customer_key", "sls_prd_key", "sls_cust_id",
    "order_date", "shipping_date", "due_date", "sales_amount", "quantity", "sls_price",
]


def customer_members(customers: DataFrame, demographics: DataFrame, locations: DataFrame) -> DataFrame:
    """CRM customers with birth date and country. The CRM's gender wins if known."""
    people = demographics.withColumnRenamed("cid", "person")
    places = locations.withColumnRenamed("cid", "place")
    return (
        customers.join(people, F.expr("cst_key = person"), "left")
        .join(places, F.expr("cst_key = place"), "left")
        .selectExpr(
            "cst_id AS customer_id",
            "cst_key AS customer_number",
            "cst_firstname AS firstname",
            "cst_lastname AS lastname",
            "cst_material_status AS marital_status",
            f"coalesce(nullif(cst_gndr, '{UNKNOWN}'), gen, '{UNKNOWN}') AS gender",
            "cst_create_date AS create_date",
            "bdate AS birthdate",
            "cntry AS country",
        )
    )


def product_members(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Current product versions with their category."""
    current = products.where("prd_end_dt IS NULL")
    return current.join(categories, F.expr("cat_id = id"), "left").selectExpr(
        "prd_id AS product_id",
        "prd_key AS product_number",
        "prd_nm AS product_name",
        "cat_id AS category_id",
        "cat AS category",
        "subcat AS subcategory",
        "maintenance",
        "prd_cost AS cost",
        "prd_line AS product_line",
        "prd_start_dt AS start_date",
    )


def dim_customers(customers: DataFrame, demographics: DataFrame, locations: DataFrame) -> DataFrame:
    return surrogate_key(
        customer_members(customers, demographics, locations), ["customer_id"], "customer_key"
    )


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    return surrogate_key(
        product_members(products, categories), ["start_date", "product_number"], "product_key"
    )


def star(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Every sale with the attributes of its product and customer.

    Reports aggregate over this: columns they do not use are pruned from the
    scans and the joins, and the dimensions are joined once. Both joins leave
    the strategy to the sizes Spark sees; a dimension too large to broadcast is
    sort-merged, with skewed keys split at run time.
    """
    named = sales.withColumnsRenamed(
        {
            "sls_ord_num": "order_number",
            "sls_order_dt": "order_date",
            "sls_ship_dt": "shipping_date",
            "sls_due_dt": "due_date",
            "sls_sales": "sales_amount",
            "sls_quantity": "quantity",
        }
    )
    return named.join(products, F.expr("sls_prd_key = product_number"), "left").join(
        customers, F.expr("sls_cust_id = customer_id"), "left"
    )


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    return star(sales, products, customers).select(*FACT_COLUMNS)


def star_of_fact(fact: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """``star`` from a stored fact table, joined on the surrogate keys."""
    return fact.join(products, "product_key", "left").join(customers, "customer_key", "left")


def orphan_facts(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts whose ``key`` is missing from ``dimension``. None are expected.

    A NULL key can match nothing, so such rows are salted with the number of
    the task that read them, which spreads even identical rows over the join
    and is the same again if that task has to be repeated.
    """
    salted = fact.selectExpr("*", f"if({key} IS NULL, spark_partition_id() % 1024 + 1, 0) AS salt")
    known = dimension.selectExpr(key, "0 AS salt")
    return salted.join(known, [key, "salt"], "left_anti").select(*fact.columns)


def fan_out(rows: DataFrame, dimension: DataFrame, label: str, row_key: str, key: str) -> DataFrame:
    """How many rows a left join on ``key`` would add, without running it.

    Keys that occur once on the dimension side add nothing, so only repeated
    keys are looked up, against rows already counted per key.
    """
    members = dimension.where(f"{key} IS NOT NULL").groupBy(F.col(key).alias("joined_key"))
    repeated = members.agg(F.expr("count(*) AS members")).where("members > 1")
    hits = rows.groupBy(F.col(row_key).alias("joined_key")).agg(F.expr("count(*) AS hits"))
    return hits.join(repeated, "joined_key").selectExpr(
        f"'{label}' AS join_name", "coalesce(sum(hits * (members - 1)), 0) AS extra_rows"
    )


def join_guards(silver: Mapping[str, DataFrame]) -> DataFrame:
    """What each join of the gold layer adds; all 0 if master data names nobody twice."""
    current = silver["crm_prd_info"].where("prd_end_dt IS NULL")
    customers, sales = silver["crm_cust_info"], silver["crm_sales_details"]
    return union_all(
        [
            fan_out(customers, silver["erp_cust_az12"], "customer_demographics", "cst_key", "cid"),
            fan_out(customers, silver["erp_loc_a101"], "customer_location", "cst_key", "cid"),
            fan_out(current, silver["erp_pc_cat_g1v2"], "product_category", "cat_id", "id"),
            fan_out(sales, current, "sales_product", "sls_prd_key", "prd_key"),
            fan_out(sales, customers, "sales_customer", "sls_cust_id", "cst_id"),
        ]
    )
