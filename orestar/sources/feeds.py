"""Raw CRM and ERP feeds derived from the given order tables.

The given tables are clean. The feeds carry the faults the cleaning steps
exist for: missing ids, superseded records, padded and unknown codes, broken
dates, measures that do not add up, unknown products and customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orestar.plans.layer import Layer
from orestar.schemas import RAW

# The columns read from each given table.
_GIVEN = {
    "customer": "c_custkey bigint, c_nationkey int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def _padded(column: str, width: int) -> str:
    """At least ``width`` digits; longer numbers stay whole."""
    digits = f"CAST({column} AS string)"
    return f"lpad({digits}, greatest({width}, length({digits})), '0')"


def _cycle(number: str, *values: str | None) -> str:
    """values[number mod len(values)], NULL where the value is None."""
    listed = ", ".join("CAST(NULL AS string)" if v is None else f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({number} % {len(values)} AS int) + 1)"


def _int_date(day: str) -> str:
    return f"year({day}) * 10000 + month({day}) * 100 + day({day})"


def _typed(df: DataFrame, table: str, **columns: str) -> DataFrame:
    return df.selectExpr(
        *[f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW[table].fields]
    )


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, one in ten also as an older record; some ids missing."""
    source = _table(spark, sf_dir, "customer")
    created = "date_add(DATE '2025-01-01', CAST(c_custkey % 365 AS int))"
    cst_key = f"concat('AW', {_padded('c_custkey', 8)})"
    current = _typed(
        source,
        "crm_cust_info",
        cst_id="CASE WHEN c_custkey % 97 <> 96 THEN c_custkey END",
        cst_key=cst_key,
        cst_firstname="concat('  F', c_custkey % 89)",
        cst_lastname="concat('L', c_custkey % 83, ' ')",
        cst_material_status=_cycle("c_custkey", "S", " s ", "M", "m", None),
        cst_gndr=_cycle("c_custkey", "F", " f", "M", "m ", "x", None, None),
        cst_create_date=created,
    )
    older = _typed(
        source.where("c_custkey % 10 = 0"),
        "crm_cust_info",
        cst_id="c_custkey",
        cst_key=cst_key,
        cst_firstname="'Old'",
        cst_lastname="'Old'",
        cst_material_status="NULL",
        cst_gndr="NULL",
        cst_create_date=f"date_sub({created}, 30)",
    )
    return current.unionByName(older)


def product_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three dated versions of every part; some ids missing or used twice, some versions on one day."""
    parts = _table(spark, sf_dir, "part")
    return _typed(
        parts.selectExpr("*", "explode(sequence(0, CAST(2 - p_partkey % 3 AS int))) AS v"),
        "crm_prd_info",
        prd_id="CASE WHEN p_partkey % 89 = 5 THEN NULL WHEN p_partkey % 61 = 7 THEN p_partkey * 3 - 3 + v ELSE p_partkey * 3 + v END",
        prd_key=f"concat(upper(left(p_type, 2)), '-B', right(p_brand, 1), '-P', {_padded('p_partkey', 7)})",
        prd_nm="p_name",
        prd_cost="CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN -1 ELSE floor(p_retailprice) + v END",
        prd_line=_cycle("p_size", "M ", "r", "S", "t", "X", None),
        prd_start_dt="date_add(DATE '1995-01-01', CAST(p_partkey % 100 + if(p_partkey % 47 = 11, 0, v * 700) AS int))",
        prd_end_dt="CASE WHEN v = 0 AND p_partkey % 3 < 2 THEN DATE '1994-06-01' END",
    )


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, dates as yyyymmdd integers."""
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "CAST(l_quantity AS int) AS q",
        "CAST(floor(l_extendedprice / l_quantity) AS int) AS p",
        "CAST(l_shipdate AS date) AS shipped",
    )
    # Orders grow with the line items, so they are never broadcast.
    orders = _table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey").hint("merge")
    return _typed(
        lines.join(orders, "l_orderkey"),
        "crm_sales_details",
        sls_ord_num="concat('SO', l_orderkey)",
        sls_prd_key=f"CASE WHEN l_orderkey % 211 = 0 OR l_partkey % 37 = 0 THEN 'ZZ-UNKNOWN' ELSE concat('P', {_padded('l_partkey', 7)}) END",
        sls_cust_id="CASE WHEN l_orderkey % 101 = 0 THEN -1 - o_custkey ELSE o_custkey END",
        sls_order_dt=f"CASE WHEN l_orderkey % 50 = 0 THEN 0 WHEN l_orderkey % 53 = 0 THEN 32154 WHEN l_orderkey % 61 = 0 THEN 20991231 ELSE {_int_date('o_orderdate')} END",
        sls_ship_dt=_int_date("shipped"),
        sls_due_dt=f"CASE WHEN l_orderkey % 59 <> 0 THEN {_int_date('date_add(shipped, 12)')} END",
        sls_sales="CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN 0 WHEN l_partkey % 23 = 0 THEN q * p + 7 ELSE q * p END",
        sls_quantity="CASE WHEN l_partkey % 41 = 0 THEN 0 WHEN l_partkey % 43 = 0 THEN NULL ELSE q END",
        sls_price="CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN -p ELSE p END",
    )


def demographics_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Birth dates and genders, including people the CRM does not know."""
    known = _typed(
        _table(spark, sf_dir, "customer"),
        "erp_cust_az12",
        cid=f"concat(CASE WHEN c_custkey % 2 = 0 THEN 'NAS' ELSE '' END, 'AW', {_padded('c_custkey', 8)})",
        bdate="date_add(DATE '1920-01-01', CAST(c_custkey * 37 % 40000 AS int))",
        gen=_cycle("c_custkey", "F", "Female", " m", "MALE ", "", None),
    )
    others = _typed(
        _table(spark, sf_dir, "supplier"),
        "erp_cust_az12",
        cid=f"concat('NASEX', {_padded('s_suppkey', 8)})",
        bdate="date_add(DATE '1920-01-01', CAST(s_suppkey * 6007 % 45000 AS int))",
        gen=_cycle("s_suppkey", "F", "male"),
    )
    return known.unionByName(others)


def location_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    codes = _cycle("c_nationkey", "DE", " US", "USA", "  ", None, None)
    return _typed(
        _table(spark, sf_dir, "customer").join(nations, "c_nationkey"),
        "erp_loc_a101",
        cid=f"concat('AW-', {_padded('c_custkey', 8)})",
        cntry=f"CASE WHEN c_nationkey % 6 = 5 THEN concat(n_name, ' ') ELSE {codes} END",
    )


def category_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (type, brand digit), one combination left out."""
    pairs = _table(spark, sf_dir, "part").selectExpr("p_type", "right(p_brand, 1) AS digit")
    return _typed(
        pairs.where("NOT (p_type = 'PROMO' AND digit = '7')").distinct(),
        "erp_pc_cat_g1v2",
        id="concat(upper(left(p_type, 2)), '_B', digit)",
        cat="CASE WHEN p_type = 'LARGE' THEN concat(' ', p_type) ELSE p_type END",
        subcat="concat('Brand', digit, if(digit = '1', ' ', ''))",
        maintenance="CASE WHEN digit = '2' THEN ' Yes' WHEN digit IN ('0', '4') THEN 'Yes' ELSE 'No' END",
    )


_FEEDS = {
    "crm_cust_info": customer_feed,
    "crm_prd_info": product_feed,
    "crm_sales_details": sales_feed,
    "erp_cust_az12": demographics_feed,
    "erp_loc_a101": location_feed,
    "erp_pc_cat_g1v2": category_feed,
}


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _FEEDS[table](spark, sf_dir)


def raw_layer(spark: SparkSession, sf_dir: str) -> Layer:
    return Layer({table: lambda feed=feed: feed(spark, sf_dir) for table, feed in _FEEDS.items()})


def raw_layer_with_repeats(spark: SparkSession, sf_dir: str) -> Layer:
    """The feeds with ids that master data must not repeat, and product versions that overlap.

    One ERP person and place in fifty comes twice, every third category has a
    second row, and one part in nine has a version under a second spelling of its
    key, which the cleaning takes for the same product of the same category.
    """
    layer = raw_layer(spark, sf_dir)
    people, places = layer["erp_cust_az12"], layer["erp_loc_a101"]
    categories, products = layer["erp_pc_cat_g1v2"], layer["crm_prd_info"]
    digits = "CAST(right(cid, 2) AS int) % 50 = 0"
    spelled = products.where("CAST(substr(prd_key, 8) AS bigint) % 9 = 4 AND prd_start_dt IS NOT NULL").selectExpr(
        *[f"concat(left(prd_key, 2), '_', substr(prd_key, 4)) AS {c}" if c == "prd_key" else c for c in products.columns]
    )
    return layer.replaced(
        erp_cust_az12=people.unionByName(people.where(digits)),
        erp_loc_a101=places.unionByName(places.where(digits)),
        erp_pc_cat_g1v2=categories.unionByName(categories.where("right(id, 1) IN ('0', '3', '6')")),
        crm_prd_info=products.unionByName(spelled),
    )
