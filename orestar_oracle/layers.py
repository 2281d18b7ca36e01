"""The layers as DuckDB common table expressions, written apart from the Spark code.

``query`` puts the expressions a statement needs in front of it.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2026-01-01'"

_DAY = "year({0})*10000+month({0})*100+day({0})"
# Zeros in front up to a width, longer numbers as they are.
_ZEROS = "repeat('0', {1} - length(CAST({0} AS STRING))) || CAST({0} AS STRING)"

FEEDS = {
    "crm_cust_info": f"""
SELECT CAST(CASE WHEN c_custkey % 97 = 96 THEN NULL ELSE c_custkey END AS BIGINT) AS cst_id,
 concat('AW', {_ZEROS.format('c_custkey', 8)}) AS cst_key,
 concat('  F', CAST(c_custkey % 89 AS STRING)) AS cst_firstname, concat('L', CAST(c_custkey % 83 AS STRING), ' ') AS cst_lastname,
 CASE c_custkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN ' s ' WHEN 2 THEN 'M' WHEN 3 THEN 'm' ELSE NULL END AS cst_material_status,
 CASE c_custkey % 7 WHEN 0 THEN 'F' WHEN 1 THEN ' f' WHEN 2 THEN 'M' WHEN 3 THEN 'm ' WHEN 4 THEN 'x' ELSE NULL END AS cst_gndr,
 DATE '2025-01-01' + CAST(c_custkey % 365 AS INT) AS cst_create_date FROM customer
UNION ALL
SELECT CAST(c_custkey AS BIGINT), concat('AW', {_ZEROS.format('c_custkey', 8)}), 'Old', 'Old', NULL, NULL,
 DATE '2025-01-01' + CAST(c_custkey % 365 AS INT) - 30 FROM customer WHERE c_custkey % 10 = 0""",
    "crm_prd_info": f"""
SELECT CAST(CASE WHEN p_partkey % 89 = 5 THEN NULL WHEN p_partkey % 61 = 7 THEN (p_partkey-1)*3+v ELSE p_partkey*3+v END AS BIGINT) AS prd_id,
 concat(upper(substring(p_type,1,2)),'-B',right(p_brand,1),'-P',{_ZEROS.format('p_partkey', 7)}) AS prd_key, p_name AS prd_nm,
 CAST(CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN -1 ELSE floor(p_retailprice)+v END AS INT) AS prd_cost,
 CASE p_size % 6 WHEN 0 THEN 'M ' WHEN 1 THEN 'r' WHEN 2 THEN 'S' WHEN 3 THEN 't' WHEN 4 THEN 'X' ELSE NULL END AS prd_line,
 CAST(DATE '1995-01-01' + CAST((p_partkey % 100) + CASE WHEN p_partkey % 47 = 11 THEN 0 ELSE v END*700 AS INT) AS TIMESTAMP) AS prd_start_dt,
 CAST(CASE WHEN v=0 AND p_partkey % 3 < 2 THEN DATE '1994-06-01' ELSE NULL END AS TIMESTAMP) AS prd_end_dt
FROM part CROSS JOIN (VALUES (0), (1), (2)) vv(v) WHERE v <= 2 - p_partkey % 3""",
    "crm_sales_details": f"""
SELECT concat('SO',CAST(l_orderkey AS STRING)) AS sls_ord_num,
 CASE WHEN l_orderkey % 211 = 0 OR l_partkey % 37 = 0 THEN 'ZZ-UNKNOWN' ELSE concat('P',{_ZEROS.format('l_partkey', 7)}) END AS sls_prd_key,
 CAST(CASE WHEN l_orderkey % 101 = 0 THEN -(o_custkey + 1) ELSE o_custkey END AS BIGINT) AS sls_cust_id,
 CAST(CASE WHEN l_orderkey % 50 = 0 THEN 0 WHEN l_orderkey % 53 = 0 THEN 32154 WHEN l_orderkey % 61 = 0 THEN 20991231
  ELSE {_DAY.format("o_orderdate")} END AS INT) AS sls_order_dt,
 CAST({_DAY.format("l_shipdate")} AS INT) AS sls_ship_dt,
 CAST(CASE WHEN l_orderkey % 59 = 0 THEN NULL ELSE {_DAY.format("d")} END AS INT) AS sls_due_dt,
 CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN 0 WHEN l_partkey % 23 = 0 THEN q*p+7 ELSE q*p END AS sls_sales,
 CASE WHEN l_partkey % 43 = 0 AND l_partkey % 41 <> 0 THEN NULL WHEN l_partkey % 41 = 0 THEN 0 ELSE q END AS sls_quantity,
 CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN -p ELSE p END AS sls_price
FROM (SELECT l.*, o_custkey, o_orderdate, CAST(l_shipdate AS DATE)+12 AS d, CAST(l_quantity AS INT) AS q, CAST(floor(l_extendedprice/l_quantity) AS INT) AS p
 FROM lineitem l JOIN orders o ON l_orderkey=o_orderkey) t""",
    "erp_cust_az12": f"""
SELECT concat(CASE WHEN c_custkey % 2 = 0 THEN 'NAS' ELSE '' END,'AW',{_ZEROS.format('c_custkey', 8)}) AS cid,
 DATE '1920-01-01' + CAST((c_custkey*37) % 40000 AS INT) AS bdate,
 CASE c_custkey % 6 WHEN 0 THEN 'F' WHEN 1 THEN 'Female' WHEN 2 THEN ' m' WHEN 3 THEN 'MALE ' WHEN 4 THEN '' ELSE NULL END AS gen FROM customer
UNION ALL
SELECT concat('NASEX',{_ZEROS.format('s_suppkey', 8)}), DATE '1920-01-01' + CAST((s_suppkey*6007) % 45000 AS INT),
 CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'male' END FROM supplier""",
    "erp_loc_a101": f"""
SELECT concat('AW-',{_ZEROS.format('c_custkey', 8)}) AS cid,
 CASE c_nationkey % 6 WHEN 0 THEN 'DE' WHEN 1 THEN ' US' WHEN 2 THEN 'USA' WHEN 3 THEN '  ' WHEN 4 THEN NULL ELSE concat(n_name,' ') END AS cntry
FROM customer JOIN nation ON c_nationkey=n_nationkey""",
    "erp_pc_cat_g1v2": """
SELECT DISTINCT concat(upper(substring(p_type,1,2)),'_B',right(p_brand,1)) AS id, CASE WHEN p_type='LARGE' THEN concat(' ',p_type) ELSE p_type END AS cat,
 CASE right(p_brand,1) WHEN '1' THEN 'Brand1 ' ELSE concat('Brand',right(p_brand,1)) END AS subcat,
 CASE right(p_brand,1) WHEN '0' THEN 'Yes' WHEN '2' THEN ' Yes' WHEN '4' THEN 'Yes' ELSE 'No' END AS maintenance
FROM part WHERE NOT (p_type='PROMO' AND right(p_brand,1)='7')""",
}


def _label(value: str, **labels: str) -> str:
    """A lookup in a literal MAP, 'n/a' where the code is absent."""
    entries = ", ".join(f"'{code}': '{label}'" for code, label in labels.items())
    return f"coalesce((MAP {{{entries}}})[upper(trim({value}))], 'n/a')"


def _date(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN length({text}) = 8 THEN CAST(strptime({text}, '%Y%m%d') AS DATE) END AS {column}"


LAYERS = {
    "silver_customers": f"""
SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
 {_label("cst_material_status", S="Single", M="Married")} AS cst_material_status,
 {_label("cst_gndr", F="Female", M="Male")} AS cst_gndr, cst_create_date
FROM crm_cust_info WHERE cst_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY cst_id ORDER BY cst_create_date DESC NULLS LAST, cst_key DESC NULLS LAST,
 cst_firstname DESC NULLS LAST, cst_lastname DESC NULLS LAST) = 1""",
    "silver_products": f"""
SELECT prd_id, replace(left(prd_key, 5), '-', '_') AS cat_id, substring(prd_key, 7) AS prd_key, prd_nm,
 coalesce(prd_cost, 0) AS prd_cost,
 {_label("prd_line", M="Mountain", R="Road", S="Other Sales", T="Touring")} AS prd_line,
 CAST(prd_start_dt AS DATE) AS prd_start_dt,
 CAST(lead(prd_start_dt) OVER (PARTITION BY p.prd_key ORDER BY p.prd_start_dt NULLS FIRST, prd_id NULLS FIRST, prd_nm NULLS FIRST,
  p.prd_cost NULLS FIRST) AS DATE) - 1 AS prd_end_dt
FROM crm_prd_info p""",
    "silver_sales": f"""
SELECT sls_ord_num, sls_prd_key, sls_cust_id, {_date("sls_order_dt")}, {_date("sls_ship_dt")}, {_date("sls_due_dt")},
 CASE WHEN sls_sales > 0 AND (sls_quantity * abs(sls_price) IS NULL OR sls_sales = sls_quantity * abs(sls_price)) THEN sls_sales
  ELSE sls_quantity * abs(sls_price) END AS sls_sales,
 sls_quantity,
 CASE WHEN sls_price > 0 THEN sls_price WHEN sls_quantity <> 0 THEN CAST(sls_sales // sls_quantity AS INT) END AS sls_price
FROM crm_sales_details""",
    "silver_people": f"""
SELECT regexp_replace(cid, '^NAS', '') AS cid, CASE WHEN bdate <= {AS_OF} THEN bdate END AS bdate,
 {_label("gen", F="Female", FEMALE="Female", M="Male", MALE="Male")} AS gen
FROM erp_cust_az12""",
    "silver_new_people": """
SELECT * FROM silver_people WHERE cid NOT IN (SELECT cst_key FROM silver_customers)""",
    "silver_locations": """
SELECT replace(cid, '-', '') AS cid,
 coalesce((MAP {'DE': 'Germany', 'US': 'United States', 'USA': 'United States'})[trim(cntry)], nullif(trim(cntry), ''), 'n/a') AS cntry
FROM erp_loc_a101""",
    "silver_categories": """
SELECT id, trim(cat) AS cat, trim(subcat) AS subcat, trim(maintenance) AS maintenance FROM erp_pc_cat_g1v2""",
    "dim_customers": """
SELECT row_number() OVER (ORDER BY cst_id) AS customer_key, cst_id AS customer_id, cst_key AS customer_number,
 cst_firstname AS firstname, cst_lastname AS lastname, cst_material_status AS marital_status,
 coalesce(nullif(cst_gndr, 'n/a'), gen, 'n/a') AS gender, cst_create_date AS create_date, bdate AS birthdate, cntry AS country
FROM silver_customers LEFT JOIN silver_new_people p ON cst_key = p.cid LEFT JOIN silver_locations l ON cst_key = l.cid""",
    "dim_customers_enriched": """
SELECT row_number() OVER (ORDER BY cst_id) AS customer_key, cst_id AS customer_id, cst_key AS customer_number,
 cst_firstname AS firstname, cst_lastname AS lastname, cst_material_status AS marital_status,
 coalesce(nullif(cst_gndr, 'n/a'), gen, 'n/a') AS gender, cst_create_date AS create_date, bdate AS birthdate, cntry AS country
FROM silver_customers LEFT JOIN silver_people p ON cst_key = p.cid LEFT JOIN silver_locations l ON cst_key = l.cid""",
    "dim_products": """
SELECT row_number() OVER (ORDER BY prd_start_dt NULLS FIRST, prd_key NULLS FIRST, prd_id) AS product_key, prd_id AS product_id,
 prd_key AS product_number, prd_nm AS product_name, cat_id AS category_id, cat AS category, subcat AS subcategory, maintenance,
 prd_cost AS cost, prd_line AS product_line, prd_start_dt AS start_date
FROM silver_products LEFT JOIN silver_categories ON cat_id = id WHERE prd_end_dt IS NULL""",
    "sales_star": """
SELECT s.sls_ord_num AS order_number, s.sls_prd_key, s.sls_cust_id, s.sls_order_dt AS order_date, s.sls_ship_dt AS shipping_date,
 s.sls_due_dt AS due_date, s.sls_sales AS sales_amount, s.sls_quantity AS quantity, s.sls_price, p.*, c.*
FROM silver_sales s LEFT JOIN dim_products p ON s.sls_prd_key = p.product_number
 LEFT JOIN dim_customers c ON s.sls_cust_id = c.customer_id""",
    "fact_sales": """
SELECT order_number, product_key, customer_key, sls_prd_key, sls_cust_id, order_date, shipping_date, due_date, sales_amount, quantity, sls_price
FROM sales_star""",
}

_ALL = FEEDS | LAYERS


# Master data that repeats ids, and versions under a second spelling of their key.
REPEATED = {
    "crm_prd_info": f"""
SELECT * FROM ({FEEDS["crm_prd_info"]})
UNION ALL SELECT prd_id, concat(left(prd_key, 2), '_', substring(prd_key, 4)), prd_nm, prd_cost, prd_line, prd_start_dt, prd_end_dt
FROM ({FEEDS["crm_prd_info"]}) WHERE CAST(substring(prd_key, 8) AS BIGINT) % 9 = 4""",
    "erp_cust_az12": f"""
SELECT * FROM ({FEEDS["erp_cust_az12"]}) UNION ALL SELECT * FROM ({FEEDS["erp_cust_az12"]}) WHERE right(cid, 2) IN ('00', '50')""",
    "erp_loc_a101": f"""
SELECT * FROM ({FEEDS["erp_loc_a101"]}) UNION ALL SELECT * FROM ({FEEDS["erp_loc_a101"]}) WHERE right(cid, 2) IN ('00', '50')""",
    "erp_pc_cat_g1v2": f"""
SELECT * FROM ({FEEDS["erp_pc_cat_g1v2"]}) UNION ALL SELECT * FROM ({FEEDS["erp_pc_cat_g1v2"]}) WHERE right(id, 1) IN ('0', '3', '6')""",
}


def _needs(sql: str) -> list[str]:
    return [name for name in _ALL if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql)]


def query(sql: str, instead: dict[str, str] | None = None) -> str:
    """``sql`` preceded by the common table expressions it reads, inner ones first; ``instead`` redefines some."""
    defined = _ALL | (instead or {})
    needed: set[str] = set()
    pending = _needs(sql)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += _needs(defined[name])
    parts = [f"{name} AS ({defined[name]}\n)" for name in _ALL if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql.strip()
