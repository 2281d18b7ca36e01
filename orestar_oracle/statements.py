"""One DuckDB statement per registered query."""

from __future__ import annotations

from orestar_oracle.layers import AS_OF, FEEDS, REPEATED, query

_CUSTOMER_FEED = "SELECT cst_id, cst_key, cst_firstname, cst_lastname, cst_material_status, cst_gndr, cst_create_date FROM crm_cust_info"


def _metrics(check_id: str, table: str, source: str, severity: str = "WARN", **metrics: str) -> str:
    """One result row per metric; a metric is a count expression over ``source``."""
    rows = []
    for metric, value in metrics.items():
        bad = "INFO" if metric == "rows_checked" or severity == "INFO" else severity
        ok = "INFO" if bad == "INFO" else "PASS"
        rows.append(
            f"SELECT '{check_id}' AS check_id, '{table}' AS table_name, '{metric}' AS metric, CAST(v AS BIGINT) AS value,"
            f" CASE WHEN coalesce(v, 0) = 0 THEN '{ok}' ELSE '{bad}' END AS status"
            f" FROM (SELECT {value} AS v FROM {source})"
        )
    return "\nUNION ALL ".join(rows)


def _where(rule: str) -> str:
    return f"count(*) FILTER ({rule})"


_DATE_RULES = {
    "zero_or_negative": "sls_order_dt <= 0",
    "wrong_length": "length(CAST(sls_order_dt AS VARCHAR)) <> 8",
    "future_date": "sls_order_dt > 20500101",
    "past_date": "sls_order_dt < 19000101",
}
_MEASURE_RULES = {
    "null_sales": "sls_sales IS NULL",
    "null_quantity": "sls_quantity IS NULL",
    "null_price": "sls_price IS NULL",
    "non_positive_sales": "sls_sales <= 0",
    "non_positive_quantity": "sls_quantity <= 0",
    "non_positive_price": "sls_price <= 0",
    "calculation_mismatch": "sls_sales <> sls_quantity * sls_price",
}
_PADDING_RULES = {
    "category_spaces": "cat <> trim(cat)",
    "subcategory_spaces": "subcat <> trim(subcat)",
    "maintenance_spaces": "maintenance <> trim(maintenance)",
}
_BIRTH_RULES = {"too_old": "bdate < DATE '1924-01-01'", "future_date": f"bdate > {AS_OF}"}
_SEQUENCE_RULES = {"order_after_ship": "sls_order_dt > sls_ship_dt", "order_after_due": "sls_order_dt > sls_due_dt"}


def _total(check_id: str, table: str, source: str, metric: str, rules: dict[str, str]) -> str:
    return _metrics(check_id, table, source, **{metric: _where(" OR ".join(rules.values()))})


def _by_rule(check_id: str, table: str, source: str, rules: dict[str, str]) -> str:
    metrics = {metric: _where(rule) for metric, rule in rules.items()}
    return _metrics(check_id, table, source, **metrics, rows_checked="count(*)")


_COMPARABLE = "silver_sales WHERE sls_order_dt IS NOT NULL AND (sls_ship_dt IS NOT NULL OR sls_due_dt IS NOT NULL)"


def _unlisted(check_id: str, derived: str, key: str, source: str) -> str:
    missing = f"crm_prd_info WHERE {derived} NOT IN (SELECT {key} FROM {source})"
    return (
        _metrics(check_id, "bronze.crm_prd_info", missing, affected_products="count(DISTINCT prd_id)", affected_rows="count(*)")
        + "\nUNION ALL "
        + _metrics(check_id, "bronze.crm_prd_info", source, null_keys_in_list=_where(f"{key} IS NULL"))
    )


_REPEATED = "(SELECT {0}, count(*) AS n FROM {1} GROUP BY {0})"

METRIC_CHECKS = {
    "v1": _metrics("v1", "bronze.crm_cust_info", "crm_cust_info", null_customer_ids=_where("cst_id IS NULL")),
    "v4": _unlisted("v4", "replace(left(prd_key, 5), '-', '_')", "id", "erp_pc_cat_g1v2"),
    "v5": _unlisted("v5", "substring(prd_key, 7)", "sls_prd_key", "crm_sales_details"),
    "v7": _metrics(
        "v7", "silver.crm_prd_info", _REPEATED.format("prd_id", "silver_products"), "FAIL",
        affected_rows="coalesce(sum(n) FILTER (n > 1 OR prd_id IS NULL), 0)",
    ),
    "v8": _metrics("v8", "bronze.crm_prd_info", "crm_prd_info", invalid_date_ranges=_where("prd_end_dt < prd_start_dt")),
    "v9": _metrics("v9", "silver.crm_prd_info", "silver_products", invalid_date_ranges=_where("prd_end_dt < prd_start_dt")),
    "v10": _metrics("v10", "silver.crm_prd_info", "silver_products", cost_issues=_where("prd_cost < 0 OR prd_cost IS NULL")),
    "v14": _total("v14", "bronze.crm_sales_details", "crm_sales_details", "invalid_dates", _DATE_RULES),
    "v15": _by_rule("v15", "bronze.crm_sales_details", "crm_sales_details", _DATE_RULES),
    "v16": _total("v16", "bronze.crm_sales_details", "crm_sales_details", "inconsistent_rows", _MEASURE_RULES),
    "v17": _by_rule("v17", "bronze.crm_sales_details", "crm_sales_details", _MEASURE_RULES),
    "v18": _total("v18", "silver.crm_sales_details", "silver_sales", "invalid_date_order", _SEQUENCE_RULES),
    "v19": _by_rule("v19", "silver.crm_sales_details", _COMPARABLE, _SEQUENCE_RULES),
    "v20": _metrics(
        "v20", "bronze.erp_cust_az12",
        "erp_cust_az12 WHERE regexp_replace(cid, '^NAS', '') IN (SELECT cst_key FROM silver_customers)",
        duplicate_count="count(*)",
    ),
    "v21": _total("v21", "silver.erp_cust_az12", "silver_new_people", "birthdates_out_of_range", _BIRTH_RULES),
    "v22": _by_rule("v22", "silver.erp_cust_az12", "silver_new_people", _BIRTH_RULES),
    "v27": _total("v27", "bronze.erp_pc_cat_g1v2", "erp_pc_cat_g1v2", "unwanted_spaces", _PADDING_RULES),
    "v28": _by_rule("v28", "bronze.erp_pc_cat_g1v2", "erp_pc_cat_g1v2", _PADDING_RULES),
    "v32": _metrics(
        "v32", "silver.crm_prd_info", "silver_products p WHERE NOT EXISTS (FROM silver_categories c WHERE c.id = p.cat_id)", "FAIL",
        products_without_valid_category="count(*)",
    ),
    "v33": _metrics(
        "v33", "silver.crm_sales_details", "silver_sales s WHERE NOT EXISTS (FROM silver_products p WHERE p.prd_key = s.sls_prd_key)", "FAIL",
        unknown_products="count(DISTINCT sls_prd_key)",
    ),
    "v34": _metrics(
        "v34", "silver.crm_sales_details", "silver_sales s WHERE NOT EXISTS (FROM silver_customers c WHERE c.cst_id = s.sls_cust_id)", "FAIL",
        unknown_customers="count(DISTINCT sls_cust_id)",
    ),
}


def _overlap(people: str) -> str:
    both = f"(SELECT * FROM silver_customers FULL JOIN (SELECT DISTINCT cid FROM {people}) ON cst_key = cid)"
    return _metrics(
        "v31", "silver.crm_cust_info", both, "INFO",
        crm_customers="count(DISTINCT cst_key)",
        erp_customers="count(DISTINCT cid)",
        in_both_systems="count(DISTINCT cst_key) FILTER (cid IS NOT NULL)",
        only_in_crm="count(DISTINCT cst_key) FILTER (cid IS NULL)",
        only_in_erp="count(DISTINCT cid) FILTER (cst_key IS NULL)",
    )


METRIC_CHECKS["v31"] = _overlap("silver_new_people")


def _counts(source: str, **columns: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{label}' AS label, {column} AS value, count(*) AS row_count FROM {source} GROUP BY {column}"
        for column, label in columns.items()
    )


_DOMAINS = {"cat": "Categories", "subcat": "Subcategories", "maintenance": "Maintenance"}

LISTINGS = {
    "v2": "SELECT cst_id, count(*) AS duplicate_count FROM silver_customers GROUP BY cst_id HAVING count(*) > 1",
    "v3": _counts("silver_customers", cst_gndr="Gender Distribution", cst_material_status="Marital Status Distribution"),
    "v6": "SELECT prd_id, count(*) AS duplicate_count FROM silver_products GROUP BY prd_id HAVING count(*) > 1 OR prd_id IS NULL",
    "v11": "SELECT DISTINCT prd_line FROM silver_products",
    "v12": _counts("silver_products", prd_line="Product Line Distribution"),
    "v13": """SELECT prd_key, prd_start_dt, prd_id, prd_end_dt,
 lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt NULLS FIRST, prd_id NULLS FIRST, prd_end_dt NULLS FIRST) AS next_start_dt
FROM crm_prd_info""",
    "v23": "SELECT DISTINCT gen, 'Standardized' AS status FROM silver_new_people",
    "v24": _counts("silver_new_people", gen="Gender Distribution"),
    "v25": "SELECT DISTINCT cntry FROM silver_locations ORDER BY cntry",
    "v26": _counts("silver_locations", cntry="Country Distribution") + " ORDER BY value",
    "v29": "SELECT label, value FROM (" + _counts("erp_pc_cat_g1v2", **_DOMAINS) + ")",
    "v30": "SELECT * FROM (" + _counts("silver_categories", **_DOMAINS) + ") ORDER BY label, value",
}

_SILVER_OF = {
    "crm_cust_info": "silver_customers",
    "crm_prd_info": "silver_products",
    "crm_sales_details": "silver_sales",
    "erp_cust_az12": "silver_new_people",
    "erp_loc_a101": "silver_locations",
    "erp_pc_cat_g1v2": "silver_categories",
}

LISTINGS["v35"] = "\nUNION ALL ".join(
    f"SELECT '{raw}' AS table_name, (SELECT count(*) FROM {clean}) AS silver_rows, (SELECT count(*) FROM {raw}) AS bronze_rows"
    for raw, clean in _SILVER_OF.items()
)

_SUITE_V2 = _metrics("v2", "silver.crm_cust_info", "(" + LISTINGS["v2"] + ")", "FAIL", duplicate_ids="count(*)")
_SUITE = "\nUNION ALL ".join([*METRIC_CHECKS.values(), _SUITE_V2])



def _listed(check_id: str, table: str, metric: str, value: str) -> str:
    return f"SELECT '{check_id}' AS check_id, '{table}' AS table_name, {metric} AS metric, CAST({value} AS BIGINT) AS value, 'INFO' AS status FROM ({LISTINGS[check_id]})"


_BY_VALUE = "label || ': ' || coalesce(value, 'NULL')"
_FULL_SUITE = "\nUNION ALL ".join(
    [
        _SUITE,
        _metrics("v6", "silver.crm_prd_info", f"({LISTINGS['v6']})", listed="count(*)"),
        _metrics("v13", "bronze.crm_prd_info", f"({LISTINGS['v13']})", "INFO", listed="count(*)"),
        *[
            _listed(check_id, f"silver.{table}", _BY_VALUE, "row_count")
            for check_id, table in (("v3", "crm_cust_info"), ("v12", "crm_prd_info"), ("v24", "erp_cust_az12"), ("v26", "erp_loc_a101"), ("v30", "erp_pc_cat_g1v2"))
        ],
        *[
            _listed(check_id, f"silver.{table}", f"coalesce({column}, 'NULL')", "1")
            for check_id, table, column in (("v11", "crm_prd_info", "prd_line"), ("v23", "erp_cust_az12", "gen"), ("v25", "erp_loc_a101", "cntry"))
        ],
        _listed("v29", "bronze.erp_pc_cat_g1v2", _BY_VALUE, "1"),
        *[
            f"SELECT 'v35' AS check_id, table_name, '{layer}_rows' AS metric, {layer}_rows AS value, 'INFO' AS status FROM ({LISTINGS['v35']})"
            for layer in ("silver", "bronze")
        ],
    ]
)

_SUM = "CAST(sum({0}) AS BIGINT)"
_SALES, _UNITS = _SUM.format("sales_amount") + " AS total_sales", _SUM.format("quantity") + " AS units"
_MEASURES = f"{_SALES}, count(DISTINCT order_number) AS orders, {_UNITS}"
_PRODUCTS = f"""SELECT product_key, product_number, product_name, count(DISTINCT order_number) AS orders,
 count(DISTINCT customer_key) AS buyers, {_UNITS}, {_SALES}, CAST(sum(sales_amount) AS DOUBLE) / nullif(CAST(sum(quantity) AS DOUBLE), 0) AS avg_price
FROM sales_star WHERE product_key IS NOT NULL GROUP BY ALL"""
_COST = "CAST(quantity AS BIGINT) * cost"


def _guard(people: str) -> str:
    """Rows of each join less the rows on its left."""
    joins = {
        "customer_demographics": ("silver_customers", f"{people} r ON cst_key = r.cid"),
        "customer_location": ("silver_customers", "silver_locations r ON cst_key = r.cid"),
        "product_category": ("(SELECT * FROM silver_products WHERE prd_end_dt IS NULL)", "silver_categories r ON cat_id = r.id"),
        "sales_product": ("silver_sales", "(SELECT * FROM silver_products WHERE prd_end_dt IS NULL) r ON sls_prd_key = r.prd_key"),
        "sales_customer": ("silver_sales", "silver_customers r ON sls_cust_id = r.cst_id"),
    }
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS join_name, (SELECT count(*) FROM {left} LEFT JOIN {right}) - (SELECT count(*) FROM {left}) AS extra_rows"
        for name, (left, right) in joins.items()
    )


_GOLD_AND_REPORTS = {
    "gold_surrogate_keys": """SELECT 'customer' AS dimension, customer_key AS surrogate, customer_id AS business_id FROM dim_customers
UNION ALL SELECT 'product', product_key, product_id FROM dim_products""",
    "gold_dim_customers": "SELECT * FROM dim_customers",
    "gold_dim_customers_enriched": "SELECT * FROM dim_customers_enriched",
    "gold_dim_products": "SELECT * FROM dim_products",
    "gold_fact_sales": "SELECT * FROM fact_sales",
    "gold_fk_check": "SELECT f.* FROM fact_sales f WHERE NOT EXISTS (FROM dim_products p WHERE p.product_key = f.product_key)",
    "gold_fk_check_customer": "SELECT f.* FROM fact_sales f LEFT JOIN dim_customers c USING (customer_key) WHERE c.customer_id IS NULL",
    "gold_join_guard": _guard("silver_new_people"),
    "report_sales_by_country": f"SELECT country, {_MEASURES} FROM sales_star GROUP BY country",
    "report_revenue_by_category": f"SELECT category, subcategory, {_MEASURES} FROM sales_star GROUP BY ALL",
    "report_sales_trend": f"""SELECT *, CAST(sum(total_sales) OVER (ORDER BY order_year NULLS FIRST, order_month NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_sales
FROM (SELECT CAST(year(order_date) AS INT) AS order_year, CAST(month(order_date) AS INT) AS order_month, {_MEASURES} FROM sales_star GROUP BY ALL)""",
    "report_profit": f"""SELECT category, {_SALES}, {_SUM.format(_COST)} AS total_cost, {_SUM.format("sales_amount - " + _COST)} AS profit
FROM sales_star WHERE product_key IS NOT NULL GROUP BY category""",
    "report_customers": f"""SELECT customer_key, customer_number, count(DISTINCT order_number) AS orders, {_UNITS}, {_SALES},
 min(order_date) AS first_order, max(order_date) AS last_order, CAST(sum(sales_amount) AS DOUBLE) / CAST(count(DISTINCT order_number) AS DOUBLE) AS avg_order_value
FROM sales_star WHERE customer_key IS NOT NULL GROUP BY ALL""",
    "report_products": _PRODUCTS,
    "report_products_top": _PRODUCTS + " ORDER BY total_sales DESC NULLS LAST, product_key LIMIT 10",
    "fact_sales_point_in_time": """SELECT s.sls_ord_num AS order_number, s.sls_prd_key, s.sls_order_dt AS order_date, s.sls_sales AS sales_amount,
 s.sls_quantity AS quantity, v.prd_id AS product_id, v.prd_start_dt AS version_start, v.prd_end_dt AS version_end, v.prd_cost AS cost_at_sale
FROM silver_sales s LEFT JOIN silver_products v
 ON v.prd_key = s.sls_prd_key AND s.sls_order_dt BETWEEN v.prd_start_dt AND coalesce(v.prd_end_dt, DATE '9999-12-31')""",
    "report_sales_by_customer_attr": "\nUNION ALL ".join(
        f"SELECT '{a}' AS attribute, {a} AS value, {_SALES}, {_UNITS} FROM sales_star GROUP BY {a}"
        for a in ("gender", "country", "marital_status")
    ),
    "report_sales_by_product_line": f"SELECT product_line, {_MEASURES} FROM sales_star GROUP BY product_line",
    # An estimate that misses its stated error shows as a difference.
    **{
        f"report_distinct_counts_by_{name}": f"""SELECT {by}, count(DISTINCT order_number) AS orders, count(DISTINCT customer_key) AS buyers,
 count(DISTINCT product_key) AS products, {_SALES}, true AS orders_within_error, true AS buyers_within_error, true AS products_within_error
FROM (SELECT *, CAST(year(order_date) AS INT) AS order_year FROM sales_star) GROUP BY ALL"""
        for name, by in (("year", "order_year"), ("line", "order_year, product_line"))
    },
    "report_sales_by_cost": f"SELECT CAST(floor(cost / 100.0) AS BIGINT) * 100 AS cost_from, {_MEASURES} FROM sales_star GROUP BY ALL",
}

_GOLD_AND_REPORTS["check_v34_all_masters"] = _metrics(
    "v34",
    "silver.crm_sales_details",
    """silver_sales s WHERE NOT EXISTS (
 FROM (SELECT CAST(cst_id AS VARCHAR) AS k FROM silver_customers UNION SELECT cst_key FROM silver_customers UNION SELECT cid FROM silver_people)
 WHERE k = CAST(sls_cust_id AS VARCHAR) OR k = 'AW' || lpad(CAST(sls_cust_id AS VARCHAR), CAST(greatest(8, length(CAST(sls_cust_id AS VARCHAR))) AS INTEGER), '0'))""",
    "FAIL",
    unknown_to_all="count(DISTINCT sls_cust_id)",
)

_GOLD_AND_REPORTS["report_summaries"] = "\nUNION ALL BY NAME ".join(
    f"SELECT *, '{name}' AS report FROM ({_GOLD_AND_REPORTS[query]})"
    for name, query in {
        "sales_by_country": "report_sales_by_country", "revenue_by_category": "report_revenue_by_category",
        "sales_trend": "report_sales_trend", "profit": "report_profit", "sales_by_customer_attribute": "report_sales_by_customer_attr",
        "sales_by_product_line": "report_sales_by_product_line", "sales_by_cost": "report_sales_by_cost",
    }.items()
)

# A field left empty in a CSV file reads back as NULL.
_EMPTY_AS_NULL = {"erp_cust_az12": "SELECT cid, bdate, nullif(gen, '') AS gen FROM erp_cust_az12"}

_BRONZE = {f"bronze_ingest_{table}": _EMPTY_AS_NULL.get(table, f"SELECT * FROM {table}") for table in FEEDS}
_FIELDS = ("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_quantity", "sls_price")
_FAULTY = {
    "sls_quantity": "CASE n % 7 WHEN 1 THEN 'many' ELSE CAST(sls_quantity AS VARCHAR) END",
    "sls_ord_num": "CASE n % 7 WHEN 2 THEN rpad(sls_ord_num, 60, '0') ELSE sls_ord_num END",
}
_TEXT = " || ',' || ".join(f"coalesce({_FAULTY.get(f, f'CAST({f} AS VARCHAR)')}, '')" for f in _FIELDS)
_BRONZE["bronze_rejects"] = f"""SELECT 'crm_sales_details' AS table_name, CASE n % 7 WHEN 1 THEN 'malformed' ELSE 'over_long' END AS reason,
 CASE n % 7 WHEN 1 THEN 'sls_quantity' ELSE 'sls_ord_num' END AS faults, {_TEXT} AS line
FROM (SELECT *, CAST(substring(sls_ord_num, 3) AS BIGINT) AS n FROM crm_sales_details) WHERE n % 7 IN (1, 2)"""

_SILVER = {
    "silver_customers": "SELECT * FROM silver_customers",
    "silver_products": "SELECT * FROM silver_products",
    "silver_sales": "SELECT * FROM silver_sales",
    "silver_sales_preview": """SELECT * FROM silver_sales ORDER BY sls_ord_num NULLS FIRST, sls_prd_key NULLS FIRST, sls_cust_id NULLS FIRST,
 sls_order_dt NULLS FIRST, sls_ship_dt NULLS FIRST, sls_due_dt NULLS FIRST, sls_sales NULLS FIRST, sls_quantity NULLS FIRST, sls_price NULLS FIRST LIMIT 5""",
    "silver_erp_customers": "SELECT * FROM silver_people",
    "silver_erp_customers_new": "SELECT * FROM silver_new_people",
    "silver_locations": "SELECT * FROM silver_locations",
    "silver_categories_raw": "SELECT * FROM erp_pc_cat_g1v2",
    "silver_categories": "SELECT * FROM silver_categories",
}

_LOAD_COUNTS = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, (SELECT count(*) FROM {source}) AS rows_loaded, 'LOADED' AS status"
    for layer, tables in (
        ("bronze", {t: t for t in FEEDS}),
        ("silver", _SILVER_OF),
        ("gold", {t: t for t in ("dim_customers", "dim_products", "fact_sales")}),
    )
    for name, source in tables.items()
)

_LOAD_FAILURES = " UNION ALL ".join(
    f"SELECT 'bronze' AS layer, '{name}' AS table_name, 'LOADED' AS status, (SELECT count(*) FROM {name}) AS rows_loaded, 0 AS rows_rejected,"
    " CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS condition, true AS timed, CAST(NULL AS VARCHAR) AS step"
    if name != "crm_sales_details"
    else "SELECT 'bronze', 'crm_sales_details', 'FAILED', NULL, NULL, 'ValueError: ' || count(*) || ' lines do not fit crm_sales_details', NULL, true, 'plans/warehouse.py'"
    " FROM crm_sales_details WHERE CAST(substring(sls_ord_num, 3) AS BIGINT) % 7 IN (1, 2)"
    for name in sorted(FEEDS, key=lambda t: t == "crm_sales_details")
)


def statements() -> dict[str, str]:
    plain = _BRONZE | _SILVER | _GOLD_AND_REPORTS
    plain |= {f"check_{check_id}": sql for check_id, sql in (METRIC_CHECKS | LISTINGS).items()}
    plain["check_v21_all"] = _total("v21", "silver.erp_cust_az12", "silver_people", "birthdates_out_of_range", _BIRTH_RULES)
    plain["check_v22_all"] = _by_rule("v22", "silver.erp_cust_az12", "silver_people", _BIRTH_RULES)
    plain["check_v24_all"] = _counts("silver_people", gen="Gender Distribution")
    plain["check_v31_all"] = _overlap("silver_people")
    plain["check_v2_stored_repeats"] = "SELECT cst_id, count(*) AS duplicate_count FROM crm_cust_info GROUP BY cst_id HAVING count(*) > 1"
    plain["check_v13_sample"] = LISTINGS["v13"] + " WHERE prd_key IN (SELECT DISTINCT prd_key FROM crm_prd_info ORDER BY prd_key LIMIT 2)"
    plain["quality_suite"] = _SUITE
    plain["load_reconciliation"] = _LOAD_COUNTS
    plain["load_failures"] = _LOAD_FAILURES
    category = FEEDS["erp_pc_cat_g1v2"]
    changed = {
        "gold_join_guard_repeats": (_guard("silver_people"), REPEATED),
        # Over everyone, as the layers with repeats are.
        "quality_suite_full": (_FULL_SUITE.replace("silver_new_people", "silver_people"), REPEATED),
        "fact_sales_point_in_time_overlaps": (_GOLD_AND_REPORTS["fact_sales_point_in_time"], REPEATED),
        "check_v4_null_listed": (
            METRIC_CHECKS["v4"],
            {"erp_pc_cat_g1v2": f"SELECT CASE WHEN id <> 'LA_B1' THEN id END AS id, cat, subcat, maintenance FROM ({category})"},
        ),
        "check_v4_empty_list": (METRIC_CHECKS["v4"], {"erp_pc_cat_g1v2": f"SELECT * FROM ({category}) WHERE false"}),
    }
    return {name: query(sql) for name, sql in plain.items()} | {name: query(*parts) for name, parts in changed.items()}
