"""The catalogue of data-quality checks, V1 to V35.

Checks that are predicates on one table are data (``table_checks``) and run
together, one aggregation per table. Checks that list values or compare tables
are functions of the layers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestar.functions import cleansing as c
from orestar.operators.anti_join import anti_join_null_aware, few_copies
from orestar.operators.presence import Holder, has, not_in, only_in, presence
from orestar.operators.profile import Listing, Profile, profile_results
from orestar.operators.quality import (
    FAIL, INFO, PASS, WARN, Check, metric_rows, result_rows, run_checks, union_all, value_counts,
)
from orestar.operators.sequence import with_next
from orestar.plans import gold
from orestar.workspace import materialise

Tables = Mapping[str, DataFrame]

# The usual sample products of the validity preview, the
# plausible range of an order date, the oldest plausible birth date.
SAMPLE_PRODUCTS = ("AC-HE-HL-U509-R", "AC-HE-HL-U509")
FIRST_ORDER_DATE, LAST_ORDER_DATE = 19000101, 20500101
OLDEST_BIRTHDATE = dt.date(1924, 1, 1)


def int_date_rules(name: str) -> dict[str, str]:
    return {
        "zero_or_negative": f"{name} <= 0",
        "wrong_length": f"NOT {c.is_eight_long(name)}",
        "future_date": f"{name} > {LAST_ORDER_DATE}",
        "past_date": f"{name} < {FIRST_ORDER_DATE}",
    }


def measure_rules() -> dict[str, str]:
    """Rules of a consistent sale. The price keeps its sign here."""
    measures = ("sales", "quantity", "price")
    return {
        **{f"null_{name}": f"sls_{name} IS NULL" for name in measures},
        **{f"non_positive_{name}": f"sls_{name} <= 0" for name in measures},
        "calculation_mismatch": "sls_sales <> sls_quantity * sls_price",
    }


def padding_rules() -> dict[str, str]:
    columns = {"category_spaces": "cat", "subcategory_spaces": "subcat", "maintenance_spaces": "maintenance"}
    return {metric: f"{name} <> trim({name})" for metric, name in columns.items()}


def _total(check_id: str, metric: str, rules: Mapping[str, str]) -> Check:
    """Rows that break any of the rules."""
    return Check(check_id, metric, " OR ".join(rules.values()))


def _by_rule(check_id: str, rules: Mapping[str, str], within: str = "true") -> list[Check]:
    """Rows that break each rule, and the rows looked at."""
    broken = [Check(check_id, name, rule, within=within, null_when_empty=True) for name, rule in rules.items()]
    return [*broken, Check(check_id, "rows_checked", within=within)]


def table_checks(
    as_of: dt.date | None = None, int_dates: Sequence[str] = ("sls_order_dt",)
) -> dict[str, list[Check]]:
    """Predicate checks by ``layer.table``. ``int_dates`` are the raw dates whose range is checked."""
    if len(int_dates) == 1:
        dates = int_date_rules(int_dates[0])
    else:
        dates = {f"{name}_{m}": rule for name in int_dates for m, rule in int_date_rules(name).items()}
    sequence = {
        "order_after_ship": "sls_order_dt > sls_ship_dt",
        "order_after_due": "sls_order_dt > sls_due_dt",
    }
    comparable = "sls_order_dt IS NOT NULL AND coalesce(sls_ship_dt, sls_due_dt) IS NOT NULL"
    birth = {
        "too_old": f"bdate < DATE '{OLDEST_BIRTHDATE.isoformat()}'",
        "future_date": f"bdate > {c.as_of_day(as_of)}",
    }
    ends_early = {"ends_early": "prd_end_dt < prd_start_dt"}
    cost = {"negative": "prd_cost < 0", "missing": "prd_cost IS NULL"}
    return {
        "bronze.crm_cust_info": [Check("v1", "null_customer_ids", "cst_id IS NULL")],
        "bronze.crm_prd_info": [_total("v8", "invalid_date_ranges", ends_early)],
        "silver.crm_prd_info": [
            _total("v9", "invalid_date_ranges", ends_early),
            _total("v10", "cost_issues", cost),
        ],
        "bronze.crm_sales_details": [
            _total("v14", "invalid_dates", dates),
            *_by_rule("v15", dates),
            _total("v16", "inconsistent_rows", measure_rules()),
            *_by_rule("v17", measure_rules()),
        ],
        "silver.crm_sales_details": [
            _total("v18", "invalid_date_order", sequence),
            *_by_rule("v19", sequence, within=comparable),
        ],
        "silver.erp_cust_az12": [
            _total("v21", "birthdates_out_of_range", birth),
            *_by_rule("v22", birth),
        ],
        "bronze.erp_pc_cat_g1v2": [
            _total("v27", "unwanted_spaces", padding_rules()),
            *_by_rule("v28", padding_rules()),
        ],
    }


def _table(bronze: Tables, silver: Tables, name: str) -> DataFrame:
    layer, table = name.split(".")
    return {"bronze": bronze, "silver": silver}[layer][table]


def predicate_ids() -> list[str]:
    return list(dict.fromkeys(check.check_id for checks in table_checks().values() for check in checks))


def predicate_check(check_id: str, bronze: Tables, silver: Tables, as_of: dt.date | None = None) -> DataFrame:
    for name, checks in table_checks(as_of).items():
        chosen = [check for check in checks if check.check_id == check_id]
        if chosen:
            return run_checks(_table(bronze, silver, name), name, chosen)
    raise KeyError(check_id)


def duplicate_keys(df: DataFrame, key: str, report_null: bool) -> DataFrame:
    counted = df.groupBy(key).agg(F.expr("count(*) AS duplicate_count"))
    return counted.where("duplicate_count > 1" + (f" OR {key} IS NULL" if report_null else ""))


def duplicate_rows(df: DataFrame, key: str, check_id: str, table: str) -> DataFrame:
    """Rows whose key is NULL or repeated, from the counts per key alone."""
    affected = duplicate_keys(df, key, report_null=True).selectExpr(
        "coalesce(sum(duplicate_count), 0) AS affected_rows"
    )
    return metric_rows(affected, check_id, table, FAIL)


def duplicate_customers(silver: Tables) -> DataFrame:
    repeated = duplicate_keys(silver["crm_cust_info"], "cst_id", report_null=False)
    return metric_rows(repeated.selectExpr("count(*) AS duplicate_ids"), "v2", "silver.crm_cust_info", FAIL)


def _unlisted(products: DataFrame, derived: str, listed: DataFrame, listed_key: str, check_id: str) -> DataFrame:
    """Products whose derived key is NOT IN a list: distinct ids, rows, NULLs in the list."""
    counted = products.groupBy(F.expr(f"{derived} AS derived_key"), "prd_id").agg(F.expr("count(*) AS n"))
    missing = anti_join_null_aware(counted, listed, "derived_key", listed_key).selectExpr(
        "count(DISTINCT prd_id) AS affected_products", "coalesce(sum(n), 0) AS affected_rows"
    )
    nulls = listed.selectExpr(f"count_if({listed_key} IS NULL) AS null_keys_in_list")
    return metric_rows(missing, check_id, "bronze.crm_prd_info").unionByName(
        metric_rows(nulls, check_id, "bronze.crm_prd_info")
    )


def missing_categories(bronze: Tables, silver: Tables) -> DataFrame:
    return _unlisted(bronze["crm_prd_info"], c.category_part("prd_key"), bronze["erp_pc_cat_g1v2"], "id", "v4")


def never_sold(bronze: Tables, silver: Tables) -> DataFrame:
    return _unlisted(
        bronze["crm_prd_info"], c.product_part("prd_key"), bronze["crm_sales_details"], "sls_prd_key", "v5"
    )


def validity_preview(bronze: Tables, keys: Sequence[str] | DataFrame = ()) -> DataFrame:
    """Each product version with the start of the next one; of the chosen products or of all.

    ``keys`` are product keys or a table with a ``prd_key`` column.
    """
    versions = bronze["crm_prd_info"]
    if isinstance(keys, DataFrame):
        versions = versions.join(few_copies(keys, "prd_key"), F.expr("prd_key = listed_key"), "left_semi")
    elif keys:
        versions = versions.where(F.col("prd_key").isin(*keys))
    dated = versions.selectExpr("prd_key", "prd_start_dt", "prd_id", "prd_end_dt", "CAST(prd_start_dt AS date) AS start_day")
    return with_next(dated, "prd_key", "prd_start_dt", out="next_start_dt", day="start_day").drop("start_day")


def already_in_crm(bronze: Tables, silver: Tables) -> DataFrame:
    people = bronze["erp_cust_az12"].groupBy(F.expr(f"{c.erp_customer_key('cid')} AS cst_key"))
    customers = few_copies(silver["crm_cust_info"], "cst_key")
    known = people.agg(F.expr("count(*) AS n")).join(customers, F.expr("cst_key = listed_key"), "left_semi")
    return metric_rows(
        known.selectExpr("coalesce(sum(n), 0) AS duplicate_count"), "v20", "bronze.erp_cust_az12"
    )


def customer_overlap(bronze: Tables, silver: Tables) -> DataFrame:
    """Customers per system from one grouping of the tagged keys; no join."""
    crm = silver["crm_cust_info"].selectExpr("cst_key AS k", "true AS crm", "false AS erp")
    erp = silver["erp_cust_az12"].selectExpr("cid AS k", "false AS crm", "true AS erp")
    systems = crm.unionByName(erp).where("k IS NOT NULL").groupBy("k").agg(
        F.expr("bool_or(crm) AS crm"), F.expr("bool_or(erp) AS erp")
    )
    counts = systems.selectExpr(
        "count_if(crm) AS crm_customers",
        "count_if(erp) AS erp_customers",
        "count_if(crm AND erp) AS in_both_systems",
        "count_if(crm AND NOT erp) AS only_in_crm",
        "count_if(erp AND NOT crm) AS only_in_erp",
    )
    return metric_rows(counts, "v31", "silver.crm_cust_info", INFO)


def uncategorised_products(bronze: Tables, silver: Tables) -> DataFrame:
    per_category = silver["crm_prd_info"].groupBy("cat_id").agg(F.expr("count(*) AS n"))
    listed = few_copies(silver["erp_pc_cat_g1v2"], "id")
    missing = per_category.join(listed, F.expr("cat_id = listed_key"), "left_anti")
    return metric_rows(
        missing.selectExpr("coalesce(sum(n), 0) AS products_without_valid_category"),
        "v32", "silver.crm_prd_info", FAIL,
    )


def unknown_references(
    sales: DataFrame, key: str, known: DataFrame, known_key: str, check_id: str, metric: str
) -> DataFrame:
    """Distinct keys in sales that no master record has; reduced to keys before the join."""
    used = sales.where(f"{key} IS NOT NULL").selectExpr(f"{key} AS used_key").distinct()
    missing = used.join(few_copies(known, known_key), F.expr("used_key = listed_key"), "left_anti")
    return metric_rows(missing.selectExpr(f"count(*) AS {metric}"), check_id, "silver.crm_sales_details", FAIL)


def products_not_in_catalogue(bronze: Tables, silver: Tables) -> DataFrame:
    return unknown_references(
        silver["crm_sales_details"], "sls_prd_key", silver["crm_prd_info"], "prd_key", "v33", "unknown_products"
    )


def customers_not_in_master(bronze: Tables, silver: Tables) -> DataFrame:
    return unknown_references(
        silver["crm_sales_details"], "sls_cust_id", silver["crm_cust_info"], "cst_id", "v34", "unknown_customers"
    )


def customers_in_no_master(bronze: Tables, silver: Tables) -> DataFrame:
    """V34 against everyone either system knows: CRM ids, CRM keys and ERP keys in one list.

    A customer is known if the number in the sale is listed, as it is or as a key.
    """
    crm, erp = silver["crm_cust_info"], silver["erp_cust_az12"]
    known = crm.selectExpr("CAST(cst_id AS string) AS known").union(crm.select("cst_key")).union(erp.select("cid")).distinct()
    used = silver["crm_sales_details"].where("sls_cust_id IS NOT NULL").select("sls_cust_id").distinct()
    missing = used.join(known, F.expr("CAST(sls_cust_id AS string) = known"), "left_anti")
    missing = missing.join(known, F.expr(f"{c.customer_key_of('sls_cust_id')} = known"), "left_anti")
    return metric_rows(missing.selectExpr("count(*) AS unknown_to_all"), "v34", "silver.crm_sales_details", FAIL)


def reconciliation(bronze: Tables, silver: Tables) -> DataFrame:
    """Rows per table in both layers, counted side by side and paired by name."""
    counts = [
        bronze[name].selectExpr(f"'{name}' AS table_name", "NULL AS silver", "count(*) AS bronze") for name in bronze
    ] + [silver[name].selectExpr(f"'{name}' AS table_name", "count(*) AS silver", "NULL AS bronze") for name in silver]
    return union_all(counts).groupBy("table_name").agg(
        F.expr("max(silver) AS silver_rows"), F.expr("max(bronze) AS bronze_rows")
    )


_CATEGORY_DOMAINS = {"cat": "Categories", "subcat": "Subcategories", "maintenance": "Maintenance"}
_CUSTOMER_DOMAINS = {"cst_gndr": "Gender Distribution", "cst_material_status": "Marital Status Distribution"}

# Checks whose result is a list of values or keys.
LISTINGS: dict[str, Callable[[Tables, Tables], DataFrame]] = {
    "v2": lambda b, s: duplicate_keys(s["crm_cust_info"], "cst_id", report_null=False),
    "v3": lambda b, s: value_counts(s["crm_cust_info"], _CUSTOMER_DOMAINS),
    "v6": lambda b, s: duplicate_keys(s["crm_prd_info"], "prd_id", report_null=True),
    "v11": lambda b, s: s["crm_prd_info"].select("prd_line").distinct(),
    "v12": lambda b, s: value_counts(s["crm_prd_info"], {"prd_line": "Product Line Distribution"}),
    "v13": lambda b, s: validity_preview(b),
    "v23": lambda b, s: s["erp_cust_az12"].selectExpr("gen", "'Standardized' AS status").distinct(),
    "v24": lambda b, s: value_counts(s["erp_cust_az12"], {"gen": "Gender Distribution"}),
    "v25": lambda b, s: s["erp_loc_a101"].select("cntry").distinct().orderBy("cntry"),
    "v26": lambda b, s: value_counts(s["erp_loc_a101"], {"cntry": "Country Distribution"}).orderBy("value"),
    "v29": lambda b, s: value_counts(b["erp_pc_cat_g1v2"], _CATEGORY_DOMAINS).select("label", "value"),
    "v30": lambda b, s: value_counts(s["erp_pc_cat_g1v2"], _CATEGORY_DOMAINS).orderBy("label", "value"),
    "v35": reconciliation,
}

# Checks that compare tables and give metrics.
CROSS_TABLE: dict[str, Callable[[Tables, Tables], DataFrame]] = {
    "v4": missing_categories,
    "v5": never_sold,
    "v7": lambda b, s: duplicate_rows(s["crm_prd_info"], "prd_id", "v7", "silver.crm_prd_info"),
    "v20": already_in_crm,
    "v31": customer_overlap,
    "v32": uncategorised_products,
    "v33": products_not_in_catalogue,
    "v34": customers_not_in_master,
}


# Checks that ``containment_checks`` answers together.
CONTAINMENTS = ("v4", "v5", "v20", "v31", "v32", "v33", "v34")


def key_presence(bronze: Tables, silver: Tables) -> DataFrame:
    """Where the keys of the containment checks occur; sales are read once in each layer."""
    category, product, person, customer = "category", "product", "person", "customer"
    raw_products = bronze["crm_prd_info"]
    return presence(
        [
            Holder(raw_products, [(category, 0, c.category_part("prd_key")), ("sold", 0, c.product_part("prd_key"))]),
            Holder(bronze["erp_pc_cat_g1v2"], [(category, 1, "id")]),
            Holder(bronze["crm_sales_details"], [("sold", 1, "sls_prd_key")]),
            Holder(silver["crm_prd_info"], [(category, 2, "cat_id"), (product, 1, "prd_key")]),
            Holder(silver["erp_pc_cat_g1v2"], [(category, 3, "id")]),
            Holder(silver["crm_sales_details"], [(product, 0, "sls_prd_key"), (customer, 0, "sls_cust_id")]),
            Holder(silver["crm_cust_info"], [(person, 0, "cst_key"), (customer, 1, "cst_id")]),
            Holder(silver["erp_cust_az12"], [(person, 1, "cid")]),
            Holder(bronze["erp_cust_az12"], [(person, 2, c.erp_customer_key("cid"))]),
        ]
    )


def containment_checks(bronze: Tables, silver: Tables) -> DataFrame:
    """V4, V5, V20 and V31 to V34 from one presence mask per key, all counts in one aggregation."""
    masks = materialise(key_presence(bronze, silver), "presence")
    raw, known = "bronze.crm_prd_info", f"key IS NOT NULL AND {has(0)}"
    unknown = f"{known} AND NOT {has(1)}"

    def keys(domain: str, rule: str) -> str:
        return f"count_if(domain = '{domain}' AND {rule})"

    def rows(domain: str, rule: str, bit: int) -> str:
        return f"coalesce(sum(if(domain = '{domain}' AND {rule}, n{bit}, 0)), 0)"

    def unlisted(domain: str) -> str:
        """Rows whose key is NOT IN the list, as SQL has it: all if the list is empty, none if it holds NULL."""
        empty, has_null = f"{keys(domain, has(1))} = 0", f"{keys(domain, f'key IS NULL AND {has(1)}')} > 0"
        return f"CASE WHEN {empty} THEN {rows(domain, 'true', 0)} WHEN {has_null} THEN 0 ELSE {rows(domain, unknown, 0)} END"

    def nulls_listed(domain: str) -> str:
        return rows(domain, "key IS NULL", 1)

    erp = f"key IS NOT NULL AND {has(1)}"
    found = {
        ("v4", raw, "affected_rows", WARN): unlisted("category"),
        ("v4", raw, "null_keys_in_list", WARN): nulls_listed("category"),
        ("v5", raw, "affected_rows", WARN): unlisted("sold"),
        ("v5", raw, "null_keys_in_list", WARN): nulls_listed("sold"),
        ("v20", "bronze.erp_cust_az12", "duplicate_count", WARN): rows("person", f"{known} AND {has(2)}", 2),
        ("v31", "silver.crm_cust_info", "crm_customers", INFO): keys("person", known),
        ("v31", "silver.crm_cust_info", "erp_customers", INFO): keys("person", erp),
        ("v31", "silver.crm_cust_info", "in_both_systems", INFO): keys("person", f"{known} AND {has(1)}"),
        ("v31", "silver.crm_cust_info", "only_in_crm", INFO): keys("person", unknown),
        ("v31", "silver.crm_cust_info", "only_in_erp", INFO): keys("person", f"{erp} AND NOT {has(0)}"),
        ("v32", "silver.crm_prd_info", "products_without_valid_category", FAIL): rows("category", only_in(2, 3), 2),
        ("v33", "silver.crm_sales_details", "unknown_products", FAIL): keys("product", unknown),
        ("v34", "silver.crm_sales_details", "unknown_customers", FAIL): keys("customer", unknown),
    }
    counts = masks.selectExpr(*[f"{expression} AS m{i}" for i, expression in enumerate(found.values())])
    metrics = [(check_id, table, metric, f"m{i}", severity) for i, (check_id, table, metric, severity) in enumerate(found)]
    products = [
        _unlisted_products(bronze["crm_prd_info"], masks, domain, derived, check_id)
        for domain, derived, check_id in (("category", c.category_part("prd_key"), "v4"), ("sold", c.product_part("prd_key"), "v5"))
    ]
    return union_all([result_rows(counts, metrics), *products])


def _unlisted_products(products: DataFrame, masks: DataFrame, domain: str, derived: str, check_id: str) -> DataFrame:
    """Distinct products whose derived key is NOT IN the list of the domain."""
    own = masks.where(F.col("domain") == domain)
    # What NOT IN turns on: whether the list is empty, and whether it holds NULL.
    facts = own.where(has(1)).selectExpr("struct(count(*) = 0 AS empty, count_if(key IS NULL) > 0 AS has_null) AS facts").scalar()
    missing = own.withColumn("list", facts).where(not_in(0, has(1), "list.empty", "list.has_null"))
    pairs = products.selectExpr(f"CAST({derived} AS string) AS derived_key", "prd_id").distinct()
    met = pairs.join(missing.select("key"), F.expr("derived_key <=> key"), "left_semi")
    return metric_rows(met.selectExpr("count(DISTINCT prd_id) AS affected_products"), check_id, "bronze.crm_prd_info")


def quality_suite(bronze: Tables, silver: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Every metric check at once: one aggregation per table plus the cross-table checks."""
    fused = [run_checks(_table(bronze, silver, name), name, checks) for name, checks in table_checks(as_of).items()]
    return union_all([*fused, *_key_checks(bronze, silver)])


def _key_checks(bronze: Tables, silver: Tables) -> list[DataFrame]:
    """The metric checks of keys, within a table and between tables."""
    cross = [check(bronze, silver) for name, check in CROSS_TABLE.items() if name not in CONTAINMENTS]
    return [duplicate_customers(silver), *cross, containment_checks(bronze, silver)]


def _profiles(as_of: dt.date | None) -> dict[str, Profile]:
    """Tables of which both predicates and values, or several columns, are asked."""
    predicates = table_checks(as_of)

    def listed(check_id: str, labels: Mapping[str, str], counted: bool = True) -> list[Listing]:
        return [Listing(check_id, column, f"{label}: ", counted) for column, label in labels.items()]

    listings = {
        "silver.crm_cust_info": listed("v3", _CUSTOMER_DOMAINS),
        "silver.crm_prd_info": [*listed("v12", {"prd_line": "Product Line Distribution"}), Listing("v11", "prd_line", counted=False)],
        "silver.erp_cust_az12": [*listed("v24", {"gen": "Gender Distribution"}), Listing("v23", "gen", counted=False)],
        "silver.erp_loc_a101": [*listed("v26", {"cntry": "Country Distribution"}), Listing("v25", "cntry", counted=False)],
        "bronze.erp_pc_cat_g1v2": listed("v29", _CATEGORY_DOMAINS, counted=False),
        "silver.erp_pc_cat_g1v2": listed("v30", _CATEGORY_DOMAINS),
    }
    return {name: Profile(predicates.get(name, ()), found) for name, found in listings.items()}


def full_suite(bronze: Tables, silver: Tables, as_of: dt.date | None = None) -> DataFrame:
    """``quality_suite`` and ``listing_metrics`` in one: predicates and value lists of a table come from one pass over it."""
    wanted = _profiles(as_of)
    profiled = profile_results({name: _table(bronze, silver, name) for name in wanted}, wanted)
    others = [
        run_checks(_table(bronze, silver, name), name, found) for name, found in table_checks(as_of).items() if name not in wanted
    ]
    return union_all([profiled, *others, *_key_checks(bronze, silver), *_key_listings(bronze, silver)])


def listing_metrics(bronze: Tables, silver: Tables) -> DataFrame:
    """The listing checks as results: one per listed value, or their number where the list is of keys."""

    def by_value(check_id: str, table: str, label: str, value: str, count: str) -> DataFrame:
        columns = f"'{check_id}' AS check_id", f"'{table}' AS table_name", f"concat({label}, coalesce({value}, 'NULL')) AS metric"
        return LISTINGS[check_id](bronze, silver).selectExpr(*columns, f"CAST({count} AS bigint) AS value", f"'{INFO}' AS status")

    counts = {"v3": "crm_cust_info", "v12": "crm_prd_info", "v24": "erp_cust_az12", "v26": "erp_loc_a101", "v30": "erp_pc_cat_g1v2"}
    domains = {"v11": ("crm_prd_info", "prd_line"), "v23": ("erp_cust_az12", "gen"), "v25": ("erp_loc_a101", "cntry")}
    return union_all(
        [
            *_key_listings(bronze, silver),
            *[by_value(i, f"silver.{t}", "label, ': '", "value", "row_count") for i, t in counts.items()],
            *[by_value(i, f"silver.{t}", "''", column, "1") for i, (t, column) in domains.items()],
            by_value("v29", "bronze.erp_pc_cat_g1v2", "label, ': '", "value", "1"),
        ]
    )


def _key_listings(bronze: Tables, silver: Tables) -> list[DataFrame]:
    """Listings of keys by their number, and the rows of every table."""

    def counted(check_id: str, table: str, severity: str = INFO) -> DataFrame:
        listed = LISTINGS[check_id](bronze, silver).selectExpr("count(*) AS listed")
        return metric_rows(listed, check_id, table, severity)

    loads = LISTINGS["v35"](bronze, silver).selectExpr(
        "'v35' AS check_id", "table_name",
        f"inline(array(struct('silver_rows' AS metric, silver_rows AS value, '{INFO}' AS status),"
        f" struct('bronze_rows' AS metric, bronze_rows AS value, '{INFO}' AS status)))",
    )
    return [counted("v6", "silver.crm_prd_info", WARN), counted("v13", "bronze.crm_prd_info"), loads]


def gold_checks(silver: Tables, gold_tables: Tables) -> DataFrame:
    """V36 on both sides of the fact, and what each join of the gold layer would repeat."""
    fact = gold_tables["fact_sales"]
    orphans = [
        metric_rows(
            gold.orphan_facts(fact, gold_tables[dimension], key).selectExpr(f"count(*) AS orphans_by_{key}"),
            "v36", "gold.fact_sales", FAIL,
        )
        for dimension, key in (("dim_products", "product_key"), ("dim_customers", "customer_key"))
    ]
    guards = gold.join_guards(silver).selectExpr(
        "'guard' AS check_id", "'gold' AS table_name", "join_name AS metric", "extra_rows AS value",
        f"if(extra_rows = 0, '{PASS}', '{FAIL}') AS status",
    )
    return union_all([*orphans, guards])


def suite_verdict(results: DataFrame) -> DataFrame:
    """One row per check, FAIL before WARN before PASS, computed from the results."""
    found = f"CASE WHEN bool_or(status = '{FAIL}') THEN '{FAIL}' WHEN bool_or(status = '{WARN}') THEN '{WARN}' ELSE 'PASS' END"
    return results.groupBy("check_id").agg(F.expr(f"{found} AS status"), F.expr("count(*) AS metrics"))
