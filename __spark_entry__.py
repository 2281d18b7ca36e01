
from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestar_oracle.statements import statements
from orestar.operators.quality import union_all
from orestar.plans import checks, gold, reports, silver
from orestar.plans.layer import Layer
from orestar.plans.warehouse import Warehouse
from orestar.schemas import BRONZE, FEED_FILES, GOLD, RAW, SILVER
from orestar.session import prepare
from orestar.sources import csv_feeds, feeds
from orestar.sources.run_log import LAYER as OPS
from orestar.sources.run_log import LOADED
from orestar.workspace import fresh_path, materialise

try:
    import corpus_pipeline
    from orestar.llm import registry as llm
except ModuleNotFoundError as missing:
    # The only guard: both may be absent, and only as a whole.
    if missing.name not in ("corpus_pipeline", "orestar.llm"):
        raise
    llm = corpus_pipeline = None

AS_OF = dt.date(2026, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, sf_dir: str, erp_scope: str = "new_only") -> Layer:
    return silver.silver_layer(feeds.raw_layer(spark, sf_dir), AS_OF, erp_scope)


_dimensions: dict[tuple, DataFrame] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """The files a dimension is made from: new data under an old path are other files."""
    tables = ("customer", "nation", "part", "supplier")
    return tuple(sorted(f for t in tables for f in spark.read.parquet(f"{sf_dir}/{t}.parquet").inputFiles()))


def _dimension(spark: SparkSession, sf_dir: str, name: str, erp_scope: str = "new_only") -> DataFrame:
    """A numbered dimension, stored once per session as the gold layer stores it."""
    known = (spark.sparkContext.applicationId, f"{name}-{erp_scope}", _state(spark, sf_dir))
    if known not in _dimensions:
        tables = _silver(spark, sf_dir, erp_scope)
        if name == "customers":
            df = gold.dim_customers(tables["crm_cust_info"], tables["erp_cust_az12"], tables["erp_loc_a101"])
        else:
            df = gold.dim_products(tables["crm_prd_info"], tables["erp_pc_cat_g1v2"])
        _dimensions[known] = materialise(df, f"dim_{name}")
    return _dimensions[known]


def _star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.star(
        _silver(spark, sf_dir)["crm_sales_details"],
        _dimension(spark, sf_dir, "products"),
        _dimension(spark, sf_dir, "customers"),
    )


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).select(*gold.FACT_COLUMNS)


def _ingest(table: str) -> Query:
    """Write a feed as CSV, then ingest it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{fresh_path(spark, 'feed')}/{FEED_FILES[table]}"
        csv_feeds.write_csv(feeds.raw_table(spark, sf_dir, table), path)
        return csv_feeds.accepted(csv_feeds.read_raw(spark, path, table), table)

    return run


def _faulty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of which two sevenths of the orders break the schema."""
    turn = "CAST(substr(sls_ord_num, 3) AS bigint) % 7"
    return feeds.raw_table(spark, sf_dir, "crm_sales_details").withColumns(
        {
            "sls_quantity": F.expr(f"if({turn} = 1, 'many', CAST(sls_quantity AS string))"),
            "sls_ord_num": F.expr(f"if({turn} = 2, rpad(sls_ord_num, 60, '0'), sls_ord_num)"),
        }
    )


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a faulty sales file that are turned away, with the columns at fault."""
    path = f"{fresh_path(spark, 'feed')}/sales.csv"
    csv_feeds.write_csv(_faulty_sales(spark, sf_dir), path)
    return csv_feeds.rejected_lines(csv_feeds.read_lines(spark, path), "crm_sales_details")


def _load_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log of a bronze load that stops at a faulty sales file, times left out."""
    source_dir = fresh_path(spark, "sources")
    for table, file in FEED_FILES.items():
        feed = _faulty_sales(spark, sf_dir) if table == "crm_sales_details" else feeds.raw_table(spark, sf_dir, table)
        csv_feeds.write_csv(feed, f"{source_dir}/{file}")
    root = fresh_path(spark, "lake")
    prefix = "run_" + root[-8:] + "_"
    warehouse = Warehouse(spark, root, prefix, as_of=AS_OF)
    try:
        warehouse.load_bronze(source_dir, mode="FAILFAST")
    except ValueError:
        # The load is meant to stop; what it left in the log is the result.
        pass
    told = warehouse.log.entries().selectExpr(
        "layer", "table_name", "status", "rows_loaded", "rows_rejected", "error", "condition",
        "seconds >= 0 AND ended_at >= started_at AS timed", "split(step, ':')[0] AS step",
    )
    told = materialise(told, "run_log")
    for layer in (BRONZE, OPS):
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{layer} CASCADE")
    return told


def _load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job from CSV files to gold, as its run log tells it."""
    source_dir = fresh_path(spark, "sources")
    for table, file in FEED_FILES.items():
        csv_feeds.write_csv(feeds.raw_table(spark, sf_dir, table), f"{source_dir}/{file}")
    root = fresh_path(spark, "lake")
    prefix = "run_" + root[-8:] + "_"
    warehouse = Warehouse(spark, root, prefix, as_of=AS_OF)
    warehouse.load_bronze(source_dir)
    warehouse.load_silver()
    warehouse.build_gold()
    log = warehouse.log.entries().where(F.col("status") == LOADED)
    told = materialise(log.select("layer", "table_name", "rows_loaded", "status"), "run_log")
    for layer in (BRONZE, SILVER, GOLD, OPS):
        spark.sql(f"DROP DATABASE {prefix}{layer} CASCADE")
    return told


def _surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [
        _dimension(spark, sf_dir, f"{name}s").selectExpr(
            f"'{name}' AS dimension", f"{name}_key AS surrogate", f"{name}_id AS business_id"
        )
        for name in ("customer", "product")
    ]
    return union_all(keys)


def _repeats(spark: SparkSession, sf_dir: str) -> tuple[Layer, Layer]:
    """Raw and silver with repeated master data; all ERP people, so that known customers meet their repeats."""
    raw = feeds.raw_layer_with_repeats(spark, sf_dir)
    return raw, silver.silver_layer(raw, AS_OF, "all")


def _point_in_time_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = _repeats(spark, sf_dir)
    return reports.sales_point_in_time(tables["crm_sales_details"], tables["crm_prd_info"])


def _stored_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 over a customer table into which all CRM records were loaded, newest or not."""
    return checks.duplicate_keys(feeds.customer_feed(spark, sf_dir), "cst_id", report_null=False)


def _unlisted_by(listed: Callable[[DataFrame], DataFrame]) -> Query:
    """V4 against another list of categories."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = feeds.raw_layer(spark, sf_dir)
        return checks.missing_categories(raw.replaced(erp_pc_cat_g1v2=listed(raw["erp_pc_cat_g1v2"])), raw)

    return run


def _sample_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V13 for two chosen products."""
    raw = feeds.raw_layer(spark, sf_dir)
    chosen = raw["crm_prd_info"].select("prd_key").distinct().orderBy("prd_key").limit(2)
    return checks.validity_preview(raw, chosen)


def _silver_query(table: str, erp_scope: str = "new_only") -> Query:
    return lambda spark, sf_dir: _silver(spark, sf_dir, erp_scope)[table]


def _sales_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _silver(spark, sf_dir)["crm_sales_details"]
    return sales.orderBy(*sales.columns).limit(5)


def _report(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_star(spark, sf_dir))


def _counts_with_estimates(*by: str) -> Query:
    """Exact counts beside those from monthly sketches, which are stored first as the reports job stores them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = _star(spark, sf_dir)
        return reports.counts_with_estimates(star, materialise(reports.monthly_sketches(star), "sketches"), list(by))

    return run


def _summary_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary reports of the batch job, stacked: all come from one stored pass over the star."""
    found = materialise(reports.summaries(_star(spark, sf_dir)), "summaries")
    stacked = [report(found).select("*", F.lit(name).alias("report")) for name, report in reports.FROM_SUMMARIES.items()]
    told = stacked[0]
    for more in stacked[1:]:
        told = told.unionByName(more, allowMissingColumns=True)
    return told


def _point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _silver(spark, sf_dir)
    return reports.sales_point_in_time(tables["crm_sales_details"], tables["crm_prd_info"])


def _check(run: Callable[[Layer, Layer], DataFrame], erp_scope: str = "new_only") -> Query:
    return lambda spark, sf_dir: run(feeds.raw_layer(spark, sf_dir), _silver(spark, sf_dir, erp_scope))


def _predicate(check_id: str, erp_scope: str = "new_only") -> Query:
    return _check(lambda bronze, clean: checks.predicate_check(check_id, bronze, clean, AS_OF), erp_scope)


def _stored_for_checks(raw: Layer, erp_scope: str = "new_only") -> tuple[Layer, Layer]:
    """Bronze and silver with those tables stored that several checks read."""
    bronze = raw.replaced(crm_sales_details=materialise(raw["crm_sales_details"], "bronze_sales"))
    customers = materialise(silver.clean_customers(bronze["crm_cust_info"]), "silver_customers")
    products = materialise(silver.clean_products(bronze["crm_prd_info"]), "silver_products")
    clean = silver.silver_layer(bronze, AS_OF, erp_scope, customers=customers)
    return bronze, clean.replaced(crm_cust_info=customers, crm_prd_info=products)


def _quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metric checks."""
    return checks.quality_suite(*_stored_for_checks(feeds.raw_layer(spark, sf_dir)), AS_OF)


def _full_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks and value lists of the batch job, over layers with repeated master data."""
    return checks.full_suite(*_stored_for_checks(feeds.raw_layer_with_repeats(spark, sf_dir), "all"), AS_OF)


def queries() -> dict[str, Query]:
    """One callable per query; each reads the tables in ``sf_dir`` whole."""
    return {name: _in_prepared_session(query) for name, query in _queries().items()}


def _in_prepared_session(query: Query) -> Query:
    return lambda spark, sf_dir: query(prepare(spark), sf_dir)


def _queries() -> dict[str, Query]:
    return {
        **{f"bronze_ingest_{table}": _ingest(table) for table in RAW},
        "bronze_rejects": _rejects,
        "load_reconciliation": _load_reconciliation,
        "load_failures": _load_failures,
        "silver_customers": _silver_query("crm_cust_info"),
        "silver_products": _silver_query("crm_prd_info"),
        "silver_sales": _silver_query("crm_sales_details"),
        "silver_sales_preview": _sales_preview,
        "silver_erp_customers": _silver_query("erp_cust_az12", "all"),
        "silver_erp_customers_new": _silver_query("erp_cust_az12"),
        "silver_locations": _silver_query("erp_loc_a101"),
        "silver_categories": _silver_query("erp_pc_cat_g1v2"),
        "silver_categories_raw": lambda spark, sf_dir: silver.clean_categories(
            feeds.category_feed(spark, sf_dir), trim=False
        ),
        **{f"check_{check_id}": _predicate(check_id) for check_id in checks.predicate_ids()},
        **{f"check_{check_id}": _check(run) for check_id, run in checks.LISTINGS.items()},
        **{f"check_{check_id}": _check(run) for check_id, run in checks.CROSS_TABLE.items()},
        # The ERP checks over everyone, not only over people the CRM lacks.
        **{f"check_{check_id}_all": _predicate(check_id, "all") for check_id in ("v21", "v22")},
        "check_v24_all": _check(checks.LISTINGS["v24"], "all"),
        "check_v31_all": _check(checks.CROSS_TABLE["v31"], "all"),
        "quality_suite": _quality_suite,
        "quality_suite_full": _full_suite,
        "gold_surrogate_keys": _surrogate_keys,
        "gold_dim_customers": lambda spark, sf_dir: _dimension(spark, sf_dir, "customers"),
        "gold_dim_customers_enriched": lambda spark, sf_dir: _dimension(spark, sf_dir, "customers", "all"),
        "gold_dim_products": lambda spark, sf_dir: _dimension(spark, sf_dir, "products"),
        "gold_fact_sales": _fact,
        "gold_fk_check": lambda spark, sf_dir: gold.orphan_facts(
            _fact(spark, sf_dir), _dimension(spark, sf_dir, "products"), "product_key"
        ),
        "gold_fk_check_customer": lambda spark, sf_dir: gold.orphan_facts(
            _fact(spark, sf_dir), _dimension(spark, sf_dir, "customers"), "customer_key"
        ),
        "gold_join_guard": lambda spark, sf_dir: gold.join_guards(_silver(spark, sf_dir)),
        "gold_join_guard_repeats": lambda spark, sf_dir: gold.join_guards(_repeats(spark, sf_dir)[1]),
        "check_v2_stored_repeats": _stored_repeats,
        "check_v4_null_listed": _unlisted_by(lambda c: c.selectExpr("nullif(id, 'LA_B1') AS id")),
        "check_v4_empty_list": _unlisted_by(lambda c: c.where("length(id) > 50")),
        "check_v13_sample": _sample_preview,
        "check_v34_all_masters": _check(checks.customers_in_no_master, "all"),
        "report_sales_by_country": _report(reports.sales_by_country),
        "report_revenue_by_category": _report(reports.revenue_by_category),
        "report_sales_trend": _report(reports.sales_trend),
        "report_profit": _report(reports.profit),
        "report_customers": _report(reports.customers),
        "report_products": _report(reports.products),
        "report_products_top": _report(reports.top_products),
        "report_distinct_counts_by_year": _counts_with_estimates("order_year"),
        "report_distinct_counts_by_line": _counts_with_estimates("order_year", "product_line"),
        "fact_sales_point_in_time": _point_in_time,
        "fact_sales_point_in_time_overlaps": _point_in_time_overlaps,
        "report_sales_by_customer_attr": _report(reports.sales_by_customer_attribute),
        "report_sales_by_product_line": _report(reports.sales_by_product_line),
        "report_sales_by_cost": _report(reports.sales_by_cost),
        "report_summaries": _summary_reports,
        **training_data_queries(),
    }


def training_data_queries() -> dict[str, Query]:
    """The queries of the subpackage that may be absent."""
    return llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}


def oracle_sql() -> dict[str, str]:
    """The same queries in DuckDB SQL."""
    return statements() | (llm.oracle_sql() if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    """Total sales by country, from the raw tables through all three layers."""
    return queries()["report_sales_by_country"](spark, "/root/testdata/sf0.001")
