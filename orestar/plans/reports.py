"""Business reports over the star (see ``gold.star``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestar.operators.grouped_sets import grouped_sets
from orestar.operators.interval_index import join_in_interval
from orestar.operators.sketches import sketch_cells, united_counts, within_error

_MEASURES = (
    "sum(sales_amount) AS total_sales",
    "count(DISTINCT order_number) AS orders",
    "sum(quantity) AS units",
)


def _summary(star: DataFrame, by: list[str], *more: str) -> DataFrame:
    return star.groupBy(*by).agg(*[F.expr(measure) for measure in (*_MEASURES, *more)])


def sales_by_country(star: DataFrame) -> DataFrame:
    return _summary(star, ["country"])


def revenue_by_category(star: DataFrame) -> DataFrame:
    return _summary(star, ["category", "subcategory"])


def sales_trend(star: DataFrame) -> DataFrame:
    """Per month, with a running total. The unpartitioned window sees one row per month."""
    dated = star.selectExpr("*", "year(order_date) AS order_year", "month(order_date) AS order_month")
    return _with_running_sales(_summary(dated, ["order_year", "order_month"]))


def _with_running_sales(months: DataFrame) -> DataFrame:
    so_far = "OVER (ORDER BY order_year, order_month ROWS UNBOUNDED PRECEDING)"
    return months.selectExpr("*", f"sum(total_sales) {so_far} AS running_sales")


def profit(star: DataFrame) -> DataFrame:
    """Sales less current product cost, for sales of a known product."""
    known = star.where("product_key IS NOT NULL").selectExpr(
        "category", "sales_amount", "CAST(quantity AS bigint) * cost AS line_cost"
    )
    return known.groupBy("category").agg(
        F.expr("sum(sales_amount) AS total_sales"),
        F.expr("sum(line_cost) AS total_cost"),
        F.expr("sum(sales_amount - line_cost) AS profit"),
    )


def customers(star: DataFrame) -> DataFrame:
    known = star.where("customer_key IS NOT NULL")
    spans = ("min(order_date) AS first_order", "max(order_date) AS last_order")
    return _summary(known, ["customer_key", "customer_number"], *spans).selectExpr(
        "*", "CAST(total_sales AS double) / orders AS avg_order_value"
    )


def products(star: DataFrame) -> DataFrame:
    """Sales are summed per product, order and customer first; only those sums are told apart twice."""
    by = ["product_key", "product_number", "product_name"]
    cells = star.where("product_key IS NOT NULL").groupBy(*by, "order_number", "customer_key").agg(
        F.expr("sum(sales_amount) AS sales_amount"), F.expr("sum(quantity) AS quantity")
    )
    return _summary(cells, by, "count(DISTINCT customer_key) AS buyers").selectExpr(
        "*", "CAST(total_sales AS double) / nullif(units, 0) AS avg_price"
    )


def top_products(star: DataFrame, k: int = 10) -> DataFrame:
    return products(star).orderBy(F.desc_nulls_last("total_sales"), "product_key").limit(k)


def sales_by_customer_attribute(star: DataFrame) -> DataFrame:
    """Sales per gender, country and marital status from one pass over the star."""
    names = ["gender", "country", "marital_status"]
    cells = star.groupBy(*names).agg(F.expr("sum(sales_amount) AS s"), F.expr("sum(quantity) AS q"))
    pairs = ", ".join(f"struct('{name}' AS attribute, {name} AS value)" for name in names)
    return (
        cells.selectExpr("s", "q", f"inline(array({pairs}))")
        .groupBy("attribute", "value")
        .agg(F.expr("sum(s) AS total_sales"), F.expr("sum(q) AS units"))
    )


def sales_by_product_line(star: DataFrame) -> DataFrame:
    return _summary(star, ["product_line"])


def sales_by_cost(star: DataFrame, band: int = 100) -> DataFrame:
    """Sales per band of product cost; the band is named by its lower bound."""
    return _summary(star.selectExpr("*", f"floor(cost / {band}) * {band} AS cost_from"), ["cost_from"])


def _last_until(days: str, day: str) -> str:
    """The last of the sorted ``days`` that is not after ``day``, by bisection; NULL if there is none."""
    further = "at + shiftleft(1, bit)"
    bits = f"sequence(CAST(floor(log2(size({days}))) AS int), 0, -1)"
    return f"get({days}, aggregate({bits}, 0, (at, bit) -> if(get({days}, {further} - 1) <= {day}, {further}, at)) - 1)"


def sales_point_in_time(sales: DataFrame, versions: DataFrame) -> DataFrame:
    """Every sale with each product version, and so the cost, valid on its order date.

    Which versions are valid changes only on a day on which one begins or has
    ended. Those days alone are matched with the versions, by blocks of days
    (``operators.interval_index``): a few rows a version, none for a sale. A sale
    finds the last such day of its product by bisection of the product's days,
    which the calendar bounds, and takes what is valid since then. A single
    mistyped year costs nothing. Versions whose periods overlap give a row each,
    as the join on the period itself would.
    """
    valid = versions.select("prd_key", "prd_id", "prd_start_dt", "prd_end_dt", "prd_cost")
    turns = "explode(array(prd_start_dt, date_add(prd_end_dt, 1))) AS turn"
    turns = valid.where("prd_key IS NOT NULL AND prd_start_dt IS NOT NULL").selectExpr("prd_key AS turn_key", turns)
    turns = turns.where("turn IS NOT NULL").distinct()
    span = turns.selectExpr("struct(min(turn) AS first_day, max(turn) AS last_day)").scalar()
    found = join_in_interval(
        turns, valid, [("turn_key", "prd_key")], "turn", "prd_start_dt", "prd_end_dt", (span.getField("first_day"), span.getField("last_day"))
    ).drop("prd_key")
    days = turns.groupBy(F.col("turn_key").alias("days_key")).agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    dated = sales.join(days, F.expr("sls_prd_key = days_key"), "left").withColumn("since", F.expr(_last_until("turns", "sls_order_dt")))
    return dated.join(found, F.expr("sls_prd_key = turn_key AND since = turn"), "left").selectExpr(
        "sls_ord_num AS order_number",
        "sls_prd_key",
        "sls_order_dt AS order_date",
        "sls_sales AS sales_amount",
        "sls_quantity AS quantity",
        "prd_id AS product_id",
        "prd_start_dt AS version_start",
        "prd_end_dt AS version_end",
        "prd_cost AS cost_at_sale",
    )


def monthly_sketches(star: DataFrame) -> DataFrame:
    """Sales per month, product line and country with sketches of orders, buyers and products.

    From these cells alone the distinct counts of any period, line or country follow.
    """
    dated = star.selectExpr("*", "year(order_date) AS order_year", "month(order_date) AS order_month")
    return sketch_cells(
        dated,
        ["order_year", "order_month", "product_line", "country"],
        {"orders": "order_number", "buyers": "customer_key", "products": "product_key"},
        {"total_sales": "sales_amount", "units": "quantity"},
    )


SKETCHED = ("orders", "buyers", "products")


def approximate_counts(cells: DataFrame, by: list[str]) -> DataFrame:
    """The cells of ``monthly_sketches`` united: sums exact, distinct counts estimated."""
    return united_counts(cells, by, SKETCHED, ("total_sales", "units"))


def counts_with_estimates(star: DataFrame, cells: DataFrame, by: list[str]) -> DataFrame:
    """Exact distinct counts of the groups, and whether those from the stored cells keep their stated error."""
    dated = star.selectExpr("*", "year(order_date) AS order_year", "month(order_date) AS order_month")
    exact = dated.groupBy(*by).agg(
        F.expr("count(DISTINCT order_number) AS orders"),
        F.expr("count(DISTINCT customer_key) AS buyers"),
        F.expr("count(DISTINCT product_key) AS products"),
        F.expr("sum(sales_amount) AS total_sales"),
    )
    estimated = approximate_counts(cells, by).selectExpr(
        *[f"{name} AS e_{name}" for name in by], *[f"{name} AS about_{name}" for name in SKETCHED]
    )
    same = " AND ".join(f"{name} <=> e_{name}" for name in by)
    judged = [f"{within_error(f'about_{name}', name)} AS {name}_within_error" for name in SKETCHED]
    return exact.join(estimated, F.expr(same), "left").selectExpr(*by, *SKETCHED, "total_sales", *judged)


_ORDER_SETS = {
    "country": ["country"],
    "category": ["category", "subcategory"],
    "month": ["order_year", "order_month"],
    "product_line": ["product_line"],
    "cost": ["cost_from"],
}
_SUM_SETS = {"known_category": ["category", "known_product"], "gender": ["gender"], "marital_status": ["marital_status"]}
# What the customer and the day tell, and what the product tells.
_TOGETHER = [["country", "month", "gender", "marital_status"], ["category", "product_line", "cost", "known_category"]]


def summaries(star: DataFrame, band: int = 100) -> DataFrame:
    """What the summary reports tell, from one pass over the star; one row per set of columns and its values.

    ``from_summaries`` makes the reports of it. It holds a row per country, category,
    month, line, band of cost, gender and marital status, whatever the sales.
    """
    told = star.selectExpr(
        "country", "category", "subcategory", "year(order_date) AS order_year", "month(order_date) AS order_month", "product_line",
        f"floor(cost / {band}) * {band} AS cost_from", "product_key IS NOT NULL AS known_product", "gender", "marital_status",
        "order_number", "sales_amount", "quantity", "CAST(quantity AS bigint) * cost AS line_cost",
    )
    sums = {"total_sales": "sales_amount", "units": "quantity", "total_cost": "line_cost", "profit": "sales_amount - line_cost"}
    found = grouped_sets(told, {**_ORDER_SETS, **_SUM_SETS}, "order_number", sums, list(_ORDER_SETS), _TOGETHER)
    return found.withColumnRenamed("n_counted", "orders")


def _of_set(found: DataFrame, name: str) -> DataFrame:
    own = found.where(F.col("grouped_by") == name)
    return own.select(*_ORDER_SETS[name], "total_sales", "orders", "units")


def _attributes(found: DataFrame) -> DataFrame:
    named = "CASE grouped_by WHEN 'gender' THEN gender WHEN 'country' THEN country ELSE marital_status END AS value"
    own = found.where("grouped_by IN ('gender', 'country', 'marital_status')")
    return own.selectExpr("grouped_by AS attribute", named, "total_sales", "units")


# The reports that a stored ``summaries`` holds, by the name of their table.
FROM_SUMMARIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "sales_by_country": lambda found: _of_set(found, "country"),
    "revenue_by_category": lambda found: _of_set(found, "category"),
    "sales_trend": lambda found: _with_running_sales(_of_set(found, "month")),
    "profit": lambda found: found.where("grouped_by = 'known_category' AND known_product").select(
        "category", "total_sales", "total_cost", "profit"
    ),
    "sales_by_customer_attribute": _attributes,
    "sales_by_product_line": lambda found: _of_set(found, "product_line"),
    "sales_by_cost": lambda found: _of_set(found, "cost"),
}

# Reports that read the star themselves.
STAR_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": customers,
    "products": products,
    "monthly_sketches": monthly_sketches,
}
