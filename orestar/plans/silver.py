"""Bronze to silver: one lazy transformation per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from orestar.functions import cleansing as c
from orestar.operators.anti_join import anti_join_null_aware
from orestar.operators.latest import latest_by_key
from orestar.operators.sequence import with_next
from orestar.plans.layer import Layer


def clean_customers(raw: DataFrame) -> DataFrame:
    return latest_by_key(raw, "cst_id", newest="cst_create_date").selectExpr(
        "cst_id",
        "cst_key",
        "trim(cst_firstname) AS cst_firstname",
        "trim(cst_lastname) AS cst_lastname",
        f"{c.code_label('cst_material_status', c.MARITAL_LABELS)} AS cst_material_status",
        f"{c.code_label('cst_gndr', c.CRM_GENDER_LABELS)} AS cst_gndr",
        "cst_create_date",
    )


def clean_products(raw: DataFrame) -> DataFrame:
    """Split keys, label lines and derive when each version ends.

    A version ends the day before its product's next version starts; the end
    in the feed is not used. "Product" is the full raw key here, not the part
    of it that is kept.
    """
    dated = raw.selectExpr(
        "prd_key", "CAST(prd_start_dt AS date) AS start_day", "prd_start_dt", "prd_id", "prd_nm", "prd_cost", "prd_line"
    )
    return with_next(dated, "prd_key", "start_day", out="next_start").selectExpr(
        "prd_id",
        f"{c.category_part('prd_key')} AS cat_id",
        f"{c.product_part('prd_key')} AS prd_key",
        "prd_nm",
        "coalesce(prd_cost, 0) AS prd_cost",
        f"{c.code_label('prd_line', c.PRODUCT_LINE_LABELS)} AS prd_line",
        "start_day AS prd_start_dt",
        "date_sub(next_start, 1) AS prd_end_dt",
    )


def clean_sales(raw: DataFrame, on_invalid_date: str = "fail") -> DataFrame:
    measures = ("sls_sales", "sls_quantity", "sls_price")
    return raw.selectExpr(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        *[f"{c.decode_int_date(d, on_invalid_date)} AS {d}" for d in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        f"{c.repaired_sales(*measures)} AS sls_sales",
        "sls_quantity",
        f"{c.repaired_price(*measures)} AS sls_price",
    )


def clean_demographics(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """All ERP people. ``new_people`` narrows them to those the CRM lacks."""
    return raw.selectExpr(
        f"{c.erp_customer_key('cid')} AS cid",
        f"{c.not_after('bdate', as_of)} AS bdate",
        f"{c.code_label('gen', c.ERP_GENDER_LABELS)} AS gen",
    )


def new_people(demographics: DataFrame, customers: DataFrame) -> DataFrame:
    return anti_join_null_aware(demographics, customers, "cid", "cst_key")


def clean_locations(raw: DataFrame) -> DataFrame:
    return raw.selectExpr("replace(cid, '-') AS cid", f"{c.country_label('cntry')} AS cntry")


def clean_categories(raw: DataFrame, trim: bool = True) -> DataFrame:
    names = ("cat", "subcat", "maintenance")
    return raw.selectExpr("id", *[f"trim({name}) AS {name}" if trim else name for name in names])


def silver_layer(
    bronze: Mapping[str, DataFrame],
    as_of: dt.date | None = None,
    erp_scope: str = "new_only",
    on_invalid_date: str = "fail",
    customers: DataFrame | None = None,
) -> Layer:
    """The six silver tables. ``erp_scope`` is ``new_only`` or ``all``.

    ``customers`` may name an already stored silver customer table, so that the
    ERP load reads it instead of deriving it again.
    """
    if erp_scope not in ("new_only", "all"):
        raise ValueError(f"erp_scope must be new_only or all, not {erp_scope!r}")

    def people() -> DataFrame:
        everyone = clean_demographics(bronze["erp_cust_az12"], as_of)
        if erp_scope == "all":
            return everyone
        return new_people(everyone, layer["crm_cust_info"] if customers is None else customers)

    layer = Layer(
        {
            "crm_cust_info": lambda: clean_customers(bronze["crm_cust_info"]),
            "crm_prd_info": lambda: clean_products(bronze["crm_prd_info"]),
            "crm_sales_details": lambda: clean_sales(bronze["crm_sales_details"], on_invalid_date),
            "erp_cust_az12": people,
            "erp_loc_a101": lambda: clean_locations(bronze["erp_loc_a101"]),
            "erp_pc_cat_g1v2": lambda: clean_categories(bronze["erp_pc_cat_g1v2"]),
        }
    )
    return layer
