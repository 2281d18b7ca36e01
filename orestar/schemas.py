"""Declared schemas of the raw feeds. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Layer names, table names, file names, text width.
BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
TEXT_WIDTH = 50
AUDIT_COLUMN = "dwh_create_date"

_ID, _INT, _TEXT, _DATE = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()
_DATETIME = T.TimestampNTZType()  # the source's date-times carry no zone


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


RAW = {
    "crm_cust_info": _struct(
        cst_id=_ID, cst_key=_TEXT, cst_firstname=_TEXT, cst_lastname=_TEXT,
        cst_material_status=_TEXT, cst_gndr=_TEXT, cst_create_date=_DATE,
    ),
    "crm_prd_info": _struct(
        prd_id=_ID, prd_key=_TEXT, prd_nm=_TEXT, prd_cost=_INT, prd_line=_TEXT,
        prd_start_dt=_DATETIME, prd_end_dt=_DATETIME,
    ),
    "crm_sales_details": _struct(
        sls_ord_num=_TEXT, sls_prd_key=_TEXT, sls_cust_id=_ID, sls_order_dt=_INT,
        sls_ship_dt=_INT, sls_due_dt=_INT, sls_sales=_INT, sls_quantity=_INT, sls_price=_INT,
    ),
    "erp_cust_az12": _struct(cid=_TEXT, bdate=_DATE, gen=_TEXT),
    "erp_loc_a101": _struct(cid=_TEXT, cntry=_TEXT),
    "erp_pc_cat_g1v2": _struct(id=_TEXT, cat=_TEXT, subcat=_TEXT, maintenance=_TEXT),
}

FEED_FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_pc_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}


def text_columns(table: str) -> list[str]:
    return [f.name for f in RAW[table].fields if isinstance(f.dataType, T.StringType)]
