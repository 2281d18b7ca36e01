from __future__ import annotations

import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from orestar.functions import cleansing as c
from orestar.plans import silver

# sales, quantity, price -> repaired sales, repaired price
SALES = [
    (20, 2, 10, 20, 10),
    (None, 2, 10, 20, 10),
    (0, 2, 10, 20, 10),
    (-5, 2, 10, 20, 10),
    (99, 2, 10, 20, 10),
    (20, 2, -10, 20, 10),
    (20, 2, None, 20, 10),
    (None, 2, None, None, None),
    (99, 2, -10, 20, 49),
    (-20, 2, -10, 20, -10),
    (20, 0, 10, 0, 10),
    (20, 0, None, 20, None),
    (20, -2, 10, -20, 10),
    (20, None, 10, 20, 10),
    (-7, 2, None, None, -3),
]


def test_repaired_measures(spark):
    rows = [(i, s, q, p) for i, (s, q, p, _, _) in enumerate(SALES)]
    df = spark.createDataFrame(rows, "i int, s int, q int, p int").selectExpr(
        "i", f"{c.repaired_sales('s', 'q', 'p')} AS sales", f"{c.repaired_price('s', 'q', 'p')} AS price"
    )
    assert [f.dataType.simpleString() for f in df.schema.fields[1:]] == ["int", "int"]
    got = {r.i: (r.sales, r.price) for r in df.collect()}
    assert got == {i: row[3:] for i, row in enumerate(SALES)}


DATES = [None, 0, 32154, 20101229, 20101332, -1234567, 20991231, 123456789]


def test_int_dates_null_when_invalid(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "d int")
    got = [r[0] for r in df.selectExpr(c.decode_int_date("d", "null")).collect()]
    assert got == [None, None, None, dt.date(2010, 12, 29), None, None, dt.date(2099, 12, 31), None]


@pytest.mark.parametrize("bad", [20101332, -1234567, 20230229])
def test_int_dates_stop_when_invalid(spark, bad):
    df = spark.createDataFrame([(20101229,), (bad,)], "d int")
    with pytest.raises((PySparkException, Py4JJavaError)):
        df.selectExpr(c.decode_int_date("d")).collect()


def test_both_date_modes_agree_on_valid_days(spark):
    days = spark.range(0, 60000, 13).selectExpr("date_add(DATE '1900-01-01', CAST(id AS int)) AS day")
    numbers = days.selectExpr("day", "CAST(date_format(day, 'yyyyMMdd') AS int) AS d")
    wrong = numbers.where(f"NOT ({c.decode_int_date('d')} = day AND {c.decode_int_date('d', 'null')} = day)")
    assert wrong.count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("f",), (" FEMALE ",), ("m ",), ("x",), ("",), (None,)], "g string")
    got = [r[0] for r in df.selectExpr(c.code_label("g", c.ERP_GENDER_LABELS)).collect()]
    assert got == ["Female", "Female", "Male", "n/a", "n/a", "n/a"]


def test_trim_keeps_tabs(spark):
    df = spark.createDataFrame([("\tS",)], "g string")
    assert df.selectExpr(c.code_label("g", c.MARITAL_LABELS)).first()[0] == "n/a"


def test_countries(spark):
    df = spark.createDataFrame([(" DE",), ("US",), ("USA ",), ("  ",), ("",), (None,), (" France ",), ("de",)], "x string")
    got = [r[0] for r in df.selectExpr(c.country_label("x")).collect()]
    assert got == ["Germany", "United States", "United States", "n/a", "n/a", "n/a", "France", "de"]


def test_product_key_parts(spark):
    df = spark.createDataFrame([("AC-HE-HL-U509-R",), ("AC",), (None,)], "k string")
    got = [tuple(r) for r in df.selectExpr(c.category_part("k"), c.product_part("k")).collect()]
    assert got == [("AC_HE", "HL-U509-R"), ("AC", ""), (None, None)]


def test_people(spark):
    raw = spark.createDataFrame(
        [("NASAW1", dt.date(2030, 1, 1), "F"), ("AW2", dt.date(2026, 1, 1), None), ("nasAW3", None, " male")],
        "cid string, bdate date, gen string",
    )
    got = [tuple(r) for r in silver.clean_demographics(raw, dt.date(2026, 1, 1)).collect()]
    assert got == [("AW1", None, "Female"), ("AW2", dt.date(2026, 1, 1), "n/a"), ("nasAW3", None, "Male")]


def test_products_close_versions_and_ignore_the_feed_end(spark):
    at = dt.datetime
    raw = spark.createDataFrame(
        [
            (1, "AC-HE-A", "one", None, "m", at(2020, 1, 1, 9), at(2019, 1, 1)),
            (2, "AC-HE-A", "two", -3, "S ", at(2021, 5, 1), None),
            (3, "AC-HE-B", "tie 1", 5, "x", at(2020, 1, 1, 8), None),
            (4, "AC-HE-B", "tie 2", 5, None, at(2020, 1, 1, 9), None),
        ],
        "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string,"
        " prd_start_dt timestamp_ntz, prd_end_dt timestamp_ntz",
    )
    got = {r.prd_id: (r.cat_id, r.prd_key, r.prd_cost, r.prd_line, r.prd_start_dt, r.prd_end_dt)
           for r in silver.clean_products(raw).collect()}
    day = dt.date
    assert got == {
        1: ("AC_HE", "A", 0, "Mountain", day(2020, 1, 1), day(2021, 4, 30)),
        2: ("AC_HE", "A", -3, "Other Sales", day(2021, 5, 1), None),
        3: ("AC_HE", "B", 5, "n/a", day(2020, 1, 1), day(2019, 12, 31)),
        4: ("AC_HE", "B", 5, "n/a", day(2020, 1, 1), None),
    }
