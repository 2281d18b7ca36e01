from __future__ import annotations

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from orestar.sources.csv_feeds import accepted, read_lines, read_raw, rejected, rejected_lines


@pytest.fixture
def feed(spark, tmp_path):
    def write(text: str, table: str, **options):
        path = tmp_path / "feed.csv"
        path.write_text(text)
        return read_raw(spark, str(path), table, **options)

    return write


CUSTOMERS = (
    "header,of,other,names,than,the,table\n"
    '1,AW1,"Smith, J", padded ,S,F,2025-01-31\n'
    "2,AW2,  ,,M,,\n"
    "x,AW3,a,b,S,F,2025-01-31\n"
    "4,AW4,a,b,S,F\n"
    "5,AW5,a,b,S,F,2025-01-31,more\n"
    f"6,{'K' * 51},a,b,S,F,2025-01-31\n"
    f"7,{'K' * 50},a,b,S,F,2025-01-31\n"
    "8,AW8,a,b,S,F,2025-02-31\n"
)


def test_rows_and_rejects(feed):
    lines = feed(CUSTOMERS, "crm_cust_info")
    good = {r.cst_id: r for r in accepted(lines, "crm_cust_info").collect()}
    assert good.keys() == {1, 2, 7}
    assert good[1].cst_firstname == "Smith, J"
    assert good[1].cst_lastname == " padded "
    assert good[2].cst_firstname == "  "
    assert good[2].cst_lastname is None and good[2].cst_create_date is None
    bad = {(r.line.split(",")[0], r.reason) for r in rejected(lines, "crm_cust_info").collect()}
    assert bad == {("x", "malformed"), ("4", "malformed"), ("5", "malformed"), ("6", "over_long"), ("8", "malformed")}


def test_the_verdict_does_not_depend_on_the_columns_used(feed):
    lines = feed(CUSTOMERS, "crm_cust_info")
    assert accepted(lines, "crm_cust_info").count() == 3
    assert accepted(lines, "crm_cust_info").select("cst_key").count() == 3
    counts = rejected(lines, "crm_cust_info").groupBy("reason").count()
    assert dict(map(tuple, counts.collect())) == {"malformed": 4, "over_long": 1}


def test_fail_fast(feed):
    with pytest.raises((PySparkException, Py4JJavaError)):
        feed(CUSTOMERS, "crm_cust_info", mode="FAILFAST").collect()
    with pytest.raises((PySparkException, Py4JJavaError)):
        feed(CUSTOMERS, "crm_cust_info", mode="FAILFAST").select("cst_key").count()
    clean = "h,h\nAW-1,DE\n"
    assert feed(clean, "erp_loc_a101", mode="FAILFAST").count() == 1


def test_drop_malformed(feed):
    lines = feed(CUSTOMERS, "crm_cust_info", mode="DROPMALFORMED")
    assert sorted(r.cst_id for r in lines.collect()) == [1, 2, 7]
    assert lines.count() == lines.select("cst_key").count() == 3


def test_an_unknown_mode(feed):
    with pytest.raises(ValueError):
        feed(CUSTOMERS, "crm_cust_info", mode="LENIENT")


def test_quotes_as_ordinary_characters(feed):
    lines = feed('h,h\nAW-1,"DE"\n', "erp_loc_a101", quote="")
    assert accepted(lines, "erp_loc_a101").first().cntry == '"DE"'


def test_collation(spark, feed):
    lines = accepted(feed("h,h\nAW1,de \nAW2,FR\n", "erp_loc_a101", collation="UTF8_LCASE_RTRIM"), "erp_loc_a101")
    assert lines.where("cntry = 'DE'").count() == 1
    known = spark.createDataFrame([("aw1",)], "k string")
    assert lines.join(known, lines.cid == known.k.cast(lines.schema["cid"].dataType)).count() == 1


def test_other_separator(feed):
    assert accepted(feed("h;h\nAW-1;DE\n", "erp_loc_a101", sep=";"), "erp_loc_a101").first().cntry == "DE"


def test_rejects_name_their_columns_and_keep_the_line(spark, feed, tmp_path):
    lines = feed(CUSTOMERS + f'9,"{"K" * 51}", a ,"b ""x""",S,F,2025-01-31\nz,AW9,{"L" * 60},b,S,F,yesterday\n\u0001,AW10,a,b,S,F,\n', "crm_cust_info")
    found = rejected_lines(read_lines(spark, str(tmp_path / "feed.csv")), "crm_cust_info")
    assert found.columns == ["table_name", "reason", "faults", "line"]
    told = {r.line.split(",")[0]: (r.reason, r.faults) for r in found.collect()}
    assert told == {
        "x": ("malformed", "cst_id"), "4": ("malformed", "number of fields"), "5": ("malformed", "number of fields"),
        "6": ("over_long", "cst_key"), "8": ("malformed", "cst_create_date"), "9": ("over_long", "cst_key"),
        "z": ("malformed", "cst_id, cst_firstname, cst_create_date"), "\u0001": ("malformed", "cst_id"),
    }
    kept = {r.line for r in found.collect()}
    assert f'9,"{"K" * 51}", a ,"b ""x""",S,F,2025-01-31' in kept
    # The same lines as those the typed reading turns away.
    assert rejected(lines, "crm_cust_info").groupBy("reason").count().orderBy("reason").collect() == (
        found.groupBy("reason").count().orderBy("reason").collect()
    )


def test_no_line_is_turned_away(spark, feed, tmp_path):
    feed("h;h\nAW-1;'D;E'\n", "erp_loc_a101", sep=";", quote="'")
    lines = read_lines(spark, str(tmp_path / "feed.csv"))
    assert rejected_lines(lines, "erp_loc_a101", sep=";", quote="'").count() == 0
    assert [r.faults for r in rejected_lines(lines, "erp_loc_a101", sep=";", quote="").collect()] == ["number of fields"]
