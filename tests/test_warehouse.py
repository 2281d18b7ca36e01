from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as driver
from orestar import workspace
from orestar.__main__ import main
from orestar.plans import reports
from orestar.plans.warehouse import Warehouse
from orestar.schemas import FEED_FILES, RAW
from orestar.sources import csv_feeds, feeds
from orestar.sources.lake import Lake
from test_operators import same_rows


@pytest.fixture(scope="module")
def sources(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sources"))
    for table, file in FEED_FILES.items():
        csv_feeds.write_csv(feeds.raw_table(spark, sf_dir, table), f"{folder}/{file}")
    return folder


@pytest.fixture(scope="module")
def loaded(spark, sources, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("lake")), "loaded_", as_of=driver.AS_OF)
    return warehouse, warehouse.run(sources)


def test_layers_equal_the_lazy_queries(spark, sf_dir, loaded):
    warehouse, _ = loaded
    queries = driver.queries()
    for table, name in [("crm_prd_info", "silver_products"), ("erp_cust_az12", "silver_erp_customers_new")]:
        assert same_rows(warehouse.layer("silver")[table], queries[name](spark, sf_dir))
    for table in ("dim_customers", "dim_products", "fact_sales"):
        assert same_rows(warehouse.lake.read("gold", table), queries[f"gold_{table}"](spark, sf_dir))


def test_tables_answer_sql(spark, loaded):
    question = "SELECT sum(f.sales_amount) FROM loaded_gold.{} f JOIN loaded_gold.dim_products p USING (product_key)"
    totals = {spark.sql(question.format(name)).first()[0] for name in ("fact_sales", "dim_fact_sales")}
    assert len(totals) == 1 and totals.pop() > 0


def test_reports_on_the_stored_star(spark, sf_dir, loaded):
    warehouse, _ = loaded
    for report, name in [
        (reports.sales_by_country, "report_sales_by_country"),
        (reports.profit, "report_profit"),
        (reports.sales_by_cost, "report_sales_by_cost"),
    ]:
        assert same_rows(report(warehouse.star()), driver.queries()[name](spark, sf_dir))


def test_quality_results_are_kept(spark, sf_dir, loaded):
    warehouse, results = loaded
    suite = driver.queries()["quality_suite"](spark, sf_dir)
    # V6 is a list of keys in the suite's catalogue; the batch adds their number.
    kept = results.select("check_id", "table_name", "metric", "value", "status")
    in_suite = [r.check_id for r in suite.select("check_id").distinct().collect()]
    assert same_rows(kept.where(kept.check_id.isin(in_suite)), suite)


def test_the_batch_keeps_gold_checks_and_listings(spark, sf_dir, loaded):
    _, results = loaded
    found = {(r.check_id, r.metric): (r.value, r.status) for r in results.collect()}
    run = driver.queries()
    products = run["gold_fk_check"](spark, sf_dir).count()
    customers = run["gold_fk_check_customer"](spark, sf_dir).count()
    assert found["v36", "orphans_by_product_key"] == (products, "FAIL" if products else "PASS")
    assert found["v36", "orphans_by_customer_key"] == (customers, "FAIL" if customers else "PASS")
    for r in run["gold_join_guard"](spark, sf_dir).collect():
        assert found["guard", r.join_name] == (r.extra_rows, "PASS")
    for check_id in ("v3", "v12", "v24", "v26", "v30"):
        for r in run[f"check_{check_id}"](spark, sf_dir).collect():
            assert found[check_id, f"{r.label}: {r.value or 'NULL'}"] == (r.row_count, "INFO")
    assert found["v6", "listed"][0] == run["check_v6"](spark, sf_dir).count()
    assert found["v13", "listed"][0] == run["check_v13"](spark, sf_dir).count()
    counts = {(r.table_name, r.metric): r.value for r in results.where("check_id = 'v35'").collect()}
    for r in run["check_v35"](spark, sf_dir).collect():
        assert (counts[r.table_name, "silver_rows"], counts[r.table_name, "bronze_rows"]) == (r.silver_rows, r.bronze_rows)


def test_reports_are_stored(spark, sf_dir, loaded):
    warehouse, _ = loaded
    warehouse.build_reports()
    stored = lambda name: warehouse.lake.read("reports", name)
    assert same_rows(stored("sales_by_country"), driver.queries()["report_sales_by_country"](spark, sf_dir))
    assert same_rows(stored("products"), driver.queries()["report_products"](spark, sf_dir))
    assert same_rows(stored("sales_point_in_time"), driver.queries()["fact_sales_point_in_time"](spark, sf_dir))


def test_the_fact_is_sorted_by_date(loaded):
    warehouse, _ = loaded
    fact = warehouse.lake.read("gold", "fact_sales")
    spans = fact.selectExpr("input_file_name() AS f", "order_date").groupBy("f").agg({"order_date": "min"}).collect()
    rows = fact.selectExpr("input_file_name() AS f", "order_date").where("order_date IS NOT NULL").groupBy("f")
    ends = sorted((r[1], r[2]) for r in rows.agg(F.min("order_date"), F.max("order_date")).collect())
    assert len(spans) >= 1 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_intermediate_tables_go_after_use(spark, tmp_path):
    shared = Path(workspace.shared_root(spark).removeprefix("file:"))
    with workspace.scratch(spark):
        kept = workspace.materialise(spark.range(3), "passing")
        assert kept.count() == 3 and list(shared.glob("passing-*"))
    assert not list(shared.glob("passing-*"))


def test_run_log(loaded):
    warehouse, _ = loaded
    entries = warehouse.log.entries().where("layer <> 'reports'").collect()
    assert len(entries) == 16
    assert {e.status for e in entries} == {"LOADED"}
    assert all(e.ended_at >= e.started_at for e in entries)
    assert all(e.rows_loaded > 0 for e in entries if e.layer != "batch")
    (batch,) = [e for e in entries if e.layer == "batch"]
    assert batch.seconds >= max(e.seconds for e in entries if e.layer != "batch")


def test_silver_rows_carry_the_load_time(loaded):
    warehouse, _ = loaded
    table = warehouse.lake.read("silver", "erp_loc_a101")
    assert table.where("dwh_create_date IS NULL").count() == 0
    assert table.select("dwh_create_date").distinct().count() == 1


def test_rejected_lines_are_kept_and_the_rest_is_loaded(spark, tmp_path):
    for table, file in FEED_FILES.items():
        path = tmp_path / "src" / file
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(",".join(RAW[table].names) + "\n")
    (tmp_path / "src" / FEED_FILES["erp_loc_a101"]).write_text("cid,cntry\nAW-1,DE\nAW-2\n")
    warehouse = Warehouse(spark, str(tmp_path / "lake"), "rejects_")
    warehouse.load_bronze(str(tmp_path / "src"))
    assert [r.cid for r in warehouse.lake.read("bronze", "erp_loc_a101").collect()] == ["AW-1"]
    rejects = warehouse.lake.read("ops", "rejects_erp_loc_a101").collect()
    assert [(r.reason, r.line) for r in rejects] == [("malformed", "AW-2")]
    counts = {r.table_name: r.rows_loaded for r in warehouse.log.entries().collect()}
    assert counts["erp_loc_a101"] == 1 and counts["crm_cust_info"] == 0


@pytest.fixture
def feed_with_a_bad_line(tmp_path):
    def write(places: str) -> str:
        for table, file in FEED_FILES.items():
            path = tmp_path / "src" / file
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(",".join(RAW[table].names) + "\n")
        (tmp_path / "src" / FEED_FILES["erp_loc_a101"]).write_text(f"cid,cntry\n{places}")
        return str(tmp_path / "src")

    return write


def test_the_table_stays_if_its_rejects_cannot_be_kept(spark, tmp_path, feed_with_a_bad_line, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "lake"), "unsafe_")
    warehouse.load_bronze(feed_with_a_bad_line("AW-1,DE\n"))
    monkeypatch.setattr(warehouse.lake, "append", lambda df, layer, table, keep=warehouse.lake.append: (
        keep(df, layer, table) if not table.startswith("rejects_") else (_ for _ in ()).throw(OSError("disk full"))
    ))
    with pytest.raises(OSError):
        warehouse.load_bronze(feed_with_a_bad_line("AW-2,DE\nAW-3\n"))
    assert [r.cid for r in warehouse.lake.read("bronze", "erp_loc_a101").collect()] == ["AW-1"]


def test_modes_share_one_verdict(spark, tmp_path, feed_with_a_bad_line):
    lines = feed_with_a_bad_line(f"AW-1,DE\nAW-2\n{'K' * 51},DE\n")
    dropping = Warehouse(spark, str(tmp_path / "dropped"), "dropping_")
    dropping.load_bronze(lines, mode="DROPMALFORMED")
    assert [r.cid for r in dropping.lake.read("bronze", "erp_loc_a101").collect()] == ["AW-1"]
    (entry,) = dropping.log.entries().where("table_name = 'erp_loc_a101'").collect()
    assert (entry.rows_loaded, entry.rows_rejected) == (1, 2)
    assert not dropping.lake.exists("ops", "rejects_erp_loc_a101")
    strict = Warehouse(spark, str(tmp_path / "strict"), "strict_")
    with pytest.raises(ValueError, match="2 lines"):
        strict.load_bronze(lines, mode="FAILFAST")
    assert not strict.lake.exists("bronze", "erp_loc_a101")


def test_jobs_in_processes_of_their_own(sources, tmp_path):
    """Nothing but the root folder passes from one job to the next."""
    root = tmp_path / "it's a lake"
    env = os.environ | {
        "PYSPARK_SUBMIT_ARGS": "--master local[4] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 pyspark-shell",
        "PYTHONPATH": str(Path(__file__).parents[1]),
    }

    def job(*words: str) -> int:
        command = [sys.executable, "-m", "orestar", *words, "--root", str(root), "--as-of", "2026-01-01", "--shuffle-partitions", "4"]
        return subprocess.run(command, env=env, cwd=tmp_path, capture_output=True, timeout=600).returncode

    assert [job("bronze", "--sources", sources), job("silver"), job("gold"), job("checks"), job("reports")] == [0, 0, 0, 1, 0]


def test_a_failed_load_is_logged_raised_and_changes_nothing(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), "failing_")
    good = [("SO1", "P1", 1, 20200101, 20200102, 20200103, 10, 1, 10)]
    bad = [("SO2", "P1", 1, 20201332, 20200102, 20200103, 10, 1, 10)]
    for rows, fails in ((good, False), (bad, True)):
        warehouse.lake.overwrite(spark.createDataFrame(rows, RAW["crm_sales_details"]), "bronze", "crm_sales_details")
        for table in RAW.keys() - {"crm_sales_details"}:
            warehouse.lake.overwrite(spark.createDataFrame([], RAW[table]), "bronze", table)
        if fails:
            with pytest.raises((PySparkException, Py4JJavaError)):
                warehouse.load_silver()
        else:
            warehouse.load_silver()
    assert [r.sls_ord_num for r in warehouse.lake.read("silver", "crm_sales_details").collect()] == ["SO1"]
    failed = warehouse.log.entries().where("status = 'FAILED'").collect()
    assert [f.table_name for f in failed] == ["crm_sales_details"]
    assert failed[0].error
    tolerant = Warehouse(spark, str(tmp_path), "failing_", on_invalid_date="null")
    tolerant.load_silver()
    assert tolerant.lake.read("silver", "crm_sales_details").first().sls_order_dt is None


def test_command_line(spark, sources, tmp_path):
    job = ["--root", str(tmp_path), "--prefix", "cli_", "--as-of", "2026-01-01"]
    assert main(["bronze", "--sources", sources, *job]) == 0
    assert main(["silver", *job]) == 0
    assert main(["gold", *job]) == 0
    assert main(["checks", *job]) == 1  # the feeds carry faults of severity FAIL
    assert spark.table("cli_gold.dim_fact_sales").count() == spark.table("cli_silver.crm_sales_details").count()
    assert spark.table("cli_ops.load_runs").where("status = 'LOADED'").count() == 15


def test_refresh_from_itself_and_new_columns(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), "refresh_")
    assert lake.overwrite(spark.range(5), "silver", "t") == 5
    assert lake.overwrite(lake.read("silver", "t").where("id > 1"), "silver", "t") == 3
    assert sorted(r.id for r in lake.read("silver", "t").collect()) == [2, 3, 4]
    lake.overwrite(spark.range(2).selectExpr("id", "'x' AS v"), "silver", "t")
    assert lake.read("silver", "t").columns == ["id", "v"]


def test_erp_scope(spark, sf_dir, loaded):
    """Only with all ERP people does the customer dimension get birth dates."""
    run = driver.queries()
    assert run["gold_dim_customers"](spark, sf_dir).where("birthdate IS NOT NULL").count() == 0
    assert run["gold_dim_customers_enriched"](spark, sf_dir).where("birthdate IS NOT NULL").count() > 0
    with pytest.raises(ValueError):
        driver.silver.silver_layer({}, erp_scope="some")


def test_as_of_defaults_to_today(spark):
    tomorrow = dt.date.today() + dt.timedelta(days=2)
    raw = spark.createDataFrame([("a", tomorrow, None), ("b", dt.date(2000, 1, 1), None)], RAW["erp_cust_az12"])
    got = {r.cid: r.bdate for r in driver.silver.clean_demographics(raw).collect()}
    assert got == {"a": None, "b": dt.date(2000, 1, 1)}
