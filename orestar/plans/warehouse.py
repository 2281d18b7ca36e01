"""The batch job: CSV files to bronze, bronze to silver, silver to gold, the checks and the reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orestar.plans import checks, gold, reports, silver
from orestar.plans.layer import Layer
from orestar.schemas import AUDIT_COLUMN, BRONZE, FEED_FILES, GOLD, RAW, SILVER
from orestar.sources import csv_feeds
from orestar.sources.lake import Lake
from orestar.sources.run_log import LAYER as OPS
from orestar.sources.run_log import Loaded, RunLog
from orestar.workspace import scratch

REPORTS = "reports"


class Warehouse:
    """Full refresh of the latest dataset. Each method reads the layer before it."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "",
        as_of: dt.date | None = None,
        erp_scope: str = "new_only",
        on_invalid_date: str = "fail",
    ) -> None:
        self.spark = spark
        self.lake = Lake(spark, root, prefix)
        self.lake.restore()
        if self.lake.exists(GOLD, "fact_sales"):
            self._name_fact_view()
        self.log = RunLog(self.lake, uuid4().hex)
        self.as_of = as_of
        self.erp_scope = erp_scope
        self.on_invalid_date = on_invalid_date

    def run(self, source_dir: str, mode: str = "PERMISSIVE", **read_options: str) -> DataFrame:
        """Everything, logged as one batch besides its tables. Options are those of ``read_raw``."""

        def batch() -> Loaded:
            self.load_bronze(source_dir, mode, **read_options)
            self.load_silver()
            self.build_gold()
            self.run_checks()
            self.build_reports()
            return Loaded()

        self.log.record("batch", "all", batch)
        return self.check_results()

    def load_bronze(self, source_dir: str, mode: str = "PERMISSIVE", **read_options: str) -> None:
        """Load the feeds. Lines that do not fit are kept with their reason, dropped and counted, or stop the load.

        Each feed is parsed once, into a folder of accepted and one of rejected
        lines; if there are any of these the raw lines are read once more, to keep
        them as they are with the columns at fault. The table changes only after
        the rejects are safe.
        """

        def load(table: str) -> Loaded:
            lines = csv_feeds.read_raw(self.spark, f"{source_dir}/{FEED_FILES[table]}", table, **read_options)
            judged = csv_feeds.judged(lines, table).withColumn("outcome", F.expr("if(reason IS NULL, 'accepted', 'rejected')"))
            seen = Observation()
            counted = judged.observe(seen, F.expr("count_if(reason IS NULL) AS rows"), F.expr("count_if(reason IS NOT NULL) AS rejects"))
            folder = self.lake.fresh_folder(BRONZE, table)
            counted.write.partitionBy("outcome").parquet(folder)
            rows, rejects = (seen.get.get(name, 0) for name in ("rows", "rejects"))
            if rejects and mode == "FAILFAST":
                raise ValueError(f"{rejects} lines do not fit {table}")
            if rejects and mode == "PERMISSIVE":
                raw = csv_feeds.read_lines(self.spark, f"{source_dir}/{FEED_FILES[table]}")
                bad = csv_feeds.rejected_lines(raw, table, **{k: v for k, v in read_options.items() if k in ("sep", "quote")})
                named = bad.withColumn("batch_id", F.lit(self.log.batch_id))
                self.lake.append(named, OPS, f"rejects_{table}")
            if not rows:
                # No line was accepted, so no such folder was written.
                self.spark.createDataFrame([], RAW[table]).write.mode("append").parquet(f"{folder}/outcome=accepted")
            self.lake.point(BRONZE, table, f"{folder}/outcome=accepted", lines.select(*RAW[table].names).schema)
            return Loaded(rows, rejects)

        if mode not in csv_feeds.MODES:
            raise ValueError(f"mode must be one of {', '.join(csv_feeds.MODES)}, not {mode!r}")
        self._each(BRONZE, RAW, load)

    def load_silver(self) -> None:
        """Five tables at once; then the ERP people, who depend on the stored customers."""
        self._each(SILVER, [t for t in RAW if t != "erp_cust_az12"], self._refresh_silver)
        self._each(SILVER, ["erp_cust_az12"], self._refresh_silver)

    def _refresh_silver(self, table: str) -> Loaded:
        customers = self.lake.read(SILVER, "crm_cust_info") if table == "erp_cust_az12" else None
        tables = silver.silver_layer(
            self.layer(BRONZE), self.as_of, self.erp_scope, self.on_invalid_date, customers
        )
        rows = self.lake.overwrite(tables[table].withColumn(AUDIT_COLUMN, F.current_timestamp()), SILVER, table)
        return Loaded(rows)

    def build_gold(self) -> None:
        """Both dimensions, then the fact, which is also readable as ``dim_fact_sales``."""
        clean = self.layer(SILVER)
        dimensions = {
            "dim_customers": lambda: gold.dim_customers(
                clean["crm_cust_info"], clean["erp_cust_az12"], clean["erp_loc_a101"]
            ),
            "dim_products": lambda: gold.dim_products(clean["crm_prd_info"], clean["erp_pc_cat_g1v2"]),
        }
        # The numbered members are written once more than stored; that copy goes with the block.
        with scratch(self.spark):
            self._each(GOLD, dimensions, lambda table: Loaded(self.lake.overwrite(dimensions[table](), GOLD, table)))

        def load_fact(table: str) -> Loaded:
            products, customers = (self.lake.read(GOLD, name) for name in ("dim_products", "dim_customers"))
            fact = gold.fact_sales(clean["crm_sales_details"], products, customers)
            # By date, as most reports ask for a period; the order number spreads a busy day.
            return Loaded(self.lake.overwrite(fact, GOLD, table, cluster=("order_date", "order_number")))

        self._each(GOLD, ["fact_sales"], load_fact)
        self._name_fact_view()

    def _name_fact_view(self) -> None:
        fact, other_name = (self.lake.name(GOLD, table) for table in ("fact_sales", "dim_fact_sales"))
        self.spark.sql(f"CREATE OR REPLACE VIEW {other_name} AS SELECT * FROM {fact}")

    def run_checks(self) -> DataFrame:
        """Run every check on the stored layers, gold included, and keep the results."""
        bronze, clean = self.layer(BRONZE), self.layer(SILVER)
        found = [
            checks.full_suite(bronze, clean, self.as_of),
            checks.gold_checks(clean, {name: self.lake.read(GOLD, name) for name in ("fact_sales", "dim_products", "dim_customers")}),
        ]
        results = checks.union_all(found)
        kept = results.withColumns({"batch_id": F.lit(self.log.batch_id), "checked_at": F.current_timestamp()})
        self.lake.append(kept, OPS, "quality_results")
        return self.check_results()

    def check_results(self) -> DataFrame:
        stored = self.lake.read(OPS, "quality_results")
        return stored.where(stored.batch_id == self.log.batch_id)

    def build_reports(self) -> None:
        """The reports over the stored gold layer, each as a table; the summary reports from one pass over it."""
        star = self.star()
        clean = self.layer(SILVER)
        tables = {name: lambda report=report: report(star) for name, report in reports.STAR_REPORTS.items()}
        tables["sales_point_in_time"] = lambda: reports.sales_point_in_time(clean["crm_sales_details"], clean["crm_prd_info"])
        tables["summaries"] = lambda: reports.summaries(star)
        self._each(REPORTS, tables, lambda table: Loaded(self.lake.overwrite(tables[table](), REPORTS, table)))
        found = self.lake.read(REPORTS, "summaries")
        self._each(
            REPORTS, reports.FROM_SUMMARIES,
            lambda table: Loaded(self.lake.overwrite(reports.FROM_SUMMARIES[table](found), REPORTS, table)),
        )

    def star(self) -> DataFrame:
        """Gold as the reports read it."""
        fact, products, customers = (
            self.lake.read(GOLD, name) for name in ("fact_sales", "dim_products", "dim_customers")
        )
        return gold.star_of_fact(fact, products, customers)

    def layer(self, layer: str) -> Layer:
        return Layer({table: lambda table=table: self.lake.read(layer, table).drop(AUDIT_COLUMN) for table in RAW})

    def _each(self, layer: str, tables: Iterable[str], load: Callable[[str], Loaded]) -> None:
        """Load independent tables side by side: each is its own Spark job.

        The first error is raised after all have finished.
        """
        tables = list(tables)
        record = inheritable_thread_target(self.spark)(
            lambda table: self.log.record(layer, table, lambda: load(table))
        )
        with ThreadPoolExecutor(len(tables)) as pool:
            started = [pool.submit(record, table) for table in tables]
        for future in started:
            future.result()
