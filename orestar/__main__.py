"""Batch jobs for spark-submit: load a layer, run the checks, build the reports, or do the batch.

    spark-submit --py-files orestar.zip orestar/__main__.py all --sources s3a://in --root s3a://lake

The exit code is 1 if a check of severity FAIL found something.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from orestar.operators.quality import FAIL
from orestar.plans.checks import suite_verdict
from orestar.plans.warehouse import Warehouse
from orestar.session import cluster_session, prepare
from orestar.sources import csv_feeds


def _arguments(words: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orestar", description=__doc__)
    parser.add_argument("job", choices=["bronze", "silver", "gold", "checks", "reports", "all"])
    parser.add_argument("--root", required=True, help="folder of the stored layers")
    parser.add_argument("--sources", help="folder of the CSV feeds (bronze, all)")
    parser.add_argument("--prefix", default="", help="put before the database names")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="day after which a birth date is unknown; today")
    parser.add_argument("--erp-scope", choices=["new_only", "all"], default="new_only")
    parser.add_argument("--on-invalid-date", choices=["fail", "null"], default="fail")
    parser.add_argument("--mode", choices=csv_feeds.MODES, default="PERMISSIVE", help="what lines do that fit no schema")
    parser.add_argument("--sep", default=",", help="what parts the fields of a feed")
    parser.add_argument("--quote", default='"', help="what encloses a field; empty reads quotes as ordinary characters")
    parser.add_argument("--collation", help="collation of the text columns, such as UTF8_LCASE")
    parser.add_argument("--shuffle-partitions", help="tasks of a shuffle; about one per 128 MB of the largest table")
    given = parser.parse_args(words)
    if given.job in ("bronze", "all") and not given.sources:
        parser.error("--sources is needed to load bronze")
    return given


def _report(results: DataFrame) -> int:
    verdicts = suite_verdict(results).orderBy("check_id").collect()  # one row per check
    for verdict in verdicts:
        print(f"{verdict.check_id:5} {verdict.status}")
    return int(any(verdict.status == FAIL for verdict in verdicts))


def main(words: Sequence[str] | None = None) -> int:
    given = _arguments(words)
    active = SparkSession.getActiveSession()
    spark = prepare(active) if active else cluster_session()
    if given.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", given.shuffle_partitions)
    warehouse = Warehouse(
        spark, given.root, given.prefix, given.as_of, given.erp_scope, given.on_invalid_date
    )
    reading = {"sep": given.sep, "quote": given.quote} | ({"collation": given.collation} if given.collation else {})
    if given.job == "all":
        return _report(warehouse.run(given.sources, given.mode, **reading))
    if given.job == "bronze":
        warehouse.load_bronze(given.sources, given.mode, **reading)
    elif given.job == "silver":
        warehouse.load_silver()
    elif given.job == "gold":
        warehouse.build_gold()
    elif given.job == "reports":
        warehouse.build_reports()
    return _report(warehouse.run_checks()) if given.job == "checks" else 0


if __name__ == "__main__":
    raise SystemExit(main())
