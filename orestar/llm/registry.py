"""The registered queries of this subpackage, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestar.llm import (
    decontamination,
    exact_dedup,
    line_dedup,
    lm_scoring,
    mask_search,
    mixing,
    near_dedup,
    periodic_runs,
    quality,
    quotes,
    secret_scan,
    toxicity,
    url_filter,
)
from orestar.llm.sql_twins import TWINS

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("digest")


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations mailed with quotes, and put together again from the quotes alone."""
    linked = quotes.link_quotations(quotes.mails_of(_table(spark, sf_dir, "conversations")))
    return linked.select(
        F.col("id.conv_id").alias("conv_id"),
        F.col("id.turn").alias("turn"),
        F.col("root.conv_id").alias("root_conv_id"),
        F.col("root.turn").alias("root_turn"),
        F.col("parent.conv_id").alias("parent_conv_id"),
        F.col("parent.turn").alias("parent_turn"),
        "depth",
        F.sha2(quotes.normalised(F.col("own")), 256).alias("own_sha256"),
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.deduplicate_lines(_table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.spam_hosts(pages))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The contract's shingles have two words.
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=2).drop("digest")


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.language_scores(_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.top_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [
        op1_quality_classifier,
        op2_toxicity,
        op3_benchmark_decontamination,
        op4_quotation_linking,
        op5_source_mixing,
        op6_secret_scan,
        op7_line_dedup,
        op8_url_filter,
        op9_exact_dedup,
        op10_minhash_near_dedup,
        op11_lm_scoring,
        op12_ranked_search,
        op13_periodic_runs,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return dict(TWINS)
