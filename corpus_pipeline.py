"""The corpus pipeline: stages that each take documents and hand on what they keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orestar.llm import decontamination, exact_dedup, mixing, near_dedup, toxicity
from orestar.session import prepare
from orestar.workspace import fresh_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold of their language."""
    prepare(spark)
    return toxicity.remove_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact_dedup.remove_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: five-word shingles, similarity 0.8."""
    prepare(spark)
    return near_dedup.remove_near(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    prepare(spark)
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy the mix takes, with its shard and its order in the shard."""
    prepare(spark)
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("minhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        path = fresh_path(spark, "stage_" + name.replace(" ", "_"))
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
