"""Exact duplicates: rows are grouped by a 128-bit content hash and, inside a hash, by their bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestar.llm.text import free_name, present, same, without_space

HASH_BYTES = 16


def _rows(docs: DataFrame, id_col: str, text_col: str, hash_bytes: int) -> DataFrame:
    text = present(F.col(text_col))
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.char_length(text).alias("n_chars"), without_space(text).alias("bare"))
        .withColumn("hash", F.substring(F.unhex(F.md5("bare")), 1, hash_bytes))
        .withColumn("sha", F.sha2("bare", 256))
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bytes: int = HASH_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if nothing but white space tells them apart. The row with
    the most code points stays, then the smallest id. The grouping key is the
    content hash together with the text itself, so two texts that share a hash
    never share a group; equal texts meet in the map-side aggregation first, so
    a group of any size sends one row per task.

    Null texts count as empty, and empty texts equal each other. A null id loses
    against any other id in a tie. Rows that repeat both id and text each get a
    result row, all of them kept if the id is: the id cannot tell them apart.
    ``remove_exact`` leaves one of them. Ids are taken as bigint: those that are no
    number stop the query. Other columns are ignored.
    """
    rows = _rows(docs, id_col, text_col, hash_bytes)
    groups = (
        rows.groupBy("hash", "bare")
        # The complement reverses the order of the ids without overflow.
        .agg(F.expr("max(struct(n_chars, ~CAST(doc_id AS bigint) AS turned))").alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select(
            "hash",
            F.sha2("bare", 256).alias("sha"),
            F.expr("~best.turned").alias("keep_id"),
            F.col("best.n_chars").alias("keep_chars"),
            "group_size",
        )
    )
    # The digest joins a row to the group whose bytes it shares.
    return rows.drop("bare").join(groups, ["hash", "sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (same(F.col("doc_id"), F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def remove_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")
    )
    sha = free_name(docs, "sha_of_bare_text")
    chars = free_name(docs, "length_of_text")
    marked = docs.withColumns({sha: F.sha2(without_space(F.col(text_col)), 256), chars: F.char_length(present(F.col(text_col)))})
    left = marked.join(kept, same(marked[id_col], kept["kept_id"]) & (marked[sha] == kept["kept_sha"]), "left_semi")
    # Only rows that repeat the id of a kept row can still meet here.
    first = left.groupBy(id_col, sha).agg(F.max_by(F.struct(*docs.columns), F.col(chars)).alias("row"))
    return first.select("row.*")
