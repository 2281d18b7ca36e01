"""NOT IN with SQL's treatment of NULLs, as a shuffle-scalable anti join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARTS = 8


def few_copies(df: DataFrame, key: str, out: str = "listed_key") -> DataFrame:
    """The distinct non-NULL values of ``key``, each at most once per ``part``.

    For the right side of a semi or anti join: a hot value shrinks to a few rows
    before the shuffle. Reducing it to one would leave the values already
    partitioned for the join, and a join that shuffles only one side cannot be
    split when a left key is hot.
    """
    parted = df.selectExpr(f"{key} AS {out}", f"spark_partition_id() % {_PARTS} AS part").where(f"{out} IS NOT NULL")
    return parted.distinct().select(out)


def anti_join_null_aware(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` for which ``key NOT IN (right_key of right)`` is true.

    One NULL on the right makes the condition true for no row; an empty right
    side makes it true for every row; otherwise rows with a NULL key drop out.
    SQL's own NOT IN is planned as a broadcast of the right side whatever its
    size. Here the match is a plain anti join, and the two facts about the
    right side come from one scalar subquery.
    """
    keys = right.selectExpr(f"{right_key or key} AS listed_key")
    facts = keys.selectExpr(
        "struct(count(*) = 0 AS is_empty, coalesce(bool_or(listed_key IS NULL), false) AS has_null)"
    ).scalar()
    unmatched = left.join(few_copies(keys, "listed_key"), F.expr(f"{key} = listed_key"), "left_anti")
    return unmatched.where(
        facts.getField("is_empty") | (F.col(key).isNotNull() & ~facts.getField("has_null"))
    )
