"""Dense surrogate keys without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestar.workspace import materialise

# Fixed value: monotonically_increasing_id holds the partition number above
# this many bits and the row's index in the partition below.
_INDEX_BITS = 33


def surrogate_key(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Number the rows 1..n in ``order``, ties broken by the remaining columns.

    A distributed sort puts the rows in order across partitions, where the row
    index inside the partition is free. The sorted rows are written once, so
    the index and the partition sizes come from the same partitioning. What is
    broadcast is one row per partition of that sort.
    """
    ties = [c for c in df.columns if c not in order]
    placed = df.orderBy(*order, *ties).selectExpr(
        "*", f"shiftright(monotonically_increasing_id(), {_INDEX_BITS}) AS part",
        f"monotonically_increasing_id() & {(1 << _INDEX_BITS) - 1} AS place",
    )
    ranked = materialise(placed, out)
    sizes = ranked.groupBy("part").agg(F.expr("count(*) AS size"))
    before = "sum(size) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = sizes.selectExpr("part", f"coalesce({before}, 0) AS offset")
    return ranked.join(F.broadcast(offsets), "part").selectExpr(f"offset + place + 1 AS {out}", *df.columns)
