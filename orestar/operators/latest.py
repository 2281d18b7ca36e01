"""Newest record per key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def latest_by_key(df: DataFrame, key: str, newest: str) -> DataFrame:
    """One row per non-NULL ``key``: the one with the greatest ``newest``.

    A NULL ``newest`` loses to any value; ties go to the greatest remaining
    columns, so the result is the same on every run. It is a plain maximum, so
    each task reduces a key to one candidate before the shuffle, however many
    records the key has.
    """
    rest = [c for c in df.columns if c not in (key, newest)]
    record = f"struct({', '.join([newest, *rest])})"
    best = df.where(f"{key} IS NOT NULL").selectExpr(key, f"{record} AS record").groupBy(key).agg({"record": "max"})
    return best.toDF(key, "best").select(key, "best.*").select(*df.columns)
