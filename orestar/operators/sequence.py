"""The next row's value within a key, without gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_COPIES_PER_TASK_ROW = 10_000


def with_next(df: DataFrame, key: str, order: str, out: str, day: str | None = None) -> DataFrame:
    """Add ``out``: the ``order`` value of the following row of the same ``key``.

    Equals ``lead(order) over (partition by key order by order, <other columns>)``
    with NULLs first, for any number of rows per key. Rows are first reduced to
    one per (key, order); of the rows sharing an ``order`` value all but the
    last are followed by that same value, so only the last needs the window.
    With a date as ``order`` the window holds at most one row per calendar day
    and key. For a finer ``order``, ``day`` names a column with its date; the
    window then runs inside a day, and across days on one row per day.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    record = f"struct({', '.join(rest)})"
    slots = df.groupBy(key, order).agg(F.expr(f"max({record}) AS last_record"), F.expr("count(*) AS sharing"))
    # Always true. It keeps the count in the plan of both uses, which then share one aggregation.
    slots = slots.where("sharing > 0")
    last = _lead(slots, key, order, out, day).select(key, order, "last_record.*", out)
    tied = _tied_rows(df, slots, key, order, record).withColumn(out, F.col(order))
    columns = [*df.columns, out]
    return last.select(*columns).unionByName(tied.select(*columns))


def _lead(slots: DataFrame, key: str, order: str, out: str, day: str | None) -> DataFrame:
    if day is None:
        return slots.selectExpr("*", f"lead({order}) OVER (PARTITION BY {key} ORDER BY {order}) AS {out}")
    slots = slots.withColumn("slot_day", F.col(f"last_record.{day}"))
    days = (
        slots.groupBy(F.col(key).alias("day_key"), F.col("slot_day").alias("day_of"))
        .agg(F.min(order).alias("first_order"))
        .selectExpr(
            "day_key", "day_of", "lead(first_order) OVER (PARTITION BY day_key ORDER BY day_of) AS next_day_order"
        )
    )
    in_day = f"lead({order}) OVER (PARTITION BY {key}, slot_day ORDER BY {order}) AS in_day_order"
    return (
        slots.selectExpr("*", in_day)
        .join(days, F.expr(f"{key} <=> day_key AND slot_day <=> day_of"), "left")
        .selectExpr("*", f"coalesce(in_day_order, next_day_order) AS {out}")
    )


def _tied_rows(df: DataFrame, slots: DataFrame, key: str, order: str, record: str) -> DataFrame:
    """Rows that another row of the same (key, order) follows. Usually none."""
    shared = slots.where("sharing > 1").selectExpr(f"{key} AS tied_key", f"{order} AS tied_order", "last_record")
    return repeat_rows(
        df.join(shared, F.expr(f"{key} <=> tied_key AND {order} <=> tied_order"))
        .selectExpr(*df.columns, f"{record} <=> last_record AS is_last")
        .groupBy(*df.columns, "is_last")
        .agg(F.expr("count(*) - if(is_last, 1, 0) AS copies"))
        .where("copies > 0")
        .drop("is_last"),
        "copies",
    )


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times; a large count is spread over many tasks."""
    columns = [c for c in df.columns if c != copies]
    step = _COPIES_PER_TASK_ROW
    return (
        df.selectExpr("*", f"explode(sequence(0, ({copies} - 1) div {step})) AS slice")
        .selectExpr(*columns, "slice", f"CAST(least({copies} - slice * {step}, {step}) AS int) AS here")
        .repartition(*columns, "slice")
        .selectExpr(*columns, "explode(sequence(1, here)) AS copy")
        .select(*columns)
    )
