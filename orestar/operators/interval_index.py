"""Points in intervals by an equality join, on blocks of doubling size.

A block of level k holds 2^k days that follow one another. An interval is the
disjoint union of two blocks per level at most, and a day lies in one block of
each level. So a day lies in an interval if and only if one block of the day is
one of the interval's, and then exactly one is: the join is on the block alone,
needs no comparison afterwards and gives each pair once. Rows grow with the
logarithm of the time that is spanned, not with the time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def levels(days: str) -> str:
    """The number of the highest level for a calendar of so many days."""
    return f"CAST(floor(log2(greatest({days}, 1))) AS int)"


def covering_blocks(first: str, last: str, top: str) -> str:
    """The blocks (level, block) whose days are those from ``first`` to ``last``; none if last < first.

    Days are numbered from 0. On its level a block next to the left end is taken
    if it is a right half, one next to the right end if it is a left half.
    """
    begin, end = f"shiftright(({first}) + shiftleft(1, level) - 1, level)", f"shiftright(({last}) + 1, level)"
    sides = f"transform(sequence(0, {top}), level -> struct(level AS level, {begin} AS begin, {end} AS stop))"
    taken = (
        "filter(array(struct(s.level AS level, s.begin AS block, s.begin % 2 = 1 AS taken),"
        " struct(s.level AS level, s.stop - 1 AS block, s.stop % 2 = 1 AS taken)), b -> b.taken AND s.begin < s.stop)"
    )
    return f"transform(flatten(transform({sides}, s -> {taken})), b -> struct(b.level AS level, b.block AS block))"


def enclosing_blocks(day: str, top: str) -> str:
    """The block (level, block) of each level that holds ``day``."""
    return f"transform(sequence(0, {top}), level -> struct(level AS level, shiftright({day}, level) AS block))"


def join_in_interval(
    points: DataFrame, intervals: DataFrame, on: list[tuple[str, str]], day: str, first: str, last: str, span: tuple[Column, Column]
) -> DataFrame:
    """Pairs of a point and an interval of the same keys that holds its ``day``; the columns of both.

    ``span`` are the first and the last day of all points; intervals are cut to
    it, which is what bounds an open end. A missing day or first day, or an
    interval that ends before it begins, gives no pair. ``last`` missing means no
    end. Columns of the two sides must differ in name.
    """
    begins, ends = span
    calendar = {"span_begin": begins, "span_days": F.datediff(ends, begins) + 1}
    top = levels("span_days")
    dated = points.where(f"{day} IS NOT NULL").withColumns(calendar)
    looked_up = dated.selectExpr("*", f"inline({enclosing_blocks(f'datediff({day}, span_begin)', top)})").withColumnsRenamed(
        {"level": "point_level", "block": "point_block"}
    )
    cut_first = f"greatest(datediff({first}, span_begin), 0)"
    cut_last = f"least(coalesce(datediff({last}, span_begin), span_days - 1), span_days - 1)"
    covered = intervals.where(f"{first} IS NOT NULL").withColumns(calendar)
    covered = covered.selectExpr("*", f"inline({covering_blocks(cut_first, cut_last, top)})")
    same = " AND ".join(f"{p} = {i}" for p, i in [*on, ("point_level", "level"), ("point_block", "block")])
    met = looked_up.drop("span_begin", "span_days").join(covered.drop("span_begin", "span_days"), F.expr(same))
    return met.drop("point_level", "point_block", "level", "block")
