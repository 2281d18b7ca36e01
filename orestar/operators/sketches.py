"""Distinct counts that can be added up: sketches per cell, united for any group of cells.

An exact distinct count of a group has to see the group's rows again, as counts of
parts do not add up. A HyperLogLog sketch of a cell has a fixed size, and sketches
unite without loss: the sketch of a year is the union of those of its months, the
same as if the year had been sketched. So cells are sketched once, in the pass
that sums them, and stored; every coarser count is a query over cells.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Binary logarithm of a sketch's buckets: 4 KB a sketch at most, 1.6 % standard error.
PRECISION = 12


def standard_error(precision: int = PRECISION) -> float:
    """Of an estimate, relative to the exact count: that of united sketches, which is the larger one."""
    return 1.04 / math.sqrt(1 << precision)


def sketch_cells(
    df: DataFrame, by: Sequence[str], distinct: Mapping[str, str], sums: Mapping[str, str] | None = None, precision: int = PRECISION
) -> DataFrame:
    """One row per cell: the columns of ``by``, a sketch per entry of ``distinct`` and a sum per entry of ``sums``.

    Entries map the name of a column to the expression that is counted or summed.
    NULL is not counted, as in ``count(DISTINCT)``. Each task sketches what it
    reads of a cell; only sketches and sums are shuffled.
    """
    sketches = [F.hll_sketch_agg(F.expr(f"CAST({value} AS string)"), precision).alias(name) for name, value in distinct.items()]
    return df.groupBy(*by).agg(*sketches, *[F.expr(f"sum({value}) AS {name}") for name, value in (sums or {}).items()])


def united_counts(cells: DataFrame, by: Sequence[str], distinct: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct counts and exact sums of groups of cells; of all cells if ``by`` is empty."""
    counts = [F.expr(f"coalesce(hll_sketch_estimate(hll_union_agg({name})), 0) AS {name}") for name in distinct]
    return cells.groupBy(*by).agg(*counts, *[F.expr(f"sum({name}) AS {name}") for name in sums])


def within_error(estimate: str, exact: str, deviations: int = 4, precision: int = PRECISION) -> str:
    """Whether an estimate lies as near to the exact count as its stated error says; small counts to one."""
    return f"abs({estimate} - {exact}) <= greatest(1, {deviations * standard_error(precision)} * {exact})"
