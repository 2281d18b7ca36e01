"""Sums and exact distinct counts for several sets of columns from one pass over a table.

The rows are stored once, with what the sets, the sums and the counts need. Sums: rows
that agree in the columns of a few sets become one cell, inside the tasks already; only
cells are multiplied, once per set. Counts: the values of a set, found with its sums, are
numbered, and a counted value keeps one bit per value it occurs with. A task so sends one
row of masks per counted value, whatever the number of sets, and masks that are alike are
counted before their bits are told apart. A set of very many values is counted by its
distinct pairs instead. Every step reduces inside its tasks before it shuffles, so neither
a value nor a counted value with most rows gathers them in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orestar.operators.quality import union_all
from orestar.workspace import materialise

# A set of more values has no masks: it is counted by distinct pairs.
MOST_MASKED = 1024
_BITS = 64


def grouped_sets(
    df: DataFrame,
    sets: Mapping[str, Sequence[str]],
    counted: str,
    sums: Mapping[str, str],
    count_in: Sequence[str],
    together: Sequence[Sequence[str]] = (),
    most_masked: int = MOST_MASKED,
) -> DataFrame:
    """One row per set and its values: ``grouped_by``, all columns of the sets, ``n_counted`` and the sums.

    ``sums`` are named expressions over ``df``; ``n_counted`` is the number of
    distinct non-NULL values of the column ``counted``, 0 outside the sets named in
    ``count_in``. Columns outside a row's set are NULL, and so are values that are:
    ``grouped_by`` tells them apart. A table without rows gives none. The names of the
    sets' columns, of ``counted`` and of the sums must differ.

    ``together`` deals the sets into those that share cells; by default all do. Sets
    whose columns depend on one another belong together, as they have few cells.
    """
    if len({(frozenset(own), name in count_in) for name, own in sets.items()}) < len(sets):
        raise ValueError("two sets have the same columns")
    together = together or [list(sets)]
    if sorted(name for names in together for name in names) != sorted(sets):
        raise ValueError("every set belongs to one group of sets")
    columns = list(dict.fromkeys(column for own in sets.values() for column in own))
    rows = materialise(df.select(*columns, counted, *[F.expr(value).alias(name) for name, value in sums.items()]), "grouped_rows")
    found = union_all([_summed(rows, {name: sets[name] for name in names}, columns, list(sums)) for names in together])
    own_sets = {name: own for name, own in sets.items() if name in count_in}
    sizes = {row.grouped_by: row["count"] for row in found.groupBy("grouped_by").count().collect()}
    masked = {name: own for name, own in own_sets.items() if 0 < sizes.get(name, 0) <= most_masked}
    paired = {name: own for name, own in own_sets.items() if sizes.get(name, 0) > most_masked}
    counts = [_pairs_counted(rows, name, own, columns, counted) for name, own in paired.items()]
    if masked:
        counts.append(_masks_counted(rows, found, masked, sizes, columns, counted))
    if not counts:
        return found.selectExpr("grouped_by", *columns, "0L AS n_counted", *sums)
    known = union_all(counts).withColumnsRenamed({name: f"of_{name}" for name in ("grouped_by", *columns)})
    alike = " AND ".join(f"{name} <=> of_{name}" for name in ("grouped_by", *columns))
    return found.join(known, F.expr(alike), "left").selectExpr(
        "grouped_by", *columns, "coalesce(n_counted, 0L) AS n_counted", *sums
    )


def _summed(rows: DataFrame, sets: Mapping[str, Sequence[str]], columns: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """A row per set and value with its sums."""
    used = [column for column in columns if any(column in own for own in sets.values())]
    totals = [F.expr(f"sum({name}) AS {name}") for name in sums]
    # The constant lets a set without columns group, too.
    cells = materialise(rows.groupBy(F.lit(True).alias("every_row"), *used).agg(*totals), "grouped_cells")
    keys = ["every_row", *used]
    # The bit of a column is set if it is left out; the last column has the lowest.
    names: dict[int, list[str]] = {}
    for name, own in sets.items():
        names.setdefault(sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in own), []).append(name)
    asked = [[F.col(key) for key in sets[alike[0]]] for alike in names.values()]
    apart = cells.groupingSets(asked, *[F.col(key) for key in keys]).agg(*totals, F.expr("grouping_id() AS set_bits"))
    named = " ".join(f"WHEN {bits} THEN array({', '.join(f"'{name}'" for name in alike)})" for bits, alike in names.items())
    values = [c if c in used else f"CAST(NULL AS {rows.schema[c].dataType.simpleString()}) AS {c}" for c in columns]
    return apart.selectExpr(f"explode(CASE set_bits {named} END) AS grouped_by", *values, *sums)


def _pairs_counted(rows: DataFrame, name: str, own: Sequence[str], columns: Sequence[str], counted: str) -> DataFrame:
    """Counts of one set, whatever the number of its values."""
    pairs = rows.where(f"{counted} IS NOT NULL").select(*own, counted).distinct()
    values = [c if c in own else f"CAST(NULL AS {rows.schema[c].dataType.simpleString()}) AS {c}" for c in columns]
    return pairs.groupBy(*own).agg(F.expr("count(*) AS n_counted")).selectExpr(f"'{name}' AS grouped_by", *values, "n_counted")


def _masks_counted(
    rows: DataFrame, found: DataFrame, sets: Mapping[str, Sequence[str]], sizes: Mapping[str, int], columns: Sequence[str], counted: str
) -> DataFrame:
    """Counts of sets of few values, from a mask of values per counted value."""
    own_rows = found.where(F.col("grouped_by").isin(*sets)).select("grouped_by", *columns)
    number = F.row_number().over(Window.partitionBy("grouped_by").orderBy(*columns)) - 1
    values = materialise(own_rows.withColumn("code", number), "grouped_values")
    marked = rows.where(f"{counted} IS NOT NULL").select(*columns, counted)
    masks, first_word = [], {}
    for i, (name, own) in enumerate(sets.items()):
        first_word[name] = len(masks)
        code = f"code_{i}"
        told = values.where(F.col("grouped_by") == name).select(*[F.col(c).alias(f"told_{c}") for c in own], F.col("code").alias(code))
        if own:
            alike = F.expr(" AND ".join(f"{c} <=> told_{c}" for c in own))
            marked = marked.join(F.broadcast(told), alike).drop(*[f"told_{c}" for c in own])
        else:
            marked = marked.withColumn(code, F.lit(0))
        for word in range(-(-sizes[name] // _BITS)):
            bit = f"if({code} DIV {_BITS} = {word}, shiftleft(1L, {code} % {_BITS}), 0L)"
            masks.append(F.expr(f"bit_or({bit}) AS mask_{len(masks)}"))
    words = ", ".join(f"struct({word} AS word, mask_{word} AS mask)" for word in range(len(masks)))
    held = marked.groupBy(counted).agg(*masks).selectExpr(f"inline(array({words}))").where("mask <> 0")
    held = held.groupBy("word", "mask").agg(F.expr("count(*) AS n"))
    bits = held.selectExpr("word", f"explode(filter(sequence(0, {_BITS - 1}), b -> getbit(mask, b) = 1)) AS bit", "n")
    bits = bits.groupBy("word", "bit").agg(F.expr("sum(n) AS n_counted"))
    starts = " ".join(f"WHEN '{name}' THEN {word}" for name, word in first_word.items())
    placed = values.selectExpr("*", f"CAST(CASE grouped_by {starts} END + code DIV {_BITS} AS int) AS word", f"code % {_BITS} AS bit")
    return placed.join(bits, ["word", "bit"]).select("grouped_by", *columns, "n_counted")
