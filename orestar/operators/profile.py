"""All that is asked of the values of a table, from one reading of it.

Predicate checks count over all rows, value lists count per value of a column.
Both are grouping sets of one aggregation: the empty set and a set for each listed
column. Rows are multiplied by the number of sets inside a task only; what is
shuffled is one row per value and task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestar.operators.quality import INFO, Check, result_rows, union_all
from orestar.workspace import materialise


@dataclass(frozen=True)
class Listing:
    """A list of a column's values as results: the metric is ``prefix`` and the value, its value the rows or 1."""

    check_id: str
    column: str
    prefix: str = ""
    counted: bool = True


@dataclass(frozen=True)
class Profile:
    """What is asked of one table."""

    checks: Sequence[Check] = ()
    listings: Sequence[Listing] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(listing.column for listing in self.listings))


def profile(df: DataFrame, table: str, wanted: Profile) -> DataFrame:
    """(table_name, place, value, row_count, metrics) from one pass.

    ``place`` is the number of the listed column, or -1 for the row of the whole
    table, which holds a number per check. A table without rows gives no row.
    """
    columns = wanted.columns
    metrics = ", ".join(f"CAST({check.aggregate()} AS bigint)" for check in wanted.checks)
    told = [F.expr("count(*) AS row_count"), F.expr(f"CAST(array({metrics}) AS array<bigint>) AS metrics")]
    named = df.selectExpr("*", *[f"CAST({column} AS string) AS listed_{i}" for i, column in enumerate(columns)])
    keys = [f"listed_{i}" for i in range(len(columns))]
    if not keys:
        return named.agg(*told).selectExpr(f"'{table}' AS table_name", "-1 AS place", "CAST(NULL AS string) AS value", "row_count", "metrics")
    by = [F.col(key) for key in keys]
    counted = named.groupingSets([[], *[[key] for key in by]], *by).agg(*told, F.expr("grouping_id() AS gid"))
    # In the set of a column all others are left out, which their bits say.
    whole = (1 << len(keys)) - 1
    at = [f"WHEN {whole - (1 << (len(keys) - 1 - i))} THEN" for i in range(len(keys))]
    place = " ".join(f"{when} {i}" for i, when in enumerate(at))
    value = " ".join(f"{when} {key}" for when, key in zip(at, keys))
    return counted.selectExpr(
        f"'{table}' AS table_name", f"CASE gid {place} ELSE -1 END AS place", f"CASE gid {value} END AS value", "row_count",
        f"if(gid = {whole}, metrics, NULL) AS metrics",
    )


def profile_results(tables: Mapping[str, DataFrame], wanted: Mapping[str, Profile]) -> DataFrame:
    """The checks and listings of all tables as results, each table read once."""
    found = materialise(union_all([profile(tables[name], name, asked) for name, asked in wanted.items()]), "profiles")
    return union_all([_check_results(found, wanted), *_listing_results(found, wanted)])


def _check_results(found: DataFrame, wanted: Mapping[str, Profile]) -> DataFrame:
    checked = {name: asked for name, asked in wanted.items() if asked.checks}
    if not checked:
        return found.selectExpr("inline(CAST(array() AS array<struct<check_id: string, table_name: string, metric: string, value: bigint, status: string>>))")
    arrays = [f"max(if(table_name = '{name}' AND place = -1, metrics, NULL)) AS t{i}" for i, name in enumerate(checked)]
    one_row = found.selectExpr(*arrays)
    metrics, columns = [], []
    for i, (name, asked) in enumerate(checked.items()):
        for j, check in enumerate(asked.checks):
            # Without rows a conditional sum is NULL, a count 0.
            column = f"t{i}[{j}]" if check.null_when_empty else f"coalesce(t{i}[{j}], 0)"
            columns.append(f"{column} AS m{len(columns)}")
            metrics.append((check.check_id, name, check.metric, f"m{len(metrics)}", check.severity if check.rule else INFO))
    return result_rows(one_row.selectExpr(*columns), metrics)


def _listing_results(found: DataFrame, wanted: Mapping[str, Profile]) -> list[DataFrame]:
    lists = []
    for name, asked in wanted.items():
        for place, column in enumerate(asked.columns):
            rows = [
                f"struct('{x.check_id}' AS check_id, '{name}' AS table_name, concat('{x.prefix}', coalesce(value, 'NULL')) AS metric,"
                f" CAST({'row_count' if x.counted else 1} AS bigint) AS value, '{INFO}' AS status)"
                for x in asked.listings
                if x.column == column
            ]
            lists.append(f"WHEN table_name = '{name}' AND place = {place} THEN array({', '.join(rows)})")
    return [found.selectExpr(f"inline(CASE {' '.join(lists)} END)")] if lists else []
