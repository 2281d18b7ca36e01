"""Declarative data-quality checks: many rules, one pass over each table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASS, WARN, FAIL, INFO = "PASS", "WARN", "FAIL", "INFO"


@dataclass(frozen=True)
class Check:
    """One metric of one check.

    ``rule`` is the SQL predicate a faulty row satisfies; without one the
    metric is the number of rows looked at. ``within`` limits the rows the
    metric sees. ``null_when_empty`` keeps the SQL habit of a conditional sum,
    which is NULL rather than 0 over no rows.
    """

    check_id: str
    metric: str
    rule: str | None = None
    severity: str = WARN
    within: str = "true"
    null_when_empty: bool = False

    def aggregate(self) -> str:
        rule = self.rule or "true"
        if self.null_when_empty:
            return f"sum(CASE WHEN {self.within} THEN if({rule}, 1, 0) END)"
        return f"count_if(({self.within}) AND ({rule}))"


def _result(check_id: str, table: str, metric: str, value: str, severity: str) -> str:
    status = f"'{INFO}'" if severity == INFO else f"if(coalesce({value}, 0) = 0, '{PASS}', '{severity}')"
    return (
        f"struct('{check_id}' AS check_id, '{table}' AS table_name, '{metric}' AS metric,"
        f" CAST({value} AS bigint) AS value, {status} AS status)"
    )


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All metrics of ``checks`` from a single aggregation, one row each.

    Columns: check_id, table_name, metric, value, status.
    """
    counted = df.selectExpr(*[f"{check.aggregate()} AS m{i}" for i, check in enumerate(checks)])
    results = [
        _result(check.check_id, table, check.metric, f"m{i}", check.severity if check.rule else INFO)
        for i, check in enumerate(checks)
    ]
    return counted.selectExpr(f"inline(array({', '.join(results)}))")


def result_rows(one_row: DataFrame, metrics: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """Columns of a one-row aggregate as results: (check_id, table, metric, column, severity) of each."""
    results = [_result(check_id, table, metric, column, severity) for check_id, table, metric, column, severity in metrics]
    return one_row.selectExpr(f"inline(array({', '.join(results)}))")


def metric_rows(one_row: DataFrame, check_id: str, table: str, severity: str = WARN) -> DataFrame:
    """The columns of a one-row aggregate as check results."""
    return result_rows(one_row, [(check_id, table, name, name, severity) for name in one_row.columns])


def value_counts(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """(label, value, row_count) of several columns in one pass; ``labels`` maps column to label."""
    pairs = [f"struct('{label}' AS label, {column} AS value)" for column, label in labels.items()]
    listed = df.selectExpr(f"inline(array({', '.join(pairs)}))")
    return listed.groupBy("label", "value").agg(F.expr("count(*) AS row_count"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """One union of all; paired up, so that no plan is analysed once per frame."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).unionByName(union_all(frames[middle:]))
