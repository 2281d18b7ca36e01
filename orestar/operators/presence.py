"""Which tables hold which keys: one grouping for any number of containment checks.

Every table names its keys in a domain and has a bit there. All are stacked and
reduced together, so each table is read once and there is one shuffle, into which
a key goes once per task. What any check between the tables of a domain asks can
be read off a key's mask, NULL keys included, which form a key of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestar.operators.quality import union_all

# Tables of one domain at most: each has a count of rows of its own.
MOST = 4


@dataclass(frozen=True)
class Holder:
    """A table that holds keys: SQL expressions of its keys by domain, with its bit there."""

    rows: DataFrame
    keys: Sequence[tuple[str, int, str]]


def presence(holders: Sequence[Holder]) -> DataFrame:
    """One row per domain and key: domain, key (as text), mask, n0 to n3 (its rows in the table of each bit).

    A table without rows leaves no trace; one that holds NULL keys has its bit in
    the row whose key is NULL. A table of several domains is read once.
    """
    stacked = []
    for holder in holders:
        if any(not 0 <= bit < MOST for _, bit, _ in holder.keys):
            raise ValueError(f"a domain has {MOST} bits")
        named = [f"struct('{domain}' AS domain, CAST({key} AS string) AS key, {bit} AS bit)" for domain, bit, key in holder.keys]
        stacked.append(holder.rows.selectExpr(f"inline(array({', '.join(named)}))"))
    counts = [F.expr(f"count_if(bit = {bit}) AS n{bit}") for bit in range(MOST)]
    return union_all(stacked).groupBy("domain", "key").agg(F.expr("bit_or(shiftleft(1, bit)) AS mask"), *counts)


def has(bit: int) -> str:
    return f"(mask & {1 << bit}) <> 0"


def only_in(bit: int, other: int) -> str:
    """The key is in one table and not in the other; NULL is in no table."""
    return f"({has(bit)} AND (key IS NULL OR NOT {has(other)}))"


def not_in(bit: int, other: str, empty: str, has_null: str) -> str:
    """The key is in the table of ``bit`` and ``NOT IN`` the list whose bit test is ``other``.

    As SQL has it: everything is NOT IN an empty list, nothing is NOT IN a list
    that holds NULL, and NULL is NOT IN no other list.
    """
    return f"({has(bit)} AND ({empty} OR (NOT {has_null} AND key IS NOT NULL AND NOT {other})))"
