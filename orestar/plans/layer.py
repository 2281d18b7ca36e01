"""A named set of tables, each defined when first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Layer(Mapping[str, DataFrame]):
    def __init__(self, definitions: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._definitions = definitions
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = self._definitions[table]()
        return self._tables[table]

    def replaced(self, **tables: DataFrame) -> Layer:
        """The same set with some tables given, such as stored copies."""
        return Layer({name: lambda name=name: tables[name] if name in tables else self[name] for name in self})

    def __iter__(self) -> Iterator[str]:
        return iter(self._definitions)

    def __len__(self) -> int:
        return len(self._definitions)
