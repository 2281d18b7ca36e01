"""Intermediate tables: what is written for them, and what a spoiled one does."""

from __future__ import annotations

from pathlib import Path

import pytest

from orestar.workspace import materialise


def test_intermediate_tables_are_their_rows_only(spark):
    """Each further file is a process more, which Hadoop starts to set its mode on a local disk."""
    kept = materialise(spark.range(100, numPartitions=3), "only_rows")
    files = [Path(name.removeprefix("file:")) for name in kept.inputFiles()]
    assert len(files) == 3
    assert sorted(files) == sorted(files[0].parent.iterdir())
    assert kept.count() == 100


def test_an_empty_table_keeps_its_columns(spark):
    kept = materialise(spark.range(0).selectExpr("id", "CAST(id AS string) AS name"), "empty")
    assert kept.columns == ["id", "name"] and kept.collect() == []


def test_a_spoiled_table_is_not_read(spark):
    kept = materialise(spark.range(100_000, numPartitions=1).selectExpr("xxhash64(id) AS h"), "spoiled")
    assert kept.distinct().count() == 100_000
    file = Path(kept.inputFiles()[0].removeprefix("file:"))
    held = bytearray(file.read_bytes())
    held[len(held) // 2] ^= 1
    file.write_bytes(held)
    with pytest.raises(Exception, match="FAILED_READ_FILE|checksum|CRC"):
        kept.selectExpr("sum(h % 1000)").collect()
