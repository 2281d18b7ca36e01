"""One row per table load and one per batch: what ran, how long, how many rows, how it ended."""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable
from pathlib import Path
from threading import Lock
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from orestar.sources.lake import Lake

LAYER, TABLE = "ops", "load_runs"
LOADED, FAILED = "LOADED", "FAILED"
_SCHEMA = (
    "batch_id string, layer string, table_name string, rows_loaded bigint, rows_rejected bigint, started_at timestamp,"
    " ended_at timestamp, seconds double, status string, error string, condition string, sqlstate string, step string"
)
_PACKAGE = Path(__file__).parents[1]


class Failure(NamedTuple):
    """What is known of an error: its text, Spark's name and SQLSTATE for it, and where in this package it arose."""

    error: str | None = None
    condition: str | None = None
    sqlstate: str | None = None
    step: str | None = None


def failure_of(error: Exception) -> Failure:
    known = isinstance(error, PySparkException)
    own = [f for f in traceback.extract_tb(error.__traceback__) if _PACKAGE in Path(f.filename).parents]
    step = f"{Path(own[-1].filename).relative_to(_PACKAGE).as_posix()}:{own[-1].lineno} {own[-1].name}" if own else None
    return Failure(
        f"{type(error).__name__}: {error}", error.getCondition() if known else None, error.getSqlState() if known else None, step
    )


class Loaded(NamedTuple):
    """What a load wrote, and what it turned away."""

    rows: int | None = None
    rejected: int | None = None


class RunLog:
    def __init__(self, lake: Lake, batch_id: str) -> None:
        self.lake = lake
        self.batch_id = batch_id
        self._one_writer = Lock()

    def record(self, layer: str, table: str, load: Callable[[], Loaded]) -> Loaded:
        """Run ``load`` and log it. A failure is logged too, and always raised."""
        started = dt.datetime.now(dt.timezone.utc)
        try:
            loaded = load()
        except Exception as error:
            self._append(layer, table, Loaded(), started, FAILED, failure_of(error))
            raise
        self._append(layer, table, loaded, started, LOADED, Failure())
        return loaded

    def _append(
        self, layer: str, table: str, loaded: Loaded, started: dt.datetime, status: str, failure: Failure
    ) -> None:
        ended = dt.datetime.now(dt.timezone.utc)
        seconds = (ended - started).total_seconds()
        row = (self.batch_id, layer, table, loaded.rows, loaded.rejected, started, ended, seconds, status, *failure)
        with self._one_writer:
            self.lake.append(self.lake.spark.createDataFrame([row], _SCHEMA), LAYER, TABLE)

    def entries(self) -> DataFrame:
        log = self.lake.read(LAYER, TABLE)
        return log.where(log.batch_id == self.batch_id)
