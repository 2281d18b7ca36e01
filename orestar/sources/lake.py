"""The stored layers: one catalog database per layer, Parquet tables inside."""

from __future__ import annotations

import json
import time
from threading import Lock
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINTERS = "_tables"
_POINTER_SCHEMA = "layer string, table string, path string, schema string, written bigint"


class Lake:
    """Full-refresh tables below ``root``.

    Every refresh writes a new folder and only then points the table at it, so
    readers see the old rows or the new ones, a failed load changes nothing,
    and a table may be refreshed from itself. Which folder is current is also
    appended to a small table of pointers below ``root``, from which another
    process registers the tables: no metastore is needed between jobs.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self._one_pointer = Lock()

    def restore(self) -> None:
        """Register the tables that earlier jobs left below ``root``."""
        try:
            pointers = self.spark.read.schema(_POINTER_SCHEMA).json(f"{self.root}/{_POINTERS}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        newest = pointers.groupBy("layer", "table").agg(F.expr("max(struct(written, path, schema)) AS at"))
        for row in newest.collect():  # one row per table
            self._register(row.layer, row.table, row.at.path, T.StructType.fromJson(json.loads(row.at.schema)))

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def fresh_folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}/{uuid4().hex}"

    def overwrite(self, df: DataFrame, layer: str, table: str, cluster: tuple[str, ...] = ()) -> int:
        """Refresh a table and return its row count, taken while writing.

        With ``cluster`` the rows are sorted by these columns over the whole
        table, so a filter on the first of them skips most files.
        """
        path = self.fresh_folder(layer, table)
        loaded = Observation()
        # Counted after the sort, which reads its input twice.
        rows = df.repartitionByRange(*cluster).sortWithinPartitions(*cluster) if cluster else df
        rows.observe(loaded, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        self.point(layer, table, path, df.schema)
        return loaded.get.get("rows", 0)

    def append(self, df: DataFrame, layer: str, table: str) -> None:
        path = f"{self.root}/{layer}/{table}"
        df.write.mode("append").parquet(path)
        if not self.exists(layer, table):
            self.point(layer, table, path, df.schema)
        self.spark.catalog.refreshTable(self.name(layer, table))

    def point(self, layer: str, table: str, path: str, schema: T.StructType) -> None:
        """Make ``path`` the table's folder, for this process and for later ones."""
        self._register(layer, table, path, schema)
        row = (layer, table, path, schema.json(), time.time_ns())
        with self._one_pointer:
            pointer = self.spark.createDataFrame([row], _POINTER_SCHEMA).coalesce(1)
            pointer.write.mode("append").json(f"{self.root}/{_POINTERS}")

    def _register(self, layer: str, table: str, path: str, schema: T.StructType) -> None:
        spark, name = self.spark, self.name(layer, table)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} LOCATION {_quoted(f'{self.root}/{layer}')}")
        columns = [(f.name, f.dataType.simpleString()) for f in schema.fields]
        if self.exists(layer, table) and spark.table(name).dtypes == columns:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
        spark.catalog.refreshTable(name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
