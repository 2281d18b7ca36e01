"""The shared folder in which jobs keep intermediate tables.

An intermediate table written here outlives any executor, which is why the
package cuts lineage this way and never with executor-local storage.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="orestar-")
    return _local_roots[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid4().hex}"


# On a local disk Hadoop starts a process (chmod) for each file and folder it
# makes. These tables go without checksum files, which are as many again, and
# without a mark of success, which nobody waits for. Parquet's own checksums
# of the pages are compared on reading instead, in any store.
_WRITING = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
    "parquet.page.write-checksum.enabled": "true",
}
_READING = {"parquet.page.verify-checksum.enabled": "true"}

_kept_in_block: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables that were written inside the block, by any thread, when it ends."""
    paths: list[str] = []
    _kept_in_block.append(paths)
    try:
        yield
    finally:
        _kept_in_block.remove(paths)
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in paths:
            folder = hadoop.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so every later use sees the same rows.

    The copy on disk also gives the optimizer true sizes for its join choices.
    """
    path = fresh_path(df.sparkSession, label)
    for paths in _kept_in_block:
        paths.append(path)
    df.write.options(**_WRITING).parquet(path)
    return df.sparkSession.read.schema(df.schema).options(**_READING).parquet(path)
