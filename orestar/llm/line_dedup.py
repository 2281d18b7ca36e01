"""Lines that repeat across documents, against a store of levelled sorted runs of line hashes.

The store is append-only. A batch of documents reduces its lines to distinct
hashes, anti-joins the runs one after the other, keeps what is left as a new run
and drops every line some earlier document holds. Runs are bucketed and sorted
by hash, so the chain of anti-joins merges them in place without shuffling the
store. When a level holds ``fanout`` runs they are compacted into one run of the
next level, so the number of runs grows with the logarithm of the batches.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestar.llm.text import SPACE_CHARS, ascii_lower, present, row_digest, same
from orestar.workspace import fresh_path

MIN_KEY = 10
BATCHES = 4
FANOUT = 3


def lines_of(text: Column) -> Column:
    return F.split(present(text), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(SPACE_CHARS)))


def line_hash(key: Column) -> Column:
    """128 bits of a SHA-256 digest."""
    return F.unhex(F.substring(F.sha2(key, 256), 1, 32))


class LineStore:
    """Sorted runs of line hashes, grouped in levels."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark = spark
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self._name = f"line_runs_{uuid4().hex}"
        self._runs = 0

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        """A run as a bucketed table, and the folder it lies in."""
        table, path = f"{self._name}_{self._runs}", fresh_path(self.spark, "line_run")
        self._runs += 1
        (
            rows.repartition(self.buckets, "hash")
            .sortWithinPartitions("hash")
            .write.bucketBy(self.buckets, "hash")
            .sortBy("hash")
            .option("path", path)
            .saveAsTable(table)
        )
        return table, path

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of (doc_id, hash) rows; returns its new hashes with the smallest id that holds each.

        Ids of a batch must not be smaller than those of earlier batches.
        """
        fresh = lines.groupBy("hash").agg(F.min("doc_id").alias("keeper"))
        for run in self.runs():
            fresh = fresh.join(self.spark.table(run).select("hash"), "hash", "left_anti")
        table, path = self._write(fresh)
        self.levels[0].append(table)
        self._compact()
        # Read as plain files: a hot hash among the occurrences can then be split.
        return self.spark.read.schema(fresh.schema).parquet(path)

    def _compact(self) -> None:
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) < self.fanout:
                return
            merged = [self.spark.table(run).select("hash") for run in self.levels[depth]]
            whole = merged[0]
            for run in merged[1:]:
                whole = whole.unionAll(run)
            table, _ = self._write(whole)
            if depth + 1 == len(self.levels):
                self.levels.append([])
            self.levels[depth + 1].append(table)
            for run in self.levels[depth]:
                self.spark.sql(f"DROP TABLE {run}")
            self.levels[depth] = []

    def close(self) -> None:
        """Forget the catalog entries; the files stay in the shared folder."""
        for run in self.runs():
            self.spark.sql(f"DROP TABLE {run}")
        self.levels = [[]]


def _occurrences(docs: DataFrame, id_col: str, text_col: str, min_key: int) -> DataFrame:
    """Every line long enough to be compared: doc_id, digest, pos, hash."""
    return (
        docs.select(
            F.col(id_col).alias("doc_id"),
            row_digest(F.col(text_col)).alias("digest"),
            F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"),
        )
        .select("doc_id", "digest", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_key)
        .select("doc_id", "digest", "pos", line_hash(F.col("key")).alias("hash"))
    )


def _batch_number(docs: DataFrame, id_col: str, batches: int) -> Column:
    """Batches by rising id, about equally large; null ids come last."""
    at = F.percentile_approx(id_col, [i / batches for i in range(1, batches)], 1000)
    bounds = (docs.select(at.alias("bounds")).first().bounds if batches > 1 else None) or []
    bounds = sorted(set(bounds))
    number = F.lit(0)
    for bound in bounds:
        number = number + F.when(F.col("doc_id").isNull() | (F.col("doc_id") > bound), 1).otherwise(0)
    return number


def _dropped_lines(docs: DataFrame, id_col: str, text_col: str, min_key: int, batches: int, fanout: int) -> DataFrame:
    """Positions to drop: doc_id, digest, pos."""
    spark = docs.sparkSession
    all_lines = fresh_path(spark, "lines")
    occurrences = _occurrences(docs, id_col, text_col, min_key)
    id_type = occurrences.schema["doc_id"].dataType.simpleString()
    batch = _batch_number(docs, id_col, batches)
    occurrences.withColumn("batch", batch).write.partitionBy("batch").parquet(all_lines)
    # Told apart by folder, so a batch reads its own lines only.
    lines = spark.read.schema(f"doc_id {id_type}, digest bigint, pos int, hash binary, batch int").parquet(all_lines)
    store = LineStore(spark, fanout)
    dropped = fresh_path(spark, "dropped_lines")
    for number in range(batches):
        own = lines.where(F.col("batch") == number).drop("batch")
        fresh = store.add(own.select("doc_id", "hash")).withColumn("is_new", F.lit(True))
        judged = own.join(fresh, "hash", "left")
        elsewhere = F.col("is_new").isNull() | ~same(F.col("doc_id"), F.col("keeper"))
        judged.where(elsewhere).select("doc_id", "digest", "pos").write.mode("append").parquet(dropped)
    store.close()
    return spark.read.schema(f"doc_id {id_type}, digest bigint, pos int").parquet(dropped)


def deduplicate_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_key: int = MIN_KEY,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_text.

    A line is compared by its key: stripped of white space at both ends, A-Z
    lower-cased. Keys of ``min_key`` code points or more that several documents
    hold stay in the document with the smallest id, with all their lines there.

    Null and empty texts are one empty line. Rows that share an id are one
    document when counting holders, and each gets a result row. A null id counts
    as the largest. Ids are numbers: others stop the query. Other columns are ignored.
    """
    drops = (
        _dropped_lines(docs, id_col, text_col, min_key, batches, fanout)
        .groupBy("doc_id", "digest")
        .agg(F.collect_set("pos").alias("gone"))
        .withColumnsRenamed({"doc_id": "drop_id", "digest": "drop_digest"})
    )
    texts = docs.select(
        F.col(id_col).alias("doc_id"), row_digest(F.col(text_col)).alias("digest"), present(F.col(text_col)).alias("body")
    )
    met = texts.join(drops, same(texts["doc_id"], drops["drop_id"]) & (texts["digest"] == drops["drop_digest"]), "left")
    split = met.withColumn("lines", F.split("body", "\n"))
    left = "array_except(sequence(0, size(lines) - 1), gone)"
    kept = F.when(F.col("gone").isNull(), F.col("body")).otherwise(
        F.array_join(F.transform(F.expr(left), lambda i: F.get("lines", i)), "\n")
    )
    return split.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.array_size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )
