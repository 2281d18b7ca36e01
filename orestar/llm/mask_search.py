"""The best documents of each query, by groups of documents that hold the same of its terms.

Documents are searched in blocks. In a block every query term has a bitmap of the
documents that hold it. The bitmaps of a query's terms, put side by side, give
each document a presence mask, and documents of equal masks form a group. What a
group can score at most is the sum over its mask of each term's weight times the
largest share any document of the block gets from it. Groups are scored exactly
in the order of that bound, until the next one lies below the k-th best score:
no document of it or of a later one can be among the best.

Every block hands on its own best documents for each query, k at most, and the
best of these are the answer. Documents are tokenised once; what is stored of
each is its length and how often it holds each query term. Queries are taken in
batches of bounded size, so their number is not bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orestar.llm.words import NO_TERM, sized_slices, words_of
from orestar.workspace import materialise

TOP = 10
# Bytes of text tokenised at a time, and documents searched as one block.
SLICE = 8 << 20
BLOCK = 20_000
# Characters of queries handled in one pass over the documents; a longer query
# is a batch of its own.
BATCH_CHARS = 4 << 20
# Fixed values of the score.
SATURATION = 1_000_000_000
LENGTH_SHARE = 90


def _numbered(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_no, item_id, text, batch): queries in batches of bounded length."""
    kept = queries.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kept = kept.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("item_no"))
    kept = materialise(kept.withColumn("size", F.length("text")), "search_items")
    # Characters before each query: those of earlier parts, one row per part, and those before it in its own.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = kept.groupBy("part").agg(F.sum("size").alias("size"))
    parts = parts.select(F.col("part").alias("of_part"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before_part"))
    within = Window.partitionBy("part").orderBy("item_no").rowsBetween(Window.unboundedPreceding, -1)
    sized = kept.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = sized.join(parts, F.col("part") == F.col("of_part"))
    return materialise(placed.selectExpr("item_no", "item_id", "text", f"(before_part + before) DIV {BATCH_CHARS} AS batch"), "search_batches")


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of each text, and where those of each begin."""
    words = words_of(texts, NO_TERM)
    return words.each, words.first


def postings(docs: DataFrame, vocabulary: pa.Array, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, n (its terms), terms and tfs (ascending numbers of query terms in it, how often)."""
    kept = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sized_slices(batch, "text", SLICE):
                each, first = _terms(part.column("text"))
                term = pc.fill_null(pc.index_in(each, vocabulary), -1).to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(part.num_rows), np.diff(first))
                known = term >= 0
                pair, tf = np.unique(owner[known] * len(vocabulary) + term[known], return_counts=True)
                begins = np.searchsorted(pair, np.arange(part.num_rows + 1) * len(vocabulary))
                lists = [
                    pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(x, pa.int32()))
                    for x in (pair % len(vocabulary) if len(pair) else pair, tf)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(first), pa.int64()), *lists], names=["id", "n", "terms", "tfs"]
                )

    return kept.mapInArrow(count, "id bigint, n bigint, terms array<int>, tfs array<int>")


class Block:
    """Documents of a block as lists of (document, share of the score) by query term."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, begins: np.ndarray, terms: np.ndarray, tfs: np.ndarray, total: int, words: int, count: int):
        self.ids = ids
        length = 100 - LENGTH_SHARE + LENGTH_SHARE * n * total // max(words, 1)
        owner = np.repeat(np.arange(len(n)), np.diff(begins))
        tf = tfs.astype(np.int64)
        share = SATURATION * tf // (1000 * tf + 8 * length[owner])
        order = np.argsort(terms, kind="stable")
        self.owner, self.share = owner[order], share[order]
        self.at = np.searchsorted(terms[order], np.arange(count + 1))

    def holders(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        of = slice(self.at[term], self.at[term + 1])
        return self.owner[of], self.share[of]

    def masks(self, terms: np.ndarray) -> np.ndarray:
        """A row of 64-bit words per document: bit j is set if it holds the j-th term."""
        mask = np.zeros((len(terms) + 63) // 64 * len(self.ids), np.uint64).reshape(-1, len(self.ids))
        for j, term in enumerate(terms):
            holders, _ = self.holders(term)
            mask[j // 64, holders] |= np.uint64(1 << (j % 64))
        return mask

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) of the ``k`` best documents, by falling score and rising id; only scores above 0."""
        useful = (weights > 0) & (self.at[terms + 1] > self.at[terms])
        terms, weights = terms[useful], weights[useful]
        if not len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        masks = self.masks(terms)
        rows = np.flatnonzero((masks != 0).any(axis=0))
        # Documents by mask: a group for each distinct one.
        order = rows[np.lexsort(masks[:, rows])]
        new = np.ones(len(order), bool)
        new[1:] = (masks[:, order[1:]] != masks[:, order[:-1]]).any(axis=0)
        begins = np.append(np.flatnonzero(new), len(order))
        most = np.array([self.holders(t)[1].max() for t in terms])
        distinct = masks[:, order[begins[:-1]]]
        bound = np.zeros(len(begins) - 1, np.int64)
        for j in range(len(terms)):
            held = (distinct[j // 64] >> np.uint64(j % 64)) & np.uint64(1)
            bound += held.astype(np.int64) * (weights[j] * most[j])
        falling = np.argsort(-bound, kind="stable")
        sizes = np.diff(begins)
        found, scores, done, wave = np.empty(0, np.int64), np.empty(0, np.int64), 0, 4 * k
        score = np.zeros(len(self.ids), np.int64)
        while done < len(falling):
            if len(scores) == k and bound[falling[done]] < scores[-1]:
                break
            # Groups in order, until they hold enough documents for a wave.
            upto = done + 1 + int(np.searchsorted(np.cumsum(sizes[falling[done:]]), wave))
            groups = falling[done:upto]
            if len(scores) == k:
                groups = groups[bound[groups] >= scores[-1]]
            step = np.arange(sizes[groups].sum()) - np.repeat(np.cumsum(sizes[groups]) - sizes[groups], sizes[groups])
            chosen = order[np.repeat(begins[groups], sizes[groups]) + step]
            self._score(score, chosen, terms, weights)
            found, scores = np.append(found, chosen), np.append(scores, score[chosen])
            ranked = np.lexsort((self.ids[found], -scores))[:k]
            found, scores = found[ranked], scores[ranked]
            done, wave = upto, 2 * wave
        return found, scores

    def _score(self, score: np.ndarray, chosen: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        wanted = np.zeros(len(score), bool)
        wanted[chosen] = True
        for term, weight in zip(terms, weights):
            holders, share = self.holders(term)
            of = wanted[holders]
            score[holders[of]] += weight * share[of]


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows of a task, ``most`` at a time."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == most:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _search_batch(items: list, docs: DataFrame, id_col: str, text_col: str, k: int, block: int) -> DataFrame:
    """The best of every block for one batch of queries: item_no, id, score."""
    numbers = [r["item_no"] for r in items]
    each, first = _terms(pa.array([r["text"] for r in items], pa.string()))
    each = each.dictionary_encode() if len(each) else pa.DictionaryArray.from_arrays(pa.array([], pa.int32()), pa.array([], pa.binary()))
    vocabulary, code = each.dictionary, each.indices.to_numpy()
    asked = [np.unique(code[a:b]).astype(np.int64) for a, b in zip(first[:-1], first[1:])]
    held = materialise(postings(docs, vocabulary, id_col, text_col), "search_postings")
    total, words = held.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One count per query term.
    df = np.zeros(len(vocabulary), np.int64)
    for term, count in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = count
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, block):
            if not table.num_rows:
                continue
            ids = table["id"].chunk(0)
            lists, tfs = (table[c].chunk(0) for c in ("terms", "tfs"))
            begins = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            # A document without an id comes after all others.
            order = pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy()
            found = Block(order, table["n"].to_numpy(), begins, lists.flatten().to_numpy(), tfs.flatten().to_numpy(), total, words, len(vocabulary))
            for number, terms in zip(numbers, asked):
                rows, scores = found.best(terms, weights[terms], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(rows), pa.int64()), ids.take(pa.array(rows)), pa.array(scores, pa.int64())],
                    names=["item_no", "id", "score"],
                )

    return held.mapInArrow(search, "item_no bigint, id bigint, score bigint")


def top_documents(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = TOP,
    block: int = BLOCK,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of each query with the highest scores above 0.

    A document's score for a query sums over the query's distinct terms a weight
    that falls with the number of documents holding the term, times a share that
    rises with its occurrences and falls with the document's length; equal scores
    rank by rising id, a document without an id last. All is integer arithmetic
    but the logarithm in the weight.

    A null or empty text has no terms: such a document is never found nor counted,
    such a query finds nothing. Each row is a document or a query of its own, also
    if rows share an id or have none; equal documents under one id may each take a
    rank. Ids must fit a bigint. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = _numbered(queries, item_col, item_text_col)
    found = None
    for (batch,) in items.select("batch").distinct().orderBy("batch").toLocalIterator():
        own = items.where(F.col("batch") == batch).select("item_no", "text").collect()
        best = materialise(_search_batch(own, docs, id_col, text_col, k, block), "search_best")
        found = best if found is None else found.unionAll(best)
    if found is None:
        found = spark.createDataFrame([], "item_no bigint, id bigint, score bigint")
    # At most k rows per block reach a query's ranking.
    ranked = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    named = items.select("item_no", "item_id")
    return found.join(named, "item_no").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
