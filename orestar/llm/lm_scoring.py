"""Language-model scores by context-tree weighting over bytes, and by word frequencies beside it.

A text is modelled as its lower-cased words with one space between them and an
end mark. What the model says of a byte depends on the ``DEPTH`` bytes before it
alone, so a text's probability is a product over its strings of ``DEPTH`` + 1
bytes ("grams"), and all work on the corpus is counting grams:

1. Texts are gathered into chunks of bounded size. A chunk lists its distinct
   grams and words with their counts in the training texts, dealt into buckets by
   a hash; there is a bucket for so many bytes of corpus.
2. Counts meet by bucket. Grams with the same three nearest bytes are the
   subtrees below these in all context trees; a task climbs many of them at once.
3. The roots of the subtrees are the leaves of 255 small trees, one for each way
   a byte can have begun; each is climbed as one group of at most 2^24 rows.
4. The price of each gram and of each word goes back to the chunks that list it,
   and a chunk's texts are scored from its own price list.

So nothing is broadcast and no task sees the whole model, which grows with the
corpus. See ``context_trees`` for the model.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestar.llm.context_trees import BITS, Climb
from orestar.llm.words import bytes_of, sized_slices, words_of
from orestar.workspace import materialise

# Bytes of context. The nearest three are climbed apart from the others.
DEPTH = 5
NEAR = 3
# Bytes of a chunk, a longer text being one of its own; bytes
# whose grams are sorted at a time; grams whose trees are climbed at a time; bytes
# of corpus for each bucket.
CHUNK_BYTES = 32 << 20
WINDOW = 1 << 20
CLIMBED = 200_000
BUCKET_BYTES = 64 << 20
# Texts handed to Python at a time.
BATCH_TEXTS = "1000"
END = 0x0A
# Fixed values of the word model: the added count, and the texts kept aside.
ADDED = 0.1
FOLDS = 10


def is_held_out(doc_id: object) -> bool:
    """A tenth of the ids, by their checksum; a text without an id is learned from."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def grams(texts: pa.Array, depth: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(gram, text) for every byte of the texts and their end marks, a window at a time.

    A gram holds the bytes before, nearest first, and the byte itself last. Before
    a text there are end marks.
    """
    data, offsets = bytes_of(texts)
    sizes = np.diff(offsets) + depth + 1
    ends = np.cumsum(sizes)
    begins = ends - sizes
    line = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint8)
    for begin, a, b in zip(begins + depth, offsets[:-1], offsets[1:]):
        line[begin : begin + b - a] = data[a:b]
    for low in range(0, len(line), WINDOW):
        high = min(low + WINDOW, len(line))
        owner = np.repeat(np.arange(len(ends)), np.diff(np.clip(ends, low, high), prepend=low))
        at = np.arange(low, high)
        inside = at - begins[owner] >= depth
        at, owner = at[inside], owner[inside]
        # The window with what comes before it.
        part = line[max(low - depth, 0) : high].astype(np.uint64)
        at = at - max(low - depth, 0)
        code = np.zeros(len(at), np.uint64)
        for back in range(1, depth + 1):
            code = (code << np.uint64(8)) | part[at - back]
        yield (code << np.uint64(8)) | part[at], owner


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted; faster than a hash table where most keys repeat."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(which, np.concatenate(counts), len(key)).astype(np.int64)


def _bucket_of_grams(gram: np.ndarray, buckets: int) -> np.ndarray:
    mixed = gram * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(8)) % np.uint64(buckets)


class _Chunk:
    """Texts gathered so far, with the counts of their grams and words in training texts."""

    def __init__(self, depth: int, buckets: int):
        self.depth, self.buckets = depth, buckets
        self.texts: list[pa.Table] = []
        self.grams: list[np.ndarray] = []
        self.gram_counts: list[np.ndarray] = []
        self.words: list[pa.Table] = []
        self.bytes = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        held = np.array([is_held_out(i) for i in ids.to_pylist()], bool)
        words = words_of(texts)
        joined = words.joined(np.arange(words.first[-1]), words.per_text)
        self.texts.append(pa.table({"id": ids, "held": pa.array(held), "text": joined}))
        self.bytes += pc.sum(pc.binary_length(joined)).as_py() or 0
        for code, owner in grams(joined, self.depth):
            key, count = np.unique((code << np.uint64(1)) | held[owner], return_counts=True)
            # Held-out grams are listed, and count nothing.
            self.grams.append(key >> np.uint64(1))
            self.gram_counts.append(np.where(key & np.uint64(1), 0, count))
        found = words.each.dictionary_encode()
        learned = np.repeat(~held, words.per_text)
        counts = np.bincount(found.indices.to_numpy(), learned, len(found.dictionary)).astype(np.int64)
        # The empty word is the end of a text.
        self.words.append(pa.table({"word": found.dictionary, "n": counts}))
        self.words.append(pa.table({"word": pa.array([b""]), "n": [int((~held).sum())]}))
        if len(self.grams) > 8:
            self._merge()

    def _merge(self) -> None:
        self.grams, self.gram_counts = ([x] for x in _summed(self.grams, self.gram_counts))
        words = pa.concat_tables(self.words).group_by("word").aggregate([("n", "sum")])
        self.words = [words.rename_columns({"n_sum": "n"}).select(["word", "n"])]

    def rows_out(self, number: int) -> Iterator[pa.RecordBatch]:
        for part in pa.concat_tables(self.texts).combine_chunks().to_batches(max_chunksize=int(BATCH_TEXTS)):
            yield _counted(number, 1, texts=pa.array([_packed_table(part)]))
        self._merge()
        gram, n = self.grams[0], self.gram_counts[0]
        yield self._dealt(number, _bucket_of_grams(gram, self.buckets), n, lambda of: _packed(np.diff(gram[of], prepend=gram.dtype.type(0))), "grams")
        word, n = self.words[0]["word"].combine_chunks(), self.words[0]["n"].to_numpy()
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, word.to_pylist()), np.uint64, len(word))
        yield self._dealt(number, hashed % np.uint64(self.buckets), n, lambda of: b" ".join(word.take(pa.array(of)).to_pylist()), "words")

    def _dealt(self, number: int, bucket: np.ndarray, n: np.ndarray, packed, name: str) -> pa.RecordBatch:
        order = np.argsort(bucket, kind="stable")
        used, begins = np.unique(bucket[order], return_index=True)
        parts = np.split(order, begins[1:])
        lists = pa.array([packed(of) for of in parts], pa.binary())
        counts = pa.array([_packed(n[of]) for of in parts], pa.binary())
        return _counted(number, len(used), bucket=pa.array(used.astype(np.int64)), counts=counts, **{name: lists})


_COUNTED = "chunk bigint, texts binary, bucket bigint, grams binary, words binary, counts binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Small numbers in few bytes once compressed: first the lowest byte of each, then the next."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(packed: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed.as_buffer(), np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _packed_table(part: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(part)
    return sink.getvalue().to_pybytes()


def _counted(number: int, size: int, **given: pa.Array) -> pa.RecordBatch:
    kinds = {"texts": pa.binary(), "bucket": pa.int64()} | dict.fromkeys(("grams", "words", "counts"), pa.binary())
    columns = [given.get(name, pa.nulls(size, kind)) for name, kind in kinds.items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(size, number)), *columns], names=["chunk", *kinds])


def _count(depth: int, buckets: int):
    """Texts as they will be scored, and each chunk's lists; chunks are numbered by task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, chunk = TaskContext.get().partitionId() << 32, _Chunk(depth, buckets)
        for batch in batches:
            for part in sized_slices(batch, "text", WINDOW):
                if chunk.bytes >= CHUNK_BYTES:
                    yield from chunk.rows_out(number)
                    number, chunk = number + 1, _Chunk(depth, buckets)
                chunk.add(part.column("id"), part.column("text"))
        if chunk.texts:
            yield from chunk.rows_out(number)

    return count


def _sum_grams(lists: pa.Table) -> pa.Table:
    """A bucket's distinct grams with their counts in all chunks."""
    grams_listed = [np.cumsum(_unpacked(x)) for x in lists["grams"]]
    gram, n = _summed(grams_listed, [_unpacked(x) for x in lists["counts"]])
    return pa.table({"bucket": np.full(len(gram), lists["bucket"][0].as_py()), "gram": gram.astype(np.int64), "n": n})


def _word_counts(lists: pa.Table) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words listed in a bucket, as codes, and the counts of the different ones in all chunks."""
    code = pa.array([w for x in lists["words"] for w in x.as_py().split(b" ")], pa.binary()).dictionary_encode()
    n = np.concatenate([_unpacked(x) for x in lists["counts"]])
    return code, np.bincount(code.indices.to_numpy(), n, len(code.dictionary)).astype(np.int64)


def _sum_words(lists: pa.Table) -> pa.Table:
    """A bucket's training tokens, and how many of them are different."""
    _, counts = _word_counts(lists)
    return pa.table({"tokens": [int(counts.sum())], "distinct": [int((counts > 0).sum())]})


def _return_words(lists: pa.Table) -> pa.Table:
    """For each chunk's list the counts of its words in all chunks."""
    code, counts = _word_counts(lists)
    sizes = [x.as_py().count(b" ") + 1 for x in lists["words"]]
    parts = np.split(counts[code.indices.to_numpy()], np.cumsum(sizes)[:-1])
    nothing = pa.nulls(len(lists), pa.binary())
    counts = pa.array([_packed(n) for n in parts], pa.binary())
    return pa.table({"chunk": lists["chunk"], "bucket": lists["bucket"], "words": lists["words"], "counts": counts, "prices": nothing})


def _price_grams(lists: pa.Table, priced: pa.Table) -> pa.Table:
    """For each chunk's list the prices of its grams, which the chunk knows itself."""
    gram = priced["gram"].to_numpy().astype(np.uint64)
    order = np.argsort(gram)
    gram, price = gram[order], priced["price"].to_numpy()[order]
    parts = [price[np.searchsorted(gram, np.cumsum(_unpacked(x)))].tobytes() for x in lists["grams"]]
    nothing = pa.nulls(len(lists), pa.binary())
    return pa.table({"chunk": lists["chunk"], "bucket": lists["bucket"], "words": nothing, "counts": nothing, "prices": pa.array(parts, pa.binary())})


_PRICED = "chunk bigint, bucket bigint, words binary, counts binary, prices binary"


def _by_near(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Sorted (gram, n, bucket) of whole groups of the nearest bytes, ``CLIMBED`` rows or one group at a time."""
    shift = np.uint64(8 * (depth + 1 - NEAR))
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        gram, n, bucket = (batch.column(c).to_numpy() for c in ("gram", "n", "bucket"))
        held.append((gram.astype(np.uint64), n.astype(np.float64), bucket))
        rows += batch.num_rows
        if rows >= CLIMBED:
            columns = [np.concatenate(x) for x in zip(*held)]
            cut = np.searchsorted(columns[0] >> shift, columns[0][-1] >> shift)
            if cut:
                yield tuple(c[:cut] for c in columns)
            held, rows = [tuple(c[cut:] for c in columns)], rows - cut
    if rows:
        yield tuple(np.concatenate(x) for x in zip(*held))


_CLIMBED = "near bigint, bucket bigint, gram bigint, p array<double>, node int, zeros double, ones double, weighted double"


def _climb_far(depth: int):
    """Subtrees below the nearest bytes: mixed predictions of each gram's eight bits there, and the subtrees' roots."""
    far = 8 * (depth - NEAR)

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n, bucket in _by_near(batches, depth):
            byte, rest = gram & np.uint64(0xFF), (gram >> np.uint64(8)) & np.uint64((1 << far) - 1)
            near = gram >> np.uint64(8 + far)
            p = np.empty((len(gram), BITS))
            for j in range(BITS):
                node = np.uint64(1 << j) | (byte >> np.uint64(BITS - j))
                bit = (byte >> np.uint64(BITS - 1 - j)) & np.uint64(1)
                tree = Climb.from_leaves((((near << np.uint64(8)) | node) << np.uint64(far)) | rest, n, bit.astype(np.float64)).up(far)
                p[:, j] = tree.fixed
                yield _climbed(
                    near=tree.key >> np.uint64(8), node=(tree.key & np.uint64(0xFF)).astype(np.int32),
                    zeros=tree.zeros, ones=tree.ones, weighted=tree.log_weighted,
                )
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(gram) + 1) * BITS, pa.int32()), pa.array(p.ravel()))
            yield _climbed(near=near, bucket=bucket, gram=gram.astype(np.int64), p=lists)

    return climb


def _climbed(**given) -> pa.RecordBatch:
    kinds = dict.fromkeys(("near", "bucket", "gram"), pa.int64()) | {"p": pa.list_(pa.float64()), "node": pa.int32()}
    kinds |= dict.fromkeys(("zeros", "ones", "weighted"), pa.float64())
    size = len(given["near"])
    given["near"] = given["near"].astype(np.int64)
    columns = [pa.array(given[c], kinds[c]) if isinstance(given.get(c), np.ndarray) else given.get(c, pa.nulls(size, kinds[c])) for c in kinds]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


def _climb_near(roots: pa.Table) -> pa.Table:
    """One tree over the nearest bytes: what a prediction below becomes on the way to the tree's root."""
    near = roots["near"].to_numpy().astype(np.uint64)
    order = np.argsort(near)
    zeros, ones, weighted = (roots[c].to_numpy()[order] for c in ("zeros", "ones", "weighted"))
    size = len(near)
    tree = Climb(near[order], zeros, ones, weighted, np.arange(size), np.zeros(size), np.ones(size)).up(8 * NEAR)
    return pa.table({"near": pa.array(near[order].astype(np.int64)), "node": roots["node"], "fixed": tree.fixed, "share": tree.share})


def prices(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(bucket, gram, price): the log10 probability of each gram's byte after the others, from (bucket, gram, n)."""
    near = F.shiftright("gram", 8 * (depth + 1 - NEAR))
    grouped = counts.withColumn("near", near).repartition("near").sortWithinPartitions("gram").select("gram", "n", "bucket")
    climbed = materialise(grouped.mapInArrow(_climb_far(depth), _CLIMBED), "lm_trees")
    roots = climbed.where("node IS NOT NULL").select("near", "node", "zeros", "ones", "weighted")
    tops = roots.groupBy("node").applyInArrow(_climb_near, "near bigint, node int, fixed double, share double")
    # At most 255 entries.
    tops = tops.groupBy("near").agg(F.map_from_entries(F.collect_list(F.struct("node", F.struct("fixed", "share")))).alias("top"))
    met = climbed.where("gram IS NOT NULL").select("near", "bucket", "gram", "p").join(tops, "near")
    byte = "CAST(gram & 255 AS int)"
    nodes = f"transform(sequence(0, {BITS - 1}), j -> top[shiftleft(1, j) | shiftright({byte}, {BITS} - j)])"
    chance = f"transform(tops, (t, j) -> if(shiftright({byte}, {BITS - 1} - j) & 1 = 1, t.fixed + t.share * p[j], 1 - t.fixed - t.share * p[j]))"
    met = met.withColumn("tops", F.expr(nodes)).select("bucket", "gram", F.expr(chance).alias("chance"))
    return met.select("bucket", "gram", F.expr("aggregate(chance, 0D, (s, x) -> s + log10(x))").alias("price"))


_SCORED = "id bigint, held boolean, n_tokens bigint, n_known bigint, base double, score double"


def _score_chunk(depth: int, buckets: int, tokens: int, distinct: int):
    """Scores of a chunk's texts from the prices of the grams and words it lists."""

    def score(packed: pa.Table, listed: pa.Table) -> pa.Table:
        of_words = listed.filter(pc.is_valid(listed["words"]))
        of_grams = listed.filter(pc.is_null(listed["words"])).sort_by("bucket")
        # The texts are gone through twice, so that a window is all that is held.
        listing = [np.empty(0, np.uint64)]
        for texts in _opened(packed):
            for part in _slices(texts["text"]):
                listing += [_distinct(code) for code, _ in grams(part, depth)]
                if len(listing) > 8:
                    listing = [_distinct(np.concatenate(listing))]
        gram = _distinct(np.concatenate(listing))
        price = np.empty(len(gram))
        order = np.argsort(_bucket_of_grams(gram, buckets), kind="stable")
        price[order] = np.concatenate([np.frombuffer(x.as_buffer(), np.float64) for x in of_grams["prices"]])
        names = pa.array([w for x in of_words["words"] for w in x.as_py().split(b" ")], pa.binary())
        n = np.concatenate([_unpacked(x) for x in of_words["counts"]]).astype(np.int64)
        worth, seen = np.log10((n + ADDED) / (tokens + ADDED * (distinct + 1))), n > 0
        end = pc.index(names, pa.scalar(b"", pa.binary())).as_py()
        found = []
        for texts in _opened(packed):
            sums = []
            for part in _slices(texts["text"]):
                words = words_of(part)
                code = pc.index_in(words.each, names).to_numpy() if len(words.each) else np.empty(0, np.int64)
                owner = np.repeat(np.arange(len(part)), words.per_text)
                known = np.bincount(owner, seen[code], len(part)).astype(np.int64) + int(seen[end])
                base = np.bincount(owner, worth[code], len(part)) + worth[end]
                sums.append((words.per_text + 1, known, base, _gram_scores(part, gram, price, depth)))
            columns = dict(zip(("n_tokens", "n_known", "base", "score"), map(np.concatenate, zip(*sums))))
            found.append(pa.table({"id": texts["id"], "held": texts["held"], **columns}))
        return pa.concat_tables(found)

    return score


def _opened(packed: pa.Table) -> Iterator[pa.RecordBatch]:
    for x in packed["texts"]:
        yield from pa.ipc.open_stream(x.as_buffer())


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    for part in sized_slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", WINDOW):
        yield part.column("text")


def _gram_scores(texts: pa.Array, gram: np.ndarray, price: np.ndarray, depth: int) -> np.ndarray:
    """Sums of the prices of each text's grams; at most 65,536 texts."""
    total = np.zeros(len(texts))
    for code, owner in grams(texts, depth):
        both, count = np.unique((code << np.uint64(16)) | owner.astype(np.uint64), return_counts=True)
        code = both >> np.uint64(16)
        new = np.ones(len(code), bool)
        new[1:] = code[1:] != code[:-1]
        value = price[np.searchsorted(gram, code[new])][np.cumsum(new) - 1]
        total += np.bincount((both & np.uint64(0xFFFF)).astype(np.int64), count * value, len(texts))
    return total


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``score`` is the log10 probability the context-tree model gives the text's
    tokens, ``bits_per_byte`` its code length; ``base_score`` is that of a model
    of word frequencies with 0.1 added to each count. Both learn from all texts
    but a tenth, chosen by id. Tokens are the words, A-Z lower-cased and parted by
    white space of any kind and length, and one end.

    A null or empty text is one end. A row without an id is learned from. Repeated
    rows are learned from and scored each on their own. If nothing is learned from,
    every bit has probability a half. Ids must fit a bigint. Other columns are
    ignored.
    """
    if not NEAR <= depth <= DEPTH:
        raise ValueError(f"a depth of {NEAR} to {DEPTH} bytes")
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_TEXTS)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    buckets = max(size // BUCKET_BYTES + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counted = materialise(rows.mapInArrow(_count(depth, buckets), _COUNTED), "lm_counted")
    of_grams = counted.where("grams IS NOT NULL").select("chunk", "bucket", "grams", "counts")
    own_grams = of_grams.select("chunk", "bucket", "grams")
    of_words = counted.where("words IS NOT NULL").select("chunk", "bucket", "words", "counts")
    priced = prices(of_grams.groupBy("bucket").applyInArrow(_sum_grams, "bucket bigint, gram bigint, n bigint"), depth)
    per_bucket = of_words.groupBy("bucket").applyInArrow(_sum_words, "tokens bigint, distinct bigint")
    tokens, distinct = per_bucket.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    priced = priced.withColumnRenamed("bucket", "of_bucket")
    listed = own_grams.groupBy("bucket").cogroup(priced.groupBy("of_bucket")).applyInArrow(_price_grams, _PRICED)
    listed = listed.unionAll(of_words.groupBy("bucket").applyInArrow(_return_words, _PRICED))
    texts = counted.where("texts IS NOT NULL").select(F.col("chunk").alias("of_chunk"), "texts")
    scored = texts.groupBy("of_chunk").cogroup(listed.groupBy("chunk")).applyInArrow(_score_chunk(depth, buckets, tokens, distinct), _SCORED)
    return scored.select(
        F.col("id").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
