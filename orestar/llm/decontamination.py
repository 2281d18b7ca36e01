"""Benchmark passages in documents: a prefix-filtered containment join.

A benchmark item becomes windows of ``WINDOW`` consecutive words. A window is a
set of word shingles that a document has to contain whole, so its prefix under
the rarity order is one shingle: the one with the fewest occurrences in the
corpus. A first pass over the texts only counts the benchmark's shingles, by
their hashes; a second joins each window's prefix alone. A match fixes where the
window would start; length and position bounds and then the words that stand
there decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestar.llm.text import ascii_lower, present, row_digest, same
from orestar.workspace import materialise

WINDOW = 10
SHINGLE = 3
# The benchmark's shingles are sent to every executor up to this size; beyond it
# the join shuffles, after a sieve of at most SIEVE rows.
BROADCAST_BYTES = 32 << 20
SIEVE = 1 << 20
# Fixed value: what separates words.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of ASCII letters, digits and characters beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(present(text)), WORD_GAP), "")


def _windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct windows with the items that have them: window (its words with spaces), words, items."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
    return (
        items.where("item IS NOT NULL AND size(words) > 0")
        .withColumn("len", F.expr(f"least({WINDOW}, size(words))"))
        .withColumn("start", F.expr("explode(sequence(1, size(words) - len + 1))"))
        .selectExpr("item", "slice(words, start, len) AS words")
        .groupBy(F.array_join("words", " ").alias("window"), "words")
        .agg(F.collect_set("item").alias("items"))
    )


def _fits(df: DataFrame, limit: int) -> bool:
    """Whether the rows of ``df`` stay below ``limit`` bytes in memory."""
    per_row = F.octet_length(F.to_json(F.struct(*df.columns))) + 64
    return (df.select(F.sum(per_row).alias("bytes")).first().bytes or 0) <= limit


def _key_at(width: int) -> Column:
    """Hash of the shingle that begins at ``pos``; null past the end."""
    parts = [F.expr(f"get(words, pos + {i})") for i in range(width)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(*parts))


def _window_shingles(windows: DataFrame) -> DataFrame:
    """Every shingle of every window: window, len, width, offset, known_key (the hash of its words)."""
    placed = windows.select(
        "window", "words", F.size("words").alias("len"), F.least(F.lit(SHINGLE), F.size("words")).alias("width")
    ).withColumn("pos", F.expr("explode(sequence(0, len - width))"))
    key = F.coalesce(*(F.when(F.col("width") == x, _key_at(x)) for x in range(1, SHINGLE + 1)))
    return placed.select("window", "len", "width", F.col("pos").alias("offset"), key.alias("known_key"))


def _places(docs: DataFrame, widths: list[int]) -> DataFrame:
    """The shingle hashes of every place in a document; position n_words is past the last word and stands for itself."""
    own = ["doc_id", "digest", "n_words", "words"]
    at = docs.select(*own, F.explode(F.expr("sequence(0, n_words)")).alias("pos"))
    if len(widths) == 1:
        return at.withColumn("key", _key_at(widths[0]))
    keys = F.array(*(F.struct(_key_at(x).alias("key")) for x in widths))
    return at.select(*own, "pos", F.inline(F.when(F.col("pos") == F.col("n_words"), F.slice(keys, 1, 1)).otherwise(keys)))


def _sieved(places: DataFrame, keys: DataFrame) -> DataFrame:
    """``places`` without most that have none of the keys; at most ``SIEVE`` rows are broadcast, whatever the keys."""
    holes = keys.select(F.pmod("known_key", F.lit(SIEVE)).alias("hole")).distinct()
    return places.where("key IS NOT NULL").join(F.broadcast(holes), F.pmod("key", F.lit(SIEVE)) == F.col("hole"), "left_semi")


def _prefixes(docs: DataFrame, shingles: DataFrame, widths: list[int], broadcast_bytes: int) -> DataFrame:
    """The rarest shingle of each window, of those of which the corpus holds all: window, len, offset, known_key."""
    known = materialise(shingles.select("known_key").distinct(), "benchmark_shingles")
    keys = _places(docs, widths).select("key")
    if _fits(known, broadcast_bytes):
        met = keys.join(F.broadcast(known), keys["key"] == known["known_key"])
        counts = met.groupBy("known_key").agg(F.count(F.lit(1)).alias("n"))
    else:
        # Counted inside the tasks before anything meets.
        all_counts = _sieved(keys, known).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        counts = all_counts.join(known, all_counts["key"] == known["known_key"]).select("known_key", "n")
    # A window with a shingle that occurs nowhere is left out by the count.
    rarest = (
        shingles.join(counts, "known_key", "left")
        .groupBy("window", "len")
        .agg(F.min(F.struct("n", "offset", "known_key")).alias("rarest"), F.count(F.lit(1)).alias("needed"), F.count("n").alias("seen"))
        .where("needed = seen")
    )
    return rarest.select("window", "len", "rarest.offset", "rarest.known_key")


def _occurrences(docs: DataFrame, prefixes: DataFrame, widths: list[int], broadcast_bytes: int) -> DataFrame:
    """One row per document (window null), and one per place ``start`` where a window occurs in it."""
    own = ["doc_id", "digest", "n_words"]
    start = F.col("pos") - F.col("offset")
    inside = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    there = F.expr("array_join(slice(words, greatest(start, 0) + 1, len), ' ') = window")
    places = _places(docs, widths)
    if _fits(prefixes, broadcast_bytes):
        met = places.join(F.broadcast(prefixes), places["key"] == prefixes["known_key"], "left").withColumn("start", start)
        return met.where((F.col("pos") == F.col("n_words")) | F.coalesce(inside & there, F.lit(False))).select(*own, "start", "window")
    met = _sieved(places.select(*own, "pos", "key"), prefixes).join(prefixes, F.col("key") == F.col("known_key"))
    candidates = met.where(inside).select(
        F.col("doc_id").alias("met_id"), F.col("digest").alias("met_digest"), start.alias("start"), "len", "window"
    ).distinct()
    # The words are read from the candidate documents once more.
    confirmed = docs.join(
        candidates, same(docs["doc_id"], candidates["met_id"]) & (docs["digest"] == candidates["met_digest"])
    ).where(there)
    documents = docs.select(*own, F.lit(None).cast("int").alias("start"), F.lit(None).cast("string").alias("window"))
    return confirmed.select(*own, "start", "window").unionAll(documents)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies inside an occurrence of a window. The corpus counts
    that order the shingles, the search and the check all cover whole texts,
    which are read once to count and once to search. The shingles of the
    benchmark are broadcast if they are measured to fit, and shuffled otherwise;
    both ways give the same rows.

    Null and empty texts have no words and are clean. Items without words, or
    without an id, match nothing; items of one text are all counted. Repeated
    rows each get a row, null ids are kept, other columns are ignored.
    """
    prepared = docs.select(
        F.col(id_col).alias("doc_id"), row_digest(F.col(text_col)).alias("digest"), words_of(F.col(text_col)).alias("words")
    ).withColumn("n_words", F.size("words"))
    windows = materialise(_windows(benchmark, item_col, item_text_col), "windows")
    shingles = materialise(_window_shingles(windows), "window_shingles")
    widths = sorted(r.width for r in shingles.select("width").distinct().collect()) or [SHINGLE]
    prefixes = materialise(_prefixes(prepared, shingles, widths, broadcast_bytes), "rarest")
    met = materialise(_occurrences(prepared, prefixes, widths, broadcast_bytes), "occurrences")
    found = met.where("window IS NOT NULL").select("doc_id", "digest", "start", "window").distinct()
    hits = (
        found.join(windows, "window")
        .groupBy("doc_id", "digest")
        .agg(
            F.array_sort(F.collect_set(F.struct("start", F.size("words").alias("len")))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        # Spans sorted by start: each adds what lies beyond the furthest end so far.
        .withColumn(
            "hit",
            F.expr(
                "aggregate(spans, struct(0 AS upto, 0L AS n), (s, x) -> struct(greatest(s.upto, x.start + x.len) AS upto,"
                " s.n + greatest(0, x.start + x.len - greatest(s.upto, x.start)) AS n), s -> s.n)"
            ),
        )
        .select(F.col("doc_id").alias("hit_id"), F.col("digest").alias("hit_digest"), "hit", "items")
    )
    documents = met.where("window IS NULL").select("doc_id", "digest", F.col("n_words").cast("long").alias("n_words"))
    met_hits = documents.join(hits, same(documents["doc_id"], hits["hit_id"]) & (documents["digest"] == hits["hit_digest"]), "left")
    n_hit = F.coalesce("hit", F.lit(0).cast("long"))
    return met_hits.select(
        "doc_id",
        "digest",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.array_size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of a benchmark item."""
    dirty = contamination(docs, benchmark, id_col, text_col).where("contaminated")
    dirty = dirty.select(F.col("doc_id").alias("dirty_id"), F.col("digest").alias("dirty_digest"))
    return docs.join(
        dirty, same(docs[id_col], dirty["dirty_id"]) & (row_digest(docs[text_col]) == dirty["dirty_digest"]), "left_anti"
    )
