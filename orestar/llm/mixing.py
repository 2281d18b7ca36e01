"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are hashed into blocks of their source. A source's target buys whole
passes over its blocks and a part of one more pass, in a permuted block order.
Every (block, pass) is one draw. The draws of all sources are split among output
shards by a binary tree: a node hands its left child a draw, without
replacement, from its own block counts, so counts add up exactly at every node
and shards are as mixed as a random deal. A shard then takes the next draws in
each source's order, which makes its blocks disjoint from every other shard's,
and orders its rows by a hash.

What is gathered in one place is one row per source, one row per shard and
source, and block sums per slice of the hash range; never documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orestar.llm.text import count_words, free_name, row_digest, same
from orestar.operators.surrogate import surrogate_key
from orestar.workspace import materialise

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_WORDS = 1 << 14
BLOCK_ROWS = 1 << 10
SHARD_WORDS = 1 << 22
SEED = 20
# Bits of the hash range that form one slice of a source's block order.
_SLICE_BITS = 8


def _source_key(source: Column) -> Column:
    """The source as a join key that is never null; null sorts last."""
    return F.coalesce(F.concat(F.lit("a"), source.cast("string")), F.lit("b"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """Add ``weight`` and ``target`` to one row per source (key, source_size).

    Weights repeat in the order of the keys. All sizes are shared out by weight;
    a source above ``most_repeats`` times its size keeps that much and the rest
    is shared again, until nobody is above. Each round is one aggregate row.
    """
    ranked = materialise(surrogate_key(sizes, ["key"], "source_rank"), "source_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("source_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * most_repeats)
    total, share, capped = None, 0.0, -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(share)
        row = ranked.select(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)).alias("spent"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open_weight"),
            F.count_if(full).alias("capped"),
        ).first()
        total = row.total
        if row.capped == capped or not row.open_weight:
            break
        capped, share = row.capped, (total - row.spent) / row.open_weight
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(float(share)))
    return ranked.withColumn("target", target).drop("most")


def _split_counts(seed: int) -> str:
    """Counts for the left child: one hypergeometric draw per source, each given the ones before.

    A draw inverts the distribution within 12 standard deviations of its mean,
    beyond which nothing is left in double precision. Its weights follow from
    one another, so they need no factorials.
    """
    u = f"(shiftrightunsigned(xxhash64({seed}L, node, q.source_rank), 11) * {2.0 ** -53!r}D)"
    mean = "(1e0 * s.take * q.n / greatest(s.there, 1L))"
    spread = f"(12 * sqrt({mean} * (1 - 1e0 * q.n / greatest(s.there, 1L))) + 12)"
    low = f"greatest(0L, s.take - (s.there - q.n), CAST(floor({mean} - {spread}) AS bigint))"
    high = f"least(q.n, s.take, CAST(ceil({mean} + {spread}) AS bigint))"
    # The weight of k + 1 over that of k.
    ratio = "((q.n - k) * 1e0 * (s.take - k) / ((k + 1) * 1e0 * (s.there - q.n - s.take + k + 1)))"
    total = f"aggregate(ks, struct(1e0 AS w, 1e0 AS upto), (a, k) -> struct(a.w * {ratio} AS w, a.upto + a.w * {ratio} AS upto), a -> a.upto)"
    pick = (
        "aggregate(ks, struct(1e0 AS w, 1e0 AS upto, b.low AS picked), (a, k) -> struct("
        f"a.w * {ratio} AS w, a.upto + a.w * {ratio} AS upto, if(a.upto < due, k + 1, a.picked) AS picked), a -> a.picked)"
    )
    # A lambda over one element gives a value a name.
    drawn = f"transform(array({u} * {total}), due -> {pick})[0]"
    steps = "if(b.high > b.low, sequence(b.low, b.high - 1), CAST(array() AS array<bigint>))"
    drawn = f"transform(array({steps}), ks -> {drawn})[0]"
    drawn = f"transform(array(struct({low} AS low, {high} AS high)), b -> {drawn})[0]"
    return (
        "aggregate(counts, struct(total AS there, total_left AS take, CAST(array() AS array<bigint>) AS picked),"
        f" (s, q) -> transform(array({drawn}), x -> struct(s.there - q.n AS there, s.take - x AS take,"
        " array_append(s.picked, x) AS picked))[0], s -> s.picked)"
    )


def shard_counts(counts: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Split draws per source (source_rank, n) into ``shards``: rows shard, source_rank, n, first.

    ``first`` is the number of the source's draws that earlier shards took.
    """
    root = counts.agg(F.array_sort(F.collect_list(F.struct("source_rank", F.col("n").cast("long").alias("n")))).alias("counts"))
    nodes = root.selectExpr("1L AS node", "0L AS shard", f"{shards}L AS width", "counts").where("size(counts) > 0")
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        sized = nodes.selectExpr("*", "aggregate(counts, 0L, (a, q) -> a + q.n) AS total").selectExpr(
            "*", "width DIV 2 AS width_left", "CAST(round(1e0 * total * (width DIV 2) / width) AS bigint) AS total_left"
        )
        dealt = sized.withColumn("picked", F.expr(_split_counts(seed)))
        left = "struct(node * 2 AS node, shard, width_left AS width, zip_with(counts, picked, (q, x) -> named_struct('source_rank', q.source_rank, 'n', x)) AS counts)"
        right = "struct(node * 2 + 1 AS node, shard + width_left AS shard, width - width_left AS width, zip_with(counts, picked, (q, x) -> named_struct('source_rank', q.source_rank, 'n', q.n - x)) AS counts)"
        nodes = dealt.selectExpr(f"inline(filter(array({left}, {right}), c -> c.width > 0))")
    rows = nodes.selectExpr("shard", "inline(counts)")
    earlier = Window.partitionBy("source_rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    digest = row_digest(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        _source_key(F.col(source_col)).alias("key"),
        count_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), digest).alias("place"),
    )


def _block_of(place: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(place), blocks)


def _ordered_blocks(placed: DataFrame, seed: int) -> DataFrame:
    """Blocks with the number of blocks and words before them in their source's permuted order."""
    sums = placed.groupBy("key", "block").agg(F.sum("size").alias("words"))
    turn = F.xxhash64(F.lit(seed), "key", "block")
    sums = materialise(
        sums.withColumn("turn", turn).withColumn("slice", F.shiftright("turn", 64 - _SLICE_BITS)), "mix_blocks"
    )
    slices = sums.groupBy("key", "slice").agg(F.sum("words").alias("words_in"), F.count(F.lit(1)).alias("blocks_in"))
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        "key", "slice",
        F.coalesce(F.sum("words_in").over(before), F.lit(0)).alias("words_earlier"),
        F.coalesce(F.sum("blocks_in").over(before), F.lit(0)).alias("blocks_earlier"),
    )
    inside = Window.partitionBy("key", "slice").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.join(slices, ["key", "slice"]).select(
        "key", "block", "words",
        (F.col("words_earlier") + F.coalesce(F.sum("words").over(inside), F.lit(0))).alias("words_before"),
        (F.col("blocks_earlier") + F.count(F.lit(1)).over(inside)).alias("blocks_before"),
    )


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    weights: tuple[int, ...] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The documents by size and block, and one row per block saying which draws take it.

    First: doc_id, key, size, place, block. Second: key, block, source_size,
    target, passes (all its documents are taken so often), whole (all are taken
    once more), chosen (the places of those taken once more), shards (that of
    each draw).
    """
    sized = materialise(_sized(docs, id_col, text_col, source_col, seed), "mix_sizes")
    sizes = sized.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = source_targets(sizes, weights, most_repeats)
    sources = materialise(
        # Blocks are bounded in rows too, for documents of few words or none.
        sources.withColumn("blocks", F.expr(f"1 + source_size DIV {block_words} + rows DIV {BLOCK_ROWS}"))
        .withColumn("passes", F.expr("CAST(if(source_size = 0, 0, floor(target / source_size)) AS bigint)"))
        .withColumn("rest", F.expr("target - passes * source_size")),
        "mix_sources",
    )
    placed = sized.join(sources.select("key", "blocks"), "key").withColumn("block", _block_of(F.col("place"), F.col("blocks")))
    placed = placed.drop("blocks")
    blocks = _ordered_blocks(placed, seed).join(
        sources.select("key", "source_rank", "source_size", "target", "passes", "rest"), "key"
    )
    blocks = blocks.withColumn("left_over", F.col("rest") - F.col("words_before"))
    # In the block in which the last pass ends, documents are taken by falling
    # size as long as they fit. A block holds few documents, whatever the corpus.
    partial = blocks.where("left_over > 0 AND left_over < words").select("key", "block", "left_over")
    chosen = (
        placed.where("size > 0")
        .join(partial, ["key", "block"])
        .groupBy("key", "block", "left_over", "place")
        .agg(F.sum("size").alias("size"))
        .groupBy("key", "block", "left_over")
        .agg(F.array_sort(F.collect_list(F.expr("struct(-size AS less, place)"))).alias("offered"))
        .select(
            "key", "block",
            F.expr(
                "aggregate(offered, struct(left_over AS room, CAST(array() AS array<bigint>) AS chosen), (s, d) ->"
                " if(s.room + d.less >= 0, struct(s.room + d.less AS room, array_append(s.chosen, d.place) AS chosen), s), s -> s.chosen)"
            ).alias("chosen"),
        )
    )
    blocks = blocks.join(chosen, ["key", "block"], "left")
    blocks = blocks.withColumn("whole", F.expr("left_over > 0 AND left_over >= words"))
    blocks = blocks.withColumn("draws", F.expr("passes + if(whole OR size(chosen) > 0, 1, 0)"))
    blocks = materialise(blocks, "mix_plan")
    words = blocks.agg(F.sum(F.expr("passes * words + greatest(0, least(words, left_over))")).alias("words")).first().words
    shards = max(1, math.ceil((words or 0) / shard_words))
    return placed, _with_shards(blocks, shards, seed)


def _with_shards(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """Number each source's draws, pass by pass in block order, and look their shards up."""
    per_source = blocks.groupBy("source_rank").agg(F.sum("draws").alias("n"), F.count(F.lit(1)).alias("width"))
    dealt = shard_counts(per_source.where("n > 0").select("source_rank", "n"), shards, seed)
    owners = dealt.where("n > 0").selectExpr("source_rank", "shard", "explode(sequence(first, first + n - 1)) AS draw")
    draws = (
        blocks.where("draws > 0")
        .join(per_source.select("source_rank", "width"), "source_rank")
        .selectExpr("key", "block", "source_rank", "width", "blocks_before", "explode(sequence(0L, draws - 1)) AS pass")
        # Blocks of the last, partial pass are a prefix of the order, so numbers have no gaps.
        .selectExpr("key", "block", "pass", "source_rank", "pass * width + blocks_before AS draw")
    )
    found = draws.join(owners, ["source_rank", "draw"]).groupBy("key", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pass", "shard"))), lambda d: d.shard).alias("shards")
    )
    dealt_blocks = blocks.join(found, ["key", "block"], "left").select(
        "key", "block", "source_size", "target", "passes", "whole", "chosen", "shards"
    )
    # What meets the documents is planned from here on, without the tree.
    return materialise(dealt_blocks, "mix_shards")


def _copies(placed: DataFrame, blocks: DataFrame) -> DataFrame:
    again = F.expr("if(whole OR coalesce(array_contains(chosen, place), false), 1L, 0L)")
    copies = F.when(F.col("size") == 0, F.lit(0).cast("long")).otherwise(F.col("passes") + again)
    return placed.join(blocks, ["key", "block"]).withColumn("copies", copies)


def mixture(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, shards.

    ``size`` counts words, ``taken`` the words the mix takes with repeats, and
    ``shards`` names the output shard of each copy. Options are those of
    ``plan_mix``. Results depend on ids, texts and sources only.

    Null texts have size 0 and are never taken. A null source is a source of its
    own, last in order. Repeated rows and null ids are rows like any other; rows
    that repeat id and text are taken alike. Other columns are ignored.
    """
    placed, blocks = plan_mix(docs, **options)
    return _copies(placed, blocks).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        F.expr("slice(coalesce(shards, array()), 1, CAST(copies AS int))").alias("shards"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, **options) -> DataFrame:
    """The mix itself: a row per taken copy, with the columns of ``docs``, its shard and its order in the shard.

    New columns: mix_copy, mix_shard, mix_order. Rows sorted by (mix_shard,
    mix_order) are the locally shuffled output.
    """
    placed, blocks = plan_mix(docs, id_col=id_col, text_col=text_col, seed=seed, **options)
    own_id, own_place, shards, copy, shard, order = (
        free_name(docs, n) for n in ("mix_id", "mix_place", "mix_shards", "mix_copy", "mix_shard", "mix_order")
    )
    taken = (
        _copies(placed, blocks)
        .where("copies > 0")
        .select(
            F.col("doc_id").alias(own_id), F.col("place").alias(own_place), F.expr("slice(shards, 1, CAST(copies AS int))").alias(shards)
        )
        # Rows that repeat id and text are taken alike; the table has them once.
        .dropDuplicates([own_id, own_place])
    )
    # Texts are moved by a query of one join, which the driver holds beside nothing else.
    taken = materialise(taken, "mix_taken")
    place = F.xxhash64(F.lit(seed), docs[id_col], row_digest(docs[text_col]))
    rows = docs.join(taken, same(docs[id_col], taken[own_id]) & (place == taken[own_place]))
    dealt = rows.select(*(docs[c] for c in docs.columns), own_place, F.posexplode(shards).alias(copy, shard))
    return dealt.withColumn(order, F.xxhash64(F.lit(seed), own_place, copy)).drop(own_place)
