"""Mixing: exact counts in the tree, targets by water filling, disjoint draws."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from statistics import mean

import pytest
from odd_documents import documents, no_docs, odd_docs, odd_rows, prepared  # noqa: F401
from orestar.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fill(sizes):
    """Targets by sharing again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        spent = sum(3 * sizes[s] for s in capped)
        rest = sum(weight[s] for s in order if s not in capped)
        share = {s: 3 * sizes[s] if s in capped else (total - spent) * weight[s] / rest for s in order}
        above = {s for s in order if share[s] > 3 * sizes[s]}
        if not above:
            return share
        capped |= above


def check(rows, found, near):
    sizes, taken, target = Counter(), Counter(), {}
    sources = defaultdict(set)
    for doc_id, text, _, source in rows:
        sizes[source] += size_of(text)
        sources[doc_id, size_of(text)].add(source)
    for r in found:
        assert r.size == size_of(next(t for i, t, *_ in rows if i == r.doc_id and size_of(t) == r.size))
        (source,) = sources[r.doc_id, r.size]
        assert r.source_size == sizes[source]
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        assert len(r.shards) * r.size == r.taken
        taken[source] += r.taken
        target[source] = r.target
    for source, share in fill(sizes).items():
        assert target[source] == pytest.approx(share)
        assert abs(taken[source] - share) <= near(source)


def test_odd_rows(odd_docs, odd_rows):
    found = mixing.mixture(odd_docs)
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken", "shards"]
    longest = defaultdict(int)
    for _, text, _, source in odd_rows:
        longest[source] = max(longest[source], size_of(text))
    # No closer than documents allow.
    check(odd_rows, found.collect(), longest.__getitem__)


def test_many_documents_come_near_their_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), "en", f"s{min(i % 9, 5)}") for i in range(1500)]
    rows += [(5000, "w " * 40, "en", "tiny")]
    found = mixing.mixture(documents(spark, rows), block_words=500, shard_words=3000).collect()
    check(rows, found, lambda s: 40 if s == "tiny" else 25)
    again = mixing.mixture(documents(spark, rows[::-1]).repartition(5), block_words=500, shard_words=3000).collect()
    assert sorted(again) == sorted(found)
    assert len({s for r in found for s in r.shards}) == 13


def test_shards_get_exact_and_hypergeometric_counts(spark):
    counts = {1: 100, 2: 37, 3: 900}
    table = spark.createDataFrame([*counts.items()], "source_rank int, n int")
    rows = mixing.shard_counts(table, 7).collect()
    for source, n in counts.items():
        own = sorted((r.shard, r.first, r.n) for r in rows if r.source_rank == source)
        assert sum(n for _, _, n in own) == n
        assert [first for _, first, _ in own] == [sum(n for _, _, n in own[:i]) for i in range(7)]
    per_shard = Counter()
    for r in rows:
        per_shard[r.shard] += r.n
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    drawn = [
        next(r.n for r in mixing.shard_counts(table, 2, seed).collect() if r.shard == 0 and r.source_rank == 1) for seed in range(40)
    ]
    # Half of the 1037 draws: mean 50, standard deviation 4.7.
    assert abs(mean(drawn) - 50) < 3 and 2 < max(abs(x - 50) for x in drawn) < 20


def test_mixed_documents_are_the_taken_copies(odd_docs):
    plan = Counter()
    for r in mixing.mixture(odd_docs).collect():
        plan[r.doc_id] += len(r.shards)
    mixed = mixing.mixed_documents(odd_docs.withColumnRenamed("score", "mix_copy"))
    assert mixed.columns[-3:] == ["_mix_copy", "mix_shard", "mix_order"]
    assert Counter(r.doc_id for r in mixed.collect()) == +plan


def test_empty_table(no_docs):
    assert mixing.mixture(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0


def test_texts_are_moved_by_one_join(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), "en", f"s{i % 5}") for i in range(300)]
    plan = mixing.mixed_documents(documents(spark, rows), block_words=500, shard_words=700)._jdf.queryExecution().executedPlan().toString()
    # Neither the tree over the shards nor the plan of the mix is left in it, however many shards there are.
    assert len(re.findall(r"\w*Join", plan)) == 1 and plan.count("Generate") == 1 and "Aggregate" not in plan
