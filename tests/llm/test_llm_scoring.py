"""Language-model scores against a context tree in plain Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odd_documents import LOWER, documents, no_docs, odd_docs, odd_rows, prepared  # noqa: F401
from orestar.llm import context_trees, lm_scoring


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]


def learned(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 != 0


def decisions(text, depth):
    """(how the byte begins, bits of context, bit) of every binary decision in the text's tokens and end."""
    line = b"\n" * depth + " ".join(tokens(text)).encode() + b"\n"
    for at in range(depth, len(line)):
        context = "".join(f"{b:08b}" for b in reversed(line[at - depth : at]))
        byte = f"{line[at]:08b}"
        for j in range(8):
            yield byte[:j], context, int(byte[j])


class Tree:
    """Sequential bookkeeping by node: counts of zeros and ones under each context suffix."""

    def __init__(self, depth):
        self.counts, self.depth, self.known = {}, depth, {}

    def learn(self, text):
        for begun, context, bit in decisions(text, self.depth):
            for upto in range(8 * self.depth + 1):
                self.counts.setdefault((begun, context[:upto]), [0, 0])[bit] += 1

    def estimate(self, node):
        zeros, ones = self.counts.get(node, (0, 0))
        return sum(math.lgamma(x + 0.5) for x in (zeros, ones)) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    def weighted(self, begun, context):
        node = (begun, context)
        if node not in self.counts:
            return 0.0
        if node not in self.known:
            own = self.estimate(node)
            if len(context) < 8 * self.depth:
                below = self.weighted(begun, context + "0") + self.weighted(begun, context + "1")
                stop = math.log(context_trees.STOP) + own
                more = math.log(1 - context_trees.STOP) + below
                own = max(stop, more) + math.log1p(math.exp(-abs(stop - more)))
            self.known[node] = own
        return self.known[node]

    def chance_of_one(self, begun, context):
        chance = None
        for upto in range(8 * self.depth, -1, -1):
            zeros, ones = self.counts.get((begun, context[:upto]), (0, 0))
            estimate = (ones + 0.5) / (zeros + ones + 1)
            if chance is None or (begun, context[: upto + 1]) not in self.counts:
                chance = estimate
            else:
                node = (begun, context[:upto])
                stop = math.exp(math.log(context_trees.STOP) + self.estimate(node) - self.weighted(*node))
                chance = stop * estimate + (1 - stop) * chance
        return chance

    def score(self, text):
        total = 0.0
        for begun, context, bit in decisions(text, self.depth):
            one = self.chance_of_one(begun, context)
            total += math.log10(one if bit else 1 - one)
        return total


def brute(rows, depth):
    tree, counts = Tree(depth), Counter()
    for doc_id, text, *_ in rows:
        if learned(doc_id):
            tree.learn(text)
            counts.update([*tokens(text), "\n"])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for doc_id, text, *_ in rows:
        own = [*tokens(text), "\n"]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        out.append((doc_id, not learned(doc_id), len(own), sum(t in counts for t in own), total, base, tree.score(text)))
    return out


def close(found, expected):
    order = lambda rows: sorted(rows, key=lambda r: repr((r[:5], round(r[6], 4))))
    found, expected = order(found), order(expected)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    np.testing.assert_allclose([r[5:] for r in found], [r[5:] for r in expected], rtol=1e-9, atol=1e-9)


def scored(docs, **options):
    found = lm_scoring.language_scores(docs, **options)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return [tuple(r) for r in found.collect()]


@pytest.mark.parametrize("depth", [3, 5])
def test_scores_of_odd_rows(spark, odd_rows, depth):
    # Some ids of both folds; the long texts are left to the next test.
    rows = [r for r in odd_rows if r[0] not in (7, 8)] + [(i, f"beta gammaé {i} delta beta", "en", "s") for i in range(20, 60)]
    assert len({learned(r[0]) for r in rows}) == 2
    close(scored(documents(spark, rows), depth=depth), brute(rows, depth))


def test_a_score_does_not_depend_on_chunks(spark, odd_docs, monkeypatch):
    whole = scored(odd_docs)
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 50)
    monkeypatch.setattr(lm_scoring, "WINDOW", 1000)
    monkeypatch.setattr(lm_scoring, "CLIMBED", 10)
    monkeypatch.setattr(lm_scoring, "BUCKET_BYTES", 3000)
    close(scored(odd_docs.repartition(3)), whole)


def test_chances_of_all_bytes_sum_to_one(spark):
    """Whatever comes before, seen or not."""
    counts = [(int.from_bytes(c[::-1] + bytes([b]), "big"), n) for c, b, n in
              [(b"abc", 100, 5), (b"abc", 101, 1), (b"xbc", 100, 2), (b"\xffqq", 0, 9)]]
    for context in (b"abc", b"zbc", b"zzc", b"\n\n\n"):
        asked = [(int.from_bytes(context[::-1] + bytes([b]), "big"), 0) for b in range(256)]
        grams = spark.createDataFrame(counts + asked, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"), F.lit(0).alias("bucket"))
        found = {r.gram: r.price for r in lm_scoring.prices(grams, 3).collect()}
        assert sum(10 ** found[g] for g, _ in asked) == pytest.approx(1, abs=1e-9)


def test_estimates_of_large_counts():
    for a, b in [(0, 0), (1, 0), (4095, 4096), (10_000, 3), (10**9, 10**6)]:
        expected = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        assert context_trees.log_estimate(np.array([a]), np.array([b]))[0] == pytest.approx(expected, rel=1e-12, abs=1e-9)


def test_grams_across_windows(monkeypatch):
    texts = pa.array([b"ab", b"", b"abcdefgh"])
    whole = [list(zip(c.tolist(), o.tolist())) for c, o in lm_scoring.grams(texts, 3)]
    monkeypatch.setattr(lm_scoring, "WINDOW", 4)
    parts = [list(zip(c.tolist(), o.tolist())) for c, o in lm_scoring.grams(texts, 3)]
    assert sum(parts, []) == sum(whole, [])
    assert [o for _, o in sum(whole, [])] == [0] * 3 + [1] + [2] * 9
    # The second byte of the first text: after "a" and two marks.
    assert whole[0][1][0] == int.from_bytes(b"a\n\nb", "big")


def test_held_out_texts_are_foretold_better_than_by_word_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = lm_scoring.language_scores(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_empty_tables(spark, no_docs):
    assert scored(no_docs) == []
    # Nothing to learn from: eight bits of a half for each byte and the end.
    held = next(i for i in range(100) if not learned(i))
    (row,) = scored(documents(spark, [(held, "ab", "en", "s")]))
    assert row[:5] == (held, True, 2, 0, 0) and row[5] == pytest.approx(2 * math.log10(1.0)) and row[6] == pytest.approx(-24 * math.log10(2))
