"""Ranked search and periodic runs against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

from odd_documents import LOWER, documents, no_docs, odd_docs, odd_rows, prepared  # noqa: F401
from orestar.llm import mask_search, periodic_runs

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def some(values):
    return sorted(values, key=repr)


def terms(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def brute_search(rows, items, k):
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    docs = [d for d in docs if d[1]]
    n_docs, n_words = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in docs:
            m = 10 + 90 * sum(c.values()) * n_docs // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) & set(c)
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, i + 1, None if none else doc_id, -s) for i, (s, none, doc_id) in enumerate(sorted(found)[:k])]
    return out


ITEMS = [(1, "Beta gamma, delta! word7x984 first"), (1, "line of the page"), (None, "alpha x"), (3, None), (4, "?!"), (5, "nowhere at all")]


@pytest.mark.parametrize(("block", "chars"), [(20_000, 1 << 20), (3, 20), (1, 1)])
def test_search_of_odd_rows(spark, odd_docs, odd_rows, monkeypatch, block, chars):
    monkeypatch.setattr(mask_search, "BATCH_CHARS", chars)
    items = spark.createDataFrame([(*i, "x", 1) for i in ITEMS], "item_id int, text string, rank string, id int").repartition(3)
    found = mask_search.top_documents(odd_docs, items, k=3, block=block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert some(map(tuple, found.collect())) == some(brute_search(odd_rows, ITEMS, 3))


def test_search_by_queries_of_many_terms(spark):
    """More terms than a 64-bit mask holds, many ties, many equal masks."""
    rng = random.Random(3)
    names = [f"t{i}" for i in range(150)]
    rows = [(i, " ".join(rng.choices(names[: 5 + i % 140], k=rng.choice([1, 3, 60]))), "en", "s") for i in range(500)]
    rows += [(1000 + i, "t1 t2 t3", "en", "s") for i in range(60)]
    items = [(0, " ".join(names)), (1, "t1 t2 t3"), (2, "t149 t148"), (3, "t77 t77 t78 unseen")]
    found = mask_search.top_documents(documents(spark, rows), spark.createDataFrame(items, "item_id int, text string"), block=97)
    assert some(map(tuple, found.collect())) == some(brute_search(rows, items, 10))


def test_groups_below_the_last_place_are_not_scored(monkeypatch):
    """A hundred documents with both terms come before thousands that hold the common one."""
    n = 5000
    both = np.arange(n) < 100
    begins = np.append(0, np.cumsum(1 + both))
    listed = np.concatenate([[0, 1] if b else [0] for b in both]).astype(np.int32)
    block = mask_search.Block(np.arange(n), np.full(n, 10), begins, listed, np.ones(len(listed), np.int32), n, 10 * n, 2)
    seen = []
    score = mask_search.Block._score
    monkeypatch.setattr(mask_search.Block, "_score", lambda self, s, chosen, *a: (seen.extend(chosen), score(self, s, chosen, *a)))
    rows, _ = block.best(np.array([0, 1]), np.array([5, 4000]), 10)
    assert rows.tolist() == list(range(10))
    assert len(seen) == 100


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_report(doc_id, text, plant=True):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and n and h % 10 == 0:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, sha256(told.encode()).hexdigest(), sha256(left.encode()).hexdigest())


def test_runs_of_odd_rows(odd_docs, odd_rows):
    found = periodic_runs.run_report(odd_docs)
    expected = [brute_report(i, text) for i, text, *_ in odd_rows if not text or len(text) < 1000]
    got = [r for r in map(tuple, found.collect()) if r[0] not in (7, 8)]
    assert some(got) == some(expected)


def test_runs_of_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 6000")
    rows = docs.select("doc_id", "text").collect()
    found = [tuple(r) for r in periodic_runs.run_report(docs).collect()]
    assert some(found) == some(brute_report(*r) for r in rows)
    assert sum(r[1] for r in found) > 5


def test_runs_of_a_few_letters(monkeypatch):
    """Texts of one to three different words, side by side, with repeats of repeats."""
    rng = random.Random(7)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            text = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.choice([0, 3, 20, 90]))]
            base = [rng.randrange(2) for _ in range(rng.randint(1, 6))] * rng.randint(2, 6)
            at = rng.randint(0, len(text))
            texts.append(text[:at] + base * rng.randint(0, 3) + text[at:])
        first = np.append(0, np.cumsum([len(t) for t in texts]))
        found = [[] for _ in texts]
        for i, s, e, q in zip(*periodic_runs.periodic_runs(np.array(sum(texts, []), np.int64), first)):
            found[i].append((s - first[i], e - s, q))
        assert found == [brute_runs(t) for t in texts]


def test_a_run_is_looked_for_once_per_rule():
    """A text of one word repeated: its nodes are far fewer than its words."""
    words = np.zeros(4096, np.int64)
    rules = [len(np.unique(rule)) for rule, *_ in periodic_runs.grammar(words, np.array([0, 4096]))]
    assert sum(rules) < 30
    assert [x.tolist() for x in periodic_runs.periodic_runs(words, np.array([0, 4096]))] == [[0], [0], [4096], [1]]


def test_hashes_that_collide_are_found_out(monkeypatch):
    """With a hash that says all is equal, the words decide and another hash is taken."""
    same, calls = periodic_runs.Sequence.same, []

    def faulty(self, a, shift, length):
        calls.append(self.seed)
        return np.ones(len(a), bool) if self.seed == 1 else same(self, a, shift, length)

    monkeypatch.setattr(periodic_runs.Sequence, "same", faulty)
    words = np.array([1, 2, 1, 3, 1, 4, 1, 5] + [1, 2] * 4)
    runs = periodic_runs.periodic_runs(words, np.array([0, len(words)]))
    assert [x.tolist() for x in runs] == [[0], [8], [16], [2]] and {1, 2} <= set(calls)


def test_empty_tables(spark, no_docs):
    assert periodic_runs.run_report(no_docs).count() == 0
    assert mask_search.top_documents(no_docs, spark.createDataFrame(ITEMS, "item_id int, text string")).count() == 0
    nothing = spark.createDataFrame([], "item_id int, text string")
    assert mask_search.top_documents(documents(spark, [(1, "a b", "en", "s")]), nothing).count() == 0
