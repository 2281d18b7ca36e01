"""Decontamination against a search of every window at every place."""

from __future__ import annotations

import hashlib
import re

import pytest

from odd_documents import no_docs, odd_docs, odd_rows, prepared  # noqa: F401
from orestar.llm import decontamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    out = []
    windows = []
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        if item is not None and w:
            windows += [(str(item), w[i : i + n]) for i in range(len(w) - n + 1)]
    for doc_id, text, *_ in docs:
        w, hit, names = words(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    names.add(item)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (1, "Beta gamma, delta epsilon; zeta eta theta iota kappa lambda mu and more that is not there"),
    (2, "word3x3 WORD4x4 word5x5 word6x6 word7x7 word8x8 word9x9 word10x10 word11x11 word12x12 word13x13"),
    (3, "x"),
    (4, "first line"),
    (5, None),
    (6, " ;, "),
    (None, "first line"),
    (7, "first line"),
    (8, "Übung macht"),
    (9, "alpha beta gamma nothing of this is anywhere at all in them"),
]


@pytest.mark.parametrize("broadcast_bytes", [decontamination.BROADCAST_BYTES, 0])
def test_against_brute_force(spark, odd_docs, odd_rows, broadcast_bytes):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontamination.contamination(odd_docs, items, broadcast_bytes=broadcast_bytes).drop("digest")
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(odd_rows, ITEMS)


def test_remove_contaminated(spark, odd_docs, odd_rows):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    left = decontamination.remove_contaminated(odd_docs, items)
    assert left.columns == odd_docs.columns
    clean = [r[:1] for r in brute(odd_rows, ITEMS) if not r[5]]
    assert sorted([(r.doc_id,) for r in left.collect()], key=repr) == sorted(clean, key=repr)


def test_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contamination(no_docs, items).count() == 0
    rows = decontamination.contamination(odd_docs, nothing).collect()
    assert len(rows) == odd_docs.count() and not any(r.contaminated for r in rows)


@pytest.mark.parametrize("broadcast_bytes", [decontamination.BROADCAST_BYTES, 0])
def test_a_passage_in_all_items_and_a_shingle_in_all_texts(spark, broadcast_bytes):
    shared = " ".join(f"s{i}" for i in range(12))
    items = [(i, f"own{i} a b c {shared} a b c end{i}") for i in range(40)]
    docs = [(i, "a b c " * (i % 50) + (shared if i % 3 == 0 else f"own{i % 40} a b c s0 s1 s2 s3 s4 s5 s6"), None, None) for i in range(120)]
    table = spark.createDataFrame([d[:2] for d in docs], "doc_id bigint, text string")
    found = decontamination.contamination(table, spark.createDataFrame(items, "item_id bigint, text string"), broadcast_bytes=broadcast_bytes)
    assert sorted(map(tuple, found.drop("digest").collect()), key=repr) == brute(docs, items)


@pytest.mark.parametrize("broadcast_bytes", [decontamination.BROADCAST_BYTES, 0])
def test_only_the_rarest_shingle_of_a_window_is_joined(spark, broadcast_bytes):
    """One prefix for each window whose shingles all occur somewhere, by the counts of the whole corpus."""
    items = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "a b c d e"), (3, "a b c x y"), (4, "j")], "item_id bigint, text string")
    texts = ["a b c " * 9, "a b c d e f g h i j", "a b c d e", "d e f g h i j", "b c d", "c d e f"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").select(
        decontamination.words_of(decontamination.F.col("text")).alias("words"), "doc_id"
    ).selectExpr("doc_id", "doc_id AS digest", "words", "size(words) AS n_words")
    shingles = decontamination._window_shingles(decontamination._windows(items, "item_id", "text"))
    found = decontamination._prefixes(docs, shingles, [1, 3], broadcast_bytes).collect()
    # Shingles by their places: "a b c" 11, "b c d" 3, "c d e" 3, "d e f" 3 and those after it 2.
    assert {(r.window, r.len, r.offset) for r in found} == {("a b c d e f g h i j", 10, 4), ("a b c d e", 5, 1), ("j", 1, 0)}
