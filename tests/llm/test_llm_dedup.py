"""Exact, near and line duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odd_documents import no_docs, odd_docs, odd_rows, prepared  # noqa: F401
from orestar.llm import exact_dedup, line_dedup, near_dedup
from orestar.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = r"[\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def some(values):
    return sorted(values, key=repr)


def test_exact_groups(odd_docs, odd_rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in odd_rows:
        groups[re.sub(SPACE, "", text or "")].append((doc_id, len(text or "")))
    expected = []
    for bare, members in groups.items():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        expected += [(i, best[0], len(members), (i, n) == best, sha(bare)) for i, n in members]
    found = exact_dedup.exact_groups(odd_docs)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert some(map(tuple, found.collect())) == some(expected)


def test_exact_groups_tell_colliding_hashes_apart(odd_docs):
    whole = exact_dedup.exact_groups(odd_docs).collect()
    # No byte of hash is left: every text shares its hash with all others.
    assert some(exact_dedup.exact_groups(odd_docs, hash_bytes=0).collect()) == some(whole)


def test_remove_exact_leaves_one_row_of_each_text(odd_docs, odd_rows):
    left = exact_dedup.remove_exact(odd_docs)
    assert left.columns == odd_docs.columns
    texts = [re.sub(SPACE, "", r.text or "") for r in left.collect()]
    assert sorted(texts) == sorted({re.sub(SPACE, "", t or "") for _, t, *_ in odd_rows})


def line_key(line):
    return re.sub(f"^{SPACE}|{SPACE}$", "", line).translate(LOWER)


def brute_lines(rows, least):
    holders = defaultdict(list)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= least:
                holders[line_key(line)].append(doc_id)
    first = {k: min(v, key=lambda i: (i is None, i or 0)) for k, v in holders.items()}
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(line_key(x), doc_id) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize(("batches", "fanout"), [(1, 3), (5, 2)])
def test_lines(odd_docs, odd_rows, batches, fanout):
    found = line_dedup.deduplicate_lines(odd_docs, batches=batches, fanout=fanout)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept_text"]
    assert some(map(tuple, found.collect())) == some(brute_lines(odd_rows, 10))


def test_line_store_compacts_and_forgets(spark):
    store = line_dedup.LineStore(spark, fanout=2, buckets=2)
    new = []
    for i in range(5):
        batch = spark.range(10 * i, 10 * i + 20).select(F.col("id").alias("doc_id"), F.md5(F.col("id").cast("string")).cast("binary").alias("hash"))
        new.append(store.add(batch).count())
    assert new == [20, 10, 10, 10, 10]
    assert [len(level) for level in store.levels] == [1, 0, 1]
    assert sum(spark.table(run).count() for run in store.runs()) == 60
    store.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_runs")]


def shingles(text, width):
    words = [w for w in re.split(SPACE, (text or "").translate(LOWER)) if w]
    if not words:
        return frozenset()
    return frozenset(zip(*(words[i:] for i in range(width)))) if len(words) >= width else frozenset([tuple(words)])


def brute_near(rows, width):
    sets = [(doc_id, shingles(text, width)) for doc_id, text, *_ in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return [(i, len(s), None if i is None else top(i), i is None or top(i) == i) for i, s in sets]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_of_odd_rows(odd_docs, odd_rows, width):
    found = near_dedup.near_duplicates(odd_docs, width=width).drop("digest")
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert some(map(tuple, found.collect())) == some(brute_near(odd_rows, width))


def family(n, words, seed):
    """Near copies of one text: each replaces a few words of it."""
    base = [f"w{seed}n{i}" for i in range(words)]
    rows = []
    for k in range(n):
        own = list(base)
        for j in range(1 + k % 5):
            own[(7 * k + 31 * j) % words] = f"new{seed}k{k}j{j}"
        rows.append((seed * 10_000 + k, " ".join(own), "en", "s"))
    return rows


def test_near_duplicates_in_crowded_regions(spark):

    rows = family(150, 60, 1) + family(40, 45, 2) + family(3, 400, 3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    expected = some(brute_near(rows, 2))
    assert some(map(tuple, near_dedup.near_duplicates(docs, width=2).drop("digest").collect())) == expected
    # A neighbourhood of one, so that the search of crowded regions has to find the rest.
    assert some(map(tuple, near_dedup.near_duplicates(docs, width=2, neighbours=1).drop("digest").collect())) == expected


def replaced(base, spots, name):
    return [f"{name}{i}" if i in spots else w for i, w in enumerate(base)]


def test_a_true_partner_among_hundreds_of_near_misses(spark):
    """Two texts at similarity 0.8, each with 150 others at 0.785, over twenty of which agree better by chance."""
    rng = random.Random(2)
    one = [f"w2n{i}" for i in range(109)]
    two = replaced(one, range(2, 98, 16), "two")
    rows = [(1, one), (2, two)]
    for k in range(300):
        spots = rng.sample(range(1, 104, 4), 6)
        rows.append((10 + k, replaced((one, two)[k % 2], {*spots, spots[0] + 1}, f"k{k}n")))
    rows = [(i, " ".join(words), "en", "s") for i, words in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = near_dedup.near_duplicates(docs, width=2).drop("digest")
    expected = brute_near(rows, 2)
    assert [r[2] for r in expected[:2]] == [1, 1]
    assert some(map(tuple, found.collect())) == some(expected)


def test_crowded_regions_are_searched_whole(spark, monkeypatch):
    """A hundred pairs at similarity 0.8, most of them apart, that share much with all others, in regions far above the size of a task."""
    monkeypatch.setattr(near_dedup, "CROWD", 4)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(109)]
    rows = []
    for k in range(100):
        one = replaced(base, rng.sample(range(1, 105, 4), 5), f"k{k}n")
        rows += [(2 * k, one), (2 * k + 1, replaced(one, rng.sample(range(3, 106, 4), 6), f"k{k}m"))]
    rows = [(i, " ".join(words), "en", "s") for i, words in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    # A neighbourhood of one, so that nearly all regions are crowded.
    found = near_dedup.near_duplicates(docs, width=2, neighbours=1).drop("digest")
    expected = brute_near(rows, 2)
    assert sum(r[3] for r in expected) > 60
    assert some(map(tuple, found.collect())) == some(expected)


def recall(found, expected):
    """Share of the documents that belong to a group and are in one with all they belong to."""
    groups = lambda rows: {r[0]: frozenset(x[0] for x in rows if x[2] == r[2]) for r in rows}
    one, two = groups(found), groups(expected)
    linked = [i for i in two if len(two[i]) > 1]
    assert all(one[i] <= two[i] for i in one)
    return sum(one[i] == two[i] for i in linked) / len(linked)


def test_dense_regions_are_searched_deeper(spark, monkeypatch):
    """With every region of more than eight classes split by up to twelve hashes, nearly all links are still found."""
    monkeypatch.setattr(near_dedup, "DENSE", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(109)]
    rows = []
    for k in range(120):
        one = replaced(base, rng.sample(range(1, 105, 4), 5), f"k{k}n")
        rows += [(2 * k, one), (2 * k + 1, replaced(one, rng.sample(range(3, 106, 4), 4), f"k{k}m"))]
    rows = [(i, " ".join(words), "en", "s") for i, words in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = [tuple(r) for r in near_dedup.near_duplicates(docs, width=2, neighbours=1).drop("digest").collect()]
    assert recall(found, brute_near(rows, 2)) >= 0.9


def test_classes_that_met_before_are_left_out():
    import numpy as np
    import pandas as pd

    signature = np.arange(256).astype(">u2")
    far = signature.copy()
    far[[0, 8]] = 999
    rows = pd.DataFrame({"id": [1, 2, 3], "c": [1, 2, 3], "n": 100, "block": 7, "searched": [[4] * 32] * 3,
                         "signature": [signature.tobytes(), signature.tobytes(), far.tobytes()]})

    def found(tree, deep=4):
        lists = near_dedup.agreeing_across(rows[:1].assign(searched=[[deep] * 32]), rows, tree, 80, 8)
        return [(a, np.frombuffer(x, "<i8").tolist()) for a, x in zip(lists["a"], lists["others"])]

    # The second meets the first in the first tree, the third in the third.
    assert found(0) == [(1, [2, 3])]
    assert found(1) == found(2) == [(1, [3])]
    assert found(3) == []
    # Nor by twelve hashes, of which the last are the next tree's.
    assert found(2, deep=12) == [(1, [3])] and found(3, deep=12) == []


def test_near_in_order_gives_each_pair_once():
    import numpy as np
    import pandas as pd

    keys = [np.array([1, 1, 1, 1, x], ">u2").tobytes() for x in (1, 2, 3, 4, 5)] + [np.array([2] * 5, ">u2").tobytes()]
    rows = pd.DataFrame({"id": range(6), "tree": 0, "key": keys})

    def pairs(old, neighbours, tree=0):
        found = near_dedup.near_in_order(rows.assign(tree=tree), old, 5, 4, neighbours)
        return sorted(zip(found["a"], found["b"], found["gap"])), [k for k in found["key"] if k is not None]

    apart = [(a, b, b - a) for a in range(5) for b in range(a + 1, 5)]
    assert pairs(0, 4) == (apart, [])
    assert pairs(3, 4) == ([p for p in apart if p[1] >= 3], [])
    # Five rows are too many for a neighbourhood of two: the region is named instead.
    name = np.array([1] * 4, ">u2").tobytes()
    assert pairs(0, 2) == ([(0, 0, 0)] + [p for p in apart if p[2] == 1], [name])
    assert pairs(0, 2, tree=near_dedup.FIRST_TREES) == ([(0, 0, 0)], [name])


def _forest_rows(ids, part):
    import pandas as pd

    return pd.DataFrame({"id": list(ids), "tree": 0, "key": [bytes(10)] * len(ids), "part": part})


def test_a_region_cut_by_a_batch_is_crowded():
    import pandas as pd

    batches = [_forest_rows(range(9), 0), _forest_rows([9], 0)]
    met = pd.concat(near_dedup._neighbour_pairs(5, 4, 8)(iter(batches)))
    assert met["key"][met["edge"] == -1].notna().any()


def test_seams_over_empty_and_short_partitions(spark):
    import pandas as pd

    parts = [_forest_rows([0, 1], 0), _forest_rows([2], 1), _forest_rows([3, 4], 3)]
    met = pd.concat([pd.concat(near_dedup._neighbour_pairs(5, 4, 8)(iter([rows]))) for rows in parts])
    edges = met[met["edge"] >= 0].astype({"a": int, "b": int, "gap": int, "tree": int, "edge": int, "part": int, "place": int})
    near = near_dedup._across_seams(spark.createDataFrame(edges.to_dict("records"), near_dedup._PAIR_SCHEMA), 4, 8)
    pairs = sorted((r.a, r.b, r.gap) for r in near.collect())
    assert pairs == [(0, 2, 2), (0, 3, 3), (0, 4, 4), (1, 2, 1), (1, 3, 2), (1, 4, 3), (2, 3, 1), (2, 4, 2)]


def test_components(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 103), (103, 101), (200, 200), (300, None)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_empty_tables(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.remove_exact(no_docs).columns == no_docs.columns
    assert line_dedup.deduplicate_lines(no_docs).count() == 0
    assert near_dedup.near_duplicates(no_docs).count() == 0
