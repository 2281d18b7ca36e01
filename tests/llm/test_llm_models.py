"""The two trained classifiers: held-out accuracy, and what labels and odd rows do to them."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from odd_documents import documents, no_docs, odd_docs, odd_rows, prepared  # noqa: F401
from orestar.llm import quality, toxicity

BAD = ["venom", "spiteful", "rotten"]


def text(i, bad):
    rng = random.Random(i)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) for _ in range(60)]
    if bad:
        for _ in range(4):
            words[rng.randrange(60)] = rng.choice(BAD) + rng.choice(["", "ly", "ness"])
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, text(i, i % 5 == 0), ("en", "de")[i % 2], "s") for i in range(600)]
    labels = [(i, i % 3 != 0, int(i % 5 == 0)) for i in range(600)] + [(None, 1, 1), (7, 1, 0), (8, None, None)]
    return rows, spark.createDataFrame([(i, None if q is None else int(q), t) for i, q, t in labels], "doc_id bigint, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, corpus, odd_rows):
    rows, labels = corpus
    odd = [(None if i is None else 10_000 + i, *rest) for i, *rest in odd_rows]
    found = toxicity.toxicity(documents(spark, rows + odd), labels).collect()
    assert len(found) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    own = [r for r in found if r.held_out and r.doc_id < 10_000]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in own) / len(own) > 0.95
    assert all(r.held_out is False for r in found if r.doc_id is None)


def test_toxicity_removes_what_it_flags(spark, corpus):
    rows, labels = corpus
    docs = documents(spark, rows)
    kept = toxicity.remove_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    flagged = {r.doc_id for r in toxicity.toxicity(docs, labels).where("flagged").collect()}
    assert ids == set(range(600)) - flagged
    assert sum(i % 5 == 0 for i in flagged) / len(flagged) > 0.95


def test_toxicity_ignores_held_out_labels(spark, corpus):
    rows, labels = corpus
    held_out = toxicity.fold_of(labels["doc_id"]) == toxicity.HELD_OUT_FOLD
    docs = documents(spark, rows)
    one, two = (toxicity.training_sample(docs, own).orderBy("label_id").toPandas() for own in (labels, labels.where(~held_out)))
    pd.testing.assert_frame_equal(one, two)
    assert one["label"].isin([0, 1]).all() and len(one) < 600


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """More rows than one task learns alone, and texts of any length: all of them teach, in parts."""
    monkeypatch.setattr(toxicity, "ALONE_ROWS", 200)
    monkeypatch.setattr(toxicity, "PART_ROWS", 300)
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1600):
        toxic = int(rng.random() < 0.3)
        text = [*rng.choice(words, 30), *(["vile"] if toxic else [])]
        rows.append((i, " ".join(rng.permutation(text)), "en" if i % 2 else "fr"))
        labels.append((i, toxic))
    rows.append((5000, "tail " * 40_000, "en"))
    labels.append((5000, 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    learned = marks.where(toxicity.fold_of(marks["doc_id"]) != toxicity.HELD_OUT_FOLD)
    assert toxicity.training_sample(docs, marks).count() == learned.count() > 1000
    found = toxicity.toxicity(docs, marks).collect()
    truth, aside = dict(labels), [r for r in found if r.held_out]
    assert len(found) == 1601 and sum(r.predicted == truth[r.doc_id] for r in aside) >= 0.97 * len(aside) > 300
    # A second run learns the same.
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, marks).collect()}
    assert max(abs(again[r.doc_id] - r.score) for r in found) < 1e-6


def test_toxicity_without_labels(spark, corpus, odd_docs, no_docs):
    _, labels = corpus
    scores = {r.score for r in toxicity.toxicity(odd_docs, labels.where("false")).collect()}
    assert len(scores) == 1
    assert toxicity.toxicity(no_docs, labels).count() == 0


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    count = toxicity.FILTERS * len(toxicity.WIDTHS)
    model = toxicity.Model(
        rng.normal(size=(toxicity.BUCKETS, toxicity.DIM)).astype(np.float32),
        rng.normal(size=(toxicity.DIM, toxicity.FILTERS * sum(toxicity.WIDTHS))).astype(np.float32),
        rng.normal(size=count).astype(np.float32), rng.normal(size=count), rng.normal(size=count),
    )
    texts = ["", "one", "two words", text(1, True), text(2, False) * 3, "  ", "é ß"]
    whole = toxicity.Scorer(model).raw(texts)
    alone = [toxicity.Scorer(model).raw([t])[0] for t in texts]
    assert np.allclose(whole, alone, atol=1e-4)
    # The responses are those of the filters at every place, by hand.
    words = toxicity.words_of(texts[3])
    vectors = model.vectors(toxicity.Pieces.of(words))[1:]
    by_hand = max(v @ model.filters[:, 3] + model.bias[3] for v in vectors)
    scorer = toxicity.Scorer(model)
    ids = toxicity._padded(scorer._ids(words), np.array([len(words)]))
    seen = toxicity._responses(scorer.table, ids, model.bias)[: len(words), 3].max()
    assert np.isclose(by_hand, seen, atol=1e-4)


def test_quality_on_held_out_rows(spark, corpus, odd_rows):
    rows, labels = corpus
    marked = [(i, t + " $$$ ### %%%" * 5 if i % 3 == 0 else t, lang, source) for i, t, lang, source in rows]
    odd = [(None if i is None else 10_000 + i, *rest) for i, *rest in odd_rows]
    found = quality.quality(documents(spark, marked + odd), labels, rounds=2, added=20)
    assert found.columns == ["doc_id", "held_out", "text_score", "meta_score", "score", "keep"]
    found = found.collect()
    assert len(found) == len(rows) + len(odd)
    own = [r for r in found if r.held_out and r.doc_id < 10_000]
    assert sum(r.keep == (r.doc_id % 3 != 0) for r in own) / len(own) > 0.95


def test_quality_views_teach_each_other(spark, corpus):
    """Rows that only the text tells apart become training rows of the metadata view."""
    rows, labels = corpus
    marked = [(i, t + " ###" * 20 if i % 3 == 0 else t, lang, "bad" if i % 3 == 0 else "good") for i, t, lang, _ in rows]
    few = labels.where("doc_id < 60")
    table = quality.features(documents(spark, marked))
    before, _ = quality.co_train(table, few, "doc_id", 0, 50, 100)
    after, _ = quality.co_train(table, few, "doc_id", 2, 50, 100)
    assert not np.allclose(before["meta"].weights, after["meta"].weights)


def area(score, label):
    pairs = [(a > b) + (a == b) / 2 for a, y in zip(score, label) if y for b, z in zip(score, label) if not z]
    return sum(pairs) / len(pairs)


def test_useless_view_teaches_nothing(spark, corpus):
    """All metadata are alike: the text view stays as it was, whatever the rounds."""
    rows, labels = corpus
    marked = [(i, t + " ###" * 20 if i % 3 == 0 else t, "en", "s") for i, t, _, _ in rows]
    table = quality.features(documents(spark, marked))
    few = labels.where("doc_id < 200")
    before, _ = quality.co_train(table, few, "doc_id", 0, 50, 1000)
    after, _ = quality.co_train(table, few, "doc_id", 3, 50, 1000)
    np.testing.assert_array_equal(before["text"].weights, after["text"].weights)


def test_exchange_helps_the_weaker_view(spark, corpus):
    """The source tells the label; from few labels the text view alone knows little."""
    rows, labels = corpus
    rng = random.Random(3)
    marked = [(i, t + " q" * rng.randint(0, 3) if i % 3 == 0 else t, "en", "bad" if i % 3 == 0 else "good") for i, t, _, _ in rows]
    docs, few = documents(spark, marked), labels.where("doc_id < 120")
    areas = []
    for rounds in (0, 3):
        found = quality.quality(docs, few, rounds=rounds, added=100).where("doc_id >= 120").collect()
        areas.append(area([r.text_score for r in found], [r.doc_id % 3 != 0 for r in found]))
    assert areas[1] > areas[0] + 0.03, areas


def test_trust():
    y = np.array([1] * 10 + [0] * 10)
    odds = np.where(y == 1, 4.0, -4.0)
    assert quality.trust(odds, y) == pytest.approx({1: 2 * 11 / 12 - 1, 0: 2 * 11 / 12 - 1})
    assert quality.trust(-odds, y) == {1: 0, 0: 0}
    assert quality.trust(np.zeros(20), y) == {1: 0, 0: 0}
    assert quality.trust(odds / 4, y) == {1: 0, 0: 0}
    assert quality.trust(odds[:10], y[:10]) == {1: 0, 0: 0}


def test_rows_taught_against_brute_force(spark):
    """Beyond the limit, one of equal features, none taught before, ties by a hash of the id."""
    rng = random.Random(5)
    rows = [(i, rng.randrange(60), None) for i in range(300)]
    rows = [(i, v, [-9.0, -3.0, -2.0, 0.0, 2.0, 2.5, 2.5, 8.0][v % 8]) for i, v, _ in rows]
    scores = spark.createDataFrame(rows, "doc_id bigint, vector bigint, text double")
    taught = [0, 1, 7]

    def hashed(i):
        return np.uint64(xxhash.xxh64(int(i).to_bytes(8, "little"), seed=42).intdigest()).astype(np.int64)

    expected = []
    for label, sign in ((0, -1), (1, 1)):
        best = {}
        for i, vector, odds in rows:
            if sign * odds >= np.log(9) and vector not in taught:
                best[vector] = min(best.get(vector, (hashed(i), i, -sign * odds)), (hashed(i), i, -sign * odds))
        ordered = sorted((odds, h, i, v) for v, (h, i, odds) in best.items())[:9]
        expected += [(i, v, label) for _, _, i, v in ordered]
    found = quality._surest(scores, "text", [0, 1], 9, taught, 0.9)
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_quality_without_labels(corpus, odd_docs, no_docs):
    _, labels = corpus
    assert len({r.score for r in quality.quality(odd_docs, labels.where("false")).collect()}) == 1
    assert quality.quality(no_docs, labels).count() == 0
