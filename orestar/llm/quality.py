"""Quality by co-training: a classifier on the text and one on the page's metadata teach each other.

Both views start from the same bounded sample of labelled rows. In every round
each view is calibrated on labelled rows kept aside and scores all unlabelled
documents; those it is sure of join the training rows of the other view, weighted
by how often it is right about such rows aside. A view that ranks the rows aside
no better than chance teaches nothing. At the end a logistic fit on the two
calibrated outputs, on the same rows, combines them into the score that every
document gets.

The features of a document are computed once and written; rounds and the final
scoring read them. What reaches the driver are labelled rows and pseudo-labelled
rows up to stated numbers.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestar.llm.text import present
from orestar.workspace import materialise

# Labelled rows of each label in the sample; rows of each label and view that a
# round adds; rounds; the calibrated probability from which a view is sure.
MOST_LABELLED = 6000
ADDED = 200
ROUNDS = 3
SURE = 0.9
HELD_OUT_FOLD = 2

GRAMS = 256
META = 96
_WORD = re.compile(r"\S+")
_SIGNS = np.zeros(256, bool)
_SIGNS[[ord(c) for c in "#$%&*|!<>{}[]=_~^\\"]] = True
SHAPES = 12


def text_features(text: str) -> np.ndarray:
    """Shares of hashed byte trigrams, and the shape of words and lines."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    grams = np.zeros(GRAMS, np.float32)
    if len(raw) > 2:
        x = raw.astype(np.uint32)
        codes = ((x[:-2] * 961 + x[1:-1] * 31 + x[2:]) * np.uint32(2654435761)) >> np.uint32(24)
        grams += np.sqrt(np.bincount(codes, minlength=GRAMS)[:GRAMS] / len(codes))
    words, lines = _WORD.findall(text), [x for x in text.split("\n") if x]
    sizes = np.fromiter(map(len, words), np.float64, len(words))
    n, chars = max(len(words), 1), max(len(raw), 1)
    upper = ((raw >= 65) & (raw <= 90)).sum()
    shapes = [
        _SIGNS[raw].sum() / chars, upper / chars, ((raw >= 48) & (raw <= 57)).sum() / chars, (raw >= 128).sum() / chars,
        sizes.mean() / 10 if len(words) else 0.0, sizes.std() / 10 if len(words) else 0.0,
        len(set(words)) / n, sum(map(str.isupper, words)) / n, len(set(lines)) / max(len(lines), 1),
        math.log1p(len(words) / max(len(lines), 1)) / 5, math.log1p(len(words)) / 10, math.log1p(len(lines)) / 10,
    ]
    return np.concatenate([grams, np.array(shapes, np.float32)])


def meta_features(lang: object, source: object, n_chars: object) -> np.ndarray:
    """Language, source, both together and the stated length, hashed to one-hot places."""
    found = np.zeros(META, np.float32)
    size = -1 if n_chars is None or n_chars != n_chars or n_chars < 0 else int(math.log2(1 + n_chars))
    for part in (f"lang={lang}", f"source={source}", f"both={lang},{source}", f"size={size}"):
        found[zlib.crc32(part.encode()) % META] = 1.0
    return found


@dataclass
class View:
    """A logistic model over standardised features, with its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, pull: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Weighted ridge logistic regression by Newton's method; ``pull`` draws weights to ``start``."""
    beta = start.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - y)) + pull * (beta - start)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        move = np.linalg.solve(hess, grad)
        beta -= np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-6:
            break
    return beta


def fit_view(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-6, scale, 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    pull = np.append(np.full(x.shape[1], 0.002 * weight.sum() + 1.0), 1e-3)
    return View(mean, scale, logistic(z, y, weight, pull, np.zeros(z.shape[1])))


def _platt(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    x = np.column_stack([raw, np.ones_like(raw)])
    slope, shift = logistic(x, y, weight, np.array([1.0, 1e-2]), np.array([1.0, 0.0]))
    return max(float(slope), 0.0), float(shift)


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"],
                "text_view": [text_features(t).astype("<f2").tobytes() for t in batch["text"]],
                "meta_view": [
                    meta_features(*m).astype("<f2").tobytes()
                    for m in zip(batch["lang"].astype(object), batch["source"].astype(object), batch["n_chars"].astype(object))
                ],
            }
        )


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and both views of every row, as half-precision vectors; a missing metadata column counts as null."""

    def meta(name: str, kind: str) -> Column:
        return (F.col(name) if name in docs.columns else F.lit(None)).cast(kind).alias(name)

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), present(F.col(text_col)).alias("text"),
        meta("lang", "string"), meta("source", "string"), meta("n_chars", "double"),
    )
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return rows.mapInPandas(_features, "doc_id bigint, text_view binary, meta_view binary")


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f2").reshape(-1, width).astype(np.float32)


def _views(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    return {"text": _matrix(rows["text_view"], GRAMS + SHAPES), "meta": _matrix(rows["meta_view"], META)}


def _labelled(table: DataFrame, labels: DataFrame, id_col: str, most: int) -> pd.DataFrame:
    """At most ``most`` rows of each label outside the held-out fold, by smallest hash, weighted to the labels' shares."""
    own = (
        labels.where(f"{id_col} IS NOT NULL AND quality IN (0, 1)")
        .groupBy(F.col(id_col).cast("bigint").alias("label_id"))
        .agg(F.min("quality").alias("label"))
        .where(fold_of(F.col("label_id")) != HELD_OUT_FOLD)
    )
    parts = []
    for label in (0, 1):
        of_label = own.where(F.col("label") == label)
        total = of_label.count()
        chosen = of_label.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
        found = (
            table.join(F.broadcast(chosen), table["doc_id"] == chosen["label_id"])
            .select("label_id", "label", "text_view", "meta_view")
            .dropDuplicates(["label_id"])
            .withColumn("aside", F.pmod(F.xxhash64(F.lit("aside"), "label_id"), F.lit(5)) == 0)
            .orderBy("label_id")
            .toPandas()
        )
        parts.append(found.assign(weight=total / max(len(found), 1)))
    return pd.concat(parts, ignore_index=True)


def _scored(table: DataFrame, views: dict[str, View]) -> DataFrame:
    """doc_id, the log odds of both calibrated views, and a hash by which rows of equal features are known."""
    shared = table.sparkSession.sparkContext.broadcast(views)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _views(batch)
                odds = {k: v.calibrated(x[k]).astype(float) for k, v in shared.value.items()}
                yield pd.DataFrame({"doc_id": batch["doc_id"], "vector": batch["vector"], **odds})

    hashed = table.withColumn("vector", F.xxhash64("text_view", "meta_view"))
    return hashed.mapInPandas(score, "doc_id bigint, vector bigint, text double, meta double")


def trust(odds: np.ndarray, y: np.ndarray, sure: float = SURE) -> dict[int, float]:
    """How far a view is believed when it is sure of a label, from 0 to 1, by rows kept aside.

    Of the rows aside that it is as sure of, 2 * (share it gets right) - 1, the share
    with one right and one wrong row added. A view that ranks the rows aside no better
    than chance, by one standard error of the rank sum, is not believed at all.
    """
    ones, zeros = odds[y == 1], odds[y == 0]
    if not len(ones) or not len(zeros):
        return {0: 0.0, 1: 0.0}
    rank = pd.Series(np.append(ones, zeros)).rank().to_numpy()[: len(ones)].sum()
    area = (rank - len(ones) * (len(ones) + 1) / 2) / (len(ones) * len(zeros))
    error = math.sqrt((len(odds) + 1) / (12 * len(ones) * len(zeros)))
    if area <= 0.5 + error:
        return {0: 0.0, 1: 0.0}
    limit = math.log(sure / (1 - sure))
    believed = {}
    for label, own in ((1, odds >= limit), (0, odds <= -limit)):
        believed[label] = max(0.0, 2 * ((y[own] == label).sum() + 1) / (own.sum() + 2) - 1)
    return believed


def _surest(scores: DataFrame, view: str, labels: list[int], added: int, taught: list[int], sure: float) -> DataFrame:
    """The rows a view is surest of, ``added`` of each label, with the label it gives them.

    Only rows beyond the limit ``sure``, one of those with equal features, none
    with the features of a row taught before; ties by a hash of the id.
    """
    limit = math.log(sure / (1 - sure))
    parts = []
    for label in labels:
        odds = F.col(view) if label else -F.col(view)
        hashed = F.struct(F.xxhash64("doc_id").alias("hash"), "doc_id")
        own = (
            scores.where((odds >= limit) & ~F.col("vector").isin(taught))
            .groupBy("vector")
            .agg(F.min(hashed).alias("first"), F.max(odds).alias("odds"))
            .orderBy(F.desc("odds"), "first.hash", "first.doc_id")
            .limit(added)
        )
        parts.append(own.select(F.col("first.doc_id").alias("doc_id"), "vector", F.lit(label).alias("label")))
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def co_train(
    table: DataFrame, labels: DataFrame, id_col: str, rounds: int, added: int, most: int, sure: float = SURE
) -> tuple[dict[str, View], np.ndarray]:
    """Both views after the rounds, and the weights that combine their calibrated outputs.

    Every round calibrates each view on the labelled rows kept aside and teaches the
    other one the rows beyond the limit ``sure``, weighted by ``trust``. Without rows of
    both labels the views are flat and the score is the share of label 1; without
    such rows aside nothing is exchanged.
    """
    sample = _labelled(table, labels, id_col, most)
    y, weight = sample["label"].to_numpy(float), sample["weight"].to_numpy(float)
    aside = sample["aside"].to_numpy(bool)
    x = _views(sample)
    if not len(sample) or len(set(y[~aside])) < 2:
        share = ((weight * y).sum() + 1) / (weight.sum() + 2) if len(sample) else 0.5
        flat = {k: View(np.zeros(v.shape[1]), np.ones(v.shape[1]), np.zeros(v.shape[1] + 1)) for k, v in x.items()}
        return flat, np.array([0.0, 0.0, math.log(share / (1 - share))])
    fit = ~aside
    check = aside if len(set(y[aside])) == 2 else fit
    rows = {k: (v[fit], y[fit], weight[fit]) for k, v in x.items()}

    def fitted() -> dict[str, View]:
        views = {k: fit_view(*own) for k, own in rows.items()}
        for k, view in views.items():
            view.slope, view.shift = _platt(view.raw(x[k][check]), y[check], weight[check])
        return views

    views = fitted()
    known = labels.select(F.col(id_col).cast("bigint").alias("label_id")).where("label_id IS NOT NULL").distinct()
    taught: dict[str, list[int]] = {k: [] for k in views}
    for _ in range(rounds):
        believed = {k: trust(view.calibrated(x[k][aside]), y[aside], sure) for k, view in views.items()}
        teachers = {k: [label for label in (0, 1) if own[label] > 0] for k, own in believed.items()}
        if not any(teachers.values()):
            break
        # All rows are scored; only ids, hashes and scores are shuffled to leave the labelled ones out.
        scores = _scored(table, views).where("doc_id IS NOT NULL")
        scores = materialise(scores.join(known, scores["doc_id"] == known["label_id"], "left_anti"), "co_training")
        learnt = False
        for teacher, pupil in (("text", "meta"), ("meta", "text")):
            if not teachers[teacher]:
                continue
            chosen = _surest(scores, teacher, teachers[teacher], added, taught[pupil], sure)
            chosen = chosen.withColumnRenamed("doc_id", "chosen_id")
            # At most 2 * added rows: sent everywhere, and to the driver.
            new = table.join(F.broadcast(chosen), table["doc_id"] == chosen["chosen_id"]).dropDuplicates(["chosen_id"])
            new = new.select("chosen_id", "vector", "label", "text_view", "meta_view").orderBy("chosen_id").toPandas()
            if len(new):
                learnt = True
                taught[pupil] += new["vector"].tolist()
                worth = new["label"].map(believed[teacher]).to_numpy(float) * weight.mean()
                before = rows[pupil]
                rows[pupil] = (
                    np.vstack([before[0], _views(new)[pupil]]),
                    np.append(before[1], new["label"].to_numpy(float)),
                    np.append(before[2], worth),
                )
        if not learnt:
            break
        views = fitted()
    stacked = np.column_stack([*(v.calibrated(x[k][check]) for k, v in views.items()), np.ones(int(check.sum()))])
    return views, logistic(stacked, y[check], weight[check], np.array([1.0, 1.0, 1e-2]), np.array([0.5, 0.5, 0.0]))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    added: int = ADDED,
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, text_score, meta_score, score, keep.

    Scores are probabilities of label 1; ``keep`` is score >= 0.5. Labels of the
    held-out fold are never used. Null and empty texts and null metadata have
    features like any other; rows without an id are scored but never taught from;
    repeated rows each get a row. Without labels of both kinds all scores are the
    share of label 1. Columns other than lang, source and n_chars are ignored.
    Ids are taken as bigint: those that are no number stop the query.
    """
    table = materialise(features(docs, id_col, text_col), "quality_features")
    views, blend = co_train(table, labels, id_col, rounds, added, most_labelled)
    shared = docs.sparkSession.sparkContext.broadcast((views, blend))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, weights = shared.value
        for batch in batches:
            if len(batch):
                x = _views(batch)
                text, meta = (own[k].calibrated(x[k]).astype(float) for k in ("text", "meta"))
                both = text * weights[0] + meta * weights[1] + weights[2]
                p = [1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (text, meta, both)]
                yield pd.DataFrame({"doc_id": batch["doc_id"], "text_score": p[0], "meta_score": p[1], "score": p[2]})

    scored = table.mapInPandas(score, "doc_id bigint, text_score double, meta_score double, score double")
    held_out = F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT_FOLD, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).alias("keep")
    )
