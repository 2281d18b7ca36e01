"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is embedded as the mean of the vectors its pieces hash to: the word
itself and its beginnings, so that forms of one stem share what is learned.
Filters of several widths slide over the whole text. Their largest response in
each quarter of the text, and in all of it, goes through a rectifier into a
logistic output, and Platt scaling on rows kept aside makes the output a
probability. Thresholds are then chosen by
language on the same rows. The model has a fixed size and learns from every
labelled row outside the held-out fold, each text whole. A few thousand rows are
learned in one task. Of more, each task learns a part as a stream, from the same
model, and after each pass the tasks' steps are averaged: those of an embedding
over the tasks that moved it. Scoring reads every text whole.
"""

from __future__ import annotations

import pickle
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from orestar.llm.text import present
from orestar.workspace import materialise

# Labelled rows, and characters of them, that one task learns alone; what is more is learned in parts of so many rows.
ALONE_ROWS, ALONE_CHARS, PART_ROWS, MOST_PARTS = 8000, 1 << 26, 8000, 64
# Rows gone through before passes over all parts end, and the fewest passes.
SEEN_ROWS, LEAST_PASSES = 48_000, 2
# The contract's cut, which is also the threshold where a language has too few labels.
CUT = 0.3
LEAST_LABELS = 15
HELD_OUT_FOLD = 2

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
# Quarters of a text that are pooled apart, and pads behind a text: no filter
# reaches into the next text, and no quarter is empty.
PARTS = 4
PADS = max(WIDTHS) - 1 + PARTS
EPOCHS, BATCH, RATE = 6, 32, 0.08
# Buckets whose steps are sent together, and raw outputs told apart by calibration.
BLOCK_BUCKETS, RAW_DIGITS = 1 << 10, 3
# Words whose responses a task keeps at hand, and words it pools at once.
CACHED_WORDS, CHUNK_WORDS = 200_000, 300_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def pieces_of(word: str) -> list[int]:
    """Buckets of the word and of its beginnings of three to eight letters."""
    found = [zlib.crc32(word.encode()) % BUCKETS]
    for n in range(3, min(9, len(word))):
        found.append(zlib.crc32(f"^{word[:n]}".encode()) % BUCKETS)
    return found


class Pieces:
    """The buckets of many words, one after the other."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, words: list[str]) -> Pieces:
        flat, sizes = array("q"), array("q")
        for word in words:
            own = pieces_of(word)
            flat.extend(own)
            sizes.append(len(own))
        return cls(np.array(flat, np.int64), np.array(sizes, np.int64))

    def take(self, rows: np.ndarray) -> Pieces:
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        return Pieces(self.flat[np.repeat(self.starts[rows], sizes) + inside], sizes)


def _columns(width: int, offset: int) -> slice:
    """Where the response of a filter width to its ``offset``-th word stands."""
    before = sum(w for w in WIDTHS if w < width) + offset
    return slice(before * FILTERS, (before + 1) * FILTERS)


@dataclass
class Model:
    """Embeddings, filters, output layer, calibration and thresholds."""

    embeddings: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    largest: np.ndarray
    spread: np.ndarray
    offset: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def vectors(self, pieces: Pieces) -> np.ndarray:
        """Embeddings of words, after a pad of zeros."""
        found = np.zeros((len(pieces.sizes) + 1, DIM), np.float32)
        if len(pieces.sizes):
            sums = np.add.reduceat(self.embeddings[pieces.flat], pieces.starts, axis=0)
            found[1:] = sums / pieces.sizes[:, None].astype(np.float32)
        return found

    def raw(self, quarters: np.ndarray) -> np.ndarray:
        """Output from rectified responses: texts x quarters x filters."""
        return quarters.max(axis=1) @ self.largest + quarters.mean(axis=1) @ self.spread + self.offset

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))


REACH = max(WIDTHS) - 1


def _responses(table: np.ndarray, ids: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Every filter at every position but the last few, which are pads."""
    last = len(ids) - REACH
    parts = []
    for at, width in enumerate(WIDTHS):
        z = table[ids[:last], _columns(width, 0)]
        for offset in range(1, width):
            z = z + table[ids[offset : last + offset], _columns(width, offset)]
        parts.append(z + bias[at * FILTERS : (at + 1) * FILTERS])
    return np.hstack(parts)


def _quarters(sizes: np.ndarray) -> np.ndarray:
    """Where the quarters of texts of these sizes begin, and where the last one ends.

    Between that end and the next text lie the pads a filter may reach into.
    """
    whole = sizes + PADS
    first = np.cumsum(whole) - whole
    return first[:, None] + (np.arange(PARTS + 1)[None, :] * (sizes + PARTS)[:, None]) // PARTS


def _padded(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Word rows with pads behind every text, and a few more at the end."""
    full = np.zeros(len(ids) + PADS * len(sizes) + REACH, np.int64)
    full[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)) * PADS, sizes)] = ids
    return full


class Scorer:
    """Raw outputs for whole texts, with the responses to known words at hand."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        # Word 0 is the pad.
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1, self.model.filters.shape[1]), np.float32)

    def _ids(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if len(self.rows) + len(new) > CACHED_WORDS and self.rows:
            self._clear()
            new = list(dict.fromkeys(words))
        if new:
            first = len(self.table)
            self.rows.update(zip(new, range(first, first + len(new))))
            self.table = np.vstack([self.table, self.model.vectors(Pieces.of(new))[1:] @ self.model.filters])
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    def _outputs(self, texts: list[list[str]]) -> np.ndarray:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ids = _padded(self._ids([w for words in texts for w in words]), sizes)
        z = _responses(self.table, ids, self.model.bias)
        pooled = np.maximum.reduceat(z, _quarters(sizes).ravel(), axis=0).reshape(len(texts), PARTS + 1, -1)
        return self.model.raw(np.maximum(pooled[:, :PARTS], 0))

    def raw(self, texts: list[str]) -> np.ndarray:
        found, chunk, size = [], [], 0
        for text in texts:
            words = words_of(text)
            if chunk and size + len(words) > CHUNK_WORDS:
                found.append(self._outputs(chunk))
                chunk, size = [], 0
            chunk.append(words)
            size += len(words)
        if chunk:
            found.append(self._outputs(chunk))
        return np.concatenate(found) if found else np.empty(0)


def _count_buckets(seen: np.ndarray, docs: list[np.ndarray], pieces: Pieces, labels: np.ndarray) -> None:
    """Add to ``seen`` (label x bucket) the texts that hold a bucket."""
    for words, label in zip(docs, labels):
        seen[int(label), np.unique(pieces.take(np.unique(words)).flat)] += 1


def _initial(seen: np.ndarray, base: float, rng: np.random.Generator) -> Model:
    """Small random weights; one dimension starts with how much a bucket leans to toxic texts."""
    total = seen.sum(axis=0)
    lean = (seen[1] - total * base) / np.sqrt(total * base * (1 - base) + 1)
    embeddings = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    embeddings[:, 0] = lean / 4
    filters = rng.normal(0, 0.3, (DIM, FILTERS * sum(WIDTHS))).astype(np.float32)
    filters[0] = np.abs(filters[0])
    filters[0, 0], filters[1:, 0] = 1.0, 0.0
    count = FILTERS * len(WIDTHS)
    largest, spread = (np.abs(rng.normal(0, 0.2, count)) for _ in range(2))
    largest[0] = spread[0] = 1.0
    return Model(embeddings, filters, np.zeros(count, np.float32), largest, spread, -2.0)


class _Adagrad:
    def __init__(self, values: np.ndarray):
        self.values, self.seen = values, np.full(values.shape, 1e-2, np.float64 if values.dtype == np.float64 else np.float32)

    def step(self, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        self.seen[rows] += gradient * gradient
        self.values[rows] -= RATE * gradient / np.sqrt(self.seen[rows])


def _train_batch(model: Model, rules: dict[str, _Adagrad], docs: list[np.ndarray], pieces: Pieces, labels: np.ndarray) -> None:
    """One step of gradient descent; ``docs`` hold word numbers."""
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    used, where = np.unique(np.concatenate(docs), return_inverse=True)
    own = pieces.take(used)
    vectors = model.vectors(own)
    ids = _padded(where + 1, sizes)
    z = _responses(vectors @ model.filters, ids, model.bias)
    count = FILTERS * len(WIDTHS)
    bounds = _quarters(sizes)
    parts = zip(bounds[:, :-1].ravel(), bounds[:, 1:].ravel())
    places = np.stack([a + z[a:b].argmax(axis=0) for a, b in parts]).reshape(len(docs), PARTS, count)
    hidden = np.maximum(z[places, np.arange(count)], 0).astype(np.float64)
    slope = (1 / (1 + np.exp(-np.clip(model.raw(hidden), -30, 30))) - labels) / len(docs)
    top = hidden.argmax(axis=1)[:, None, :] == np.arange(PARTS)[None, :, None]
    back = slope[:, None, None] * (model.largest * top + model.spread / PARTS) * (hidden > 0)
    d_vectors, d_filters = np.zeros_like(vectors), np.zeros_like(model.filters)
    for at, width in enumerate(WIDTHS):
        mine = slice(at * FILTERS, (at + 1) * FILTERS)
        g = back[:, :, mine].reshape(-1, FILTERS).astype(np.float32)
        for offset in range(width):
            columns = _columns(width, offset)
            words = ids[places[:, :, mine].reshape(-1, FILTERS) + offset]
            d_filters[:, columns] += np.einsum("bf,bfd->df", g, vectors[words])
            np.add.at(d_vectors, words.ravel(), (g[:, :, None] * model.filters[:, columns].T[None]).reshape(-1, DIM))
    touched = np.flatnonzero(np.abs(d_vectors[1:]).sum(axis=1))
    if len(touched):
        theirs = own.take(touched)
        share = np.repeat(d_vectors[touched + 1] / theirs.sizes[:, None].astype(np.float32), theirs.sizes, axis=0)
        rows, at = np.unique(theirs.flat, return_inverse=True)
        d_rows = np.zeros((len(rows), DIM), np.float32)
        np.add.at(d_rows, at, share)
        rules["embeddings"].step(d_rows, rows)
    rules["filters"].step(d_filters)
    rules["bias"].step(back.sum(axis=(0, 1)).astype(np.float32))
    rules["largest"].step(slope @ hidden.max(axis=1) + 1e-4 * model.largest)
    rules["spread"].step(slope @ hidden.mean(axis=1) + 1e-4 * model.spread)
    model.offset -= RATE * float(slope.sum())


def _platt(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic fit by Newton's method; targets are drawn in a little."""
    pos, neg = (weights * labels).sum(), (weights * (1 - labels)).sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([raw, np.ones_like(raw)])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        pull = np.array([1e-2, 1e-4]) * (beta - [1.0, 0.0])
        grad = x.T @ (weights * (p - target)) + pull
        hess = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-4])
        move = np.linalg.solve(hess, grad)
        beta -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def _best_cut(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The cut of largest F1, in the middle of the gap around it."""
    order = np.argsort(-scores)
    s, hit = scores[order], np.cumsum((weights * labels)[order])
    f1 = 2 * hit / (np.cumsum(weights[order]) + hit[-1])
    at = int(f1.argmax())
    return float((s[at] + (s[at + 1] if at + 1 < len(s) else 0.0)) / 2)


def _log_loss(p: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum())


def _numbered(texts: list[str]) -> tuple[list[np.ndarray], Pieces]:
    """The words of texts by number, and the buckets of the numbers."""
    numbers: dict[str, int] = {}
    docs = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words_of(t)), np.int64) for t in texts]
    return docs, Pieces.of(list(numbers))


def _steps(docs: list[np.ndarray], order: np.ndarray) -> Iterator[np.ndarray]:
    """``order`` in steps of ``BATCH`` texts, fewer if they hold more than ``CHUNK_WORDS`` words."""
    first, size = 0, 0
    for at, doc in enumerate(order):
        if at > first and (at - first == BATCH or size + len(docs[doc]) > CHUNK_WORDS):
            yield order[first:at]
            first, size = at, 0
        size += len(docs[doc])
    if first < len(order):
        yield order[first:]


def _learn(model: Model, rules: dict[str, _Adagrad], docs: list[np.ndarray], pieces: Pieces, labels: np.ndarray, order: np.ndarray) -> None:
    for step in _steps(docs, order):
        _train_batch(model, rules, [docs[i] for i in step], pieces, labels[step])


_TRAINED = ("embeddings", "filters", "bias", "largest", "spread")


def _copy(model: Model) -> Model:
    return replace(model, **{name: getattr(model, name).copy() for name in _TRAINED})


def _constant(share: float) -> Model:
    count = FILTERS * len(WIDTHS)
    nothing = (np.zeros(n, np.float32) for n in ((1, DIM), (DIM, FILTERS * sum(WIDTHS)), count, count, count))
    return Model(*nothing, constant=share)


def _share(toxic: float, all_rows: float) -> float:
    """The share of toxic labels, drawn in a little; 0 without labels."""
    return float((toxic + 1) / (all_rows + 2)) if all_rows else 0.0


def train(rows: pd.DataFrame, seed: int = 7) -> Model:
    """Fit on rows (label_id, label, text, lang, aside) in one task; rows ``aside`` calibrate, the others train.

    Without rows of both labels the model is the constant share of toxic labels.
    """
    rows = rows.sort_values(["label", "label_id", "text"], ignore_index=True)
    labels, aside = rows["label"].to_numpy(np.float64), rows["aside"].to_numpy(bool)
    weight = np.ones(len(rows))
    rng = np.random.default_rng(seed)
    if len(rows) == 0 or labels[~aside].min(initial=1) == labels[~aside].max(initial=0) or not (~aside).any():
        return _constant(_share(labels.sum(), len(rows)))
    texts = rows["text"].tolist()
    docs, pieces = _numbered(texts)
    fit, check = np.flatnonzero(~aside), np.flatnonzero(aside)
    if len(set(labels[check])) < 2:
        check = fit
    seen = np.zeros((2, BUCKETS), np.float32)
    _count_buckets(seen, [docs[i] for i in fit], pieces, labels[fit])
    model = _initial(seen, labels[fit].mean(), rng)
    rules = {name: _Adagrad(getattr(model, name)) for name in _TRAINED}
    best, loss = model, np.inf
    # Small tables are gone through more often.
    for _ in range(max(EPOCHS, min(40, 3000 // len(fit)))):
        _learn(model, rules, docs, pieces, labels, rng.permutation(fit))
        raw = Scorer(model).raw([texts[i] for i in check])
        model.slope, model.shift = _platt(raw, labels[check], weight[check])
        now = _log_loss(model.probability(raw), labels[check], weight[check])
        if now < loss:
            loss, best = now, _copy(model)
    scores = best.probability(Scorer(best).raw([texts[i] for i in check]))
    langs = rows["lang"].astype(object).where(rows["lang"].notna(), None).to_numpy()[check]
    for lang in sorted({x for x in langs if x is not None}):
        own = langs == lang
        if min(labels[check][own].sum(), (1 - labels[check][own]).sum()) >= LEAST_LABELS:
            best.thresholds[lang] = _best_cut(scores[own], labels[check][own], weight[check][own])
    return best


# What tasks send of a model: by block of buckets the buckets, their steps and how
# much Adagrad has seen; in block -1 the other weights.
_STEPS_SCHEMA = "block int, part int, at binary, steps binary, seen binary"


def _by_block(at: np.ndarray, steps: np.ndarray, seen: np.ndarray) -> pd.DataFrame:
    cuts = np.flatnonzero(np.diff(at // BLOCK_BUCKETS)) + 1
    parts = [x for x in zip(np.split(at, cuts), np.split(steps, cuts), np.split(seen, cuts)) if len(x[0])]
    part = TaskContext.get().partitionId()
    told = [(int(a[0]) // BLOCK_BUCKETS, part, a.astype("<i4").tobytes(), x.astype("<f4").tobytes(), y.astype("<f4").tobytes()) for a, x, y in parts]
    return pd.DataFrame(told, columns=["block", "part", "at", "steps", "seen"])


def _count_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen = np.zeros((2, BUCKETS), np.float32)
    for batch in batches:
        docs, pieces = _numbered(batch["text"].tolist())
        _count_buckets(seen, docs, pieces, batch["label"].to_numpy())
    at = np.flatnonzero(seen.any(axis=0))
    yield _by_block(at, seen[0, at], seen[1, at])


def _learn_part(shared):
    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given, seen = shared.value
        model = _copy(given)
        rules = {name: _Adagrad(getattr(model, name)) for name in _TRAINED}
        for name, rule in rules.items():
            rule.seen = seen[name].copy()
        rows = 0
        for batch in batches:
            docs, pieces = _numbered(batch["text"].tolist())
            _learn(model, rules, docs, pieces, batch["label"].to_numpy(np.float64), np.arange(len(batch)))
            rows += len(batch)
        if not rows:
            return
        at = np.flatnonzero((rules["embeddings"].seen != seen["embeddings"]).any(axis=1))
        moved = (model.embeddings - given.embeddings)[at], (rules["embeddings"].seen - seen["embeddings"])[at]
        yield _by_block(at, *moved)
        dense = {n: (getattr(model, n) - getattr(given, n), rules[n].seen - seen[n]) for n in _TRAINED[1:]}
        told = (-1, TaskContext.get().partitionId(), b"", pickle.dumps((dense, model.offset - given.offset)), b"")
        yield pd.DataFrame([told], columns=["block", "part", "at", "steps", "seen"])

    return learn


def _added(width: int, averaged: bool):
    """The steps of a block from all tasks: added, or averaged over the tasks that moved a bucket."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        first = group.iloc[:1].copy()
        if first["block"].iloc[0] < 0:
            return group
        base = int(first["block"].iloc[0]) * BLOCK_BUCKETS
        steps, seen = np.zeros((2, BLOCK_BUCKETS, width))
        tasks = np.zeros((BLOCK_BUCKETS, 1))
        for at, x, y in zip(group["at"], group["steps"], group["seen"]):
            own = np.frombuffer(at, "<i4") - base
            steps[own] += np.frombuffer(x, "<f4").reshape(-1, width)
            seen[own] += np.frombuffer(y, "<f4").reshape(-1, width)
            tasks[own] += 1
        own = np.flatnonzero(tasks)
        if averaged:
            steps /= np.maximum(tasks, 1)
        first["at"] = [(own + base).astype("<i4").tobytes()]
        first["steps"], first["seen"] = [steps[own].astype("<f4").tobytes()], [seen[own].astype("<f4").tobytes()]
        return first

    return add


def _arrays(row, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row.at, "<i4"), *(np.frombuffer(x, "<f4").reshape(-1, width) for x in (row.steps, row.seen))


def _next_model(fit_rows: DataFrame, model: Model, seen: dict[str, np.ndarray], parts: int, turn: int) -> Model:
    """One pass over all rows in ``parts`` streams; ``seen`` is brought up to date."""
    shared = fit_rows.sparkSession.sparkContext.broadcast((model, seen))
    # Other rows follow one another in each pass.
    dealt = fit_rows.select("label_id", "label", "text").repartition(parts, "label_id")
    dealt = dealt.sortWithinPartitions(F.xxhash64(F.lit(turn), "label_id"), "label_id", "text")
    told = dealt.mapInPandas(_learn_part(shared), _STEPS_SCHEMA).groupBy("block").applyInPandas(_added(DIM, True), _STEPS_SCHEMA)
    rows = sorted(told.collect(), key=lambda r: (r.block, r.part))
    shared.unpersist()
    model = _copy(model)
    others = [pickle.loads(r.steps) for r in rows if r.block < 0]
    for name in _TRAINED[1:]:
        getattr(model, name)[...] += sum(dense[name][0] for dense, _ in others) / len(others)
        seen[name] += sum(dense[name][1] for dense, _ in others)
    model.offset += sum(offset for _, offset in others) / len(others)
    for row in (r for r in rows if r.block >= 0):
        at, steps, more = _arrays(row, DIM)
        model.embeddings[at] += steps
        seen["embeddings"][at] += more
    return model


def _outputs_of(rows: DataFrame, model: Model) -> DataFrame:
    """How many rows have a language, label and raw output, told apart to ``RAW_DIGITS`` digits; stored."""
    raw = F.round(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), _output_column(rows.sparkSession, model, F.col("text"), False))), RAW_DIGITS)
    told = rows.select("lang", "label", raw.alias("raw")).groupBy("lang", "label", "raw").agg(F.count(F.lit(1)).alias("n"))
    return materialise(told, "toxic_outputs")


def train_in_parts(rows: DataFrame, seed: int = 7) -> Model:
    """``train`` for any number of stored rows: tasks learn a part each, pass by pass."""
    counts = {(r.aside, r.label): r.n for r in rows.groupBy("aside", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = (counts.get((False, label), 0) for label in (0, 1))
    if not clean or not toxic:
        return _constant(_share(toxic + counts.get((True, 1), 0), sum(counts.values())))
    fit_rows = rows.where("NOT aside")
    check = rows.where("aside") if counts.get((True, 0)) and counts.get((True, 1)) else fit_rows
    parts = min(MOST_PARTS, -(-(clean + toxic) // PART_ROWS))
    counted = fit_rows.select("label", "text").mapInPandas(_count_part, _STEPS_SCHEMA)
    held = np.zeros((2, BUCKETS), np.float32)
    for row in counted.groupBy("block").applyInPandas(_added(1, False), _STEPS_SCHEMA).collect():
        at, *by_label = _arrays(row, 1)
        held[:, at] = np.hstack(by_label).T
    model = _initial(held, toxic / (clean + toxic), np.random.default_rng(seed))
    seen = {name: _Adagrad(getattr(model, name)).seen for name in _TRAINED}
    best, of_best, loss = model, None, np.inf
    for turn in range(max(LEAST_PASSES, -(-SEEN_ROWS // (clean + toxic)))):
        model = _next_model(fit_rows, model, seen, parts, turn)
        outputs = _outputs_of(check, model)
        told = outputs.groupBy("label", "raw").agg(F.sum("n").alias("n")).orderBy("label", "raw").toPandas()
        raw, labels, n = (told[c].to_numpy(np.float64) for c in ("raw", "label", "n"))
        model.slope, model.shift = _platt(raw, labels, n)
        now = _log_loss(model.probability(raw), labels, n)
        if now < loss:
            loss, best, of_best = now, model, outputs

    def cut(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["label", "raw"])
        labels, n = group["label"].to_numpy(np.float64), group["n"].to_numpy(np.float64)
        if min((n * labels).sum(), (n * (1 - labels)).sum()) < LEAST_LABELS:
            return pd.DataFrame({"lang": [], "cut": []})
        scores = 1 / (1 + np.exp(-np.clip(slope * group["raw"].to_numpy() + shift, -30, 30)))
        return pd.DataFrame({"lang": [key[0]], "cut": [_best_cut(scores, labels, n)]})

    slope, shift = best.slope, best.shift
    by_lang = of_best.where("lang IS NOT NULL").groupBy("lang").applyInPandas(cut, "lang string, cut double")
    return replace(best, thresholds={r.lang: r.cut for r in by_lang.collect()})


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Every labelled row outside the held-out fold: label_id, label, text, lang, aside (one id in five).

    A document with several labels counts as toxic if one of them says so; null
    ids and labels are left out. Rows that share an id count once if they are equal.
    """
    own = (
        labels.where(f"{id_col} IS NOT NULL AND toxic IN (0, 1)")
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.max("toxic").alias("label"))
        .where(fold_of(F.col("label_id")) != HELD_OUT_FOLD)
    )
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    # Of the documents' columns these three alone, whatever the others are called.
    known = docs.select(F.col(id_col).alias("known_id"), present(F.col(text_col)).alias("text"), lang.alias("lang"))
    found = known.join(own, F.col("known_id") == F.col("label_id")).select("label_id", "label", "text", "lang").distinct()
    return found.withColumn("aside", F.pmod(F.xxhash64(F.lit("aside"), "label_id"), F.lit(5)) == 0)


def _train_in_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = list(batches)
    if parts:
        yield pd.DataFrame({"model": [pickle.dumps(train(pd.concat(parts, ignore_index=True)))]})


def _output_column(spark: SparkSession, model: Model, text: Column, probable: bool) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        scorer = Scorer(own)
        for batch in batches:
            if own.constant is not None:
                yield pd.Series(np.full(len(batch), own.constant))
            else:
                raw = scorer.raw(batch.tolist())
                yield pd.Series(own.probability(raw) if probable else raw)

    return score(present(text))


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """Probability that a text is toxic; null and empty texts are scored as texts without words."""
    return _output_column(spark, model, text, True)


def threshold_column(model: Model, lang: Column) -> Column:
    """The language's threshold, or the common cut."""
    found = [F.when(lang == k, F.lit(v)) for k, v in sorted(model.thresholds.items())]
    return F.coalesce(*found, F.lit(CUT))


def fit(docs: DataFrame, labels: DataFrame, **columns) -> Model:
    """Learn from every labelled row, few of them in one task, which is run again elsewhere if its executor is lost."""
    # Rows are long: small batches keep what Arrow hands over bounded.
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    rows = materialise(training_sample(docs, labels, **columns), "toxic_labelled")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text").cast("bigint")).alias("chars")).first()
    if size.n > ALONE_ROWS or (size.chars or 0) > ALONE_CHARS:
        return train_in_parts(rows)
    trained = rows.repartition(1).mapInPandas(_train_in_task, "model binary").collect()
    return pickle.loads(trained[0].model) if trained else train(rows.limit(0).toPandas())


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, lang_threshold, flagged.

    The score depends on the text alone. ``predicted`` cuts it at ``CUT``,
    ``flagged`` at the threshold of the document's language. Null ids are in no
    fold; repeated rows each get a row; without labels of both kinds every score
    is the share of toxic labels. Other columns are ignored.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, lang_col=lang_col)
    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(fold_of(F.col(id_col)) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        score_column(docs.sparkSession, model, F.col(text_col)).alias("score"),
        threshold_column(model, lang).alias("lang_threshold"),
    )
    return rows.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0)).withColumn(
        "flagged", F.col("score") >= F.col("lang_threshold")
    )


def remove_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold of their language.

    A model that was given no two kinds of labels tells nothing apart and removes nothing.
    """
    model = fit(docs, labels, text_col=text_col, lang_col=lang_col)
    if model.constant is not None:
        return docs
    lang = docs[lang_col] if lang_col in docs.columns else F.lit(None).cast("string")
    return docs.where(score_column(docs.sparkSession, model, docs[text_col]) < threshold_column(model, lang))
