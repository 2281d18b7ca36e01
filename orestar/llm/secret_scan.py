"""Secrets in text: fixed patterns, and strings that a battery of randomness tests takes for random.

A candidate is a long run of the characters secrets are written in. Its encoding
is the smallest alphabet that holds it. Two questions are asked of it. Is it too
even for ordinary text? The sum of squared letter counts is compared with what
the letters of the rest of its document would give, as a lower-tail p-value. And can it
be random? Chi-squared uniformity over the alphabet, a runs test about the
alphabet's middle and the lag-one serial correlation must all let it pass.

The first p-values are thresholded by Benjamini and Hochberg's rule within each
encoding and class of length, because short strings are many and say little.
Counts for the rule come from all documents, as a histogram of fixed size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestar.workspace import materialise

ASSIGN = re.compile(
    r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
KINDS = ("assign", "access", "hex", "random")

# The alphabets a secret may be written in, smallest first.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "+-/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz",
}
_INDEX = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}

# Letters of Latin-script prose in groups of falling frequency, each about half
# as frequent as the one before.
COMMON_LETTERS = ("eatinos", "rhldcu", "mfpgwyb", "vkxjqz")

FALSE_DISCOVERIES = 0.01
RANDOM_LEVEL = 0.001
# p-values are counted in steps of this size of their natural logarithm.
_STEP = 0.25
_LOWEST = 400

SCANNED = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base string,"
    " base_spans array<struct<start:bigint,kind:int,end:bigint>>,"
    " candidates array<struct<start:bigint,end:bigint,encoding:string,length_class:int,step:int>>"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order of start and kind."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def encoding_of(token: str) -> str:
    used = set(token)
    return next(name for name, index in _INDEX.items() if used <= index.keys())


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity_p(codes: np.ndarray, size: int) -> float:
    """Upper-tail p-value of chi-squared against equal shares (Wilson-Hilferty)."""
    counts = np.bincount(codes, minlength=size)
    n, free = len(codes), size - 1
    x = float((counts.astype(float) ** 2).sum()) * size / n - n
    return _normal_tail(((x / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)))


def runs_p(codes: np.ndarray, size: int) -> float:
    """Two-sided p-value of the number of runs above and below the middle of the alphabet."""
    high = codes * 2 >= size
    n, a = len(codes), int(high.sum())
    b = n - a
    if not a or not b:
        return 0.0 if n >= 20 else 1.0
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + int((high[1:] != high[:-1]).sum())
    return 2 * _normal_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0


def serial_p(codes: np.ndarray) -> float:
    """Two-sided p-value of the lag-one serial correlation."""
    x = codes - codes.mean()
    power = float((x * x).sum())
    if not power:
        return 0.0
    r = float((x[1:] * x[:-1]).sum()) / power
    n = len(codes)
    return 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n))


def ordinary_ln_p(codes: np.ndarray, shares: np.ndarray) -> float:
    """Logarithm of the chance that ordinary text is as even: pairs of equal letters against ``shares``."""
    counts = np.bincount(codes, minlength=len(shares)).astype(float)
    n = len(codes)
    pairs = float((counts * (counts - 1)).sum())
    two, three = float((shares**2).sum()), float((shares**3).sum())
    mean = n * (n - 1) * two
    var = 2 * n * (n - 1) * (two + 2 * (n - 2) * three - (2 * n - 3) * two * two)
    z = (pairs - mean) / math.sqrt(max(var, 1e-9))
    if z < -30:
        return -z * z / 2
    return math.log(max(0.5 * math.erfc(-z / math.sqrt(2)), 1e-200))


def _counts(text: str) -> np.ndarray:
    return np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)[:128].astype(float)


def _usual_counts() -> np.ndarray:
    """Some ordinary text that every document is taken to have besides its own, so that no character is impossible."""
    counts = np.full(128, 0.05)
    for rank, letters in enumerate(COMMON_LETTERS):
        counts[[ord(c) for c in letters]] = 12.0 / 2**rank
    return counts


_USUAL = _usual_counts()


def candidate_rows(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Candidates that overlap no base span; those that cannot be random count as tests with a p-value of 1."""
    found, letters = [], None
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for s, _, e in base):
            continue
        name = encoding_of(m[0])
        index = _INDEX[name]
        codes = np.fromiter((index[c] for c in m[0]), np.int64, end - start)
        size = len(index)
        ln_p = 0.0
        if min(uniformity_p(codes, size), runs_p(codes, size), serial_p(codes)) >= RANDOM_LEVEL:
            if letters is None:
                letters = _counts(text)
            shares = (letters - _counts(m[0]) + _USUAL)[[ord(c) for c in ALPHABETS[name]]]
            ln_p = ordinary_ln_p(codes, shares / shares.sum())
        found.append(
            {
                "start": start,
                "end": end,
                "encoding": name,
                "length_class": int(math.log2((end - start) / 20) * 2),
                "step": min(_LOWEST, int(-ln_p / _STEP)),
            }
        )
    return found


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            text = text or ""
            base = base_spans(text)
            n = Counter(kind for _, kind, _ in base)
            spans = [{"start": s, "kind": k, "end": e} for s, k, e in base]
            rows.append((doc_id, n[0], n[1], n[2], _written(base), spans, candidate_rows(text, base)))
        columns = ["doc_id", "n_assign", "n_access", "n_hex", "base", "base_spans", "candidates"]
        frame = pd.DataFrame(rows, columns=columns)
        yield frame.astype({"doc_id": "Int64"})


def thresholds(histogram: list[tuple[str, int, int, int]], tests: dict[tuple[str, int], int], level: float) -> dict:
    """Smallest step to report per (encoding, length class): the step-up rule on binned p-values."""
    found = {}
    for stratum in tests:
        steps = sorted(((s, n) for e, c, s, n in histogram if (e, c) == stratum), reverse=True)
        seen = 0
        for step, n in steps:
            seen += n
            if math.exp(-step * _STEP) * tests[stratum] <= level * seen:
                found[stratum] = step
    return found


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: float = FALSE_DISCOVERIES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base, spans.

    ``base`` has the spans of the fixed patterns, ``spans`` those and the random
    strings, as kind:start:end in code points. ``level`` bounds the expected share
    of ordinary strings among the random ones of an encoding and length class.

    Null and empty texts have no spans. Repeated rows and null ids each get a row;
    ids are integers. Other columns are ignored. Texts are scanned whole.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scanned = materialise(rows.mapInPandas(_scan, SCANNED), "secret_scan")
    counted = (
        scanned.select(F.explode("candidates").alias("c"))
        .groupBy("c.encoding", "c.length_class", "c.step")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    histogram = [(r.encoding, r.length_class, r.step, r.n) for r in counted]
    tests = Counter()
    for encoding, length_class, _, n in histogram:
        tests[encoding, length_class] += n
    least = thresholds(histogram, tests, level)
    cases = [f"c.encoding = '{e}' AND c.length_class = {k} AND c.step >= {s}" for (e, k), s in sorted(least.items())]
    reported = f"filter(candidates, c -> {' OR '.join(f'({x})' for x in cases) or 'false'})"
    random = f"transform({reported}, c -> named_struct('start', c.start, 'kind', {KINDS.index('random')}, 'end', c.end))"
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    spans = (
        f"array_join(transform(array_sort(concat(base_spans, {random})),"
        f" s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')"
    )
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", "base", F.expr(spans).alias("spans"))
