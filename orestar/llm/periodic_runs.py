"""Stretches of words that repeat with a period, found in a grammar of the words.

Re-Pair replaces word pairs that occur more than once by nonterminals, most
frequent first, until no pair of a text occurs twice. What is left of a text is
split in halves down to its symbols. A run that is longer than one word then
crosses the boundary between the two parts of exactly one smallest node of this
tree. So it is enough to look for runs across one boundary in each node: for a
nonterminal once, at its first occurrence, whatever the number of its
occurrences. What is found there is translated to all of them, and pieces of one
run are merged.

A run of four periods or more has two of them on one side of the boundary. A
period is a candidate there only if the words next to the boundary come again
after it; how far it holds is found by binary search on hashes of word sequences,
and each run is confirmed word by word in the end.

Pairs of one text never meet those of another, so texts are compressed side by
side, as many at a time as make up ``SLICE`` bytes. Nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orestar.llm.words import AS_GIVEN, WHITE, Words, sized_slices, words_of

LEAST_LENGTH = 6
LEAST_PERIODS = 4
# Bytes of text handled at a time.
SLICE = 4 << 20


class Sequence:
    """A word sequence in which stretches are compared by hash."""

    def __init__(self, words: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        # Odd, so that powers never become zero.
        base = rng.integers(0, 2**63, dtype=np.uint64) | np.uint64(1)
        codes = rng.integers(0, 2**63, int(words.max(initial=0)) + 1, dtype=np.uint64)
        self.words, self.seed = words, seed
        self.powers = np.full(len(words) + 1, base)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(codes[words] * self.powers[:-1], out=self.sums[1:])

    def same(self, a: np.ndarray, shift: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words from ``a`` on are those ``shift`` later."""
        one = (self.sums[a + length] - self.sums[a]) * self.powers[shift]
        return one == self.sums[a + shift + length] - self.sums[a + shift]

    def reach(self, a: np.ndarray, shift: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """Number of words from ``a`` on (or before ``a``) that equal those ``shift`` later, at most ``most``."""
        low, high = np.zeros_like(a), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            holds = self.same(a - middle if back else a, shift, middle)
            low, high = np.where(holds, middle, low), np.where(holds, high, middle - 1)
        return low


def _counted(most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, 1), ..., (i, most[i]) for every i."""
    i = np.repeat(np.arange(len(most)), most)
    return i, np.arange(1, len(i) + 1) - (np.cumsum(most) - most)[i]


def crossing_runs(text: Sequence, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of periodic stretches of ``low`` to ``high`` with two periods on a side of ``middle``."""
    words, found = text.words, []
    length = high - low
    for right, side in ((True, high - middle), (False, middle - low)):
        most = np.where(length >= LEAST_LENGTH, np.minimum(side // 2, length // LEAST_PERIODS), 0)
        node, period = _counted(most)
        # The first word of two periods to the right, or the last of two to the left.
        anchor = middle[node] if right else middle[node] - period
        next_to = anchor if right else middle[node] - 1 - period
        near = words[next_to] == words[next_to + period]
        node, period, anchor = node[near], period[near], anchor[near]
        twice = text.same(anchor if right else anchor - period, period, period)
        node, period, anchor = node[twice], period[twice], anchor[twice]
        after = text.reach(anchor, period, high[node] - anchor - period, back=False)
        before = text.reach(anchor, period, anchor - low[node], back=True)
        found.append((node, anchor - before, anchor + period + after, period))
    node, start, end, period = (np.concatenate(x) for x in zip(*found))
    long = end - start >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * period)
    return _smallest_periods(node[long], start[long], end[long], period[long])


def _smallest_periods(node: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of equal stretches the one with the smallest period: the others are multiples of it."""
    order = np.lexsort((period, end, start, node))
    node, start, end, period = node[order], start[order], end[order], period[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[new], start[new], end[new], period[new]


def _every_second(at: np.ndarray, twin: np.ndarray) -> np.ndarray:
    """False for pairs that overlap the one before, in stretches of one symbol."""
    goes_on = np.zeros(len(at), bool)
    goes_on[1:] = twin[1:] & twin[:-1] & (at[1:] == at[:-1] + 1)
    place = np.arange(len(at))
    begun = np.maximum.accumulate(np.where(goes_on, 0, place))
    return (place - begun) % 2 == 0


def grammar(symbols: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Re-Pair of texts side by side; yields (rule, low, middle, high) of all occurrences of new nonterminals.

    Equal symbols stand for equal words of one text. In a round each pair that is
    more frequent than both pairs it overlaps is replaced; the most frequent pair
    of a text always is. Last come the nodes of the balanced trees over what is
    left, each a rule of its own.
    """
    place = np.arange(len(symbols))
    stop = len(symbols)
    last = np.zeros(len(symbols), bool)
    last[first[1:][np.diff(first) > 0] - 1] = True
    symbols, named = symbols.copy(), int(symbols.max(initial=0)) + 1
    while len(symbols) > 1:
        frequent = np.bincount(symbols, minlength=named)[symbols] > 1
        at = np.flatnonzero(frequent[:-1] & frequent[1:] & ~last[:-1])
        at = at[_every_second(at, symbols[at] == symbols[at + 1])]
        _, pair, count = np.unique(symbols[at] * named + symbols[at + 1], return_inverse=True, return_counts=True)
        often = count[pair] > 1
        at, pair = at[often], pair[often]
        if not len(at):
            break
        rank = np.zeros(len(symbols) + 1, np.int64)
        rank[at] = count[pair] * len(count) + pair + 1
        won = (rank[at] > rank[at - 1]) & (rank[at] > rank[at + 1])
        at, pair = at[won], pair[won]
        left = np.bincount(pair, minlength=len(count))
        at, pair = at[left[pair] > 1], pair[left[pair] > 1]
        ends = np.append(place, stop)
        rules, rule = np.unique(pair, return_inverse=True)
        yield rule, ends[at], ends[at + 1], ends[at + 2]
        symbols[at] = named + rule
        named += len(rules)
        last[at] = last[at + 1]
        kept = np.ones(len(symbols), bool)
        kept[at + 1] = False
        symbols, place, last = symbols[kept], place[kept], last[kept]
    yield from _halves(place, last, stop)


def _halves(place: np.ndarray, last: np.ndarray, stop: int) -> Iterator[tuple[np.ndarray, ...]]:
    ends = np.append(place, stop)
    closes = np.flatnonzero(last) + 1
    opens = np.append(0, closes)[:-1]
    size = 1
    while (closes - opens).max(initial=0) > size:
        node, step = _counted((closes - opens - size + 2 * size - 1) // (2 * size))
        low = opens[node] + (step - 1) * 2 * size
        high = np.minimum(low + 2 * size, closes[node])
        yield np.arange(len(low)), ends[low], ends[low + size], ends[high]
        size *= 2


def _merged(text: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of one text and period that share a period or more are one run."""
    order = np.lexsort((end, start, period, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    # Ends so far, within the group of text and period.
    group = np.zeros(len(text), np.int64)
    group[1:] = np.cumsum((text[1:] != text[:-1]) | (period[1:] != period[:-1]))
    wide = int(end.max(initial=0)) + 1
    so_far = np.maximum.accumulate(end + group * wide) - group * wide
    new = np.ones(len(text), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] + period[1:] > so_far[:-1])
    begins = np.flatnonzero(new)
    ends = np.maximum.reduceat(end, begins) if len(begins) else end
    return _smallest_periods(text[begins], start[begins], ends, period[begins])


def _is_run(words: np.ndarray, first: int, stop: int, start: int, end: int, period: int) -> bool:
    if (words[start : end - period] != words[start + period : end]).any():
        return False
    open_left = start > first and words[start - 1] == words[start - 1 + period]
    return not open_left and not (end < stop and words[end] == words[end - period])


def periodic_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, end, period) of all runs, by text, start and period; text ``i`` is ``first[i]`` to ``first[i + 1]``.

    ``words`` has a number for each word. Places count from the first text on.
    """
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    _, symbols = np.unique(owner * (int(words.max(initial=0)) + 1) + words, return_inverse=True)
    nodes = list(grammar(symbols, first))
    seed = 1
    while True:
        text = Sequence(words, seed)
        found = []
        for rule, low, middle, high in nodes:
            large = high - low >= LEAST_LENGTH
            rule, low, middle, high = rule[large], low[large], middle[large], high[large]
            order = np.argsort(rule, kind="stable")
            rule, low, middle, high = rule[order], low[order], middle[order], high[order]
            rules, one, many = np.unique(rule, return_index=True, return_counts=True)
            node, start, end, period = crossing_runs(text, low[one], middle[one], high[one])
            # To every occurrence of the rule: how far it lies from the first.
            run, turn = _counted(many[node])
            shift = low[one[node[run]] + turn - 1] - low[one[node[run]]]
            found.append((start[run] + shift, end[run] + shift, period[run]))
        if not found:
            return tuple(np.empty(0, np.int64) for _ in range(4))
        start, end, period = (np.concatenate(x) for x in zip(*found))
        owner, start, end, period = _merged(np.searchsorted(first, start, "right") - 1, start, end, period)
        if all(_is_run(words, first[i], first[i + 1], s, e, p) for i, s, e, p in zip(owner, start, end, period)):
            order = np.lexsort((period, start, owner))
            return owner[order], start[order], end[order], period[order]
        # Two different sequences had one hash.
        seed += 1


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """For a tenth of the ids: which word each word is replaced by, so that the text ends periodically."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or not n or h % 10:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % period)


def _digest(text: bytes) -> str:
    return sha256(text).hexdigest()


_RESULT = [
    *(StructField(n, LongType()) for n in ("n_runs", "start", "length", "period", "exponent_milli")),
    StructField("runs_sha256", StringType()),
    StructField("collapsed_sha256", StringType()),
]


def _described(runs: list[tuple[int, int, int]]) -> tuple:
    """The run of the greatest exponent, the earliest and shortest period of equals, and the digest of all."""
    best = None
    for start, length, period in runs:
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    text = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], _digest(text.encode()))


def _rows(ids: list, words: Words, replaced: np.ndarray | None) -> list[tuple]:
    """What is reported of each text, once its words are replaced as told."""
    first, per_text = words.first, words.per_text
    taken = np.arange(first[-1]) if replaced is None else replaced
    code = words.each.dictionary_encode().indices.to_numpy().astype(np.int64)[taken] if len(taken) else taken
    owner, start, end, period = periodic_runs(code, first)
    step = np.zeros(len(taken) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, end, -1)
    kept = np.cumsum(step)[:-1] == 0
    kept_before = np.append(0, np.cumsum(kept))
    collapsed = words.joined(taken[kept], np.diff(kept_before[first]))
    bounds = np.searchsorted(owner, np.arange(len(per_text) + 1))
    rows = []
    for i, doc_id in enumerate(ids):
        of = slice(bounds[i], bounds[i + 1])
        runs = list(zip((start[of] - first[i]).tolist(), (end[of] - start[of]).tolist(), period[of].tolist()))
        rows.append((doc_id, *_described(runs), sha256(collapsed[i].as_buffer()).hexdigest()))
    return rows


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, its run of the greatest exponent, digests of all runs and of the text without repeats.

    A run is a stretch with smallest period q and at least max(6, 4 q) words that
    no neighbouring word extends. The collapsed text drops what a run holds after
    its first q words. With ``plant``, a tenth of the texts are made to end
    periodically first, as told by their ids; a text without an id is left as it
    is. Words are parted by white space and compared as they are written.

    A null or empty text has no words, no runs and four nulls. Repeated rows and
    rows that share an id are each reported. Other columns are ignored.
    """
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = StructType([StructField("doc_id", kept.schema["doc_id"].dataType), *_RESULT])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sized_slices(batch, "text", SLICE):
                words = words_of(part.column("text"), WHITE, AS_GIVEN)
                ids = part.column("doc_id").to_pylist()
                taken = np.arange(words.first[-1])
                if plant:
                    for i, doc_id in enumerate(ids):
                        by = planted(doc_id, int(words.per_text[i]))
                        if by is not None:
                            taken[words.first[i] : words.first[i + 1]] = words.first[i] + by
                columns = [pa.array(c) for c in zip(*_rows(ids, words, taken))]
                columns[0] = part.column("doc_id")
                types = [pa.int64()] * 5 + [pa.string()] * 2
                columns[1:] = [c.cast(t) for c, t in zip(columns[1:], types)]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return kept.mapInArrow(report, out)
