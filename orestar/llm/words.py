"""Words of whole texts as arrays, for operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that end a word. White space of the contracts; and all of
# ASCII but digits and letters.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NO_TERM = np.zeros(256, bool)
NO_TERM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20
AS_GIVEN = np.arange(256, dtype=np.uint8)


@dataclass
class Words:
    """The words of a number of texts: text ``i`` has words ``first[i]`` to ``first[i + 1]``."""

    each: pa.BinaryArray
    first: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def joined(self, chosen: np.ndarray, per_text: np.ndarray, by: bytes = b" ") -> pa.Array:
        """Words at ``chosen`` with ``by`` between them; the first ``per_text[0]`` are the first text's, and so on."""
        ends = pa.array(np.append(0, np.cumsum(per_text)), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(ends, self.each.take(pa.array(chosen))), by)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of all texts and where each begins; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def words_of(texts: pa.Array, ends: np.ndarray = WHITE, folded: np.ndarray = LOWERED) -> Words:
    """Maximal runs of bytes that are not in ``ends``, folded byte by byte."""
    data, offsets = bytes_of(texts)
    if not len(data):
        return Words(pa.array([], pa.binary()), np.zeros(len(offsets), np.int64))
    inside = ~ends[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    # A word ends with its text.
    full = np.diff(offsets) > 0
    edge = offsets[:-1][full]
    begins[edge] = inside[edge]
    edge = offsets[1:][full] - 1
    stops[edge] = inside[edge]
    at = np.flatnonzero(begins)
    sizes = np.flatnonzero(stops) + 1 - at
    letters = folded[data[inside]]
    bounds = np.append(0, np.cumsum(sizes))
    each = pa.BinaryArray.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(letters)]
    )
    return Words(each, np.searchsorted(at, offsets))


def sized_slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about ``most_bytes``; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most_bytes:
            yield batch.slice(start, i - start)
            total, start = 0, i
        total += size
    if start < len(sizes):
        yield batch.slice(start)
