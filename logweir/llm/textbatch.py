"""Words, word hashes and n-gram hashes of a batch of texts, as numpy arrays.

All texts of a chunk are handled at once, over their UTF-8 bytes. Every text is
followed by a newline, which no word contains, so no word spans two texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from logweir.llm.frames import slices

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Bytes of text handled at once (a longer text makes a chunk of its own), and hashed at once.
CHUNK_BYTES = 2 << 20
_HASH_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true inside the ranges (ends included)."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: ``[^\x20\x09-\x0D]+``: anything but ASCII white space.
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: after lower-casing, digits, a-z and all beyond ASCII.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte; A-Z have those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    values[0x41:0x5B] = values[0x61:0x7B]
    return values


_VALUES = _byte_values()


class Chunk(NamedTuple):
    """Texts ``first .. first + len(offsets) - 2`` of a batch, as bytes."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Byte ranges of all words of a chunk, and the first word of each text."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """For each word, the row in the chunk that it belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def chunks(texts: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts (null: empty), each with a newline after it, in pieces of about ``size`` bytes.

    Only one piece at a time is copied.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    nothing, newline = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    for first, rows in slices(texts, size):
        piece = pc.fill_null(texts.slice(first, rows).cast(pa.large_string()), "")
        ended = pc.binary_join_element_wise(piece, nothing, newline)
        _, offset_buffer, data_buffer = ended.buffers()
        offsets = np.frombuffer(offset_buffer, dtype=np.int64)[ended.offset :][: rows + 1]
        data = np.frombuffer(data_buffer, dtype=np.uint8)
        yield Chunk(first, data[offsets[0] : offsets[-1]], offsets - offsets[0])


def find_words(chunk: Chunk, is_word: np.ndarray) -> Words:
    inside = is_word[chunk.data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0))).astype(np.int64)
    start, end = edges[0::2], edges[1::2]
    return Words(start, end, np.searchsorted(start, chunk.offsets))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, A-Z as a-z. Ranges are in order of their starts."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        low = int(start[i])
        j = int(np.searchsorted(start, low + _HASH_BYTES))
        j = max(j, i + 1)
        high = int(end[i:j].max())
        power = _powers(_BASE, high - low)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data[low:high]] * power, out=sums[1:])
        back = _powers(_BASE_INV, high - low)
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64))
        i = j
    return out


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words (by their hashes), across texts too."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    size = len(words) - n + 1
    factors = _powers(_BASE, n + 1)[1:]
    total = words[:size] * factors[0]
    for k in range(1, n):
        total = total + words[k : k + size] * factors[k]
    return mix(total + np.uint64(n))


def seeded(words: np.ndarray, seed: int) -> np.ndarray:
    """Another hash of the same values."""
    return mix(words + np.uint64((seed * _BASE) & _MASK))


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)
