"""Words of Arrow text batches as byte spans with 64-bit hashes, in numpy.

A batch of texts is one byte buffer; words are spans of it and never become
Python strings. A span's hash is a polynomial over its bytes, taken from prefix
sums, so every span costs the same however long it is. Two different words
share a hash with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = (1 << 20) - 64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text (or members of lists) each, one row at least."""
    values = batch.column(column)
    length = pc.list_value_length if pa.types.is_nested(values.type) else pc.binary_length
    sizes = np.cumsum(pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = int(sizes[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield batch.slice(start, end - start)
        start = end
    pa.default_memory_pool().release_unused()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes and the offsets of each; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]], cuts - cuts[0]


_powers = {BASE: np.ones(1, U64), INVERSE: np.ones(1, U64)}


def powers(base: int, count: int) -> np.ndarray:
    have = _powers[base]
    while len(have) < count:
        have = np.concatenate([have, have * U64(pow(base, len(have), 1 << 64))])
    _powers[base] = have
    return have[:count]


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    values = values.astype(U64, copy=True)
    values ^= values >> U64(30)
    values *= U64(0xBF58476D1CE4E5B9)
    values ^= values >> U64(27)
    values *= U64(0x94D049BB133111EB)
    values ^= values >> U64(31)
    return values


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(symbols) + 1, U64)
    np.cumsum((symbols.astype(U64) + U64(1)) * powers(BASE, len(symbols)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts])


class Words:
    """Word spans of a batch of texts.

    ``starts`` and ``ends`` are byte positions, ``first[i]:first[i + 1]`` the words
    of text ``i``, ``hashes`` their hashes with A-Z lower-cased.
    """

    def __init__(self, texts: pa.Array, alphabet: np.ndarray):
        raw, self.cuts = text_bytes(texts)
        self.raw = LOWER[raw]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = alphabet[raw]
        begins = inside[1:-1] & ~inside[:-2]
        stops = inside[1:-1] & ~inside[2:]
        edge = np.unique(self.cuts[(self.cuts > 0) & (self.cuts < len(raw))])
        begins[edge] = inside[1:-1][edge]
        stops[edge - 1] = inside[1:-1][edge - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, self.cuts)
        self.counts = np.diff(self.first)
        self._sums = None

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def sums(self) -> np.ndarray:
        if self._sums is None:
            self._sums = prefix_sums(self.raw)
        return self._sums

    def hashes_of(self, which) -> np.ndarray:
        return span_hash(self.sums, self.starts[which], self.ends[which])

    @property
    def hashes(self) -> np.ndarray:
        return self.hashes_of(slice(None))

    @property
    def text_of(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def strings(self, which) -> list[str]:
        raw = self.raw.tobytes()
        return [raw[s:e].decode("utf-8", "replace") for s, e in zip(self.starts[which], self.ends[which])]


def look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys``, and which of them are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def sums_by(owner: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=count)[:count]
