"""Words and shingles of Arrow text columns as 64-bit hashes, a whole column slice at a time.

Hashes identify words: two different words of a corpus share one with a probability of about 2^-60 per pair.
Offsets count UTF-8 bytes, since every separator is ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  #: text hashed at a time; keeps the working arrays in cache and memory bounded

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(int(_P), -1, 2**64))
_Q = np.uint64(0xD6E8FEB86659FD93)


def _classes(is_word) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: whether it belongs to a word, and its hash value (A-Z count as a-z)."""
    member = np.array([is_word(b + 32 if 65 <= b <= 90 else b) for b in range(256)])
    value = np.array([_BYTE[b + 32 if 65 <= b <= 90 else b] if member[b] else 0 for b in range(256)], dtype=np.uint64)
    return member, value


#: `[^\x20\x09-\x0D]+` after lower-casing A-Z
SPACED = _classes(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z
ALPHANUMERIC = _classes(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        tables = []
        for base in (_P, _P_INVERSE):
            steps = np.full(max(n, SLICE_BYTES), base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if n > 8 * SLICE_BYTES:  # not kept: one very long text must not enlarge the worker for good
            return tables[0], tables[1]
        _powers = (tables[0], tables[1])
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a run of texts: `hash`, byte offsets `start` and `end` within the run, and `first`, the index of each
    text's first word (one entry more than texts)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, classes: tuple[np.ndarray, np.ndarray]):
        member, value = classes
        inside = member[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        begin, stop = offsets[:-1], offsets[1:]
        full = stop > begin
        opens[begin[full]] = inside[begin[full]]
        closes[stop[full] - 1] = inside[stop[full] - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        if len(self.start):
            power, inverse = _power_tables(len(data))
            sums = np.add.reduceat(value[data] * power[: len(data)], self.start)
            self.hash = mixed(sums * inverse[self.start])
        else:
            self.hash = np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.start, offsets)


def shingles(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of `k` words; those that cross a text's end are the caller's to leave out."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = word_hash[:n].copy()
    for j in range(1, k):
        total *= _Q
        total += word_hash[j:j + n]
    return mixed(total + np.uint64(k))


def text_slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive slices of a text column of about SLICE_BYTES; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        cut = offsets[row:last + 1]
        yield row, data[cut[0]:cut[-1]], cut - cut[0]
        row = last


def list_column(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
