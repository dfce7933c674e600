"""Words of a batch of texts as numpy arrays: where they start and end, and 64-bit hashes.

All functions work on bytes of UTF-8, which is exact for classes that split at ASCII bytes only.
A null text has no words. Memory is a fixed multiple of the bytes of one slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15 | 3)
_UNFACTOR = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
#: Powers of the factor and of its inverse, for one block of bytes.
_POWERS = np.cumprod(np.append(np.uint64(1), np.full((1 << 15) - 1, _FACTOR)))
_UNPOWERS = np.cumprod(np.append(np.uint64(1), np.full((1 << 15) - 1, _UNFACTOR)))
_ODD = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Bytes of `[^\x20\x09-\x0D]`, and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` once A-Z is lower case.
NOT_SPACE = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
ALNUM = np.array([b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


class Words(NamedTuple):
    """Words of n texts: hash, first byte and byte past the end of each; text k has words
    first[k] to first[k + 1]. data holds the (lower-cased) bytes of all texts."""

    data: np.ndarray
    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and len + 1 offsets into them; null texts are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return (data[offsets[0] : offsets[-1]], offsets - offsets[0]) if len(texts) else (data[:0], np.zeros(1, np.int64))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most so many bytes in a column, or of one row."""
    if not batch.num_rows:
        return
    values = batch.column(column)
    lists = pa.types.is_list(values.type)
    sizes = pc.multiply(pc.list_value_length(values), 8) if lists else pc.binary_length(values)
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def find_words(texts: pa.Array, inside: np.ndarray, lower: bool = False, hashed: bool = True) -> Words:
    """Maximal runs of bytes of a class, within each text."""
    data, offsets = raw(texts)
    if lower:
        data = np.frombuffer(data.tobytes().translate(LOWER.tobytes()), np.uint8)
    mask = np.frombuffer(data.tobytes().translate(inside.tobytes()), bool)
    # no word reaches from one text over into the next
    edges = offsets[offsets < len(data)]
    opens = mask.copy()
    opens[1:] &= ~mask[:-1]
    opens[edges] = mask[edges]
    begin = np.flatnonzero(opens)
    shuts = mask.copy()
    shuts[:-1] &= ~mask[1:]
    edges = offsets[offsets > 0] - 1
    shuts[edges] = mask[edges]
    end = np.flatnonzero(shuts) + 1
    first = np.searchsorted(begin, offsets).astype(np.int64)
    hashes = hash_ranges(data, begin, end) if hashed else np.zeros(0, np.uint64)
    return Words(data, hashes, begin, end, first)


def hash_ranges(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each range; equal bytes, equal hash."""
    size = len(_POWERS)
    sums = np.zeros(len(data) + 1, np.uint64)
    for a in range(0, len(data), size):
        b = min(a + size, len(data))
        part = sums[a + 1 : b + 1]
        np.multiply(_ODD[data[a:b]], _POWERS[: b - a], out=part)
        part *= np.uint64(pow(int(_FACTOR), a, 1 << 64))
        part[:1] += sums[a : a + 1]
        np.cumsum(part, out=part)
    back = _UNPOWERS[begin % size]
    if len(data) > size:
        blocks = [pow(int(_UNFACTOR), a, 1 << 64) for a in range(0, len(data) + 1, size)]
        back *= np.array(blocks, np.uint64)[begin // size]
    return mix((sums[end] - sums[begin]) * back + (end - begin).astype(np.uint64))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n hashes in a row, regardless of texts; entry i is for i to i + n - 1."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    power = np.full(len(hashes) + 1, _FACTOR)
    power[0] = 1
    np.cumprod(power, out=power)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[:-1], out=sums[1:])
    back = np.full(len(hashes) + 1, _UNFACTOR)
    back[0] = 1
    np.cumprod(back, out=back)
    return mix((sums[n:] - sums[:-n]) * back[: len(hashes) - n + 1])


def starts_of_runs(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words at which n words in a row of one text start, and the text of each."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    ahead = np.cumsum(counts) - counts
    return np.arange(len(text)) - np.repeat(ahead, counts) + np.repeat(first[:-1], counts), text
