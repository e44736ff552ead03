"""Words and word hashes of Arrow text batches, in NumPy.

A word is a maximal run of bytes other than blank, tab, line feed, vertical tab, form feed
and carriage return; A-Z are lower-cased, nothing else is. Texts are handled in slices of a
few hundred kilobytes, so memory follows the slice and not the batch; a text longer than a
slice is cut at white space and its word hashes are put together again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        for base in (_BASE, _INVERSE):
            table = np.full(size, base)
            table[0] = 1
            _powers.setdefault(size, []).append(np.cumprod(table))
    return _powers[size]


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte position, hash) of every word of lower-cased data."""
    codes = np.frombuffer(data, np.uint8)
    blank = np.concatenate(([True], _BLANK[codes], [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _power_tables(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def _pieces(data: bytes) -> Iterator[bytes]:
    """Cut a very long text at white space (anywhere, inside a word longer than a slice)."""
    at = 0
    while len(data) - at > SLICE_BYTES:
        end = at + SLICE_BYTES
        while end > at and not _BLANK[data[end - 1]]:
            end -= 1
        if end == at:  # a word longer than a slice: up to its end
            end = at + SLICE_BYTES
            while end < len(data) and not _BLANK[data[end]]:
                end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and len(texts) + 1 offsets into them."""
    if len(texts) == 1 and len(texts[0]) > SLICE_BYTES:
        parts = [_hash_words(p.lower())[1] for p in _pieces(texts[0])]
        joined = np.concatenate(parts)
        return joined, np.array([0, len(joined)])
    starts, hashes = _hash_words(b" ".join(texts).lower())
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(starts, begins)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch cut into runs of rows whose texts are about a slice long together."""
    at = batch.schema.get_field_index(column)
    lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0)
    ends = np.cumsum(np.asarray(lengths, np.int64))
    row, done = 0, 0
    while row < batch.num_rows:
        stop = max(row + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        part = batch.slice(row, stop - row)
        yield part, as_bytes(part.column(at))
        row, done = stop, int(ends[stop - 1])


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive entries; entry i covers words i .. i + n - 1."""
    count = max(0, len(words) - n + 1)
    out = words[:count].copy()
    for i in range(1, n):
        out = mix(out * _BASE + words[i : i + count])
    return out


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; fewer than k words make one shingle, none make none."""
    if len(words) == 0:
        return words
    return np.unique(ngram_hashes(words, min(k, len(words))))
