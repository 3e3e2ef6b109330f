"""Array helpers over the bytes of an Arrow text column, used inside tasks.

Hashes are 64 bits wide. Two different words, shingles or lines share a hash with a
chance of 2**-64 a pair; operators state where they rely on that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
WIDTH = 5

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_random = np.random.RandomState(20240607)
_TABLE = _random.randint(1, 1 << 62, 256, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = _random.randint(1, 1 << 62, 16, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def separators(chars: bytes) -> np.ndarray:
    """Table telling for each byte whether it belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(chars)] = False
    return table


WORD = separators(WHITE)
#: Letters, digits and all bytes of other scripts.
LETTER = separators(bytes(c for c in range(128) if not chr(c).isalnum()))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, kept for the task's next piece."""
    size = max(1 << 20, 1 << (n - 1).bit_length()) if n else 1 << 20
    if size not in _powers:
        if len(_powers) > 1:
            _powers.clear()
        both = []
        for base in (_BASE, _INVERSE):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            both.append(np.cumprod(row))
        _powers[size] = tuple(both)
    up, down = _powers[size]
    return up, down


def pieces(texts: pa.Array, limit: int = 1 << 17, rows: int = 20_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of rows of about ``limit`` bytes: first row, end row, bytes, offsets.

    Nulls count as empty. A single longer text is a piece of its own.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), at + rows, len(texts))
        yield at, end, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_hashes(raw: np.ndarray, bounds: np.ndarray, table: np.ndarray = WORD, lower: bool = True, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, in order, and the row it stands in. ``first`` > 0: only so many leading bytes count."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if lower:
        raw = _LOWER[raw]
    inside = table[raw]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = bounds[1:-1]
    before[cuts[cuts < n]] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    if first:
        end = np.minimum(end, start + first)
    up, down = powers(n)
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_TABLE[raw] * up[:n], out=total[1:])
    return mix((total[end] - total[start]) * down[start]), np.searchsorted(bounds, start, side="right") - 1


def shingles(words: np.ndarray, row: np.ndarray, n_rows: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words of a row, with its row; a shorter row is one shingle as a whole."""
    found, rows = [], []
    if len(words) >= width:
        whole = row[width - 1 :] == row[: len(row) - width + 1]
        h = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            h += words[k : k + len(h)] * _FOLD[k]
        found.append(mix(h[whole]))
        rows.append(row[: len(h)][whole])
    count = np.bincount(row, minlength=n_rows)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.searchsorted(row, short)
        h = count[short].astype(np.uint64) * _FOLD[width]
        for k in range(width - 1):
            there = count[short] > k
            h[there] += words[first[there] + k] * _FOLD[k]
        found.append(mix(h))
        rows.append(short)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(rows)


def distinct(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, ascending within the row, rows ascending. At most 65,536 rows."""
    order = np.argsort(h)
    h, row = h[order], row[order].astype(np.uint16)
    order = np.argsort(row, kind="stable")
    h, row = h[order], row[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[first], row[first].astype(np.int64)


def distinct_leading(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``distinct``, for the leading 48 bits of the hashes; the others are zero. It sorts one number, so it is several times as fast."""
    key = np.sort((row.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    key = key[first]
    return key << np.uint64(16), (key >> np.uint64(48)).astype(np.int64)


def word_sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Sets of word shingles: first row, end row, hashes, and bounds of each row's ascending hashes."""
    for at, end, raw, bounds in pieces(texts):
        h, row = distinct(*shingles(*word_hashes(raw, bounds), end - at))
        yield at, end, h, np.searchsorted(row, np.arange(end - at + 1))


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets reach the similarity; empty sets do not."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Arrow list column from values and row bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
