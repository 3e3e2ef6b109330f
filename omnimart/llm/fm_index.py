"""Compressed full-text index of word sequences, searched backwards for many patterns at once.

The suffixes of all segments of a shard, each ended by a separator, are sorted by their first ``DEPTH`` words. The words before
them (the Burrows-Wheeler transform) are kept as a wavelet matrix, one succinct bit plane for each bit of a
word's number. All suffixes that begin with a pattern of at most ``DEPTH`` words lie side by side, and the place of this
interval follows from that of the pattern without its first word by two ranks a plane.
"""

from __future__ import annotations

import numpy as np

from omnimart.llm.wavelet import WaveletMatrix

DEPTH = 64
#: Words of a probe: where a match ends, whether so few words alone occur twice.
PROBE = 8


class FMIndex:
    """Index over ``words`` (64-bit hashes) cut into segments by ``bounds``; ``weights`` says how often a segment stands for itself."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray, weights: np.ndarray):
        lengths = np.diff(bounds)
        known, number = np.unique(words, return_inverse=True)
        text = np.zeros(len(words) + len(lengths), dtype=np.int64)
        #: Place of each segment's first word in the text with separators.
        self.first = bounds[:-1] + np.arange(len(lengths))
        text[np.arange(len(words)) + np.repeat(np.arange(len(lengths)), lengths)] = number + 1
        order = _sorted_suffixes(text)
        self.n, self.text, self.lengths = len(text), text, lengths
        weight = np.repeat(weights, lengths + 1)[order]
        self.weight = np.concatenate([[0], np.cumsum(weight, dtype=np.int64)])
        bits = max(1, int(len(known)).bit_length())
        matrix = WaveletMatrix.build(text[order - 1], bits)
        self.planes = []
        for plane, zeros in zip(matrix.planes, matrix.zeros):
            bitmap = np.append(plane.words, np.uint64(0))
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(bitmap[:-1]), dtype=np.int64)])
            self.planes.append((bitmap, before, zeros))
        counts = np.bincount(text, minlength=len(known) + 1)
        symbols = np.arange(len(known) + 1)
        self.shift = np.concatenate([[0], np.cumsum(counts)[:-1]]) - self._descend(np.zeros(len(symbols), np.int64), symbols)

    def _descend(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for level, (bitmap, before, zeros) in enumerate(self.planes):
            word = at >> 6
            ones = before[word] + np.bitwise_count(bitmap[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(symbol >> (len(self.planes) - 1 - level) & 1, zeros + ones, at - ones)
        return at

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more word before them."""
        n = len(low)
        both = self._descend(np.concatenate([low, high]), np.concatenate([symbol, symbol]))
        return both[:n] + self.shift[symbol], both[n:] + self.shift[symbol]

    def occurrences(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.weight[high] - self.weight[low]

    def repeated(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest intervals of at least ``least`` words of the segments that occur twice or more: segment, first word, end.

        Each segment is matched from its end to its beginning. Where a match ends before a word, the windows left are those
        that hold this word; a probe of a few words from there on mostly tells that none of them occurs twice.
        """
        out = []
        seg = np.flatnonzero(self.lengths >= least)
        end = self.lengths[seg].copy()
        at, low, high = end.copy(), np.zeros(len(seg), np.int64), np.full(len(seg), self.n)
        stop, kept = np.zeros(len(seg), np.int64), np.full(len(seg), -1)  # kept: the end of the match that a probe follows
        while len(seg):
            new_low, new_high = self.extend(low, high, self.text[self.first[seg] + at - 1])
            found = self.occurrences(new_low, new_high) >= 2
            at, low, high = at - found, np.where(found, new_low, low), np.where(found, new_high, high)
            over = ~found | (at == stop)
            if over.any():
                k = np.flatnonzero(over)
                probing = kept[k] >= 0
                whole = (at[k] == 0) & ~probing & found[k]
                told = ~probing & (end[k] - at[k] >= least)
                out.append((seg[k[told]], at[k[told]], end[k[told]]))
                # The word before which a match ended; for a probe, the first one of its words.
                word = np.where(probing, stop[k], at[k] - 1)
                asks = ~probing & ~whole & (word + PROBE < end[k])
                next_end = np.where(probing & ~found[k], word + PROBE - 1, np.minimum(np.where(probing, kept[k], end[k]) - 1, word + least))
                kept[k] = np.where(asks, end[k], -1)
                end[k] = np.where(asks, word + PROBE, next_end)
                stop[k] = np.where(asks, word, 0)
                at[k], low[k], high[k] = end[k], 0, self.n
                done = np.zeros(len(seg), dtype=bool)
                done[k] = whole | (~asks & (end[k] < least))
                if done.any():
                    seg, end, at, low, high, stop, kept = (x[~done] for x in (seg, end, at, low, high, stop, kept))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out))


def _sorted_suffixes(text: np.ndarray) -> np.ndarray:
    """Places of ``text`` in the order of the first ``DEPTH`` words from there on."""
    rank, n = text, len(text)
    width = 1
    order = np.argsort(rank, kind="stable")
    while width < DEPTH:
        after = np.zeros(n, dtype=np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key)
        ordered = key[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[0] = 0
        np.cumsum(ordered[1:] != ordered[:-1], out=fresh[1:])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            break
        width *= 2
    return order
