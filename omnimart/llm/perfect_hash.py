"""Minimal perfect hashes over sets of terms, with the terms themselves stored for verification.

A term's 64-bit hash picks its shard. In a shard, levels of bits place the terms: a level has about twice as many bits as
terms are left; a bit is set where just one term falls, and terms that fall together go to the next level. The rank of a
term's bit among all set bits is its slot, so slots are 0 to n - 1 without gaps. Terms are stored in slot order, and a
looked-up term counts only if it equals the stored one byte by byte; an unknown term is thus never taken for a known
one. Terms that no level parts (equal hashes) are kept in a plain dictionary behind the others.
"""

from __future__ import annotations

import pickle

import numpy as np

from omnimart.llm import textops

LEVELS = 24
_STEP = 0x9E3779B97F4A7C15


def hashes(terms: list[bytes]) -> np.ndarray:
    """64-bit hash of each term; terms hold no blank."""
    if not terms:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(b" ".join(terms), dtype=np.uint8)
    found, _ = textops.word_hashes(raw, np.array([0, len(raw)]), lower=False)
    return found


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _spread(h: np.ndarray, level: int) -> np.ndarray:
    return textops.mix(h + np.uint64(_STEP * (level + 1) % (1 << 64)))


def build(terms: list[bytes]) -> bytes:
    """The perfect hash of one shard's different terms, as bytes."""
    h = hashes(terms)
    left, words, sizes, slots = np.arange(len(terms)), [], [], []
    for level in range(LEVELS):
        if not len(left):
            break
        size = -(-2 * len(left) // 64) * 64
        at = (_spread(h[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(size)
        own = alone[at]
        slots.append(left[own][np.argsort(at[own])])
        left = left[~own]
    placed = np.concatenate([*slots, left]).astype(np.int64) if len(terms) else np.zeros(0, np.int64)
    ordered = [terms[i] for i in placed.tolist()]
    return pickle.dumps((np.concatenate(words) if words else np.zeros(0, np.uint64), sizes, ordered[: len(ordered) - len(left)], ordered[len(ordered) - len(left) :]))


class PerfectHashes:
    """Shards of one vocabulary side by side: slots run on from shard to shard."""

    def __init__(self, shards: dict[int, bytes], of: int):
        """``shards`` by number, out of ``of`` shards; terms of other shards are unknown."""
        self.of = of
        self.start = np.zeros((of, LEVELS), dtype=np.int64)
        self.size = np.zeros((of, LEVELS), dtype=np.int64)
        self.base = np.zeros(of + 1, dtype=np.int64)
        self.rest: dict[bytes, int] = {}
        #: From a shard's ranks to its slots: dictionary terms of the shards before it have slots but no bits.
        self.shift = np.zeros(of, dtype=np.int64)
        words, terms, at, ranked = [], [], 0, 0
        for k in sorted(shards):
            bits, sizes, placed, rest = pickle.loads(shards[k])
            for level, size in enumerate(sizes):
                self.start[k, level], self.size[k, level] = at, size
                at += size
            words.append(bits)
            self.shift[k] = len(terms) - ranked
            self.base[k] = len(terms)
            self.rest |= {term: len(terms) + len(placed) + i for i, term in enumerate(rest)}
            ranked += len(placed)
            terms += placed + rest
            self.base[k + 1 :] = len(terms)
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ends = np.concatenate([[0], np.cumsum([len(t) for t in terms], dtype=np.int64)])
        self.stored = np.frombuffer(b"".join(terms), dtype=np.uint8)

    @property
    def n(self) -> int:
        return len(self.ends) - 1

    def terms(self, first: int, last: int) -> list[bytes]:
        raw, ends = self.stored.tobytes(), self.ends
        return [raw[ends[i] : ends[i + 1]] for i in range(first, last)]

    def slots(self, terms: list[bytes]) -> np.ndarray:
        """Slot of each term, -1 for a term that is not stored."""
        found = np.full(len(terms), -1, dtype=np.int64)
        if not len(self.words):
            return found
        h = hashes(terms)
        shard = shard_of(h, self.of)
        left = np.arange(len(terms))
        for level in range(LEVELS):
            size = self.size[shard[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = self.start[shard[left], level] + (_spread(h[left], level) % size.astype(np.uint64)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            there = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            found[left[there]] = (self.before[at >> 6] + below + self.shift[shard[left]])[there]
            left = left[~there]
        self._verify(terms, found)
        if self.rest:
            for i, term in enumerate(terms):
                if term in self.rest:
                    found[i] = self.rest[term]
        return found

    def _verify(self, terms: list[bytes], found: np.ndarray) -> None:
        """Forget slots whose stored term is another one."""
        length = np.fromiter(map(len, terms), np.int64, len(terms))
        ends = np.cumsum(length)
        own = np.flatnonzero(found >= 0)
        same = self.ends[found[own] + 1] - self.ends[found[own]] == length[own]
        found[own[~same]] = -1
        own = own[same]
        n = length[own]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        raw = np.frombuffer(b"".join(terms), dtype=np.uint8)
        unlike = raw[np.repeat(ends[own] - n, n) + within] != self.stored[np.repeat(self.ends[found[own]], n) + within]
        found[own[np.unique(np.repeat(np.arange(len(own)), n)[unlike])]] = -1
