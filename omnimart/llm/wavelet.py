"""Wavelet matrix: a sequence of ids as bit planes with rank and select.

Plane 0 holds the highest bit of every id in order; the ids are then parted stably, those with a
0 first, and plane 1 holds the next bit in that order, and so on. One id, the count of an id in
a range, and the place of its k-th occurrence each take one or two ranks or selects a
plane. Ranks use a directory of counts for every 512 bits, rebuilt on loading.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WMX1"
WORD_BITS = 512


class Plane:
    def __init__(self, packed: np.ndarray, n: int):
        self.packed, self.n = packed, n
        padded = np.zeros(-(-len(packed) // 64) * 64, dtype=np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).reshape(-1, 8).sum(axis=1, dtype=np.int64))])
        self.ones = int(self.before[-1])

    def bit(self, i: int) -> int:
        return int(self.packed[i >> 3] >> (i & 7) & 1)

    def rank(self, i: int) -> int:
        """Ones before place i."""
        block = i // WORD_BITS
        count = int(self.before[block])
        first = block * 8
        count += int(np.bitwise_count(self.words[first : i >> 6]).sum())
        if i & 63:
            count += int(self.words[i >> 6] & np.uint64((1 << (i & 63)) - 1)).bit_count()
        return count

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of that value."""
        before = self.before if bit else np.arange(len(self.before), dtype=np.int64) * WORD_BITS - self.before
        block = int(np.searchsorted(before, k, side="right")) - 1
        low = block * WORD_BITS
        bits = np.unpackbits(self.packed[low >> 3 : (low + WORD_BITS) >> 3], bitorder="little")
        return low + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.n, bitorder="little").view(bool)


class WaveletMatrix:
    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.planes = n, planes
        self.zeros = [n - p.ones for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        values, planes = ids.astype(np.uint16 if bits <= 16 else np.uint32), []
        for level in range(bits - 1, -1, -1):
            ones = (values & values.dtype.type(1 << level)) != 0
            planes.append(Plane(np.packbits(ones, bitorder="little"), len(values)))
            if level:
                values = np.concatenate([values[~ones], values[ones]])
        return cls(len(ids), planes)

    def to_bytes(self) -> bytes:
        packer = zstandard.ZstdCompressor(level=1)
        parts = [MAGIC, struct.pack("<QI", self.n, len(self.planes))]
        for plane in self.planes:
            body = packer.compress(plane.packed.tobytes())
            parts += [struct.pack("<I", len(body)), body]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, bits = struct.unpack_from("<QI", data, 4)
        at, planes, unpacker = 16, [], zstandard.ZstdDecompressor()
        for _ in range(bits):
            (size,) = struct.unpack_from("<I", data, at)
            planes.append(Plane(np.frombuffer(unpacker.decompress(data[at + 4 : at + 4 + size], max_output_size=n // 8 + 1), dtype=np.uint8), n))
            at += 4 + size
        return cls(n, planes)

    def access(self, i: int) -> int:
        value = 0
        for plane, zeros in zip(self.planes, self.zeros):
            bit = plane.bit(i)
            value = value << 1 | bit
            i = zeros + plane.rank(i) if bit else i - plane.rank(i)
        return value

    def count(self, value: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of an id at places low to before high."""
        low, high = self._narrow(value, low, self.n if high is None else high)
        return high - low

    def _narrow(self, value: int, low: int, high: int) -> tuple[int, int]:
        if value >> len(self.planes):
            return 0, 0
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.rank(low), plane.rank(high)
            low, high = (zeros + a, zeros + b) if value >> (len(self.planes) - 1 - level) & 1 else (low - a, high - b)
        return low, high

    def locate(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        low, high = self._narrow(value, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i = low + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - level) & 1
            i = self.planes[level].select(bit, i - self.zeros[level] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids in order."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.n, dtype=kind)
        for level, (plane, zeros) in reversed(list(enumerate(zip(self.planes, self.zeros)))):
            ones, held = plane.bits(), np.empty(self.n, dtype=kind)
            held[~ones] = values[:zeros]
            held[ones] = values[zeros:] | kind(1 << (len(self.planes) - 1 - level))
            values = held
        return values
