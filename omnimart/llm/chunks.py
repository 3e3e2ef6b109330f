"""Encoding of whole texts from their distinct chunks.

A chunk ends where no token can reach across, so the ids of a text are the ids of its chunks in
order. A task encodes each distinct chunk once and then looks it up by the hash of its bytes (64 bits, and
its length).
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from omnimart.llm import textops

PIECE_BYTES = 1 << 20
#: Remembered chunks of a worker process; beyond it they are forgotten and encoded again.
KEPT = 1_500_000
BATCH = 4_096


class ChunkEncoder:
    """Encodes Arrow texts; ``starts`` finds the chunk starts of a piece, ``encode`` the ids of chunks.

    ``mark_first``: the first chunk of a text is another chunk than the same bytes later on.
    """

    def __init__(self, starts: Callable[[np.ndarray, np.ndarray], np.ndarray], encode: Callable[[list[str], np.ndarray], list[list[int]]], mark_first: bool, kept: int = KEPT):
        self.starts, self.encode, self.mark_first, self.kept = starts, encode, mark_first, kept
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.flat = [np.zeros(0, np.uint32)]
        self.length = [np.zeros(0, np.int64)]

    def pieces(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """First row, end row, ids, bounds of each row's ids, and the bytes and byte bounds of the rows."""
        for at, end, raw, bounds in textops.pieces(texts, PIECE_BYTES):
            ids, cut = self.ids(raw, bounds)
            yield at, end, ids, cut, raw, bounds

    def ids(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n_rows = len(bounds) - 1
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(n_rows + 1, np.int64)
        cuts = self.starts(raw, bounds)
        heads = bounds[:-1][np.diff(bounds) > 0]
        cuts[heads] = True
        start = np.flatnonzero(cuts)
        stop = np.append(start[1:], len(raw))
        up, down = textops.powers(len(raw))
        total = np.empty(len(raw) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(textops._TABLE[raw] * up[: len(raw)], out=total[1:])
        h = textops.mix(((total[stop] - total[start]) * down[start]) + (stop - start).astype(np.uint64))
        if self.mark_first:
            head = np.searchsorted(start, heads)
            h[head] = textops.mix(h[head] + np.uint64(1))
        found, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.slot) + len(found) > self.kept:
            self._forget()
        slots = np.fromiter(map(self.slot.get, found.tolist(), itertools.repeat(-1)), np.int64, len(found))
        new = np.flatnonzero(slots < 0)
        if len(new):
            data, where = raw.tobytes(), first[new]
            chunks = [data[i:j].decode("utf-8", "replace") for i, j in zip(start[where].tolist(), stop[where].tolist())]
            at_head = np.isin(start[where], heads) if self.mark_first else np.zeros(len(new), bool)
            # In batches, as the libraries' results are many times the size of the ids.
            ids = [x for k in range(0, len(new), BATCH) for x in self.encode(chunks[k : k + BATCH], at_head[k : k + BATCH])]
            slots[new] = np.arange(len(self.slot), len(self.slot) + len(new))
            self.slot.update(zip(found[new].tolist(), slots[new].tolist()))
            self.length.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            self.flat.append(np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(self.length[-1].sum())))
            self.flat, self.length = [np.concatenate(self.flat)], [np.concatenate(self.length)]
        slots = slots[back]
        begin = np.concatenate([[0], np.cumsum(self.length[0])])
        n = self.length[0][slots]
        ends = np.cumsum(n)
        ids = self.flat[0][np.repeat(begin[slots] - (ends - n), n) + np.arange(ends[-1])]
        row_first = np.searchsorted(start, bounds)
        return ids, np.concatenate([[0], ends])[row_first]
