"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Items and documents are sets of shingles of five lower-cased (A-Z) words. Items are
partitioned by size into classes (u/2, u], u a power of two. For a class, each document is cut
into blocks of u consecutive shingles, and two neighbouring blocks make a window; so a passage as
long as an item lies whole in a window that is not much longer than the item, however long
the document. An item that is contained to 80 % has a Jaccard similarity of at least 0.19 with that
window; 32 minima of either side, one equal minimum sufficing, find it with a chance
above 99.8 % (an item contained whole: above 99.97 %). Block minima of a class are made from those of
the class below. Each candidate is verified by the exact share of the item's
shingles in the whole document.

The items are the query set. They are taken in blocks of bounded size, each sent to all
tasks; documents are not shuffled. A document's scattered copies of shingles count in the
verification; only the search looks at windows.

Null and empty texts match nothing. An item or document of fewer than five words is one
shingle as a whole, so a shorter item is only found in a document of the same words. Rows with a null id
are not searched for or in. Rows that repeat an id count as one item (all their
shingles) or give a result row each (documents). Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from omnimart.llm import textops
from omnimart.llm.frames import Pins, fresh, map_batches

PERCENT = 80
MINIMA = 32
#: Items and characters of a block of the query set, about.
BLOCK_ITEMS = 5_000
BLOCK_CHARS = 8 << 20

_draw = np.random.RandomState(4)
_MULTIPLY = _draw.randint(0, 1 << 31, MINIMA).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _draw.randint(0, 1 << 31, MINIMA).astype(np.uint32)
_BITS = 16
_SHIFT = np.uint32(32 - _BITS)


class ItemIndex:
    """Shingle sets of a block of items, and by size class the minima under each hash function."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray]):
        self.ids, self.sets = ids, sets
        size = np.array([len(s) for s in sets], dtype=np.int64)
        of = np.ceil(np.log2(np.maximum(size, 1))).astype(int)
        self.classes = {}
        for c in np.unique(of[size > 0]):
            own = np.flatnonzero((of == c) & (size > 0))
            tables = []
            for k in range(MINIMA):
                low = np.array([(_high(sets[i]) * _MULTIPLY[k] + _ADD[k]).min() for i in own])
                order = np.argsort(low, kind="stable")
                tables.append((low[order], own[order]))
            # Most minima are sorted out by their leading bits alone.
            seen = np.zeros((MINIMA, 1 << _BITS), dtype=bool)
            for k, (low, _) in enumerate(tables):
                seen[k, low >> _SHIFT] = True
            self.classes[int(c)] = (tables, seen)

    def candidates(self, h: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        """Distinct (row, item index) that share a minimum with a window. ``h`` in text order."""
        if not len(h) or not self.classes:
            return np.zeros((0, 2), dtype=np.int64)
        high = _high(h)
        minima = [high * _MULTIPLY[k] + _ADD[k] for k in range(MINIMA)]
        count, width = np.bincount(row, minlength=n_rows), 0
        found = []
        for c in sorted(self.classes):
            blocks = -(-count // (1 << (c - width)))
            starts = np.concatenate([[0], np.cumsum(count)[:-1]])
            of = np.repeat(np.arange(n_rows), blocks)
            nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            edges = starts[of] + (nth << (c - width))
            pair = np.flatnonzero(of[1:] == of[:-1])
            tables, seen = self.classes[c]
            for k in range(MINIMA):
                minima[k] = low = np.minimum.reduceat(minima[k], edges)
                window = low.copy()
                window[pair] = np.minimum(low[pair], low[pair + 1])
                hit = np.flatnonzero(seen[k, window >> _SHIFT])
                if len(hit):
                    values, owner = tables[k]
                    first, last = np.searchsorted(values, window[hit]), np.searchsorted(values, window[hit], side="right")
                    for i in np.flatnonzero(last > first):
                        found.append(np.stack([np.full(last[i] - first[i], of[hit[i]]), owner[first[i] : last[i]]], 1))
            count, width = blocks, c
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=np.int64)


def _high(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32)


def item_blocks(items: DataFrame):
    """Blocks of the query set, one at a time on the driver, each of a bounded expected size."""
    items = fresh(items, "item_id", "text").where("item_id is not null")
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = 1 + max(n // BLOCK_ITEMS, chars // BLOCK_CHARS)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow()
        ids = rows["item_id"].combine_chunks()
        sets: dict[int, np.ndarray] = {}
        for at, end, h, bounds in textops.word_sets(rows["text"].combine_chunks()):
            for k, i in enumerate(ids[at:end].to_pylist()):
                own = h[bounds[k] : bounds[k + 1]]
                sets[i] = np.union1d(sets[i], own) if i in sets else own
        names = sorted(sets)
        yield ItemIndex(np.array(names, dtype=np.int64), [sets[i] for i in names])


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (doc_id, item_id, n_item, n_shared) with ``100 * n_shared >= percent * n_item``."""
    docs = fresh(docs, "doc_id", "text").where("doc_id is not null")
    spark, found = docs.sparkSession, None
    for index in item_blocks(items):
        part = _search(docs, spark.sparkContext.broadcast(index) if index.classes else None, percent)
        found = part if found is None else found.union(part)
    return found


def _search(docs: DataFrame, sent, percent: int) -> DataFrame:
    def run(batches):
        index = sent.value if sent else ItemIndex(np.zeros(0, np.int64), [])
        for batch in batches:
            ids = batch["doc_id"]
            for at, end, raw, bounds in textops.pieces(batch["text"]):
                words, word_row = textops.word_hashes(raw, bounds)
                h, row = textops.shingles(words, word_row, end - at)
                if len(row) and np.any(np.diff(row) < 0):
                    order = np.argsort(row, kind="stable")
                    h, row = h[order], row[order]
                docs_, items_, sizes, shared = [], [], [], []
                own, last = None, -1
                for r, i in index.candidates(h, row, end - at):
                    if r != last:
                        own, last = np.unique(h[np.searchsorted(row, r) : np.searchsorted(row, r + 1)]), r
                    item = index.sets[i]
                    both = len(np.intersect1d(item, own, assume_unique=True))
                    if 100 * both >= percent * len(item):
                        docs_.append(at + r)
                        items_.append(index.ids[i])
                        sizes.append(len(item))
                        shared.append(both)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(docs_, pa.int64())), *(pa.array(x, pa.int64()) for x in (items_, sizes, shared))],
                    ["doc_id", "item_id", "n_item", "n_shared"],
                )

    return map_batches(docs, run, "doc_id long, item_id long, n_item long, n_shared long")


def remove_contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, unnamed: bool = False) -> DataFrame:
    """``docs`` without the documents that hold an item; rows with a null id stay, or with ``unnamed`` go by their text."""
    pins = Pins(docs.sparkSession)
    hit = pins.pin(contained_items(docs, items, percent).select("doc_id").distinct(), "contaminated")
    kept = pins.join(docs, hit, "doc_id", "left_anti")
    if not unnamed:
        return kept
    # Whether a text holds an item depends on nothing else, so its hash stands in for the id.
    nameless = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    texts = fresh(docs, "doc_id", "text").where("doc_id is null").select(nameless.alias("doc_id"), "text")
    held = pins.pin(contained_items(texts, items, percent).select(F.col("doc_id").alias("_nameless")).distinct(), "contaminated-texts")
    return pins.join(kept.withColumn("_nameless", nameless), held, "_nameless", "left_anti").drop("_nameless").select(*docs.columns)
