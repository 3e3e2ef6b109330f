"""Nearest vectors by an inverted multi-index.

Vectors are cut in two halves, and each half is quantised by its own codebook of k centroids, fitted
on a bounded sample; a pair of centroids is a cell, so k centroids a half make k * k cells. A
query ranks both codebooks by squared distance and takes pairs in order of the summed distance from
a heap, until the cells taken hold enough vectors. Every vector of those cells is compared
by exact Euclidean distance in double precision. Every row is indexed.

How many vectors are enough is measured: ``probes`` vectors are compared with all rows, and the
places of their true neighbours in the order of cells tell how far to go for the wanted
recall. Where vectors have no structure to use, that is a large share of the rows.

Vectors that are null, zero, of another length than most, or that hold a null or non-finite component
take no part, nor do rows with a null id. Repeated rows count once; a query is not its own
neighbour. Of equal vectors only the k + 1 smallest ids can be among k nearest, so only they are
kept in a cell. Ties go to the smaller id; with fewer candidates than k all are returned. Extra
columns are not read.

Cells of one first-half centroid are joined as blocks of about 1,024 vectors and 256 queries, so
that a cell with many vectors is spread over many tasks.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from omnimart.llm.frames import Pins, fresh, map_batches

#: Documented bound of the vectors that the codebooks are fitted on.
SAMPLE = 16_384
CELL = 4
MOST_CENTROIDS = 256
PROBES = 64
RECALL = 0.97
VECTORS = 1_024
QUERIES = 256


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, v) that take part, v in double precision."""
    rows = fresh(vectors, "vec_id", "embedding").where("vec_id is not null and embedding is not null")
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.select("vec_id", v.alias("v")).where(fine).distinct()
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (usual["d"] if usual else 0))


def _means(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly spread first members."""
    centres = points[np.unique(np.linspace(0, len(points) - 1, k).astype(int))].copy()
    for _ in range(rounds):
        own = _squares(points, centres).argmin(axis=1)
        count = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        full = count > 0
        centres[full] = total[full] / count[full, None]
    return centres


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


def codebooks(vectors: DataFrame, n: int) -> list[np.ndarray]:
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    points = np.array(rows["v"].to_pylist())
    k = max(1, min(MOST_CENTROIDS, round(math.sqrt(n / CELL))))
    half = points.shape[1] // 2
    return [_means(points[:, :half], k), _means(points[:, half:], k)]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def assign(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    half, width = books[0].shape[1], len(books[1])

    def run(batches):
        for batch in batches:
            v = _matrix(batch["v"])
            cell = _squares(v[:, :half], books[0]).argmin(1) * width + _squares(v[:, half:], books[1]).argmin(1) if len(v) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], ["vec_id", "v", "cell"])

    return map_batches(vectors.select("vec_id", "v"), run, "vec_id long, v array<double>, cell int")


def cells_in_order(near: np.ndarray, far: np.ndarray):
    """Pairs (i, j) by rising near[i] + far[j]."""
    a, b = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
    heap, seen = [(near[a[0]] + far[b[0]], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (near[a[x]] + far[b[y]], x, y))


def reaches(queries: DataFrame, books: list[np.ndarray], sizes: np.ndarray, enough: int) -> DataFrame:
    """Rows (vec_id, v, reach, part): the summed distance at which a query's cells hold enough vectors, for
    each first-half centroid with a cell within that reach."""
    half, width = books[0].shape[1], len(books[1])

    def run(batches):
        for batch in batches:
            v = _matrix(batch["v"])
            if not len(v):
                continue
            near, far = _squares(v[:, :half], books[0]), _squares(v[:, half:], books[1])
            reach, parts = [], []
            for q in range(len(v)):
                held, last = 0, 0.0
                for i, j in cells_in_order(near[q], far[q]):
                    held += sizes[i * width + j]
                    last = near[q, i] + far[q, j]
                    if held >= enough:
                        break
                reach.append(last)
                parts.append(np.flatnonzero(near[q] + far[q].min() <= last))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reach), pa.array(parts, pa.list_(pa.int32()))], ["vec_id", "v", "reach", "parts"])

    found = map_batches(queries.select("vec_id", "v"), run, "vec_id long, v array<double>, reach double, parts array<int>")
    return found.select("vec_id", "v", "reach", F.explode("parts").alias("part"))


def measured_need(entries: DataFrame, books: list[np.ndarray], sizes: np.ndarray, k: int, probes: int, recall: float) -> int:
    """Vectors that a query's cells must hold for the wanted share of true neighbours of probe rows."""
    rows = entries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(probes).select("vec_id", "v").toArrow()
    ids, points = rows["vec_id"].to_numpy(), np.array(rows["v"].to_pylist())
    half, width = books[0].shape[1], len(books[1])

    def run(batches):
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int32))] * len(points)
        for batch in batches:
            v, own, cell = _matrix(batch["v"]), batch["vec_id"].to_numpy(), batch["cell"].to_numpy()
            for p, point in enumerate(points):
                score = _squares(v, point[None, :])[:, 0] if len(v) else np.zeros(0)
                score, names, cells = (np.concatenate(x) for x in zip(best[p], (score[own != ids[p]], own[own != ids[p]], cell[own != ids[p]])))
                order = np.lexsort((names, score))[:k]
                best[p] = score[order], names[order], cells[order]
        n = [len(b[0]) for b in best]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(points)), n)), *(pa.array(np.concatenate([b[c] for b in best])) for c in range(3))], ["probe", "score", "vec_id", "cell"])

    nearest = Window.partitionBy("probe").orderBy("score", "vec_id")
    found = map_batches(entries.select("vec_id", "v", "cell"), run, "probe long, score double, vec_id long, cell int")
    truth = found.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= k).select("probe", "cell").toArrow()
    if not truth.num_rows:
        return 0
    probe, cell = truth["probe"].to_numpy(), truth["cell"].to_numpy()
    sums = _squares(points[:, :half], books[0])[:, :, None] + _squares(points[:, half:], books[1])[:, None, :]
    needs = []
    for p in np.unique(probe):
        flat = sums[p].ravel()
        order = np.argsort(flat, kind="stable")
        held = np.cumsum(sizes[order])
        needs += held[np.searchsorted(flat[order], flat[cell[probe == p]], side="right") - 1].tolist()
    return int(np.quantile(needs, recall, method="higher"))


def _blocks(rows: DataFrame, size: int, name: str, *columns: str) -> DataFrame:
    """Rows of a part in blocks of about ``size``, by a hash of the id."""
    # At most as many rows as there are first-half centroids.
    sizes = rows.groupBy("part").agg(F.ceil(F.count("*") / size).alias("blocks"))
    split = rows.join(F.broadcast(sizes), "part").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("blocks")))
    return split.groupBy("part", "block").agg(F.collect_list(F.struct("vec_id", "v", *columns)).alias(name)).select("part", name)


def search(vectors: DataFrame, is_query: Column, k: int = 10, probes: int = PROBES, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score (distance) of the k nearest rows found for each query row."""
    pins = Pins(vectors.sparkSession)
    rows = pins.pin(usable(vectors), "vectors")
    n = rows.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books = codebooks(rows, n)
    half, width = books[0].shape[1], len(books[1])
    same = Window.partitionBy("v").orderBy("vec_id")
    entries = pins.pin(assign(rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1), books), "entries")
    sizes = np.zeros(len(books[0]) * width, dtype=np.int64)
    for cell, count in entries.groupBy("cell").count().collect():
        sizes[cell] = count
    enough = max(k + 1, measured_need(entries, books, sizes, k, probes, recall))
    asked = pins.pin(reaches(rows.where(is_query), books, sizes, enough), "reaches")

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                held, queries = (batch[c].slice(r, 1).flatten() for c in ("entries", "queries"))
                ids, v, cell = held.field("vec_id").to_numpy(), _matrix(held.field("v")), held.field("cell").to_numpy()
                names, q, reach = queries.field("vec_id").to_numpy(), _matrix(queries.field("v")), queries.field("reach").to_numpy()
                near, far = _squares(q[:, :half], books[0]), _squares(q[:, half:], books[1])
                found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
                for x in range(len(q)):
                    taken = np.flatnonzero((near[x, cell // width] + far[x, cell % width] <= reach[x] * (1 + 1e-9)) & (ids != names[x]))
                    score = np.sqrt(((v[taken] - q[x]) ** 2).sum(axis=1))
                    limit = np.partition(score, k - 1)[k - 1] if len(score) > k else np.inf
                    best = np.flatnonzero(score <= limit)
                    best = best[np.lexsort((ids[taken[best]], score[best]))][:k]
                    found.append((np.full(len(best), names[x]), ids[taken[best]], score[best]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["query_id", "vec_id", "score"])

    entry_blocks = _blocks(entries.withColumn("part", F.floor(F.col("cell") / width).cast("int")), VECTORS, "entries", "cell")
    pairs = entry_blocks.join(_blocks(asked, QUERIES, "queries", "reach"), "part").select("entries", "queries")
    scored = map_batches(pairs, run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = pins.pin(scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "neighbours")
    pins.keep_only(found)
    return found
