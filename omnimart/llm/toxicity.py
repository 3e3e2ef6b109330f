"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Terms are lower-cased (A-Z) words of letters and digits and, for longer words, their first five
bytes. Every term of a text counts, whether or not an example has it. A vector is
(1 + ln tf) * ln(1 + N / df) with document frequencies over all documents, of length one. With ``associated`` each
weight is multiplied by sqrt(1 + G), where G is the likelihood ratio statistic of the term and the label among the
examples (0 for a term of none): plain cosines find texts of the same subject, and a toxic word or two in a
long text hardly move them. No term is left out either way, unless ``vocabulary`` asks for the
most associated ones only.

The examples are at most ``positives`` and ``negatives`` labelled rows (those of the smallest hashes of
their ids). Terms of many examples stand in a matrix, the others in postings; a document's
cosines with all examples are summed from both, so the k nearest are exact (ties go to the smaller id). They vote
with weight 1 / (0.05 + 1 - cosine); each class is weighted by how many labelled rows an example
stands for. Votes are calibrated by a logistic curve fitted on the examples' own votes without
themselves. A document that shares no term with any example has no neighbours; its votes are those of the
examples without terms. Terms that no example has lengthen a document's vector; their frequencies are
counted apart, as there is no bound to their number.

Null and empty texts are such documents. Null labels or ids do not teach; a
document with several labels counts with each. Without examples of both classes every score is the share
of positives (0 without labels). Rows that repeat an id get a result each. Only the id
and text of ``docs`` are read, and an id is never an input of a score.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from omnimart.llm import textops
from omnimart.llm.frames import Pins, fresh, map_batches

#: Documented bounds of the labelled rows that are learnt from.
POSITIVES = 3_000
NEGATIVES = 5_000
NEAREST = 15
STEM = 5
#: Terms in the matrix, at most; documents whose cosines are computed at once.
COMMON = 512
ROWS = 64
#: Cosines that may be among the nearest are computed in double precision; single precision over COMMON terms of vectors of length
#: one is less than half of this off.
SLACK = 1e-4


def terms(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each term occurrence: words, then the stems of longer words."""
    word, row = textops.word_hashes(raw, bounds, textops.LETTER)
    stem, _ = textops.word_hashes(raw, bounds, textops.LETTER, first=STEM)
    longer = stem != word
    # A stem is another term than the word of the same letters.
    return np.concatenate([word, textops.mix(stem[longer] + np.uint64(1))]), np.concatenate([row, row[longer]])


class Vocabulary:
    """Places of hashes among ascending ones. Leading bits tell where to begin, so a search takes a step or two."""

    def __init__(self, known: np.ndarray):
        bits = max(1, len(known).bit_length())
        self.known, self.shift = known, np.uint64(64 - bits)
        self.first = np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << self.shift)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is there; the place of another one means nothing."""
        if not len(self.known):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        last = len(self.known) - 1
        at = np.minimum(self.first[h >> self.shift], last)
        left = np.flatnonzero(self.known[at] < h)
        while len(left):
            left = left[at[left] < last]
            at[left] += 1
            left = left[self.known[at[left]] < h[left]]
        return at, self.known[at] == h


def _occurrences(raw, bounds, vocabulary: Vocabulary):
    """Row, vocabulary index and count of the vocabulary's terms, ordered by row and index."""
    h, row = terms(raw, bounds)
    at, kept = vocabulary.find(h)
    cell, count = np.unique((row[kept] << 32) + at[kept], return_counts=True)
    return cell >> 32, cell & ((1 << 32) - 1), count


@dataclass
class ExampleIndex:
    """Example vectors by term, with the examples' labels and weights."""

    vocabulary: np.ndarray
    idf: np.ndarray
    strength: np.ndarray
    n_docs: int
    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    slots: np.ndarray
    values: np.ndarray
    column: np.ndarray
    matrix: np.ndarray
    curve: tuple[float, float] = (1.0, 0.0)
    empty: float = 0.0
    base: float = 0.0

    def nearest(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, n_rows: int, k: int, without: int | None = None):
        """For each row: slots and cosines of the k nearest examples, nearest first, of those with a cosine above 0.

        Entries are ordered by row. ``without`` is the slot of the first row, if the rows are examples, which are not their own neighbours.
        """
        cut = np.searchsorted(row, np.arange(0, n_rows + ROWS, ROWS))
        for first, i, j in zip(range(0, n_rows, ROWS), cut[:-1], cut[1:]):
            n = min(ROWS, n_rows - first)
            grid, rare, sums = self._cosines(row[i:j] - first, term[i:j], weight[i:j], n)
            for r in range(n):
                own = sums[r]
                if without is not None:
                    own[without + first + r] = 0
                least = np.partition(own, len(own) - k)[len(own) - k] - SLACK if len(own) > k else 0.0
                slots = np.flatnonzero((own >= least) & (own > 0))
                used = np.flatnonzero(grid[r])
                cosines = self.matrix[np.ix_(slots, used)] @ grid[r, used] + rare[r, slots]
                best = np.lexsort((self.ids[slots], -np.round(cosines, 12)))[:k]
                yield slots[best], cosines[best]

    @cached_property
    def _single(self) -> np.ndarray:
        return self.matrix.T.astype(np.float32)

    def __getstate__(self):
        return {name: value for name, value in self.__dict__.items() if name != "_single"}

    def _cosines(self, row, term, weight, n):
        """Weights of the matrix's terms, sums over the other terms, and cosines that are less than SLACK / 2 off."""
        column = self.column[term]
        common = column >= 0
        grid = np.zeros((n, self.matrix.shape[1]))
        grid[row[common], column[common]] = weight[common]
        row, term, weight = row[~common], term[~common], weight[~common]
        first, size = self.starts[term], self.starts[term + 1] - self.starts[term]
        at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(size) else np.zeros(0, np.int64)
        cell = np.repeat(row * len(self.ids), size) + self.slots[at]
        rare = np.bincount(cell, np.repeat(weight, size) * self.values[at], minlength=n * len(self.ids)).reshape(n, len(self.ids))
        return grid, rare, rare + grid.astype(np.float32) @ self._single

    def vote(self, slots: np.ndarray, cosines: np.ndarray) -> float:
        w = self.weights[slots] / (0.05 + np.maximum(0.0, 1 - cosines))
        return float((w * self.labels[slots]).sum() / w.sum()) if len(slots) else self.empty

    def score(self, vote: float) -> float:
        a, b = self.curve
        v = min(max(vote, 1e-4), 1 - 1e-4)
        return float(1 / (1 + np.exp(-(a * np.log(v / (1 - v)) + b))))


def sample(labels: DataFrame, positives: int, negatives: int) -> DataFrame:
    """At most so many labelled rows (doc_id, label) of each class."""
    rows = fresh(labels, "doc_id", "label").where("doc_id is not null and label is not null").select("doc_id", (F.col("label") > 0).cast("int").alias("label")).distinct()
    order = F.xxhash64("doc_id"), F.col("doc_id")
    return rows.where("label = 1").orderBy(*order).limit(positives).union(rows.where("label = 0").orderBy(*order).limit(negatives))


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, vocabulary: int | None = None, k: int = NEAREST, associated: bool = False) -> ExampleIndex:
    """Index of the examples drawn from ``labels`` (doc_id, label); statistics over all of ``docs``."""
    docs = fresh(docs, "doc_id", "text")
    known = fresh(labels, "doc_id", "label").where("doc_id is not null and label is not null").distinct()
    all_rows = {int(r[0]): r[1] for r in known.groupBy((F.col("label") > 0).cast("int")).count().collect()}
    # The sample is bounded by its parameters, so it may be sent to every task.
    chosen = docs.join(F.broadcast(sample(labels, positives, negatives)), "doc_id")
    kept, strength = _terms_of(chosen, vocabulary)
    df, n_docs = _frequencies(docs, kept)
    idf = np.log(1 + n_docs / np.maximum(df, 1))
    strength = strength if associated else np.ones(len(kept))
    ids, label, vectors = _example_vectors(chosen, kept, idf * strength)
    return _build(kept, idf, strength, n_docs, ids, label, vectors, all_rows, k)


def _terms_of(chosen: DataFrame, vocabulary: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the examples' terms, ascending, and what a term's association with the label multiplies its weight by."""

    def run(batches):
        for batch in batches:
            label = batch["label"].to_numpy()
            for at, end, raw, bounds in textops.pieces(batch["text"]):
                h, row = textops.distinct(*terms(raw, bounds))
                found, back = np.unique(h, return_inverse=True)
                has = label[at:end][row]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *(pa.array(np.bincount(back, has == c, minlength=len(found)).astype(np.int64)) for c in (1, 0))], ["term", "p", "n"])

    totals = {int(r[0]): r[1] for r in chosen.groupBy("label").count().collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return np.zeros(0, np.uint64), np.zeros(0)
    counts = map_batches(chosen, run, "term long, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).toArrow()
    term, p, n = counts["term"].to_numpy().view(np.uint64), counts["p"].to_numpy().astype(float), counts["n"].to_numpy().astype(float)
    share = (p + n) / (pos + neg)

    def part(seen, expected):
        there = seen > 0
        return np.where(there, seen * np.log(np.where(there, seen, 1) / np.where(there, expected, 1)), 0)

    g = part(p, share * pos) + part(n, share * neg) + part(pos - p, (1 - share) * pos) + part(neg - n, (1 - share) * neg)
    g = np.maximum(0, 2 * np.round(g, 6))
    best = np.lexsort((term, -g))[:vocabulary]
    best = best[np.argsort(term[best])]
    return term[best], np.sqrt(1 + g[best])


def _frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Document frequency of each term of the vocabulary and the number of documents, over all documents."""

    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        vocabulary = Vocabulary(sent.value)
        df, n = np.zeros(len(vocabulary.known), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, raw, bounds in textops.pieces(batch["text"]):
                df += np.bincount(_occurrences(raw, bounds, vocabulary)[1], minlength=len(vocabulary.known))
        # Document count under -1.
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], found])), pa.array(np.concatenate([[n], df[found]]))], ["term", "df"])

    rows = map_batches(docs, run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(vocabulary) + 1, np.int64)
    df[rows["term"].to_numpy() + 1] = rows["df"].to_numpy()
    return df[1:], int(df[0])


def _weights(row, term, count, factor, n_rows):
    """Weights of each row at length one, and the rows' squared lengths before."""
    value = (1 + np.log(count)) * factor[term]
    square = np.bincount(row, value * value, minlength=n_rows)
    return value / np.sqrt(square)[row], square


def _example_vectors(chosen: DataFrame, vocabulary: np.ndarray, factor: np.ndarray):
    """Ids and labels of the examples, and slot, term and weight of their entries, ordered by slot."""
    sent = chosen.sparkSession.sparkContext.broadcast((vocabulary, factor))

    def run(batches):
        vocabulary, factor = Vocabulary(sent.value[0]), sent.value[1]
        for batch in batches:
            for at, end, raw, bounds in textops.pieces(batch["text"]):
                row, term, count = _occurrences(raw, bounds, vocabulary)
                cut = np.searchsorted(row, np.arange(end - at + 1))
                weight, _ = _weights(row, term, count, factor, end - at)
                yield pa.RecordBatch.from_arrays([*(batch[c][at:end] for c in ("doc_id", "label", "key")), textops.lists(term.astype(np.int32), cut), textops.lists(weight, cut)], ["doc_id", "label", "key", "term", "weight"])

    keyed = chosen.select("doc_id", "label", "text", F.xxhash64("text").alias("key"))
    rows = map_batches(keyed, run, "doc_id long, label int, key long, term array<int>, weight array<double>").toArrow()
    ids, label = rows["doc_id"].to_numpy(), rows["label"].to_numpy()
    order = np.lexsort((rows["key"].to_numpy(), label, ids))
    rows = rows.take(pa.array(order)).combine_chunks()
    size = rows["term"].combine_chunks().value_lengths().to_numpy() if len(order) else np.zeros(0, np.int64)
    flat = [pa.concat_arrays([c.flatten() for c in rows[x].chunks]).to_numpy() if len(order) else np.zeros(0) for x in ("term", "weight")]
    return ids[order], label[order], (np.repeat(np.arange(len(ids)), size), flat[0].astype(np.int64), flat[1])


def _build(vocabulary, idf, strength, n_docs, ids, label, vectors, all_rows, k) -> ExampleIndex:
    drawn = np.bincount(label, minlength=2).astype(float)
    stands = np.array([all_rows.get(c, 0) / max(drawn[c], 1) for c in (0, 1)])
    base = all_rows.get(1, 0) / max(1, sum(all_rows.values()))
    slot, term, value = vectors
    size = np.bincount(term, minlength=len(vocabulary))
    often = np.argsort(-size, kind="stable")[:COMMON]
    often = often[size[often] > len(ids) / 32]
    column = np.full(len(vocabulary), -1)
    column[often] = np.arange(len(often))
    matrix = np.zeros((len(ids), len(often)))
    common = column[term] >= 0
    matrix[slot[common], column[term[common]]] = value[common]
    rare = np.flatnonzero(~common)
    rare = rare[np.argsort(term[rare], kind="stable")]
    starts = np.searchsorted(term[rare], np.arange(len(vocabulary) + 1))
    index = ExampleIndex(vocabulary, idf, strength, n_docs, ids, label, stands[label], starts, slot[rare].astype(np.int32), value[rare], column, matrix, base=base)
    empty = np.bincount(slot, minlength=len(ids)) == 0
    w = index.weights
    index.empty = float(((w * label)[empty].sum() + base) / (w[empty].sum() + 1)) if len(ids) else base
    if min(drawn) > 0:
        votes = np.array([index.vote(*found) for found in index.nearest(slot, term, value, len(ids), k, without=0)])
        index.curve = _calibrate(votes, label, w)
    return index


def _calibrate(votes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the votes' log odds, by Newton's method."""
    v = np.clip(votes, 1e-4, 1 - 1e-4)
    x = np.stack([np.log(v / (1 - v)), np.ones(len(v))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - label)) + 1e-2 * (beta - [1.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return max(float(beta[0]), 0.1), float(beta[1])


def _unseen(docs: DataFrame, index: ExampleIndex, sent) -> DataFrame:
    """By text (key, square): what terms of no example add to the squared length of its vector."""

    def run(batches):
        vocabulary = Vocabulary(sent.value.vocabulary)
        for batch in batches:
            key = batch["key"].to_numpy()
            for at, end, raw, bounds in textops.pieces(batch["text"]):
                h, row = terms(raw, bounds)
                new = ~vocabulary.find(h)[1]
                h, row = h[new], row[new]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else np.zeros(0, np.int64)
                count = np.diff(np.append(first, len(h)))
                yield pa.RecordBatch.from_arrays([pa.array(key[at:end][row[first]]), pa.array(h[first].view(np.int64)), pa.array(count.astype(np.int64))], ["key", "term", "n"])

    found = map_batches(docs.select("text", F.xxhash64("text").alias("key")), run, "key long, term long, n long")
    # Rows of the same text count in the frequency, but lengthen its vector once.
    copies = found.groupBy("term", "key", "n").agg(F.count("*").alias("copies"))
    df = F.sum("copies").over(Window.partitionBy("term"))
    weight = (1 + F.log("n")) * F.log(1 + F.lit(float(index.n_docs)) / df)
    return copies.select("key", (weight * weight).alias("square")).groupBy("key").agg(F.round(F.sum("square"), 9).alias("square"))


def score(docs: DataFrame, index: ExampleIndex, k: int = NEAREST) -> DataFrame:
    """doc_id, score and evidence (ids of up to three nearest examples) of every document."""
    docs = fresh(docs, "doc_id", "text")
    if not len(index.vocabulary) or len(np.unique(index.labels)) < 2:
        value = index.score(index.empty) if len(np.unique(index.labels)) > 1 else index.base
        return docs.select("doc_id", F.lit(float(value)).alias("score"), F.lit([]).cast("array<long>").alias("evidence"))
    sent = docs.sparkSession.sparkContext.broadcast(index)
    pins = Pins(docs.sparkSession)

    def search(batches):
        index = sent.value
        factor, vocabulary = index.idf * index.strength, Vocabulary(index.vocabulary)
        for batch in batches:
            slots, cosines, squares = [], [], []
            for at, end, raw, bounds in textops.pieces(batch["text"]):
                row, term, count = _occurrences(raw, bounds, vocabulary)
                weight, square = _weights(row, term, count, factor, end - at)
                for near, cosine in index.nearest(row, term, weight, end - at, k):
                    slots.append(near)
                    cosines.append(cosine)
                squares.append(square)
            cut = np.concatenate([[0], np.cumsum([len(x) for x in slots])]).astype(np.int32)
            flat = [np.concatenate([np.zeros(0, t), *x]).astype(t) for x, t in ((slots, np.int32), (cosines, float))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], textops.lists(flat[0], cut), textops.lists(flat[1], cut), pa.array(np.concatenate([np.zeros(0), *squares]))], ["doc_id", "key", "slots", "cosines", "own"])

    def vote(batches):
        index = sent.value
        for batch in batches:
            own, more = batch["own"].to_numpy(), batch["square"].to_numpy()
            shorter = np.sqrt(own / np.maximum(own + more, 1e-300))
            cut = batch["slots"].offsets.to_numpy()
            slots, cosines = batch["slots"].values.to_numpy(), batch["cosines"].values.to_numpy()
            low = batch["cosines"].offsets.to_numpy()
            scores, evidence = [], []
            for r in range(batch.num_rows):
                near = slots[cut[r] : cut[r + 1]]
                scores.append(index.score(index.vote(near, cosines[low[r] : low[r + 1]] * shorter[r])))
                evidence.append(index.ids[near[:3]].tolist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    unseen = pins.pin(_unseen(docs, index, sent), "unseen-terms")
    found = map_batches(docs.withColumn("key", F.xxhash64("text")), search, "doc_id long, key long, slots array<int>, cosines array<double>, own double")
    joined = pins.join(found, unseen, "key", "left").select("doc_id", "slots", "cosines", "own", F.coalesce("square", F.lit(0.0)).alias("square"))
    return map_batches(joined, vote, "doc_id long, score double, evidence array<long>")
