"""Importance resampling of documents towards a target text set, over hashed words and word runs.

Words are lower-cased (A-Z only) runs of ASCII letters, digits and bytes of other scripts. Features are all runs of 1 to
``longest`` consecutive words joined by one space, repeats counted; a feature's bucket is the CRC-32 of its UTF-8 bytes modulo
``buckets``. A bucket's gain is the logarithm of its share in the target over its share in the source (one added to
each bucket), in thousandths, rounded down. A document's weight is the sum of its features' gains; with noise drawn from its
id (Gumbel, in thousandths) added, the highest scores are a sample without replacement.

Head and tail: the most frequent words of all texts are sent to every worker with their exact CRC state, so that a feature
that begins with one goes on from that state, and the most frequent pairs with their bucket. The head holds at most
``head`` entries of each kind, whatever the size of the corpus. All other features, the tail, take their CRC directly. Both
give the same buckets, and bucket totals are exact counts over all documents.

Null and empty texts have no features, weight 0 and no place in the draw. A null id draws its noise from the empty
string. Rows that repeat an id count, and are drawn, each for itself. With no eligible document nothing is drawn.
Other columns than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from omnimart.llm.frames import Pins, fresh, map_batches

BUCKETS = 10_000
HEAD = 20_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Different words or pairs that a task counts before it hands its counts on.
HELD = 200_000

#: Bytes of words as they are, A-Z lower-cased, all others as blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


def bucket_of(feature: bytes, buckets: int = BUCKETS) -> int:
    return zlib.crc32(feature) % buckets


def _counted(texts: DataFrame, longest: int) -> DataFrame:
    """Exact counts of all words and, if asked for, pairs: n_words (1 or 2), feature, n."""

    def rows(size: int, held: Counter) -> pa.RecordBatch:
        out = [pa.array([size] * len(held), pa.int32()), pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
        held.clear()
        return pa.RecordBatch.from_arrays(out, ["n_words", "feature", "n"])

    def run(batches):
        held = {size: Counter() for size in range(1, min(longest, 2) + 1)}
        for batch in batches:
            for text in batch["text"].to_pylist():
                words = words_of(text)
                held[1].update(words)
                if longest > 1:
                    held[2].update(map(b" ".join, zip(words, words[1:])))
                for size, counts in held.items():
                    if len(counts) > HELD:
                        yield rows(size, counts)
        for size, counts in held.items():
            yield rows(size, counts)

    return map_batches(texts, run, "n_words int, feature binary, n long").groupBy("n_words", "feature").agg(F.sum("n").alias("n"))


class Head:
    """CRC states of frequent words and buckets of frequent pairs."""

    def __init__(self, words: list[bytes], pairs: list[bytes], buckets: int):
        self.buckets = buckets
        self.states = {w: zlib.crc32(w) for w in words}
        self.pairs = {tuple(p.split(b" ")): bucket_of(p, buckets) for p in pairs}

    @classmethod
    def learn(cls, texts: DataFrame, longest: int = 1, size: int = HEAD, buckets: int = BUCKETS) -> Head:
        """The head of ``texts``: at most ``size`` words and ``size`` pairs, by exact counts."""
        pins = Pins(texts.sparkSession)
        counted = pins.pin(_counted(texts, longest), "feature-counts")
        top = [[bytes(r.feature) for r in counted.where(F.col("n_words") == k).orderBy(F.desc("n"), "feature").limit(size).select("feature").collect()] for k in (1, 2)]
        pins.drop(counted)
        return cls(*top, buckets)

    def runs(self, words: list[bytes], longest: int):
        """Bucket of every run of two words and more. The first word's state comes from the head if it is there."""
        states, pairs, buckets = self.states, self.pairs, self.buckets
        for first in range(len(words) - 1):
            word = words[first]
            state = states.get(word)
            if state is None:
                state = zlib.crc32(word)
            for size in range(2, min(longest, len(words) - first) + 1):
                if size == 2:
                    known = pairs.get((word, words[first + 1]))
                    if known is not None:
                        if longest > 2:
                            state = zlib.crc32(b" " + words[first + 1], state)
                        yield known
                        continue
                state = zlib.crc32(b" " + words[first + size - 1], state)
                yield state % buckets


class _Looked(dict):
    """What each head word's bucket holds; a word of the tail is looked up by its CRC."""

    def __init__(self, states: dict[bytes, int], values: list):
        super().__init__((word, values[state % len(values)]) for word, state in states.items())
        self.values_of = values

    def __missing__(self, word: bytes):
        return self.values_of[zlib.crc32(word) % len(self.values_of)]


def bucket_totals(texts: DataFrame, head: Head, longest: int = 1) -> np.ndarray:
    """Exact number of features in each bucket over all ``texts``; a task hands on one row a bucket."""
    kept = texts.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        head = kept.value
        totals = np.zeros(head.buckets, dtype=np.int64)
        bucket = _Looked(head.states, list(range(head.buckets)))
        words: Counter = Counter()

        def settle():
            np.add.at(totals, np.fromiter(map(bucket.__getitem__, words), np.int64, len(words)), np.fromiter(words.values(), np.int64, len(words)))
            words.clear()

        for batch in batches:
            for text in batch["text"].to_pylist():
                found = words_of(text)
                words.update(found)
                if longest > 1:
                    np.add.at(totals, np.fromiter(head.runs(found, longest), np.int64), 1)
                if len(words) > HELD:
                    settle()
        settle()
        there = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(totals[there])], ["bucket", "n"])

    found = map_batches(texts, run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(head.buckets, dtype=np.int64)
    for row in found:
        totals[row.bucket] = row.n
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log ratio of the smoothed shares, rounded down, for each bucket."""
    n = len(source)
    all_source, all_target = float(int(source.sum()) + n), float(int(target.sum()) + n)
    return [math.floor(1000 * math.log((float(t) + 1) * all_source / ((float(s) + 1) * all_target))) for s, t in zip(source.tolist(), target.tolist())]


def weigh(docs: DataFrame, head: Head, gain: list[int], longest: int = 1) -> DataFrame:
    """``docs`` (doc_id) with n_words, n_features and weight."""
    kept = docs.sparkSession.sparkContext.broadcast((head, gain))

    def run(batches):
        head, gain = kept.value
        own = _Looked(head.states, gain).__getitem__
        for batch in batches:
            counts, features, weights = [], [], []
            for text in batch["text"].to_pylist():
                words = words_of(text)
                n, weight = len(words), sum(map(own, words))
                if longest > 1:
                    more = [gain[b] for b in head.runs(words, longest)]
                    n, weight = n + len(more), weight + sum(more)
                counts.append(len(words))
                features.append(n)
                weights.append(weight)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(x, pa.int64()) for x in (counts, features, weights))], ["doc_id", "n_words", "n_features", "weight"])

    return map_batches(fresh(docs, "doc_id", "text"), run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id in thousandths, rounded down."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def draw(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` (doc_id, n_words, score and more) with ``rank``: 1, 2, 3... by falling score, then id, for the drawn rows.

    Rows are ordered by one range shuffle; of it, the driver sees one count a partition.
    """
    pins = Pins(scored.sparkSession)
    # The row number keeps repeated rows apart, so that a range can end between them.
    rows = pins.pin(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    placed = rows.where(F.col("n_words") >= least_words).select("_row", "score", "doc_id").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = pins.pin(placed.select("_row", F.monotonically_increasing_id().alias("_at")), "placed")
    part = F.shiftright("_at", 33)
    counts = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    wanted = percent * sum(counts.values()) // 100
    before, total = [], 0
    for k in sorted(counts):
        before.append((k, total))
        total += counts[k]
    offsets = scored.sparkSession.createDataFrame(before, "part long, before long")
    ranked = placed.withColumn("part", part.cast("long")).join(F.broadcast(offsets), "part").select("_row", (F.col("before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).alias("rank")).where(F.col("rank") <= wanted)
    return rows.join(ranked, "_row", "left").drop("_row")


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, head_size: int = HEAD, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank in the draw (null if not drawn)."""
    docs, target = fresh(docs, "doc_id", "text"), fresh(target, "text")
    head = Head.learn(docs.select("text"), longest, head_size, buckets)
    gain = gains(bucket_totals(docs.select("text"), head, longest), bucket_totals(target, head, longest))
    scored = weigh(docs, head, gain, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return draw(scored, least_words, percent).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
