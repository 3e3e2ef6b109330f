"""Removal of repeated passages: each word covered by a window of words that starts anywhere else as well.

Words are what stands between blanks (space, tab, line ends). A window is ``least`` consecutive words of one text; it is repeated if
the same words start at another place of any text, its own included. Windows are judged on the input. Every word of a
repeated window goes, at all its places; none stays as the original.

1. A window's anchor is the smallest hash among its runs of ``RUN`` words; equal windows have equal anchors. Neighbouring windows of one
   anchor make a segment. Segments whose anchor occurs only once cannot hold a repeated window and go.
2. Equal segments are collapsed to one with a count. Segments are dealt out by their anchor, and a task builds
   a compressed FM-index (``fm_index``) over each shard of about ``SHARD_WORDS`` words.
3. The shard's segments are matched against its index by backward search; intervals of at least ``least`` words that occur
   twice or more, counted with the numbers of copies, are reported and laid back on the texts.

An anchor with more than ``HOT`` different segments (a passage that very many texts share, each with other words
around it) would be too much for a task. Its segments are cut into their windows, equal windows are collapsed, and the
different ones are dealt out by their own hash. So no task holds more than a shard and one anchor's segments.

Texts are told apart by their MD5, words by 64-bit hashes. Null and empty texts have no words. Rows that repeat a
text are copies of each other, whatever their ids; null ids and repeated ids are allowed. Other columns than ``doc_id`` and
``text`` are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from omnimart.llm import textops
from omnimart.llm.fm_index import DEPTH, FMIndex
from omnimart.llm.frames import Pins, fresh, map_batches

LEAST = 35
RUN = 8
SHARD_WORDS = 1 << 18
HOT = 4096

_PRIME = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


def _least_of(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest value among each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    return np.minimum(h[: len(h) - (width - done)], h[width - done :]) if width > done else h


def cut(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, run: int = RUN):
    """Segments of many texts whose word hashes lie one after another.

    Returns, for each segment, its first word's place in ``words``, its number of windows, anchor, hash, and whether its anchor
    stands at two places of the segment's run.
    """
    span = least - run + 1
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool)
    if len(words) < least:
        return none
    runs = np.zeros(len(words) - run + 1, dtype=np.uint64)
    for k in range(run):
        runs += words[k : k + len(runs)] * textops._FOLD[k % len(textops._FOLD)] * np.uint64(2 * (k // len(textops._FOLD)) + 1)
    runs = textops.mix(runs)
    anchor = _least_of(runs, span)
    lengths = np.diff(bounds)
    # Windows that lie in one text: place of the first word, and text.
    inside = np.zeros(len(words) + 1, dtype=np.int64)
    whole = lengths >= least
    np.add.at(inside, bounds[:-1][whole], 1)
    np.add.at(inside, bounds[1:][whole] - least + 1, -1)
    valid = np.cumsum(inside[: len(anchor)]) > 0
    begins = np.zeros(len(anchor), dtype=bool)
    begins[bounds[:-1][whole]] = True
    begins[1:] |= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    start = np.flatnonzero(begins & valid)
    if not len(start):
        return none
    stops = np.flatnonzero(np.append(valid[1:] & ~begins[1:], False) < valid) + 1
    n = stops - start
    # A window that does not hold the first place of its anchor holds a second one.
    place = np.lib.stride_tricks.sliding_window_view(runs, span)[start].argmin(axis=1)
    twice = n - 1 > place
    # Runs of more windows than an anchor's first place allows are cut, so that segments stay short.
    pieces = -(-n // span)
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start, n, twice = np.repeat(start, pieces) + piece * span, np.minimum(np.repeat(n, pieces) - piece * span, span), np.repeat(twice, pieces)
    up, down = textops.powers(len(words))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])
    end = start + n + least - 1
    own = textops.mix((total[end] - total[start]) * down[start] + end.astype(np.uint64) * _PRIME - start.astype(np.uint64) * _PRIME)
    return start, n, anchor[start], own, twice


def segment_rows(texts: DataFrame, least: int, run: int) -> DataFrame:
    """Per text (key, text): key, and arrays anchors, hashes, starts, windows and weights of its segments."""

    def rows(batches):
        for batch in batches:
            for at, end, raw, bytes_at in textops.pieces(batch["text"]):
                words, row = textops.word_hashes(raw, bytes_at, lower=False)
                bounds = np.searchsorted(row, np.arange(end - at + 1))
                start, n, anchor, own, twice = cut(words, bounds, least, run)
                text = np.searchsorted(bounds, start, side="right") - 1
                ends = np.searchsorted(text, np.arange(end - at + 1))
                full = np.flatnonzero(np.diff(ends))
                cuts = np.concatenate([ends[full], ends[-1:]])
                lists = [textops.lists(x, cuts) for x in (anchor.view(np.int64), own.view(np.int64), (start - bounds[text]).astype(np.int32), n.astype(np.int32), 1 + twice.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch["key"].take(pa.array(at + full)), *lists], ["key", "anchors", "hashes", "starts", "windows", "weights"])

    return map_batches(texts, rows, "key binary, anchors array<long>, hashes array<long>, starts array<int>, windows array<int>, weights array<int>")


def segment_words(wanted: DataFrame, least: int) -> DataFrame:
    """Words of the wanted segments of each text: anchor, hash, at (first window), n, words; hot ones window by window."""

    def rows(batches):
        for batch in batches:
            for text, segments in zip(batch["text"], batch["wanted"]):
                words, out = words_of(text.as_py()), []
                for s in segments.as_py():
                    first, last = s["start"], s["start"] + s["windows"] + least - 1
                    if s["hot"]:
                        out += [(s["anchor"], s["hash"], k - first, s["n"], b" ".join(words[k : k + least]), True) for k in range(first, last - least + 1)]
                    else:
                        out.append((s["anchor"], s["hash"], 0, s["n"], b" ".join(words[first:last]), False))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], ["anchor", "hash", "at", "n", "words", "hot"])

    return map_batches(wanted, rows, "anchor long, hash long, at int, n long, words binary, hot boolean")


def search_shards(segments: DataFrame, least: int, shard_words: int) -> DataFrame:
    """Repeated intervals of segments (place, anchor, hash, n, words): anchor, hash, first, end.

    Segments of one ``place`` meet in one shard; ``segments`` is partitioned and sorted by it.
    """

    def report(held):
        words, row = _hashed(held)
        index = FMIndex(words, np.searchsorted(row, np.arange(len(held) + 1)), np.array([r[2] for r in held], dtype=np.int64))
        segment, first, end = index.repeated(least)
        anchor, own = (np.array([r[c] for r in held], dtype=np.int64)[segment] for c in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(own), pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32))], ["anchor", "hash", "first", "end"])

    def rows(batches):
        held, at, size = [], None, 0
        for batch in batches:
            for place, *segment in zip(*(batch[c].to_pylist() for c in ("place", "anchor", "hash", "n", "words"))):
                if place != at and size >= shard_words:
                    yield report(held)
                    held, size = [], 0
                held.append(segment)
                at, size = place, size + segment[3].count(b" ") + 1
        if held:
            yield report(held)

    return map_batches(segments, rows, "anchor long, hash long, first int, end int")


def _hashed(held: list) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of segments, and the segment of each."""
    raw = np.frombuffer(b" ".join(r[3] for r in held), dtype=np.uint8)
    ends = np.cumsum([len(r[3]) + 1 for r in held])
    return textops.word_hashes(raw, np.concatenate([[0], ends[:-1], [len(raw)]]), lower=False)


def repeated_spans(docs: DataFrame, pins: Pins, least: int = LEAST, run: int = RUN, shard_words: int = SHARD_WORDS, hot: int = HOT) -> DataFrame:
    """Pinned places of repeated words by text: key (MD5), firsts and ends, ascending and apart."""
    if not 0 < run < least or 2 * least - run > DEPTH:
        raise ValueError(f"a window and its neighbours of one anchor have more than {DEPTH} words")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.where("text is not null").select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"), "text")
    cuts = pins.pin(segment_rows(texts, least, run), "cuts")
    counts = cuts.select(F.explode(F.arrays_zip("anchors", "weights")).alias("s")).groupBy(F.col("s.anchors").alias("anchor")).agg(F.sum("s.weights").alias("n"))
    anchors = pins.pin(counts.where("n > 1").select("anchor"), "anchors")
    every = cuts.select("key", F.explode(F.arrays_zip("anchors", "hashes", "starts", "windows")).alias("s")).select("key", F.col("s.anchors").alias("anchor"), F.col("s.hashes").alias("hash"), F.col("s.starts").alias("start"), F.col("s.windows").alias("windows"))
    places = pins.pin(pins.join(every, anchors, "anchor", "left_semi"), "places")
    pins.drop(cuts, anchors)

    segments = pins.pin(places.groupBy("anchor", "hash").agg(F.count("*").alias("n"), F.min(F.struct("key", "start", "windows")).alias("own")), "segments")
    crowded = pins.pin(segments.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("anchor", F.lit(True).alias("hot")), "crowded")
    marked = pins.join(segments, crowded, "anchor", "left").select("own.key", F.struct("anchor", "hash", "n", "own.start", "own.windows", F.coalesce("hot", F.lit(False)).alias("hot")).alias("w"))
    wanted = marked.groupBy("key").agg(F.collect_list("w").alias("wanted"))
    # One row a text: copies are dropped by the tasks that read them, before texts are shuffled.
    found = pins.pin(segment_words(texts.dropDuplicates(["key"]).join(wanted, "key").select("text", "wanted"), least), "segment-words")
    pins.drop(segments, crowded)

    whole = found.where("not hot").select(F.col("anchor").alias("place"), "anchor", "hash", "n", "words")
    windows = found.where("hot")
    same = windows.groupBy("words").agg(F.sum("n").alias("n")).where("n > 1").select(F.xxhash64("words").alias("place"), F.lit(0).cast("long").alias("anchor"), F.xxhash64("words").alias("hash"), "n", "words")
    spans = search_shards(whole.repartition(parts, "place").sortWithinPartitions("place"), least, shard_words)
    hits = pins.pin(spans, "spans")
    if windows.take(1):
        twice = search_shards(same.repartition(parts, "place").sortWithinPartitions("place"), least, shard_words)
        twice = twice.select(F.col("hash").alias("window")).distinct()
        back = windows.select(F.xxhash64("words").alias("window"), "anchor", "hash", "at").join(twice, "window").select("anchor", "hash", F.col("at").alias("first"), (F.col("at") + least).alias("end"))
        hits = pins.pin(hits.unionByName(back), "spans")

    # Intervals of a segment lie on every text that has it. They are stored first, so that the join can split a
    # segment that very many texts have.
    of_segment = pins.pin(hits.groupBy("anchor", "hash").agg(F.collect_list(F.struct("first", "end")).alias("spans")), "segment-spans")
    laid = pins.join(places, of_segment, ["anchor", "hash"])
    laid = laid.select("key", F.explode("spans").alias("s"), "start").groupBy("key").agg(F.collect_set(F.struct((F.col("start") + F.col("s.first")).alias("first"), (F.col("start") + F.col("s.end")).alias("end"))).alias("spans"))

    def merged(batches):
        for batch in batches:
            keys, firsts, ends = [], [], []
            for key, spans in zip(batch["key"].to_pylist(), batch["spans"]):
                flat = spans.values.flatten()
                a, b = flat[0].to_numpy(), flat[1].to_numpy()
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                apart = np.append(True, a[1:] > b[:-1])
                keys.append(key)
                firsts.append(a[apart])
                ends.append(b[np.append(np.flatnonzero(apart)[1:] - 1, len(b) - 1)])
            kinds = (pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip((keys, firsts, ends), kinds)], ["key", "firsts", "ends"])

    result = pins.pin(map_batches(laid, merged, "key binary, firsts array<int>, ends array<int>"), "repeated")
    pins.keep_only(result)
    return result


def remove_repeats(docs: DataFrame, least: int = LEAST, **settings) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, and the kept words joined by one space (``text``; empty for a null text)."""
    pins = Pins(docs.sparkSession)
    docs = fresh(docs, "doc_id", "text")
    spans = repeated_spans(docs, pins, least, **settings)
    marked = pins.join(docs.withColumn("key", F.unhex(F.md5(F.col("text").cast("binary")))), spans, "key", "left")

    def rows(batches):
        for batch in batches:
            out = []
            for text, firsts, ends in zip(batch["text"], batch["firsts"], batch["ends"]):
                words = words_of(text.as_py())
                if firsts.is_valid:
                    kept, at = [], 0
                    for a, b in zip(firsts.as_py(), ends.as_py()):
                        kept += words[at:a]
                        at = b
                    kept += words[at:]
                else:
                    kept = words
                out.append((len(words), len(words) - len(kept), b" ".join(kept)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.binary())], ["doc_id", "n_words", "n_removed", "text"])

    return map_batches(marked.select("doc_id", "text", "firsts", "ends"), rows, "doc_id long, n_words long, n_removed long, text binary")


def digest(found: DataFrame) -> DataFrame:
    """``remove_repeats`` with the SHA-256 of the kept text instead of the text."""
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
