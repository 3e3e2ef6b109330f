"""Near-duplicate lines by MinHash over character shingles, one kept per component.

A line is what stands between line feeds. Lines that are empty or hold only blanks are left
alone. A line's set holds its runs of ten characters; a shorter line is one run as a whole. Forty
minima of the set in ten bands of four make candidates (a pair of similarity 0.8 meets
with a chance of 99.5 %, one of 0.9 with 99.998 %); candidates are compared by exact Jaccard of their
sets, and lines linked directly or through others form a component. Runs of ten leave lines of fewer than 99
characters with one changed character apart; with ``chars`` = 4 (the pipeline) the bound is 39. Short runs are
common to unlike lines, so other widths than ten take 18 bands of six (99.6 % at 0.8). Of each component,
the occurrence with the smallest (doc_id, line number) stays and all others go.

Null texts stay null, empty ones empty. Of rows that repeat an id and its text, all keep the same lines; rows that repeat
an id with another text are documents of their own, ordered by a hash of the text. Rows with a null id are kept
unchanged, as their lines have no place in the order. Extra columns pass through.
Equal lines are told by a 64-bit hash, shingles of compared lines by its leading 48 bits.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from omnimart.llm import textops
from omnimart.llm.frames import SENT_BYTES, Pins, fresh, map_batches
from omnimart.llm.linking import FINE, MARKS, link, marks

CHARS = 10
BANDS = 10
ROWS = 4
PERCENT = 80

#: Width of the runs that also tells short lines with one changed character, and bands and rows of widths other than CHARS.
SHORT_CHARS = 4
SHORT_BANDS = 18
SHORT_ROWS = 6


def _drawn(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.RandomState(seed)
    multiply = draw.randint(0, 1 << 31, n).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    return multiply, draw.randint(0, 1 << 31, n).astype(np.uint32)


_USUAL, _SHORT = _drawn(77, BANDS * ROWS), _drawn(78, SHORT_BANDS * SHORT_ROWS)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

#: Bits of a hash that ``textops.distinct_leading`` keeps.
LEADING = np.uint64(((1 << 48) - 1) << 16)


def char_shingles(codes: np.ndarray, chars: int = CHARS) -> np.ndarray:
    """Hash of the run of ``chars`` (1 to 15) characters that starts at each place but the last ones."""
    runs = {1: codes.astype(np.uint64) + np.uint64(1)}
    for width, factor in ((2, _A), (4, _B), (8, _C)):
        if width <= chars:
            half = runs[width // 2]
            runs[width] = half[: -width // 2] * factor + half[width // 2 :]
    found, done = None, 0
    for width in sorted(runs, reverse=True):
        if chars & width:
            found = runs[width] if found is None else found[:-width] * _A + runs[width][done:]
            done += width
    return textops.mix(found)


def line_table(texts: list[str]):
    """Code points of many texts, and for each line of more than blanks: text, number, first place, end."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.append(np.flatnonzero(codes == 10), len(codes))
    starts = np.concatenate([[0], ends[:-1] + 1])
    per_text = np.array([t.count("\n") + 1 for t in texts])
    text = np.repeat(np.arange(len(texts)), per_text)
    number = np.arange(len(starts)) - np.repeat(np.concatenate([[0], np.cumsum(per_text)[:-1]]), per_text)
    dark = np.concatenate([[0], np.cumsum((codes != 32) & (codes != 10) & (codes != 9) & (codes != 13))])
    full = dark[ends] > dark[starts]
    return codes, text[full], number[full], starts[full], ends[full]


def line_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = textops.powers(len(codes))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textops.mix(codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)])])
    return textops.mix(((total[ends] - total[starts]) * down[np.minimum(starts, len(down) - 1)]) ^ (ends - starts).astype(np.uint64))


def band_shape(chars: int) -> tuple[int, int]:
    """Bands and their rows."""
    return (BANDS, ROWS) if chars == CHARS else (SHORT_BANDS, SHORT_ROWS)


def bands(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray, chars: int = CHARS) -> np.ndarray:
    """Band keys of each line, shape (lines, bands). ``whole`` are the lines' own hashes."""
    n_bands, n_rows = band_shape(chars)
    multiply, add = _USUAL if chars == CHARS else _SHORT
    low = np.empty((n_bands * n_rows, len(starts)), dtype=np.uint32)
    is_long = ends - starts >= chars
    long, short = np.flatnonzero(is_long), np.flatnonzero(~is_long)
    low[:, short] = whole[short].astype(np.uint32) * multiply[:, None] + add[:, None]
    if len(long):
        # Only windows of these lines; those between two lines cross a line end.
        inside = np.zeros(len(codes) - chars + 2, dtype=np.int8)
        inside[starts[long]] += 1
        inside[ends[long] - chars + 1] -= 1
        h = (char_shingles(codes, chars) >> np.uint64(32)).astype(np.uint32)[np.cumsum(inside, dtype=np.int8)[:-1].view(bool)]
        n = ends[long] - starts[long] - chars + 1
        edges = np.cumsum(n) - n
        drawn = np.empty_like(h)
        for k in range(n_bands * n_rows):
            np.multiply(h, multiply[k], out=drawn)
            np.add(drawn, add[k], out=drawn)
            low[k, long] = np.minimum.reduceat(drawn, edges)
    rows = low.reshape(n_bands, n_rows, len(starts)).astype(np.uint64)
    keys = np.repeat(np.arange(n_bands, dtype=np.uint64)[:, None], len(starts), axis=1)
    for r in range(0, n_rows, 2):
        keys = textops.mix(keys * _A + (rows[:, r] << np.uint64(32)) + rows[:, r + 1])
    return np.ascontiguousarray(keys.T)


def set_sizes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, chars: int = CHARS) -> np.ndarray:
    """Number of different shingles of each line."""
    found = np.ones(len(starts), dtype=np.int64)
    long = np.flatnonzero(ends - starts >= chars)
    h = char_shingles(codes, chars) if len(long) else None
    for at in range(0, len(long), 50_000):
        own = long[at : at + 50_000]
        n = ends[own] - starts[own] - chars + 1
        place = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        _, row = textops.distinct(h[place], np.repeat(np.arange(len(own)), n))
        found[own] = np.bincount(row, minlength=len(own))
    return found


def _texts(batch: pa.RecordBatch):
    """Runs of rows with up to about a megabyte of text: first row, texts."""
    for at, end, raw, bounds in textops.pieces(batch["text"]):
        data = raw.tobytes()
        yield at, [data[i:j].decode("utf-8", "replace") for i, j in zip(bounds[:-1], bounds[1:])]


def line_places(docs: DataFrame, chars: int = CHARS) -> DataFrame:
    """Per line: doc_id, copy (hash of its text, ``docs`` has it), line (number), node (hash) and, once a piece, its band keys."""

    def run(batches):
        for batch in batches:
            for at, texts in _texts(batch):
                codes, text, number, starts, ends = line_table(texts)
                if not len(starts):
                    continue
                node = line_hashes(codes, starts, ends)
                _, first = np.unique(node, return_index=True)
                first.sort()
                keys = bands(codes, starts[first], ends[first], node[first], chars)
                count = np.zeros(len(node), dtype=np.int64)
                count[first] = keys.shape[1]
                row = pa.array(at + text)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(row), batch["copy"].take(row), pa.array(number.astype(np.int32)), pa.array(node.view(np.int64)), textops.lists(keys.ravel().view(np.int64), np.concatenate([[0], np.cumsum(count)]))],
                    ["doc_id", "copy", "line", "node", "keys"],
                )

    return map_batches(docs, run, "doc_id long, copy long, line int, node long, keys array<long>")


def sized_lines(lines: DataFrame, chars: int = CHARS) -> DataFrame:
    """``lines`` (node, text) with size, the number of different shingles, and their marks and finer marks."""

    def run(batches):
        for batch in batches:
            sizes, fine = [np.zeros(0, np.int64)], [np.zeros((0, FINE), np.int64)]
            for _, _, h, bounds in line_sets(batch["text"], chars):
                sizes.append(np.diff(bounds))
                fine.append(marks(h, bounds, FINE))
            fine = np.concatenate(fine)
            # A parity of the marks is that of the fine ones that fall together there.
            signs = np.bitwise_xor.reduce(fine.reshape(len(fine), FINE // MARKS, MARKS), axis=1)
            lists = [textops.lists(x.ravel(), np.arange(len(x) + 1) * x.shape[1]) for x in (signs, fine)]
            yield pa.RecordBatch.from_arrays([batch["node"], batch["text"], pa.array(np.concatenate(sizes)), *lists], ["node", "text", "size", "marks", "fine"])

    return map_batches(lines, run, "node long, text string, size long, marks array<long>, fine array<long>")


def line_rows(docs: DataFrame, chars: int = CHARS) -> DataFrame:
    """Per line: doc_id, line (number), node (hash), size (different shingles) and, once a piece, its band keys."""

    def run(batches):
        for batch in batches:
            for at, texts in _texts(batch):
                codes, text, number, starts, ends = line_table(texts)
                if not len(starts):
                    continue
                node = line_hashes(codes, starts, ends)
                _, first, back = np.unique(node, return_index=True, return_inverse=True)
                keys = np.zeros((len(node), 0), dtype=np.uint64)
                keys = bands(codes, starts[first], ends[first], node[first], chars) if _ordered(starts[first]) else _banded(codes, starts, ends, node, first, chars)
                size = set_sizes(codes, starts[first], ends[first], chars)[back]
                has = np.zeros(len(node), dtype=bool)
                has[first] = True
                count = np.where(has, band_shape(chars)[0], 0)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(at + text)), pa.array(number.astype(np.int32)), pa.array(node.view(np.int64)), pa.array(size), textops.lists(keys[back[has]].ravel().view(np.int64), np.concatenate([[0], np.cumsum(count)]))],
                    ["doc_id", "line", "node", "size", "keys"],
                )

    return map_batches(docs, run, "doc_id long, line int, node long, size long, keys array<long>")


def _ordered(starts: np.ndarray) -> bool:
    return bool(np.all(np.diff(starts) > 0))


def _banded(codes, starts, ends, node, first, chars):
    """Band keys of the lines in ``first``, whatever their order."""
    order = np.argsort(starts[first])
    found = np.empty((len(first), band_shape(chars)[0]), dtype=np.uint64)
    found[order] = bands(codes, starts[first][order], ends[first][order], node[first][order], chars)
    return found


def line_sets(lines: pa.Array, chars: int = CHARS):
    """Sets of character shingles of texts that are one line each; see ``textops.word_sets``."""
    for at, end, raw, bounds in textops.pieces(lines):
        data = raw.tobytes()
        texts = [data[i:j].decode("utf-8", "replace") for i, j in zip(bounds[:-1], bounds[1:])]
        if len(texts) == 1 and len(texts[0]) >= chars:
            # It may be a very long line, whose places would take several times its memory.
            h = np.unique(char_shingles(np.frombuffer(texts[0].encode("utf-32-le"), dtype=np.uint32), chars) & LEADING)
            yield at, end, h, np.array([0, len(h)])
            continue
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        length = np.array([len(t) for t in texts])
        ends = np.cumsum(length)
        starts = ends - length
        n = np.where(length >= chars, length - chars + 1, 0)
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)
        short = np.flatnonzero(n == 0)
        h = char_shingles(codes, chars)[place] if len(row) else np.zeros(0, np.uint64)
        h, row = np.concatenate([h, line_hashes(codes, starts[short], ends[short])]), np.concatenate([row, short])
        h, row = textops.distinct_leading(h, row)
        yield at, end, h, np.searchsorted(row, np.arange(len(n) + 1))


def wanted_lines(docs: DataFrame) -> DataFrame:
    """Texts of the lines whose numbers a row lists in ``numbers`` with their ``nodes``."""
    # The lambda holds a text's lines, so that a text is split once and not for each of its numbers.
    texts = F.flatten(F.transform(F.array(F.split("text", "\n", -1)), lambda lines: F.transform("numbers", lambda k: F.get(lines, k))))
    return docs.select(F.inline(F.arrays_zip("nodes", texts))).toDF("node", "text").where("text is not null")


def removals(docs: DataFrame, pins: Pins, percent: int = PERCENT, chars: int = CHARS) -> tuple[DataFrame, DataFrame]:
    """Line occurrences (doc_id, copy, line, node, component, kept), and the pinned numbers to drop by document and copy."""
    docs = fresh(docs, "doc_id", "text").where("doc_id is not null").withColumn("copy", F.xxhash64("text"))
    # Keys are needed twice: to find the buckets of several lines, and then those lines. They go before the lines do.
    keys = pins.pin(line_places(docs, chars), "line-keys")
    lines = pins.pin(keys.select("doc_id", "copy", "line", "node"), "lines")
    every = keys.select("node", F.explode("keys").alias("bucket"))
    spans = every.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    buckets = pins.pin(spans.select("bucket"), "buckets")
    shared = pins.pin(pins.join(every, buckets, "bucket", "left_semi").distinct(), "shared")
    pins.drop(keys, buckets)
    nodes = pins.pin(shared.select("node").distinct(), "nodes")
    owners = pins.join(lines, nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "copy", "line")).alias("o"))
    listed = owners.groupBy("o.doc_id", "o.copy").agg(F.collect_list(F.struct("node", "o.line")).alias("w"))
    wanted = pins.pin(listed.select("doc_id", "copy", F.col("w.node").alias("nodes"), F.col("w.line").alias("numbers")), "wanted")
    texts = pins.pin(sized_lines(wanted_lines(pins.join(docs, wanted, ["doc_id", "copy"])).dropDuplicates(["node"]), chars), "line-texts")
    sized = shared.join(texts.select("node", "size", "marks"), "node").select("bucket", "node", "size", "marks")
    postings = pins.pin(sized.select("*", F.lit(1).alias("need"), F.lit(0).alias("own"), F.lit(True).alias("core")), "postings")
    pins.drop(shared, nodes, wanted)
    roots = link(postings, texts, partial(line_sets, chars=chars), percent, pins)
    pins.drop(postings, texts)
    at = F.struct("doc_id", "copy", "line")
    placed = pins.join(lines, roots, "node", "left").select("doc_id", "copy", "line", "node", F.coalesce("root", "node").alias("component"))
    # Most lines stand alone; only the places of the others are compared.
    several = placed.groupBy("component").count().where("count > 1").select("component")
    several = pins.pin(several, "several")
    kept = pins.join(placed, several, "component", "left_semi").groupBy("component").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last").select("component", "first")
    kept = pins.pin(kept, "kept")
    gone = pins.join(placed, kept, "component").where(at != F.col("first"))
    drops = pins.pin(gone.groupBy("doc_id", "copy").agg(F.collect_set("line").alias("gone")), "drops")
    judged = placed.join(kept, "component", "left").select("doc_id", "copy", "line", "node", "component", (F.col("first").isNull() | (at == F.col("first"))).alias("kept"))
    return judged, drops


def dedup_lines(docs: DataFrame, percent: int = PERCENT, chars: int = CHARS) -> DataFrame:
    """``docs`` with every line gone whose component has an earlier one, and n_lines and n_removed."""
    pins = Pins(docs.sparkSession)
    if {"n_lines", "n_removed"} & set(docs.columns):
        raise ValueError("the input has a column n_lines or n_removed")
    _, drops = removals(docs, pins, percent, chars)
    pins.keep_only(drops)
    gone = drops.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), F.col("gone").alias("_gone"))
    fits = pins.size(drops) <= SENT_BYTES
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_copy"))
    marked = docs.join(F.broadcast(gone) if fits else gone, same, "left")
    cut = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    return marked.select(
        *(F.when(F.col("_gone").isNull(), F.col("text")).otherwise(cut).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns),
        F.coalesce(1 + F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).alias("n_removed"),
    )
