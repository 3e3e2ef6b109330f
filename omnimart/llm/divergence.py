"""Audit of sources: how far the term shares of each source lie from its language's and from other sources'.

Terms are runs of ASCII letters and bytes of other scripts, A-Z lower-cased. A language keeps the V terms that at least
``least_docs`` of its documents hold. In a group (a language's source, or the whole language) with N occurrences of kept terms,
a term with c of them has the share p = 1 + floor(10^9 (c + 1) / (N + V)). The divergence of p from q is
floor((p - q)^2 / q). All arithmetic is in integers.

* Part ``pair``: each other source of the language, with the sum of the divergences of the group from it over all kept terms.
* Part ``term``: kept terms of the group with p above the language's share, the ``top`` largest.

Two passes over the texts. The first counts the documents of each term exactly and drops rare terms. The kept ones go, by
hash, into shards of about ``SHARD_TERMS`` terms, each with a minimal perfect hash and its stored terms (``perfect_hash``).
The second pass looks every term up and adds to a dense array of slots for each group it meets.

All perfect hashes together are sent to every worker if they have at most ``SENT_BYTES``. A larger vocabulary may have no room
in a worker, and instead of the hashes the terms travel: each task counts its terms by group and sends the counts
to the task that has their shard. Both give the same counts.

Null text, language and source count as empty strings. Groups without terms are groups like others, with N = 0; a language
without kept terms has pairs of value 0. Repeated rows count each for itself. No documents give no rows. Other columns
than text, lang and source are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from omnimart.llm import perfect_hash
from omnimart.llm.frames import Pins, fresh, map_batches, ship

LEAST_DOCS = 3
TOP = 200
UNIT = 1000  # 10^9 is taken in three steps, so that no product leaves 64 bits
SHARD_TERMS = 32_768
SENT_BYTES = 32 << 20
#: Different terms that a task holds before it settles its counts.
HELD = 200_000
#: Slots of groups that a task holds before it hands them on.
SLOTS = 8 << 20
#: Sources of a language that are compared in one task, at most.
SOURCES = 64

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
COUNTS = "lang string, source string, shard int, slots binary, counts binary, n long"


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


def shares(counts: np.ndarray, n: int, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / (n + kept)), exact for up to 9 * 10^15 occurrences."""
    rest, found, all_ = counts.astype(np.int64) + 1, np.zeros(len(counts), dtype=np.int64), n + kept
    for _ in range(3):
        rest *= UNIT
        found = found * UNIT + rest // all_
        rest %= all_
    return found + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def document_frequencies(docs: DataFrame) -> DataFrame:
    """Number of rows that hold a term: lang, term, n_docs. Tasks add up their own rows first."""

    def rows(held: dict[str, Counter]) -> pa.RecordBatch:
        langs = pa.array([lang for lang, c in held.items() for _ in range(len(c))], pa.string())
        out = [langs, pa.array([t for c in held.values() for t in c], pa.binary()), pa.array([n for c in held.values() for n in c.values()], pa.int64())]
        held.clear()
        return pa.RecordBatch.from_arrays(out, ["lang", "term", "n_docs"])

    def run(batches):
        held: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                held[lang].update(set(terms_of(text)))
            if sum(map(len, held.values())) > HELD:
                yield rows(held)
        yield rows(held)

    found = map_batches(docs.select("text", "lang"), run, "lang string, term binary, n_docs long")
    return found.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"))


def build_hashes(kept: DataFrame) -> DataFrame:
    """Perfect hash of each shard of ``kept`` (lang, term, shards): lang, shard, shards, terms (how many), hash."""

    def assign(batches):
        for batch in batches:
            h = perfect_hash.hashes(batch["term"].to_pylist())
            of = batch["shards"].to_numpy().astype(np.uint64)
            at = ((h >> np.uint64(32)) % of).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(at), batch["shards"], batch["term"]], ["lang", "shard", "shards", "term"])

    def build(group: pa.Table) -> pa.Table:
        terms = sorted(group["term"].to_pylist())
        return pa.table({"lang": group["lang"][:1], "shard": group["shard"][:1], "shards": group["shards"][:1], "terms": pa.array([len(terms)], pa.int32()), "hash": pa.array([perfect_hash.build(terms)], pa.binary())})

    placed = map_batches(kept.select("lang", "shards", "term"), assign, "lang string, shard int, shards int, term binary")
    return placed.groupBy("lang", "shard").applyInArrow(build, "lang string, shard int, shards int, terms int, hash binary")


class _Slots:
    """Dense counts of each group, a shard at a time where the shard has been met."""

    def __init__(self):
        self.held: dict[tuple[str, str, int], np.ndarray] = {}
        self.size = 0

    def add(self, lang: str, source: str, index: perfect_hash.PerfectHashes, terms: list[bytes], counts: list[int]) -> None:
        slot = index.slots(terms)
        known = slot >= 0
        slot, n = slot[known], np.array(counts, dtype=np.int64)[known]
        order = np.argsort(slot)
        slot, n = slot[order], n[order]
        shard = np.searchsorted(index.base, slot, side="right") - 1
        for k in np.unique(shard).tolist():
            own = slice(*np.searchsorted(shard, [k, k + 1]))
            dense = self.held.get((lang, source, k))
            if dense is None:
                dense = self.held[lang, source, k] = np.zeros(index.base[k + 1] - index.base[k], dtype=np.int64)
                self.size += len(dense)
            dense[slot[own] - index.base[k]] += n[own]

    def rows(self) -> pa.RecordBatch:
        out = []
        for (lang, source, shard), dense in self.held.items():
            there = np.flatnonzero(dense)
            out.append((lang, source, shard, there.astype(np.uint32).tobytes(), dense[there].tobytes(), int(dense.sum())))
        self.__init__()
        return _rows(out)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], ["lang", "source", "shard", "slots", "counts", "n"])


def _group_terms(batches, settle):
    """Counts of terms by group; ``settle`` turns them into rows when many are held and at the end (second argument)."""
    held: dict[tuple[str, str], Counter] = defaultdict(Counter)
    for batch in batches:
        for text, *group in zip(*(batch[c].to_pylist() for c in ("text", "lang", "source"))):
            held[tuple(group)].update(terms_of(text))
        if sum(map(len, held.values())) > HELD:
            yield from settle(held, False)
            held.clear()
    yield from settle(held, True)


def recount_sent(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """Counts by group and shard, a row a task, with all perfect hashes on every worker."""
    by_lang: dict[str, tuple[dict[int, bytes], int]] = {}
    for row in hashes.select("lang", "shard", "shards", "hash").collect():
        by_lang.setdefault(row.lang, ({}, row.shards))[0][row.shard] = bytes(row.hash)
    kept = docs.sparkSession.sparkContext.broadcast(by_lang)

    def run(batches):
        indexes = {lang: perfect_hash.PerfectHashes(*parts) for lang, parts in kept.value.items()}
        slots = _Slots()

        def settle(held, last):
            for (lang, source), counts in held.items():
                if lang in indexes:
                    slots.add(lang, source, indexes[lang], list(counts), list(counts.values()))
                    if slots.size > SLOTS:
                        yield slots.rows()
            if last:
                yield slots.rows()

        yield from _group_terms(batches, settle)

    return map_batches(docs, run, COUNTS)


def recount_routed(docs: DataFrame, hashes: DataFrame, vocabulary: DataFrame, pins: Pins, parts: int) -> DataFrame:
    """Counts by group and shard where each shard's perfect hash is in one task only and the terms' counts are sent to it.

    ``vocabulary`` (lang, shards) is a pinned table.
    """

    def count(batches):
        def settle(held, _):
            for (lang, source), counts in held.items():
                yield _terms([(lang, source, list(counts), list(counts.values()))])

        yield from _group_terms(batches, settle)

    def cut(batches):
        for batch in batches:
            for lang, source, of, blob, counts in zip(*(batch[c].to_pylist() for c in ("lang", "source", "shards", "terms", "counts"))):
                terms, n = blob.split(b" "), np.frombuffer(counts, dtype=np.int64)
                shard = perfect_hash.shard_of(perfect_hash.hashes(terms), of)
                order = np.argsort(shard, kind="stable")
                ends = np.searchsorted(shard[order], np.arange(of + 1))
                for k in np.flatnonzero(np.diff(ends)).tolist():
                    own = order[ends[k] : ends[k + 1]]
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([k], pa.int32()), pa.array([source]), pa.array([b" ".join(terms[i] for i in own)], pa.binary()), pa.array([n[own].tobytes()], pa.binary())], ["lang", "shard", "source", "terms", "counts"])

    def look_up(batches):
        slots, at, index = _Slots(), None, None
        for batch in batches:
            for lang, shard, source, blob, counts in zip(*(batch[c].to_pylist() for c in ("lang", "shard", "source", "terms", "counts"))):
                if (lang, shard) != at:
                    if slots.held:
                        yield _numbered(slots.rows(), at[1])
                    at, index = (lang, shard), None
                if source is None:  # the shard's own row, which comes first
                    index = perfect_hash.PerfectHashes({0: blob}, 1)
                elif index is not None:  # else no kept term fell into the shard
                    slots.add(lang, source, index, blob.split(b" "), np.frombuffer(counts, dtype=np.int64))
                if slots.size > SLOTS:
                    yield _numbered(slots.rows(), shard)
        if slots.held:
            yield _numbered(slots.rows(), at[1])

    counted = map_batches(docs, count, "lang string, source string, terms binary, counts binary")
    sent = map_batches(pins.join(counted, vocabulary, "lang").select("lang", "source", "shards", "terms", "counts"), cut, "lang string, shard int, source string, terms binary, counts binary")
    own = hashes.select("lang", "shard", F.lit(None).cast("string").alias("source"), F.col("hash").alias("terms"), F.lit(None).cast("binary").alias("counts"))
    dealt = own.unionByName(sent).repartition(parts, "lang", "shard").sortWithinPartitions("lang", "shard", F.asc_nulls_first("source"))
    return map_batches(dealt, look_up, COUNTS)


def _numbered(rows: pa.RecordBatch, shard: int) -> pa.RecordBatch:
    return rows.set_column(2, "shard", pa.array([shard] * rows.num_rows, pa.int32()))


def _terms(rows: list[tuple]) -> pa.RecordBatch:
    out = [(lang, source, b" ".join(terms), np.array(counts, dtype=np.int64).tobytes()) for lang, source, terms, counts in rows if terms]
    kinds = (pa.string(), pa.string(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], ["lang", "source", "terms", "counts"])


def merge(partial: DataFrame, parts: int) -> DataFrame:
    """One row for each group and shard; a shard's rows pass a task one by one. A null source stands for the whole language."""

    def run(batches):
        at, source, own, whole = None, None, {}, {}

        def added(into: dict, slots: bytes, counts: bytes) -> None:
            slots, counts = np.frombuffer(slots, np.uint32), np.frombuffer(counts, np.int64)
            size = int(slots[-1]) + 1 if len(slots) else 0
            dense = into.get("dense", np.zeros(0, np.int64))
            if len(dense) < size:
                dense = into["dense"] = np.concatenate([dense, np.zeros(size - len(dense), np.int64)])
            dense[slots] += counts

        def row(name, into: dict) -> tuple:
            there = np.flatnonzero(dense := into.pop("dense", np.zeros(0, np.int64)))
            return *at, name, there.astype(np.uint32).tobytes(), dense[there].tobytes(), int(dense.sum())

        def given(rows):
            return _rows([(lang, name, shard, *rest) for lang, shard, name, *rest in rows])

        for batch in batches:
            out = []
            for lang, name, shard, slots, counts in zip(*(batch[c].to_pylist() for c in ("lang", "source", "shard", "slots", "counts"))):
                if at is not None and ((lang, shard), name) != (at, source):
                    out.append(row(source, own))
                    if (lang, shard) != at:
                        out.append(row(None, whole))
                at, source = (lang, shard), name
                added(own, slots, counts)
                added(whole, slots, counts)
            yield given(out)
        if at is not None:
            yield given([row(source, own), row(None, whole)])

    return map_batches(partial.repartition(parts, "lang", "shard").sortWithinPartitions("lang", "shard", "source"), run, COUNTS)


def _dense(slots: bytes | None, counts: bytes | None, size: int) -> np.ndarray:
    found = np.zeros(size, dtype=np.int64)
    if slots:
        found[np.frombuffer(slots, np.uint32)] = np.frombuffer(counts, np.int64)
    return found


def compare(key: tuple, sides: pa.Table, shard: pa.Table, top: int) -> pa.Table:
    """Pairs of the sources of two blocks over one shard's terms, and, where the blocks are the same one, its sources' terms."""
    out: dict[str, list] = {"lang": [], "source": [], "part": [], "item": [], "value": []}
    if not shard.num_rows:  # no source of the first block
        return pa.table({c: pa.array(x, pa.int64() if c == "value" else pa.string()) for c, x in out.items()})
    block = shard.to_pylist()[0]
    size, kept = block["terms"], block["kept"]
    groups = {0: [], 1: []}
    for r in sides.to_pylist():
        counts = _dense(r["slots"], r["counts"], size)
        groups[r["side"]].append((r["source"], counts, shares(counts, r["n_all"], kept)))

    def put(source, part, item, value):
        for column, x in zip(out.values(), (block["lang"], source, part, item, value)):
            column.append(x)

    for a, _, p in groups[0]:
        for b, _, q in groups[1]:
            if a != b:
                put(a, "pair", b, int(divergence(p, q).sum()))
    if key[2] == key[3]:
        names = perfect_hash.PerfectHashes({0: block["hash"]}, 1).terms(0, size)
        q = shares(_dense(block["slots"], block["counts"], size), block["n_all"], kept)
        for a, counts, p in groups[0]:
            own = np.flatnonzero((counts > 0) & (p > q))
            value = divergence(p[own], q[own])
            if len(own) > top:
                # Only values from the last place upwards can be among the first; of equal ones the names decide.
                high = value >= np.partition(value, len(value) - top)[len(value) - top]
                own, value = own[high], value[high]
            for least, name in sorted((-v, names[i]) for v, i in zip(value.tolist(), own.tolist()))[:top]:
                put(a, "term", name.decode("utf-8", "replace"), -least)
    return pa.table({c: pa.array(x, pa.int64() if c == "value" else pa.string()) for c, x in out.items()})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, shard_terms: int = SHARD_TERMS, sent_bytes: int = SENT_BYTES, sources: int = SOURCES) -> DataFrame:
    """Rows lang, source, part, item, value, rank (from 1 by group and part, value falling, then the item's bytes)."""
    spark = docs.sparkSession
    pins, parts = Pins(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = fresh(docs, "text", "lang", "source").select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")))
    groups = pins.pin(docs.select("lang", "source").distinct(), "groups")
    kept = pins.pin(document_frequencies(docs).where(F.col("n_docs") >= least_docs), "kept")
    sized = kept.groupBy("lang").agg(F.count("*").alias("kept")).withColumn("shards", F.ceil(F.col("kept") / shard_terms).cast("int"))
    vocabulary = pins.pin(sized, "vocabulary")
    hashes = pins.pin(build_hashes(pins.join(kept, vocabulary, "lang")), "perfect-hashes")
    pins.drop(kept)
    stored = hashes.agg(F.sum(F.length("hash"))).first()[0] or 0
    partial = recount_sent(docs, hashes) if stored <= sent_bytes else recount_routed(docs, hashes, vocabulary, pins, parts)
    counts = pins.pin(merge(partial, parts), "counts")

    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    blocks = F.pmod(F.xxhash64("source"), F.ceil(F.col("sources") / sources))
    named = groups.join(groups.groupBy("lang").agg(F.count("*").alias("sources")), "lang").withColumn("block", blocks)
    named = pins.pin(named.join(totals, ["lang", "source"], "left").withColumn("n_all", F.coalesce("n_all", F.lit(0))), "named")
    # Every group has a row for every shard of its language, also where it has none of its terms.
    every = named.join(hashes.select("lang", "shard"), "lang").join(counts.where("source is not null"), ["lang", "source", "shard"], "left")
    count = F.ceil(F.col("sources") / sources)
    other = F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("other")
    one = every.select("*", other).select("lang", "shard", F.col("block").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), "source", "slots", "counts", "n_all")
    two = every.select("*", other).select("lang", "shard", F.col("other").alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"), "source", "slots", "counts", "n_all")
    whole = totals.where("source is null").select("lang", "n_all")
    at = ["lang", "shard", "i", "j"]
    keys = one.select(*at).distinct().select(*(F.col(c).alias(c) for c in at))
    # A shard of which no document of the second pass has a term cannot be, but the left joins do not rely on it.
    own = keys.join(hashes.drop("shards"), ["lang", "shard"]).join(vocabulary, "lang").join(whole, "lang", "left")
    own = own.join(counts.where("source is null").select("lang", "shard", "slots", "counts"), ["lang", "shard"], "left").withColumn("n_all", F.coalesce("n_all", F.lit(0)))

    def run(key, sides, shard):
        return compare(tuple(k.as_py() for k in key), sides, shard, top)

    ship(spark)
    schema = "lang string, source string, part string, item string, value long"
    found = pins.pin(one.unionByName(two).groupBy(*at).cogroup(own.groupBy(*at)).applyInArrow(run, schema), "divergences")
    pins.keep_only(found, groups, vocabulary)
    # A language without kept terms has no shard: its pairs are of value 0.
    bare = groups.join(vocabulary, "lang", "left_anti")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(none).withColumn("rank", F.row_number().over(place))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return ranked.unionByName(terms)
