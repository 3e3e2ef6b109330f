"""Similarity join of documents on word shingles with adaptive multi-match prefixes.

A document is the set of its shingles of five lower-cased (A-Z) words; two documents
link when ``100 * intersection >= percent * union``.

Shingles have one global order. Those whose hash lies in the lowest three tenths of the hash
range come first, rare ones (by exact document frequency) before frequent ones; the others
follow by hash. In a set of n shingles with needed overlap t = ceil(percent * n / 100),
any partner shares at least l of the first n - t + l shingles, for each l up to t. A
document takes the l whose longer prefix costs least: the postings that it meets, plus the
verification of the at most ``postings / l`` documents that can share l of them. A pair must
then share the smaller l of its two documents before its whole sets are compared.

Rows: documents of equal sets are one class, and one of them takes part in the join. Null
and empty texts have no shingles and are linked with nothing; a text of fewer than five
words is one shingle as a whole. Every row gets a result, repeated rows too. Rows that repeat an id with
another text are documents of their own, each with its own links. Rows with a
null id are left out of the result, as they can't be named in it. Other columns are not read.
Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from omnimart.llm import textops
from omnimart.llm.frames import Pins, fresh, map_batches
from omnimart.llm.linking import link

PERCENT = 80
#: Share of the hash range whose shingles are ordered by document frequency.
REGION = 0.3
#: Longest extension of a prefix, in matches.
MOST = 4

_EDGE = np.uint64(int(REGION * 2**64))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, copy, n_shingles and a 128-bit digest of the shingle set (s1, s2)."""

    def run(batches):
        for batch in batches:
            for at, end, h, bounds in textops.word_sets(batch["text"]):
                starts, full = bounds[:-1], np.diff(bounds) > 0
                digest = []
                for salt in (0, 0x5851F42D4C957F2D):
                    total = np.zeros(end - at, dtype=np.uint64)
                    if len(h):
                        total[full] = np.add.reduceat(textops.mix(h ^ np.uint64(salt)), starts[full])
                    digest.append(total.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][at:end], batch["copy"][at:end], pa.array(np.diff(bounds)), *map(pa.array, digest)],
                    ["doc_id", "copy", "n_shingles", "s1", "s2"],
                )

    return map_batches(docs, run, "doc_id long, copy long, n_shingles long, s1 long, s2 long")


def region_postings(docs: DataFrame, percent: int, most: int = MOST) -> DataFrame:
    """Per document: n, the count of its low-range shingles, and rows (token, place) that may be in a prefix.

    ``place`` is 0 for shingles ordered by frequency, else the position in the order.
    """

    def run(batches):
        for batch in batches:
            for at, end, h, bounds in textops.word_sets(batch["text"]):
                n = np.diff(bounds)
                row = np.repeat(np.arange(end - at), n)
                low = np.bincount(row[h < _EDGE], minlength=end - at)
                longest = np.minimum(n - (percent * n + 99) // 100 + most, n)
                nth = np.arange(len(h)) - bounds[row]
                keep = nth < np.maximum(low, longest)[row]
                place = np.where(nth < low[row], 0, nth + 1)[keep].astype(np.int32)
                count = np.bincount(row[keep], minlength=end - at)
                cut = np.concatenate([[0], np.cumsum(count)])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][at:end], pa.array(n.astype(np.int32)), pa.array(low.astype(np.int32)), textops.lists(h[keep].view(np.int64), cut), textops.lists(place, cut)],
                    ["doc_id", "n", "low", "token", "place"],
                )

    lists = map_batches(docs, run, "doc_id long, n int, low int, token array<long>, place array<int>")
    return lists.select("doc_id", "n", "low", F.explode(F.arrays_zip("token", "place")).alias("t")).select("doc_id", "n", "low", "t.token", "t.place")


def prefixes(postings: DataFrame, percent: int, most: int = MOST) -> DataFrame:
    """Postings (bucket, node, need, size, own, core) of each document's adaptive prefix that others share."""
    by_token = Window.partitionBy("token")
    shared = postings.withColumn("df", F.count("*").over(by_token)).where("df > 1")
    # Low-range shingles that no one shares come first in the order: low minus the shared ones.
    by_doc = Window.partitionBy("doc_id")
    in_order = by_doc.orderBy(F.col("place") > 0, F.when(F.col("place") == 0, F.col("df")), F.col("place"), F.col("token")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        shared.withColumn("alone", F.col("low") - F.count(F.when(F.col("place") == 0, 1)).over(by_doc))
        .withColumn("at", F.row_number().over(by_doc.orderBy(*_order())))
        .withColumn("cost", F.sum(F.col("df") - 1).over(in_order))
        .withColumn("at", F.when(F.col("place") > 0, F.col("place")).otherwise(F.col("alone") + F.col("at")))
    )
    needed = F.ceil((F.col("n") * percent) / 100).cast("int")
    least = F.col("n") - needed
    costs = []
    for k in range(1, most + 1):
        met = F.coalesce(F.max(F.when(F.col("at") <= least + k, F.col("cost"))).over(by_doc), F.lit(0))
        # A posting is met by a join row, a candidate by comparing two sets of about n.
        costs.append(F.when(F.lit(k) <= needed, F.struct((met + met / k * F.greatest(F.lit(1.0), F.col("n") / 16)).alias("c"), F.lit(k).alias("need"))))
    return (
        ranked.withColumn("need", F.least(*costs)["need"]).where(F.col("at") <= least + F.col("need"))
        .select(F.col("token").alias("bucket"), F.col("doc_id").alias("node"), "need", F.col("n").alias("size"), (F.col("alone") / F.col("n")).alias("own"), (F.col("at") <= least + 1).alias("core"))
    )


def _order():
    return F.col("place") > 0, F.when(F.col("place") == 0, F.col("df")), F.col("place"), F.col("token")


def similarity_classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every document."""
    return linked_rows(docs, percent).select("doc_id", "n_shingles", "component_id")


def linked_rows(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The classes with copy, the hash of the row's text, and first: whether the row is the first of its component,
    by id and then by copy. Equal rows are first together."""
    pins = Pins(docs.sparkSession)
    docs = fresh(docs, "doc_id", "text").where("doc_id is not null").withColumn("copy", F.xxhash64("text"))
    sets = pins.pin(shingle_sets(docs), "sets")
    own = F.struct("doc_id", "copy")
    classes = sets.where("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min(own).alias("first"))
    members = sets.join(classes, ["n_shingles", "s1", "s2"], "left").withColumn("first", F.coalesce("first", own))
    members = pins.pin(members.select("doc_id", "copy", "n_shingles", "first", F.xxhash64("first.doc_id", "first.copy").alias("node")), "members")
    copies = pins.pin(members.where(F.col("first") != own).select("doc_id", "copy").distinct(), "copies")
    # One document of each class, under the class's number; rows that repeat it count once.
    alone = pins.join(docs, copies, ["doc_id", "copy"], "left_anti").select(F.xxhash64("doc_id", "copy").alias("doc_id"), "text")
    postings = prefixes(region_postings(alone, percent), percent)
    prefix = pins.pin(postings.groupBy("bucket", "node").agg(F.min("need").alias("need"), F.max("size").alias("size"), F.min("own").alias("own"), F.max("core").alias("core")), "prefix")
    wanted = pins.pin(prefix.select("node").distinct(), "wanted")
    texts = pins.pin(pins.join(alone.withColumnRenamed("doc_id", "node"), wanted, "node", "left_semi").dropDuplicates(["node"]), "texts")
    roots = link(prefix, texts, textops.word_sets, percent, pins)
    pins.drop(sets, prefix, texts, wanted)
    # Components carry the smallest id of their documents.
    linked = roots.union(roots.select("root", "root").distinct())
    ids = members.select("node", F.col("first").alias("id")).distinct()
    least = linked.join(ids, "node").groupBy("root").agg(F.min("id").alias("least"))
    named = pins.pin(linked.join(least, "root").select("node", "least"), "named")
    found = pins.join(members, named, "node", "left").withColumn("least", F.coalesce("least", "first"))
    found = pins.pin(found.select("doc_id", "copy", "n_shingles", F.col("least.doc_id").alias("component_id"), (F.col("least") == own).alias("first")), "classes")
    pins.keep_only(found)
    return found
