"""Connected components from postings, without listing the pairs of a bucket.

A posting says that a node stands in a bucket; nodes that share enough buckets are candidates,
and a candidate pair is linked if the two shingle sets are similar enough.

1. The hub of a bucket is its most typical node (fewest shingles of its own). Every node is
   compared with the hub that it shares most buckets with, and then with its other hubs that this has not yet linked
   it to. That is a number of pairs in proportion to the postings. Nodes and all their hubs form families,
   whether or not they are similar.
2. Most families are now one component. In the others, nodes of different components are
   compared in blocks of bounded size; a block of one component is not compared with its like. A pair of blocks
   returns a spanning forest of the components that it joins, so fewer links than it has nodes. With marks (see below),
   families of up to FAMILY_NODES nodes are compared in pairs instead. Larger ones are chains of unlike nodes, whose
   square would outgrow the input: there each component is a family of its own, and step 3 compares what shares a bucket.
3. Nodes of different families that share a core bucket and have sizes of the same or of neighbouring
   classes are a group. In a group with few pairs between its families they are compared in pairs, if they
   share enough buckets; in a larger group in blocks. With marks, the nodes of a bucket but its hub are a group, one of many nodes by class, and marks
   are compared where the group lies, so that pairs are written only if their marks let them pass.

So a bucket of many copies costs one comparison a copy, and no link between different
components is left out. After the first step components are found on the components so far and the new
links between them, not on all links again.

Postings may have ``marks``: 256 parities of a node's shingles, by hash. Shingles that two nodes share cancel out in the
marks' difference, so that this has at most as many bits as there are shingles in one of the nodes only. Candidates
whose marks differ by more than the similarity allows are no links and are left before their texts are read; they make
no family either, else chains of unlike nodes would grow into families that are compared as a whole. If ``texts`` has
``fine``, 1024 such parities, pairs are judged by these, too, before their texts are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from omnimart.llm import textops
from omnimart.llm.frames import SENT_BYTES, Pins, map_batches, ship

#: Cuts a text column into runs of rows with the hashes of each row's ascending shingle set.
Sets = Callable[[pa.Array], Iterator[tuple[int, int, np.ndarray, np.ndarray]]]

#: Bounds of a block: shingles and nodes.
BLOCK_SHINGLES = 32_768
BLOCK_NODES = 256
#: Pairs between the families of a group that are compared as pairs; the nodes of a larger group are compared in blocks.
FEW = 4096
#: With marks, groups of up to so many nodes are compared as pairs, if their marks leave few of them.
FEW_NODES = 4096
#: With marks, families of up to so many nodes are compared as a whole, and larger ones bucket by bucket.
FAMILY_NODES = 64
#: Words of 64 parities.
MARKS = 4
#: Words of the finer marks, which stand with the texts: long sets fill the first ones, so that unlike pairs pass them.
FINE = 16


def components(edges: DataFrame, pins: Pins) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (a, b): columns node, root.

    Alternates two steps until only stars are left: each node hands its smallest neighbour to
    its larger neighbours, then to its smaller ones. Every step is a grouping and a join
    on the shuffled edge table; nothing is gathered on the driver but whether a node is left
    that stands on both sides or has two smaller neighbours.
    """
    now = pins.pin(_forward(edges), "edges")
    while _unfinished(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")
        down = large.where("a <> b")
        smallest = down.groupBy("b").agg(F.min("a").alias("m"))
        small = down.join(smallest, "b")
        spread = small.select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        after = pins.pin(_forward(spread), "edges")
        pins.drop(now)
        now = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _unfinished(edges: DataFrame) -> bool:
    sides = edges.select("a", "b").withColumn("s", F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    seen = sides.select(F.explode("s").alias("s")).groupBy("s.node").agg(F.sum("s.up").alias("up"), F.sum("s.down").alias("down"))
    return bool(seen.where("down > 1 or (up > 0 and down > 0)").take(1))


def _forward(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _fits(x, y, percent: int):
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def marks(h: np.ndarray, bounds: np.ndarray, words: int = MARKS) -> np.ndarray:
    """Parities of each row's distinct hashes, shape (rows, words)."""
    n, width = len(bounds) - 1, 64 * words
    cell = np.repeat(np.arange(n), np.diff(bounds)) * width + (h >> np.uint64(40)).astype(np.int64) % width
    odd = (np.bincount(cell, minlength=n * width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(n, words)


def _alike(x, y, size_x, size_y, percent: int, words: int = MARKS):
    """Whether two nodes' marks let their sets reach the similarity, which bounds the shingles that one of them has only."""
    differ = sum((F.bit_count(x[k].bitwiseXOR(y[k])) for k in range(words)), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (size_x + size_y)


def verify_pairs(pairs: DataFrame, texts: DataFrame, sets: Sets, percent: int, pins: Pins | None = None) -> DataFrame:
    """Pairs (a, b) whose whole sets reach the similarity. With ``fine`` in ``texts``, and ``pins``, only texts of pairs that these let pass are dealt out."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            kept = np.zeros(n, dtype=bool)
            # The two rows of a pair lie next to each other, so that one set at most waits for its partner.
            both = pa.concat_arrays([batch[c].cast(pa.large_string()) for c in ("ta", "tb")]).take(pa.array(np.arange(2 * n).reshape(2, n).T.ravel()))
            waiting = None
            for at, end, h, bounds in sets(both):
                for k in range(at, end):
                    own = h[bounds[k - at] : bounds[k - at + 1]]
                    if k % 2:
                        kept[k // 2] = textops.jaccard_at_least(waiting, own, percent)
                    else:
                        waiting = own.copy()
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(kept))

    if "fine" in texts.columns:
        left, right = (texts.select(F.col("node").alias(s), F.col("size").alias(f"s{s}"), F.col("fine").alias(f"f{s}")) for s in "ab")
        near = _alike(F.col("fa"), F.col("fb"), F.col("sa"), F.col("sb"), percent, FINE)
        pairs = pairs.join(left, "a").join(right, "b").where(near).select("a", "b")
        if pins is not None:
            pairs = pins.pin(pairs, "near-pairs")
            texts = _texts_of(texts, pairs.select(F.explode(F.array("a", "b")).alias("node")), pairs, pins)
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb"), run, "a long, b long")


def _similar(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of two lists of distinct hashes reach the similarity."""
    size_l, size_r = (np.array([len(x) for x in side], dtype=np.int64) for side in (left, right))
    flat_l, flat_r = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(flat_l, flat_r)
    places = []
    for flat, size in ((flat_l, size_l), (flat_r, size_r)):
        at = np.searchsorted(both, flat)
        at[at == len(both)] = 0
        there = both[at] == flat if len(both) else np.zeros(len(flat), dtype=bool)
        places.append((np.repeat(np.arange(len(size)), size)[there], at[there]))
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, len(both), 4096):
        width = min(4096, len(both) - first)
        grids = []
        for (row, at), n in zip(places, (len(left), len(right))):
            own = (at >= first) & (at < first + width)
            grid = np.zeros((n, width), dtype=np.float32)
            grid[row[own], at[own] - first] = 1
            grids.append(grid)
        common += grids[0] @ grids[1].T
    common = common.astype(np.int64)
    return (common > 0) & (100 * common >= percent * (size_l[:, None] + size_r[None, :] - common))


def _may(size_l: np.ndarray, size_r: np.ndarray, marks_l: np.ndarray, marks_r: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of two lists of sets may reach the similarity by their sizes and marks."""
    differ = np.zeros((len(size_l), len(size_r)), dtype=np.int64)
    for k in range(MARKS):
        differ += np.bitwise_count(marks_l[:, None, k].view(np.uint64) ^ marks_r[None, :, k].view(np.uint64))
    return (100 + percent) * differ <= (100 - percent) * (size_l[:, None] + size_r[None, :])


def alike_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Per group of ``members`` (bucket, class, node, size, family, signs) the pairs (a, b) of different families that sizes and signs let
    pass, or, if they are more than FEW, one row without nodes. Groups are sorted, not gathered; small ones are compared many at once."""

    few = FEW

    def judged(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, part, node, size, family = (rows[c].to_numpy() for c in ("bucket", "class", "node", "size", "family"))
        signs = rows["signs"].combine_chunks()
        words, at = np.diff(signs.offsets.to_numpy()), signs.offsets.to_numpy()[:-1].astype(np.int64)
        flat = signs.values.to_numpy().view(np.uint64)
        long = np.flatnonzero(words == FINE)
        coarse = np.empty((len(node), MARKS), dtype=np.uint64)
        coarse[words == MARKS] = flat[at[words == MARKS][:, None] + np.arange(MARKS)]
        fine = flat[at[long][:, None] + np.arange(FINE)]
        coarse[long] = np.bitwise_xor.reduce(fine.reshape(len(long), FINE // MARKS, MARKS), axis=1)
        place = np.full(len(node), -1)
        place[long] = np.arange(len(long))
        new = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])))
        group = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(node))))
        end = np.append(new, len(node))[group + 1]
        found, total = [], np.zeros(len(new), dtype=np.int64)
        own = np.arange(len(node))
        for away in range(1, int((end - own).max(initial=0))):
            own = own[own + away < end[own]]
            own = own[total[group[own]] <= few]
            i, j = own, own + away
            keep = (family[i] != family[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
            i, j = i[keep], j[keep]
            bound = (100 - percent) * (size[i] + size[j])
            keep = (100 + percent) * np.bitwise_count(coarse[i] ^ coarse[j]).sum(axis=1, dtype=np.int64) <= bound
            i, j, bound = i[keep], j[keep], bound[keep]
            both = np.flatnonzero((place[i] >= 0) & (place[j] >= 0))
            far = (100 + percent) * np.bitwise_count(fine[place[i[both]]] ^ fine[place[j[both]]]).sum(axis=1, dtype=np.int64) > bound[both]
            keep = np.ones(len(i), dtype=bool)
            keep[both[far]] = False
            found.append((i[keep], j[keep]))
            total += np.bincount(group[i[keep]], minlength=len(new))
        i, j = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
        keep = total[group[i]] <= few
        i, j, crowded = i[keep], j[keep], new[total > few]
        where = pa.array(np.concatenate([i, crowded]))
        nodes = [pa.concat_arrays([pa.array(f(node[i], node[j])), pa.nulls(len(crowded), pa.int64())]) for f in (np.minimum, np.maximum)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket).take(where), pa.array(part).take(where), *nodes], ["bucket", "class", "a", "b"])

    def run(batches):
        waiting, group = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, part = batch["bucket"].to_numpy(), batch["class"].to_numpy()
            # The last group may go on in the next batch.
            done = int(np.count_nonzero((bucket != bucket[-1]) | (part != part[-1])))
            if waiting and (done or group != (bucket[-1], part[-1])):
                yield from judged(pa.Table.from_batches([*waiting, batch.slice(0, done)]))
                waiting = []
            elif done:
                yield from judged(pa.Table.from_batches([batch.slice(0, done)]))
            waiting.append(batch.slice(done))
            group = bucket[-1], part[-1]
        if waiting:
            yield from judged(pa.Table.from_batches(waiting))

    sorted_rows = members.select("bucket", "class", "node", "size", "family", "signs").repartition("bucket", "class").sortWithinPartitions("bucket", "class")
    return map_batches(sorted_rows, run, "bucket long, class long, a long, b long")


def _links(left: list[np.ndarray], right: list[np.ndarray], may: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs in ``may`` that reach the similarity."""
    a, b = np.nonzero(may)
    if len(a) <= len(left) + len(right):
        same = np.array([textops.jaccard_at_least(left[i], right[j], percent) for i, j in zip(a.tolist(), b.tolist())], dtype=bool)
        return a[same], b[same]
    rows, columns = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
    i, j = np.nonzero(_similar([left[k] for k in rows], [right[k] for k in columns], percent) & may[np.ix_(rows, columns)])
    return rows[i], columns[j]


def merged(roots: DataFrame, links: DataFrame, pins: Pins) -> DataFrame:
    """``roots`` (node, root), pinned, after further ``links`` (a, b), on the graph of the components so far."""

    def placed(side: str) -> DataFrame:
        return roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))

    between = links.join(placed("a"), "a", "left").join(placed("b"), "b", "left")
    between = between.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b").distinct()
    between = pins.pin(between, "between")
    if not between.take(1):
        return roots
    joined = pins.pin(components(between, pins), "joined").withColumnRenamed("root", "top")
    lifted = roots.join(joined.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    # Joined nodes were roots or stood alone, so they have no row of their own yet.
    return pins.pin(lifted.union(joined.select("node", F.col("top").alias("root"))), "roots")


def _forest(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray) -> np.ndarray:
    """Places of links that join components not yet joined by those before them."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    kept = []
    for k, (x, y) in enumerate(zip(ra[a].tolist(), rb[b].tolist())):
        x, y = top(x), top(y)
        if x != y:
            up[x] = y
            kept.append(k)
    return np.array(kept, dtype=np.int64)


def blocks_of(members: DataFrame) -> DataFrame:
    """``members`` (family, root, node, size) with a block number: nodes of a large component in blocks of their own,
    small components together. Blocks are dealt out by hash, so no family is gathered for it."""
    roots = members.groupBy("family", "root").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    roots = roots.withColumn("parts", F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("shingles") / BLOCK_SHINGLES)))
    large = (F.col("n") > BLOCK_NODES // 2) | (F.col("shingles") > BLOCK_SHINGLES // 2)
    pooled = roots.where(~large).groupBy("family").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_NODES), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)).alias("pool"))
    placed = roots.join(pooled, "family", "left").select("family", "root", large.alias("large"), "parts", "pool")
    own = F.xxhash64("root", F.pmod(F.xxhash64("node"), F.col("parts")))
    shared = F.xxhash64(F.lit("small"), F.pmod(F.xxhash64("root"), F.col("pool")))
    return members.join(placed, ["family", "root"]).select("family", F.when(F.col("large"), own).otherwise(shared).alias("block"), "node", "root")


def verify_blocks(members: DataFrame, texts: DataFrame, sets: Sets, percent: int, pins: Pins) -> DataFrame:
    """Links (a, b) that join different components of a family, a spanning forest for each pair of blocks.

    ``members`` (family, root, node, size) holds whole families. Texts are joined to blocks, not to families.
    """
    cut = pins.pin(blocks_of(members), "blocks")
    blocks = cut.groupBy("family", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    left, right = blocks.toDF("family", "i", "li", "hi"), blocks.toDF("family", "j", "lj", "hj")
    two = left.join(right, "family").where("i <= j and not (li = hi and lj = hj and li = lj)").select("family", "i", "j")
    # A pair of blocks is one group; a block compared with itself stands on both sides.
    sides = two.select("family", "i", "j", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("i").alias("block")), F.struct(F.lit(1).alias("side"), F.col("j").alias("block")))).alias("s")).select("family", "i", "j", "s.side", "s.block")
    rows = sides.join(cut, ["family", "block"]).join(texts.select("node", "text"), "node").select("family", "i", "j", "side", "node", "root", "text")

    def run(group: pa.Table) -> pa.Table:
        parts = []
        for side in (0, 1):
            own = group.filter(pa.array(group["side"].to_numpy() == side)).combine_chunks()
            found, signs = [], [np.zeros((0, MARKS), np.int64)]
            for column in own["text"].chunks:
                for at, end, h, bounds in sets(column):
                    found += [h[bounds[k] : bounds[k + 1]].copy() for k in range(end - at)]
                    signs.append(marks(h, bounds))
            parts.append((own["node"].to_numpy(), own["root"].to_numpy(), found, np.concatenate(signs)))
        (na, ra, sa, ma), (nb, rb, sb, mb) = parts
        a, b = _links(sa, sb, _may(*(np.array([len(x) for x in side], dtype=np.int64) for side in (sa, sb)), ma, mb, percent) & (ra[:, None] != rb[None, :]), percent)
        kept = _forest(a, b, ra, rb)
        return pa.table({"a": na[a[kept]], "b": nb[b[kept]]})

    ship(members.sparkSession)
    return rows.groupBy("family", "i", "j").applyInArrow(run, "a long, b long")


def link(postings: DataFrame, texts: DataFrame, sets: Sets, percent: int, pins: Pins) -> DataFrame:
    """Components (node, root) of all nodes that have a verified link.

    ``postings`` is a pinned table of distinct (bucket, node, need, size, own, core): two nodes are
    candidates if they share at least the smaller of their ``need`` buckets and their sizes
    allow the similarity; of the buckets that linked nodes share, at least one is ``core`` to both.
    ``own`` is the share of a node's shingles that no other node has. ``texts`` (node, text)
    has the texts that ``sets`` makes shingle sets of. With a column ``marks`` (see ``marks``), which ``texts`` has then, too, like ``size``,
    only candidates that they let pass are compared.
    """
    marked = ["marks"] if "marks" in postings.columns else []
    hubs = postings.groupBy("bucket").agg(F.min(F.struct("own", "node", "size", "need", *marked)).alias("hub"))
    met = postings.join(hubs, "bucket").where((F.col("node") != F.col("hub.node")) & _fits(F.col("size"), F.col("hub.size"), percent))
    if marked:
        met = met.where(_alike(F.col("marks"), F.col("hub.marks"), F.col("size"), F.col("hub.size"), percent))
    candidates = met.groupBy("node", F.struct("hub.own", "hub.node").alias("hub")).agg(F.count("*").alias("n"), F.min(F.least("need", "hub.need")).alias("need")).where("n >= need")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("n"), "hub"))
    followed = pins.pin(candidates.select(F.col("hub.node").alias("a"), F.col("node").alias("b"), place.alias("place")), "followed")
    stars = pins.pin(verify_pairs(followed.where("place = 1").select("a", "b"), texts, sets, percent, pins), "stars")
    roots = pins.pin(components(stars, pins), "roots")
    pins.drop(stars)
    open_pairs = _apart(followed.where("place > 1").select("a", "b"), roots)
    more = pins.pin(verify_pairs(open_pairs, texts, sets, percent, pins), "more-stars")
    roots = merged(roots, more, pins)
    # Verified pairs are candidates too, so families are unions of components.
    families = merged(roots, followed.select("a", "b"), pins).withColumnRenamed("root", "family")
    pins.drop(followed, more)

    # The smallest node of a family or component has no row of its own there.
    sized = texts.select("node", "size", "marks") if marked else postings.select("node", "size").distinct()
    placed = sized.join(families, "node", "left").join(roots, "node", "left")
    placed = placed.select("node", "size", *marked, F.coalesce("family", "node").alias("family"), F.coalesce("root", "node").alias("root"))
    several = placed.groupBy("family").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("nodes")).where("low <> high")
    wide = pins.pin(several.where(F.col("nodes") > FAMILY_NODES).select("family"), "wide") if marked else None
    several = several.where(F.col("nodes") <= FAMILY_NODES) if marked else several
    inside = pins.pin(placed.join(several.select("family"), "family", "left_semi").select("family", "root", "node", "size", *marked), "inside")
    if inside.take(1):
        if marked:
            left, right = (inside.select("family", *(F.col(c).alias(f"{c[0]}{side}") for c in ("root", "node", "size", *marked))) for side in "ab")
            likely = left.join(right, "family").where((F.col("ra") < F.col("rb")) & _alike(F.col("ma"), F.col("mb"), F.col("sa"), F.col("sb"), percent))
            within = verify_pairs(likely.select(F.col("na").alias("a"), F.col("nb").alias("b")), texts, sets, percent, pins)
        else:
            within = verify_blocks(inside, texts, sets, percent, pins)
        within = pins.pin(within, "within")
        roots = merged(roots, within, pins)
        pins.drop(within)
    pins.drop(inside)

    named = families.join(roots, "node", "left").select("node", "family", F.coalesce("root", "node").alias("root"))
    if marked:
        named = named.join(wide.withColumn("wide", F.lit(True)), "family", "left").select("node", F.when(F.col("wide"), F.col("root")).otherwise(F.col("family")).alias("family"), "root")
    core = postings.where("core").select("bucket", "node", "size", "own", *marked).join(named, "node", "left").withColumn("root", F.coalesce("root", "node")).withColumn("family", F.coalesce("family", "node"))
    if marked:
        return _across(core, texts, roots, sets, percent, pins)
    mixed = core.groupBy("bucket").agg(F.min("family").alias("low"), F.max("family").alias("high")).where("low <> high").select("bucket")
    rest = pins.pin(core.join(mixed, "bucket", "left_semi").select("bucket", "node", "size", "family", "root"), "rest")
    if not rest.take(1):
        return roots
    grouped = rest.withColumn("class", _size_class(percent)).withColumn("class", F.explode(F.array(F.col("class") - 1, "class")))
    sides = grouped.groupBy("bucket", "class", "family").agg(F.count("*").alias("n"))
    # Pairs of nodes of different families: half of the square of all nodes without the squares of the families.
    counted = sides.groupBy("bucket", "class").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs")).where("pairs > 0")
    groups = pins.pin(counted, "groups")
    if not groups.take(1):
        return roots
    few = groups.where(F.col("pairs") <= FEW).select("bucket", "class")
    left, right = (grouped.select("bucket", "class", *(F.col(c).alias(f"{c[0]}{side}") for c in ("node", "size", "family", "root"))) for side in "ab")
    families_of = sides.join(few, ["bucket", "class"]).select("bucket", "class", "family")
    across = families_of.withColumnRenamed("family", "fa").join(families_of.withColumnRenamed("family", "fb"), ["bucket", "class"]).where("fa < fb")
    together = across.join(left, ["bucket", "class", "fa"]).join(right, ["bucket", "class", "fb"])
    together = together.where(_fits(F.col("sa"), F.col("sb"), percent) & (F.col("ra") != F.col("rb")))
    pairs = pins.pin(together.select(F.col("na").alias("a"), F.col("nb").alias("b")).distinct(), "pairs")
    if pairs.take(1):
        shared = pairs
        if postings.agg(F.max("need")).first()[0] > 1:
            shared = _sharing(pairs, postings)
        roots = merged(roots, verify_pairs(shared, texts, sets, percent, pins), pins)
    pins.drop(pairs)
    roots = _crowds(grouped, groups.where(F.col("pairs") > FEW).select("bucket", "class"), texts, roots, sets, percent, pins)
    pins.drop(rest, groups)
    return roots


def _size_class(percent: int):
    """Sizes of linked nodes are in the same or in neighbouring classes, so both nodes are in the group of the lower class."""
    return F.floor(F.log("size") / (1.001 * max(math.log(100 / percent), 1e-9)))


def _crowds(grouped: DataFrame, many: DataFrame, texts: DataFrame, roots: DataFrame, sets: Sets, percent: int, pins: Pins) -> DataFrame:
    """``roots`` after the groups ``many`` of ``grouped`` (bucket, class, node, size) have been compared in blocks."""
    if not many.take(1):
        return roots
    crowd = grouped.join(many, ["bucket", "class"]).select(F.xxhash64("bucket", "class").alias("family"), "node", "size").distinct()
    crowd = crowd.join(roots, "node", "left").select("family", F.coalesce("root", "node").alias("root"), "node", "size")
    crowd = pins.pin(crowd, "crowd")
    links = pins.pin(verify_blocks(crowd, _texts_of(texts, crowd.select("node"), crowd, pins), sets, percent, pins), "crowd-links")
    roots = merged(roots, links, pins)
    pins.drop(crowd, links)
    return roots


def _texts_of(texts: DataFrame, nodes: DataFrame, pinned: DataFrame, pins: Pins) -> DataFrame:
    """Those of ``texts`` that ``nodes``, which ``pinned`` holds, call for, if these may be sent to all executors: no others are dealt out then."""
    return texts.join(F.broadcast(nodes.distinct()), "node", "left_semi") if pins.size(pinned) <= SENT_BYTES else texts


def _across(core: DataFrame, texts: DataFrame, roots: DataFrame, sets: Sets, percent: int, pins: Pins) -> DataFrame:
    """``roots`` after step 3 of postings with marks, of which one shared bucket makes a candidate.

    Every node has been compared with the hub of each of its buckets, so hubs and buckets of two nodes are left out.
    A pair is judged in its group by the finer marks, if both sets are long, else by the coarse ones; only pairs that pass are written.
    """
    buckets = core.groupBy("bucket").agg(F.min("family").alias("low"), F.max("family").alias("high"), F.count("*").alias("nodes"), F.min(F.struct("own", "node")).alias("hub"))
    buckets = buckets.where("low <> high and nodes > 2").select("bucket", F.col("hub.node").alias("hub"), (F.col("nodes") > FEW_NODES + 1).alias("large"))
    rest = core.join(buckets, "bucket").where("node <> hub").select("bucket", "node", "size", "family", "large", "marks")
    rest = pins.pin(rest, "rest")
    if not rest.take(1):
        return roots
    # A bucket of few nodes is one group, others are groups by size.
    of_sizes = F.explode(F.when(F.col("large"), F.array(F.col("class") - 1, "class")).otherwise(F.array(F.lit(-2).cast("bigint"))))
    grouped = rest.withColumn("class", _size_class(percent)).withColumn("class", of_sizes)
    crowded = grouped.where("large").groupBy("bucket", "class").count().where(F.col("count") > FEW_NODES).select("bucket", "class")
    crowded = pins.pin(crowded, "crowded")
    long = texts.where(F.col("size") > 64 * MARKS).select("node", "fine")
    members = pins.join(grouped, crowded, ["bucket", "class"], "left_anti").join(long, "node", "left").withColumn("signs", F.coalesce("fine", "marks"))
    seen = pins.pin(alike_pairs(members, percent), "alike")
    pairs = pins.pin(seen.where("a is not null").select("a", "b").distinct(), "pairs")
    if pairs.take(1):
        read = _texts_of(texts.select("node", "text"), pairs.select(F.explode(F.array("a", "b")).alias("node")), pairs, pins)
        roots = merged(roots, verify_pairs(pairs, read, sets, percent), pins)
    many = crowded.union(seen.where("a is null").select("bucket", "class"))
    roots = _crowds(grouped, many, texts, roots, sets, percent, pins)
    pins.drop(rest, crowded, seen, pairs)
    return roots


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) whose nodes are not of one component yet."""
    left, right = (roots.select(F.col("node").alias(s), F.col("root").alias(f"r{s}")) for s in "ab")
    both = pairs.join(left, "a", "left").join(right, "b", "left")
    return both.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _sharing(pairs: DataFrame, postings: DataFrame) -> DataFrame:
    """Pairs that share enough buckets of their whole prefixes; that they share one is known."""
    held = postings.groupBy("node").agg(F.collect_set("bucket").alias("buckets"), F.min("need").alias("need"))
    both = pairs.join(held.toDF("a", "ba", "da"), "a").join(held.toDF("b", "bb", "db"), "b")
    return both.where(F.size(F.array_intersect("ba", "bb")) >= F.least("da", "db")).select("a", "b")
