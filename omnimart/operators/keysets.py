"""Joins and comparisons that stay spread out when one key has very many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from omnimart.session import pin


def join_unique(
    facts: DataFrame, dimension: DataFrame, key: str, how: str = "inner"
) -> DataFrame:
    """Join facts, which may repeat a text key heavily, to a table that has it once.

    AQE splits the hot partition of the facts, but only when both inputs are
    shuffled for this join. A dimension that already is partitioned by the key
    would not be; rewriting the key makes Spark shuffle it, the smaller side, again.
    """
    fresh = dimension.withColumn(key, F.concat(F.col(key), F.lit("")))
    return facts.join(fresh, key, how)


def left_join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join where any key may repeat heavily on the right.

    A left outer join cannot be split on its right side, an inner join can. So the
    matches come from an inner join, and the rest from an anti join against the
    distinct right keys, which are reduced before their shuffle.
    """
    matched = left.join(right, key)
    absent = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(absent, allowMissingColumns=True)


def missing_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys without a parent, each once with its number of rows."""
    children = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count("*").alias("row_count"))
    )
    parents = parent.select(F.col(parent_key).alias("key")).distinct()
    return children.join(parents, "key", "left_anti")


def key_differences(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> DataFrame:
    """Keys present on one side only, with the side that has them."""
    sides = (
        a.select(F.col(a_key).alias("key"), F.lit(1).alias("in_a"), F.lit(0).alias("in_b"))
        .unionByName(
            b.select(F.col(b_key).alias("key"), F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
        )
        .groupBy("key")
        .agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    )
    only_a = F.when(F.col("in_b") == 0, "left").otherwise("right")
    return sides.filter("in_a <> in_b").select("key", only_a.alias("side"))


def digests(keys: DataFrame, key: str, ranges: int) -> DataFrame:
    """Order-free digest of each hash range of the keys: rows, and the sum of their hashes without overflow.

    Tasks add up their own rows first, so one row a range and task is all that moves.
    """
    h = F.xxhash64(F.col(key))
    return keys.groupBy(F.pmod(h, F.lit(ranges)).alias("range")).agg(
        F.count("*").alias("n"), F.sum(h.cast("decimal(20,0)")).alias("digest")
    )


def key_differences_by_digest(
    a: DataFrame, a_key: str, b: DataFrame, b_key: str, ranges: int = 1 << 16
) -> DataFrame:
    """``key_differences`` of two sets that are mostly equal: only rows of differing ranges are compared.

    Both sides are first reduced to digests by hash range. Equal digests mean equal sets but for a
    chance of 2**-64; a key that is repeated on one side makes its range differ, which costs a comparison and
    changes nothing. The differing ranges, at most ``ranges`` numbers, are sent to all tasks, and the rows of
    all others end in the scan's own stage.
    """
    left, right = digests(a.select(a_key), a_key, ranges), digests(b.select(b_key), b_key, ranges)
    sides = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    differing = (
        sides.groupBy("range")
        .agg(F.sum(F.col("n") * F.col("side")).alias("n"), F.sum(F.col("digest") * F.col("side")).alias("digest"))
        .filter("n <> 0 OR digest <> 0")
        .select("range")
    )
    chosen = pin(differing, "differing-ranges")

    def near(df: DataFrame, key: str) -> DataFrame:
        placed = df.select(F.col(key).alias("key")).withColumn("range", F.pmod(F.xxhash64("key"), F.lit(ranges)))
        return placed.join(F.broadcast(chosen), "range", "left_semi").select("key")

    return key_differences(near(a, a_key), "key", near(b, b_key), "key")


def quantity_mismatches(
    batch: DataFrame, stream: DataFrame, key: str = "order_id", quantity: str = "quantity"
) -> DataFrame:
    """Full outer comparison of two quantity feeds, keeping only disagreements.

    Both sides are first reduced to distinct (key, quantity) pairs with their
    number of copies, so the join sees no hot key; ``copies`` is how many joined
    rows each reported pair stands for.
    """

    def reduced(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy(key, F.col(quantity).alias(f"{prefix}_quantity")).agg(
            F.count("*").alias(f"{prefix}_copies")
        )

    b, s = reduced(batch, "batch"), reduced(stream, "stream")
    joined = b.join(s, key, "full_outer")
    differs = (
        F.col("batch_copies").isNull()
        | F.col("stream_copies").isNull()
        | (F.col("batch_quantity") != F.col("stream_quantity"))
    )
    copies = F.coalesce("batch_copies", F.lit(1)) * F.coalesce("stream_copies", F.lit(1))
    return joined.filter(differs).select(
        key, "batch_quantity", "stream_quantity", copies.alias("copies")
    )


def search_rows(df: DataFrame, columns: Sequence[str], text: str) -> DataFrame:
    """Rows whose joined columns contain the trimmed text, ignoring case."""
    haystack = F.lower(F.concat_ws(" ", *columns))
    return df.filter(haystack.contains(text.strip().lower()))
