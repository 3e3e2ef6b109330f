"""Exact nearest-rank percentiles from value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# Values are split into a high part and a low part of this many bits, so a window
# never holds more than 65,536 rows of one group.
LOW_BITS = 16


def nearest_rank(
    df: DataFrame, value: str, p: float, by: Sequence[str] = (), name: str = "percentile"
) -> DataFrame:
    """The ceil(p * n)-th smallest integer ``value`` of each group, with its row count.

    Rows are first counted per (group, value), before any shuffle; then the block
    of values holding the rank is found, and within it the value itself. Without
    ``by`` the result is one row, and an empty input gives count 0 and value 0.
    """
    keys = list(by) or ["_all"]
    source = df if by else df.withColumn("_all", F.lit(0))
    counted = (
        source.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("bigint").alias("v"))
        .agg(F.count("*").alias("n"))
        .withColumn("block", F.shiftright("v", LOW_BITS))
    )
    group = Window.partitionBy(*keys)
    blocks = (
        counted.groupBy(*keys, "block")
        .agg(F.sum("n").alias("n"))
        .withColumn("total", F.sum("n").over(group))
        .withColumn("upto", F.sum("n").over(group.orderBy("block")))
        .withColumn("rank", F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("total"))))
        .filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        .select(
            F.struct(*keys, "block").alias("cell"),
            "total",
            (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"),
        )
    )
    # Structs compare null-safe inside, so a group whose name is null is kept.
    chosen = (
        counted.join(blocks, F.struct(*keys, "block") == F.col("cell"))
        .withColumn("upto", F.sum("n").over(group.orderBy("v")))
        .filter("upto >= rank")
        .groupBy(*keys)
        .agg(F.min("v").alias(name), F.first("total").alias("row_count"))
    )
    if by:
        return chosen.select(*keys, "row_count", name)
    return chosen.agg(
        F.coalesce(F.max("row_count"), F.lit(0)).alias("row_count"),
        F.coalesce(F.max(name), F.lit(0)).alias(name),
    )
