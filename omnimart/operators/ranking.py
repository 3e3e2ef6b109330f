"""Tiles over a whole set without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from omnimart.session import pin

COMPARABLE = "decimal(28,4)"


def tile_scores(
    df: DataFrame, key: str, measures: dict[str, Column], tiles: int = 4
) -> DataFrame:
    """Add ``ntile(tiles) over (order by measure nulls last, key)`` for each named measure.

    All measures are sorted together by one range shuffle on (measure, value, key).
    The key is unique, so even a value shared by most rows is spread over many
    partitions. Row counts per partition (a few rows) turn local positions into
    ranks; only the last row of each tile reaches the driver, and every score is
    then a comparison with those rows.
    """
    base = pin(df, "tiles-base")
    names = list(measures)
    entries = [
        F.struct(
            F.lit(i).alias("measure"),
            measures[name].isNull().alias("missing"),
            measures[name].cast(COMPARABLE).alias("value"),
        )
        for i, name in enumerate(names)
    ]
    order = ["measure", "missing", "value", "row_key"]
    placed = pin(
        base.select(F.col(key).alias("row_key"), F.explode(F.array(*entries)).alias("entry"))
        .select("row_key", "entry.*")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("position", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("position", 33)),
        "tiles-order",
    )
    bounds = _tile_ends(placed, tiles).collect()  # at most (tiles - 1) rows per measure
    scores = []
    for i, name in enumerate(names):
        score = F.lit(1)
        value = measures[name].cast(COMPARABLE)
        for end in (row for row in bounds if row["measure"] == i):
            later_key = F.col(key) > F.lit(end["row_key"])
            if end["missing"]:
                after = value.isNull() & later_key
            else:
                last = F.lit(end["value"]).cast(COMPARABLE)
                after = value.isNull() | (value > last) | ((value == last) & later_key)
            score = score + after.cast("int")
        scores.append(score.alias(name))
    return base.select("*", *scores)


def _tile_ends(placed: DataFrame, tiles: int) -> DataFrame:
    """Last row of every tile but the final one, per measure."""
    # One row per partition and measure: its size is bounded by the partition count.
    parts = placed.groupBy("measure", "part").agg(
        F.count("*").alias("rows"), F.min("position").alias("first")
    )
    by_measure = Window.partitionBy("measure")
    before = by_measure.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "measure",
        "part",
        "first",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(by_measure).alias("total"),
    )
    size, extra = F.expr(f"total div {tiles}"), F.col("total") % tiles
    ends = [F.lit(t) * size + F.least(F.lit(t), extra) for t in range(1, tiles)]
    rank = F.col("before") + F.col("position") - F.col("first") + 1
    return (
        placed.join(F.broadcast(offsets), ["measure", "part"])
        .filter(rank.isin(*ends))
        .select("measure", "missing", "value", "row_key")
    )
