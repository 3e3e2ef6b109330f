"""Full outer comparison of two fact streams by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from omnimart.streaming.settled import ON_DISK, Input, Settled, run_settled


def compare_streams(batch: DataFrame, stream: DataFrame, folder: str, apart: str = "1 minute", delay: str = "1 hour", delay_ms: int = 3_600_000) -> Settled:
    """Join two streams (order_id, at, quantity), each of which has a key once, by key.

    Rows of a pair lie at most ``apart`` from each other, so that a row without a partner is told, and leaves
    the state, as soon as the watermark has passed it by as much. The state holds ``delay`` and ``apart`` of either side, and whole rows of
    at least the newest batch, which may be a large part of the input: it lies on disk.
    """
    left = batch.select(F.col("order_id").alias("batch_key"), F.col("at").alias("batch_at"), F.col("quantity").alias("batch_quantity"))
    right = stream.select(F.col("order_id").alias("stream_key"), F.col("at").alias("stream_at"), F.col("quantity").alias("stream_quantity"))
    near = f"batch_key = stream_key AND stream_at BETWEEN batch_at - INTERVAL {apart} AND batch_at + INTERVAL {apart}"
    joined = left.withWatermark("batch_at", delay).join(right.withWatermark("stream_at", delay), F.expr(near), "full_outer")
    inputs = {
        "batch": Input(left, F.col("batch_at"), F.col("batch_at"), delay_ms),
        "stream": Input(right, F.col("stream_at"), F.col("stream_at"), delay_ms),
    }
    return run_settled(joined, inputs, folder, state=ON_DISK)


def settled_pairs(run: Settled) -> DataFrame:
    """All pairs and single rows of a finished comparison, as a full outer join of both whole streams has them.

    Emitted pairs stand. Rows that were emitted alone, are late, or are open in the state without a pair are brought
    together once more; these are the few that a pair may still be found for.
    """
    emitted = run.emitted()
    pairs = emitted.filter("batch_key IS NOT NULL AND stream_key IS NOT NULL")

    def single(side: str, other: str) -> DataFrame:
        alone = emitted.filter(f"{other}_key IS NULL AND ({side}_key IS NOT NULL OR {side}_at IS NOT NULL)")
        columns = [f"{side}_{c}" for c in ("key", "at", "quantity")]
        held = run.open_side("left" if side == "batch" else "right").select(*columns)
        held = held.join(pairs.select(f"{side}_key"), f"{side}_key", "left_anti")
        return alone.select(*columns).unionByName(held.select(*columns)).unionByName(run.late(side).select(*columns))

    rest = single("batch", "stream").join(single("stream", "batch"), F.expr("batch_key = stream_key"), "full_outer")
    return pairs.unionByName(rest)


def mismatches(pairs: DataFrame) -> DataFrame:
    """Pairs that disagree, and keys of one side only."""
    differs = F.col("batch_key").isNull() | F.col("stream_key").isNull() | (F.col("batch_quantity") != F.col("stream_quantity"))
    return pairs.filter(differs).select(F.coalesce("batch_key", "stream_key").alias("order_id"), "batch_quantity", "stream_quantity", F.lit(1).cast("bigint").alias("copies"))
