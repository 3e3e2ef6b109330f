"""Event stream: read, deduplicate, enrich, watch latency."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from omnimart.operators.keysets import join_unique

# Latency alarm over one-minute windows.
ALARM_P95_MS = 3000
ALARM_WINDOW = "60 seconds"


def read_event_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Stream over a folder of Parquet files, from the earliest file on."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def sample(stored: DataFrame, rows: int = 10) -> DataFrame:
    """A few stored events to look at."""
    return stored.limit(rows)


def deduplicate(events: DataFrame, delay: str, copy_groups: int | None = None) -> DataFrame:
    """First copy of each event id within the watermark delay.

    A stream has no combine step before its shuffle, so one event id sent very
    often would land in one task. The first step therefore drops copies per event
    id and group of input tasks; the second then sees a few copies per id at most.
    There are as many groups as the square root of the shuffle partitions, so the
    split of a hot id grows with the cluster and the state of the others stays small.
    """
    if copy_groups is None:
        partitions = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        copy_groups = max(2, math.isqrt(partitions))
    return (
        events.withWatermark("event_at", delay)
        .withColumn("_group", F.spark_partition_id() % copy_groups)
        .dropDuplicatesWithinWatermark(["event_id", "_group"])
        .drop("_group")
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def enrich(events: DataFrame, bridge: DataFrame) -> DataFrame:
    """Customer of each event; events without one are left out."""
    return join_unique(
        events, bridge.select("source_customer_id", "customer_id"), "source_customer_id"
    )


def unresolved_events(events: DataFrame, bridge: DataFrame) -> DataFrame:
    """The events ``enrich`` leaves out."""
    known = bridge.select("source_customer_id", F.lit(True).alias("_known"))
    return events.join(known, "source_customer_id", "left").filter("_known is null").drop("_known")


def latency_windows(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Event count and 95th percentile latency of each minute.

    Works on a batch too (no delay). The percentile state is a count per distinct
    millisecond value, merged before the shuffle, so a busy minute stays small.
    """
    if delay is not None:
        events = events.withWatermark("event_at", delay)
    p95 = F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY latency_ms)")
    return (
        events.groupBy(F.window("event_at", ALARM_WINDOW).alias("w"))
        .agg(F.count("*").alias("events"), p95.cast("bigint").alias("latency_p95_ms"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "events",
            "latency_p95_ms",
        )
    )


def with_open_windows(emitted: DataFrame, events: DataFrame) -> DataFrame:
    """All windows of a finite source: those a stream has emitted, and the ones that its
    watermark still kept open, from the stored events that lie behind them."""
    closed = emitted.agg(F.max("window_end")).scalar()
    later = events.filter(F.coalesce(F.col("event_at") >= closed, F.lit(True)))
    return emitted.unionByName(latency_windows(later))


def alarms(windows: DataFrame, threshold_ms: int = ALARM_P95_MS) -> DataFrame:
    """Minutes strictly above the threshold; a minute without events raises none."""
    return windows.filter(F.col("latency_p95_ms") > threshold_ms)


def is_late(windows: DataFrame, threshold_ms: int = ALARM_P95_MS) -> DataFrame:
    """The screen's marker, which already fires at the threshold itself."""
    return windows.withColumn("late", F.col("latency_p95_ms") >= threshold_ms)
