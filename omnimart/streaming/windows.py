"""Latency by minute with every event accounted for: closed windows, open windows, late events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from omnimart.streaming.events import ALARM_WINDOW
from omnimart.streaming.settled import Input, Settled, run_settled


def count_latencies(events: DataFrame, folder: str, delay: str = "10 minutes", delay_ms: int = 600_000) -> Settled:
    """Stream the number of events of each minute and latency.

    The state holds one counter for each latency of an open minute, which the ``statestore`` reader can show.
    """
    rows = events.select("event_at", "latency_ms")
    window = F.window("event_at", ALARM_WINDOW)
    counted = rows.withWatermark("event_at", delay).groupBy(window.alias("w"), "latency_ms").agg(F.count("*").alias("n"))
    counted = counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "latency_ms", "n")
    return run_settled(counted, {"events": Input(rows, F.col("event_at"), window.end, delay_ms)}, folder)


def parts(run: Settled) -> DataFrame:
    """Counters (part, window_start, window_end, latency_ms, n) of what was emitted, is open, and came late."""
    columns = ["window_start", "window_end", "latency_ms", "n"]
    window = F.window("event_at", ALARM_WINDOW)
    state = run.open()
    # The state's columns are named by the engine: the grouping columns first, the counter last.
    w, latency, n = state.columns[0], state.columns[1], state.columns[-1]
    held = state.select(F.col(f"`{w}`.start").alias("window_start"), F.col(f"`{w}`.end").alias("window_end"), F.col(f"`{latency}`").alias("latency_ms"), F.col(f"`{n}`").alias("n"))
    late = run.late("events").groupBy(window.alias("w"), "latency_ms").agg(F.count("*").alias("n"))
    late = late.filter("w IS NOT NULL").select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "latency_ms", "n")
    found = run.emitted().select(F.lit("emitted").alias("part"), *columns)
    return found.unionByName(held.select(F.lit("open").alias("part"), *columns)).unionByName(late.select(F.lit("late").alias("part"), *columns))


def latency_of(counters: DataFrame) -> DataFrame:
    """Events and 95th percentile latency of each minute, by nearest rank over its counters."""
    minute = Window.partitionBy("window_start")
    merged = counters.groupBy("window_start", "window_end", "latency_ms").agg(F.sum("n").alias("n"))
    # A minute has at most one row for each millisecond of latency.
    upto = F.sum("n").over(minute.orderBy(F.asc_nulls_last("latency_ms")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = F.sum(F.when(F.col("latency_ms").isNotNull(), F.col("n"))).over(minute)
    ranked = merged.withColumn("upto", upto).withColumn("known", known).withColumn("events", F.sum("n").over(minute))
    reached = F.col("upto") >= F.ceil(F.lit(0.95) * F.col("known"))
    p95 = F.min(F.when(reached, F.col("latency_ms"))).cast("bigint")
    return ranked.groupBy("window_start", "window_end").agg(F.max("events").alias("events"), p95.alias("latency_p95_ms"))
