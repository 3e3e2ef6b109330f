"""Repeatable samples and reports of a landed source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from omnimart.operators.quantiles import nearest_rank


def bottom_k(df: DataFrame, key: Sequence[str], k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows of each group whose key has the smallest MD5, with ``sample_hash`` and ``sample_rank``.

    The same rows whatever the partitioning, the number of runs or the order of arrival: a row's place depends on
    its own key only. Each task keeps ``k`` rows a group before anything moves. Rows of one key are put in the
    order of their other columns.
    """
    from pyspark.sql import Window

    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key))
    hashed = df.withColumn("sample_hash", F.md5(text.cast("binary")))
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in by]
    if not by:
        hashed = hashed.orderBy("sample_hash", *rest).limit(k)
    place = Window.partitionBy(*(by or [F.lit(0)])).orderBy("sample_hash", *rest)
    return hashed.withColumn("sample_rank", F.row_number().over(place)).filter(F.col("sample_rank") <= k)


def landing_report(source: str, landed: DataFrame, time: str | None = None, latency: str | None = None) -> DataFrame:
    """One row: source, rows, first and last time, and the latency's 95th percentile where the source has one."""
    none = F.lit(None).cast("timestamp")
    first, last = (F.min(time), F.max(time)) if time else (F.max(none), F.max(none))
    counted = landed.agg(F.count("*").alias("rows"), first.alias("first_at"), last.alias("last_at")).withColumn("source", F.lit(source))
    if latency is None:
        return counted.select("source", "rows", "first_at", "last_at", F.lit(None).cast("bigint").alias("latency_p95_ms"))
    p95 = nearest_rank(landed, latency, 0.95, name="latency_p95_ms").select("latency_p95_ms")
    # Both sides are one row.
    return counted.join(F.broadcast(p95)).select("source", "rows", "first_at", "last_at", "latency_p95_ms")
