"""One row per key, by an order that never ties on differing rows."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_one(
    df: DataFrame, key: str, order: Column, ties: Sequence[str] | None = None
) -> DataFrame:
    """First row of each key by ``order``.

    The tie-breaking columns follow, descending; by default all others, so the
    survivor does not depend on partitioning. Catalyst turns the rank filter into
    a window group limit that also runs before the shuffle: each task sends at most
    one row per key, so a key with very many copies does not pile up in one task.
    """
    if ties is None:
        ties = [c for c in df.columns if c != key]
    window = Window.partitionBy(key).orderBy(order, *[F.col(c).desc_nulls_last() for c in ties])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_latest(df: DataFrame, key: str, time: str) -> DataFrame:
    ties = [c for c in df.columns if c not in (key, time)]
    return keep_one(df, key, F.col(time).desc_nulls_last(), ties)


def keep_latest_part(
    df: DataFrame,
    key: str,
    time: str,
    precedence: Sequence[str],
    wanted: Collection[str] | None = None,
) -> DataFrame:
    """``keep_latest`` restricted to the columns a caller wants.

    Ties are broken column by column in ``precedence``, so the surviving values of
    its first columns depend on these alone. Cutting it after the last wanted
    column therefore gives the values of the full result, while the scan, the
    shuffle and the sorts carry fewer columns.
    """
    if wanted is not None:
        places = [i for i, c in enumerate(precedence) if c in wanted]
        precedence = precedence[: max(places, default=-1) + 1]
    return keep_latest(df.select(key, time, *precedence), key, time)


def keep_lowest(df: DataFrame, key: str, preference: str) -> DataFrame:
    return keep_one(df, key, F.col(preference).asc_nulls_last())
