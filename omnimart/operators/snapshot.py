"""Version history from successive full extracts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from omnimart.functions.scalars import moment
from omnimart.operators.tables import PART, KeyedTable

OPEN = "open"


def advance(
    current: DataFrame, extract: DataFrame, key: str, checked: Sequence[str], at: datetime
) -> DataFrame:
    """Versions after one more extract: unchanged, newly closed and newly opened rows.

    ``current`` holds the open versions only. A key that changed closes its version
    and opens another, an absent key closes, a new key opens. Presence is a flag of
    each side, not a null value, and values compare null-safe.
    """
    now = moment(at)
    old = current.select(F.col(key), F.struct("*").alias("old"))
    new = extract.select(F.col(key), F.struct(key, *checked).alias("new"))
    joined = old.join(new, key, "full_outer")
    same = reduce(Column.__and__, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in checked])
    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()

    def version(side: str, start: Column, end: Column, updated: Column, scd_id: Column) -> Column:
        return F.struct(
            F.col(f"{side}.{key}").alias(key),
            *[F.col(f"{side}.{c}").alias(c) for c in checked],
            start.alias("valid_from"),
            end.alias("valid_to"),
            updated.alias("updated_at"),
            scd_id.alias("scd_id"),
        )

    never = F.lit(None).cast("timestamp")
    marks = ("valid_from", "valid_to", "updated_at", "scd_id")
    kept = version("old", *[F.col(f"old.{c}") for c in marks])
    closed = version("old", F.col("old.valid_from"), now, now, F.col("old.scd_id"))
    opened = version("new", now, never, now, version_id(F.col(f"new.{key}"), now))
    unchanged = had & has & same
    versions = F.array(
        F.when(unchanged, kept).when(had, closed),
        F.when(has & ~F.coalesce(unchanged, F.lit(False)), opened),
    )
    return (
        joined.select(F.explode(F.array_compact(versions)).alias("v")).select("v.*")
    )


def version_id(key: Column, at: Column) -> Column:
    return F.md5(F.concat_ws("|", key, F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def first_versions(
    extract: DataFrame, key: str, checked: Sequence[str], at: datetime
) -> DataFrame:
    now = moment(at)
    return extract.select(
        key,
        *checked,
        now.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        now.alias("updated_at"),
        version_id(F.col(key), now).alias("scd_id"),
    )


class Snapshot:
    """Stored history; open versions and each closing day have their own partition."""

    def __init__(self, spark: SparkSession, path: str, key: str, checked: Sequence[str]):
        part = F.when(F.col("valid_to").isNull(), OPEN).otherwise(
            F.date_format("valid_to", "yyyy-MM-dd")
        )
        self.table = KeyedTable(spark, path, key, part)
        self.key = key
        self.checked = list(checked)

    def read(self) -> DataFrame:
        return self.table.read()

    def apply(self, extract: DataFrame, at: datetime) -> None:
        """Take one extract; only the open versions and today's closings are rewritten."""
        if not self.table.exists():
            self.table.overwrite(first_versions(extract, self.key, self.checked, at))
            return
        after = advance(self.table.read([OPEN]), extract, self.key, self.checked, at)
        today = at.strftime("%Y-%m-%d")
        rows = after.unionByName(self.table.read([today]))
        self.table.replace(rows.withColumn(PART, self.table.partition), [OPEN, today])
