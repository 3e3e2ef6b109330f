"""Sales cube kept up to date from the days that changed.

Two tables are stored: what each customer bought by channel and day, in folders by day, and what each bought in each
(channel, period), which is the sum of its days. A new moment or corrected days change the second table by the
difference: days that left a period, or changed, are taken back with their former values; days that came in,
or changed, are added. Sales are read for the changed days only, former values for days that leave or changed.
Customers of a cell are its rows with orders left, so the distinct count needs no sketch and stays exact. A period of n days
holds the n days before the moment's time of day and the day that begins then; sales dated later wait for their day.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from omnimart.operators import files
from omnimart.operators.cube import ALL, CHANNELS, PERIODS, grid
from omnimart.operators.sketches import DAY_SECONDS

MEASURES = ("revenue", "orders", "units")
DAY = "_day"


def epoch_day(time: Column, anchor_seconds: int) -> Column:
    """Number of the day since 1970 that changes ``anchor_seconds`` after midnight."""
    return F.floor((F.unix_micros(time) / 1_000_000 - anchor_seconds) / DAY_SECONDS).cast("int")


class CubeStore:
    """Daily rows and cells below ``path``; a manifest, written last, names the current version."""

    def __init__(self, spark: SparkSession, path: str, periods: Sequence[int] = PERIODS, channels: Sequence[str] = CHANNELS):
        self.spark, self.path = spark, path.rstrip("/")
        self.periods, self.channels = tuple(periods), tuple(channels)

    def manifest(self) -> dict:
        names = [n for n in files.children(self.spark, f"{self.path}/manifest") if n[0] != "."]
        return json.loads(files.read_text(self.spark, f"{self.path}/manifest/{names[-1]}")) if names else {"version": 0, "day": None, "anchor": 0, "days": {}}

    def _daily(self, days: dict[str, int]) -> DataFrame:
        """Stored daily rows of the given days, from the folders that the manifest names."""
        folders = [f"{self.path}/daily/_version={v}/{DAY}={d}" for d, v in days.items()]
        schema = f"channel string, customer_id string, revenue decimal(38,2), orders bigint, units bigint, {DAY} int"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/daily").parquet(*folders).select("channel", "customer_id", *MEASURES, DAY)

    def _cells(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells/_version={version}")

    def advance(self, sales: DataFrame, as_of: datetime, changed: Iterable[int] = ()) -> None:
        """Bring the cube to ``as_of``; ``changed`` are days (by ``day_of``) whose sales were corrected or are new.

        Days that were never stored, and the one that the last moment lay in, count as changed. ``sales`` is filtered to the changed days, on the order time.
        """
        before = self.manifest()
        anchor = as_of.hour * 3600 + as_of.minute * 60 + as_of.second
        if before["version"] and before["anchor"] != anchor:
            raise ValueError("the stored days change at another time of day")
        today = self.day_of(as_of)
        # The day of the last moment had only begun then.
        last = today if before["day"] is None else before["day"]
        new = {d for d in range(today - max(self.periods), today + 1) if str(d) not in before["days"] or d >= last}
        dirty = sorted(new | {d for d in changed if d >= today - max(self.periods)})
        version = before["version"] + 1
        wanted = F.lit(False)
        for first, last in _spans(dirty):
            low, high = (F.timestamp_micros(F.lit((d * DAY_SECONDS + anchor) * 1_000_000)) for d in (first, last + 1))
            wanted = wanted | ((F.col("ordered_at") >= low) & (F.col("ordered_at") < high))
        day = epoch_day(F.col("ordered_at"), anchor).alias(DAY)
        fresh = sales.filter(wanted).groupBy("channel", "customer_id", day).agg(
            F.sum("sales_amount").cast("decimal(38,2)").alias("revenue"), F.count("*").alias("orders"), F.sum("quantity").cast("bigint").alias("units")
        )
        folder = f"{self.path}/daily/_version={version}"
        fresh.select("channel", "customer_id", *MEASURES, DAY).hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(folder)
        written = {n.split("=", 1)[1]: version for n in files.children(self.spark, folder) if n.startswith(f"{DAY}=")}
        # A day without sales is known, but has no folder.
        days = {d: v for d, v in before["days"].items() if int(d) not in dirty} | {str(d): written.get(str(d)) for d in dirty}
        days = {d: v for d, v in days.items() if int(d) >= today - max(self.periods)}
        parts = [self._cells(before["version"])] if before["version"] else []
        for period in self.periods:
            now = set(range(today - period, today + 1))
            then = set() if before["day"] is None else set(range(before["day"] - period, before["day"] + 1))
            back = {d: v for d, v in before["days"].items() if v and int(d) in then and (int(d) not in now or int(d) in dirty)}
            put = {d: v for d, v in days.items() if v and int(d) in now and (int(d) not in then or int(d) in dirty)}
            for chosen, sign in ((back, -1), (put, 1)):
                if chosen:
                    rows = self._daily(chosen)
                    parts.append(rows.select("channel", F.lit(period).alias("period"), "customer_id", *((F.col(m) * sign).alias(m) for m in MEASURES)))
        schema = "channel string, period int, customer_id string, revenue decimal(38,2), orders bigint, units bigint"
        both = self.spark.createDataFrame([], schema)
        for part in parts:
            both = both.unionByName(part)
        cells = both.groupBy("channel", "period", "customer_id").agg(*(F.sum(m).alias(m) for m in MEASURES)).filter("orders <> 0")
        cells.withColumn("revenue", F.col("revenue").cast("decimal(38,2)")).write.mode("overwrite").parquet(f"{self.path}/cells/_version={version}")
        content = {"version": version, "day": today, "anchor": anchor, "days": days}
        files.publish_text(self.spark, f"{self.path}/manifest/{version:010d}.json", json.dumps(content))

    def day_of(self, at: datetime) -> int:
        return (datetime(at.year, at.month, at.day) - datetime(1970, 1, 1)).days

    def read(self) -> DataFrame:
        """Revenue, orders, customers, units and basket of each channel and period."""
        stored = self._cells(self.manifest()["version"])
        wide = stored.select(F.explode(F.array("channel", F.lit(ALL))).alias("channel"), "period", "customer_id", *MEASURES)
        cells = wide.groupBy("channel", "period").agg(
            F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"), F.count_distinct("customer_id").alias("customers"), F.sum("units").alias("units")
        )
        basket = F.round(F.col("revenue").cast("double") / F.col("orders"), 2)
        filled = grid(stored, self.channels, self.periods).join(cells, ["channel", "period"], "left").withColumn("avg_basket", basket)
        return filled.fillna(0, ["orders", "customers", "units", "avg_basket"]).withColumn("revenue", F.coalesce("revenue", F.lit(0)).cast("decimal(18,2)"))


def _spans(days: Sequence[int]) -> list[tuple[int, int]]:
    """Runs of consecutive days, first and last."""
    spans: list[tuple[int, int]] = []
    for d in days:
        if spans and spans[-1][1] == d - 1:
            spans[-1] = (spans[-1][0], d)
        else:
            spans.append((d, d))
    return spans
