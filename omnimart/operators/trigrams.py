"""Text search by an index of runs of three characters instead of a scan.

A row's text is lower-cased and ended by two marks, so that each of its characters begins a run. The index holds the rows
of each run, in folders by the run's hash and sorted by run, and how many rows have it. A text of three
characters or more looks up its rarest runs, which few rows have, and only rows that have them all are read and
compared. A text of one or two characters looks up the runs that begin with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from omnimart.session import pin

MARK = "\u0000"
#: Runs of a text that are looked up, the rarest first.
LOOKED_UP = 3


def _runs(haystack: Column) -> Column:
    whole = F.concat(haystack, F.lit(MARK * 2))
    places = F.sequence(F.lit(1), F.length(haystack))
    return F.array_distinct(F.transform(F.when(F.length(haystack) > 0, places).otherwise(F.array().cast("array<int>")), lambda i: F.substring(whole, i, F.lit(3))))


def _bucket(run: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(buckets)).cast("int")


class TrigramIndex:
    """Index below ``path``: texts by id, postings and counts of runs. Ids are distinct."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def build(self, df: DataFrame, key: str, columns: Sequence[str]) -> None:
        texts = df.select(F.col(key).alias("id"), F.lower(F.concat_ws(" ", *columns)).alias("haystack"))
        texts.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/texts")
        stored = self.spark.read.parquet(f"{self.path}/texts")
        postings = stored.select("id", F.explode(_runs(F.col("haystack"))).alias("run")).withColumn("bucket", _bucket(F.col("run"), self.buckets))
        # A run that very many rows have fills several files of its bucket.
        postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "run").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/postings")
        counts = self._postings().groupBy("bucket", "run").agg(F.count("*").alias("n"))
        counts.hint("rebalance", "bucket").sortWithinPartitions("bucket", "run").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/counts")

    def _texts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/texts")

    def _postings(self) -> DataFrame:
        return self.spark.read.schema(f"id {self._texts().schema['id'].dataType.simpleString()}, run string, bucket int").parquet(f"{self.path}/postings")

    def rarest(self, text: str) -> list[tuple[str, int]] | None:
        """The rarest runs of a text of at least three characters, with their buckets; None if no row has one of them."""
        runs = sorted({text[i : i + 3] for i in range(len(text) - 2)})
        asked = self.spark.createDataFrame([(r,) for r in runs], "run string").withColumn("bucket", _bucket(F.col("run"), self.buckets))
        buckets = {r.run: r.bucket for r in asked.collect()}
        counts = self.spark.read.schema("run string, n bigint, bucket int").parquet(f"{self.path}/counts")
        known = counts.filter(F.col("bucket").isin(sorted(set(buckets.values()))) & F.col("run").isin(runs)).collect()
        if len(known) < len(runs):
            return None
        return [(r.run, buckets[r.run]) for r in sorted(known, key=lambda r: (r.n, r.run))[:LOOKED_UP]]

    def candidates(self, text: str) -> DataFrame:
        """Ids of the rows that may contain the lower-case text."""
        if len(text) < 3:
            return self._postings().filter(F.col("run").startswith(text)).select("id").distinct()
        found = self.rarest(text)
        if found is None:
            return self._postings().select("id").limit(0)
        # Folder and run reach the scan: other buckets are not listed, other row groups not read.
        near = self._postings().filter(F.col("bucket").isin(sorted({b for _, b in found})) & F.col("run").isin([r for r, _ in found]))
        return near.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") == len(found)).select("id")

    def search(self, text: str) -> DataFrame:
        """Ids of the rows whose text contains the trimmed one, ignoring case."""
        text = self.spark.range(1).select(F.lower(F.trim(F.lit(text)))).first()[0] if text.strip() else ""
        if not text:
            return self._texts().select("id")
        ids = pin(self.candidates(text), "candidates")
        return self._texts().join(ids, "id", "left_semi").filter(F.col("haystack").contains(text)).select("id")
