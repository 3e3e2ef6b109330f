"""Intermediate tables in the shared folder, and joins whose broadcast is checked first."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from omnimart.session import scratch_path

#: Largest side that is sent to all executors, in bytes of its table; beyond it rows are shuffled.
SENT_BYTES = 24 << 20

#: Rows and bytes of a batch between Spark and a worker, where the session has Spark's own defaults: texts are
#: long, and several batches are in memory on either side.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that their tasks can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package; a worker gives unused Arrow memory back after each task."""
    ship(df.sparkSession)
    for key, (usual, bounded) in BATCHES.items():
        if df.sparkSession.conf.get(key, usual) == usual:
            df.sparkSession.conf.set(key, bounded)

    def released(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


class Pins:
    """Tables written once to ``spark.checkpoint.dir`` and read back, so that every later pass,
    also one after the loss of an executor, sees the same rows."""

    def __init__(self, spark):
        self.spark = spark
        self.paths: list[str] = []

    def pin(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append(path)
        read._pinned_at = path
        return read

    def size(self, pinned: DataFrame) -> int:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(pinned._pinned_at)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        self.paths.remove(path)

    def drop(self, *pinned: DataFrame) -> None:
        """Delete tables that no later step reads, and shuffle files of the steps that wrote them.

        Spark removes shuffle files when the driver's garbage collector finds their query unused, which a driver with
        little to do on its own may not run for a long time; so it is asked to.
        """
        for df in pinned:
            self._delete(df._pinned_at)
        gc.collect()
        self.spark._jvm.System.gc()

    def keep_only(self, *pinned: DataFrame) -> None:
        """Delete all tables but those that the result still reads."""
        kept = {df._pinned_at for df in pinned}
        for path in [p for p in self.paths if p not in kept]:
            self._delete(path)

    def join(self, big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
        """Join with a pinned table: sent to all executors if its stored size is within the
        bound, else both sides are shuffled. The rows are the same."""
        fits = self.size(small) <= SENT_BYTES
        return big.join(F.broadcast(small) if fits else small, on, how)


def fresh(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; a missing one is an error that names it."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no column {missing[0]}")
    return df.select(*(F.col(f"`{c}`") for c in columns))
