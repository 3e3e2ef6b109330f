"""Streams whose output accounts for every input row: emitted results, open state, and late rows.

A stateful operator drops rows that arrive behind its watermark, and holds what its watermark keeps open. A settled
run passes the input through next to the operator's results, in the same micro-batches, and stores

* results as the operator emits them,
* late rows, that is those that the operator dropped,

each under the batch's own folder, which a repeated batch overwrites. Open state is read from the checkpoint with the
``statestore`` reader. Nothing is lost then: emitted, open and late rows together are the input.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from omnimart.operators import files
from omnimart.session import CODEC
from omnimart.streaming.sinks import run_available

RESULT = "result"

#: State on the executors' disks, with bounded memory, instead of in their heaps. A run that began otherwise goes on as it began.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@dataclass(frozen=True)
class Input:
    """An input of the operator: its stream without a watermark, and the time that the operator
    compares with the watermark (the row's own, or the end of its window). Without times, a stream
    beside the operator, all rows of which are kept like late ones."""

    stream: DataFrame
    time: Column | None = None
    compared: Column | None = None
    delay_ms: int = 0


class Marks:
    """Watermark of each batch, worked out as the engine does: by the largest time of each input in
    the batches before, less its delay; the smallest input's counts. Rows of a batch are late by the
    mark that the batch before it had."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, batch_id: int) -> dict:
        path = f"{self.folder}/{batch_id:010d}.json"
        if batch_id < 0 or not files.exists(self.spark, path):
            return {}
        return json.loads(files.read_text(self.spark, path))

    def late_before(self, batch_id: int, inputs: Mapping[str, Input]) -> int | None:
        """Milliseconds up to which a row of the batch is late; None if none is."""
        seen, timed = self._read(batch_id - 2), {n: i for n, i in inputs.items() if i.time is not None}
        if any(seen.get(name) is None for name in timed):
            return None
        return min(seen[name] - i.delay_ms for name, i in timed.items())

    def record(self, batch_id: int, largest: Mapping[str, int | None]) -> None:
        before = self._read(batch_id - 1)
        both = {n: max((x for x in (t, before.get(n)) if x is not None), default=None) for n, t in largest.items()}
        files.write_text(self.spark, f"{self.folder}/{batch_id:010d}.json", json.dumps(both))


@dataclass(frozen=True)
class Settled:
    """Folders of a settled run."""

    spark: SparkSession
    folder: str
    schemas: Mapping[str, object]

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"

    def _part(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        schema = self.schemas[name]
        if not files.children(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{path}/{b}" for b in files.children(self.spark, path) if b.startswith("batch=")))

    def emitted(self) -> DataFrame:
        return self._part(RESULT)

    def late(self, name: str) -> DataFrame:
        """Rows of an input that arrived behind the watermark."""
        return self._part(name)

    def open(self, **options) -> DataFrame:
        """State that the last watermark has left open: columns of the state's key and value."""
        state = self.spark.read.format("statestore").options(**options).load(self.checkpoint)
        return state.select("key.*", "value.*")

    def open_side(self, side: str) -> DataFrame:
        """Rows of one side of a join that its state still holds, matched or not."""
        state = self.spark.read.format("statestore").option("joinSide", side).load(self.checkpoint)
        return state.select("value.*")


def run_settled(result: DataFrame, inputs: Mapping[str, Input], folder: str, then: Callable[[DataFrame, Mapping[str, DataFrame], int], None] | None = None, state: Mapping[str, str] | None = None) -> Settled:
    """Run ``result``, a stateful stream over ``inputs``, on all that has arrived.

    ``then`` is given the results and late rows of each batch. It must bear a repeated batch. ``state`` are settings of the state store.
    """
    spark = result.sparkSession
    settled = Settled(spark, folder.rstrip("/"), {RESULT: result.schema} | {n: i.stream.schema for n, i in inputs.items()})
    marks = Marks(spark, f"{settled.folder}/marks")
    parts = [result.select(F.lit(RESULT).alias("part"), F.struct("*").alias(RESULT))]
    for name, i in inputs.items():
        row = F.struct(*i.stream.columns).alias(name)
        millis = [F.unix_millis(c).alias(f"{name}_{k}") for c, k in ((i.time, "at"), (i.compared, "compared")) if c is not None]
        parts.append(i.stream.select(F.lit(name).alias("part"), row, *millis))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Kept between the passes, so that the operator runs once a batch; on disk, as a batch may be a large part of the input.
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            largest = batch.agg(*(F.max(f"{n}_at").alias(n) for n, i in inputs.items() if i.time is not None)).first().asDict()
            bound = marks.late_before(batch_id, inputs)
            found = {RESULT: batch.filter(F.col("part") == RESULT).select(f"{RESULT}.*")}
            for name, i in inputs.items():
                late = F.lit(i.time is None) if bound is None or i.time is None else F.col(f"{name}_compared") <= bound
                found[name] = batch.filter((F.col("part") == name) & late).select(f"{name}.*")
            for name, rows in found.items():
                rows.write.mode("overwrite").option("compression", CODEC).parquet(f"{settled.folder}/{name}/batch={batch_id}")
            if then is not None:
                then(found[RESULT], {n: found[n] for n in inputs}, batch_id)
            marks.record(batch_id, largest)
        finally:
            batch.unpersist()

    with _set(spark, state or {}):
        run_available(both, settled.checkpoint, handle)
    return settled


@contextmanager
def _set(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings for queries that start within the block; what a session has set itself stands."""
    given = spark.conf.getAll
    for key, value in conf.items():
        if key not in given:
            spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in conf:
            if key not in given:
                spark.conf.unset(key)
