"""Streaming writers. All run with ``availableNow`` and resume from their checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from omnimart.operators.tables import KeyedTable, later_than
from omnimart.session import CODEC, pin, released
from omnimart.streaming.validation import FAILED, OK, enriched_json, is_plain, is_valid, payload_fields, plain_line

MAX_BATCH_RECORDS = 500


def run_available(stream: DataFrame, checkpoint: str, handle: Callable) -> StreamingQuery:
    """Process everything that has arrived, then stop."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()
    return query


def append_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def json_lines(events: DataFrame, key: str = "partition_key") -> DataFrame:
    """Key, enriched JSON text and validity of each event, as a message broker takes them."""
    if is_plain(events.schema):
        line = plain_line(events)
        return events.select(F.col(key).alias("key"), line["value"].alias("value"), line["valid"].alias("valid"))
    text = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    # The one-element array names the fields, and no filter on generated columns moves below them: a text is parsed once,
    # and not again for every condition of its validity.
    line = F.transform(F.array(payload_fields(text)), lambda fields: F.struct(enriched_json(fields).alias("value"), is_valid(fields).alias("valid")))
    return events.select(F.col(key).alias("key"), F.inline(line))


def write_json_lines(lines: DataFrame, path: str, spread: int | None = None) -> None:
    """Gzipped JSON files of at most 500 records, grouped by key; a second write replaces the first.

    A very frequent key is spread over several tasks by a hash of the record, over as
    many as a shuffle has partitions if not said otherwise. Every task moves its own files into the folder, instead of
    the driver those of all tasks; a repeated task has the same rows and so replaces its files by as many.
    """
    if spread is None:
        spread = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        lines.withColumn("_spread", F.pmod(F.xxhash64("value"), F.lit(spread)))
        .repartition("key", "_spread")
        .select("value")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_BATCH_RECORDS)
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .option("compression", "gzip")
        .text(path)
    )


def route_validated(good_path: str, failed_path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler writing good and failed records to their folders.

    Each batch has its own folder that a repeated batch overwrites, so a restart
    neither loses nor repeats records.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Stored for the two writes, so that a batch is read and validated once and needs no memory.
        with released(batch.sparkSession):
            validated = pin(batch, "validated")
            for result, path in ((OK, good_path), (FAILED, failed_path)):
                validated.filter(F.col("result") == result).write.mode("overwrite").option("compression", CODEC).parquet(
                    f"{path}/batch={batch_id}"
                )

    return handle


def merge_into(
    table: KeyedTable, time: str, strict: bool = False
) -> Callable[[DataFrame, int], None]:
    """Batch handler merging events by key; repeating a batch changes nothing.

    ``strict`` drops rows that are not newer than the stored maximum, late ones
    included; the default keeps them.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = later_than(batch, time, table.watermark(time)) if strict else batch
        table.merge(rows, time)

    return handle
