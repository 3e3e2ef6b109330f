"""Token ids of documents in wavelet-matrix shards, written and read by Spark.

Documents are put in ascending id order by range partitioning; each task encodes its
documents, cuts the ids into shards of about ``shard_tokens`` and packs each into a wavelet
matrix. A shard is one row in one file of its own (``maxRecordsPerFile`` is 1): its number,
the ids and ends of its documents, and the compressed planes. Spark's committer makes a
file visible only when its task has succeeded. Shard numbers ascend with document ids.

Null texts are empty, and empty ones hold the end id alone. Null document ids come first.
Rows that repeat an id follow each other in the order of their texts. A text
longer than a shard is a shard of its own. An empty table has no shards. Other columns are
not read.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from omnimart.llm.chunks import ChunkEncoder
from omnimart.llm.frames import fresh, map_batches
from omnimart.llm.wavelet import WaveletMatrix

SHARD_TOKENS = 1 << 21
SHARD = "shard long, doc_ids array<long>, ends array<long>, planes binary"

# Kinds of bytes: 1 space or line feed, 2 ASCII letter, 3 other printed ASCII but digits, 4 digit, 0 the rest.
_KIND = np.zeros(256, dtype=np.uint8)
for _c in range(0x21, 0x7F):
    _KIND[_c] = 2 if chr(_c).isalpha() else 4 if chr(_c).isdigit() else 3
_KIND[[32, 10]] = 1
#: Whether there is a cut between two kinds, by 8 * former + latter.
_CUT = np.zeros(64, dtype=bool)
_CUT[[8 * 2 + 1, 8 * 3 + 1, 8 * 4 + 1, 8 * 2 + 3]] = True


def byte_level_starts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places where a byte-level pre-tokenizer always cuts.

    A space or line feed after a printed ASCII or Latin character begins a pre-token, whatever stands around it,
    and so does ASCII punctuation after an ASCII letter.
    """
    cuts = np.zeros(len(raw), dtype=bool)
    kind = _KIND[raw]
    cuts[1:] = _CUT[kind[1:] | kind[:-1] << np.uint8(3)]
    cuts[2:] |= (kind[2:] == 1) & (raw[:-2] == 0xC3)
    return cuts


@functools.lru_cache(maxsize=1)
def byte_level_encoder(path: str) -> ChunkEncoder:
    """Encoder of a byte-level tokenizer file; special tokens in a text are ordinary text.

    A worker process keeps it, with the chunks it has seen, for its next tasks.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    def encode(chunks: list[str], _) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    return ChunkEncoder(byte_level_starts, encode, mark_first=False)


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, folder: str, bits: int = 16, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` (doc_id, text) with a tokenizer file and write shards to a new folder."""

    def run(batches):
        encoder = byte_level_encoder(tokenizer)
        number = TaskContext.get().partitionId() << 32
        ids, ends, parts, held = [], [], [], 0

        def shard():
            nonlocal number, held
            flat = np.concatenate(parts)
            if flat.max() >> bits:
                raise ValueError(f"an id needs more than {bits} bits")
            planes = WaveletMatrix.build(flat, bits).to_bytes()
            row = pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())), pa.array([planes], pa.binary())], ["shard", "doc_ids", "ends", "planes"])
            number, held = number + 1, 0
            for kept in (ids, ends, parts):
                kept.clear()
            return row

        for batch in batches:
            for at, end, found, cut, _, _ in encoder.pieces(batch["text"]):
                names = batch["doc_id"][at:end].to_pylist()
                n = np.diff(cut)
                # The end id goes behind each document.
                found = np.insert(found, cut[1:], end_id)
                cut = np.concatenate([[0], np.cumsum(n + 1)])
                first = 0
                while first < len(names):
                    last = int(np.searchsorted(cut, cut[first] + shard_tokens - held, side="right")) - 1
                    if last <= first and not held:
                        last = first + 1
                    if last > first:
                        parts.append(found[cut[first] : cut[last]])
                        ids.extend(names[first:last])
                        ends.extend((held + cut[first + 1 : last + 1] - cut[first]).tolist())
                        held += int(cut[last] - cut[first])
                        first = last
                    if held >= shard_tokens or first < len(names):
                        yield shard()
        if held:
            yield shard()

    ordered = fresh(docs, "doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_batches(ordered, run, SHARD).write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with ``base``, the number of ids before each one."""
    shards = spark.read.schema(SHARD).parquet(folder)
    sizes = shards.select("shard", F.element_at("ends", -1).alias("n"))
    # One row a shard: the running total is over the directory, not over documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.join(sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "shard")


def _matrices(batches) -> Iterator[tuple[dict, WaveletMatrix]]:
    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch[c][r] for c in batch.schema.names}
            yield row, WaveletMatrix.from_bytes(row["planes"].as_py())


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files."""

    def run(batches):
        for row, matrix in _matrices(batches):
            wide = matrix.decode().astype("<u4").view(np.uint8).data
            ends = row["ends"].values.to_numpy()
            starts = np.concatenate([[0], ends[:-1]])
            sums = [zlib.crc32(wide[4 * i : 4 * j]) for i, j in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([row["doc_ids"].values, pa.array(starts + row["base"].as_py()), pa.array(ends - starts), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_batches(read_shards(spark, folder), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """Per shard: occurrences of an id, and the place of the first among all ids (null if none)."""

    def run(batches):
        for row, matrix in _matrices(batches):
            n = matrix.count(token)
            first = row["base"].as_py() + matrix.locate(token, 0) if n else None
            yield pa.RecordBatch.from_arrays([pa.array([row["shard"].as_py()]), pa.array([n]), pa.array([first], pa.int64())], ["shard", "n", "first"])

    return map_batches(read_shards(spark, folder), run, "shard long, n long, first long")
