"""Stored tables: full refresh, keyed merge by partition, raw zone, exports."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from omnimart.functions.scalars import moment
from omnimart.operators import files
from omnimart.operators.dedup import keep_latest
from omnimart.operators.drift import conform, merged_schema
from omnimart.operators.postings import PostingIndex
from omnimart.session import CODEC, pin

PART = "_part"

#: Partition of rows without a time.
UNDATED = "none"


class SchemaDrift(ValueError):
    """Incoming columns differ from the stored ones."""


def check_schema(stored: T.StructType, incoming: T.StructType) -> None:
    def shape(schema: T.StructType) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in schema]

    if shape(stored) != shape(incoming):
        raise SchemaDrift(f"stored {shape(stored)}, incoming {shape(incoming)}")


class KeyedTable:
    """Parquet table with a unique key, kept in folders by a partition text.

    A commit writes the touched partitions under a new version folder and then one
    small manifest naming the folder of every partition; readers follow the newest
    manifest. Untouched partitions are never rewritten, and a write that fails
    leaves the current version as it was. One writer at a time is assumed.

    Beside the rows lies an index from key to partition (``PostingIndex``), named by the same manifest: a
    merge reads the index buckets of its keys and, of the rows, only partitions that hold one of them. A
    null key is refused, as no merge could find its row again.

    With ``held`` a commit is only seen by this object until ``publish`` writes its
    manifest; without that, the next writer starts again from the stored version. With ``at`` the
    table is the one of that version (0: none yet), whatever manifests there are, so that several
    tables can be switched by the one file that names their versions.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        partition: Column,
        held: bool = False,
        buckets: int = 32,
        at: int | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.partition = F.coalesce(partition, F.lit(UNDATED))
        self.held = held
        self.at = at
        self._pending: dict | None = None
        self.index = PostingIndex(spark, f"{self.path}/index", buckets)

    # -- reading -----------------------------------------------------------

    def _manifest(self) -> dict:
        if self._pending is not None:
            return self._pending
        if self.at is not None:
            versions = [f"{self.at:010d}.json"] if self.at else []
        else:
            versions = self._versions()
        if not versions:
            return {"version": 0, "parts": {}, "schema": None}
        return json.loads(files.read_text(self.spark, f"{self.path}/manifest/{versions[-1]}"))

    def _versions(self) -> list[str]:
        return [n for n in files.children(self.spark, f"{self.path}/manifest") if n[0] != "."]

    @property
    def version(self) -> int:
        return self._manifest()["version"]

    def exists(self) -> bool:
        return self._manifest()["version"] > 0

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._manifest()["schema"])

    def partitions(self) -> list[str]:
        return sorted(self._manifest()["parts"])

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """Current rows, of the named partitions only if given."""
        return self._read_with_part(parts).drop(PART)

    def _read_with_part(
        self, parts: Sequence[str] | None = None, schema: T.StructType | None = None
    ) -> DataFrame:
        manifest = self._manifest()
        schema = schema or T.StructType.fromJson(manifest["schema"])
        folders = [
            f"{self.path}/data/_version={version}/{PART}={part}"
            for part, version in manifest["parts"].items()
            if parts is None or part in parts
        ]
        full = T.StructType([*schema, T.StructField(PART, T.StringType())])
        if not folders:
            return self.spark.createDataFrame([], full)
        reader = self.spark.read.schema(full).option("basePath", f"{self.path}/data")
        return reader.parquet(*folders).select(*full.names)

    def watermark(self, time: str):
        """Largest stored ``time``, or None. Partitions must be named in time order,
        so that one column of the last dated one is all there is to read."""
        names = [name for name in self.partitions() if name != UNDATED]
        if not names:
            return None
        newest = self.read(names[-1:]).agg(F.max(time).cast("timestamp_ntz")).first()[0]
        return newest  # wall-clock time of the session, as ``moment`` takes it

    # -- writing -----------------------------------------------------------

    def replace(
        self, rows: DataFrame, touched: Sequence[str], index: dict[str, list[int]] | None = None
    ) -> None:
        """Make ``rows`` the whole content of the touched partitions.

        ``index`` is the state of the index after that; without it the table has none, and the next
        merge looks through the stored keys and makes one.
        """
        written = self._write(rows)
        stale = set(written) - set(touched)
        if stale:
            raise ValueError(f"rows outside the touched partitions: {sorted(stale)}")
        self._commit(rows, touched, written, index)

    def _write(self, rows: DataFrame) -> list[str]:
        """Write rows below the next version, which no manifest names yet; the partitions they are in."""
        folder = f"{self.path}/data/_version={self.version + 1}"
        # Rebalancing gathers a partition into few files and splits an oversized one; in the
        # order of the key, row groups can be skipped by key range.
        gathered = rows.hint("rebalance", PART).sortWithinPartitions(PART, self.key)
        gathered.write.mode("overwrite").option("compression", CODEC).partitionBy(PART).parquet(folder)
        return [
            name.split("=", 1)[1]
            for name in files.children(self.spark, folder)
            if name.startswith(f"{PART}=")
        ]

    def _commit(
        self, rows: DataFrame, touched: Sequence[str], written: Sequence[str], index: dict[str, list[int]] | None
    ) -> None:
        manifest = self._manifest()
        version = manifest["version"] + 1
        parts = {p: v for p, v in manifest["parts"].items() if p not in set(touched)}
        parts.update({p: version for p in written})
        schema = T.StructType([f for f in rows.schema if f.name != PART])
        self._pending = {
            "version": version,
            "parts": parts,
            "schema": schema.jsonValue(),
            "index": index,
            "buckets": self.index.buckets,
        }
        if not self.held:
            self.publish()

    def publish(self) -> None:
        """Make what was committed the state that all readers see.

        Readers of a pinned version see it once they are given its number (``version``).
        """
        if self._pending is None:
            return
        content = dict(self._pending)
        if self.at is not None:
            # A manifest of this number that no reader was ever given is what a broken publication has left.
            files.delete(self.spark, f"{self.path}/manifest/{content['version']:010d}.json")
            self.at = content["version"]
        files.publish_text(
            self.spark, f"{self.path}/manifest/{content['version']:010d}.json", json.dumps(content)
        )
        self._pending = None

    def tidy(self, keep: int = 2) -> None:
        """Delete what no manifest of the last ``keep`` versions names, for readers that began before the last."""
        versions = [v for v in self._versions() if self.at is None or int(v.split(".")[0]) <= self.at]
        named: dict[str, set[str]] = {"data": set(), "index": set()}
        for name in versions[-keep:]:
            content = json.loads(files.read_text(self.spark, f"{self.path}/manifest/{name}"))
            named["data"] |= {f"_version={v}/{PART}={p}" for p, v in content["parts"].items()}
            named["index"] |= {f"_version={v}/_bucket={b}" for b, vs in (content.get("index") or {}).items() for v in vs}
        for kind, kept in named.items():
            held = {path.split("/")[0] for path in kept}
            for folder in files.children(self.spark, f"{self.path}/{kind}"):
                if folder not in held:
                    files.delete(self.spark, f"{self.path}/{kind}/{folder}")
                    continue
                for part in files.children(self.spark, f"{self.path}/{kind}/{folder}"):
                    if "=" in part and f"{folder}/{part}" not in kept:
                        files.delete(self.spark, f"{self.path}/{kind}/{folder}/{part}")
        for name in versions[:-keep]:
            files.delete(self.spark, f"{self.path}/manifest/{name}")

    def overwrite(self, rows: DataFrame) -> None:
        """Full refresh: the new rows replace every partition."""
        placed = pin(rows.withColumn(PART, self.partition), "refresh")
        index = self._add_postings(placed, {})
        self.replace(placed, sorted({*self.partitions(), *_part_names(placed)}), index)

    def _add_postings(self, rows: DataFrame, state: dict, base: bool = False) -> dict[str, list[int]]:
        places = rows.select(F.col(self.key).alias("key"), F.col(PART).alias("place"))
        version = self._manifest()["version"] + 1
        return self.index.add(places, state, -version if base else version)

    def _index_state(self) -> dict[str, list[int]]:
        """State of the index, made anew where the table has none of as many buckets."""
        manifest = self._manifest()
        if manifest.get("index") is not None and manifest["buckets"] == self.index.buckets:
            return manifest["index"]
        # An older version than the merge's own, which follows.
        return self._add_postings(self._read_with_part().filter(F.col(self.key).isNotNull()), {}, base=True)

    def merge(self, batch: DataFrame, time: str, evolve: bool = False) -> None:
        """Keep the latest row of each key, be it stored or in the batch.

        The result does not depend on the order in which batches arrive. Only partitions
        that hold a stored row of a batch key or receive a row are read and rewritten.
        Other columns or types than the stored ones are refused, or with ``evolve`` taken over
        where the drift report accepts them; rows written before then need not be rewritten.
        """
        latest = keep_latest(batch, self.key, time).withColumn(PART, self.partition)
        if not self.exists():
            self._load(latest)
            return
        batch = pin(latest, "merge-batch")
        incoming = _part_names(batch)
        if not incoming:
            return
        keys = batch.select(F.col(self.key).alias("key"))
        buckets = self.index.touched(keys)
        schema, incoming_schema = self.schema(), T.StructType([f for f in batch.schema if f.name != PART])
        if evolve:
            schema = merged_schema(schema, incoming_schema)
        if schema is None or not evolve:
            check_schema(self.schema(), incoming_schema)
        batch = conform(batch, T.StructType([*schema, T.StructField(PART, T.StringType())]))
        state = self._index_state()
        places = self.index.find(keys, state, buckets).select("place").distinct().collect()
        holding = sorted(r.place for r in places if r.place in self._manifest()["parts"])
        touched = sorted({*incoming, *holding})
        own = batch.select(self.key)
        stored = self._read_with_part(holding, schema).join(own, self.key, "left_semi").select(*batch.columns)
        latest = pin(keep_latest(stored.unionByName(batch), self.key, time), "merge-latest")
        kept = self._read_with_part(touched, schema).join(own, self.key, "left_anti")
        index = self._add_postings(latest, state)
        self.replace(kept.select(*batch.columns).unionByName(latest), touched, index)

    def _load(self, rows: DataFrame) -> None:
        """First rows of the table: written once, and the index made from what was written."""
        written = self._write(rows)
        if not written:
            return
        folder = f"{self.path}/data/_version={self.version + 1}"
        placed = self.spark.read.schema(rows.schema).option("basePath", folder).parquet(*(f"{folder}/{PART}={p}" for p in written))
        odd = {r[0] for r in placed.select(PART).distinct().collect()} ^ set(written)
        if odd:
            raise ValueError(f"texts that cannot name a partition: {sorted(map(str, odd))}")
        self._commit(rows, written, written, self._add_postings(placed, {}))


def _part_names(df: DataFrame) -> list[str]:
    """Partition names of a table: as many as it has days or months."""
    return sorted(row[0] for row in df.select(PART).distinct().collect())


def later_than(df: DataFrame, time: str, watermark) -> DataFrame:
    """Rows strictly newer than the stored maximum; all of them on a first load."""
    return df if watermark is None else df.filter(F.col(time) > moment(watermark))


LOADED_AT = "_ingested_at"


def write_raw_zone(
    df: DataFrame, root: str, source: str, ingestion_date: str, loaded_at: datetime | None = None
) -> str:
    """One day of a raw source; a second run replaces that day only.

    ``loaded_at`` is stored with every row, as the time that freshness is judged by later.
    """
    folder = f"{root.rstrip('/')}/raw/{source}"
    if loaded_at is not None:
        df = df.withColumn(LOADED_AT, moment(loaded_at))
    (
        df.withColumn("ingestion_date", F.lit(ingestion_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy("ingestion_date")
        .parquet(folder)
    )
    return folder


def landed_day(df: DataFrame, root: str, source: str, ingestion_date: str) -> DataFrame:
    """Rows of ``df`` as one day of the raw zone has them, so that landing them again does not make them again."""
    folder = f"{root.rstrip('/')}/raw/{source}/ingestion_date={ingestion_date}"
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def landed_files(
    spark: SparkSession, folders: dict[str, str], ingestion_date: str | None = None
) -> DataFrame:
    """Files, bytes and rows per landed source, of one day if given (only its folder is read)."""
    parts = []
    for source, folder in folders.items():
        landed = spark.read.parquet(folder)
        if ingestion_date is not None:
            landed = landed.filter(F.col("ingestion_date").cast("string") == ingestion_date)
        meta = landed.select(
            F.lit(source).alias("source"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
        )
        parts.append(meta.groupBy("source", "file", "bytes").agg(F.count("*").alias("rows")))
    listed = parts[0]
    for part in parts[1:]:
        listed = listed.unionByName(part)
    return listed.groupBy("source").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    )


HEADER_FILE = "_header.csv"


def write_csv(df: DataFrame, path: str, columns: Mapping[str, str]) -> None:
    """Export the named columns under the given headings, with semicolons.

    Every value is quoted and an inner quote doubled; headings are not quoted. Rows go to
    part files without a heading. The heading, with a byte-order mark, is one file of its own that
    Spark's readers skip; the header file followed by the parts in order is the whole export.
    """
    (
        df.select(*columns)
        .write.mode("overwrite")
        .option("header", False)
        .option("sep", ";")
        .option("quoteAll", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    files.write_text(df.sparkSession, f"{path}/{HEADER_FILE}", "\ufeff" + ";".join(columns.values()) + "\n")


FILE = "file"


def write_export(
    df: DataFrame,
    path: str,
    columns: Mapping[str, str],
    order: Sequence[Column],
    rows_per_file: int = 1_000_000,
) -> None:
    """Export the named columns as whole files: each begins with the heading and holds its share of the rows in order.

    Values are quoted with inner quotes doubled, separated by semicolons; headings are not quoted and follow a
    byte-order mark. Files are numbered folders (``file=0``, ``file=1``...) in the order of the rows.
    """

    def quoted(column: str) -> Column:
        text = F.coalesce(F.col(column).cast("string"), F.lit(""))
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    rows = df.select(*columns).orderBy(*order)
    rows = pin(rows.select(F.concat_ws(";", *map(quoted, columns)).alias("value"), F.monotonically_increasing_id().alias("_at")), "export")
    # Rows before each partition of the sorted table: one number a partition.
    part = F.shiftright("_at", 33)
    counts = sorted((r.part, r.n) for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for number, n in counts:
        before.append((number, total))
        total += n
    offsets = df.sparkSession.createDataFrame(before, "part bigint, before bigint")
    place = F.col("before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    placed = rows.withColumn("part", part.cast("bigint")).join(F.broadcast(offsets), "part").select("value", place.alias("_at"))
    placed = placed.withColumn(FILE, F.floor(F.col("_at") / rows_per_file))
    heading = F.lit("\ufeff" + ";".join(columns.values())).alias("value")
    n_files = max(1, -(-total // rows_per_file))
    headings = df.sparkSession.range(n_files).select(heading, F.lit(-1).cast("bigint").alias("_at"), F.col("id").alias(FILE))
    lines = placed.unionByName(headings).repartition(min(n_files, 200), FILE).sortWithinPartitions(FILE, "_at")
    lines.select("value", FILE).write.mode("overwrite").partitionBy(FILE).text(path)


def write_cube(cube: DataFrame, path: str) -> None:
    """Cube cells in folders by channel and period, so a report reads one of them."""
    cube.write.mode("overwrite").partitionBy("channel", "period").parquet(path)
