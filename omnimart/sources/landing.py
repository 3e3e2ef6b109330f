"""The eight CSV sources of a landing folder."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from omnimart.functions.scalars import moment
from omnimart.operators import files
from omnimart.session import pin
from omnimart.sources.schemas import EVENT_TIME, SOURCE_NAMES, file_of, schema_of

BAD_RECORD = "_bad_record"
INGESTED_AT = "_ingested_at"


#: Bytes of a file that one task reads.
LARGEST_FILE = 256 << 20


class OversizedFile(ValueError):
    """A landing file is too large to be read by one task."""


class MissingSources(FileNotFoundError):
    """At least one source file is absent; the message lists all of them."""


class LandingSource:
    """Typed reads of the landing files.

    A value that does not fit its column becomes null and the whole line is kept
    in ``quarantine``; nothing is inferred from the data. A quoted value may hold line breaks. For that a
    file is read as a whole by one task, so it may have at most ``largest`` bytes; a source
    of more is a folder of several files.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        loaded_at: datetime | None = None,
        largest: int = LARGEST_FILE,
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.loaded_at = loaded_at
        self.largest = largest
        self._measured: set[str] = set()

    def check_present(self) -> None:
        present = set(files.children(self.spark, self.folder))
        missing = [file_of(name) for name in SOURCE_NAMES if file_of(name) not in present]
        if missing:
            raise MissingSources(", ".join(missing))

    def _bounded(self, name: str) -> None:
        """Refuse a source with a file that is too large for one task."""
        if name not in self._measured:
            size, path = files.largest_file(self.spark, f"{self.folder}/{file_of(name)}")
            if size > self.largest:
                raise OversizedFile(f"{path} has {size} bytes; write it as files of at most {self.largest}")
            self._measured.add(name)

    def _read(self, name: str) -> DataFrame:
        self._bounded(name)
        schema = schema_of(name).add(BAD_RECORD, "string")
        return (
            self.spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", True)
            .option("encoding", "UTF-8")
            .option("escape", '"')
            .option("nullValue", None)
            .option("emptyValue", "")
            .option("columnNameOfCorruptRecord", BAD_RECORD)
            .csv(f"{self.folder}/{file_of(name)}")
        )

    def table(self, name: str, since: datetime | None = None) -> DataFrame:
        df = self._read(name).drop(BAD_RECORD)
        if since is not None and name in EVENT_TIME:
            df = df.filter(F.col(EVENT_TIME[name]) >= moment(since))
        return df

    def quarantine(self, name: str) -> DataFrame:
        """Lines that did not fit the schema, stored because they are only known once parsed."""
        return pin(self._read(name).filter(F.col(BAD_RECORD).isNotNull()), f"bad-{name}")

    def loaded(self, name: str) -> DataFrame:
        """The table with its ingestion time, one value for the whole load."""
        loaded = moment(self.loaded_at) if self.loaded_at else F.current_timestamp()
        return self.table(name).withColumn(INGESTED_AT, loaded)

    def register_views(self, prefix: str = "raw_") -> list[str]:
        """One temporary view per source, after checking that all files are there."""
        self.check_present()
        names = []
        for name in SOURCE_NAMES:
            self.loaded(name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names


def source_counts(source, names=SOURCE_NAMES) -> DataFrame:
    """Rows per source, all sources in one job."""
    parts = [
        source.table(name).agg(F.count("*").alias("records")).select(
            F.lit(name).alias("source"), "records"
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, parts)
