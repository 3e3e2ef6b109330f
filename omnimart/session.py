"""Session settings and shared-storage tables that cut a plan's lineage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "omnimart", cores: int | None = None, **conf: str) -> SparkSession:
    """Session for local runs; settings that spark-submit or a properties file gave win.

    Timestamps are UTC everywhere, and AQE coalesces small shuffle partitions,
    picks broadcast joins from measured sizes and splits skewed join partitions.
    """
    wanted = {
        "spark.app.name": app,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if cores is not None:
        wanted["spark.master"] = f"local[{cores}]"
        wanted["spark.sql.shuffle.partitions"] = str(max(cores, 1))
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # started by spark-submit, whose settings are there to be read
        SparkContext._ensure_initialized()
    given = SparkConf()
    builder = SparkSession.builder
    for key, value in {**wanted, **conf}.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where the setting is absent, a folder below the warehouse is taken and set; the
    warehouse is shared by the driver and all executors, whatever the master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, unique to this call."""
    app = spark.sparkContext.applicationId
    return "/".join((scratch_root(spark), "omnimart", app, f"{name}-{uuid.uuid4().hex[:12]}"))


#: Paths pinned in the innermost ``released`` block of this thread.
_pinned: ContextVar[list[str] | None] = ContextVar("pinned", default=None)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what ``pin`` stores within the block, on success and on failure.

    Results that leave the block must not read pinned tables.
    """
    paths: list[str] = []
    token = _pinned.set(paths)
    try:
        yield
    finally:
        _pinned.reset(token)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Codec of intermediate and stored tables: a third smaller than Spark's default.
CODEC = "zstd"


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a shared Parquet table and read it back.

    Used where one result feeds several passes: they then agree even when an
    executor is lost, and each later pass reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, name)
    if (paths := _pinned.get()) is not None:
        paths.append(path)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
