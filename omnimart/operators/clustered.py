"""Tables written in the order of a time, with the bounds of each file at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_clustered(df: DataFrame, path: str, by: str, n_files: int, most_rows: int = 5_000_000) -> None:
    """Rows in about ``n_files`` files, each a range of ``by`` and sorted by it.

    A value that a third of the rows share is cut between files by the rows' hash, and no file has more
    than ``most_rows`` rows. ``bounds`` lists the smallest and largest value of each file.
    """
    order = [F.col(by).asc_nulls_first(), F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(n_files, *order).sortWithinPartitions(F.col(by).asc_nulls_first())
    ranged.write.mode("overwrite").option("maxRecordsPerFile", most_rows).parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    found = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(by).alias("low"), F.max(by).alias("high"), F.count("*").alias("n"), F.count_if(F.col(by).isNull()).alias("nulls")
    )
    found.coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")


def bounds(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: file, low, high, n, nulls."""
    return spark.read.parquet(f"{path}/bounds")


def files_between(spark: SparkSession, path: str, low, high) -> list[str]:
    """Files that may hold values from ``low`` to before ``high``."""
    near = bounds(spark, path).filter((F.col("high") >= F.lit(low)) & (F.col("low") < F.lit(high)))
    return sorted(f"{path}/rows/{r.file}" for r in near.select("file").collect())


def read_between(spark: SparkSession, path: str, by: str, low, high) -> DataFrame:
    """Rows from ``low`` to before ``high``. No other file is opened."""
    schema = spark.read.parquet(f"{path}/rows").schema
    chosen = files_between(spark, path, low, high)
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*chosen).filter((F.col(by) >= F.lit(low)) & (F.col(by) < F.lit(high)))
