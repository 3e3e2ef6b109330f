"""Small files and folder listings through the session's own file system."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _path(spark, path)
    return fs.exists(jvm_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when there is no such folder."""
    jvm_path, fs = _path(spark, path)
    if not fs.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jvm_path))


def largest_file(spark: SparkSession, path: str) -> tuple[int, str]:
    """Size and path of the largest file at a path or directly below it; zero if there is none."""
    jvm_path, fs = _path(spark, path)
    if not fs.exists(jvm_path):
        return 0, path
    return max(((s.getLen(), s.getPath().toString()) for s in fs.listStatus(jvm_path) if s.isFile()), default=(0, path))


def fingerprint(spark: SparkSession, path: str) -> str:
    """Digest of names, sizes and modification times of the files directly below a folder and
    below its folders."""
    jvm_path, fs = _path(spark, path)
    found = []
    for status in fs.listStatus(jvm_path):
        below = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in below]
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a file."""
    jvm_path, fs = _path(spark, path)
    stream = fs.create(jvm_path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that appears only when complete and never replaces another."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}.draft"
    write_text(spark, draft, text)
    target, fs = _path(spark, path)
    if fs.exists(target) or not fs.rename(_path(spark, draft)[0], target):
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all below it."""
    jvm_path, fs = _path(spark, path)
    fs.delete(jvm_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def write_json(spark: SparkSession, path: str, report: dict) -> dict:
    """A report as one JSON file; values Spark returned (decimals, dates) become text."""
    write_text(spark, path, json.dumps(report, ensure_ascii=False, indent=2, default=str))
    return report


def read_json(spark: SparkSession, path: str) -> dict:
    """A stored report, or an empty one when it is missing or unreadable."""
    if not exists(spark, path):
        return {}
    try:
        return json.loads(read_text(spark, path))
    except ValueError:
        return {}


def one_row(df: DataFrame) -> dict:
    """The single row of an aggregate as a dict."""
    return df.first().asDict(recursive=True)
