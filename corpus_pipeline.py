"""Cleaning pipeline over ``documents``: each stage applies one operator to all that its predecessor kept.

1. ``quality``: documents whose probability of a usable grade is below one half go.
2. ``line_dedup``: lines that occurred before, alike or nearly by runs of four characters, go; a document that loses all its
   lines goes.
3. ``ngram_jaccard``: of documents linked by similarity 0.8 on five-word shingles, the smallest id stays.
4. ``decontaminate``: documents that hold a benchmark item go.
5. ``sentencepiece``: the remaining texts as token ids.

Rows and columns: documents with a null id come after all others in the order of ids, each as a document of its own, and
keep their null id. Rows that repeat an id with another text are documents of their own; rows that repeat both stay or go together. Null and empty
texts, and texts of blanks, have no lines, shingles or items and pass all stages that the classifier lets them reach; very long
texts are read whole. Further columns, whatever their names, pass stages 1 to 4 as they are. Empty tables give no rows; without
ratings no document is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from omnimart.llm import decontaminate, line_dedup, ngram_join, quality, sentencepiece_codec
from omnimart.llm.frames import SENT_BYTES, Pins
from omnimart.llm.queries import PIECES

#: First number of documents without an id.
NAMELESS = 1 << 62


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` as doc_id, text and one column with all others, so that no name meets an operator's own."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *([F.struct(*(F.col(f"`{c}`") for c in others)).alias("others")] if others else []))


def _together(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``found`` with the columns of ``docs``."""
    return found.select(*(F.col(c) if c in ("doc_id", "text") else F.col("others").getField(c).alias(c) for c in docs.columns))


def _numbered(docs: DataFrame, pins: Pins) -> DataFrame:
    """``docs`` with a number for each row without an id, which ``nameless`` tells."""
    without = docs.where("doc_id is null").withColumn("doc_id", F.lit(NAMELESS) + F.monotonically_increasing_id())
    # Stored, so that every pass sees the same numbers.
    without = pins.pin(without.withColumn("nameless", F.lit(True)), "nameless")
    return docs.where("doc_id is not null").withColumn("nameless", F.lit(False)).unionByName(without)


def _unnumbered(found: DataFrame) -> DataFrame:
    return found.withColumn("doc_id", F.when(~F.col("nameless"), F.col("doc_id"))).drop("nameless")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, quality.quality_grades(labels))
    return _together(quality.score(_apart(docs), model, tail=1).where("selected"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_numbered(_apart(docs), Pins(spark)), chars=line_dedup.SHORT_CHARS)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike("[^ \\t\\r\\n]")
    return _together(_unnumbered(found.where(~F.coalesce(emptied, F.lit(False)))), docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pins = Pins(spark)
    numbered = _numbered(_apart(docs), pins)
    later = pins.pin(ngram_join.linked_rows(numbered).where("not first").select("doc_id", "copy").distinct(), "later")
    gone = later.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"))
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_copy"))
    kept = numbered.join(F.broadcast(gone) if pins.size(later) <= SENT_BYTES else gone, same, "left_anti")
    return _together(_unnumbered(kept), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _together(decontaminate.remove_contaminated(_apart(docs), items, unnamed=True), docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = sentencepiece_codec.encode(docs.select("doc_id", "lang", "source", "text"), PIECES)
    return found.select("doc_id", "lang", "source", F.size("token_ids").alias("n_tokens"), "token_ids")


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", keep_one_of_each_group),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", tokenize),
]

#: The regression and the tokenizer have no SQL form; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and dropped when the next one is there."""
    pins, stored = Pins(spark), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = pins.pin(stage(spark, docs, sf_dir), name)
        if stored is not None:
            pins.drop(stored)
        stored = docs
    return docs
