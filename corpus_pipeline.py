"""Corpus pipeline over documents: identify languages, drop copies, near copies and benchmark leaks, encode.

Each stage reads what the one before has kept, from a table written in the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import decontamination, exact_dedup, language_id, ngram_jaccard, sentencepiece_trie
from shoplens.llm.columns import table
from shoplens.llm.queries import PIECE_MODEL
from shoplens.operators.scale import materialise, scratch_path

ORACLE_SQL = None  # languages, near copies and pieces are beyond SQL; the tests hold the rows against brute force


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is near some language of the labelled rows; texts without letters and far-off ones go."""
    return language_id.accepted(docs, language_id.fit(docs.select("doc_id", "text", "lang")))


def free_name(docs: DataFrame, name: str) -> str:
    """``name`` with as many underscores behind it as it takes to be none of the columns."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays (null ids last); of repeated rows of that id one. All columns stay."""
    index = exact_dedup.DigestIndex(scratch_path(spark, "digest-index"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = exact_dedup.deduplicate(docs.select("doc_id", "text"), index, uuid.uuid4().hex).filter("kept")
    own, kept_id, kept_digest = (free_name(docs, n) for n in ("row_digest", "kept_id", "kept_digest"))
    kept = found.select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_digest))
    rows = docs.withColumn(own, F.sha2(exact_dedup.normalised(F.col("text")).cast("binary"), 256))
    stay = rows.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_digest)), "left_semi")
    return stay.dropDuplicates(["doc_id", own]).drop(own)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Rows with a number of their own, written so that it stays, and its column: ids may be null or stand for several texts."""
    row = free_name(docs, "_row")
    return materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays; null ids come last, one of equal ids stays. All columns stay."""
    rows, row = numbered(docs)
    found = ngram_jaccard.near_duplicates(rows.select(row, "text"), id=row).select(F.col("doc_id").alias(row), "component_id")
    ids = rows.select(row, F.col("doc_id").alias("own_id"))
    first = F.min(F.struct(F.col("own_id").isNull().alias("last"), "own_id", row))
    kept = found.join(ids, row).groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{row}").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go. All columns of the others stay."""
    rows, row = numbered(docs)
    found = decontamination.contaminated(rows.select(row, "text"), table(spark, sf_dir, "benchmark"), id=row).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(found, row, "left_anti").drop(row)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and whether they decode to it."""
    return sentencepiece_trie.round_trip(docs, PIECE_MODEL)


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the documents of ``sf_dir``."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = materialise(stage(spark, rows, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
