"""Small column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators.scale import materialise

BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(identifier: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``."""
    return F.pmod(F.crc32(identifier.cast("string")), F.lit(folds))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_heavy_keys(rows: DataFrame, lookup: DataFrame, keys: list[str], size: str, total: int, share: int = 1000) -> DataFrame:
    """Inner join of rows to one lookup row per key (columns ``keys``), where ``size`` holds the key's number of rows.

    Keys with more than 1/``share`` of all ``total`` rows number fewer than ``share``, whatever the input:
    these lookup rows are broadcast, and the rows of all other keys meet by a sort-merge join in which no
    key is hot.
    """
    heavy = F.col(size) * share > F.lit(total)
    few = F.broadcast(lookup.filter(heavy))
    light = rows.join(F.broadcast(lookup.filter(heavy).select(*keys)), keys, "left_anti")
    return rows.join(few, keys).unionByName(light.hint("merge").join(lookup.filter(~heavy), keys))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` labelled rows (draw, doc_id, text, label) of docs (doc_id, text) and labels (doc_id, label).

    Drawn are the rows with the smallest digest of id, label and text, so the draw depends on the rows alone and an id that
    stands for many texts cannot exceed the limit. Rows equal in all three count once; a text with two labels counts with
    each. Null labels and null ids teach nothing; a null text is a text of its own.
    """
    taught = labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("double").alias("label")).distinct()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    known = texts.select("doc_id", "digest").join(taught, "doc_id").distinct()
    known = materialise(known.withColumn("draw", F.xxhash64("doc_id", "label", "digest")), "labelled")
    total = known.count()
    if total > limit:  # digests are spread evenly: the cut leaves a little over ``limit`` rows to be ordered
        share = min(1.0, (limit + 6 * limit**0.5) / total)
        cut = min(2**63 - 1, int(share * 2**64) - 2**63)
        known = known.filter(F.col("draw") <= cut).orderBy("draw", "doc_id", "label", "digest").limit(limit)
    drawn = texts.join(F.broadcast(known), ["doc_id", "digest"])
    return drawn.groupBy("draw", "doc_id", "label").agg(F.first("text").alias("text"))
