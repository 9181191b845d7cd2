"""Exact duplicates through a persistent digest index, bucketed and sorted by digest.

The index is a parquet folder with one row per distinct text ever seen: its digest and the row that
stays. A batch is reduced to its distinct digests, those already in the index fall out by a sort-merge
anti-join that reads the index bucket by bucket without shuffling it, and the rest is appended.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.columns import BLANKS, with_heavy_keys
from shoplens.operators.scale import materialise
from shoplens.sources.writers import folder_names


@dataclass(frozen=True)
class DigestIndex:
    """Folder of the index and its number of buckets, fixed at creation (about one per 256 MB of index).

    The number is kept beside the folder; an index that is opened again has the number it was made with, whatever is asked for.
    """

    path: str
    buckets: int

    @property
    def name(self) -> str:
        return f"digest_index_{hashlib.md5(self.path.encode()).hexdigest()}"

    def open(self, spark: SparkSession) -> DataFrame:
        """The index as a bucketed table; an existing folder is taken up, a missing one starts empty."""
        buckets = self.kept(spark)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, keep_row BIGINT, batch STRING) "
            f"USING PARQUET CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def kept(self, spark: SparkSession) -> int:
        """Number of buckets of the folder, set by the first to open it."""
        beside = f"{self.path}-buckets"
        if not folder_names(spark, beside):
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(beside)
        return spark.read.schema("buckets int").parquet(beside).first()["buckets"]

    def append(self, rows: DataFrame) -> None:
        """Add rows of digests that the index does not hold; one file per bucket."""
        rows.repartition(self.kept(rows.sparkSession), "digest").write.insertInto(self.name)


def normalised(text: Column) -> Column:
    """Blank runs as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Decide for each row of a batch whether it stays, and append the new texts to the index.

    Texts are equal when identical after ``normalised``; null counts as empty, so null and empty texts are
    copies of each other. Of equal texts within a batch the row with the smallest id stays (null ids last, of
    repeated rows of one id exactly one); a text known from an earlier batch has no row kept now. An empty
    batch gives no rows and leaves the index as it is. Other columns are not read, whatever their names.
    Appending the same ``batch`` name twice is safe: its rows are recognised and keep their decision.

    Returns doc_id, keep_id, group_size (rows of this batch with the text), kept, text_sha256.
    """
    spark = docs.sparkSession
    rows = materialise(
        docs.select(F.col(id).cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256)).alias("digest"))
        .withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row")).alias("first")
    groups = materialise(rows.groupBy("digest").agg(first, F.count(F.lit(1)).alias("group_size")), "groups")
    known = index.open(spark)
    fresh = groups.join(known.hint("merge"), "digest", "left_anti")
    index.append(fresh.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), F.lit(batch).alias("batch")))
    held = index.open(spark).withColumn("now", F.col("batch") == batch).drop("batch")
    lookup = groups.select("digest", "group_size", "first").hint("merge").join(held, "digest")
    total = rows.count()
    joined = with_heavy_keys(rows, lookup, ["digest"], "group_size", total)
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("now") & (F.col("row") == F.col("first.row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
