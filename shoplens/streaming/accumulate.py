"""Daily accumulation driven by newly landed files instead of a schedule.

The batch operators do the work; a micro-batch only decides which rows are new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def accumulate_history(
    spark: SparkSession, landing: str, schema: T.StructType, archive: str, checkpoint: str, keys: Sequence[str], sums: Sequence[str]
) -> StreamingQuery:
    """Sum new Parquet files per (keys, date) into ``archive/batch=…``, each file once.

    A batch that is run again after a failure overwrites its own folder. Readers sum over batches
    (see ``archived_totals``).
    """

    def write(batch: DataFrame, number: int) -> None:
        day = batch.groupBy(*keys, "date").agg(*[F.sum(c).alias(c) for c in sums])
        day.write.mode("overwrite").parquet(f"{archive}/batch={number}")

    rows = spark.readStream.schema(schema).parquet(landing)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def archived_totals(spark: SparkSession, archive: str, low: str, high: str, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    rows = spark.read.parquet(archive).filter(F.col("date").between(low, high))
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
