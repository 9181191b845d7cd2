"""Table writers. Every target path is the caller's."""

from __future__ import annotations

import errno
import os
import re
import shutil
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators.scale import global_positions, hot_key_join, spread
from shoplens.sources.readers import NO_VALUE


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, target.getFileSystem(conf), conf


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder; empty if there is none."""
    jvm, fs, _ = _filesystem(spark, folder)
    target = jvm.org.apache.hadoop.fs.Path(folder)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")  # what Spark escapes in the names of folders
CRC_BYTES = 512  # bytes to a checksum, as Hadoop's local file system has it


def write_text_folders(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write ``value`` as text, one folder for each combination of ``by`` (at least one column); a folder that is there is replaced, others stay.

    The layout is that of ``partitionBy(*by).text(path)``, which does it where ``path`` is no local folder. Spark's local file system starts a
    process for every file it makes, to set permissions, and one thread commits all folders. So there the tasks make the files themselves, with
    the same checksum files, under a hidden folder; after all are made, the folders of the attempts that counted are moved by many tasks.
    """
    spark = df.sparkSession
    jvm, fs, _ = _filesystem(spark, path)
    if fs.getUri().getScheme() != "file":
        writer = df.select("value", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by).text(path)
        return
    root = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)).toUri().getPath()
    run = uuid.uuid4().hex
    staging = f"{root}/.staging-{run}"
    os.makedirs(staging)
    try:
        rows = df.select(F.col("value").cast("binary"), *[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in by])  # bytes: lines may be in any encoding
        made = rows.sortWithinPartitions(*by).mapInArrow(_folder_maker(staging, run, list(by)), "attempt bigint, folder string")
        listed = f"{staging}/folders"
        made.write.parquet(f"file://{listed}")  # holds the rows of attempts that counted, no others
        staged = spread(spark.read.schema(made.schema).parquet(f"file://{listed}"), "folder")
        staged.mapInArrow(_folder_mover(staging, root, run), "attempt bigint, folder string").write.format("noop").mode("overwrite").save()
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def _folder_maker(staging: str, run: str, by: list[str]):
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        top, name = f"{staging}/{task.taskAttemptId()}", f"part-{task.partitionId():05d}-{run}.c000.txt"
        now, out = None, None
        for batch in batches:
            folders = []
            lines, keys = batch.column("value").to_pylist(), zip(*[batch.column(c).to_pylist() for c in by], strict=True)
            for line, key in zip(lines, keys, strict=True):
                if key != now:
                    if out is not None:
                        out.close()
                    now, folder = key, "/".join(f"{_escaped(c)}={_escaped(v)}" for c, v in zip(by, key, strict=True))
                    folders.append(folder)
                    os.makedirs(f"{top}/{folder}")
                    out = _CheckedFile(f"{top}/{folder}", name)
                out.write((line or b"") + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array([task.taskAttemptId()] * len(folders), pa.int64()), pa.array(folders, pa.string())], ["attempt", "folder"])
        if out is not None:
            out.close()

    return make


def _escaped(value: str | None) -> str:
    return ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE


class _CheckedFile:
    """A file and beside it its checksums, which Hadoop's local file system compares when it reads."""

    def __init__(self, folder: str, name: str) -> None:
        self.data, self.sums, self.rest = open(f"{folder}/{name}", "wb"), open(f"{folder}/.{name}.crc", "wb"), b""
        self.sums.write(b"crc\0" + CRC_BYTES.to_bytes(4, "big"))

    def write(self, some: bytes) -> None:
        self.data.write(some)
        self.rest += some
        if len(self.rest) >= CRC_BYTES:
            whole = len(self.rest) // CRC_BYTES * CRC_BYTES
            for at in range(0, whole, CRC_BYTES):
                self._sum(self.rest[at : at + CRC_BYTES])
            self.rest = self.rest[whole:]

    def _sum(self, some: bytes) -> None:
        self.sums.write(zlib.crc32(some).to_bytes(4, "big"))

    def close(self) -> None:
        if self.rest:
            self._sum(self.rest)
        self.data.close()
        self.sums.close()


def _folder_mover(staging: str, root: str, run: str):
    """Moves staged folders in place; a folder moved before, by an attempt that was cut off or ran beside this one, is passed over."""

    def move(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parents = set()
        for batch in batches:
            for attempt, folder in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                source, target = f"{staging}/{attempt}/{folder}", f"{root}/{folder}"
                if (parent := os.path.dirname(target)) not in parents:
                    os.makedirs(parent, exist_ok=True)
                    parents.add(parent)
                try:
                    os.rename(source, target)
                except FileNotFoundError:
                    continue
                except OSError as there:
                    if there.errno not in (errno.ENOTEMPTY, errno.EEXIST):
                        raise
                    _replace_files(source, target, run)
            yield batch

    return move


def _replace_files(source: str, target: str, run: str) -> None:
    """The files of this run take the place of those of others; a folder that several tasks wrote has files of each."""
    for folder, gone in ((target, True), (source, False)):
        for name in sorted(os.listdir(folder)):
            try:
                if not gone:
                    os.replace(f"{folder}/{name}", f"{target}/{name}")
                elif run not in name:
                    os.remove(f"{folder}/{name}")
            except FileNotFoundError:
                pass


def write_named_csv(df: DataFrame, folder: str, name: str, copy_to: str | None = None) -> str:
    """One CSV file of a given name, for dictionaries; one task writes it, row by row. Large tables belong to ``write_csv``."""
    spark = df.sparkSession
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(folder)
    jvm, fs, conf = _filesystem(spark, folder)
    path = jvm.org.apache.hadoop.fs.Path
    part = next(s.getPath() for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("part-"))
    target = path(folder, name)
    fs.rename(part, target)
    if copy_to:
        other = path(copy_to, name)
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, target, other.getFileSystem(conf), other, False, True, conf)
    return target.toString()


SEGMENT_VALUES = 10_000  # values of a key in one row


def corpus_lookups(tables: dict[str, tuple[DataFrame, str, str]], size: int = SEGMENT_VALUES) -> dict[str, DataFrame]:
    """Key to sorted value list for each lookup (w2r, r2e, r2l1l2, …): key, segment (from 0), values.

    ``tables``: name to (table, key column, value column). The list of a key is cut into segments of ``size`` values; one after
    another they are the whole sorted list. Distinct values are numbered over the whole sorted table, so a key with a large
    share of all values is spread over the tasks as any other rows. A key with null values only keeps one empty segment.
    """
    return {name: _segments(df, key, value, size) for name, (df, key, value) in tables.items()}


def _segments(df: DataFrame, key: str, value: str, size: int) -> DataFrame:
    pairs = df.select(F.col(key).alias("key"), F.col(value).cast("string").alias("value")).distinct()
    placed = global_positions(pairs, [F.col("key"), F.col("value").asc_nulls_first()], "place")
    # null values come first and are no values: places count from the first value on
    first = placed.groupBy("key").agg(F.min(F.when(F.col("value").isNotNull(), F.col("place"))).alias("first"))
    keyed = hot_key_join(placed.withColumn("_key", F.struct("key")), first.select(F.struct("key").alias("_key"), "first"), ["_key"])
    segment = F.coalesce(F.floor((F.col("place") - F.col("first")) / F.lit(size)), F.lit(0)).cast("int")
    named = keyed.withColumn("segment", F.greatest(segment, F.lit(0)))
    return named.groupBy("key", "segment").agg(F.array_sort(F.collect_list("value")).alias("values"))


def whole_lists(segments: DataFrame) -> DataFrame:
    """Segments put together again: key, values."""
    ordered = F.array_sort(F.collect_list(F.struct("segment", "values")))
    return segments.groupBy("key").agg(F.flatten(F.transform(ordered, lambda s: s["values"])).alias("values"))


def write_corpus_json(tables: dict[str, tuple[DataFrame, str, str]], folder: str, size: int = SEGMENT_VALUES) -> None:
    """One JSON folder per lookup, its rows sorted by key and segment over all files."""
    for name, df in corpus_lookups(tables, size).items():
        df.repartitionByRange("key", "segment").sortWithinPartitions("key", "segment").write.mode("overwrite").json(f"{folder}/{name}")
