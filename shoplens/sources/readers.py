"""Table readers."""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators.scale import materialise

BAD_RECORD = "_corrupt_record"

# File-name marks of landed files, first match wins; upper case only.
LANDING_MARKS = (
    ("ZSR", "zsr"),
    ("POSITION", "query_position"),
    ("PID", "query_product_interactions"),
    ("FREQUENCY", "query_level"),
)


SMALL_FILE = 1 << 14  # bytes of a file that may come as one row: a batch of 10,000 of them stays below 170 MB
OPEN_COST = 1 << 16
LISTING_TASKS = 4  # for each core
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder of null and of empty text
BYTE_ORDER_MARK = b"\xef\xbb\xbf"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header line. Without a schema every column is a string."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def parse_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, unreadable lines) of a CSV with a header line. The text is parsed once, into a table."""
    wide = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    rows = (
        spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
        .schema(wide).csv(path)
    )
    rows = materialise(rows, "parsed")
    good = rows.filter(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
    return good, rows.filter(F.col(BAD_RECORD).isNotNull()).select(BAD_RECORD)


def history_csv(spark: SparkSession, path: str, schema: T.StructType, search_term: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Raw history CSV to Parquet at ``target``, rows without a search term left out; unreadable lines beside it."""
    good, bad = parse_typed_csv(spark, path, schema)
    good.filter(F.col(search_term).isNotNull()).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target), bad


def truth_csv(spark: SparkSession, path: str, list_columns: list[str], target: str) -> DataFrame:
    """Ground-truth CSV to Parquet with list columns parsed from text."""
    from shoplens.functions.arrays import clean_list, parse_list_text

    rows = read_csv(spark, path).withColumns({c: clean_list(parse_list_text(F.col(c))) for c in list_columns})
    rows.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def landing_type(name: Column) -> Column:
    kind = None
    for mark, label in LANDING_MARKS:
        kind = F.when(F.contains(name, F.lit(mark)), label) if kind is None else kind.when(F.contains(name, F.lit(mark)), label)
    return kind.otherwise("other")


def route_landing(files: DataFrame, run_date: Column) -> DataFrame:
    """Files modified on the run date with their type and date. ``files``: path, modificationTime."""
    name = F.element_at(F.split("path", "/"), -1)
    day = F.to_date("modificationTime")
    return files.filter(day == run_date).select("path", landing_type(name).alias("type"), day.alias("date"))


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and modification time of the files of a landing folder; contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path", "modificationTime", "length")


@contextlib.contextmanager
def many_small_files(spark: SparkSession) -> Iterator[None]:
    """Folders listed and files scanned inside are dealt in a few tasks a core, where Spark makes one for each folder (to 10,000) or 32 files."""
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    set_to = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks), "spark.sql.files.openCostInBytes": str(OPEN_COST)}
    before = {k: spark.conf.get(k, None) for k in set_to}
    try:
        for k, v in set_to.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _codec_endings(spark: SparkSession) -> list[str]:
    """Endings of the names of files that Spark unpacks when it reads text."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return sorted(jvm.org.apache.hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension() for c in codecs)


def binary_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files at any depth of a folder, which is listed here; their content is read only where it is selected."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def text_lines(spark: SparkSession, folder: str, files: DataFrame, only: Column | None = None) -> DataFrame:
    """Lines of the text files of a folder, given as ``binary_files``: value, url and block (where in the file its piece begins).

    ``only`` chooses files by ``_metadata``; others are not opened. Spark's text reader takes milliseconds to begin a file, so small ones come
    as a row each and are cut into lines as it does; larger and packed ones it reads itself, after a listing of its own.
    """
    place = [F.col("_metadata.file_path").alias("url"), F.col("_metadata.file_block_start").alias("block")]
    small = F.col("_metadata.file_size") <= F.lit(SMALL_FILE)
    for ending in _codec_endings(spark):
        small = small & ~F.col("_metadata.file_name").endswith(ending)
    chosen = files if only is None else files.filter(only)
    few = chosen.filter(small).select(F.col("content").alias("value"), *place)
    lines = few.mapInArrow(_cut_lines, few.schema).withColumn("value", F.col("value").cast("string"))
    others = chosen.filter(~small).select(place[0])
    if others.isEmpty():
        return lines
    read = spark.read.option("recursiveFileLookup", True).text(folder).filter(~small).select("value", *place)
    return lines.unionByName(read.join(others, "url", "left_semi"))  # the first listing says which files, also where one has grown since


def folder_value(url: Column, name: str) -> Column:
    """Value of a partition column in the url of a file. Finding the columns of a table of n folders takes Spark a time of the order of n squared."""
    found = F.regexp_extract(url, f".*/{name}=([^/]*)/", 1)
    plain = lambda c: F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    return F.when(found != NO_VALUE, plain(plain(found)))  # names of folders are escaped, and urls again


def _cut_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line of the column value."""
    for batch in batches:
        lines, at = [], []
        for i, content in enumerate(batch.column("value").to_pylist()):
            found = content.removeprefix(BYTE_ORDER_MARK).splitlines()
            lines.extend(found)
            at.extend([i] * len(found))
        rows = batch.take(pa.array(at, pa.int64()))
        yield rows.set_column(batch.schema.get_field_index("value"), "value", pa.array(lines, pa.binary()))
