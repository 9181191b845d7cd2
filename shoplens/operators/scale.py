"""Helpers that keep an operator whole and balanced when one key holds a large share of the rows.

None of them drops, caps or samples rows. Each replaces a shape that would put an unbounded group
in a single task (global window, hot join key, exact percentile, per-user lag) by one whose largest
task is bounded by the partitioning.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the executors")
    fallback = tempfile.mkdtemp(prefix="shoplens-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/shoplens-{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Cut the lineage by writing a table to the shared folder and reading it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Set a column whose costly value later filters read several times.

    Filters move below a projection and take the whole expression along, once per use. They do not
    move below a generator, so a one-element outer explode has the value computed a single time.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode_outer(F.array(value)).alias(name))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Even tasks for a step that multiplies its input many times, or writes many small files: as many as the session gives a shuffle, and
    work for all cores, also where Spark would put so few bytes in one task. Rows of the same values of ``by`` stay together.

    The number follows the cluster's settings, not the table, so a larger table wants a larger ``spark.sql.shuffle.partitions``.
    """
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)


TASK_ROWS = 1_000_000  # rows of one key that a task of a join may take
MOST_HEAVY = 10_000  # keys that are salted at most: a bound for what is broadcast


def heavy_keys(fact: DataFrame, on: Sequence[str], task_rows: int = TASK_ROWS) -> DataFrame | None:
    """(keys, _salts) of the keys with more than ``task_rows`` rows, one salt per ``task_rows`` of them; None without any.

    Where more than ``MOST_HEAVY`` keys are that large, the rows per salt grow until no more are left; keys below stay within
    the rows of a key that is not split.
    """
    counts = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    many = materialise(counts.filter(F.col("_n") > task_rows), "heavy-keys")
    found, rows = many.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not found:
        return None
    unit = max(task_rows, -(-rows // MOST_HEAVY)) if found > MOST_HEAVY else task_rows
    return many.filter(F.col("_n") > unit).select(*on, F.ceil(F.col("_n") / F.lit(unit)).alias("_salts"))


def lookup_join(fact: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows to a table holding few rows per key. Spark broadcasts a small lookup and splits skewed partitions itself."""
    return fact.join(lookup, list(on), how)


def hot_key_join(fact: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner", task_rows: int = TASK_ROWS) -> DataFrame:
    """Inner or left join where a key may hold a large share of the rows of ``fact``.

    Keys are counted on the fact side first. Without a heavy key it is a plain join. A heavy key's rows get one salt for every
    ``task_rows`` of them, by a digest of the whole row, and only its lookup rows are repeated, once a salt; all other keys
    have the single salt 0 on both sides.
    """
    on = list(on)
    heavy = heavy_keys(fact, on, task_rows)
    if heavy is None:
        return fact.join(lookup, on, how)
    few = F.broadcast(heavy)  # at most MOST_HEAVY rows
    salts = F.coalesce("_salts", F.lit(1))
    salted = fact.join(few, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), salts)).drop("_salts")
    repeated = lookup.join(few, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop("_salts")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def _with_partition_offsets(rows: DataFrame, weight: Column) -> DataFrame:
    """Join each row to the weight held by all sort partitions before its own.

    The right side has one row per sort partition, so its size is bounded by the partition count.
    """
    sizes = rows.groupBy("_part").agg(F.sum(weight).alias("_weight"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_weight").over(before), F.lit(0)).alias("_offset"))
    return rows.join(F.broadcast(offsets), "_part")


def global_positions(df: DataFrame, order: Sequence[Column], position: str = "position") -> DataFrame:
    """Number all rows 1..n in ``order`` without a single-partition window.

    A range-partitioned sort is written once; a row's number is its place inside its partition plus
    the sizes of the partitions before it. Ties in ``order`` should be broken by the caller.
    """
    ordered = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    rows = materialise(ordered, "sorted").withColumn("_part", F.shiftright("_place", POSITION_BITS))
    inside = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return (
        _with_partition_offsets(rows, F.lit(1))
        .withColumn(position, (inside + F.col("_offset") + 1).cast("long"))
        .drop("_place", "_part", "_offset")
    )


def global_running_sum(df: DataFrame, order: Sequence[Column], weight: str, total: str = "running") -> DataFrame:
    """Inclusive running sum of ``weight`` over the whole table in ``order``."""
    ordered = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    rows = materialise(ordered, "sorted").withColumn("_part", F.shiftright("_place", POSITION_BITS))
    upto = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _with_partition_offsets(rows, F.col(weight))
        .withColumn(total, F.sum(weight).over(upto) + F.col("_offset"))
        .drop("_place", "_part", "_offset")
    )


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank", salts: int = 64
) -> DataFrame:
    """First ``n`` rows of each group in ``order`` (which must be total), with their rank.

    Up to the optimizer's group-limit threshold Spark itself trims every map partition to ``n`` rows
    per group. Beyond it a salted first pass trims each group in ``salts`` tasks.
    """
    keys = list(keys)
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n >= threshold:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_rank", F.row_number().over(part))
            .filter(F.col("_rank") <= n)
            .drop("_rank", "_salt")
        )
    group = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(group)).filter(F.col(rank) <= n)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Exact linearly interpolated percentiles of ``value`` per group.

    Equal values merge first; the distinct ones are range sorted over the whole cluster, so a group
    of any size is spread over many tasks. Each wanted rank is then found by an aggregate.
    """
    keys = list(keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col(k) for k in keys] + [F.col(value)]
    ranked = global_running_sum(counts, order, "_n", "_upto")
    spans = ranked.groupBy(*keys).agg(F.min(F.col("_upto") - F.col("_n")).alias("_base"), F.sum("_n").alias("_total"))
    joined = lookup_join(ranked, spans, keys) if keys else ranked.join(F.broadcast(spans))
    first = F.col("_upto") - F.col("_n") - F.col("_base")
    last = F.col("_upto") - F.col("_base") - 1
    picks, results = [], []
    for i, p in enumerate(probabilities):
        place = F.lit(float(p)) * (F.col("_total") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            inside = (first <= rank) & (rank <= last)
            picks.append(F.max(F.when(inside, F.col(value))).alias(f"_{side}{i}"))
        picks.append(F.max(place - F.floor(place)).alias(f"_f{i}"))
        low, high, part = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_f{i}")
        results.append((low + (high - low) * part).alias(names[i]))
    return joined.groupBy(*keys).agg(*picks).select(*keys, *results)


def lag_by_time(
    df: DataFrame, keys: Sequence[str], ts: str, previous: str = "prev_ts", bucket_seconds: int = 86400
) -> DataFrame:
    """Previous timestamp per key for rows with distinct (key, timestamp).

    The window runs inside time buckets; the first row of a bucket takes the latest timestamp of the
    nearest earlier bucket, found on one row per (key, bucket). A hot key is split by its buckets.
    """
    keys = list(keys)
    bucketed = df.withColumn("_bucket", F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / F.lit(bucket_seconds)))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(ts)
    lagged = bucketed.withColumn("_inside", F.lag(ts, 1).over(inside))
    across = Window.partitionBy(*keys).orderBy("_bucket")
    tails = (
        bucketed.groupBy(*keys, "_bucket")
        .agg(F.max(ts).alias("_tail"))
        .withColumn("_before", F.lag("_tail", 1).over(across))
        .select(*keys, "_bucket", "_before")
    )
    return (
        lagged.join(tails, [*keys, "_bucket"], "left")
        .withColumn(previous, F.coalesce("_inside", "_before"))
        .drop("_inside", "_before", "_bucket")
    )
