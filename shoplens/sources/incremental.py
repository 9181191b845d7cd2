"""Tables that take in one day at a time without reading the days before.

Every change writes a new version folder and, last, the manifest of that version: what has no manifest does not count, so a run
that was cut off is simply run again. Readers see the latest version that has one.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators.scale import spread
from shoplens.sources.readers import binary_files, landing_type, many_small_files, text_lines
from shoplens.sources.writers import folder_names, write_text_folders


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished versions under ``folder``, ascending."""
    names = [n for n in folder_names(spark, folder) if n.startswith("version=")]
    return sorted(int(n.removeprefix("version=")) for n in names if "_SUCCESS" in folder_names(spark, f"{folder}/{n}"))


class DailySums:
    """Sums per key over the last ``days`` days (None: over all), kept up by adding the day that comes and subtracting those that leave.

    ``folder`` holds ``daily/date=…/run=…`` (each day's own sums), ``totals/version=…`` and ``manifest/version=…`` (the day
    runs a version is made of, one row a day). A day given again takes the place of its earlier run, whose share is subtracted.
    Sums are whole numbers or decimals, which subtract exactly; a sum of nulls only is null, and keys without rows in the window are gone.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], sums: Sequence[str], days: int | None = None) -> None:
        self.spark, self.folder, self.keys, self.sums, self.days = spark, folder.rstrip("/"), list(keys), list(sums), days

    def _daily(self, date: str, run: int) -> str:
        return f"{self.folder}/daily/date={date}/run={run}"

    def latest(self) -> int | None:
        return max(_versions(self.spark, f"{self.folder}/manifest"), default=None)

    def runs(self, version: int | None) -> dict[str, int]:
        """Date to run of every day in a version: at most one row a day."""
        if version is None:
            return {}
        return {r.date: r.run for r in self.spark.read.parquet(f"{self.folder}/manifest/version={version}").collect()}

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self._parts()])

    def _parts(self) -> list[str]:
        return ["_rows", *[f"_n_{c}" for c in self.sums], *[f"_sum_{c}" for c in self.sums]]

    def _measured(self, day: DataFrame) -> DataFrame:
        """The day's rows per key, and for each sum how many values it has."""
        for c in self.sums:
            if isinstance(day.schema[c].dataType, (T.FloatType, T.DoubleType)):
                raise TypeError(f"{c}: sums of floating point numbers cannot be subtracted exactly")
        wide = {c: F.col(c) if isinstance(day.schema[c].dataType, T.DecimalType) else F.col(c).cast("long") for c in self.sums}
        counts = [F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_n_{c}") for c in self.sums]]
        return day.groupBy(*self.keys).agg(*counts, *[F.coalesce(F.sum(v), F.lit(0)).alias(f"_sum_{c}") for c, v in wide.items()])

    def changes(self, date: str, run: int, runs: dict[str, int]) -> tuple[DataFrame | None, dict[str, int]]:
        """Rows to add to the last version's totals and the days of the next one; reads the given day and the leaving ones only."""
        after = {**runs, date: run}
        if self.days is not None:
            first = (dt.date.fromisoformat(max(after)) - dt.timedelta(days=self.days - 1)).isoformat()
            after = {d: r for d, r in after.items() if d >= first}
        gone = [self._daily(d, r) for d, r in runs.items() if after.get(d) != r]
        parts = []
        if gone:
            parts.append(self.spark.read.parquet(*gone).select(*self.keys, *[(-F.col(c)).alias(c) for c in self._parts()]))
        if date in after:
            parts.append(self.spark.read.parquet(self._daily(date, run)).select(*self.keys, *self._parts()))
        return (parts[0].unionByName(parts[-1]) if len(parts) == 2 else parts[0] if parts else None), after

    def advance(self, day: DataFrame, date: str) -> DataFrame:
        """Take in the rows of one day (ISO date) and return the totals."""
        last = self.latest()
        version = (last or 0) + 1
        self._measured(day).write.mode("overwrite").parquet(self._daily(date, version))
        changed, runs = self.changes(date, version, self.runs(last))
        before = None if last is None else self.spark.read.parquet(f"{self.folder}/totals/version={last}")
        rows = before if changed is None else changed if before is None else before.unionByName(changed)
        self._summed(rows).filter("_rows > 0").write.mode("overwrite").parquet(f"{self.folder}/totals/version={version}")
        manifest = self.spark.createDataFrame(sorted(runs.items()), "date string, run int")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/version={version}")
        return self.totals()

    def totals(self) -> DataFrame:
        """Keys and sums of the latest version."""
        rows = self.spark.read.parquet(f"{self.folder}/totals/version={self.latest()}")
        return rows.select(*self.keys, *[F.when(F.col(f"_n_{c}") > 0, F.col(f"_sum_{c}")).alias(c) for c in self.sums])


def save_with_archive(df: DataFrame, folder: str, date: str, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Archive one day's result and return the cumulative table: the last one and this day, a repeated day in place of its earlier run."""
    return DailySums(df.sparkSession, folder, keys, sums).advance(df, date)


class VectorCache:
    """Latest vector of every query, in tables bucketed and sorted by query.

    ``base`` holds most rows, ``changes`` the later ones. A day's rows are sent to the cache's buckets and compared there: only they
    move, also when the two tables are folded, since joined buckets are written as the buckets they are.
    Unseen and newer rows go to a new version of ``changes``; when these outgrow ``share`` of the base, both are folded into a new base.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 32, share: float = 0.1) -> None:
        self.spark, self.folder, self.buckets, self.share = spark, folder.rstrip("/"), buckets, share

    def _open(self, part: str) -> DataFrame | None:
        versions = _versions(self.spark, f"{self.folder}/{part}")
        if not versions:
            return None
        path = f"{self.folder}/{part}/version={versions[-1]}"
        if not any(n.startswith("part-") for n in folder_names(self.spark, path)):
            return None  # a version without rows has no files
        kept = self.spark.read.parquet(f"{self.folder}/buckets").first()["buckets"]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
        name = f"vector_cache_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (query) SORTED BY (query) INTO {kept} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def _save(self, rows: DataFrame, part: str) -> None:
        version = max(_versions(self.spark, f"{self.folder}/{part}"), default=0) + 1
        if not folder_names(self.spark, f"{self.folder}/buckets"):  # the first writer's number stays
            self.spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(f"{self.folder}/buckets")
        kept = self.spark.read.parquet(f"{self.folder}/buckets").first()["buckets"]
        writer = (rows.repartition(kept, "query") if part == "base" and version == 1 else rows).write.bucketBy(kept, "query").sortBy("query").mode("overwrite")
        writer.option("path", f"{self.folder}/{part}/version={version}").saveAsTable(f"vector_cache_{uuid.uuid4().hex}")

    @staticmethod
    def _newer(left: DataFrame, right: DataFrame) -> DataFrame:
        """Full join on query; of two rows of a query the later one, the left of equals."""
        a, b = left.alias("a"), right.alias("b")
        right_wins = F.col("a.query").isNull() | (F.col("b.ts") > F.col("a.ts"))
        joined = a.join(b.hint("merge"), F.col("a.query") == F.col("b.query"), "full")
        return joined.select(*[F.when(right_wins, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in ("query", "ts", "vec")])

    def read(self) -> DataFrame | None:
        """query, ts, vec: no row is shuffled, both tables meet bucket by bucket."""
        base, changes = self._open("base"), self._open("changes")
        return base if changes is None else self._newer(base, changes)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows (query, …) whose query has no vector yet."""
        for part in ("base", "changes"):
            cached = self._open(part)
            rows = rows if cached is None else rows.join(cached.select("query").hint("merge"), "query", "left_anti")
        return rows

    def upsert(self, rows: DataFrame) -> None:
        """Take in rows (query, ts, vec): of each query the latest (of one time the greatest vector) replaces an older one. Null queries go."""
        shaped = rows.select("query", "ts", "vec").filter(F.col("query").isNotNull())
        latest = shaped.groupBy("query").agg(F.max(F.struct("ts", "vec")).alias("v")).select("query", "v.ts", "v.vec")
        base, changes = self._open("base"), self._open("changes")
        if base is None:
            self._save(latest, "base")
            return
        known = base.select("query", F.col("ts").alias("_ts"))
        fresh = latest.join(known.hint("merge"), "query", "left").filter(F.col("_ts").isNull() | (F.col("ts") > F.col("_ts"))).drop("_ts")
        self._save(fresh if changes is None else self._newer(changes, fresh), "changes")
        later = self._open("changes")
        if later.count() > self.share * base.count():
            self._save(self._newer(base, later), "base")
            self._save(later.limit(0), "changes")


def route_landing_files(spark: SparkSession, landing: str, target: str, run_date: str, name: Column | None = None) -> DataFrame:
    """Write the lines of the files that landed on ``run_date`` to ``target/type=…/date=…/file=…`` and return what was routed.

    ``target/_manifest`` lists the routed files (path, url, modificationTime, length, type, date, file); files on it are passed over, so
    a second run moves nothing, and a changed file replaces its earlier lines. A file's folder is overwritten as a whole:
    a run cut off before its manifest is written is simply run again. ``name`` gives the file's name from the column path.
    """
    with many_small_files(spark):
        return _route_files(spark, landing, target.rstrip("/"), F.lit(run_date).cast("date"), F.element_at(F.split("path", "/"), -1) if name is None else name)


def _route_files(spark: SparkSession, landing: str, target: str, run_day: Column, file: Column) -> DataFrame:
    day = F.to_date("modificationTime")
    files = binary_files(spark, landing)
    listed = files.select("path", F.col("_metadata.file_path").alias("url"), "modificationTime", "length").filter(day == run_day)
    listed = listed.select("path", "url", "modificationTime", "length", landing_type(file).alias("type"), day.alias("date"), file.alias("file"))
    manifest = f"{target}/_manifest"
    if folder_names(spark, manifest):
        done = spark.read.schema(listed.schema).parquet(manifest)
        listed = listed.join(done.select("path", "modificationTime", "length"), ["path", "modificationTime", "length"], "left_anti")
    run = f"{target}/_runs/{uuid.uuid4().hex}"
    listed.write.parquet(run)
    new = spark.read.schema(listed.schema).parquet(run)
    if not new.isEmpty():  # the landing folder is listed again only for large files to move
        today = text_lines(spark, landing, files, F.to_date("_metadata.file_modification_time") == run_day)  # files of other days are not opened
        routed = today.join(new.select("url", "type", "date", "file"), "url")
        dealt = spread(routed, "url", "block")  # a folder for each file: the time goes into making them, not into bytes
        write_text_folders(dealt, f"{target}/data", ["type", "date", "file"])
        new.write.mode("append").parquet(manifest)
    return new
