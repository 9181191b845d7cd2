"""Tables kept up a day at a time: equal to the full computation, and reading no older day."""

import datetime as dt
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from shoplens.sources import incremental as inc
from shoplens.sources import readers as rd
from shoplens.sources import writers as wr

KIND = "query string, sku bigint, clicks bigint, cost decimal(10,2)"


def days(count, seed=3):
    rng = random.Random(seed)
    start = dt.date(2024, 1, 25)
    out = {}
    for k in range(count):
        rows = [(f"q{rng.randint(0, 6)}" if rng.random() > 0.05 else None, rng.randint(0, 3), None if rng.random() < 0.3 else rng.randint(-3, 9), rng.randint(0, 999)) for _ in range(rng.randint(0, 12))]
        out[(start + dt.timedelta(days=k)).isoformat()] = rows
    return out


def totals(rows):
    out = {}
    for q, s, c, p in rows:
        clicks, cost = out.get((q, s), (None, 0))
        out[q, s] = (clicks if c is None else (clicks or 0) + c, cost + p)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(q, s, c, p) for q, s, c, p in rows], "query string, sku bigint, clicks bigint, cents bigint").withColumn("cost", (F.col("cents") / 100).cast("decimal(10,2)"))


def read(df):
    return {(r.query, r.sku): (r.clicks, int(r.cost * 100)) for r in df.collect()}


def test_sliding_sums_equal_the_full_sum_for_thirty_days(spark, tmp_path):
    window = inc.DailySums(spark, str(tmp_path / "w"), ["query", "sku"], ["clicks", "cost"], days=6)
    data = days(30)
    dates = sorted(data)
    for k, date in enumerate(dates):
        got = read(window.advance(frame(spark, data[date]), date))
        assert got == totals([r for d in dates[max(0, k - 5) : k + 1] for r in data[d]]), date
    runs = window.runs(window.latest())
    assert sorted(runs) == dates[-6:]
    coming = "2024-02-24"
    frame(spark, data[dates[0]]).limit(0)
    window._measured(frame(spark, data[dates[0]])).write.parquet(window._daily(coming, 99))
    changed, after = window.changes(coming, 99, runs)
    assert sorted({p.split("date=")[1][:10] for p in changed.inputFiles()}) == [dates[-6], coming]  # two days are read
    assert len(after) == 6


def test_late_repeated_and_missing_days(spark, tmp_path):
    data = days(8, 5)
    dates = sorted(data)
    for length in (4, None):
        window = inc.DailySums(spark, str(tmp_path / f"w{length}"), ["query", "sku"], ["clicks", "cost"], days=length)
        kept = {}
        for date, rows in ((dates[0], data[dates[0]]), (dates[2], data[dates[2]]), (dates[1], data[dates[1]]), (dates[2], data[dates[3]]), (dates[2], data[dates[2]]), (dates[6], data[dates[6]]), (dates[0], data[dates[0]])):
            kept[date] = rows
            got = read(window.advance(frame(spark, rows), date))
            first = "" if length is None else (dt.date.fromisoformat(max(kept)) - dt.timedelta(days=length - 1)).isoformat()
            assert got == totals([r for d, own in kept.items() if d >= first for r in own])


def test_unfinished_versions_do_not_count(spark, tmp_path):
    kept = inc.DailySums(spark, str(tmp_path), ["query"], ["clicks"])
    rows = spark.createDataFrame([("a", 1)], "query string, clicks int")
    kept.advance(rows, "2024-01-01")
    kept._measured(rows).write.parquet(kept._daily("2024-01-02", 2))  # cut off before totals and manifest
    rows.write.parquet(f"{tmp_path}/totals/version=2")
    assert kept.totals().collect() == [("a", 1)]
    assert kept.advance(rows, "2024-01-02").collect() == [("a", 2)]
    with pytest.raises(TypeError):
        kept.advance(rows.withColumn("clicks", F.col("clicks").cast("double")), "2024-01-03")


def test_vector_cache(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = random.Random(4)
        cache, want = inc.VectorCache(spark, str(tmp_path / "c"), buckets=4, share=0.3), {}
        for day in range(5):
            rows = [(f"q{rng.randint(0, 60)}", rng.randint(0, 40), [float(rng.randint(0, 9))]) for _ in range(80 if day == 0 else 12)]
            df = spark.createDataFrame([*rows, (None, 1, [0.0])], "query string, ts bigint, vec array<double>").repartition(3)
            unseen = {r.query for r in cache.unseen(df.filter("query is not null")).select("query").collect()}
            assert unseen == {q for q, *_ in rows} - set(want)
            today = {}
            for q, ts, v in rows:
                today[q] = max(today.get(q, (ts, v)), (ts, v))
            for q, (ts, v) in today.items():
                if q not in want or ts > want[q][0]:
                    want[q] = (ts, v)
            cache.upsert(df)
            assert {r.query: (r.ts, r.vec) for r in cache.read().collect()} == want
        assert len(inc._versions(spark, str(tmp_path / "c" / "base"))) > 1  # the two tables were folded
        assert inc.VectorCache(spark, str(tmp_path / "c"), buckets=9).read().count() == len(want)  # the first number of buckets holds
        plan = cache.read()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        moved = cache.unseen(df.coalesce(1))._jdf.queryExecution().executedPlan().toString()
        assert moved.count("Exchange hashpartitioning") == 1  # the day's rows only
        files = [n for n in os.listdir(tmp_path / "c" / "base" / "version=2") if n.startswith("part-")]
        assert len(files) <= 4  # a file a bucket: the fold moved nothing
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_landed_files_are_routed_once(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "routed")
    landing.mkdir()
    names = {"A_ZSR_1.csv": "zsr", "POSITION_PID.csv": "query_position", "x_PID.csv": "query_product_interactions", "FREQUENCY.csv": "query_level", "pid zsr.csv": "other"}
    for name in names:
        (landing / name).write_text(f"h\n{name}\n")
    yesterday = landing / "OLD_ZSR.csv"
    yesterday.write_text("old\n")
    os.utime(yesterday, (1_700_000_000, 1_700_000_000))
    today = spark.sql("SELECT CAST(current_date() AS STRING) AS d").first().d
    first = inc.route_landing_files(spark, str(landing), target, today)
    assert {r.file: r.type for r in first.collect()} == names
    content = lambda: {(r.type, r.file, r.value) for r in spark.read.text(f"{target}/data").collect()}
    before = content()
    assert before == {(t, n, v) for n, t in names.items() for v in ("h", n)}
    stamps = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "routed" / "data").rglob("part-*")}
    assert inc.route_landing_files(spark, str(landing), target, today).count() == 0
    assert content() == before and stamps == {str(p): p.stat().st_mtime_ns for p in (tmp_path / "routed" / "data").rglob("part-*")}
    (landing / "FREQUENCY.csv").write_text("changed\n")
    assert [r.file for r in inc.route_landing_files(spark, str(landing), target, today).collect()] == ["FREQUENCY.csv"]
    assert {v for _, n, v in content() if n == "FREQUENCY.csv"} == {"changed"}
    assert inc.route_landing_files(spark, str(landing), target, "2001-01-01").count() == 0


def test_many_small_files_are_landed_and_routed_by_many_tasks(spark, tmp_path, monkeypatch):
    import datetime as dt

    from shoplens.plans import load, tables_and_files

    rows = [(i, dt.datetime(2024, 1, 15, 12), "view", float(i)) for i in range(40)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(tables_and_files, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = load().QUERIES["src_landing_files"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r.files for r in found) == 40 and sum(r.lines for r in found) == 80 and {r.moved_again for r in found} == {0}
    for folder in ("landing", "routed/data"):
        assert len({p.name[:10] for p in (tmp_path / folder).rglob("part-*")}) > 4


def test_folders_of_text_are_written_as_spark_does(spark, tmp_path):
    odd = [chr(i) for i in range(1, 0x82)] + ["", None, "a+b c", "x" * 200, "ü/=%25", "PID_1.csv"]
    rows = [(f"{i} {k}" if i % 5 else None, i % 3, f"{k}{v}" if v and k else v) for i, v in enumerate(odd) for k in (0, 1, 1)] + [("long " * 400, 7, "long")]
    df = spark.createDataFrame([r for r in rows if not set(r[2] or "") & {"\n", "\r"}], "value string, n int, `f g:` string").repartition(4, "n")
    ours, sparks = str(tmp_path / "ours"), str(tmp_path / "sparks")
    wr.write_text_folders(df, ours, ["n", "f g:"])
    df.write.partitionBy("n", "f g:").text(sparks)
    folders = lambda top: {os.path.relpath(d, top): sorted(f.rsplit("-", 1)[-1][-3:] for f in files if "part-" in f) for d, _, files in os.walk(top) if d != top}
    assert folders(ours) == folders(sparks)
    lines = lambda top: sorted(map(tuple, spark.read.option("recursiveFileLookup", True).text(top).select("value", F.regexp_extract("_metadata.file_path", "(n=.*)/part-", 1)).collect()))
    assert lines(ours) == lines(sparks)  # the reader has also compared the checksums
    wr.write_text_folders(df.filter("n = 7").withColumn("value", F.lit("new")), f"file://{ours}", ["n", "f g:"])
    assert [r for r in lines(ours) if "n=7" in r[1]] == [("new", "n=7/f%20g%253A=long")]
    assert len(lines(ours)) == len(lines(sparks)) and not [n for n in os.listdir(ours) if n.startswith(".")]
    for sums in (tmp_path / "ours" / "n=7").rglob(".*.crc"):
        sums.write_bytes(sums.read_bytes()[:-4] + b"zzzz")
    with pytest.raises(Exception, match="(?i)checksum"):
        lines(ours)


def test_a_folder_that_two_tasks_write_has_the_lines_of_both(spark, tmp_path):
    df = spark.range(40).selectExpr("CAST(id AS STRING) AS value", "'x' AS f").repartition(4)
    for _ in range(2):
        wr.write_text_folders(df, str(tmp_path / "t"), ["f"])
        assert sorted(int(r.value) for r in spark.read.text(str(tmp_path / "t")).collect()) == list(range(40))


def test_attempts_that_run_twice_leave_one_copy(tmp_path):
    import pyarrow as pa

    for top in ("s/1/f=a", "s/2/f=a", "r/f=a"):
        (tmp_path / top).mkdir(parents=True)
    (tmp_path / "s/1/f=a/part-0-now").write_text("1")
    (tmp_path / "s/2/f=a/part-1-now").write_text("2")
    (tmp_path / "r/f=a/part-0-old").write_text("0")
    move = wr._folder_mover(f"{tmp_path}/s", f"{tmp_path}/r", "now")
    batch = pa.RecordBatch.from_pydict({"attempt": [1, 2], "folder": ["f=a", "f=a"]})
    for _ in range(2):
        list(move([batch]))
        assert {p.name: p.read_text() for p in (tmp_path / "r/f=a").iterdir()} == {"part-0-now": "1", "part-1-now": "2"}


def test_small_files_are_cut_into_lines_as_large_ones(spark, tmp_path, monkeypatch):
    contents = [b"", b"\n", b"a", b"a\n\nb", b"a\r\nb\rc\n\r", b"\xef\xbb\xbf", b"\xef\xbb\xbfx\ny", b"\xef\xbb\xbf\n", "é\x0b\x0c\x85\u2028é\n".encode(), b"\xff\xfe z\n", b"q,\x00\n", b"l" * 40_000 + b"\nm"]
    for i, c in enumerate(contents):
        (tmp_path / f"f=+ {i}%").mkdir()
        (tmp_path / f"f=+ {i}%" / f"{i}.csv").write_bytes(c)
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(b"packed\nlines\n"))
    d = str(tmp_path)
    spark_reads = spark.read.option("recursiveFileLookup", True).text(d)
    want = sorted((bytes(r[0]), r[1]) for r in spark_reads.select(F.col("value").cast("binary"), "_metadata.file_path").collect())
    assert len({u for _, u in want}) == len(contents) - 2 + 1
    for limit in (rd.SMALL_FILE, 3, -1):
        monkeypatch.setattr(rd, "SMALL_FILE", limit)
        got = rd.text_lines(spark, d, rd.binary_files(spark, d))
        assert sorted((bytes(r[0]), r[1]) for r in got.select(F.col("value").cast("binary"), "url").collect()) == want
    assert {r[0] for r in got.filter("url LIKE '%csv'").select(rd.folder_value(F.col("url"), "f")).collect()} <= {f"+ {i}%" for i in range(len(contents))}
    named = spark.createDataFrame([("file:/t/f=x/f=a%2520%253D%2B/p",), ("file:/t/f=__HIVE_DEFAULT_PARTITION__/p",)], "url string")
    assert [r[0] for r in named.select(rd.folder_value(F.col("url"), "f")).collect()] == ["a =+", None]


def test_routing_lists_many_folders_in_few_tasks(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "routed")
    for i in range(200):
        (landing / f"name=PID_{i}.csv").mkdir(parents=True)
        (landing / f"name=PID_{i}.csv" / "part-0.txt").write_text(f"{i}\n")
    today = spark.sql("SELECT CAST(current_date() AS STRING) AS d").first().d
    tracker, before = spark.sparkContext.statusTracker(), spark.conf.getAll
    spark.sparkContext.setJobGroup("routing", "routing")
    try:
        assert inc.route_landing_files(spark, str(landing), target, today, F.regexp_extract("path", "/name=([^/]+)/", 1)).count() == 200
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("routing") for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    assert tasks and max(tasks) <= rd.LISTING_TASKS * spark.sparkContext.defaultParallelism  # one for each of 200 folders before
    assert spark.conf.getAll == before
    found = spark.read.text(f"{target}/data")
    assert {(r.type, r.file, r.value) for r in found.collect()} == {("query_product_interactions", f"PID_{i}.csv", str(i)) for i in range(200)}


def test_corpus_segments_join_back(spark, tmp_path):
    rows = [("hot", f"v{i:05d}") for i in range(900)] * 2 + [("hot", None), (None, "x"), ("none", None)] + [(f"k{i % 50}", f"v{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "word string, value string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would be put in one task
    try:
        wr.write_corpus_json({"w2r": (df, "word", "value")}, str(tmp_path), size=40)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read_back = spark.read.schema("key string, segment int, values array<string>").json(f"{tmp_path}/w2r")
    want = {}
    for k, v in rows:
        want.setdefault(k, set()).update([] if v is None else [v])
    assert {r.key: r["values"] for r in wr.whole_lists(read_back).collect()} == {k: sorted(v) for k, v in want.items()}
    segments = read_back.collect()
    assert max(len(r["values"]) for r in segments) == 40
    hot = read_back.filter("key = 'hot'").withColumn("file", F.input_file_name())
    assert hot.count() == 23 and hot.select("file").distinct().count() > 1
