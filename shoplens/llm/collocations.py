"""Phrase collocations from count streams in prefix and suffix order.

Only phrases met often enough matter, and all parts of such a phrase are met at least as often. So words are counted by digest
first, then pairs of frequent words, and texts shrink to the runs of frequent pairs; phrases of two to five words are counted by
their spelling in what is left. The sets of frequent words and pairs travel as bit tables of fixed size, whose rare false
hits only leave more to be counted. Counts move as sorted streams, one for each slice of text and each range of digests, and all
streams of a range are merged at once: few rows, three bytes a word or pair.

The counts of all lengths form one stream, kept twice: sorted by the words from the first on, and from the last on. In
prefix order each phrase comes behind all phrases it begins with and right before those that go on from it, so reading the
stream once carries the count of every first part along and finds the best longer phrase. Suffix order does the same for last parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.words import Words, mixed, pieces, words_of
from shoplens.operators.scale import materialise, scratch_path, top_n_per_group

LONGEST = 5
LEAST = 100
TOP = 2000
BITS = 26  # bits of a bit table, as a power of two: 8 MB
SLICE = 4 << 20
RANGES = 10  # streams of a slice, as a power of two; a range holds that share of all distinct words, pairs or phrases
UNKNOWN = "und"
_STOP = np.zeros(256, dtype=bool)  # bytes between pieces
_STOP[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BREAK = _STOP.copy()
_BREAK[[32, 9]] = True


class Pieces:
    """Words of a batch (lang, text), and which of them have a right neighbour in their piece."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.words: Words = words_of(batch.column("text"), lower=True, breaks=_BREAK)
        w = self.words
        codes = batch.column("lang").dictionary_encode()
        self.langs = codes.dictionary.to_pylist()
        self.lang = codes.indices.to_numpy(zero_copy_only=False)[w.doc]
        stops = np.concatenate([[0], np.cumsum(_STOP[w.data])])
        self.joined = (stops[w.starts[1:]] == stops[w.starts[:-1]]) & (w.doc[1:] == w.doc[:-1])
        digests = words_of(pa.array([f"{lang.encode().hex()}." for lang in self.langs], pa.string())).names
        with np.errstate(over="ignore"):
            self.digest = mixed(w.names * np.uint64(3) + digests[self.lang])  # of language and word

    def pairs(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(self.digest[:-1] * np.uint64(5) + self.digest[1:])

    def lang_array(self, codes: np.ndarray) -> pa.Array:
        return pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int32)), pa.array(self.langs, pa.string())).cast(pa.string())

    def spelled(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and bounds of the given stretches, a line end behind each."""
        data, bounds = cut(np.append(self.words.data, np.uint8(10)), starts, ends + 1)
        data[bounds[1:] - 1] = 10
        return data, bounds

    def streams(self, digests: np.ndarray, at: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
        """Count streams of the phrases of ``size`` words that begin at the words ``at``, by language and range of their digests."""
        digests, first, n = np.unique(digests, return_index=True, return_counts=True)
        first = at[first]
        part = self.lang[first].astype(np.int64) << RANGES | (digests >> np.uint64(64 - RANGES)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, first, n = part[order], first[order], n[order].astype("<u4")
        data, bounds = self.spelled(self.words.starts[first], self.words.ends[first + size - 1])
        begin = np.flatnonzero(np.diff(part, prepend=-1))
        ends = np.append(begin[1:], len(part))[: len(begin)]
        raw, counts = data.tobytes(), n.tobytes()
        columns = [
            self.lang_array(part[begin] >> RANGES), pa.array(part[begin] & ((1 << RANGES) - 1), pa.int64()),
            pa.array([raw[bounds[i] : bounds[j]] for i, j in zip(begin, ends, strict=True)], pa.binary()).cast(pa.string()),
            pa.array([counts[4 * i : 4 * j] for i, j in zip(begin, ends, strict=True)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "range", "text", "counts"])


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the given stretches one after another, and their bounds."""
    sizes = ends - starts
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, buffers).cast(pa.string())


def within(table: np.ndarray, digests: np.ndarray) -> np.ndarray:
    place = digests >> np.uint64(59 - len(table).bit_length())  # the table has 2^BITS bits, 64 a number
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def bit_table(digests: DataFrame) -> np.ndarray:
    """Bit table of a column ``digest``: at most 2^(BITS - 6) rows of 64 bits come to the driver."""
    place = F.shiftrightunsigned("digest", 64 - BITS)
    bits = digests.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(%s & 63 as int))" % f"shiftrightunsigned(digest, {64 - BITS})").alias("bits"))
    found = bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


KEYS = "lang string, range bigint, keys binary, counts binary, n bigint"
KEY_BITS = 24  # of a digest, beside those that name its range: what shares them is counted together and told apart later, by spelling


def _counted(digests: np.ndarray) -> pa.RecordBatch:
    """Sorted streams of KEY_BITS bits of each distinct digest and its count, one row for each range of digests."""
    found, n = np.unique(digests >> np.uint64(64 - RANGES - KEY_BITS), return_counts=True)
    ranges = found >> np.uint64(KEY_BITS)
    begin = np.flatnonzero(np.diff(ranges.astype(np.int64), prepend=-1))
    ends = np.append(begin[1:], len(found))[: len(begin)]
    keys = found.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    counts = n.astype("<u4").tobytes()
    cells = lambda raw, width: pa.array([raw[width * i : width * j] for i, j in zip(begin, ends, strict=True)], pa.binary())
    none = pa.nulls(len(begin), pa.int64())
    columns = [pa.nulls(len(begin), pa.string()), pa.array(ranges[begin].astype(np.int64)), cells(keys, 3), cells(counts, 4), none]
    return pa.RecordBatch.from_arrays(columns, ["lang", "range", "keys", "counts", "n"])


def _often(streams: DataFrame, least: int) -> DataFrame:
    """(lang, digest, n): the highest bits of what the streams together count ``least`` times, and the sums of the rows (lang, n) among them."""

    def merge(table: pa.Table) -> pa.Table:
        first = table.column("range")[0].as_py()
        if first < 0:
            sums = table.group_by("lang").aggregate([("n", "sum")])
            return pa.table({"lang": sums.column("lang"), "digest": pa.nulls(len(sums), pa.int64()), "n": sums.column("n_sum")})
        raw = np.frombuffer(b"".join(table.column("keys").to_pylist()), dtype=np.uint8).reshape(-1, 3).astype(np.uint32)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype="<u4")
        found, place = np.unique(raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16, return_inverse=True)
        found = found[np.bincount(place, weights=counts, minlength=len(found)) >= least].astype(np.uint64)
        digests = (np.uint64(first) << np.uint64(KEY_BITS) | found) << np.uint64(64 - RANGES - KEY_BITS)
        return pa.table({"lang": pa.nulls(len(found), pa.string()), "digest": pa.array(digests.view(np.int64)), "n": pa.nulls(len(found), pa.int64())})

    return streams.groupBy("range").applyInArrow(merge, "lang string, digest bigint, n bigint")


def _merged(streams: DataFrame, least: int) -> DataFrame:
    """Counts (lang, size, phrase, f) of the phrases that the streams (lang, range, text, counts) together count ``least`` times."""

    def merge(table: pa.Table) -> pa.Table:
        lines = pa.array("".join(table.column("text").to_pylist()).split("\n")[:-1], pa.string())
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype="<u4").astype(np.int64)
        sums = pa.table({"phrase": lines, "n": pa.array(counts)}).group_by("phrase").aggregate([("n", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("n_sum"), least))
        size = pc.add(pc.count_substring(sums.column("phrase"), " "), 1).cast(pa.int64())
        lang = pa.array([table.column("lang")[0].as_py()] * len(sums), pa.string())
        return pa.table({"lang": lang, "size": size, "phrase": sums.column("phrase"), "f": sums.column("n_sum")})

    return streams.groupBy("lang", "range").applyInArrow(merge, "lang string, size bigint, phrase string, f bigint")


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts (lang, size, phrase, f) of all phrases of 1 to ``LONGEST`` words met at least ``least`` times in their
    language, and (lang, n), all its words. ``docs`` has lang and text, neither null."""
    spark = docs.sparkSession

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE):
            own = Pieces(batch)
            n = np.bincount(own.lang, minlength=len(own.langs)).astype(np.int64)
            none, dealt = pa.nulls(len(n), pa.binary()), np.full(len(n), -1 - len(own.digest) % (1 << RANGES))  # sums go to ranges of their own
            yield pa.RecordBatch.from_arrays([pa.array(own.langs, pa.string()), pa.array(dealt), none, none, pa.array(n)], ["lang", "range", "keys", "counts", "n"])
            yield _counted(own.digest)

    counted = materialise(_often(docs.mapInArrow(words, KEYS), least), "words")
    totals = counted.filter("digest is null").groupBy("lang").agg(F.sum("n").alias("n"))
    own_words = spark.sparkContext.broadcast(bit_table(counted.filter("digest is not null")))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE):
            own = Pieces(batch)
            known = within(own_words.value, own.digest)
            yield _counted(own.pairs()[known[1:] & known[:-1] & own.joined])

    own_pairs = spark.sparkContext.broadcast(bit_table(_often(docs.mapInArrow(pairs, KEYS), least)))
    streams = "lang string, range bigint, text string, counts binary"

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Count streams of frequent words by spelling, and each text cut down to its runs of frequent pairs, a line each."""
        for batch in pieces(batches, "text", SLICE):
            own = Pieces(batch)
            w, known = own.words, within(own_words.value, own.digest)
            at = np.flatnonzero(known)
            yield from own.streams(own.digest[at], at, 1)
            linked = np.zeros(len(known) + 1, dtype=bool)  # word i - 1 and word i
            linked[1:-1] = known[1:] & known[:-1] & own.joined
            linked[1:-1] &= within(own_pairs.value, own.pairs())
            at = np.flatnonzero(linked[1:] | linked[:-1])
            if not len(at):
                continue
            data, bounds = own.spelled(w.starts[at], w.ends[at])
            data[bounds[1:] - 1] = np.where(linked[1:][at], 32, 10)
            first = np.flatnonzero(np.diff(w.doc[at], prepend=-1))
            none = [pa.nulls(len(first), kind) for kind in (pa.int64(), pa.binary())]
            columns = [own.lang_array(own.lang[at[first]]), none[0], strings(data, np.append(bounds[first], bounds[-1])), none[1]]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "range", "text", "counts"])

    path = scratch_path(spark, "runs")
    docs.mapInArrow(runs, streams).write.option("compression", "zstd").parquet(path)
    short = spark.read.schema(streams).parquet(path)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE):
            own = Pieces(batch)
            keys = own.digest
            joined = np.append(own.joined, False)
            at = np.arange(len(keys))
            for size in range(2, LONGEST + 1):
                at = at[joined[at + size - 2]]  # words from which ``size`` are in one run
                with np.errstate(over="ignore"):
                    keys = mixed(keys[: len(own.digest)] * np.uint64(5) + np.append(own.digest[size - 1 :], np.zeros(size - 1, np.uint64)))
                yield from own.streams(keys[at], at, size)

    longer = short.filter("range is null").select("lang", "text").mapInArrow(phrases, streams)
    return materialise(_merged(short.filter("range is not null").unionByName(longer), least), "phrases"), totals


def _in_order(counts: DataFrame, words: list[str]) -> DataFrame:
    """Read the stream of counts sorted by ``words``: lang, phrase, ``parts`` (counts of the phrase's first 1, 2, ... words in this
    order) and ``longer`` (the highest count of a phrase that goes on by one word, else 0)."""
    stream = Window.partitionBy("lang", words[0]).orderBy(*words[1:])  # null, no word, comes first
    sofar = stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = [F.last(F.when(F.col("size") == k, F.col("f")), ignorenulls=True).over(sofar) for k in range(1, LONGEST)]
    out = counts.select("*", F.array(*parts).alias("parts"))
    best = F.lit(0).cast("long")
    for k in range(1, LONGEST):
        same = Window.partitionBy("lang", *words[:k])
        longer = F.max(F.when(F.col("size") == k + 1, F.col("f"))).over(same)
        best = F.when(F.col("size") == k, F.coalesce(longer, F.lit(0))).otherwise(best)
    return out.select("lang", "phrase", "size", "f", "parts", best.alias("longer"))


def best_cuts(rows: DataFrame) -> DataFrame:
    """Lowest-scoring cut of phrases (lang, phrase, size, f, n, parts, rests), the first of equal ones: lang, phrase, a, l, r, n, score."""
    cuts = []
    for k in range(1, LONGEST):
        score = f"(cast(1000 as decimal(4,0)) * cast(f as decimal(15,0)) * cast(n as decimal(18,0))) div (cast(parts[{k - 1}] as decimal(18,0)) * cast(get(rests, size - {k + 1}) as decimal(18,0)))"
        cuts.append(F.expr(f"if(size > {k}, named_struct('score', {score}, 'k', {k}, 'l', parts[{k - 1}], 'r', get(rests, size - {k + 1})), null)"))
    return rows.select("lang", "phrase", F.col("f").alias("a"), "n", F.array_min(F.array(*cuts)).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Best phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts are lower-cased (A to Z), cut into pieces at ``.,;:!?`` and line ends and into words at blanks and tabs. Phrases of 2 to
    ``LONGEST`` words met at least ``least`` times (a) are scored by floor(1000 a n / (l r)) at their lowest-scoring cut into a first part
    (met l times) and the rest (r), the first of equal ones; n counts all words of the language. A phrase inside a longer
    one met as often is left out: a longer phrase is never met more often than its parts, so one more word decides.
    Null texts are empty, a null language is ``UNKNOWN``; repeated rows count each time; other columns are not read; an empty
    table gives no rows. Products are decimals of up to 38 digits. Equal scores stand by a, then by the phrase's bytes.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts, totals = frequent_phrases(rows, least)
    split = F.split("phrase", " ")
    forward = [f"w{k}" for k in range(LONGEST)]
    named = [F.get(split, F.lit(k)).alias(w) for k, w in enumerate(forward)]
    turned = [F.get(F.reverse(split), F.lit(k)).alias(w) for k, w in enumerate(forward)]
    prefix = _in_order(counts.select("*", *named), forward).filter("size > 1")
    suffix = _in_order(counts.select("*", *turned), forward).filter("size > 1")
    suffix = suffix.select("lang", "phrase", F.col("parts").alias("rests"), F.col("longer").alias("before"))
    met = prefix.hint("merge").join(suffix, ["lang", "phrase"]).filter("greatest(longer, before) < f").join(totals, "lang")
    scored = best_cuts(met)
    ranked = top_n_per_group(scored, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
