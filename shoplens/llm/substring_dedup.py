"""Repeated word windows across a corpus, found by recompression.

Rounds of recompression rewrite every text: runs of one symbol become a symbol, then neighbours from the two halves of the
alphabet become one. New symbols are named by a 64-bit digest of what they stand for, so equal content has one name in all
tasks without a dictionary to exchange. Inside equal substrings the symbols are equal, but for a few at the edges: each symbol
carries the span of words that settles it. Every window picks one symbol settled within it, by smallest name. Spark rounds
count the picked symbols over all texts; only windows whose symbol is shared are spelled out, named in full and counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.columns import with_heavy_keys
from shoplens.llm.words import _FACTOR, _INVERSE, Words, mixed, pieces, powers, words_of
from shoplens.operators.scale import materialise

ROUNDS = 3
_INDEX = np.uint64((1 << 26) - 1)


class Spans:
    """Digest of any run of words: (a, b) for words a to b - 1."""

    def __init__(self, names: np.ndarray, salt: int = 0) -> None:
        n = len(names)
        own = mixed(names + np.uint64(salt)) if salt else names
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(own * powers(_FACTOR, n), out=self.total[1:])
        self.back = powers(_INVERSE, n + 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.total[b] - self.total[a]) * self.back[a])


def recompressed(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after ``ROUNDS`` rounds: name, first word, and the words (from, to) that settle the symbol.

    What lies at the edge of a text is settled by no words inside it, so its span reaches out of the text.
    """
    n = len(words.names)
    doc = words.doc
    sym, start = words.names.copy(), np.arange(n)
    low, high = start.copy(), start + 1

    def left(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        before = np.maximum(at - 1, 0)
        inside = (at > 0) & (doc[before] == doc[at])
        return np.where(inside, values[before], words.first[doc[at]] - 1)

    def right(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        after = np.minimum(at + 1, len(doc) - 1)
        inside = (at + 1 < len(doc)) & (doc[after] == doc[at])
        return np.where(inside, values[after], words.first[doc[at] + 1] + 1)

    for level in range(ROUNDS if n else 0):
        change = np.flatnonzero((sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])) + 1
        begin = np.concatenate([[0], change])
        end = np.concatenate([change, [len(sym)]]) - 1
        times = (end - begin + 1).astype(np.uint64)
        named = np.where(times > 1, mixed(sym[begin] ^ mixed(times)), sym[begin])
        low, high = left(low, begin), right(high, end)
        sym, start, doc = named, start[begin], doc[begin]
        second = (mixed(sym + np.uint64(level + 1)) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(sym), dtype=bool)
        joins[:-1] = ~second[:-1] & second[1:] & (doc[1:] == doc[:-1])
        taken = np.zeros(len(sym), dtype=bool)
        taken[1:] = joins[:-1]
        at, following = np.arange(len(sym)), np.minimum(np.arange(len(sym)) + 1, len(sym) - 1)
        new_low = np.where(second & ~taken, left(low, at), low)
        new_high = np.where(joins, high[following], np.where(second, high, right(high, at)))
        named = np.where(joins, mixed(sym * np.uint64(_FACTOR) + mixed(sym[following])), sym)
        sym, start, low, high, doc = named[~taken], start[~taken], new_low[~taken], new_high[~taken], doc[~taken]
    return sym, start, low, high


def window_starts(words: Words, size: int) -> np.ndarray:
    """First words of all windows of all texts."""
    counts = np.maximum(0, np.diff(words.first) - size + 1)
    shift = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return np.arange(counts.sum()) + shift


def picked(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Picked symbols: name, first and last window start they stand for, and how often they count.

    A window without any settled symbol stands for itself; a run of equal such windows is one entry that counts each.
    """
    at = window_starts(words, size)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    sym, start, low, high = recompressed(words)
    spans = Spans(words.names)
    inside = (low >= 0) & (high <= len(words.names))
    settled = np.where(inside, spans(np.where(inside, low, 0), np.where(inside, high, 0)), np.uint64(0))
    name = mixed(settled ^ mixed(sym + (start - low).astype(np.uint64)))
    first, last = np.searchsorted(low, at, "left"), np.searchsorted(high, at + size, "right")
    order = (name & ~_INDEX) | np.arange(len(name), dtype=np.uint64)
    tables, width = [order], 1
    while 2 * width <= size:
        above = tables[-1]
        tables.append(np.concatenate([np.minimum(above[:-width], above[width:]), above[max(0, len(above) - width):]]) if len(above) > width else above)
        width *= 2
    count = last - first
    found = count > 0
    choice = np.full(len(at), -1, dtype=np.int64)
    level = np.floor(np.log2(np.maximum(count, 1))).astype(np.int64)
    for k, best in enumerate(tables):
        mine = np.flatnonzero(found & (level == k))
        lowest = np.minimum(best[first[mine]], best[last[mine] - (1 << k)])
        choice[mine] = (lowest & _INDEX).astype(np.int64)
    own = np.where(found, name[choice], spans(at, at + size))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (choice[1:] != choice[:-1]) | (at[1:] != at[:-1] + 1) | (~found[1:] & (own[1:] != own[:-1]))
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(at)]]) - 1
    return own[begin], at[begin], at[end], np.where(found[begin], 1, end - begin + 1)


def _joined_digest(data: bytes, words: Words, kept: np.ndarray | slice) -> str:
    starts, ends = words.starts[kept].tolist(), words.ends[kept].tolist()
    return hashlib.sha256(b" ".join([data[a:b] for a, b in zip(starts, ends, strict=True)])).hexdigest()


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def _owners(lists: pa.Array) -> np.ndarray:
    """Row number of each value that ``lists.flatten()`` gives."""
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))


def remove_repeats(docs: DataFrame, size: int = 35, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every word covered by a window of ``size`` words that also starts anywhere else, its own text included.

    Words are runs of other than space and tab to carriage return, unchanged. Windows are judged on the input. Repeated rows are
    texts of their own, so all their windows repeat. Null and empty texts have no words; texts shorter than a window lose
    none. Other columns are not read; an empty table gives no rows.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space).
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("version", F.xxhash64("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = words_of(batch.column("text"))
            name, begin, end, times = picked(words, size)
            bounds = np.searchsorted(begin, words.first)
            shift = np.repeat(words.first[:-1], np.diff(bounds))
            data, first = words.data.tobytes(), words.first.tolist()
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"), "version": batch.column("version"), "n_words": pa.array(np.diff(words.first)),
                    "whole": pa.array([_joined_digest(data, words, slice(a, b)) for a, b in zip(first[:-1], first[1:], strict=True)]),
                    "name": _lists(name.astype(np.int64), bounds, pa.int64()), "begin": _lists(begin - shift, bounds, pa.int32()),
                    "end": _lists(end - shift, bounds, pa.int32()), "times": _lists(times, bounds, pa.int32()),
                }
            )

    kinds = "doc_id bigint, version bigint, n_words bigint, whole string, name array<bigint>, begin array<int>, end array<int>, times array<int>"
    scanned = materialise(rows.mapInArrow(scan, kinds), "recompressed")
    entries = scanned.select("doc_id", "version", F.explode(F.arrays_zip("name", "begin", "end", "times")).alias("e")).select("doc_id", "version", "e.*")
    counted = entries.groupBy("name").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("rows")).filter("n > 1")
    counted = materialise(counted, "shared-symbols")
    total = int(scanned.agg(F.coalesce(F.sum(F.size("name")), F.lit(0))).first()[0])
    shared = with_heavy_keys(entries.drop("times"), counted.drop("n"), ["name"], "rows", total)
    ranges = shared.groupBy("doc_id", "version").agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))  # at most one a word of the text

    # Texts with the same words throughout repeat as a whole: one of them stands for all, counted twice.
    groups = scanned.filter(F.col("n_words") >= size).groupBy("whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "version")).alias("first"))
    wholes = scanned.select("doc_id", "version", "whole")
    copies = with_heavy_keys(wholes, groups.filter("n > 1"), ["whole"], "n", wholes.count())
    first = F.struct("doc_id", "version").eqNullSafe(F.col("first"))
    copies = materialise(copies.select("doc_id", "version", first.alias("first")).distinct(), "copies")
    same = ranges["doc_id"].eqNullSafe(copies["doc_id"]) & (ranges["version"] == copies["version"])
    ranges = ranges.join(copies, same, "left").filter(F.coalesce("first", F.lit(True))).select(
        ranges["doc_id"], ranges["version"], "ranges", F.when(F.col("first"), 2).otherwise(1).alias("weight")
    )
    same = rows["doc_id"].eqNullSafe(ranges["doc_id"]) & (rows["version"] == ranges["version"])
    texts = materialise(rows.join(ranges, same).select(rows["doc_id"], rows["version"], "text", "ranges", "weight"), "candidates")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = words_of(batch.column("text"))
            found = batch.column("ranges")
            doc = _owners(found)
            values = found.flatten()
            begin, end = values.field("begin").to_numpy() + words.first[doc], values.field("end").to_numpy() + words.first[doc]
            marks = np.zeros(len(words.names) + 1, dtype=np.int64)
            np.add.at(marks, begin, 1)
            np.add.at(marks, end + 1, -1)
            at = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
            bounds = np.searchsorted(at, words.first)
            name, check = Spans(words.names)(at, at + size), Spans(words.names, 1)(at, at + size)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"), "version": batch.column("version"), "weight": batch.column("weight"), "name": _lists(name.astype(np.int64), bounds, pa.int64()),
                    "check": _lists((check >> np.uint64(32)).astype(np.uint32).view(np.int32), bounds, pa.int32()),
                    "at": _lists(at - np.repeat(words.first[:-1], np.diff(bounds)), bounds, pa.int32()),
                }
            )

    spelled = texts.mapInArrow(spell, "doc_id bigint, version bigint, weight int, name array<bigint>, check array<int>, at array<int>")
    entry = F.explode(F.arrays_zip("name", "check", "at")).alias("e")
    windows = spelled.select("weight", entry).select("weight", "e.name", "e.check")
    repeated = materialise(windows.groupBy("name", "check").agg(F.sum("weight").alias("n")).filter("n > 1"), "windows")
    total = int(repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    windows = spelled.filter("weight = 1").select("doc_id", "version", entry).select("doc_id", "version", "e.*")
    met = with_heavy_keys(windows, repeated, ["name", "check"], "n", total)
    starts = met.groupBy("doc_id", "version").agg(F.collect_set("at").alias("starts"))  # at most one a word of the text
    own = texts.filter("weight = 1").select("doc_id", "version", "text").dropDuplicates(["doc_id", "version"])
    same = own["doc_id"].eqNullSafe(starts["doc_id"]) & (own["version"] == starts["version"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = words_of(batch.column("text"))
            found = batch.column("starts")
            at = found.flatten().to_numpy() + words.first[_owners(found)]
            marks = np.zeros(len(words.names) + 1, dtype=np.int64)
            np.add.at(marks, at, 1)
            np.add.at(marks, at + size, -1)
            kept = np.cumsum(marks)[:-1] == 0
            data, first = words.data.tobytes(), words.first
            places = [first[d] + np.flatnonzero(kept[first[d] : first[d + 1]]) for d in range(batch.num_rows)]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"), "version": batch.column("version"),
                    "n_removed": pa.array(np.diff(first) - np.array([len(p) for p in places], dtype=np.int64)),
                    "kept": pa.array([_joined_digest(data, words, p) for p in places]),
                }
            )

    removed = own.join(starts, same).select(own["doc_id"], own["version"], "text", "starts").mapInArrow(cut, "doc_id bigint, version bigint, n_removed bigint, kept string")
    removed = removed.withColumn("copied", F.lit(False)).unionByName(
        copies.select("doc_id", "version", F.lit(None).cast("bigint").alias("n_removed"), F.sha2(F.lit(""), 256).alias("kept"), F.lit(True).alias("copied"))
    )
    same = scanned["doc_id"].eqNullSafe(removed["doc_id"]) & (scanned["version"] == removed["version"])
    lost = F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    return scanned.join(removed, same, "left").select(scanned["doc_id"], "n_words", lost.alias("n_removed"), F.coalesce("kept", "whole").alias("kept_sha256"))
