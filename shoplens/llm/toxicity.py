"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its lower-cased words, its pairs of neighbouring words and its pairs with one word between, each kind
hashed into a space of its own. Every coordinate keeps the two sums of FTRL-proximal: the adjusted gradients, which give the
weight behind an L1 threshold, and the squared gradients, which set its own rate. The labelled rows are dealt into
``SHARDS`` shards; in each epoch every shard runs over its rows from the common state, and a coordinate moves by the mean of
the shards that met it. Few weights are left and are sent to all executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.columns import labelled_sample
from shoplens.llm.words import Words, mixed, pieces, words_of
from shoplens.operators.scale import materialise

WORD_BITS, PAIR_BITS = 20, 19
COORDINATES = 1 + (1 << WORD_BITS) + 2 * (1 << PAIR_BITS)  # the first one is the constant
LABELLED = 16_000
SHARDS, EPOCHS = 4, 4
PART = 1 << 17  # coordinates sent back in one row
RATE, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.0
POSITIVE = 2.0  # weight of rows with label 1


def streams(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text and coordinate of every word, of every pair of neighbours and of every pair with one word between."""
    doc, names = words.doc, words.names
    yield doc, 1 + (names >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    base = 1 + (1 << WORD_BITS)
    for gap in (1, 2):
        if len(names) > gap:
            same = doc[gap:] == doc[:-gap]
            with np.errstate(over="ignore"):
                pair = mixed(names[:-gap][same] * np.uint64(3) + np.uint64(gap)) + names[gap:][same]
                yield doc[gap:][same], base + (mixed(pair) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        base += 1 << PAIR_BITS


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates of each text in ascending order, and where those of each text begin; the constant comes first."""
    rows = len(texts)
    keys = [np.arange(rows, dtype=np.int64) << 32] + [doc << 32 | place for doc, place in streams(words_of(texts, lower=True))]
    keys = np.unique(np.concatenate(keys))
    return (keys & 0xFFFFFFFF).astype(np.int32), np.searchsorted(keys >> 32, np.arange(rows + 1))


def weight(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / RATE + L2))


def learn(z: np.ndarray, n: np.ndarray, places: np.ndarray, label: float) -> None:
    """One FTRL-proximal step on one row."""
    zs, ns = z[places], n[places]
    w = weight(zs, ns)
    gradient = (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label) * (POSITIVE if label else 1.0)
    grown = ns + gradient * gradient
    z[places] = zs + gradient - (np.sqrt(grown) - np.sqrt(ns)) / RATE * w
    n[places] = grown


@dataclass(frozen=True)
class Model:
    places: np.ndarray  # coordinates with a weight, ascending
    weights: np.ndarray

    def scores(self, texts: pa.Array, table: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each text; ``table`` holds the weights of all coordinates."""
        keys = [np.arange(len(texts), dtype=np.int64) << 32]
        for doc, place in streams(words_of(texts, lower=True)):
            weighs = table[place] != 0
            keys.append(doc[weighs] << 32 | place[weighs])
        keys = np.unique(np.concatenate(keys))
        total = np.bincount(keys >> 32, weights=table[keys & 0xFFFFFFFF], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def table(self) -> np.ndarray:
        out = np.zeros(COORDINATES)
        out[self.places] = self.weights
        return out


def _epoch(rows: DataFrame, z: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State after every shard has run over its rows. Each shard sends back what it moved, at most one number a coordinate."""
    state = rows.sparkSession.sparkContext.broadcast((z, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, None

        def moved() -> Iterator[pa.RecordBatch]:
            every = np.flatnonzero(own[1] != state.value[1])
            for at in range(0, len(every), PART):
                places = every[at : at + PART]
                parts = [places.astype(np.int32)] + [(a[places] - b[places]).astype(np.float32) for a, b in zip(own, state.value, strict=True)]
                yield pa.record_batch({k: pa.array([v.tobytes()], pa.binary()) for k, v in zip(("places", "z", "n"), parts, strict=True)})

        for batch in batches:
            shards, labels, lists = (batch.column(i) for i in range(3))
            bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i, (shard, label) in enumerate(zip(shards.to_pylist(), labels.to_pylist(), strict=True)):
                if shard != now:
                    if own is not None:
                        yield from moved()
                    now, own = shard, [a.astype(np.float64) for a in state.value]
                learn(own[0], own[1], flat[bounds[i] : bounds[i + 1]], label)
        if own is not None:
            yield from moved()

    dz, dn, met = np.zeros_like(z), np.zeros_like(z), np.zeros_like(z)
    for row in rows.mapInArrow(run, "places binary, z binary, n binary").toLocalIterator():  # at most SHARDS x COORDINATES numbers, a part at a time
        places = np.frombuffer(row.places, dtype=np.int32)
        dz[places] += np.frombuffer(row.z, dtype=np.float32)
        dn[places] += np.frombuffer(row.n, dtype=np.float32)
        met[places] += 1
    state.destroy()
    np.maximum(met, 1, out=met)
    dz /= met
    dn /= met
    dz += z
    dn += n
    return dz, dn


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from rows (doc_id, text) and the labels (doc_id, label) to learn from.

    Learns from at most ``LABELLED`` labelled rows, see ``labelled_sample``; whole texts, whatever their length, and the state
    of ``COORDINATES`` numbers bound what moves. Rows are taken in the order of their digest, so ties are settled. Without
    labelled rows no coordinate has a weight and every score is one half.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            flat, bounds = features(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
            yield pa.record_batch({"shard": batch.column("shard"), "label": batch.column("label"), "places": lists})

    sample = labelled_sample(docs, labels, LABELLED).withColumn("shard", F.pmod("draw", F.lit(SHARDS)).cast("int"))
    dealt = sample.repartitionByRange(SHARDS, "shard").sortWithinPartitions("shard", "draw", "doc_id", "label").select("shard", "label", "text")
    rows = materialise(dealt.mapInArrow(hashed, "shard int, label double, places array<int>"), "toxic-features")
    z = n = np.zeros(COORDINATES, dtype=np.float32)
    for _ in range(EPOCHS):
        z, n = _epoch(rows, z, n)
    found = weight(z.astype(np.float64), n.astype(np.float64))
    places = np.flatnonzero(found)
    return Model(places.astype(np.int32), found[places])


def classify(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", cut: float = 0.5) -> DataFrame:
    """Score and class of each row: doc_id, score (0 to 1, higher: label 1 likelier), predicted (1 from ``cut`` on).

    Whole texts are scored. Null, empty and blank texts have the constant alone and share one score. Each row is judged for
    itself, repeated rows alike; other columns are not read; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        table = own.table()
        for batch in pieces(batches, "text"):
            score = np.round(own.scores(batch.column("text"), table), 6)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(score, pa.float64()), "predicted": pa.array((score >= cut).astype(np.int32))})

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(judge, "doc_id bigint, score double, predicted int")
