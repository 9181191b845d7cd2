"""Quality by nearest-neighbour voting among labelled texts in a latent-semantic space.

Texts become TF-IDF vectors of hashed shape n-grams (letters by case, digits alike, all other bytes as they are) and of
repeated words, projected on the leading singular vectors of the labelled sample. Every text is compared with every
labelled vector, block by block, and its nearest ones vote with weights from their cosines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.columns import labelled_sample
from shoplens.llm.words import DENSE_ROWS, byte_grams, counted, pieces, words_of

DIMENSIONS = 2048
ORDERS = (1, 2, 3)
LATENT = 48
LABELLED = 6000
NEIGHBOURS = 31
SHARPNESS = 4
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_REPEATS = 3


def term_weights(texts: pa.Array) -> np.ndarray:
    """Root of each term's share in its text, one row per text; zero rows for texts without words.

    The last ``_REPEATS`` terms count words equal to the one 1, 2 or 3 places before.
    """
    words = words_of(texts)
    space = DIMENSIONS - _REPEATS
    streams = byte_grams(_SHAPE[words.data], words.bounds, ORDERS, space)
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    out[:, :space] = counted(streams, len(texts), space)
    total = np.maximum(1, np.diff(words.bounds))[:, None]
    out[:, :space] /= total
    doc, n = words.doc, np.maximum(1, np.diff(words.first))
    for back in range(1, _REPEATS + 1):
        same = (words.names[back:] == words.names[:-back]) & (doc[back:] == doc[:-back])
        out[:, space + back - 1] = np.bincount(doc[back:][same], minlength=len(texts)) / n
    out[np.diff(words.first) == 0] = 0
    return np.sqrt(out)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    basis: np.ndarray  # DIMENSIONS x LATENT
    vectors: np.ndarray  # labelled, unit length
    labels: np.ndarray
    prior: float  # share of label 1

    def latent(self, texts: pa.Array) -> np.ndarray:
        found = (term_weights(texts) * self.idf) @ self.basis
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)

    def vote(self, latent: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by cosine to the power ``SHARPNESS``."""
        if not len(self.labels):
            return np.full(len(latent), self.prior)
        near = np.clip(latent @ self.vectors.T, 0, None)
        k = min(NEIGHBOURS, near.shape[1])
        last = np.partition(near, -k, axis=1)[:, -k]  # all that tie with the last neighbour vote
        weight = np.where(near >= last[:, None], near, 0) ** SHARPNESS
        mass = weight.sum(1)
        return np.where(mass > 1e-9, weight @ self.labels / np.maximum(mass, 1e-9), self.prior)


def _inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all rows: one row of counts per task, summed by term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in pieces(batches, "text", rows=DENSE_ROWS):
            seen += (term_weights(batch.column("text")) > 0).sum(0)
            rows += batch.num_rows
        yield pa.record_batch({"term": pa.array(np.arange(-1, DIMENSIONS)), "n": pa.array(np.concatenate([[rows], seen]))})

    n = np.zeros(DIMENSIONS + 1)
    for row in texts.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():  # DIMENSIONS + 1 rows
        n[row.term + 1] = row.n
    return (np.log((1 + n[0]) / (1 + n[1:])) + 0.1).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from rows (doc_id, text) and the labels (doc_id, label) to learn from.

    Inverse document frequencies count all texts. The latent space and the voters come from at most ``LABELLED``
    labelled rows, see ``labelled_sample``, which bounds what is sent to the executors and back, however many rows share an id.
    Texts with two labels vote with both, null labels teach nothing. Without labelled texts every score is one half.
    """
    idf = _inverse_frequencies(docs.select("text"))
    sample = labelled_sample(docs.select("doc_id", "text"), labels, LABELLED)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", rows=DENSE_ROWS):
            rows = (term_weights(batch.column("text")) * idf).astype(np.float32)
            yield pa.record_batch({"draw": batch.column("draw"), "doc_id": batch.column("doc_id"), "label": batch.column("label"), "terms": pa.array([r.tobytes() for r in rows], pa.binary())})

    rows = sample.select("draw", "doc_id", "label", "text").mapInArrow(weigh, "draw bigint, doc_id bigint, label double, terms binary").toArrow()
    rows = rows.sort_by([("draw", "ascending"), ("doc_id", "ascending"), ("label", "ascending")])
    labels = rows.column("label").to_numpy()
    if not len(labels):
        return Model(idf, np.zeros((DIMENSIONS, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    terms = np.stack([np.frombuffer(r.as_py(), dtype=np.float32) for r in rows.column("terms")])
    _, vectors = np.linalg.eigh(terms.T @ terms)
    basis = np.ascontiguousarray(vectors[:, ::-1][:, :LATENT]).astype(np.float32)
    latent = terms @ basis
    return Model(idf, basis, latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12), labels, float(labels.mean()))


def classify(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", cut: float = 0.3) -> DataFrame:
    """Score and class of each row: doc_id, score (0 to 1, higher: label 1 likelier), predicted (1 from ``cut`` on).

    The voters (at most ``LABELLED`` x ``LATENT`` numbers) are sent to the executors once. Null, empty and blank texts have no
    direction and get the share of label 1. Each row is judged for itself; other columns are not read.
    """
    voters = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = voters.value
        for batch in pieces(batches, "text", rows=DENSE_ROWS):
            score = np.clip(np.round(own.vote(own.latent(batch.column("text"))), 6), 0, 1)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(score, pa.float64()), "predicted": pa.array((score >= cut).astype(np.int32))})

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(judge, "doc_id bigint, score double, predicted int")
