"""Language identification by nearest centroid.

Texts become unit TF-IDF vectors of hashed byte n-grams. Each language has several centroids from spherical
k-means over its texts. A text takes the language of the centroid with the largest cosine, and is rejected when
it is farther from it than any plausible text of the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shoplens.llm.words import DENSE_ROWS, byte_grams, counted, pieces, text_bytes
from shoplens.operators.scale import materialise

DIMENSIONS = 4096
ORDERS = (1, 2, 3)
PER_LANGUAGE = 1500
CENTROIDS = 4
ROUNDS = 8
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)


def term_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed byte n-grams, one row per text; letters lower-cased, all other ASCII as blank."""
    data, bounds = text_bytes(texts)
    streams = byte_grams(_FOLD[data], bounds, ORDERS, DIMENSIONS)
    return counted(streams, len(texts), DIMENSIONS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of log-damped counts times idf; a text without terms stays zero."""
    vectors = np.log1p(counts) * idf
    length = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return vectors / np.maximum(length, 1e-12)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    owner: np.ndarray  # language number of each centroid
    centroids: np.ndarray
    least: np.ndarray  # smallest cosine accepted by each language
    idf: np.ndarray


def _inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all rows: one row of counts per task, summed by term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in pieces(batches, "text", rows=DENSE_ROWS):
            seen += (term_counts(batch.column("text")) > 0).sum(0)
            rows += batch.num_rows
        yield pa.record_batch({"term": pa.array(np.arange(-1, DIMENSIONS)), "n": pa.array(np.concatenate([[rows], seen]))})

    found = texts.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()  # DIMENSIONS + 1 rows
    n = np.zeros(DIMENSIONS + 1)
    for row in found:
        n[row.term + 1] = row.n
    return (np.log((1 + n[0]) / (1 + n[1:])) + 1).astype(np.float32)


def _clusters(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means with far-apart starts; deterministic."""
    centres = [vectors.mean(0)]
    while len(centres) < min(CENTROIDS, len(vectors)):
        near = (vectors @ np.array(centres).T).max(1)
        centres.append(vectors[int(near.argmin())])
    found = np.array(centres)
    for _ in range(ROUNDS):
        found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        owner = (vectors @ found.T).argmax(1)
        found = np.array([vectors[owner == k].mean(0) if (owner == k).any() else found[k] for k in range(len(found))])
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)


def fit(labelled: DataFrame, margin: float = 0.3) -> Model:
    """Model from rows (doc_id, text, lang).

    Inverse document frequencies count all rows. The centroids of a language are fitted on at most ``PER_LANGUAGE`` of its
    rows, those with the smallest digest of id and text, one task per language; rows equal in both count once, so neither a
    repeated nor a null id exceeds the bound. A language accepts cosines down to ``margin`` times the smallest among these
    rows. Rows with null language or without letters teach nothing.
    """
    labelled = labelled.filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    idf = _inverse_frequencies(labelled.select("text"))
    drawn = labelled.withColumn("draw", F.xxhash64("doc_id", "text")).select("lang", "draw", "text")
    known = materialise(drawn.select("lang", "draw").distinct(), "language-draws")
    # digests are spread evenly: the cut leaves a little over ``PER_LANGUAGE`` rows of a language to be ranked
    share = F.lit(PER_LANGUAGE + 6 * PER_LANGUAGE**0.5) / F.count(F.lit(1))
    cuts = known.groupBy("lang").agg((share * 2.0**64 - 2.0**63).alias("cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    few = known.join(F.broadcast(cuts), "lang").filter(F.col("draw") <= F.col("cut")).withColumn("rank", rank).filter(F.col("rank") <= PER_LANGUAGE)
    picked = drawn.join(F.broadcast(few.select("lang", "draw")), ["lang", "draw"]).groupBy("lang", "draw").agg(F.first("text").alias("text"))

    def cluster(table: pa.Table) -> pa.Table:
        batches = pieces(iter(table.combine_chunks().to_batches()), "text", rows=DENSE_ROWS)
        vectors = np.concatenate([weighted(term_counts(b.column("text")), idf) for b in batches])
        found = _clusters(vectors)
        least = float((vectors @ found.T).max(1).min()) * margin
        lang = table.column("lang")[0].as_py()
        return pa.table({"lang": [lang] * len(found), "least": [least] * len(found), "centre": pa.array([c.tolist() for c in found], pa.list_(pa.float32()))})

    rows = picked.select("lang", "text").groupBy("lang").applyInArrow(cluster, "lang string, least double, centre array<float>").collect()
    languages = sorted({r.lang for r in rows})
    rows.sort(key=lambda r: (r.lang, r.centre))
    return Model(
        languages,
        np.array([languages.index(r.lang) for r in rows], dtype=np.int64),
        np.array([r.centre for r in rows], dtype=np.float32).reshape(len(rows), DIMENSIONS),
        np.array([next(r.least for r in rows if r.lang == x) for x in languages]),
        idf,
    )


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Language of each row: doc_id, lang (nearest), score (its cosine, 0 to 1), rejected.

    Texts that are null or have no letter get ``und``, score 0 and are rejected, as is everything when the model
    knows no language. A text whose cosine is under the least of its language is rejected but keeps its nearest language. Equal
    cosines go to the first language by name. Each row is judged for itself; other columns are not read.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], dtype=object)
        for batch in pieces(batches, "text", rows=DENSE_ROWS):
            lettered = np.asarray(batch.column("lettered").to_numpy(zero_copy_only=False), dtype=bool)
            best, score = np.full(batch.num_rows, len(model.languages)), np.zeros(batch.num_rows)
            rejected = np.ones(batch.num_rows, dtype=bool)
            if len(model.languages) and lettered.any():
                near = weighted(term_counts(batch.column("text")), model.idf) @ model.centroids.T
                centre = near.argmax(1)
                best = np.where(lettered, model.owner[centre], best)
                score = np.where(lettered, np.clip(near.max(1), 0, 1), 0)
                rejected = ~lettered | (near.max(1) < model.least[model.owner[centre]])
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "lang": pa.array(names[best], pa.string()), "score": pa.array(score, pa.float64()), "rejected": pa.array(rejected)})

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"), has_letter(F.col(text)).alias("lettered"))
    return rows.mapInArrow(judge, "doc_id bigint, lang string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text ``identify`` does not reject; one pass without a join."""
    flag = next(n for n in (f"lettered_{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, rows=DENSE_ROWS):
            keep = np.asarray(batch.column(flag).to_numpy(zero_copy_only=False), dtype=bool)
            if len(model.languages) and keep.any():
                near = weighted(term_counts(batch.column(text)), model.idf) @ model.centroids.T
                keep = keep & (near.max(1) >= model.least[model.owner[near.argmax(1)]])
            yield batch.drop_columns([flag]).filter(pa.array(keep & bool(model.languages)))

    return docs.withColumn(flag, has_letter(F.col(text))).mapInArrow(judge, docs.schema)
