"""SentencePiece encoding and decoding by forward passes over a trie of marked words.

A text is cut before each run of marks (the blank's stand-in) and around line ends, where no piece of the model crosses. The distinct marked
words of a task are sorted, which makes them a trie in depth-first order: a word takes over the forward states of the
prefix it shares with the word before and extends them character by character. The state of a prefix is the last piece of
its best segmentation and that segmentation's score.

For a BPE model a plain best-sum path gives other pieces than the merges do. There a piece may end a prefix only if the
merges would leave it apart from the piece before it, which makes the state of each prefix unique and the path equal to the
merge result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.words import pieces

MARK = "▁"
IDS = "i"  # four bytes an id
KEPT_WORDS = 200_000
KEPT_CHECKS = 1 << 18


class Pieces:
    """Pieces of a model file: their ids, scores and merges."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        n = self.processor.vocab_size()
        special = [self.processor.is_byte(i) or self.processor.is_control(i) or self.processor.is_unknown(i) or self.processor.is_unused(i) for i in range(n)]
        self.ids = {self.processor.id_to_piece(i): i for i in range(n) if not special[i]}
        self.scores = {p: self.processor.get_score(i) for p, i in self.ids.items()}
        self.bytes = [self.processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.whole = {p for p in self.ids if len(p) > 1 and self.merged(p) == [p]}  # what the merges make of their own letters
        self.sizes = self._sizes()
        self.first = self.processor.bos_id()
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a mark behind another character: texts can't be cut at marks")
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in self.ids))  # in no piece: a cut on both sides is exact
        self.words = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|[{alone}]" if alone else "")).findall
        probe = "  a  B\n\tc\u00a0\u00e9e\u0301\ufb01\u2460 "
        self.plain = self.processor.normalize(probe) == MARK + probe.replace(" ", MARK)
        self.apart = lru_cache(KEPT_CHECKS)(self._apart)  # beside the pieces themselves all that a worker keeps between tasks

    def _sizes(self) -> dict[str, tuple[int, ...]]:
        """Lengths of the pieces that end in the given last characters (three, or two for pieces no longer), longest first."""
        ends: dict[str, set[int]] = {}
        for piece in self.whole:
            if len(piece) > 2:
                ends.setdefault(piece[-3:], set()).add(len(piece))
        pairs = {p: (2, 1) for p in self.whole if len(p) == 2}
        return pairs | {end: (*sorted(found, reverse=True), *pairs.get(end[1:], (1,))) for end, found in ends.items()}

    def marked(self, text: str) -> str:
        """The text as the model sees it: blanks as marks and one more in front; other models normalise further."""
        if not text:
            return ""
        return MARK + text.replace(" ", MARK) if self.plain else self.processor.normalize(text)

    def merged(self, text: str) -> list[str]:
        """Pieces left when the best-scored neighbours merge until none can; the leftmost of equal ones first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _apart(self, left: str, right: str) -> bool:
        return self.merged(left + right) == [left, right]


class Trie:
    """Depth-first walk over sorted words: the forward states of the current path, reused up to the shared prefix."""

    def __init__(self, model: Pieces) -> None:
        self.model, self.word, self.last = model, "", [None]

    def encode(self, word: str) -> list[int]:
        model, last, old = self.model, self.last, self.word
        sizes, whole, apart = model.sizes.get, model.whole, model.apart
        shared, most = 0, min(len(old), len(word))
        while shared < most and old[shared] == word[shared]:
            shared += 1
        del last[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            state = None
            for size in end > 2 and sizes(word[end - 3 : end]) or end > 1 and sizes(word[end - 2 : end]) or (1,):
                if size > end:
                    continue
                piece = word[end - size : end]
                if size > 1 and piece not in whole:
                    continue
                if size == end or apart(last[end - size], piece):
                    state = piece
                    break
            last.append(state)
        self.word = word
        out, end = [], len(word)
        while end:
            piece = last[end]
            known = model.ids.get(piece)
            out.extend([known] if known is not None else [model.bytes[b] for b in reversed(piece.encode())])
            end -= len(piece)
        return out[::-1]


@lru_cache(2)
def _loaded(path: str) -> Pieces:
    return Pieces(path)


def _encoder(path: str):
    """Function from texts to the bytes of their ids (``IDS``), for use inside a task; null stays null."""
    model, recent, older = _loaded(path), {}, {}

    def encoded(texts: list[str | None]) -> list[bytes | None]:
        nonlocal recent, older
        parts = [model.words(model.marked(t or "")) for t in texts]
        if len(recent) > KEPT_WORDS:
            recent, older = {}, recent
        trie = Trie(model)
        for word in sorted(set().union(*parts).difference(recent)):
            recent[word] = older[word] if word in older else array(IDS, trie.encode(word)).tobytes()
        return [None if t is None else b"".join([recent[w] for w in p]) for t, p in zip(texts, parts, strict=True)]

    return encoded


def _lists(rows: list[bytes | None]) -> pa.Array:
    """Lists of ids from their bytes."""
    bounds = np.cumsum([0] + [len(r or b"") // 4 for r in rows])
    flat = pa.array(np.frombuffer(b"".join([r or b"" for r in rows]), dtype=np.int32))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat, mask=pa.array([r is None for r in rows]))


def _decoder(path: str):
    """Function from lists of ids to texts, for use inside a task."""
    model = _loaded(path)
    spelled = [b""] * model.processor.vocab_size()
    for piece, i in model.ids.items():
        spelled[i] = piece.replace(MARK, " ").encode()
    for b, i in enumerate(model.bytes):
        spelled[i] = bytes([b])

    def decoded(rows: list[list[int] | None]) -> list[str | None]:
        joined = [None if r is None else b"".join([spelled[i] for i in r]) for r in rows]
        return [None if t is None else t.decode("utf-8", "replace").removeprefix(" ") for t in joined]

    return decoded


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each row's text by the model file at ``path`` (present on every executor): doc_id, ids.

    Ids are those of the SentencePiece library for the same model, without begin and end marks. A null text gives null, an
    empty one no ids. Repeated rows are encoded alike; other columns are not read. A task keeps the latest
    ``KEPT_WORDS`` or so encoded words between batches, which changes no result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = _encoder(path)
        for batch in pieces(batches, "text"):
            ids = encoded(batch.column("text").to_pylist())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": _lists(ids)})

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(rows: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Text of each row's ids: doc_id, text. Byte pieces join to characters, marks turn into blanks and the leading
    blank that encoding adds goes. Null stays null, no ids give the empty text. A mark in the original text comes back as a
    blank: the model does not tell them apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded = _decoder(path)
        for batch in batches:
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(decoded(batch.column("ids").to_pylist()), pa.string())})

    return rows.select(F.col(id).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each row and decode its ids again: doc_id, ids, n_ids, same (the decoded text is the text).

    Rows are treated as in ``encode`` and ``decode``; a null text has null ids, 0 of them, and same is true.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, decoded = _encoder(path), _decoder(path)
        for batch in pieces(batches, "text"):
            texts = batch.column("text").to_pylist()
            ids = encoded(texts)
            same = [a == b for a, b in zip(texts, decoded([None if r is None else memoryview(r).cast(IDS) for r in ids]), strict=True)]
            counts = pa.array([len(r or b"") // 4 for r in ids], pa.int64())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": _lists(ids), "n_ids": counts, "same": pa.array(same, pa.bool_())})

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, n_ids bigint, same boolean")
