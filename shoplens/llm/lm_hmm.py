"""Hidden Markov language model: words come from latent states that follow one another.

A state emits word classes: each of the most frequent words is a class of its own, all others share classes by their
digest, and the end of a text is a class. Within a class a word has its smoothed share of the training counts, so every
word, seen or not, has a probability. Baum-Welch rounds sum expected counts over all partitions of the training texts;
texts are scored by the scaled forward recursion over their whole length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.words import pieces, words_of
from shoplens.operators.scale import materialise

STATES = 8
OWN_CLASS = 4096
SHARED_CLASSES = 256
END = OWN_CLASS + SHARED_CLASSES
CLASSES = END + 1
BROADCAST_WORDS = 200_000
ROUNDS = 17
BATCH_TOKENS = 1 << 20
RESCALE = 8
CHUNK = 1 << 13
PRIOR = 0.01


@dataclass(frozen=True)
class Vocabulary:
    """Training counts: those of the most frequent words by digest, and what all others need."""

    names: np.ndarray  # digests of the BROADCAST_WORDS most frequent words, sorted
    counts: np.ndarray
    classes: np.ndarray
    shared: np.ndarray  # log10 of the mass of each shared class, an unseen word included
    end: int
    tokens: int
    distinct: int


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # CLASSES x STATES


def _shared_class(names: np.ndarray) -> np.ndarray:
    return OWN_CLASS + (names >> np.uint64(17)).astype(np.int64) % SHARED_CLASSES


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over rows with a column text; the end of each text is counted under the empty word."""
    plain = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz" + 5 * " ")
    words = texts.select(F.explode(F.split(plain, " ")).alias("word")).filter("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.unionByName(texts.agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(F.lit("").alias("word"), "n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """What tasks need of the counts table, bounded whatever its size."""

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "word"):
            own = words_of(pa.array(batch.column("word")))
            mass = np.bincount(_shared_class(own.names), weights=batch.column("n").to_numpy() + 1.0, minlength=END)[OWN_CLASS:]
            yield pa.record_batch({"class": pa.array(np.arange(SHARED_CLASSES)), "mass": pa.array(mass)})

    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("word") == "", F.col("n"))), F.lit(0))).first()
    ranked = counts.filter("word != ''").orderBy(F.desc("n"), "word").limit(BROADCAST_WORDS).toArrow()
    own = words_of(ranked.column("word").combine_chunks())
    n = ranked.column("n").to_numpy()
    order = np.argsort(own.names)
    classes = np.where(np.arange(len(n)) < OWN_CLASS, np.arange(len(n)), _shared_class(own.names))
    mass = np.ones(SHARED_CLASSES)
    for row in counts.filter("word != ''").mapInArrow(masses, "class bigint, mass double").groupBy("class").agg(F.sum("mass").alias("mass")).collect():
        mass[row["class"]] += row.mass
    alone = classes < OWN_CLASS  # words with a class of their own are no part of a shared one
    mass -= np.bincount(_shared_class(own.names[alone]) - OWN_CLASS, weights=n[alone] + 1.0, minlength=SHARED_CLASSES)
    return Vocabulary(own.names[order], n[order], classes[order], np.log10(mass), int(totals[2]), int(totals[0]), int(totals[1]))


def coded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Classes of the words of rows (row, doc_id, held_out, text), written to the shared folder.

    ``codes`` has two bytes a token; ``base`` and ``within`` sum the log10 terms of broadcast words and classes,
    ``rare`` lists the words whose counts have to be joined.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vocab)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        logs = np.log10(own.counts + 1.0)
        for batch in pieces(batches, "text"):
            words = words_of(batch.column("text"), lower=True)
            at = np.searchsorted(own.names, words.names)
            at[at == len(own.names)] = 0
            known = own.names[at] == words.names if len(own.names) else np.zeros(len(at), dtype=bool)
            classes = np.where(known, own.classes[at], _shared_class(words.names)) if len(own.names) else _shared_class(words.names)
            term = np.where(known, logs[at], 0.0) if len(own.names) else np.zeros(len(at))
            shared = classes >= OWN_CLASS
            inner = np.where(shared, term - own.shared[np.where(shared, classes - OWN_CLASS, 0)], 0.0)
            doc, rows = words.doc, batch.num_rows
            sums = lambda x: np.bincount(doc, weights=x, minlength=rows)
            codes = classes.astype("<u2").tobytes()
            first = words.first
            rare = np.flatnonzero(~known)
            raw = words.data.tobytes()
            spelled = pa.array([raw[a:b] for a, b in zip(words.starts[rare].tolist(), words.ends[rare].tolist(), strict=True)], pa.binary()).cast(pa.string())
            offsets = pa.array(np.searchsorted(rare, first).astype(np.int32))
            yield pa.record_batch(
                {
                    "row": batch.column("row"), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                    "codes": pa.array([codes[2 * a : 2 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary()),
                    "n_tokens": pa.array(np.diff(first) + 1), "n_known": pa.array(sums(known).astype(np.int64) + (own.end > 0)),
                    "base": pa.array(sums(term) + np.log10(own.end + 1.0)), "within": pa.array(sums(inner)),
                    "rare": pa.ListArray.from_arrays(offsets, spelled),
                }
            )

    schema = "row bigint, doc_id bigint, held_out boolean, codes binary, n_tokens bigint, n_known bigint, base double, within double, rare array<string>"
    return materialise(docs.select("row", "doc_id", "held_out", "text").mapInArrow(code, schema), "coded")


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches of about BATCH_TOKENS with the class sequence of each text, its end included. Texts of like length are
    together, as a batch takes as many steps as its longest text has tokens."""
    for whole in batches:
        sizes = pc.binary_length(whole.column("codes")).to_numpy(zero_copy_only=False)
        for batch in pieces([whole.take(pa.array(np.argsort(-sizes, kind="stable")))], "codes", 2 * BATCH_TOKENS):
            yield batch, [np.append(np.frombuffer(c.as_buffer(), dtype="<u2"), np.uint16(END)) for c in batch.column("codes")]


def _timed(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts by falling length, tokens by time: codes, where each time begins, the lengths and the order of texts."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    flat = np.concatenate([sequences[i] for i in order])
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right")
    begin = np.concatenate([[0], np.cumsum(active)])
    text = np.arange(len(flat)) - np.repeat(begin[:-1], active)
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])[text] + np.repeat(np.arange(lengths[0]), active)
    return flat[at].astype(np.int64), begin, lengths, order


def _relative(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Emissions of each class against its likeliest state, and the log of that state's.

    A step then lowers the states' sum only by as much as moves and emissions differ between states. ``PRIOR`` keeps both
    above 1e-13 over 1e11 tokens: eight steps stay above 1e-208, one step above 1e-26.
    """
    peak = model.emit.max(1)
    return model.emit / peak[:, None], np.log(peak)


def forward(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each sequence by the recursion, scaled every ``RESCALE`` steps."""
    codes, begin, lengths, order = _timed(sequences)
    emit, peak = _relative(model)
    likelihood, last, now = np.zeros(len(sequences)), np.zeros(len(sequences)), None
    for t in range(len(begin) - 1):
        here = codes[begin[t] : begin[t + 1]]
        n, seen = len(here), emit.take(here, 0)
        likelihood[:n] += peak.take(here)
        now = seen * model.start if t == 0 else (now[:n] @ model.move) * seen
        ended = int(np.searchsorted(-lengths, -t - 1))  # texts from here on end at this time
        if ended < n:
            last[ended:n] = now[ended:n].sum(1)
        if t % RESCALE == RESCALE - 1:
            scale = now @ np.ones(STATES)
            now /= scale[:, None]
            likelihood[:ended] += np.log(scale[:ended])
    out = np.empty(len(sequences))
    out[order] = likelihood + np.log(last)
    return out


def expected(model: Model, sequences: list[np.ndarray], room: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """Expected counts of starts, moves and emissions, and the log-likelihood, in one vector.

    States are held in single precision, scaled at each step, and summed in double precision. ``room`` keeps the space for
    them from call to call.
    """
    codes, begin, lengths, _ = _timed(sequences)
    emit, peak = _relative(model)
    start, move, emit = model.start.astype(np.float32), model.move.astype(np.float32), emit.astype(np.float32)
    back, ones = np.ascontiguousarray(move.T), np.ones((STATES, STATES), dtype=np.float32)  # a product with ``ones`` is the sum, at each state
    room = {} if room is None else room
    if len(room.get("states", ())) < 2 * len(codes):
        room["states"] = np.empty((2 * len(codes), STATES), dtype=np.float32)
    ahead, behind = room["states"][: len(codes)], room["states"][len(codes) : 2 * len(codes)]
    scales, bounds = np.empty(len(codes), dtype=np.float32), begin.tolist()
    seen, sums = np.empty((2, bounds[1], STATES), dtype=np.float32)
    before = None
    for t in range(len(bounds) - 1):
        a, b = bounds[t], bounds[t + 1]
        now, e, s = ahead[a:b], seen[: b - a], sums[: b - a]
        emit.take(codes[a:b], 0, e, "clip")
        if t == 0:
            np.multiply(e, start, now)
        else:
            np.dot(before[: b - a], move, now)
            np.multiply(now, e, now)
        np.dot(now, ones, s)
        np.divide(now, s, now)
        scales[a:b] = s[:, 0]
        before = now
    after = seen[:0]
    for t in range(len(bounds) - 2, -1, -1):
        a, b = bounds[t], bounds[t + 1]
        n, now, e = len(after), behind[a:b], seen[: b - a]
        if n:
            np.dot(after, back, now[:n])
            np.dot(now[:n], ones, sums[:n])
            np.divide(now[:n], sums[:n], now[:n])
        now[n:] = 1
        emit.take(codes[a:b], 0, e, "clip")
        np.multiply(e, now, e)
        after = e
    starts, moves, emissions = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, CLASSES))
    step = np.repeat(np.diff(begin)[:-1], np.diff(begin)[1:])  # so far back is the token before
    both, total = np.empty((2, max(CHUNK, bounds[1]), STATES), dtype=np.float32)
    for a in (0, *range(bounds[1], len(codes), CHUNK)):
        b = min(len(codes), a + CHUNK) if a else bounds[1]
        now, s = both[: b - a], total[: b - a]
        np.multiply(ahead[a:b], behind[a:b], now)
        np.dot(now, ones, s)
        np.divide(now, s, now)
        share = now.T.astype(np.float64)
        for k in range(STATES):
            emissions[k] += np.bincount(codes[a:b], weights=share[k], minlength=CLASSES)
        if a == 0:
            starts = share.sum(1)
            continue
        before = ahead.take(np.arange(a, b) - step[a - bounds[1] : b - bounds[1]], 0)
        np.dot(before, move, s)
        np.divide(now, s, now)
        moves += before.T @ now
    likelihood = np.log(scales).sum(dtype=np.float64) + peak[codes].sum()
    return np.concatenate([starts, (moves * model.move).ravel(), emissions.T.ravel(), [likelihood]])


def maximised(counts: np.ndarray) -> Model:
    """Model of expected counts, each smoothed by ``PRIOR``."""
    start = counts[:STATES] + PRIOR
    move = counts[STATES : STATES + STATES * STATES].reshape(STATES, STATES) + PRIOR
    emit = counts[STATES + STATES * STATES : -1].reshape(CLASSES, STATES) + PRIOR
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def train(codes: DataFrame) -> Model:
    """Baum-Welch over rows with a column codes.

    The start takes the class counts of all texts times fixed random factors. Each round counts over all texts, one vector of
    counts a task, summed entry by entry over the tasks. Their number is fixed at ``ROUNDS``.
    """
    size = STATES + STATES * STATES + CLASSES * STATES + 1

    def summed(count, entries: int) -> np.ndarray:
        """Sum over all tasks of a vector counted from sequences."""

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(entries)
            for _, part in _sequences(batches):
                total += count(part)
            at = np.flatnonzero(total)
            yield pa.record_batch({"at": pa.array(at), "n": pa.array(total[at])})

        found = codes.select("codes").mapInArrow(task, "at bigint, n double").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # at most ``entries`` rows
        total = np.zeros(entries)
        total[found.column("at").to_numpy()] = found.column("n").to_numpy()
        return total

    share = summed(lambda part: np.bincount(np.concatenate(part), minlength=CLASSES), CLASSES)
    random = np.random.default_rng(7)
    first = np.zeros(size)
    first[STATES : STATES + STATES * STATES] = (np.eye(STATES) * STATES * 9 + 1).ravel() * 100
    first[STATES + STATES * STATES : -1] = (share[:, None] * random.gamma(1.0, 1.0, (CLASSES, STATES))).ravel()
    model = maximised(first)
    for _ in range(ROUNDS):
        shipped = codes.sparkSession.sparkContext.broadcast(model)
        room: dict[str, np.ndarray] = {}  # sent empty, so each task has its own
        model = maximised(summed(lambda part, shipped=shipped, room=room: expected(shipped.value, part, room), size))
    return model


def score_texts(docs: DataFrame, held: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the rows that are not ``held`` (null: learnt from) and score all rows.

    A null text is empty: only its end counts. Repeated rows count as often as they occur, and each is scored. Other columns
    are not read; an empty table gives no rows. Without rows to learn from every count is 0 and the states stay as drawn.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed unigram) and score (the hidden Markov
    model), both log10 of the text's probability.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))
    learnt = ~F.coalesce("held_out", F.lit(False))
    counts = materialise(word_counts(rows.filter(learnt)), "word-counts")
    vocab = vocabulary(counts)
    codes = coded(rows.withColumn("row", F.monotonically_increasing_id()), vocab)
    model = train(codes.filter(learnt))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in _sequences(batches):
            plain = batch.drop_columns(["codes"])
            yield plain.append_column("states", pa.array(forward(shipped.value, part) / np.log(10)))

    plain = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "within"]
    kinds = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, within double"
    judged = codes.select(*plain, "codes").mapInArrow(judge, kinds + ", states double")
    found = codes.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("times")).join(counts, "word", "left")
    rare = found.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(F.lit(0))).alias("known")
    )
    more = F.coalesce("more", F.lit(0.0))
    return judged.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.log10(F.lit(float(vocab.tokens + vocab.distinct + 1)))).alias("base_score"),
        (F.col("states") + F.col("within") + more).alias("score"),
    )
