"""Cheapest repair of conversation structure by dynamic programming with checkpoints.

A repaired conversation has the role initials ``(s?(ua)+)?``. A row is kept (cost 0), given the role user or assistant (1) or
deleted (2, required for blank rows and duplicates); a user or assistant row without text may be inserted anywhere (5); a
truncated row that stays costs 5 more. Four states say what may follow: nothing yet, after a system row, after a user row,
after an assistant row. From each state only one role can be inserted or given, so the initials of the edits fix the repair.

The cost of finishing from each state is a vector of four numbers per row. A conversation of n rows is cut into segments of about the
root of n rows, and vectors are stored only where segments and blocks begin. A segment changes the vector behind it by a
4 x 4 table of costs, so the vectors at all segment ends follow from the tables alone. Walking forward recomputes the
vectors of one block at a time and takes, at each place, the ASCII-least edit that still reaches the cheapest cost. No task
holds more than a segment's rows, however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.columns import with_heavy_keys
from shoplens.operators.scale import global_positions, materialise

BLANK_CHARS = " \t\n\x0b\f\r"
SEGMENT = 256  # least rows of a segment; beyond the square of it a segment has the root of the conversation's rows
NO_ID = " "  # stands for a null id among ids written as text
FAR = 1 << 60
RENAME, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)  # the state a row of the only possible other role leads to
ROLE = {USER: "user", ASSISTANT: "assistant"}
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}  # places in "sua" of neighbouring initials
STAYS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}


def kind(code: str) -> tuple[int, int]:
    """Fault and initial (its place in "sua", else 3) of a row's letter."""
    return divmod(ord(code) - 65, 4)


def moves(code: str) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a row as (initial, cost, next state), in ASCII order."""
    fault, initial = kind(code)
    out = []
    for state in range(4):
        found = [("D", DELETE, state)]
        if fault in (FINE, TRUNCATED):
            extra = CUT_SHORT if fault == TRUNCATED else 0
            if (state, initial) in STAYS:
                found.append(("K", extra, STAYS[state, initial]))
            found.append(("R", RENAME + extra, FOLLOWS[state]))
        out.append(found)
    return out


MOVES = {chr(65 + i): moves(chr(65 + i)) for i in range(16)}


def with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs when rows may be inserted first; two of them reach every state."""
    for _ in range(2):
        costs = [min(FAR, c, INSERT + costs[FOLLOWS[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


END = with_inserts([0, FAR, FAR, 0])


class Steps:
    """Vector before a row from the one behind it. Vectors repeat up to a constant, so few are ever computed."""

    def __init__(self) -> None:
        self.known: dict = {}

    def before(self, code: str, behind: tuple[int, ...]) -> tuple[int, ...]:
        least = min(behind)
        rest = tuple(FAR if v >= FAR else v - least for v in behind)
        found = self.known.get((code, rest))
        if found is None:
            found = with_inserts([min(cost + rest[to] for _, cost, to in edits) for edits in MOVES[code]])
            self.known[code, rest] = found
        return tuple(FAR if v >= FAR else v + least for v in found)

    def through(self, codes: str, behind: tuple[int, ...]) -> tuple[int, ...]:
        for code in reversed(codes):
            behind = self.before(code, behind)
        return behind

    def table(self, codes: str) -> list[int]:
        """Cost from each state in front of the rows to each state behind them, row by row."""
        ends = [self.through(codes, tuple(0 if s == end else FAR for s in range(4))) for end in range(4)]
        return [ends[end][start] for start in range(4) for end in range(4)]

    def walk(self, codes: str, behind: tuple[int, ...], state: int) -> Iterator[tuple[int, str, int, int]]:
        """(row, edit, cost, state after it) of the cheapest edits from ``state`` on, the ASCII-least of equals.

        Vectors are stored at every block's end only, about root many, and those of one block are computed again.
        """
        size = isqrt(len(codes)) + 1
        stored = [behind]
        for at in range((len(codes) - 1) // size * size, 0, -size):
            stored.append(self.through(codes[at : at + size], stored[-1]))
        for at in range(0, len(codes), size):
            block = codes[at : at + size]
            vectors = [stored.pop()]
            for code in reversed(block):
                vectors.append(self.before(code, vectors[-1]))
            vectors.reverse()
            for i, code in enumerate(block):
                while True:
                    due, inserted = vectors[i][state], ("I", INSERT, FOLLOWS[state])
                    deleted, *others = MOVES[code][state]
                    if due == DELETE + vectors[i + 1][state]:
                        edit, cost, to = deleted
                    elif due == INSERT + vectors[i][FOLLOWS[state]]:
                        edit, cost, to = inserted
                    else:
                        edit, cost, to = next(e for e in others if due == e[1] + vectors[i + 1][e[2]])
                    state = to
                    yield at + i, edit, cost, state
                    if edit != "I":
                        break


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults put in by the digest of ``conv_id:turn``; nulls become one space.

    Of twenty digests 0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats
    the row, 4 makes its role user. The ids and turns returned stay null where they were.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    draw = F.crc32(F.concat_ws(":", shown[0], shown[1])) % 20
    rows = turns.select("conv_id", "turn", shown[2].alias("role"), shown[3].alias("text"), draw.alias("draw")).filter("draw != 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def _letter(fault: Column, role: Column) -> Column:
    initial = F.lit(3)
    for i, first in enumerate("sua"):
        initial = F.when(F.left(role, F.lit(1)) == first, i).otherwise(initial)
    return F.chr((65 + 4 * fault + initial).cast("long"))


def _segments(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per segment: conv, seg, segs (segments of its conversation), start (place of its first row), codes (a letter a row)."""
    firsts = rows.groupBy("conv", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(False).alias("again"))
    narrow = rows.select("place", "conv", "role", "last").join(firsts, "place", "left")
    fault = F.when(F.col("last") == "", BLANK).when(F.col("again").isNull(), DUPLICATE).when(F.col("last").isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    coded = narrow.select("conv", "place", _letter(fault, F.col("role")).alias("code"))
    sized = with_heavy_keys(coded, spans.select("conv", "n", "base"), ["conv"], "n", rows.count())
    size = F.greatest(F.lit(SEGMENT), F.ceil(F.sqrt("n"))).cast("long")
    placed = sized.select("conv", "place", "code", ((F.col("place") - F.col("base")) / size).cast("long").alias("seg"), ((F.col("n") - 1) / size + 1).cast("long").alias("segs"))
    held = placed.groupBy("conv", "seg", "segs").agg(F.min("place").alias("start"), F.sort_array(F.collect_list(F.struct("place", "code"))).alias("held"))
    return held.select("conv", "seg", "segs", "start", F.array_join(F.transform("held", lambda h: h["code"]), "").alias("codes"))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = Steps()
    for batch in batches:
        codes = batch.column("codes").to_pylist()
        tables = pa.array([steps.table(c) for c in codes], pa.list_(pa.int64()))
        edges = [pa.array([c[at] for c in codes], pa.string()) for at in (0, -1)]
        yield pa.record_batch({"conv": batch.column("conv"), "seg": batch.column("seg"), "costs": tables, "head": edges[0], "tail": edges[1]})


def _ends(table: pa.Table) -> pa.Table:
    """Vector behind each segment of one conversation, and whether the rows around its end are an illegal pair."""
    table = table.sort_by("seg")
    rows, behind, out = table.to_pylist(), END, []
    for i in range(len(rows) - 1, -1, -1):
        crossed = i + 1 < len(rows) and (kind(rows[i]["tail"])[1], kind(rows[i + 1]["head"])[1]) not in LEGAL
        out.append({"conv": rows[i]["conv"], "seg": rows[i]["seg"], "behind": list(behind), "crossed": int(crossed)})
        costs = rows[i]["costs"]
        behind = tuple(min(FAR, *(costs[4 * s + e] + behind[e] for e in range(4))) for s in range(4))
    return pa.Table.from_pylist(out, pa.schema({"conv": pa.string(), "seg": pa.int64(), "behind": pa.list_(pa.int64()), "crossed": pa.int64()}))


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = Steps()
    for batch in batches:
        out = []
        for codes, behind in zip(batch.column("codes").to_pylist(), batch.column("behind").to_pylist(), strict=True):
            exits = []
            for state in range(4):
                for _, _, _, state in steps.walk(codes, tuple(behind), state):
                    pass
                exits.append(state)
            out.append(exits)
        yield pa.record_batch({"conv": batch.column("conv"), "seg": batch.column("seg"), "exits": pa.array(out, pa.list_(pa.int64()))})


def _entries(table: pa.Table) -> pa.Table:
    """State in front of each segment of one conversation."""
    table, state, out = table.sort_by("seg"), START, []
    for exits in table.column("exits").to_pylist():
        out.append(state)
        state = exits[state]
    return pa.table({"conv": table.column("conv"), "seg": table.column("seg"), "entry": pa.array(out, pa.int64())})


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = Steps()
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            codes, state = row["codes"], row["entry"]
            audit, cost, edits, at, order = [], 0, [], -1, 0
            for i, edit, price, state in steps.walk(codes, tuple(row["behind"]), state):
                audit.append(edit)
                cost += price
                order, at = (order + 1 if i == at else 0), i
                if edit != "D":
                    edits.append({"place": row["start"] + i, "order": order, "edit": edit, "role": None if edit == "K" else ROLE[state]})
            while row["seg"] == row["segs"] - 1 and state in (SYSTEM, USER):  # rows inserted behind the last one
                state, cost, order = FOLLOWS[state], cost + INSERT, order + 1
                audit.append("I")
                edits.append({"place": row["start"] + at, "order": order, "edit": "I", "role": ROLE[state]})
            kinds = [kind(c) for c in codes]
            faults = [sum(f == wanted for f, _ in kinds) for wanted in (BLANK, DUPLICATE, TRUNCATED)]
            illegal = row["crossed"] + sum((a[1], b[1]) not in LEGAL for a, b in zip(kinds, kinds[1:]))
            out.append([row["conv"], row["seg"], *faults, illegal, cost, "".join(audit), edits])
        edit = pa.struct({"place": pa.int64(), "order": pa.int64(), "edit": pa.string(), "role": pa.string()})
        types = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.list_(edit)]
        names = ["conv", "seg", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "edits"]
        yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)


WALKED = (
    "conv string, seg bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "edits array<struct<place: bigint, order: bigint, edit: string, role: string>>"
)


@dataclass(frozen=True)
class Repair:
    reports: DataFrame  # conv, gaps, blank, duplicate, truncated, illegal, cost, audit: conversations that have rows
    rows: DataFrame  # conv, place, order, edit (K, R or I), role, text: the repaired rows, in the order of place and order


def repair(turns: DataFrame) -> Repair:
    """Faults and the cheapest repair of every conversation of ``turns`` (conv_id whole number, turn, role, text).

    Rows stand by turn, nulls first; rows of one turn by role and text, so equal rows are neighbours. The first fault counts:
    blank (no character but blanks), duplicate (role and text equal an earlier row's), truncated (the last character but blanks
    is none of ``.!?``). Null role or text counts as one space; a null id is a conversation of its own, named ``NO_ID`` in ``conv``;
    a role without a letter s, u or a in front fits nowhere. ``gaps`` is null where turns span more than a long. Columns beside
    the four are not read. An empty table gives empty results.
    """
    named = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(NO_ID)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("copy"),  # deals equal rows over sort partitions
    )
    marked = named.withColumn("digest", F.unhex(F.md5("text"))).withColumn("last", F.right(F.rtrim("text", F.lit(BLANK_CHARS)), F.lit(1)))
    rows = global_positions(marked, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")], "place")
    by_turn = rows.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("base"))
    numbers = F.col("turn").cast("decimal(20,0)")
    span = (F.max(numbers) - F.min(numbers) + 1 - F.count("turn")).try_cast("long")
    gaps = F.when(F.count("turn") == 0, F.lit(0)).otherwise(span).alias("gaps")
    spans = materialise(by_turn.groupBy("conv").agg(F.sum("n").alias("n"), F.min("base").alias("base"), gaps), "spans")
    segments = materialise(_segments(rows, spans), "segments")

    keys = ["conv", "seg"]
    long = segments.filter("segs > 1")
    tables = long.select(*keys, "codes").mapInArrow(_tables, "conv string, seg bigint, costs array<bigint>, head string, tail string")
    ends = materialise(tables.groupBy("conv").applyInArrow(_ends, "conv string, seg bigint, behind array<bigint>, crossed bigint"), "ends")
    ended = long.join(ends, keys)
    exits = ended.select(*keys, "codes", "behind").mapInArrow(_exits, "conv string, seg bigint, exits array<bigint>")
    entries = exits.groupBy("conv").applyInArrow(_entries, "conv string, seg bigint, entry bigint")
    short = segments.filter("segs = 1").select("*", F.array(*[F.lit(v).cast("long") for v in END]).alias("behind"), F.lit(0).cast("long").alias("crossed"), F.lit(START).cast("long").alias("entry"))
    walked = materialise(short.unionByName(ended.join(entries, keys)).mapInArrow(_walks, WALKED), "walked")

    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    parts = F.sort_array(F.collect_list(F.struct("seg", "audit")))
    found = walked.groupBy("conv").agg(*sums, F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))
    reports = spans.select("conv", "gaps").join(found, "conv")
    edits = walked.select("conv", F.explode("edits").alias("e")).select("conv", "e.*")
    own = rows.select("place", F.col("role").alias("own_role"), F.col("text").alias("own_text"))
    stay = edits.filter("edit != 'I'").join(own, "place").select("conv", "place", "order", "edit", F.coalesce("role", "own_role").alias("role"), F.col("own_text").alias("text"))
    new = edits.filter("edit = 'I'").select("conv", "place", "order", "edit", "role", F.lit("").alias("text"))
    return Repair(reports, stay.unionByName(new))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each run of rows with one name; the state goes on over batches, so no conversation is held."""
    now, state = None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch({"conv": pa.array([now], pa.string()), "repaired_sha256": pa.array([state.hexdigest()], pa.string())})

    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text")), strict=True):
            if conv != now:
                if state is not None:
                    yield done()
                now, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
    if state is not None:
        yield done()


def digests(rows: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) over the repaired rows as ``role:text`` lines. SHA-256 reads its input in order, so the rows
    of one conversation stream through one task; nothing of them is kept there."""
    ordered = rows.select("conv", "place", "order", "role", "text").repartition("conv").sortWithinPartitions("conv", "place", "order")
    return ordered.select("conv", "role", "text").mapInArrow(_digests, "conv string, repaired_sha256 string")


def repair_report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per id of ``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    An id without rows in ``turns`` has zeros, an empty audit and the digest of the empty text.
    """
    done = repair(turns)
    ids = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(NO_ID)).alias("conv"), F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = done.reports.withColumn("some", F.lit(True)).join(digests(done.rows), "conv", "left")
    joined = ids.join(found, "conv", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.when(F.col("some"), F.col("gaps")).otherwise(0).cast("long").alias("gaps")
    empty = F.lit(hashlib.sha256().hexdigest())
    return joined.select("conv_id", gaps, *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
