"""Vectors, nearest neighbours and attribute recommendation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.arrays import cosine
from shoplens.operators.scale import global_positions, lookup_join, materialise, top_n_per_group

BLOCK_ROWS = 1024  # probes compared with vectors of a cell at once
PART_BYTES = 32 << 20  # vectors of one side of a comparison that a task holds
DENSE_VALUES = 1 << 22  # values of candidate vectors gathered at once; with more, all are compared in double precision
ANGLE_MARGIN = 2e-6  # covers the rounding of cosines to 12 places, and of arccos
PIVOT_BYTES = 32 << 20  # pivots sent to every task: about the root of the vectors, and never more than this


def explode_affinity(features: DataFrame, column: str = "attribute_affinity_brandname", name: str = "brandname") -> DataFrame:
    """One row per user and attribute value with its score; the list column goes."""
    kept = [c for c in features.columns if c != column]
    return features.select(*kept, F.explode(column).alias("_a")).select(
        *kept, F.col("_a.attribute").alias(name), F.col("_a.affinity_score").alias("score")
    )


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("user_id", "brandname", "score")) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and f.name not in exclude]


def assemble(df: DataFrame, columns: Sequence[str] | None = None, out: str = "features") -> DataFrame:
    """Double columns except the score as one array column."""
    return df.withColumn(out, F.array(*[F.col(c) for c in (columns or feature_columns(df))]))


def _unit_rows(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows of a list array and the row lengths."""
    lists = arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr
    width = len(lists[0]) if len(lists) else 0
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), width)
    size = np.sqrt((flat * flat).sum(axis=1))
    return flat / np.where(size == 0, 1.0, size)[:, None], size


class PivotTree:
    """Pivots on two levels: every pivot belongs to the nearest of a few top ones, so a vector meets about two roots of them."""

    def __init__(self, pivots: np.ndarray) -> None:
        tops = pivots[: max(1, int(np.sqrt(len(pivots))))]
        owner = (pivots @ tops.T).argmax(axis=1)
        order = np.argsort(owner, kind="stable")
        self.tops, self.fine, self.owner = tops, pivots[order], owner[order]
        self.first = np.searchsorted(self.owner, np.arange(len(tops) + 1))

    def nearest(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell of each unit vector, the angle to its pivot and to the top pivot above."""
        dots = units @ self.tops.T
        top = dots.argmax(axis=1)
        cell, near = np.zeros(len(units), dtype=np.int64), np.zeros(len(units))
        for t in np.unique(top):
            rows = np.flatnonzero(top == t)
            own = units[rows] @ self.fine[self.first[t] : self.first[t + 1]].T
            best = own.argmax(axis=1)
            cell[rows], near[rows] = self.first[t] + best, own[np.arange(len(rows)), best]
        return cell, _angle(near), _angle(dots[np.arange(len(units)), top])

    def within(self, units: np.ndarray, limit: np.ndarray, radius: np.ndarray, top_radius: np.ndarray) -> np.ndarray:
        """For each row and cell whether the cell may hold a vector within ``limit`` of the row's; empty cells have radius minus infinity."""
        margin = limit + ANGLE_MARGIN
        reached = np.zeros((len(units), len(self.fine)), dtype=bool)
        far = _angle(units @ self.tops.T) - top_radius[None, :]
        for t in np.flatnonzero(np.isfinite(top_radius)):
            own = np.flatnonzero(far[:, t] <= margin)
            part = slice(self.first[t], self.first[t + 1])
            reached[own, part] = _angle(units[own] @ self.fine[part].T) - radius[None, part] <= margin[own, None]
        return reached


def _angle(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _place(df: DataFrame, tree: PivotTree, id_type: T.DataType) -> DataFrame:
    """Cell of every vector (-1 for length zero), the angle to its pivot and to its top pivot."""

    def nearest(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            units, size = _unit_rows(batch.column("vec"))
            cell, angle, top_angle = tree.nearest(units)
            cell = np.where(size == 0, -1, cell)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vec"), pa.array(cell, pa.int32()), pa.array(angle), pa.array(top_angle)],
                names=["id", "vec", "cell", "angle", "top_angle"],
            )

    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("vec", T.ArrayType(T.DoubleType())),
            T.StructField("cell", T.IntegerType()),
            T.StructField("angle", T.DoubleType()),
            T.StructField("top_angle", T.DoubleType()),
        ]
    )
    return df.mapInArrow(nearest, schema)


class Layout:
    """Neighbouring cells bundled up to ``most`` vectors; a larger cell is a bundle of its own, cut into several parts by a digest of the id."""

    def __init__(self, counts: np.ndarray, most: int) -> None:
        first, held = [0], 0
        for cell, n in enumerate(counts):
            if cell and held + n > most:
                first.append(cell)
                held = 0
            held += n
        self.first_cell = np.array(first)
        self.cuts = np.maximum(1, -(-np.add.reduceat(counts, self.first_cell) // most))
        self.first_part = np.cumsum(self.cuts) - self.cuts
        self.bundle = np.searchsorted(self.first_cell, np.arange(len(counts)), side="right") - 1

    def part(self, rows: DataFrame) -> DataFrame:
        """The rows with the part that their own cell and id name."""
        cells = [(c, int(self.first_part[b]), int(self.cuts[b])) for c, b in enumerate(self.bundle)]  # one row per pivot
        named = rows.sparkSession.createDataFrame(cells, "cell int, _first int, _cuts int")
        part = F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_cuts")).cast("int")
        return rows.join(F.broadcast(named), "cell").withColumn("part", part).drop("_first", "_cuts")

    def parts(self, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) pairs of all parts that hold a reached cell."""
        who, bundle = np.nonzero(np.logical_or.reduceat(reached, self.first_cell, axis=1))
        times = self.cuts[bundle]
        cut = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(who, times), np.repeat(self.first_part[bundle], times) + cut


class _Best:
    """The ``take`` best base rows met so far by each of some probes: cosine descending, then rank of the id."""

    def __init__(self, units: np.ndarray, limit: np.ndarray, take: int) -> None:
        self.units, self.narrow, self.limit, self.take = units, units.astype(np.float32), limit.copy(), take
        self.cosines = np.full((len(units), take), -np.inf)
        self.ranks = np.full((len(units), take), -1, dtype=np.int64)

    def meet(self, who: np.ndarray, units: np.ndarray, narrow: np.ndarray, ranks: np.ndarray) -> None:
        """Compare the probes ``who`` with base vectors in id order. Single precision rules out what cannot reach the limit."""
        width = units.shape[1]
        floor = (self.limit[who] - (width + 8) * 6.2e-8).astype(np.float32)
        near = self.narrow[who] @ narrow.T >= floor[:, None]
        if np.count_nonzero(near) * width > DENSE_VALUES:
            dots = np.round(self.units[who] @ units.T, 12)
            limit = self.limit[who]
            if dots.shape[1] > self.take:
                limit = np.maximum(limit, -np.partition(-dots, self.take - 1, axis=1)[:, self.take - 1])
            near = dots >= limit[:, None]
            # columns are in id order, so of ties with the last one kept the lowest ids stay
            for crowded in np.flatnonzero(near.sum(axis=1) > self.take):
                first = np.argsort(-dots[crowded], kind="stable")[: self.take]
                near[crowded] = False
                near[crowded, first] = True
            row, col = np.nonzero(near)
            found = dots[row, col]
        else:
            row, col = np.nonzero(near)
            found = np.round(np.einsum("ij,ij->i", self.units[who[row]], units[col]), 12)
            enough = found >= self.limit[who[row]]
            row, col, found = row[enough], col[enough], found[enough]
        if len(row):
            self._keep(who, row, found, ranks[col])

    def _keep(self, who: np.ndarray, row: np.ndarray, found: np.ndarray, ranks: np.ndarray) -> None:
        hit, at = np.unique(row, return_inverse=True)
        probe, take = who[hit], self.take
        owner = np.concatenate([np.repeat(np.arange(len(hit)), take), at])
        cosines = np.concatenate([self.cosines[probe].ravel(), found])
        ranks = np.concatenate([self.ranks[probe].ravel(), ranks])
        order = np.lexsort((ranks, -cosines, owner))
        held = np.bincount(owner, minlength=len(hit))
        place = np.arange(len(order)) - np.repeat(np.cumsum(held) - held, held)
        chosen = order[place < take].reshape(len(hit), take)
        self.cosines[probe], self.ranks[probe] = cosines[chosen], ranks[chosen]
        self.limit[probe] = np.maximum(self.limit[probe], self.cosines[probe, -1])


def _search(probes: pa.Table, base: pa.Table, tree: PivotTree, radius: np.ndarray, top_radius: np.ndarray, take: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``take`` best base rows (-1: none) of each probe and their cosines, at least the probe's bound. A cell is passed over where
    nothing in it can be as good as what the probe has; the probe's own cell comes first."""
    units, _ = _unit_rows(probes.column("vec"))
    cells = probes.column("cell").to_numpy()
    bound = probes.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
    rows, cosines = np.full((len(units), take), -1, dtype=np.int64), np.full((len(units), take), -np.inf)
    if base.num_rows == 0:
        return rows, cosines
    by_id = pc.sort_indices(base.column("b_id").combine_chunks()).to_numpy()
    rank = np.empty(len(by_id), dtype=np.int64)
    rank[by_id] = np.arange(len(by_id))
    base_cells = base.column("b_cell").to_numpy()
    order = np.lexsort((rank, base_cells))
    wide = _unit_rows(base.column("b_vec"))[0][order]
    narrow, rank, base_cells = wide.astype(np.float32), rank[order], base_cells[order]
    held, starts = np.unique(base_cells, return_index=True)
    spans = dict(zip(held.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(base_cells)])))
    present = np.full(len(radius), -np.inf)
    present[held] = radius[held]
    tops = np.full(len(top_radius), -np.inf)
    tops[np.unique(tree.owner[held])] = top_radius[np.unique(tree.owner[held])]
    in_order = np.argsort(cells, kind="stable")
    for at in range(0, len(units), block):
        own = in_order[at : at + block]
        best = _Best(units[own], np.where(np.isnan(bound[own]), -np.inf, bound[own]), take)
        home = cells[own]

        def meet(who: np.ndarray, cell: int) -> None:
            first, last = spans[cell]
            for start in range(first, last, 4 * block):
                piece = slice(start, min(start + 4 * block, last))
                best.meet(who, wide[piece], narrow[piece], rank[piece])

        for cell in np.unique(home):
            if cell in spans:
                meet(np.flatnonzero(home == cell), int(cell))
        reached = tree.within(best.units, _angle(np.maximum(best.limit, -1.0)), present, tops)
        reached[np.arange(len(own)), home] = False
        for cell in np.flatnonzero(reached.any(axis=0)):
            who = np.flatnonzero(reached[:, cell])
            near = _angle(best.units[who] @ tree.fine[cell]) - radius[cell] <= _angle(np.maximum(best.limit[who], -1.0)) + ANGLE_MARGIN
            if near.any():
                meet(who[near], int(cell))
        rows[own], cosines[own] = np.where(best.ranks >= 0, by_id[best.ranks], -1), best.cosines
    return rows, cosines


def _meet(visits: DataFrame, base: DataFrame, most: int, search, schema: T.StructType) -> DataFrame:
    """Apply ``search`` to the probes that visit a part (columns id, vec, cell, bound, part) and the part's vectors, with at most about
    ``most`` probes a task. Both sides are dealt by part and group of probes: a vector moves once for each part it visits, and
    once for each group of probes that comes to its part."""
    spark = base.sparkSession
    units, start = [], 0
    for r in visits.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():  # one row a part
        groups = -(-r["n"] // most)
        units.append((r["part"], start, groups))
        start += groups
    named = F.broadcast(spark.createDataFrame(units, "part int, _start int, _groups int"))
    tasks = max(1, min(start, max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    left = visits.join(named, "part").withColumn("unit", F.col("_start") + F.pmod(F.xxhash64("id"), F.col("_groups")).cast("int"))
    right = base.join(named, "part").withColumn("unit", F.explode(F.sequence(F.col("_start"), F.col("_start") + F.col("_groups") - 1)))
    probes = left.select("unit", "id", "vec", "cell", "part", "bound").repartition(tasks, "unit")
    vectors = right.select(*[F.col(c).alias(f"b_{c}") for c in ("unit", "id", "vec", "cell")]).repartition(tasks, "b_unit")
    return probes.groupBy("unit").cogroup(vectors.groupBy("b_unit")).applyInArrow(search, schema)


def _copies(df: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with the lowest id (rep) and the ``keep`` lowest ids of their copies."""
    lowest = top_n_per_group(df.select("id", "vec"), ["vec"], [F.asc("id")], keep)
    return lowest.groupBy("vec").agg(F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("ids"))


def nearest_neighbours(
    base: DataFrame, probes: DataFrame | None = None, k: int = 1, id_col: str = "id", vector: str = "vec", pivots: int | None = None
) -> DataFrame:
    """Exact k nearest vectors by cosine: probe, base, cosine, rank. Without ``probes`` every base row
    is one and never meets itself. Equal cosines rank by id.

    Copies of a vector are compared once: the search runs on distinct vectors, each standing for the
    k + 1 lowest ids of its copies, which is all that can rank. Every probe row then takes the list
    of its own vector.
    """
    same_table = probes is None
    shape = lambda df: df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    rows = shape(base)
    groups = materialise(_copies(rows, k + 1), "vectors")
    single = groups.select(F.col("rep").alias("id"), "vec")
    asked = groups.select("rep", "vec") if same_table else shape(probes).groupBy("vec").agg(F.min("id").alias("rep"))
    found = _nearest_distinct(single, None if same_table else asked.select(F.col("rep").alias("id"), "vec"), k, pivots)
    members = groups.select(F.col("rep").alias("base"), F.explode("ids").alias("member"))
    reached = lookup_join(found.select("probe", "base", "cosine"), members, ["base"]).select("probe", "member", "cosine")
    if same_table:
        length = F.aggregate("vec", F.lit(0.0), lambda t, x: t + x * x)
        own = groups.select(
            F.col("rep").alias("probe"),
            F.explode("ids").alias("member"),
            F.when(length > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("cosine"),
        )
        reached = reached.unionByName(own)
    lists = top_n_per_group(reached, ["probe"], [F.desc("cosine"), F.asc("member")], k + 1).drop("rank")
    asking = rows if same_table else shape(probes)
    named = lookup_join(asking, asked.select("vec", F.col("rep").alias("probe")), ["vec"]).select("id", "probe")
    answers = lookup_join(named, lists, ["probe"]).select(F.col("id").alias("probe"), F.col("member").alias("base"), "cosine")
    if same_table:
        answers = answers.filter(F.col("probe") != F.col("base"))
    return top_n_per_group(answers, ["probe"], [F.desc("cosine"), F.asc("base")], k)


def _pivots(rows: DataFrame, total: int, pivots: int | None) -> np.ndarray:
    """Unit vectors of the rows with the lowest digests: about the root of all rows, and within PIVOT_BYTES."""
    living = rows.filter(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x * x) > 0)
    width = rows.select(F.size("vec").alias("width")).first()
    width = max(1, width["width"]) if width else 1
    wanted = pivots or max(1, min(int(np.sqrt(total)), PIVOT_BYTES // (8 * width)))
    picked = [r["vec"] for r in living.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()]
    centre = np.array(picked or [[1.0] * width], dtype=np.float64)  # without any: only vectors of length zero
    return centre / np.sqrt((centre * centre).sum(axis=1))[:, None]


def _nearest_distinct(rows: DataFrame, probes: DataFrame | None, k: int, pivots: int | None) -> DataFrame:
    """k nearest among distinct vectors (columns id, vec).

    Vectors gather around pivots, in proportion to the root of their number, found through a tree of two levels. Neighbouring cells are
    bundled into parts of bounded size. A probe first looks inside the part of its own cell; the k-th cosine found there is a bound.
    By the triangle inequality for angles a cell can hold something better only if angle(probe, pivot) - radius(cell) stays within
    the bound, and all cells under a top pivot can be passed over by the same rule, so the probe then visits just the other parts that
    hold such a cell, once each, however many of their cells it needs. A task holds one part and a bounded group of its visitors.
    Vectors of length zero have cosine 0 with everything and join as candidates of their own: only the lowest ids among them
    can rank.
    """
    same_table = probes is None
    id_type = rows.schema["id"].dataType
    tree = PivotTree(_pivots(rows, rows.count(), pivots))
    block = BLOCK_ROWS

    placed = materialise(_place(rows, tree, id_type), "cells")
    stats = placed.filter("cell >= 0").groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"), F.max("top_angle").alias("top")).collect()  # one row per pivot
    counts = np.zeros(len(tree.fine), dtype=np.int64)
    radius, top_radius = np.full(len(tree.fine), -np.inf), np.full(len(tree.tops), -np.inf)
    for r in stats:
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
        top_radius[tree.owner[r["cell"]]] = max(top_radius[tree.owner[r["cell"]]], r["top"])
    # as many parts and groups of probes as give every core several tasks, within what a task may hold
    fair = -(-int(counts.sum()) // max(2, int(np.sqrt(8 * rows.sparkSession.sparkContext.defaultParallelism))))
    most = max(block, min(PART_BYTES // (8 * tree.fine.shape[1]), fair))
    layout = Layout(counts, most)
    probe_rows = placed if same_table else materialise(_place(probes, tree, id_type), "probes")
    living = probe_rows.filter("cell >= 0")
    base = layout.part(placed.filter("cell >= 0").select("id", "vec", "cell"))

    def look_at_home(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, cosines = _search(left, right, tree, radius, top_radius, k + same_table, block)
        if same_table:  # a probe meets itself in the part of its own cell only
            names = pa.chunked_array([*left.column("id").chunks, *right.column("b_id").chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
            itself = (rows >= 0) & (names[len(rows) + np.maximum(rows, 0)] == names[: len(rows), None]) if right.num_rows else rows >= 0
            rest = np.argsort(itself, axis=1, kind="stable")[:, :k]  # without itself, else without the last
            rows = np.take_along_axis(np.where(itself, -1, rows), rest, axis=1)
            cosines = np.take_along_axis(cosines, rest, axis=1)
        full = rows[:, k - 1] >= 0
        offsets = pa.array(np.concatenate([[0], np.cumsum((rows >= 0).sum(axis=1))]), pa.int32())
        ids = pa.ListArray.from_arrays(offsets, right.column("b_id").combine_chunks().take(pa.array(rows[rows >= 0])))
        near = pa.ListArray.from_arrays(offsets, pa.array(cosines[rows >= 0]))
        kept = [left.column("id"), left.column("vec"), left.column("cell"), left.column("part")]
        return pa.table([*kept, pa.array(cosines[:, k - 1], mask=~full), ids, near], names=home.names)

    def look_further(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, cosines = _search(left, right, tree, radius, top_radius, k, block)
        who, _ = np.nonzero(rows >= 0)
        return pa.table(
            [left.column("id").take(pa.array(who)), right.column("b_id").take(pa.array(rows[rows >= 0])), pa.array(cosines[rows >= 0])],
            names=["probe", "base", "cosine"],
        )

    def further(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                units, _ = _unit_rows(batch.column("vec"))
                bounds = batch.column("bound").to_numpy(zero_copy_only=False)
                limit = np.where(np.isnan(bounds), np.pi, _angle(np.nan_to_num(bounds)))
                who, part = layout.parts(tree.within(units, limit, radius, top_radius))
                other = part != batch.column("part").to_numpy()[who]
                who, part = pa.array(who[other]), pa.array(part[other].astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(who) for c in ("id", "vec", "cell", "bound")), part], names=["id", "vec", "cell", "bound", "part"])

    vector = T.ArrayType(T.DoubleType())
    visit = T.StructType().add("id", id_type).add("vec", vector).add("cell", "integer").add("bound", "double").add("part", "integer")
    home = T.StructType().add("id", id_type).add("vec", vector).add("cell", "integer").add("part", "integer").add("bound", "double")
    home = home.add("base", T.ArrayType(id_type)).add("cosine", vector)
    found = T.StructType().add("probe", id_type).add("base", id_type).add("cosine", "double")
    parts = []
    if stats:
        at_home = layout.part(living.select("id", "vec", "cell")).withColumn("bound", F.lit(None).cast("double"))
        own = materialise(_meet(at_home, base, most, look_at_home, home), "own")
        near = own.select(F.col("id").alias("probe"), F.explode(F.arrays_zip("base", "cosine")).alias("_n"))
        parts.append(near.select("probe", "_n.base", "_n.cosine"))
        visits = materialise(own.select("id", "vec", "cell", "part", "bound").mapInArrow(further, visit), "visits")
        if not visits.isEmpty():
            parts.append(_meet(visits, base, most, look_further, found))

    # zero vectors: k + 1 lowest ids suffice as partners, all with cosine 0
    zeros = placed.filter("cell < 0").orderBy("id").limit(k + 1).agg(F.collect_list("id").alias("ids"))
    lowest = placed.orderBy("id").limit(k + 1).agg(F.collect_list("id").alias("ids"))
    for who, partners in ((living, zeros), (probe_rows.filter("cell < 0"), lowest)):
        flat = who.select(F.col("id").alias("probe"), F.explode(partners.scalar()).alias("base"), F.lit(0.0).alias("cosine"))
        parts.append(flat.filter(F.col("probe") != F.col("base")) if same_table else flat)
    united = parts[0]
    for p in parts[1:]:
        united = united.unionByName(p)
    rounded = united.withColumn("cosine", F.round("cosine", 12)).groupBy("probe", "base").agg(F.max("cosine").alias("cosine"))
    return top_n_per_group(rounded, ["probe"], [F.desc("cosine"), F.asc("base")], k)


def similar_to_one(rows: DataFrame, probe: DataFrame, k: int, id_col: str = "user_id", vector: str = "features") -> DataFrame:
    """The k rows most like one probe row of another id. The right side is that one row."""
    one = probe.select(F.col(id_col).alias("_probe_id"), F.col(vector).alias("_probe")).limit(1)
    return (
        rows.join(F.broadcast(one), F.col(id_col) != F.col("_probe_id"))
        .withColumn("cosine_sim", cosine(F.col(vector), F.col("_probe")))
        .filter(F.col("cosine_sim").isNotNull())
        .drop("_probe_id", "_probe")
        .orderBy(F.desc("cosine_sim"), id_col)
        .limit(k)
    )


def brand_score(rows: DataFrame, user, brand: str, top_n: int = 5) -> DataFrame:
    """One user's score for one brand, as a single-row table.

    ``rows``: user_id, brandname, score, features. The stored score if present, else the mean score of
    the brand among the users of the ``top_n`` most similar rows, else 0.
    """
    mine = rows.filter(F.col("user_id") == F.lit(user))
    stored = mine.filter((F.col("brandname") == brand) & F.col("score").isNotNull()).agg(F.min("score")).scalar()
    probe = mine.orderBy("brandname").limit(1)
    near = similar_to_one(rows, probe, top_n).select("user_id").distinct()
    mean = (
        rows.filter((F.col("brandname") == brand) & F.col("score").isNotNull())
        .join(F.broadcast(near), "user_id", "left_semi")
        .agg(F.avg("score"))
        .scalar()
    )
    one = rows.sparkSession.range(1)
    return one.select(
        F.lit(user).alias("user_id"), F.lit(brand).alias("brandname"), F.coalesce(stored, mean, F.lit(0.0)).alias("predicted")
    )


def recommend_attributes(
    scores: DataFrame, users: DataFrame, attribute: str = "brandname", neighbours: int = 10, top_n: int = 10
) -> DataFrame:
    """Top attribute values per user by mean score among the user's nearest users, values the user
    already scored left out.

    ``scores``: user_id, attribute, score. ``users``: user_id, features (one row per user).
    """
    users, scores = materialise(users.select("user_id", "features"), "users"), materialise(scores.select("user_id", attribute, "score"), "scores")
    near = nearest_neighbours(users, None, neighbours, "user_id", "features").select(
        F.col("probe").alias("target"), F.col("base").alias("user_id")
    )
    # a neighbour of very many users is a hot key; its scores are few, so they are the lookup side
    reached = lookup_join(near, scores.filter(F.col("score").isNotNull()).select("user_id", attribute, "score"), ["user_id"])
    means = reached.groupBy(F.col("target").alias("user_id"), attribute).agg(F.avg("score").alias("predicted"))
    fresh = means.join(scores.select("user_id", attribute).distinct(), ["user_id", attribute], "left_anti")
    return top_n_per_group(fresh, ["user_id"], [F.desc("predicted"), F.asc(attribute)], top_n)


def dense_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """Index from 0 by descending frequency, then value; built by a distributed sort."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    numbered = global_positions(counts, [F.desc("_n"), F.asc(column)], "_position")
    return numbered.select(column, (F.col("_position") - 1).cast("int").alias(out))


def als_ratings(scores: DataFrame, user: str = "user_id", item: str = "brandname") -> DataFrame:
    """(user, item, rating) with dense indexes beside the original columns."""
    users, items = dense_index(scores, user, "user"), dense_index(scores, item, "item")
    indexed = lookup_join(lookup_join(scores, users, [user]), items, [item])
    return indexed.withColumn("rating", F.col("score").cast("float"))


def als_model(ratings: DataFrame, rank: int = 3, iterations: int = 10, reg: float = 0.1, seed: int = 7):
    """Explicit ALS model of all ratings (user, item, rating)."""
    from pyspark.ml.recommendation import ALS

    als = ALS(
        userCol="user", itemCol="item", ratingCol="rating", rank=rank, maxIter=iterations, regParam=reg,
        coldStartStrategy="drop", implicitPrefs=False, seed=seed,
    )
    return als.fit(ratings.select("user", "item", "rating"))


def als_predictions(ratings: DataFrame, pairs: DataFrame, rank: int = 3, iterations: int = 10, reg: float = 0.1, seed: int = 7) -> DataFrame:
    """Explicit ALS on all ratings; pairs of unknown users or items are left out."""
    return als_model(ratings, rank, iterations, reg, seed).transform(pairs)


def als_residuals(ratings: DataFrame, rank: int = 3, iterations: int = 10, reg: float = 0.1, seed: int = 7) -> DataFrame:
    """How well each user's factors solve their regularised least squares: user, ratings, residual (0: exactly), error, weight.

    The last half step of ALS sets all users from the items, so sum((u.v - r) v) + reg n u is zero up to single precision; ``residual`` is
    its largest entry against the largest one of sum(|r v|).
    """
    model = als_model(ratings, rank, iterations, reg, seed)
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("v"))
    rows = ratings.select("user", "item", "rating").join(items, "item").join(users, "user")
    wide = lambda c, k: F.get(c, F.lit(k)).cast("double")
    off = sum((wide("u", k) * wide("v", k) for k in range(rank)), -F.col("rating").cast("double"))
    sums = [F.sum(off * wide("v", k)).alias(f"_s{k}") for k in range(rank)] + [F.sum(F.abs(F.col("rating") * wide("v", k))).alias(f"_w{k}") for k in range(rank)]
    found = rows.groupBy("user", "u").agg(F.count(F.lit(1)).alias("ratings"), *sums)
    largest = lambda parts: parts[0] if len(parts) == 1 else F.greatest(*parts)
    error = largest([F.abs(F.col(f"_s{k}") + reg * F.col("ratings") * wide("u", k)) for k in range(rank)])
    return found.select("user", "ratings", error.alias("error"), largest([F.col(f"_w{k}") for k in range(rank)]).alias("weight")).withColumn(
        "residual", F.coalesce(F.try_divide("error", "weight"), F.lit(0.0))
    )


def latest_vectors(df: DataFrame, query: str = "query", order: str = "ts", vector: str = "vec") -> DataFrame:
    """The latest vector per query, by aggregate: no window over a query's whole history."""
    best = F.max_by(F.struct(order, vector), F.struct(order, vector))
    return df.groupBy(query).agg(best.alias("_last")).select(query, f"_last.{order}", f"_last.{vector}")
