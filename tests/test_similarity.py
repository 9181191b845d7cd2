"""Nearest neighbours, recommendation and vocabulary searches against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import recommend as re
from shoplens.operators import tables as ta
from shoplens.operators import vocabulary as vo


def brute(base, probes, k, same):
    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1.0)
    out = set()
    for p, pv in probes:
        ranked = sorted((-round(float(unit(pv) @ unit(bv)), 12) + 0.0, b) for b, bv in base if not (same and b == p))
        out |= {(p, b, i + 1) for i, (_, b) in enumerate(ranked[:k])}
    return out


def rows_of(df):
    return {(r.probe, r.base, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("k, dims, size, block", [(1, 2, 90, 1024), (3, 4, 150, 16), (5, 16, 80, 7)])
def test_neighbours_equal_brute_force(spark, monkeypatch, k, dims, size, block):
    monkeypatch.setattr(re, "BLOCK_ROWS", block)
    rng = random.Random(k)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dims)]) for i in range(size)]
    rows += [(1000 + i, rows[0][1]) for i in range(size // 2)]  # a third of all rows are copies
    rows += [(2000 + i, [0.0] * dims) for i in range(4)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    assert rows_of(re.nearest_neighbours(df, k=k)) == brute(rows, rows, k, True)
    probes = [(i, [rng.gauss(0, 1) for _ in range(dims)]) for i in range(9)] + [(77, rows[0][1]), (78, [0.0] * dims), (79, rows[0][1])]
    other = spark.createDataFrame(probes, "id bigint, vec array<double>")
    assert rows_of(re.nearest_neighbours(df, other, k=k)) == brute(rows, probes, k, False)


def test_vectors_travel_once_a_part_not_once_a_cell(spark, monkeypatch):
    written, keep = {}, re.materialise

    def counted(df, label="table"):
        kept = keep(df, label)
        written[label] = kept.count()
        return kept

    monkeypatch.setattr(re, "materialise", counted)
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    assert rows_of(re.nearest_neighbours(df, k=2, pivots=20)) == brute(rows, rows, 2, True)
    assert written["visits"] < len(rows)  # 20 cells, but all in one part


def test_parts_hold_a_bounded_number_of_vectors():
    counts = np.array([0, 3, 4, 25, 0, 1, 9, 2, 0])
    layout = re.Layout(counts, 10)
    held = np.add.reduceat(counts, layout.first_cell) / layout.cuts
    assert held.max() <= 10 and list(layout.cuts) == [1, 3, 1, 1]
    reached = np.zeros((2, len(counts)), dtype=bool)
    reached[0, [1, 2, 3]] = reached[1, 8] = True
    who, part = layout.parts(reached)
    assert sorted(zip(who.tolist(), part.tolist())) == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 5)]


def test_neighbours_of_only_zero_vectors(spark):
    df = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [0.0, 0.0])], "id string, vec array<double>")
    assert rows_of(re.nearest_neighbours(df, k=2)) == {("a", "b", 1), ("b", "a", 1)}


BRAND_ROWS = [
    ("u", "nike", 5.0, [1.0, 0.0]), ("v", "nike", 2.0, [1.0, 0.1]), ("v", "puma", 4.0, [1.0, 0.1]),
    ("w", "puma", 8.0, [0.9, 0.2]), ("x", "puma", 100.0, [-1.0, 0.0]),
]


@pytest.mark.parametrize("user, brand, n, want", [("u", "nike", 2, 5.0), ("u", "puma", 2, 4.0), ("u", "puma", 3, 6.0), ("u", "zara", 3, 0.0), ("nobody", "nike", 3, 0.0)])
def test_brand_score_counts_similar_rows_not_users(spark, user, brand, n, want):
    df = spark.createDataFrame(BRAND_ROWS, "user_id string, brandname string, score double, features array<double>")
    assert re.brand_score(df, user, brand, n).first().predicted == want


def test_dense_index_orders_by_frequency_then_value(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "x string")
    assert {r.x: r.i for r in re.dense_index(df, "x", "i").collect()} == {"b": 0, "a": 1, "c": 2}


def soundex(w):
    codes = {c: d for d, cs in {"1": "BFPV", "2": "CGJKQSXZ", "3": "DT", "4": "L", "5": "MN", "6": "R"}.items() for c in cs}
    w = w.upper()
    out, last = w[0], codes.get(w[0], "")
    for c in w[1:]:
        d = codes.get(c, "")
        if d and d != last:
            out += d
        if c not in "HW":
            last = d
    return (out + "000")[:4]


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("threshold", [0.85, 0.6])
def test_phonetic_pairs_equal_brute_force(spark, threshold):
    rng = random.Random(2)
    stems = ["telephone", "chocolate", "mississippi", "sandal", "trouser", "jacket"]
    words = set(stems)
    for w in stems:
        for _ in range(25):
            v = list(w)
            for _ in range(rng.choice([1, 1, 2])):
                i = rng.randrange(len(v))
                rng.choice([lambda: v.insert(i, rng.choice("aeiouhl")), lambda: v.__setitem__(i, rng.choice("aeioutd")), lambda: v.pop(i)])()
            words.add("".join(v))
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {(r.word, r.similar) for r in vo.phonetic_variants(df, threshold).collect()}
    want = {
        (a, b) for a in words for b in words
        if a < b and soundex(a) == soundex(b) and 1 - lev(a, b) / max(len(a), len(b)) >= threshold
    }
    assert got == want and want


def test_split_words_single_letters_need_more_products(spark):
    vocab = spark.createDataFrame([("foot", 30), ("ball", 30), ("s", 30), ("footballs", 1), ("football", 1), ("foots", 1)], "word string, products bigint")
    got = {(r.joined, r.left, r.right) for r in vo.split_words(vocab, vocab, 20, 1000).collect()}
    assert got == {("football", "foot", "ball")}


def test_replace_tokens_keeps_order_and_repeats(spark):
    q = spark.createDataFrame([("1", ["teh", "cat", "teh"]), ("2", ["ok"])], "query string, tokens array<string>")
    m = spark.createDataFrame([("teh", "the")], "wrongword string, rightword string")
    assert {r.query: r.corrected for r in vo.replace_tokens(q, m).collect()} == {"1": "the cat the", "2": "ok"}


def test_replaced_tokens_are_looked_up_once_a_run_and_without_their_lists(spark, monkeypatch):
    seen, join = [], vo.lookup_join

    def recorded(fact, lookup, on, how="inner"):
        seen.append((set(fact.columns), fact.count()))
        return join(fact, lookup, on, how)

    monkeypatch.setattr(vo, "lookup_join", recorded)
    q = spark.createDataFrame([(i, ["teh", "cat", None, "teh"]) for i in range(50)] + [(99, None)], "query int, tokens array<string>").coalesce(1)
    m = spark.createDataFrame([("teh", "the"), ("cat", None), ("dog", "hound")], "wrongword string, rightword string")
    got = {(r.query, r.corrected, r.tokens) for r in vo.replace_tokens(q, m).collect()}
    assert got == {(i, "the cat the", 4) for i in range(50)} | {(99, "", 0)}
    [(columns, rows)] = seen
    assert "_list" not in columns and rows <= 3


def test_longest_phrase(spark):
    q = spark.createDataFrame([("q", ["red", "tennis", "shoe"])], "query string, tokens array<string>")
    p = spark.createDataFrame([("shoe",), ("tennis shoe",), ("red tennis",)], "phrase string")
    assert vo.longest_phrase(q, p).first().phrase == "red tennis"


def test_union_takes_the_first_table_with_a_value(spark):
    a = spark.createDataFrame([("x", None, 1)], "k string, v string, only_a int")
    b = spark.createDataFrame([("x", "b", 2), ("y", "c", 3)], "k string, v string, only_b int")
    assert sorted(map(tuple, ta.union_common_columns([a, b], ["k"]).collect())) == [("x", "b"), ("y", "c")]
    wide = ta.union_common_columns([a, b], ["k"], "reference", a)
    assert wide.columns == ["k", "v", "only_a"] and wide.count() == 2


def test_als_predicts_every_known_pair(spark):
    scores = spark.createDataFrame([(f"u{i}", f"b{j}", float(i + j)) for i in range(6) for j in range(4)], "user_id string, brandname string, score double")
    ratings = re.als_ratings(scores)
    assert re.als_predictions(ratings, ratings.select("user", "item")).filter(F.col("prediction").isNotNull()).count() == 24


def test_als_solves_its_equations(spark):
    import numpy as np

    rng = random.Random(3)
    scores = spark.createDataFrame([(f"u{i}", f"b{j}", rng.uniform(-3, 20)) for i in range(12) for j in range(7) if rng.random() < 0.7], "user_id string, brandname string, score double")
    ratings = re.als_ratings(scores)
    found = {r.user: r for r in re.als_residuals(ratings).collect()}
    model = re.als_model(ratings)
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    by_user = {}
    for r in ratings.collect():
        by_user.setdefault(r.user, []).append((items[r.item], r.rating))
    predicted = {(r.user, r.item): r.prediction for r in re.als_predictions(ratings, ratings.select("user", "item")).collect()}
    for user, rows in by_user.items():
        v, y = np.array([a for a, _ in rows]), np.array([b for _, b in rows])
        solved = np.linalg.solve(v.T @ v + 0.1 * len(y) * np.eye(3), v.T @ y)  # by brute force
        for item, vector in items.items():
            if (user, item) in predicted:
                assert predicted[user, item] == pytest.approx(float(solved @ vector), abs=2e-2)
        assert found[user].ratings == len(y) and found[user].residual < 1e-3
