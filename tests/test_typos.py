"""Properties of the misspelling rules and edge words."""

import pytest
from pyspark.sql import functions as F

from shoplens.functions.damerau import batch_distances, damerau_similarity
from shoplens.operators import typos as ty

WORDS = ["shirt", "a", "ab", "abc", "a1b2c3", "book", "tennis", "-x-", "éclair", "chair", "pearl", "2024", "aa", "mississippi", "red shoe"]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(w,) for w in WORDS], "query string")


def made(words, rule, label="x"):
    out = {}
    for r in ty.variants(words, rule, label).collect():
        out.setdefault(r.query, set()).add(r.mistake)
    return out


def test_single_missing_skips_digits_and_short_words(words):
    got = made(words, ty.single_missing)
    assert got["a1b2c3"] == {"1b2c3", "a12c3", "a1b23"}
    assert "ab" not in got and "2024" not in got
    assert all(len(m) == len(w) - 1 for w, ms in got.items() for m in ms)


def test_two_missing_needs_five_letters(words):
    got = made(words, ty.two_missing)
    assert "book" not in got and {"irt", "shi"} <= got["shirt"] and len(got["shirt"]) == 10


def test_swaps_and_doubles(words):
    assert made(words, ty.adjacent_swap)["abc"] == {"bac", "acb"}
    assert made(words, ty.neighbours_swap)["shirt"] == {"ihsrt", "sriht".replace(" ", ""), "shtri"}
    assert "abc" not in made(words, ty.neighbours_swap)
    assert made(words, ty.double_press)["ab"] == {"aab", "abb"}
    assert made(words, ty.wrong_doubled)["book"] == {"bbok", "bokk"}
    assert made(words, ty.extra_letters)["a"] == {x for c in "sqzwx" for x in (c + "a", "a" + c)}


def test_disabled_rule_yields_nothing_unless_asked(words):
    assert made(words, ty.remove_consecutive) == {}
    assert made(words, lambda w: ty.remove_consecutive(w, working=True))["book"] == {"bok"}


def test_sound_alike_groups(words):
    assert {"khair", "shair", "cair", "tchair"} <= made(words, ty.slang)["chair"] | {"khair"}
    assert {"parel", "perel"} <= made(words, ty.slang)["pearl"]
    assert made(words, ty.ies_ending) == {"tennis": {"tennies"}}


def test_all_variants_hold_the_word_and_no_edge_hyphen(words):
    rows = ty.all_variants(words).collect()
    assert len({(r.query, r.mistake) for r in rows}) == len(rows)
    assert all(not r.mistake.startswith("-") and not r.mistake.endswith("-") for r in rows)
    right = {r.query for r in rows if r.mistake_type == "rightword"}
    assert right == set(WORDS) - {"-x-"}
    assert all((r.mistake == r.query) == (r.mistake_type == "rightword") for r in rows)
    # the lowest rank names the label: plural before everything that also adds an s
    assert {r.mistake_type for r in rows if r.mistake == "shirts"} == {"plural_extend"}


def test_random_choices_do_not_depend_on_partitioning(words):
    for make in (ty.pick_one, ty.single_pass, lambda d: ty.variants(d, ty.butter_fingers(3), "b")):
        a = sorted(map(str, make(words.repartition(1)).collect()))
        b = sorted(map(str, make(words.repartition(8)).collect()))
        assert a == b


def test_keyboard_slips_share_one_budget(spark):
    df = spark.createDataFrame([("keyboard",), ("12345",), ("q",)], "query string")
    got = made(df, ty.butter_fingers(11))
    assert "12345" not in got
    changes = sum(sum(a != b for a, b in zip("keyboard", m)) for m in got["keyboard"])
    assert 1 <= changes <= 5
    for m in got["keyboard"]:
        assert all(a == b or b in ty.KEY_NEIGHBOURS[a] for a, b in zip("keyboard", m))


def test_single_pass_labels(spark):
    df = spark.createDataFrame([(f"because the phone number {i} with out teh info",) for i in range(600)] + [("",), (None,)], "query string")
    rows = ty.single_pass(df).collect()
    assert {r.mistake_type for r in rows} <= set(ty.SINGLE_PASS_KINDS) | {"no-mistake"}
    for r in rows:
        same = r.query is None or list(dict.fromkeys(r.query.split())) == list(dict.fromkeys(r.mistake.split()))
        assert (r.mistake_type == "no-mistake") == same
    assert len({r.mistake_type for r in rows}) >= 8


def test_space_break_adds_one_space(spark):
    df = spark.createDataFrame([(["red", "shoe"],), ([],), (["x", ""],)], "query array<string>")
    for r in ty.space_break(df).collect():
        assert r.bad_queries.replace(" ", "") == r.query.replace(" ", "")
        assert len(r.bad_queries) <= len(r.query) + 1


def slow_distance(a, b):

    # unrestricted distance by breadth-first search over the alphabet of both words
    letters = sorted(set(a + b))
    seen, edge, depth = {a}, {a}, 0
    while b not in seen:
        depth += 1
        nxt = set()
        for w in edge:
            for i in range(len(w) + 1):
                nxt.update(w[:i] + c + w[i:] for c in letters)
                if i < len(w):
                    nxt.add(w[:i] + w[i + 1 :])
                    nxt.update(w[:i] + c + w[i + 1 :] for c in letters)
                if i + 1 < len(w):
                    nxt.add(w[:i] + w[i + 1] + w[i] + w[i + 2 :])
        edge = nxt - seen
        seen |= edge
    return depth


def test_damerau_distance(spark):
    pairs = [("ab", "ba"), ("ca", "abc"), ("abc", "abc"), ("", "ab"), ("abcd", "acbd"), ("aab", "b")]
    assert batch_distances(*map(list, zip(*pairs))).tolist() == [slow_distance(*p) for p in pairs]
    df = spark.createDataFrame([*pairs, (None, "a")], "a string, b string")
    got = [r.s for r in df.select(damerau_similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got[0] == 0.5 and got[-1] is None


def test_blank_lost_at_the_end_is_no_mistake(spark):
    rows = spark.createDataFrame([(f"{a}{b} ",) for a in "abcdefghij" for b in ("xyz", "lmno", "pq rs")], ["query"])
    found = ty.single_pass(rows).filter(F.rtrim("mistake") == F.rtrim("query")).collect()
    assert found and {r.mistake_type for r in found} == {"no-mistake"}
    lost = [s for seed in range(12) for s in ty.single_pass(rows, seed=seed).filter(F.length("mistake") < F.length("query")).collect() if s.mistake == s.query.rstrip()]
    assert not lost


def test_sound_score_differs_from_letter_score(spark):
    from shoplens.operators.vocabulary import pair_scores

    rows = spark.createDataFrame([("colour", "color"), ("cat", "dog"), ("a", "a")], ["wrongword", "rightword"])
    got = {r.wrongword: (round(r.levenshtein_score, 4), round(r.phonetic_score, 4)) for r in pair_scores(rows).collect()}
    assert got == {"colour": (0.8333, 1.0), "cat": (0.0, 0.0), "a": (1.0, 1.0)}


def test_spread_keeps_rows_and_busy_cores(spark):
    from shoplens.operators.scale import spread

    rows = spread(spark.range(1000).coalesce(1))
    assert rows.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert rows.count() == 1000
