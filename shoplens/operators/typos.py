"""Repeatable misspellings of a query column, built from string expressions only.

Every rule maps a text column to an array of variants; ``variants`` explodes them. Random choices
come from a hash of the text and a seed, so results do not depend on partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.text import seeded_int, seeded_unit
from shoplens.operators.cleaning import sample_queries
from shoplens.operators.scale import spread

# Keyboard neighbours in the order they are tried.
KEY_NEIGHBOURS = {
    "q": "was", "w": "qesad", "e": "wrdsf", "r": "etfdg", "t": "rygfh", "y": "tuhgj", "u": "yijhk",
    "i": "uojkl", "o": "ipkl", "p": "ol", "a": "sqzwx", "s": "adwxqez", "d": "sfecrxw", "f": "gdrvct",
    "g": "fhtbvyr", "h": "jgynbu", "j": "hkunmi", "k": "jlimo", "l": "kop", "z": "xas", "x": "zcsd",
    "c": "xvdf", "v": "bcfg", "b": "vngh", "n": "mbjh", "m": "njk",
}

# Vowel replacements.
VOWEL_SWAPS = {
    "a": ["e", "o", "u"],
    "e": ["a", "i", "o"],
    "i": ["a", "e", "ee", "ea"],
    "o": ["a", "e", "u", "oo"],
    "u": ["a", "oo", "o"],
}

# Sound-alike replacements of one, two and three letters.
SLANG_ONE = {
    "c": ["k", "ck", "s"], "d": ["dh", "th"], "f": ["ph", "p"], "g": ["j"], "i": ["y"], "j": ["z", "g"],
    "k": ["c", "ck", "kh"], "p": ["f", "ph"], "s": ["c", "z", "sh"], "t": ["th", "ti", "te", "tee", "tea"],
    "v": ["w"], "w": ["v"], "y": ["i"], "z": ["j", "s"],
}
SLANG_TWO = {
    "ck": ["c", "k", "ch"], "sh": ["ch", "s"], "ch": ["c", "sh", "tch"], "th": ["t", "d", "dh"], "ph": ["f"],
    "oo": ["u"], "ee": ["i"], "al": ["le"], "le": ["al", "el", "il"],
}
SLANG_THREE = {"ear": ["are", "ere"], "are": ["ear", "ere"], "ere": ["ear", "are"]}

# Label ranks; of equal variants the lowest rank names the label.
LABEL_RANKS = {
    "rightword": 1, "word_gap_dilemma": 2, "plural_extend": 3, "vowel_extend": 4, "apostropheS": 5, "ies_ending": 6,
    "vowel_dilemma": 7, "butter_fingers_compulsory": 8, "butter_fingers": 9, "slangwise_wrong_usage": 10,
    "adjacent_swap": 11, "neighbours_swap": 12, "single_missing_letter": 13, "two_missing_letters": 14,
    "remove_consecutive_letters": 15, "double_press_same_key": 16, "wrong_letter_doubled": 17, "head_letters": 18,
    "extra_letters": 19, "vowel_dilemma_p_extend1": 20, "vowel_dilemma_p_extend2": 21, "vow_dil_single_missing": 22,
}

Rule = Callable[[Column], Column]


def _none() -> Column:
    return F.array().cast("array<string>")


def _span(first, last) -> Column:
    """first..last inclusive, empty when last < first."""
    first, last = (F.lit(x) if isinstance(x, int) else x for x in (first, last))
    return F.when(last >= first, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<int>"))


def _head(w: Column, n) -> Column:
    return F.substring(w, F.lit(1), n if isinstance(n, Column) else F.lit(n))


def _tail(w: Column, start: Column) -> Column:
    """From the 1-based ``start`` to the end."""
    return F.substring(w, start, F.length(w))


def _at(w: Column, i: Column, n: int = 1) -> Column:
    return F.substring(w, i, F.lit(n))


def _other_than(w: Column, variants: Column) -> Column:
    return F.filter(variants, lambda v: v != w)


def _replace_groups(w: Column, groups: dict[str, list[str]], size: int = 1) -> Column:
    table = F.create_map(*[x for key, values in groups.items() for x in (F.lit(key), F.array(*map(F.lit, values)))])

    def at(i: Column) -> Column:
        options = F.coalesce(F.try_element_at(table, _at(w, i, size)), _none())
        return F.transform(options, lambda o: F.concat(_head(w, i - 1), o, _tail(w, i + size)))

    return F.flatten(F.transform(_span(1, F.length(w) - (size - 1)), at))


def single_missing(w: Column) -> Column:
    cut = F.filter(_span(1, F.length(w)), lambda i: ~_at(w, i).rlike("^[0-9]$"))
    return F.when(F.length(w) > 2, F.transform(cut, lambda i: F.concat(_head(w, i - 1), _tail(w, i + 1)))).otherwise(_none())


def two_missing(w: Column) -> Column:
    def digit(i: Column) -> Column:
        return _at(w, i).between("0", "9")

    def second(i: Column) -> Column:
        later = F.filter(_span(i + 1, F.length(w)), lambda j: ~digit(j))
        return F.transform(later, lambda j: F.concat(_head(w, i - 1), F.substring(w, i + 1, j - i - 1), _tail(w, j + 1)))

    letters = F.filter(_span(1, F.length(w)), lambda i: ~digit(i))
    return F.when(F.length(w) > 4, F.flatten(F.transform(letters, second))).otherwise(_none())


def vowel_extend(w: Column) -> Column:
    return F.array(F.concat(w, F.lit("e")))


def plural_extend(w: Column) -> Column:
    return F.array(F.concat(w, F.lit("s")), F.concat(w, F.lit("es")))


def apostrophe_s(w: Column) -> Column:
    return F.array(F.concat(w, F.lit("'s")))


def vowel_dilemma(w: Column) -> Column:
    return _other_than(w, _replace_groups(w, VOWEL_SWAPS))


def vowel_plural_s(w: Column) -> Column:
    return vowel_dilemma(F.concat(w, F.lit("s")))


def vowel_plural_es(w: Column) -> Column:
    return vowel_dilemma(F.concat(w, F.lit("es")))


def vowel_missing(w: Column) -> Column:
    cut = F.filter(_span(1, F.length(w)), lambda i: ~_at(w, i).rlike("^[0-9]$"))
    shorter = F.transform(cut, lambda i: F.concat(_head(w, i - 1), _tail(w, i + 1)))
    return _other_than(w, F.flatten(F.transform(shorter, lambda s: _replace_groups(s, VOWEL_SWAPS))))


def adjacent_swap(w: Column) -> Column:
    return F.transform(
        _span(2, F.length(w)), lambda i: F.concat(_head(w, i - 2), _at(w, i), _at(w, i - 1), _tail(w, i + 1))
    )


def neighbours_swap(w: Column) -> Column:
    swapped = F.transform(
        _span(2, F.length(w) - 1),
        lambda i: F.concat(_head(w, i - 2), _at(w, i + 1), _at(w, i), _at(w, i - 1), _tail(w, i + 2)),
    )
    return F.when(F.length(w) >= 5, swapped).otherwise(_none())


def butter_fingers_compulsory(w: Column) -> Column:
    return _other_than(w, _replace_groups(w, {k: list(v[:3]) for k, v in KEY_NEIGHBOURS.items()}))


def _key_table() -> Column:
    return F.create_map(*[F.lit(x) for pair in KEY_NEIGHBOURS.items() for x in pair])


def butter_fingers(seed: int = 7, probability: float = 0.2, copies: int = 100, max_changes: int = 4) -> Rule:
    """Seeded keyboard slips: ``copies`` copies, each letter slipping with ``probability``.

    The change budget is shared by all copies: once more than ``max_changes`` letters have slipped
    in total, the rest stay unchanged. So at most max_changes + 1 slips exist; the letters skipped
    before each are drawn from the geometric law, which needs one draw per slip, not per letter.
    """

    def rule(w: Column) -> Column:
        keys = _key_table()
        places = F.filter(_span(1, F.length(w)), lambda i: F.try_element_at(keys, _at(w, i)).isNotNull())
        count = F.greatest(F.size(places), F.lit(1))
        numbers = F.sequence(F.lit(0), F.lit(max_changes))

        def skipped(k: Column) -> Column:
            u = seeded_int("skip", seed, F.lit(1_000_000), w, k.cast("string")) / F.lit(1_000_000.0)
            return F.floor(F.log(1.0 - u) / math.log(1.0 - probability)).cast("int")

        steps = F.aggregate(
            numbers,
            F.array().cast("array<int>"),
            lambda done, k: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(-1)) + 1 + skipped(k))),
        )
        slips = F.filter(
            F.transform(
                steps,
                lambda t, k: F.struct(
                    F.floor(t / count).alias("copy"),
                    F.try_element_at(places, (t % count + 1).cast("int")).alias("place"),
                    k.alias("number"),
                ),
            ),
            lambda s: (s["copy"] < copies) & s["place"].isNotNull(),
        )

        def letter(s: Column) -> Column:
            options = F.try_element_at(keys, _at(w, s["place"]))
            return F.substring(options, seeded_int("key", seed, F.length(options), w, s["number"].cast("string")) + 1, F.lit(1))

        def apply(c: Column) -> Column:
            mine = F.filter(slips, lambda s: s["copy"] == c)
            return F.aggregate(
                mine, w, lambda text, s: F.concat(_head(text, s["place"] - 1), letter(s), _tail(text, s["place"] + 1))
            )

        slipped = F.array_distinct(F.transform(slips, lambda s: s["copy"]))
        return F.array_distinct(_other_than(w, F.transform(slipped, apply)))

    return rule


def double_press(w: Column) -> Column:
    return F.transform(_span(1, F.length(w)), lambda i: F.concat(_head(w, i), _at(w, i), _tail(w, i + 1)))


def wrong_doubled(w: Column) -> Column:
    """Where letters i and i+1 are equal, drop one of them and double another letter."""
    n = F.length(w)

    def moved(i: Column) -> Column:
        before = F.transform(
            _span(1, i - 1),
            lambda j: F.concat(_head(w, j), _at(w, j), F.substring(w, j + 1, i - j - 1), _tail(w, i + 1)),
        )
        after = F.transform(
            _span(i + 1, n),
            lambda j: F.concat(_head(w, i - 1), F.substring(w, i + 1, j - i - 1), _at(w, j), _at(w, j), _tail(w, j + 1)),
        )
        return F.concat(before, after)

    doubled = F.filter(_span(1, n - 1), lambda i: _at(w, i) == _at(w, i + 1))
    return _other_than(w, F.flatten(F.transform(doubled, moved)))


def extra_letters(w: Column) -> Column:
    """A keyboard neighbour before or after each letter."""
    keys = _key_table()

    def at(i: Column) -> Column:
        options = F.coalesce(F.try_element_at(keys, _at(w, i)), F.lit(""))
        letters = F.transform(_span(1, F.length(options)), lambda k: F.substring(options, k, F.lit(1)))
        around = lambda x: F.array(F.concat(_head(w, i - 1), x, _tail(w, i)), F.concat(_head(w, i), x, _tail(w, i + 1)))
        return F.flatten(F.transform(letters, around))

    return F.flatten(F.transform(_span(1, F.length(w)), at))


def slang(w: Column) -> Column:
    return F.concat(
        _replace_groups(w, SLANG_ONE), _replace_groups(w, SLANG_TWO, 2), _replace_groups(w, SLANG_THREE, 3)
    )


def ies_ending(w: Column) -> Column:
    return F.when(w.endswith("is"), F.array(F.concat(_head(w, F.length(w) - 2), F.lit("ies")))).otherwise(_none())


def remove_consecutive(w: Column, working: bool = False) -> Column:
    """Collapse repeated letters. The rule never yields a variant unless ``working`` is asked for."""
    if not working:
        return F.when(F.lit(True), _none())
    return _other_than(w, F.array(F.regexp_replace(w, r"(.)\1+", "$1")))


def word_gap(w: Column) -> Column:
    """A hyphen or underscore between any two letters. Not part of the full set."""
    return F.flatten(
        F.transform(
            _span(2, F.length(w)),
            lambda i: F.array(*[F.concat(_head(w, i - 1), F.lit(mark), _tail(w, i)) for mark in ("-", "_")]),
        )
    )


def head_letters(w: Column) -> Column:
    """Prefixes from three letters up to three short of the end. Not part of the full set."""
    return F.transform(_span(3, F.length(w) - 3), lambda i: _head(w, i))


# rules of the full set, by label
RULES: dict[str, Rule] = {
    "single_missing_letter": single_missing,
    "two_missing_letters": two_missing,
    "remove_consecutive_letters": remove_consecutive,
    "vowel_dilemma": vowel_dilemma,
    "vowel_extend": vowel_extend,
    "plural_extend": plural_extend,
    "vowel_dilemma_p_extend1": vowel_plural_s,
    "vowel_dilemma_p_extend2": vowel_plural_es,
    "vow_dil_single_missing": vowel_missing,
    "apostropheS": apostrophe_s,
    "adjacent_swap": adjacent_swap,
    "neighbours_swap": neighbours_swap,
    "butter_fingers": butter_fingers(),
    "butter_fingers_compulsory": butter_fingers_compulsory,
    "double_press_same_key": double_press,
    "slangwise_wrong_usage": slang,
    "ies_ending": ies_ending,
    "wrong_letter_doubled": wrong_doubled,
    "extra_letters": extra_letters,
}


def variants(df: DataFrame, rule: Rule, label: str, query: str = "query") -> DataFrame:
    """query, mistake, mistake_type: the distinct variants of one rule."""
    rows = df.select(F.col(query).alias("_text"))
    text = F.col("_text")
    # outer explode: for an inner one the optimizer adds a filter that computes the array a second time
    found = F.explode_outer(F.array_distinct(rule(text))).alias("mistake")
    return rows.select(text.alias("query"), found).filter(F.col("mistake").isNotNull()).withColumn("mistake_type", F.lit(label))


def _with_rank(made: Column, rank: int) -> Column:
    return F.transform(made, lambda v: F.struct(v.alias("mistake"), F.lit(rank).alias("rank")))


def with_all_variants(
    df: DataFrame, query: str = "query", rules: dict[str, Rule] | None = None, out: str = "variants"
) -> DataFrame:
    """Add the array of (mistake, rank) of all rules, one entry per mistake with its lowest rank.

    Equal variants meet inside the row after an array sort, so the many variants are never shuffled;
    the few queries are, once, to spread the work.
    """
    w = F.col(query)
    ranked = [F.array(F.struct(w.alias("mistake"), F.lit(LABEL_RANKS["rightword"]).alias("rank")))]
    for label, rule in (rules or RULES).items():
        made = F.filter(rule(w), lambda v: (v != w) & ~v.startswith("-") & ~v.endswith("-"))
        ranked.append(_with_rank(made, LABEL_RANKS[label]))
    # the original never appears when it starts or ends with a hyphen
    whole = F.filter(F.concat(*ranked), lambda x: ~x["mistake"].startswith("-") & ~x["mistake"].endswith("-"))
    # each entry beside the one before it: the first of equal mistakes has the lowest rank
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform("_sorted", lambda x: x["mistake"]))
    paired = F.zip_with("_sorted", before, lambda x, last: F.when(x.isNotNull() & ~x["mistake"].eqNullSafe(last), x))
    kept = F.filter(paired, lambda x: x.isNotNull())
    return spread(df).withColumn("_sorted", F.array_sort(whole)).withColumn(out, kept).drop("_sorted")


def _label(rank: Column) -> Column:
    names = F.create_map(*[x for label, r in LABEL_RANKS.items() for x in (F.lit(r), F.lit(label))])
    return F.try_element_at(names, rank)


def all_variants(df: DataFrame, query: str = "query", rules: dict[str, Rule] | None = None) -> DataFrame:
    """query, mistake, mistake_type over all rules, the original included as rightword."""
    rows = with_all_variants(df.select(F.col(query).alias("query")), "query", rules)
    item = rows.select("query", F.explode_outer("variants").alias("v")).filter(F.col("v").isNotNull())
    return item.select("query", F.col("v.mistake").alias("mistake"), _label(F.col("v.rank")).alias("mistake_type"))


def pick_one(df: DataFrame, query: str = "query", seed: int = 7, rules: dict[str, Rule] | None = None) -> DataFrame:
    """One seeded variant per query."""
    rows = with_all_variants(df.select(F.col(query).alias("query")), "query", rules)
    chosen = F.try_element_at("variants", seeded_int("pick", seed, F.greatest(F.size("variants"), F.lit(1)), F.col("query")) + 1)
    return rows.withColumn("v", chosen).select(
        "query", F.col("v.mistake").alias("mistake_queries"), _label(F.col("v.rank")).alias("mistake_type")
    )


def spell_test_set(
    df: DataFrame, query: str = "query", max_length: int = 25, fraction: float = 0.5, limit: int = 2000, seed: int = 7
) -> DataFrame:
    """A misspelling test set: sampled short queries with one variant each.

    Length filter and sampling only look at the query, so they go first: variants of texts that
    would be dropped afterwards are never made.
    """
    return pick_one(sample_queries(df, query, max_length, fraction, limit, seed), query, seed)


def space_break(df: DataFrame, tokens: str = "query", seed: int = 7) -> DataFrame:
    """A space inside one seeded word of the token list, before a seeded letter."""
    rows = df.select(F.col(tokens).alias("_words"))
    words, joined = F.col("_words"), F.array_join("_words", " ")
    word = seeded_int("word", seed, F.greatest(F.size(words), F.lit(1)), joined)
    target = F.try_element_at(words, word + 1)
    place = seeded_int("letter", seed, F.greatest(F.length(target), F.lit(1)), joined)

    def broken(t: Column, i: Column) -> Column:
        split = F.concat(_head(t, place), F.lit(" "), _tail(t, place + 1))
        return F.when((i == word) & (F.length(t) > 0), split).otherwise(t)

    return rows.select(joined.alias("query"), F.array_join(F.transform(words, broken), " ").alias("bad_queries"))


# Fixed values of the single-pass generator.
SINGLE_PASS_KINDS = [
    "double-letter", "missing-char", "extra-char", "reversed-letters", "space-mistake", "keyboard-confusion",
    "auto-correct", "phonetic-error", "homophone", "abbreviations", "skipping-letters", "predictive-text",
]
SINGLE_PASS_KEYS = {
    "q": "was", "w": "qesad", "e": "wrsdf", "r": "etdfg", "t": "ryfgh", "y": "tughj", "u": "yihjk", "i": "uojkl",
    "o": "ipkl", "p": "ol", "a": "qwsz", "s": "wedxza", "d": "erfcxs", "f": "rtgvcd", "g": "tyhbvf", "h": "yujnbg",
    "j": "uikmnh", "k": "iol,mj", "l": "opk.", "z": "asx", "x": "zsdc", "c": "xvdf", "v": "cfgb", "b": "vghn",
    "n": "bhjm", "m": "njk", ",": "mkl", ".": "lk", "/": ".", "1": "2q", "2": "13qw", "3": "24we", "4": "35er",
    "5": "46rt", "6": "57ty", "7": "68yu", "8": "79ui", "9": "80io", "0": "9p", "-": "0p", "=": "-", "`": "1",
    "~": "!", "!": "@", "@": "#", "#": "$", "$": "%", "%": "^", "^": "&", "&": "*", "*": "(", "(": ")", ")": "_",
    "_": "+", "+": "=", "{": "[", "[": "{", "}": "]", "]": "}", "\\": "|", "|": "\\", ":": ";", ";": ":",
    '"': "'", "'": '"', "<": ",", ">": ".", "?": "/",
}
SINGLE_PASS_TEXT = {
    "auto-correct": {"teh": "the", "recieve": "receive", "wierd": "weird"},
    "phonetic-error": {"ph": "f", "k": "c", "s": "z"},
    "homophone": {"to": "too", "their": "there", "hear": "here"},
    "abbreviations": {"because": "bc", "information": "info", "with out": "wo"},
}
PREDICTED_WORDS = ["the", "a", "is", "of", "and"]
CHANCES = {
    "double-letter": 0.3, "missing-char": 0.3, "extra-char": 0.2, "reversed-letters": 0.2, "space-mistake": 0.2,
    "skipping-letters": 0.1, "predictive-text": 0.1, "text": 0.1,
}


def _single_pass_keyboard(w: Column, seed: int) -> Column:
    keys = F.create_map(*[F.lit(x) for pair in SINGLE_PASS_KEYS.items() for x in pair])
    changes = seeded_int("changes", seed, F.lit(3), w)
    text = w
    for turn in range(2):
        place = seeded_int(f"place{turn}", seed, F.greatest(F.length(w), F.lit(1)), w) + 1
        options = F.try_element_at(keys, _at(text, place))
        pick = seeded_int(f"key{turn}", seed, F.greatest(F.length(options), F.lit(1)), w) + 1
        slipped = F.concat(_head(text, place - 1), F.substring(options, pick, F.lit(1)), _tail(text, place + 1))
        text = F.when((changes > turn) & options.isNotNull(), slipped).otherwise(text)
    return text


def single_pass(df: DataFrame, query: str = "query", seed: int = 7) -> DataFrame:
    """One of twelve mistake kinds per query, applied with the kind's chance.

    The label is no-mistake when the distinct words did not change. Added: mistake, mistake_type.
    """
    w, n = F.col(query), F.length(query)
    below = lambda slot, chance: seeded_unit(slot, seed, w) < chance
    at = seeded_int("at", seed, F.greatest(n, F.lit(1)), w)
    doubled = F.concat(_head(w, at), _at(w, at + 1), _tail(w, at + 1))
    pair = seeded_int("at", seed, F.greatest(n - 1, F.lit(1)), w)
    reverse = F.concat(_head(w, pair), _at(w, pair + 2), _at(w, pair + 1), _tail(w, pair + 3))
    # only the first blank goes
    blank = F.instr(w, " ")
    joined = F.concat(_head(w, blank - 1), _tail(w, blank + 1))
    spaced = F.when(below("side", 0.5), F.concat(_head(w, at), F.lit(" "), _tail(w, at + 1))).otherwise(joined)

    def skip(text: Column, slot: str) -> Column:
        i = seeded_int(slot, seed, F.greatest(F.length(text) - 1, F.lit(1)), w)
        return F.concat(_head(text, i), _tail(text, i + 3))

    skipped = F.when(seeded_int("skips", seed, F.lit(2), w) == 0, skip(w, "skip0")).otherwise(skip(skip(w, "skip0"), "skip1"))
    words = F.split(w, " ")
    where = seeded_int("word", seed, F.size(words), w)
    guess = F.element_at(F.array(*map(F.lit, PREDICTED_WORDS)), seeded_int("guess", seed, F.lit(len(PREDICTED_WORDS)), w) + 1)
    predicted = F.array_join(F.transform(words, lambda t, i: F.when(i == where, guess).otherwise(t)), " ")

    def texts(kind: str) -> Column:
        out = w
        for old, new in SINGLE_PASS_TEXT[kind].items():
            out = F.when(below(f"{kind}:{old}", CHANCES["text"]), F.replace(out, F.lit(old), F.lit(new))).otherwise(out)
        return out

    made = {
        "double-letter": F.when(below("go", CHANCES["double-letter"]), doubled),
        "missing-char": F.when((n > 3) & below("go", CHANCES["missing-char"]), F.concat(_head(w, at), _tail(w, at + 2))),
        "extra-char": F.when(below("go", CHANCES["extra-char"]), doubled),
        "reversed-letters": F.when((n > 1) & below("go", CHANCES["reversed-letters"]), reverse),
        "space-mistake": F.when((blank > 0) & below("go", CHANCES["space-mistake"]), spaced),
        "keyboard-confusion": _single_pass_keyboard(w, seed),
        **{kind: texts(kind) for kind in SINGLE_PASS_TEXT},
        "skipping-letters": F.when((n > 3) & below("go", CHANCES["skipping-letters"]), skipped),
        "predictive-text": F.when(below("go", CHANCES["predictive-text"]), predicted),
    }
    kind_index = seeded_int("kind", seed, F.lit(len(SINGLE_PASS_KINDS)), w)
    mistake = F.lit(None).cast("string")
    for i, kind in enumerate(SINGLE_PASS_KINDS):
        mistake = F.when(F.col("_kind") == i, made[kind]).otherwise(mistake)
    usable = w.isNotNull() & (n > 0)
    out = df.withColumn("_kind", kind_index).withColumn("_made", F.when(usable, F.coalesce(mistake, w)).otherwise(w))
    # blanks at the end make no word
    distinct = lambda text: F.array_distinct(F.split(F.regexp_replace(text, r"\s+$", ""), r"\s+"))
    same = distinct(w) == distinct(F.col("_made"))
    kinds = F.array(*map(F.lit, SINGLE_PASS_KINDS))
    unchanged = ~usable | same
    return out.withColumns(
        {
            "mistake": F.when(unchanged, w).otherwise(F.col("_made")),
            "mistake_type": F.when(F.coalesce(unchanged, F.lit(True)), F.lit("no-mistake")).otherwise(
                F.element_at(kinds, F.col("_kind") + 1)
            ),
        }
    ).drop("_kind", "_made")


def with_edit_distance(df: DataFrame, query: str = "query", mistake: str = "mistake") -> DataFrame:
    return df.withColumn("edit_distance", F.levenshtein(query, mistake))
