"""Typo rules over words of conversations and over product queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.operators import quality as qu
from shoplens.operators import typos as ty
from shoplens.operators.vocabulary import pair_scores
from shoplens.plans.domain import NAMED_QUERIES, WORDS, named_queries, similarity_sql, sound_sql, table, words
from shoplens.plans.registry import flat, query


def _groups_sql(name: str, groups: dict[str, list[str]], size: int) -> str:
    """CTE with (size, key, value) of a replacement table."""
    rows = ", ".join(f"({size}, '{k}', '{v}')" for k, values in groups.items() for v in values)
    return f"{name}(size, key, value) AS (VALUES {rows})"


KEYS = {k: list(v) for k, v in ty.KEY_NEIGHBOURS.items()}
TABLES_SQL = ", ".join(
    [
        _groups_sql("vowel", ty.VOWEL_SWAPS, 1), _groups_sql("keyed", KEYS, 1),
        _groups_sql("first3", {k: v[:3] for k, v in KEYS.items()}, 1),
        _groups_sql("slang1", ty.SLANG_ONE, 1), _groups_sql("slang2", ty.SLANG_TWO, 2), _groups_sql("slang3", ty.SLANG_THREE, 3),
    ]
)


def replaced(source: str, groups: str) -> str:
    """(w, m) by a replacement table over the CTE ``source``(o, w, i, n), o being the original."""
    return f"SELECT o AS w, substr(w, 1, i - 1) || value || substr(w, i + size) AS m FROM {source} JOIN {groups} ON substr(w, i, size) = key"


def places(name: str, source: str, text: str = "w") -> str:
    return f"{name} AS (SELECT w AS o, {text} AS w, unnest(range(1, length({text}) + 1)) AS i, length({text}) AS n FROM {source})"


def hash_sql(slot: str, seed: int, bound: str, *parts: str) -> str:
    text = " || '|' || ".join([*parts, f"'{slot}'", f"'{seed}'"])
    return f"((('0x' || substr(md5({text}), 1, 8))::BIGINT) % ({bound}))"


# skipped letters before slip k, then positions of the slips over 100 copies of the key letters
BUTTER_SQL = f"""ordered(key, value, pos) AS (VALUES {", ".join(f"('{k}', '{c}', {i})" for k, v in KEYS.items() for i, c in enumerate(v))}),
kp AS (SELECT w, list_filter(range(1, length(w) + 1), lambda i: regexp_matches(w[i], '[a-z]')) AS places FROM base),
sk AS (SELECT w, places, k, 1 + CAST(floor(ln(1.0::DOUBLE - {hash_sql('skip', 7, '1000000', 'w', 'CAST(k AS VARCHAR)')} / 1000000.0::DOUBLE) / ln(0.8::DOUBLE)) AS INTEGER) AS step
  FROM kp, (SELECT unnest(range(0, 5)) AS k) WHERE len(places) > 0),
ps AS (SELECT w, places, k, -1 + CAST(sum(step) OVER (PARTITION BY w ORDER BY k) AS BIGINT) AS t FROM sk),
sl AS (SELECT w, k, t // len(places) AS copy, places[t % len(places) + 1] AS place FROM ps WHERE t // len(places) < 100),
ltr AS (SELECT w, copy, place, opts[{hash_sql('key', 7, 'length(opts)', 'w', 'CAST(k AS VARCHAR)')} + 1] AS x FROM (
  SELECT sl.*, (SELECT string_agg(value, '' ORDER BY pos) FROM ordered WHERE key = w[place]) AS opts FROM sl)),
made AS (SELECT w, copy, array_to_string(list_transform(range(1, length(w) + 1), lambda i: coalesce(letters[i], w[i])), '') AS m FROM (
  SELECT w, copy, map_from_entries(list((place, x))) AS letters FROM ltr GROUP BY w, copy))"""


# every rule over the CTE base(w): rows (w, m); variants equal to the word and repeats go at the end
RULE_SQL = {
    "single_missing_letter": "SELECT o AS w, substr(w, 1, i - 1) || substr(w, i + 1) AS m FROM ix WHERE n > 2 AND NOT regexp_matches(w[i], '[0-9]')",
    "two_missing_letters": """SELECT a.o AS w, substr(a.w, 1, a.i - 1) || substr(a.w, a.i + 1, b.i - a.i - 1) || substr(a.w, b.i + 1) AS m
      FROM ix a JOIN ix b ON a.o = b.o AND b.i > a.i WHERE a.n > 4 AND NOT regexp_matches(a.w[a.i], '[0-9]') AND NOT regexp_matches(b.w[b.i], '[0-9]')""",
    "vowel_dilemma": replaced("ix", "vowel"),
    "vowel_extend": "SELECT w, w || 'e' AS m FROM base",
    "plural_extend": "SELECT w, w || unnest(['s', 'es']) AS m FROM base",
    "vowel_dilemma_p_extend1": replaced("ix_s", "vowel") + " WHERE substr(w, 1, i - 1) || value || substr(w, i + size) <> w",
    "vowel_dilemma_p_extend2": replaced("ix_es", "vowel") + " WHERE substr(w, 1, i - 1) || value || substr(w, i + size) <> w",
    "vow_dil_single_missing": replaced("ix_cut", "vowel") + " WHERE substr(w, 1, i - 1) || value || substr(w, i + size) <> o",
    "apostropheS": "SELECT w, w || '''s' AS m FROM base",
    "adjacent_swap": "SELECT o AS w, substr(w, 1, i - 2) || w[i] || w[i - 1] || substr(w, i + 1) AS m FROM ix WHERE i >= 2",
    "neighbours_swap": "SELECT o AS w, substr(w, 1, i - 2) || w[i + 1] || w[i] || w[i - 1] || substr(w, i + 2) AS m FROM ix WHERE i >= 2 AND i < n AND n >= 5",
    "butter_fingers": "SELECT w, m FROM made",
    "butter_fingers_compulsory": replaced("ix", "first3"),
    "double_press_same_key": "SELECT o AS w, substr(w, 1, i) || w[i] || substr(w, i + 1) AS m FROM ix",
    "slangwise_wrong_usage": f"{replaced('ix', 'slang1')} UNION ALL {replaced('ix', 'slang2')} UNION ALL {replaced('ix', 'slang3')}",
    "ies_ending": "SELECT w, substr(w, 1, length(w) - 2) || 'ies' AS m FROM base WHERE w LIKE '%is'",
    "wrong_letter_doubled": """SELECT * FROM (SELECT a.o AS w, CASE WHEN b.i < a.i THEN substr(a.w, 1, b.i) || a.w[b.i] || substr(a.w, b.i + 1, a.i - b.i - 1) || substr(a.w, a.i + 1)
      ELSE substr(a.w, 1, a.i - 1) || substr(a.w, a.i + 1, b.i - a.i - 1) || a.w[b.i] || a.w[b.i] || substr(a.w, b.i + 1) END AS m
      FROM ix a JOIN ix b ON a.o = b.o AND a.i <> b.i WHERE a.i < a.n AND a.w[a.i] = a.w[a.i + 1]) WHERE m <> w""",
    "extra_letters": """SELECT o AS w, substr(w, 1, i - 1) || value || substr(w, i) AS m FROM ix JOIN keyed ON w[i] = key
      UNION ALL SELECT o AS w, substr(w, 1, i) || value || substr(w, i + 1) AS m FROM ix JOIN keyed ON w[i] = key""",
}
SHARED_SQL = ", ".join(
    [
        TABLES_SQL, places("ix", "base"), places("ix_s", "base", "(w || 's')"), places("ix_es", "base", "(w || 'es')"),
        "cut AS (SELECT o, substr(w, 1, i - 1) || substr(w, i + 1) AS w FROM ix WHERE NOT regexp_matches(w[i], '[0-9]'))",
        "ix_cut AS (SELECT o, w, unnest(range(1, length(w) + 1)) AS i, length(w) AS n FROM cut)", BUTTER_SQL,
    ]
)
WORD_BASE = f"{WORDS}, base AS (SELECT word AS w FROM words)"

# rules whose variants stay few per word: rows in full
LINEAR = ["single_missing_letter", "vowel_extend", "plural_extend", "apostropheS", "adjacent_swap", "neighbours_swap", "double_press_same_key", "ies_ending", "wrong_letter_doubled"]
QUERY_NAMES = {
    "single_missing_letter": "typo_single_missing", "two_missing_letters": "typo_two_missing", "vowel_extend": "typo_vowel_extend",
    "plural_extend": "typo_plural_extend", "apostropheS": "typo_apostrophe", "vowel_dilemma": "typo_vowel_dilemma",
    "vowel_dilemma_p_extend1": "typo_vowel_plural1", "vowel_dilemma_p_extend2": "typo_vowel_plural2", "vow_dil_single_missing": "typo_vowel_missing",
    "adjacent_swap": "typo_adjacent_swap", "neighbours_swap": "typo_neighbours_swap", "butter_fingers_compulsory": "typo_butter_fingers_compulsory",
    "double_press_same_key": "typo_double_press", "wrong_letter_doubled": "typo_wrong_doubled", "extra_letters": "typo_extra_letters",
    "slangwise_wrong_usage": "typo_slang", "ies_ending": "typo_ies_ending",
}


def word_summary(df):
    return df.groupBy("query").agg(
        F.count(F.lit(1)).alias("variants"), F.min("mistake").alias("first"), F.max("mistake").alias("last"),
        F.sum(F.length("mistake")).alias("letters"),
    )


SUMMARY_SQL = "SELECT w AS query, count(*) AS variants, min(m) AS first, max(m) AS last, CAST(sum(length(m)) AS BIGINT) AS letters FROM v GROUP BY w"


def _register(label: str, name: str) -> None:
    rows = f"v AS (SELECT DISTINCT w, m FROM ({RULE_SQL[label]}))"
    rule = ty.RULES[label]
    if label in LINEAR:
        sql = f"WITH {WORD_BASE}, {SHARED_SQL}, {rows} SELECT w AS query, m AS mistake, '{label}' AS mistake_type FROM v"

        def run(spark, d):
            return ty.variants(words(spark, d), rule, label, "word")
    else:
        sql = f"WITH {WORD_BASE}, {SHARED_SQL}, {rows} {SUMMARY_SQL}"

        def run(spark, d):
            return word_summary(ty.variants(words(spark, d), rule, label, "word"))

    query(name, sql)(run)


# single_missing drops a variant equal to the word and adjacent_swap keeps it; the SQL above does the same
for _label, _name in QUERY_NAMES.items():
    _register(_label, _name)


@query(
    "typo_gap",
    f"WITH {WORD_BASE}, {places('ix', 'base')} SELECT o AS query, substr(w, 1, i - 1) || unnest(['-', '_']) || substr(w, i) AS mistake, 'word_gap_dilemma' AS mistake_type FROM ix WHERE i >= 2",
)
def _(spark, d):
    return ty.variants(words(spark, d), ty.word_gap, "word_gap_dilemma", "word")


@query(
    "typo_head_letters",
    f"WITH {WORD_BASE}, {places('ix', 'base')} SELECT o AS query, substr(w, 1, i) AS mistake, 'head_letters' AS mistake_type FROM ix WHERE i >= 3 AND i <= n - 3",
)
def _(spark, d):
    return ty.variants(words(spark, d), ty.head_letters, "head_letters", "word")


@query("typo_remove_consecutive", f"WITH {WORD_BASE} SELECT w AS query, w AS mistake, 'x' AS mistake_type FROM base WHERE 1 = 0")
def _(spark, d):
    return ty.variants(words(spark, d), ty.remove_consecutive, "remove_consecutive_letters", "word")


@query(
    "typo_butter_fingers",
    f"WITH {WORD_BASE}, {BUTTER_SQL} SELECT DISTINCT w AS query, m AS mistake, 'butter_fingers' AS mistake_type FROM made WHERE m <> w",
)
def _(spark, d):
    return ty.variants(words(spark, d), ty.RULES["butter_fingers"], "butter_fingers", "word")


QUERY_BASE = f"{NAMED_QUERIES}, base AS (SELECT query AS w FROM named_queries)"
ALL_SQL = (
    f"WITH {QUERY_BASE}, {SHARED_SQL}, u AS ("
    + " UNION ALL ".join(f"SELECT w, m, {ty.LABEL_RANKS[label]} AS r FROM ({sql})" for label, sql in RULE_SQL.items())
    + """), v AS (SELECT w, m, min(r) AS r FROM (SELECT * FROM u WHERE m <> w UNION ALL SELECT w, w, 1 FROM base)
      WHERE m NOT LIKE '-%' AND m NOT LIKE '%-' GROUP BY w, m)"""
)
LABEL_CASE = "CASE r " + " ".join(f"WHEN {r} THEN '{n}'" for n, r in ty.LABEL_RANKS.items()) + " END"


@query(
    "typo_all_variants",
    f"{ALL_SQL} SELECT w AS query, {LABEL_CASE} AS mistake_type, count(*) AS variants, min(m) AS first, max(m) AS last FROM v GROUP BY 1, 2",
)
def _(spark, d):
    rows = ty.all_variants(named_queries(spark, d).select("query"))
    return rows.groupBy("query", "mistake_type").agg(F.count(F.lit(1)).alias("variants"), F.min("mistake").alias("first"), F.max("mistake").alias("last"))


@query(
    "typo_pick_one",
    f"""{ALL_SQL}, o AS (SELECT w, m, r, row_number() OVER (PARTITION BY w ORDER BY m) - 1 AS i, count(*) OVER (PARTITION BY w) AS c FROM v)
    SELECT w AS query, m AS mistake_queries, {LABEL_CASE} AS mistake_type FROM o WHERE i = {hash_sql('pick', 7, 'c', 'w')}""",
)
def _(spark, d):
    return ty.pick_one(named_queries(spark, d).select("query"))


@query(
    "typo_test_set",
    f"""{ALL_SQL}, o AS (SELECT w, m, r, row_number() OVER (PARTITION BY w ORDER BY m) - 1 AS i, count(*) OVER (PARTITION BY w) AS c FROM v)
    SELECT w AS query, m AS mistake_queries, {LABEL_CASE} AS mistake_type FROM o WHERE i = {hash_sql('pick', 7, 'c', 'w')}
    AND length(w) <= 25 AND {hash_sql('sample', 7, '1000000', 'w')} < 500000 ORDER BY w LIMIT 2000""",
)
def _(spark, d):
    return ty.spell_test_set(named_queries(spark, d).select("query"))


@query(
    "voc_spell_variants",
    f"{ALL_SQL} SELECT m AS wrongword, count(*) AS rightwords, min(w) AS first FROM v WHERE r > 1 GROUP BY m HAVING count(*) > 1",
)
def _(spark, d):
    rows = ty.all_variants(named_queries(spark, d).select("query")).filter("mistake_type <> 'rightword'")
    return rows.groupBy(F.col("mistake").alias("wrongword")).agg(F.count(F.lit(1)).alias("rightwords"), F.min("query").alias("first")).filter("rightwords > 1")


JOINED = "array_to_string(tokens, ' ')"


@query(
    "arr_space_break",
    f"""WITH {NAMED_QUERIES}, a AS (SELECT tokens, {JOINED} AS j FROM named_queries), b AS (SELECT *, {hash_sql('word', 7, 'len(tokens)', 'j')} AS k FROM a),
    c AS (SELECT *, {hash_sql('letter', 7, 'length(tokens[k + 1])', 'j')} AS p FROM b)
    SELECT j AS query, array_to_string(list_transform(tokens, lambda t, i: CASE WHEN i = k + 1 THEN substr(t, 1, p) || ' ' || substr(t, p + 1) ELSE t END), ' ')
    AS bad_queries FROM c""",
)
def _(spark, d):
    return ty.space_break(named_queries(spark, d), "tokens")


@query("mistake_single_pass")
def _(spark, d):
    return ty.single_pass(named_queries(spark, d).select("query"))


@query(
    "mistake_edit_distance",
    f"""{ALL_SQL}, o AS (SELECT w, m, r, row_number() OVER (PARTITION BY w ORDER BY m) - 1 AS i, count(*) OVER (PARTITION BY w) AS c FROM v)
    SELECT w AS query, m AS mistake_queries, levenshtein(w, m) AS edit_distance, {LABEL_CASE} AS mistake_type FROM o WHERE i = {hash_sql('pick', 7, 'c', 'w')}""",
)
def _(spark, d):
    return flat(ty.with_edit_distance(ty.pick_one(named_queries(spark, d).select("query")), "query", "mistake_queries"))


def corrected(spark, d):
    """Part names against the brand-and-type text standing in for a correction."""
    return table(spark, d, "part").select(
        F.col("p_partkey"), F.col("p_name").alias("query"), F.concat("p_name", F.lit("s")).alias("mistake_queries"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(F.concat_ws(" ", "p_brand", "p_type")).alias("corrected"),
    )


CORRECTED_SQL = """c AS (SELECT p_partkey, p_name AS query, p_name || 's' AS mistake, CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_brand || ' ' || p_type END AS corrected
  FROM part), k AS (SELECT p_partkey, levenshtein(query, mistake) AS md, levenshtein(query, corrected) AS cd FROM c WHERE levenshtein(query, corrected) > 4)"""


@query("spell_distance_rows", f"WITH {CORRECTED_SQL} SELECT p_partkey, md AS mistake_distance, cd AS correction_distance FROM k")
def _(spark, d):
    return flat(qu.spell_distance(corrected(spark, d))[0].select("p_partkey", "mistake_distance", "correction_distance"))


@query(
    "spell_distance",
    f"""WITH {CORRECTED_SQL} SELECT count(*) AS count, round(avg(cd), 6) AS mean, round(stddev_samp(cd), 6) AS stddev, min(cd) AS min, max(cd) AS max,
    round(avg(md), 6) AS avg_mistake_distance FROM k""",
)
def _(spark, d):
    return flat(qu.spell_distance(corrected(spark, d))[1])


@query(
    "join_typo_correction",
    f"""WITH {NAMED_QUERIES}, orig AS (SELECT query, query || 'e' AS mistake_queries FROM named_queries),
    corr AS (SELECT query || 'e' AS query, array_to_string(tokens, ' ') AS corrected FROM named_queries)
    SELECT o.query, mistake_queries, corrected FROM corr c JOIN orig o ON c.query = o.mistake_queries""",
)
def _(spark, d):
    n = named_queries(spark, d)
    original = ty.variants(n, ty.vowel_extend, "vowel_extend").select("query", F.col("mistake").alias("mistake_queries"))
    fixed = n.select(F.concat("query", F.lit("e")).alias("mistake_queries"), F.array_join("tokens", " ").alias("corrected"))
    return original.join(fixed, "mistake_queries")


NEIGHBOUR_SQL = """t AS (SELECT list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS tokens
  FROM conversations),
adj AS (SELECT DISTINCT a AS wrongword, b AS rightword FROM (SELECT unnest(tokens[:-2]) AS a, unnest(tokens[2:]) AS b FROM t WHERE len(tokens) > 1))"""


@query(
    "damerau_similarity",
    f"""WITH {NEIGHBOUR_SQL} SELECT wrongword, rightword,
    round({similarity_sql("wrongword", "rightword")}, 6) AS levenshtein_score, round({similarity_sql(sound_sql("wrongword"), sound_sql("rightword"))}, 6) AS phonetic_score
    FROM adj""",
)
def _(spark, d):
    from shoplens.operators.vocabulary import ngrams

    letters = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    pairs = table(spark, d, "conversations").select(F.explode_outer(ngrams(F.split(letters, " "), 2)).alias("p")).filter(F.col("p").isNotNull()).distinct()
    sides = pairs.select(F.split("p", " ")[0].alias("wrongword"), F.split("p", " ")[1].alias("rightword"))
    return flat(pair_scores(sides).select("wrongword", "rightword", "levenshtein_score", "phonetic_score"))
