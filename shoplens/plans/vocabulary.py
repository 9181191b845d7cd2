"""Vocabulary and corpus queries over product names, conversation texts and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.functions.text import normal_tokens
from shoplens.operators import recommend as re
from shoplens.operators import vocabulary as vo
from shoplens.operators.history import history_affinity
from shoplens.plans.domain import (
    HISTORY, NAMED_QUERIES, NAME_PAIRS, PRODUCTS, SHEET, TURN_QUERIES, WORD_COUNTS, history, name_pairs, named_queries, products,
    similarity_sql, sound_sql, synonyms_sheet, table, tokens_sql, turn_queries, vectors, word_counts,
)
from shoplens.plans.registry import flat, query

ATTRIBUTES = ["name", "brandname", "category"]


def attribute_words_sql() -> str:
    parts = [f"SELECT unnest(list_distinct({tokens_sql(a)})) AS word, sku, category, '{a}' AS attribute FROM products" for a in ATTRIBUTES]
    return f"{PRODUCTS}, aw AS ({' UNION ALL '.join(parts)})"


RIGHT_SQL = f"""{attribute_words_sql()}, c AS (SELECT word, count(DISTINCT sku) AS products FROM aw WHERE length(word) <= 17 GROUP BY 1),
kept AS (SELECT * FROM c WHERE products >= CASE WHEN word IN ('brand', 'small', 'new') THEN 300 ELSE 30 END)"""


def right(spark, d):
    p = products(spark, d)
    rows = vo.attribute_words(p, ATTRIBUTES)
    known = table(spark, d, "part").select(F.lower(F.split("p_brand", "#")[0]).alias("word")).distinct()
    known = known.unionByName(p.filter("name LIKE 'small%' OR name LIKE 'new%'").select(F.split("name", " ")[0].alias("word")).distinct())
    return vo.right_words(rows, known, 17, 30, 300)


@query("voc_right_words", f"WITH {RIGHT_SQL} SELECT word, products FROM kept")
def _(spark, d):
    return right(spark, d)[0]


@query(
    "voc_right_words_entities",
    f"""WITH {RIGHT_SQL} SELECT word, category, count(DISTINCT sku) AS products, round(count(DISTINCT sku) / max(k.products), 6) AS share
    FROM aw JOIN kept k USING (word) WHERE length(word) <= 17 GROUP BY word, category""",
)
def _(spark, d):
    return flat(right(spark, d)[1])


@query(
    "join_semi_anti",
    f"""WITH {WORD_COUNTS}, {PRODUCTS} SELECT word, products FROM word_counts WHERE word IN (SELECT unnest({tokens_sql('text')}) FROM documents)
    AND word NOT IN (SELECT unnest({tokens_sql('text')}) FROM benchmark)""",
)
def _(spark, d):
    keep = table(spark, d, "documents").select(F.explode_outer(normal_tokens(F.col("text"))).alias("word"))
    drop = table(spark, d, "benchmark").select(F.explode_outer(normal_tokens(F.col("text"))).alias("word"))
    return vo.keep_words(word_counts(spark, d), keep, drop.filter("word IS NOT NULL"))


@query(
    "voc_brand_collections",
    f"""WITH t AS (SELECT unnest(list_distinct({tokens_sql("p_name || ' ' || CAST(p_partkey // 2 AS VARCHAR)")})) AS token, p_brand AS brandname FROM part)
    SELECT token, min(brandname) AS brandname, count(*) AS products FROM t GROUP BY token HAVING count(DISTINCT brandname) = 1""",
)
def _(spark, d):
    rows = table(spark, d, "part").select(F.concat_ws(" ", "p_name", F.floor(F.col("p_partkey") / 2).cast("string")).alias("name"), F.col("p_brand").alias("brandname"))
    return vo.single_brand_tokens(rows)


METADATA_SQL = f"""{PRODUCTS}, m AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS attribute, {a} AS phrase, count(DISTINCT sku) AS products, len({tokens_sql(a)}) AS tokens FROM products GROUP BY {a}" for a in ATTRIBUTES
) + ")"


@query("voc_phrase_metadata", f"WITH {METADATA_SQL} SELECT * FROM m")
def _(spark, d):
    return flat(vo.phrase_metadata(products(spark, d), ATTRIBUTES))


@query("voc_phrases_from_attributes", f"WITH {METADATA_SQL} SELECT * FROM m WHERE tokens > 1 AND products >= 5")
def _(spark, d):
    return flat(vo.phrases_from_attributes(products(spark, d), ATTRIBUTES, 5))


@query(
    "voc_derived_phrases",
    f"""WITH {RIGHT_SQL}, t AS (SELECT {tokens_sql("name || ' ' || brandname")} AS k, category FROM products),
    b AS (SELECT a || ' ' || b AS phrase, category, count(*) AS products FROM (SELECT unnest(k[:-2]) AS a, unnest(k[2:]) AS b, category FROM t)
      WHERE a IN (SELECT word FROM kept) AND b IN (SELECT word FROM kept) GROUP BY 1, 2),
    s AS (SELECT *, sum(products) OVER (PARTITION BY phrase) AS total, coalesce(sum(products) OVER (PARTITION BY phrase ORDER BY products DESC, category
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b)
    SELECT phrase, category, products, round(products / total, 6) AS share FROM s WHERE before / total < 0.9""",
)
def _(spark, d):
    p = products(spark, d).withColumn("name", F.concat_ws(" ", "name", "brandname"))
    return flat(vo.derived_phrases(p, right(spark, d)[0], percentile=0.9))


def plural_sql(w: str) -> str:
    return f"""CASE WHEN regexp_matches({w}, '(s|x|z|ch|sh)$') THEN {w} || 'es' WHEN regexp_matches({w}, '[^aeiou]y$')
      THEN substr({w}, 1, length({w}) - 1) || 'ies' ELSE {w} || 's' END"""


PLURAL_SQL = f"{WORD_COUNTS}, plurals AS (SELECT {plural_sql('word')} AS plural, word FROM word_counts WHERE {plural_sql('word')} IN (SELECT word FROM word_counts))"


@query("voc_plural_map", f"WITH {PLURAL_SQL} SELECT plural, word FROM plurals")
def _(spark, d):
    w = word_counts(spark, d)
    return vo.plural_map(w, w)


@query(
    "voc_entity_corpus",
    f"""WITH {PLURAL_SQL}, ents AS (SELECT DISTINCT word AS token, lang AS entity FROM (SELECT unnest({tokens_sql('text')}) AS word, lang FROM documents)),
    u AS (SELECT * FROM ents UNION SELECT plural, entity FROM ents JOIN plurals ON word = token)
    SELECT token, string_agg(DISTINCT entity, '|' ORDER BY entity) AS entities FROM u GROUP BY token""",
)
def _(spark, d):
    ents = table(spark, d, "documents").select(F.explode_outer(normal_tokens(F.col("text"))).alias("token"), F.col("lang").alias("entity"))
    w = word_counts(spark, d)
    return flat(vo.entity_corpus(ents.filter("token IS NOT NULL").distinct(), vo.plural_map(w, w)))


@query(
    "voc_brand_family",
    f"""WITH b AS (SELECT DISTINCT p_brand || ' ' || p_name AS brandname FROM part), f AS (SELECT brandname, {tokens_sql("replace(brandname, '#', '')")}[1] AS family FROM b)
    SELECT family, brandname, count(*) OVER (PARTITION BY family) AS brands FROM f QUALIFY count(*) OVER (PARTITION BY family) >= 30""",
)
def _(spark, d):
    brands = table(spark, d, "part").select(F.concat_ws(" ", F.replace("p_brand", F.lit("#"), F.lit("")), "p_name").alias("clean"), F.concat_ws(" ", "p_brand", "p_name").alias("brandname"))
    rows = vo.brand_families(brands.select("clean").distinct(), "clean", 30)
    return rows.join(brands.distinct(), "clean").select("family", "brandname", "brands")


@query(
    "voc_colour_synonyms",
    f"""WITH {SHEET}, {RIGHT_SQL} SELECT DISTINCT colour, word AS synonym FROM (SELECT lower(keyword) AS colour, unnest(string_split(lower(synonyms), '|')) AS word FROM sheet)
    WHERE word IN (SELECT word FROM kept)""",
)
def _(spark, d):
    return vo.colour_synonyms(synonyms_sheet(spark, d), right(spark, d)[0])


SPLIT_SQL = f"""{WORD_COUNTS}, parts AS (SELECT word FROM word_counts WHERE products >= CASE WHEN length(word) = 1 THEN 60 ELSE 20 END),
h AS (SELECT word AS joined, unnest(list_transform(range(1, length(word)), lambda i: {{'l': substr(word, 1, i), 'r': substr(word, i + 1)}})) AS x FROM word_counts),
splits AS (SELECT joined, x.l AS "left", x.r AS "right" FROM h WHERE x.l IN (SELECT word FROM parts) AND x.r IN (SELECT word FROM parts))"""


@query("voc_split_words", f"WITH {SPLIT_SQL} SELECT * FROM splits")
def _(spark, d):
    w = word_counts(spark, d)
    return vo.split_words(w, w, 20, 60)


@query(
    "voc_split_popular",
    f"""WITH {SPLIT_SQL}, f AS (SELECT query, count(*) AS freq FROM (SELECT unnest(list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) AS query
      FROM (SELECT {tokens_sql('text')} AS k FROM conversations)) GROUP BY 1),
    q AS (SELECT joined, "left" || ' ' || "right" AS query FROM splits)
    SELECT joined, query, coalesce(freq, 0) AS freq FROM q LEFT JOIN f USING (query)
    QUALIFY row_number() OVER (PARTITION BY joined ORDER BY coalesce(freq, 0) DESC, query) = 1""",
)
def _(spark, d):
    w = word_counts(spark, d)
    pairs = turn_queries(spark, d).select(F.explode_outer(vo.ngrams(F.col("tokens"), 2)).alias("query")).filter("query IS NOT NULL")
    return vo.popular_splits(vo.split_words(w, w, 20, 60), pairs.groupBy("query").agg(F.count(F.lit(1)).alias("freq")))


@query(
    "voc_right_queries",
    f"""WITH {NAMED_QUERIES}, {RIGHT_SQL} SELECT query, freq FROM named_queries WHERE freq >= 2
    AND list_has_all((SELECT list(word) FROM kept), tokens)""",
)
def _(spark, d):
    return vo.right_queries(named_queries(spark, d), right(spark, d)[0], 2)


@query(
    "voc_filter_categories",
    """WITH t2 AS (SELECT DISTINCT p_name AS token, p_type AS l1l2 FROM part), t3 AS (SELECT DISTINCT p_name AS token, p_brand AS l1l3 FROM part WHERE p_size > 45),
    m AS (SELECT DISTINCT p_brand AS l1l3, p_type AS l1l2 FROM part WHERE p_size <= 5)
    SELECT token, string_agg(DISTINCT l1l2, '|' ORDER BY l1l2) AS categories FROM t2 WHERE EXISTS (SELECT 1 FROM t3 JOIN m USING (l1l3)
      WHERE t3.token = t2.token AND m.l1l2 = t2.l1l2) GROUP BY token""",
)
def _(spark, d):
    p = table(spark, d, "part").select(F.col("p_name").alias("token"), F.col("p_type").alias("l1l2"), F.col("p_brand").alias("l1l3"), "p_size")
    return flat(vo.consistent_categories(p.select("token", "l1l2"), p.filter("p_size > 45").select("token", "l1l3"), p.filter("p_size <= 5").select("l1l3", "l1l2")))


@query(
    "voc_filter_external",
    f"""WITH {RIGHT_SQL}, v AS (SELECT DISTINCT lower(p_name || ' ' || p_brand) AS wrongword, CASE WHEN p_size % 2 = 0 THEN p_name ELSE lower(p_type) END AS rightword FROM part),
    v2 AS (SELECT * FROM v UNION SELECT DISTINCT string_split(p_name, ' ')[1], string_split(p_name, ' ')[2] FROM part)
    SELECT wrongword, rightword, CASE WHEN len({tokens_sql('rightword')}) > 1 THEN 'phrase' WHEN len({tokens_sql('wrongword')}) > 1 THEN 'synonym' ELSE 'word' END AS kind
    FROM v2 WHERE list_has_all((SELECT list(word) FROM kept), {tokens_sql('rightword')})""",
)
def _(spark, d):
    p = table(spark, d, "part")
    wide = p.select(F.lower(F.concat_ws(" ", "p_name", "p_brand")).alias("wrongword"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.lower("p_type")).alias("rightword"))
    return vo.external_by_kind(wide.unionByName(name_pairs(spark, d)), right(spark, d)[0])


# lower-case letters beyond a to z as one byte each: the engine behind the SQL counts edits in bytes
ONE_BYTE = "translate({}, 'àáâäãçèéêëìíîïñòóôöùúûüßœ', 'ABCDEFGHIJKLMNOPQRSTUVWXY')"
# the last code in front of the result: h and w are passed over, other letters without a code end a run
SOUND_SQL = """CASE WHEN NOT regexp_matches(word, '^[a-z]') THEN word ELSE rpad(substr(list_reduce(string_split(substr(word, 2), ''), lambda a, x:
  CASE WHEN x IN ('h', 'w') THEN a WHEN regexp_matches(x, '[bfpvcgjkqsxzdtlmnr]') THEN
    CASE WHEN translate(x, 'bfpvcgjkqsxzdtlmnr', '111122222222334556') = a[1] THEN a ELSE translate(x, 'bfpvcgjkqsxzdtlmnr', '111122222222334556') || a[2:] || translate(x, 'bfpvcgjkqsxzdtlmnr', '111122222222334556') END
  ELSE '0' || a[2:] END, CASE WHEN regexp_matches(word[1], '[bfpvcgjkqsxzdtlmnr]') THEN translate(word[1], 'bfpvcgjkqsxzdtlmnr', '111122222222334556') WHEN word[1] IN ('h', 'w') THEN '7' ELSE '0' END
  || upper(word[1])), 2), 4, '0')[:4] END"""


@query(
    "voc_phonetic_variants",
    f"""WITH {WORD_COUNTS}, w AS (SELECT word, {SOUND_SQL} AS code, length(word) AS n, {ONE_BYTE.format("word")} AS plain FROM word_counts)
    SELECT a.word, b.word AS similar, round(1.0 - levenshtein(a.plain, b.plain) / greatest(a.n, b.n), 6) AS similarity
    FROM w AS a JOIN w AS b ON a.code = b.code AND a.word < b.word AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n)
    WHERE 1.0 - levenshtein(a.plain, b.plain) / greatest(a.n, b.n) >= 0.85""",
)
def _(spark, d):
    return flat(vo.phonetic_variants(word_counts(spark, d)))


@query(
    "voc_remove_wrong_w2r",
    f"""WITH {NAME_PAIRS}, u AS (SELECT * FROM name_pairs UNION SELECT DISTINCT p_name, p_brand FROM part), ph AS (SELECT DISTINCT p_name AS v FROM part WHERE p_size > 48),
    pl AS (SELECT string_split(p_name, ' ')[1] AS v FROM part WHERE p_brand = 'Brand#1' AND p_size > 30)
    SELECT wrongword, rightword FROM u WHERE wrongword NOT IN (SELECT v FROM ph) AND wrongword NOT IN (SELECT v FROM pl)""",
)
def _(spark, d):
    p = table(spark, d, "part")
    pairs = name_pairs(spark, d).unionByName(p.select(F.col("p_name").alias("wrongword"), F.col("p_brand").alias("rightword")).distinct())
    phrases = p.filter("p_size > 48").select(F.col("p_name").alias("variant"))
    plurals = p.filter("p_brand = 'Brand#1' AND p_size > 30").select(F.split("p_name", " ")[0].alias("plural"))
    return vo.drop_wrong_pairs(pairs, phrases, plurals)


W2R_SQL = f"""{HISTORY}, {NAME_PAIRS}, {PRODUCTS}, tc AS (SELECT token, sku, sum(clicks) AS clicks FROM (SELECT unnest(list_distinct(query_normalised)) AS token, sku, clicks
  FROM history WHERE len(query_normalised) <= 3) GROUP BY 1, 2),
tot AS (SELECT token AS wrongword, sum(clicks) AS total FROM tc GROUP BY 1 HAVING sum(clicks) >= 100),
pw AS (SELECT sku, {tokens_sql('name')} AS words FROM products),
w2r AS (SELECT n.wrongword, n.rightword, CAST(max(total) AS BIGINT) AS total, CAST(coalesce(sum(clicks) FILTER (WHERE list_contains(words, n.rightword)), 0) AS BIGINT) AS hits
  FROM name_pairs n JOIN tot USING (wrongword) JOIN tc ON token = wrongword JOIN pw USING (sku) GROUP BY 1, 2)"""


def token_clicks(spark, d):
    short = history(spark, d).filter(F.size("query_normalised") <= 3)
    # one row per (query, sku) before tokens multiply the rows
    pairs = short.groupBy("query_normalised", "sku").agg(F.sum("clicks").alias("clicks"))
    tokens = pairs.select(F.explode_outer(F.array_distinct("query_normalised")).alias("token"), "sku", "clicks").filter("token IS NOT NULL")
    return tokens.groupBy("token", "sku").agg(F.sum("clicks").alias("clicks"))


def w2r_history(spark, d):
    words = products(spark, d).select("sku", F.explode_outer(normal_tokens(F.col("name"))).alias("word")).filter("word IS NOT NULL")
    return vo.pair_history(name_pairs(spark, d), token_clicks(spark, d), words, 100)


@query("voc_w2r_history", f"WITH {W2R_SQL} SELECT *, round(hits / total, 6) AS history_score FROM w2r")
def _(spark, d):
    return flat(w2r_history(spark, d))


FINAL_SQL = f"""{W2R_SQL}, fs AS (SELECT wrongword, rightword, round(0.25 * lev + 0.25 * sound + 0.5 * hits / total, 6) AS final_score FROM (SELECT *,
  {similarity_sql('wrongword', 'rightword')} AS lev, {similarity_sql(sound_sql('wrongword'), sound_sql('rightword'))} AS sound FROM w2r))"""


def scored_pairs(spark, d):
    rows = vo.pair_scores(w2r_history(spark, d))
    return vo.final_scores(rows).select("wrongword", "rightword", F.round("final_score", 6).alias("final_score"))


@query("weighted_final_score", f"WITH {FINAL_SQL} SELECT * FROM fs")
def _(spark, d):
    return scored_pairs(spark, d)


@query("win_best_w2r", f"WITH {FINAL_SQL} SELECT * FROM fs QUALIFY row_number() OVER (PARTITION BY wrongword ORDER BY final_score DESC, rightword) = 1")
def _(spark, d):
    return vo.best_right_word(scored_pairs(spark, d))


MAPPING_SQL = f"{PLURAL_SQL}, {TURN_QUERIES}, m AS (SELECT plural, min(word) AS word FROM plurals GROUP BY 1), tk AS (SELECT query, unnest(tokens) AS t, unnest(range(1, len(tokens) + 1)) AS i FROM turn_queries)"


@query(
    "voc_spell_apply",
    f"""WITH {MAPPING_SQL} SELECT query, string_agg(coalesce(word, t), ' ' ORDER BY i) AS corrected, count(*) AS tokens FROM tk LEFT JOIN m ON plural = t GROUP BY query""",
)
def _(spark, d):
    w = word_counts(spark, d)
    mapping = vo.plural_map(w, w).groupBy(F.col("plural").alias("wrongword")).agg(F.min("word").alias("rightword"))
    return flat(vo.replace_tokens(turn_queries(spark, d), mapping))


@query(
    "voc_rewrite_query",
    f"""WITH {TURN_QUERIES}, e AS (SELECT token, min(lang) AS entity FROM (SELECT unnest({tokens_sql('text')}) AS token, lang FROM documents) GROUP BY 1),
    tk AS (SELECT query, unnest(tokens) AS t, unnest(range(1, len(tokens) + 1)) AS i FROM turn_queries)
    SELECT query, string_agg(coalesce(entity, t), ' ' ORDER BY i) AS rewritten, count(*) AS tokens FROM tk LEFT JOIN e ON token = t GROUP BY query""",
)
def _(spark, d):
    ents = table(spark, d, "documents").select(F.explode_outer(normal_tokens(F.col("text"))).alias("token"), F.col("lang").alias("entity"))
    return flat(vo.rewrite_query(turn_queries(spark, d), ents.filter("token IS NOT NULL")))


@query(
    "voc_phrase_variants",
    f"""WITH {NAMED_QUERIES} SELECT DISTINCT array_to_string(tokens, ' ') AS phrase_key, unnest([array_to_string(tokens, ''), array_to_string(tokens, '-'), array_to_string(tokens, ' ')]) AS variant
    FROM named_queries WHERE len(tokens) > 1""",
)
def _(spark, d):
    return vo.phrase_variants(named_queries(spark, d), "query")


@query("voc_phrase_clean", f"WITH {NAMED_QUERIES} SELECT DISTINCT array_to_string(tokens, ' ') AS phrase FROM named_queries WHERE len(tokens) > 0")
def _(spark, d):
    return vo.clean_phrases(named_queries(spark, d), "query")


@query(
    "voc_plural_phrases",
    f"""WITH ph AS (SELECT DISTINCT p_name AS phrase, string_split(p_name, ' ') AS k FROM part),
    c AS (SELECT phrase, unnest([k[1], k[1] || 's']) AS a, k FROM ph), f AS (SELECT phrase, a || ' ' || unnest([k[2], CASE WHEN regexp_matches(k[2], '(s|x|z|ch|sh)$') THEN k[2] || 'es' ELSE k[2] || 's' END]) AS plural_phrase FROM c)
    SELECT phrase, plural_phrase FROM f WHERE phrase <> plural_phrase""",
)
def _(spark, d):
    p = table(spark, d, "part")
    first, second = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    plurals = p.select(first.alias("word"), F.concat(first, F.lit("s")).alias("plural")).unionByName(p.select(second.alias("word"), vo.plural_of(second).alias("plural")))
    return vo.plural_phrases(p.withColumnRenamed("p_name", "phrase"), plurals)


@query(
    "voc_brand_chunks",
    f"""WITH b AS (SELECT DISTINCT p_brand || ' ' || p_name AS brandname FROM part), t AS (SELECT brandname, {tokens_sql('brandname')} AS k FROM b),
    c AS (SELECT brandname, 'prefix' AS kind, array_to_string(k[:i], ' ') AS chunk FROM (SELECT brandname, k, unnest(range(1, len(k))) AS i FROM t)
      UNION ALL SELECT brandname, 'acronym', array_to_string(list_transform(k, lambda x: x[1]), '') FROM t)
    SELECT kind, chunk, min(brandname) AS brandname FROM c GROUP BY 1, 2 HAVING count(DISTINCT brandname) = 1""",
)
def _(spark, d):
    return vo.brand_chunks(table(spark, d, "part").select(F.concat_ws(" ", "p_brand", "p_name").alias("brandname")))


GRAMS_SQL = " UNION ALL ".join(
    f"SELECT query, array_to_string(tokens[i:i + {n - 1}], ' ') AS phrase, {n} AS n FROM (SELECT query, tokens, unnest(range(1, len(tokens) - {n} + 2)) AS i FROM named_queries)" for n in (1, 2, 3, 4)
)


@query(
    "voc_phrase_match",
    f"""WITH {NAMED_QUERIES}, g AS ({GRAMS_SQL}), ph AS (SELECT DISTINCT p_name AS phrase FROM part WHERE p_size > 45 UNION SELECT DISTINCT string_split(p_name, ' ')[2] FROM part)
    SELECT query, phrase, n AS phrase_tokens FROM (SELECT DISTINCT * FROM g) JOIN ph USING (phrase) QUALIFY row_number() OVER (PARTITION BY query ORDER BY n DESC, phrase) = 1""",
)
def _(spark, d):
    p = table(spark, d, "part")
    phrases = p.filter("p_size > 45").select(F.col("p_name").alias("phrase")).unionByName(p.select(F.split("p_name", " ")[1].alias("phrase")))
    return flat(vo.longest_phrase(named_queries(spark, d), phrases))


@query(
    "voc_identify_intent",
    f"""WITH {NAMED_QUERIES}, g AS ({GRAMS_SQL}), l AS (SELECT DISTINCT p_name AS phrase, 'category' AS kind, p_type AS value FROM part WHERE p_size <= 10
      UNION SELECT DISTINCT lower(replace(p_brand, '#', ' ')), 'brand', p_brand FROM part)
    SELECT DISTINCT query, kind, value FROM g JOIN l USING (phrase) WHERE n <= 2""",
)
def _(spark, d):
    p = table(spark, d, "part")
    categories = p.filter("p_size <= 10").select(F.col("p_name").alias("token"), F.col("p_type").alias("value"))
    brands = p.select(F.lower(F.replace("p_brand", F.lit("#"), F.lit(" "))).alias("token"), F.col("p_brand").alias("value"))
    return vo.identify_intent(named_queries(spark, d), {"category": categories, "brand": brands})


@query(
    "voc_suggest_history",
    f"""WITH {HISTORY}, {PRODUCTS}, c AS (SELECT search_term, category, sum(clicks) AS clicks FROM history JOIN products USING (sku) WHERE clicks > 0 AND len(query_normalised) <= 3 GROUP BY 1, 2),
    s AS (SELECT *, sum(clicks) OVER (PARTITION BY search_term) AS total, coalesce(sum(clicks) OVER (PARTITION BY search_term ORDER BY clicks DESC, category
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
    SELECT search_term, category, round(clicks / total, 6) AS share FROM s WHERE before / total < 0.5
      AND (search_term, category) NOT IN (SELECT name, category FROM products WHERE size <= 5)""",
)
def _(spark, d):
    p = products(spark, d)
    existing = p.filter("size <= 5").select(F.col("name").alias("search_term"), "category")
    rows = vo.suggest_from_history(history_affinity(history(spark, d), p, "category", 0.5), existing, "search_term", "category")
    return flat(rows.select("search_term", "category", "share"))


@query(
    "voc_similar_to_category",
    """WITH pairs AS (SELECT a.vec_id AS w, b.vec_id AS s, a.label AS la, b.label AS lb, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 12) AS c
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY c DESC, s) AS k FROM pairs)
    SELECT w AS word, s AS similar, round(c, 6) AS similarity FROM r WHERE k <= 5 AND lb >= 2 AND la = lb""",
)
def _(spark, d):
    rows = vectors(spark, d)
    near = re.nearest_neighbours(rows, k=5).select(F.col("probe").alias("word"), F.col("base").alias("similar"), F.col("cosine").alias("similarity"))
    words = rows.filter("label >= 2").select(F.col("id").alias("word"))
    return flat(vo.similar_to_category(near, words, rows.select(F.col("id").alias("word"), F.col("label").alias("category"))))
