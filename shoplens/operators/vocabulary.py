"""Vocabulary and corpus building. The definitions are ours; constants are arguments.

Common shape: token lists are exploded once, aggregated to one row per token (so that a frequent
token is merged before the shuffle), and only then joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.damerau import similarity_scores
from shoplens.functions.text import normal_tokens
from shoplens.operators.history import share_until
from shoplens.operators.phrase_trie import matches, token_trie
from shoplens.operators.scale import hot_key_join, lookup_join, materialise, spread, top_n_per_group

RUN_BITS = 12  # token lists are looked up in runs of 4,096 rows


def attribute_words(catalogue: DataFrame, attributes: Sequence[str], product: str = "sku", category: str = "category") -> DataFrame:
    """(word, product, category, attribute) rows of all attribute values."""
    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])
    values = catalogue.select(product, F.col(category).alias("category"), F.explode_outer(pairs).alias("a")).filter(F.col("a").isNotNull())
    return values.select(
        F.explode_outer(F.array_distinct(normal_tokens(F.col("a.value")))).alias("word"),
        F.col(product).alias("product"),
        "category",
        F.col("a.attribute").alias("attribute"),
    ).filter(F.col("word").isNotNull())


def right_words(
    words: DataFrame,
    known: DataFrame,
    max_length: int = 17,
    min_products: int = 30,
    min_known_products: int = 500,
    min_share: float = 0.0,
) -> tuple[DataFrame, DataFrame]:
    """(word, products) kept by length and product count, and (word, category, products, share).

    Words of the ``known`` list (column word) need ``min_known_products``.
    """
    sized = words.filter(F.length("word") <= max_length)
    counts = sized.groupBy("word").agg(F.countDistinct("product").alias("products"))
    flagged = counts.join(known.select("word").distinct().withColumn("_known", F.lit(True)), "word", "left")
    needed = F.when(F.col("_known"), min_known_products).otherwise(min_products)
    kept = flagged.filter(F.col("products") >= needed).select("word", "products")
    by_category = sized.groupBy("word", "category").agg(F.countDistinct("product").alias("n"))
    shares = (
        by_category.join(kept, "word")
        .withColumn("share", F.col("n") / F.col("products"))
        .filter(F.col("share") >= min_share)
        .select("word", "category", F.col("n").alias("products"), "share")
    )
    return kept, shares


def keep_words(df: DataFrame, keep: DataFrame | None, *drop: DataFrame, word: str = "word") -> DataFrame:
    """Words in ``keep`` and in none of the ``drop`` lists."""
    if keep is not None:
        df = df.join(keep.select(word).distinct(), word, "left_semi")
    for banned in drop:
        df = df.join(banned.select(word).distinct(), word, "left_anti")
    return df


def single_brand_tokens(products: DataFrame, name: str = "name", brand: str = "brandname") -> DataFrame:
    """Tokens of product names used by exactly one brand."""
    tokens = products.select(F.explode_outer(F.array_distinct(normal_tokens(F.col(name)))).alias("token"), brand).filter(F.col("token").isNotNull())
    return (
        tokens.groupBy("token")
        .agg(F.countDistinct(brand).alias("brands"), F.min(brand).alias(brand), F.count(F.lit(1)).alias("products"))
        .filter("brands = 1")
        .drop("brands")
    )


def phrase_metadata(catalogue: DataFrame, attributes: Sequence[str], product: str = "sku") -> DataFrame:
    """Per attribute value: distinct products and tokens."""
    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("phrase")) for a in attributes])
    rows = catalogue.select(product, F.explode_outer(pairs).alias("a")).filter(F.col("a").isNotNull()).select(product, "a.*").filter(F.col("phrase").isNotNull())
    counts = rows.groupBy("attribute", "phrase").agg(F.countDistinct(product).alias("products"))
    return counts.withColumn("tokens", F.size(normal_tokens(F.col("phrase"))))


def phrases_from_attributes(
    catalogue: DataFrame, attributes: Sequence[str], min_products: int = 5, product: str = "sku"
) -> DataFrame:
    return phrase_metadata(catalogue, attributes, product).filter((F.col("tokens") > 1) & (F.col("products") >= min_products))


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring tokens as text, in order.

    Built by zipping shifted arrays: a lambda over positions would compute ``tokens`` once per position.
    """
    grams = tokens
    for shift in range(2, n + 1):
        ahead = F.slice(tokens, shift, F.greatest(F.size(tokens), F.lit(1)))
        grams = F.zip_with(grams, ahead, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(grams, lambda g: g.isNotNull()) if n > 1 else grams


def derived_phrases(
    products: DataFrame, words: DataFrame, name: str = "name", category: str = "category", percentile: float = 0.9973
) -> DataFrame:
    """Neighbouring pairs of right words in names, with their categories up to a cumulative share."""
    pairs = products.select(F.explode_outer(F.array_distinct(ngrams(normal_tokens(F.col(name)), 2))).alias("phrase"), category).filter(F.col("phrase").isNotNull())
    counts = pairs.groupBy("phrase", category).agg(F.count(F.lit(1)).alias("products"))
    split = counts.withColumns({"_a": F.element_at(F.split("phrase", " "), 1), "_b": F.element_at(F.split("phrase", " "), 2)})
    known = words.select("word").distinct()
    right = split.join(known.withColumnRenamed("word", "_a"), "_a", "left_semi").join(
        known.withColumnRenamed("word", "_b"), "_b", "left_semi"
    )
    return share_until(right.drop("_a", "_b"), ["phrase"], category, "products", percentile)


# Our choice of regular plural endings.
PLURAL_RULES = (("(s|x|z|ch|sh)$", "es"), ("[^aeiou]y$", "ies"))


def plural_of(word: Column) -> Column:
    return (
        F.when(word.rlike(PLURAL_RULES[0][0]), F.concat(word, F.lit("es")))
        .when(word.rlike(PLURAL_RULES[1][0]), F.regexp_replace(word, "y$", "ies"))
        .otherwise(F.concat(word, F.lit("s")))
    )


def plural_map(vocabulary: DataFrame, category_words: DataFrame) -> DataFrame:
    """Vocabulary words that are the plural form of a category word."""
    plurals = category_words.select("word").distinct().select(plural_of(F.col("word")).alias("plural"), "word")
    return plurals.join(vocabulary.select(F.col("word").alias("plural")).distinct(), "plural", "left_semi")


def entity_corpus(entities: DataFrame, plurals: DataFrame) -> DataFrame:
    """token to sorted entity list, plural rows included. ``entities``: token, entity; entity names are
    a small fixed domain."""
    extra = entities.join(plurals.select(F.col("word").alias("token"), "plural"), "token").select(
        F.col("plural").alias("token"), "entity"
    )
    both = entities.select("token", "entity").unionByName(extra)
    return both.groupBy("token").agg(F.array_sort(F.collect_set("entity")).alias("entities"))


def brand_families(brands: DataFrame, brand: str = "brandname", min_count: int = 10) -> DataFrame:
    """(family, brand): brands sharing their first token, in families of at least ``min_count``."""
    rows = brands.select(brand).distinct().withColumn("family", F.try_element_at(normal_tokens(F.col(brand)), F.lit(1)))
    rows = rows.filter(F.col("family").isNotNull())
    large = rows.groupBy("family").agg(F.count(F.lit(1)).alias("brands")).filter(F.col("brands") >= min_count)
    return lookup_join(rows, large, ["family"])


def colour_synonyms(sheet: DataFrame, words: DataFrame) -> DataFrame:
    """(colour, synonym) rows whose synonym is a right word. ``sheet``: keyword, synonyms (pipe list)."""
    rows = sheet.select(F.lower("keyword").alias("colour"), F.explode_outer(F.split(F.lower("synonyms"), r"\|")).alias("word")).filter(F.col("word").isNotNull())
    return rows.distinct().join(words.select("word").distinct(), "word", "left_semi").withColumnRenamed("word", "synonym")


def split_words(
    words: DataFrame, vocabulary: DataFrame, min_products: int = 20, min_single: int = 1000, word: str = "word"
) -> DataFrame:
    """Words equal to two vocabulary words joined; one-letter parts need ``min_single`` products.

    ``vocabulary``: word, products. The split points of a word are few, both lookups are on distinct words.
    """
    needed = F.when(F.length("word") == 1, min_single).otherwise(min_products)
    parts = vocabulary.filter(F.col("products") >= needed).select("word")
    n = F.length("joined")
    points = F.when(n >= 2, F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))))
    halves = F.transform(
        points,
        lambda i: F.struct(
            F.substring("joined", F.lit(1), i).alias("left"), F.substring("joined", i + 1, n).alias("right")
        ),
    )
    distinct = words.select(F.col(word).alias("joined")).distinct()
    halves = distinct.select("joined", F.explode_outer(halves).alias("h")).filter(F.col("h").isNotNull()).select("joined", "h.left", "h.right")
    return lookup_join(
        lookup_join(halves, parts.withColumnRenamed("word", "left"), ["left"]),
        parts.withColumnRenamed("word", "right"),
        ["right"],
    ).select("joined", "left", "right")


def right_queries(queries: DataFrame, words: DataFrame, min_freq: int = 5) -> DataFrame:
    """Queries of enough frequency whose tokens are all right words. ``queries``: query, tokens, freq."""
    frequent = queries.filter((F.col("freq") >= min_freq) & (F.size("tokens") > 0))
    tokens = frequent.select("query", "freq", F.explode_outer(F.array_distinct("tokens")).alias("word")).filter(F.col("word").isNotNull())
    known = words.select("word").distinct().withColumn("_known", F.lit(True))
    judged = lookup_join(tokens, known, ["word"], "left")
    return (
        judged.groupBy("query", "freq")
        .agg(F.bool_and(F.coalesce("_known", F.lit(False))).alias("all_right"))
        .filter("all_right")
        .drop("all_right")
    )


def popular_splits(splits: DataFrame, frequencies: DataFrame) -> DataFrame:
    """The split form searched most for each joined word. ``frequencies``: query, freq."""
    forms = splits.withColumn("query", F.concat_ws(" ", "left", "right")).join(frequencies, "query", "left")
    scored = forms.withColumn("freq", F.coalesce("freq", F.lit(0)))
    return top_n_per_group(scored, ["joined"], [F.desc("freq"), F.asc("query")], 1).select("joined", "query", "freq")


def consistent_categories(token_l1l2: DataFrame, token_l1l3: DataFrame, mapping: DataFrame) -> DataFrame:
    """Token categories of the l1l2 list that a category of its l1l3 list maps to.

    ``mapping``: l1l3, l1l2. Category lists are a bounded domain.
    """
    implied = lookup_join(token_l1l3.distinct(), mapping.select("l1l3", "l1l2").distinct(), ["l1l3"]).select("token", "l1l2").distinct()
    kept = token_l1l2.distinct().join(implied, ["token", "l1l2"], "left_semi")
    return kept.groupBy("token").agg(F.array_sort(F.collect_set("l1l2")).alias("categories"))


def external_by_kind(variants: DataFrame, words: DataFrame) -> DataFrame:
    """External variants whose right word is known, marked word, phrase or synonym.

    ``variants``: wrongword, rightword. A right word of several tokens is a phrase and needs every
    token known; a wrong word of several tokens with a single right word is a synonym.
    """
    rows = variants.select("wrongword", "rightword").distinct()
    tokens = rows.select("rightword").distinct().withColumn("word", F.explode_outer(F.array_distinct(normal_tokens(F.col("rightword"))))).filter(F.col("word").isNotNull())
    known = words.select("word").distinct().withColumn("_known", F.lit(True))
    good = (
        lookup_join(tokens, known, ["word"], "left")
        .groupBy("rightword")
        .agg(F.bool_and(F.coalesce("_known", F.lit(False))).alias("ok"))
        .filter("ok")
        .select("rightword")
    )
    right, wrong = F.size(normal_tokens(F.col("rightword"))), F.size(normal_tokens(F.col("wrongword")))
    kind = F.when(right > 1, "phrase").when(wrong > 1, "synonym").otherwise("word")
    return rows.join(good, "rightword", "left_semi").withColumn("kind", kind)


def phonetic_variants(words: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Word pairs with one sound code and edit similarity of at least ``threshold``.

    With longer length L, distance d <= (1 - t) L. The longer word is cut into K pieces; d changes leave at least K - d of them
    in the other word, shifted by at most d places. K is d + 2 where the word is long enough: then any d + 1 pieces hold a shared
    one, so the piece most words have is left out. Pairs meet on (code, longer length, place, text), and a pair that
    shares several pieces is made at the rarest of them only: no pair is made twice, and none of a code's words without a shared piece.
    """
    w = spread(words.select("word").distinct()).withColumn("code", F.soundex("word")).withColumn("n", F.length("word")).filter(F.col("n") > 0)

    def cut(n: Column) -> tuple[Column, Column, Column]:
        """Changes allowed, pieces and letters of a piece at longer length ``n``."""
        budget = F.floor((1 - threshold) * n + 1e-9).cast("int")
        pieces = F.when(n >= 2 * (budget + 2), budget + 2).otherwise(F.least(budget + 1, n))
        return budget, pieces, F.floor(n / pieces).cast("int")

    def piece_at(j: Column, n: Column, pieces: Column, size: Column) -> tuple[Column, Column]:
        return j * size + 1, F.when(j == pieces - 1, n - (pieces - 1) * size).otherwise(size)

    # side A: the longer word of a pair and its pieces, the rarest first
    budget, pieces, size = cut(F.col("n"))
    own = F.transform(F.sequence(F.lit(0), pieces - 1), lambda j: F.struct(piece_at(j, F.col("n"), pieces, size)[0].alias("at"), F.substring(F.col("word"), *piece_at(j, F.col("n"), pieces, size)).alias("text")))
    longer = materialise(w.select(F.col("word").alias("longer"), "code", F.col("n").alias("long_n"), budget.alias("budget"), F.explode(own).alias("piece")), "pieces")
    counts = longer.groupBy("code", "long_n", "piece").agg(F.count(F.lit(1)).alias("held"))
    counted = longer.join(counts, ["code", "long_n", "piece"])
    ranked = counted.groupBy("longer", "code", "long_n", "budget").agg(F.array_sort(F.collect_list(F.struct("held", "piece"))).alias("all"))
    chosen = F.transform(F.slice("all", 1, F.least(F.col("budget") + 1, F.size("all"))), lambda x: x["piece"])
    rare = ranked.select("longer", "code", "long_n", "budget", chosen.alias("chosen")).select("*", F.posexplode("chosen").alias("rank", "piece"))
    # side B: every word, as the shorter one, for each admissible longer length, piece and shift
    widths = F.sequence(F.col("n"), F.floor(F.col("n") / threshold + 1e-9).cast("int"))
    shorter = w.select(F.col("word").alias("shorter"), "code", F.explode(widths).alias("long_n"))
    budget_b, pieces_b, size_b = cut(F.col("long_n"))

    def shifted(j: Column) -> Column:
        at, length = piece_at(j, F.col("long_n"), pieces_b, size_b)
        return F.transform(F.sequence(-budget_b, budget_b), lambda s: F.struct(at.alias("at"), F.when(at + s >= 1, F.substring(F.col("shorter"), at + s, length)).alias("text")))

    places = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), pieces_b - 1), shifted)))
    probes = shorter.select("shorter", "code", "long_n", F.explode(places).alias("piece")).filter(F.length("piece.text") > 0)
    met = rare.join(probes, ["code", "long_n", "piece"]).filter(
        (F.col("longer") != F.col("shorter"))
        # equal lengths meet from both sides
        & ((F.length("shorter") < F.col("long_n")) | (F.col("longer") < F.col("shorter")))
    )

    def shared(piece: Column) -> Column:
        """Whether the shorter word has the piece within the allowed shift."""
        return F.exists(F.sequence(-F.col("budget"), F.col("budget")), lambda s: (piece["at"] + s >= 1) & (F.substring(F.col("shorter"), piece["at"] + s, F.length(piece["text"])) == piece["text"]))

    first = met.filter(~F.exists(F.slice("chosen", 1, F.col("rank")), shared))
    pairs = first.select(F.least("longer", "shorter").alias("word"), F.greatest("longer", "shorter").alias("similar"), "long_n")
    scored = pairs.withColumn("similarity", 1.0 - F.levenshtein("word", "similar") / F.col("long_n")).drop("long_n")
    return scored.filter(F.col("similarity") >= threshold)


def drop_wrong_pairs(pairs: DataFrame, phrase_variants: DataFrame, plurals: DataFrame) -> DataFrame:
    """Wrong-to-right pairs whose wrong word is neither a phrase variant nor a plural form."""
    return pairs.join(phrase_variants.select(F.col("variant").alias("wrongword")).distinct(), "wrongword", "left_anti").join(
        plurals.select(F.col("plural").alias("wrongword")).distinct(), "wrongword", "left_anti"
    )


def pair_history(
    pairs: DataFrame,
    token_clicks: DataFrame,
    product_words: DataFrame,
    min_token_count: int = 100,
) -> DataFrame:
    """Share of a wrong word's clicks that fall on products carrying the right word.

    ``token_clicks``: token, sku, clicks (one row per pair). ``product_words``: sku, word.
    """
    totals = token_clicks.groupBy("token").agg(F.sum("clicks").alias("total")).filter(F.col("total") >= min_token_count)
    wanted = pairs.select("wrongword", "rightword").distinct().join(totals.withColumnRenamed("token", "wrongword"), "wrongword")
    clicked = hot_key_join(
        token_clicks.withColumnRenamed("token", "wrongword"), wanted.select("wrongword", "rightword"), ["wrongword"]
    )
    carried = clicked.join(
        product_words.select("sku", F.col("word").alias("rightword")).distinct(), ["sku", "rightword"], "left_semi"
    )
    hits = carried.groupBy("wrongword", "rightword").agg(F.sum("clicks").alias("hits"))
    return wanted.join(hits, ["wrongword", "rightword"], "left").select(
        "wrongword",
        "rightword",
        "total",
        F.coalesce("hits", F.lit(0)).alias("hits"),
        F.try_divide(F.coalesce("hits", F.lit(0)), F.col("total")).alias("history_score"),
    )


def sound_key(word: Column) -> Column:
    """First letter and the later ones without vowels, h, w and y: how a word sounds, roughly. Definition is ours."""
    return F.concat(F.substring(word, 1, 1), F.regexp_replace(F.substring(word, 2, 1 << 30), "[aeiouhwy]", ""))


def pair_scores(pairs: DataFrame) -> DataFrame:
    """Similarity of the two words of a pair, and of their sound keys: levenshtein_score, phonetic_score."""
    keyed = pairs.withColumns({"_wrong": sound_key(F.col("wrongword")), "_right": sound_key(F.col("rightword"))})
    return similarity_scores(keyed, {"levenshtein_score": ("wrongword", "rightword"), "phonetic_score": ("_wrong", "_right")}).drop("_wrong", "_right")


def final_scores(pairs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Weighted sum of the scores of a wrong-to-right pair; a missing score counts as 0."""
    weights = weights or {"levenshtein_score": 0.25, "phonetic_score": 0.25, "history_score": 0.5}
    total = F.lit(0.0)
    for column, weight in weights.items():
        total = total + weight * F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    return pairs.withColumn("final_score", total)


def best_right_word(pairs: DataFrame, score: str = "final_score") -> DataFrame:
    """One right word per wrong word: the highest score, then alphabetical order."""
    return top_n_per_group(pairs, ["wrongword"], [F.desc(score), F.asc("rightword")], 1).drop("rank")


def replace_tokens(
    queries: DataFrame, mapping: DataFrame, key: str = "query", tokens: str = "tokens", old: str = "wrongword", new: str = "rightword"
) -> DataFrame:
    """Tokens found in the mapping (one row per ``old``) replaced, order kept.

    Rows are cut into runs of up to 2 ** ``RUN_BITS``. The distinct tokens of a run, and not each token with its place, are joined with the
    mapping; a run then meets the few of them that are replaced. Rows without tokens keep an empty text.
    """
    numbered = materialise(queries.select(F.col(key).alias("_key"), F.col(tokens).alias("_list"), F.monotonically_increasing_id().alias("_row")), "token-lists")
    rows = numbered.select("_key", "_list", F.shiftright("_row", RUN_BITS).alias("_run"))
    used = rows.select("_run", F.explode("_list").alias(old)).distinct()
    known = lookup_join(used, mapping.select(old, new).filter(F.col(new).isNotNull()), [old]).select(F.col("_run").alias("_in"), old, new)

    def replaced(lists: pa.Table, found: pa.Table) -> pa.Table:
        names = dict(zip(found.column(old).to_pylist(), found.column(new).to_pylist()))
        texts, sizes = [], []
        for listed in (row for chunk in lists.column("_list").chunks for row in chunk):
            parts = [names.get(t, t) for t in listed.as_py() or ()]
            texts.append(" ".join(t for t in parts if t is not None))
            sizes.append(len(parts))
        return pa.table([lists.column("_key"), pa.array(texts, pa.string()), pa.array(sizes, pa.int32())], names=[key, "corrected", "tokens"])

    schema = T.StructType().add(key, queries.schema[key].dataType).add("corrected", "string").add("tokens", "integer")
    return rows.groupBy("_run").cogroup(known.groupBy("_in")).applyInArrow(replaced, schema)


def phrase_variants(phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """Joined, hyphenated and plain forms of each phrase of several tokens."""
    tokens = normal_tokens(F.col(phrase))
    forms = F.array(*[F.array_join(tokens, sep) for sep in ("", "-", " ")])
    rows = phrases.select(phrase).distinct().filter(F.size(tokens) > 1)
    return rows.select(F.array_join(tokens, " ").alias("phrase_key"), F.explode_outer(forms).alias("variant")).filter(F.col("variant").isNotNull()).distinct()


def clean_phrases(phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    return phrases.select(F.array_join(normal_tokens(F.col(phrase)), " ").alias("phrase")).filter("phrase <> ''").distinct()


def plural_phrases(phrases: DataFrame, plurals: DataFrame, phrase: str = "phrase") -> DataFrame:
    """Phrases with any non-empty choice of their known words made plural.

    ``plurals``: word, plural. Forms grow by one token a round, each a row of its own: the forms of a phrase of many known words
    are spread over the tasks. As many rounds as the longest phrase has tokens.
    """
    tokens = phrases.select(F.col(phrase).alias("phrase")).distinct().select("phrase", F.posexplode(normal_tokens(F.col("phrase"))).alias("at", "word"))
    own = materialise(tokens, "phrase-tokens")
    known = plurals.select("word", "plural").filter(F.col("plural").isNotNull()).distinct()
    forms = own.select("phrase", "at", F.col("word").alias("form")).unionByName(own.join(known, "word").select("phrase", "at", F.col("plural").alias("form")))
    forms = materialise(forms.distinct(), "forms")
    length = own.groupBy("phrase").agg(F.max("at").alias("last"))
    built = forms.filter("at = 0").select("phrase", F.col("form").alias("text")).join(length, "phrase")
    done = None
    at = 0
    while True:
        built = materialise(built, "built")
        whole = built.filter(F.col("last") == at).select("phrase", F.col("text").alias("plural_phrase"))
        done = whole if done is None else done.unionByName(whole)
        longer = built.filter(F.col("last") > at)
        if longer.isEmpty():
            break
        at += 1
        step = forms.filter(F.col("at") == at).select("phrase", "form")
        built = longer.join(step, "phrase").select("phrase", F.concat_ws(" ", "text", "form").alias("text"), "last")
    return done.distinct().filter(F.col("plural_phrase") != F.array_join(normal_tokens(F.col("phrase")), " "))


def brand_chunks(brands: DataFrame, brand: str = "brandname") -> DataFrame:
    """Leading sub-phrases and initials of multi-word brands that belong to one brand only."""
    tokens = normal_tokens(F.col(brand))
    n = F.size(tokens)
    heads = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(F.lit("prefix").alias("kind"), F.array_join(F.slice(tokens, 1, i), " ").alias("chunk")))
    initials = F.array_join(F.transform(tokens, lambda t: F.substring(t, 1, 1)), "")
    both = F.concat(heads, F.array(F.struct(F.lit("acronym").alias("kind"), initials.alias("chunk"))))
    rows = brands.select(brand).distinct().filter(n > 1).select(brand, F.explode_outer(both).alias("c")).filter(F.col("c").isNotNull()).select(brand, "c.*")
    return (
        rows.groupBy("kind", "chunk")
        .agg(F.countDistinct(brand).alias("brands"), F.min(brand).alias(brand))
        .filter("brands = 1")
        .drop("brands")
    )


def longest_phrase(queries: DataFrame, phrases: DataFrame, key: str = "query", tokens: str = "tokens") -> DataFrame:
    """The longest known phrase inside each query; equal lengths by text. Queries without any are left out."""
    found = matches(queries.select(key, F.col(tokens).alias("tokens")), token_trie(phrases, "phrase"), [key])
    best = F.max_by("phrase", F.struct("phrase_tokens", F.lit(1)))
    longest = found.groupBy(key, "phrase_tokens").agg(F.min("phrase").alias("phrase"))  # of one length the first by text
    return longest.groupBy(key).agg(best.alias("phrase"), F.max("phrase_tokens").alias("phrase_tokens"))


def identify_intent(queries: DataFrame, lookups: dict[str, DataFrame], key: str = "query", tokens: str = "tokens") -> DataFrame:
    """(query, kind, value) rows: the lookup values of a query's tokens and phrases, however long.

    Each lookup has token and value. Values stay in long form, one row each.
    """
    united = reduce(
        lambda a, b: a.unionByName(b),
        [table.select("token", F.lit(kind).alias("kind"), F.col("value").cast("string").alias("value")) for kind, table in lookups.items()],
    ).distinct()
    found = matches(queries.select(key, F.col(tokens).alias("tokens")), token_trie(united, "token"), [key])
    return lookup_join(found.select(key, F.col("phrase").alias("token")).distinct(), united, ["token"]).select(key, "kind", "value").distinct()


def rewrite_query(queries: DataFrame, entities: DataFrame, key: str = "query", tokens: str = "tokens") -> DataFrame:
    """Query text with every known token replaced by its entity type. ``entities``: token, entity."""
    one = entities.groupBy("token").agg(F.min("entity").alias("entity"))
    return replace_tokens(queries, one, key, tokens, "token", "entity").withColumnRenamed("corrected", "rewritten")


def unify_verticals(tables: dict[str, DataFrame]) -> DataFrame:
    """Same-shaped corpus tables of all verticals with a vertical column."""
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn("vertical", F.lit(v)) for v, df in tables.items()])


def suggest_from_history(affinity: DataFrame, existing: DataFrame, key: str, attribute: str) -> DataFrame:
    """History suggestions that the corpus does not have yet."""
    return affinity.join(existing.select(key, attribute).distinct(), [key, attribute], "left_anti")


def similar_to_category(neighbours: DataFrame, category_words: DataFrame, word_categories: DataFrame) -> DataFrame:
    """Similar words that are category words and share a category with the word.

    ``neighbours``: word, similar, similarity. ``word_categories``: word, category.
    """
    kept = neighbours.join(category_words.select(F.col("word").alias("similar")).distinct(), "similar", "left_semi")
    categories = word_categories.select("word", "category").distinct()
    # categories are a bounded domain: one sorted set per word
    sets = categories.groupBy("word").agg(F.collect_set("category").alias("categories"))
    left = kept.join(sets.withColumnRenamed("categories", "_a"), "word")
    both = left.join(sets.select(F.col("word").alias("similar"), F.col("categories").alias("_b")), "similar")
    return both.filter(F.arrays_overlap("_a", "_b")).select("word", "similar", "similarity")
