"""Query cleaning, dictionary extracts from the synonyms sheet, and small row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.arrays import clean_list
from shoplens.functions.text import FLOAT_PATTERN, clean_query, normal_tokens, seeded_int, straight_quotes
from shoplens.operators.scale import global_positions, lookup_join, once

# The variant names of the synonyms sheet, by extract.
EXTERNAL_VARIANTS = ("SPELL VARIANT", "STEM VARIANT", "BRAND EXPANSION")
VOCABULARY_VARIANTS = ("DEVNAGRI", "EXPANSION", "NUMERICAL", "SYMBOL")
SYNONYM_VARIANTS = ("SYNONYMS", "HINGLISH SYNONYMS", "SUBSTITUTE")

# Our choice of number words for the text-to-number step.
NUMBER_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9", "ten": "10", "eleven": "11", "twelve": "12",
}


def clean_queries(df: DataFrame, query: str = "search_term", freq: str = "total_searches") -> DataFrame:
    """The full cleaning chain with frequencies summed per cleaned query, without order or limit."""
    q = F.col(query)
    return (
        once(df, query, clean_query(q))
        .filter(~q.rlike(r"(.)\1{3,}"))
        .withColumn(query, straight_quotes(q))
        .filter(q.rlike(".*[a-z0-9].*"))
        .filter((F.length(q) <= 100) & ~q.rlike(FLOAT_PATTERN))
        .filter(~q.rlike(r"^\d+(\s\d+)*$"))
        .filter(F.size(F.split(q, r"\W+")) <= 8)
        .groupBy(q.alias("query"))
        .agg(F.sum(freq).alias("freq"))
    )


def top_queries(df: DataFrame, k: int = 100, query: str = "query", freq: str = "freq") -> DataFrame:
    """Most frequent queries; equal frequencies are ordered by the query text."""
    return df.orderBy(F.desc(freq), F.asc(query)).limit(k)


def clean_top_queries(df: DataFrame, k: int = 100, query: str = "search_term", freq: str = "total_searches") -> DataFrame:
    return top_queries(clean_queries(df, query, freq), k)


def normalise_history(df: DataFrame, query: str = "search_term", tokens: str = "query_normalised") -> DataFrame:
    """Rows with the query's normalised tokens; queries without any token go (our definition)."""
    return df.withColumn(tokens, normal_tokens(F.col(query))).filter(F.size(tokens) > 0)


def normalise_tracker(df: DataFrame, query: str = "search_term") -> DataFrame:
    """Rows unchanged, changed and dropped by the normalisation."""
    joined = F.array_join(normal_tokens(F.col(query)), " ")
    outcome = F.when(joined == "", "dropped").when(joined == F.col(query), "unchanged").otherwise("changed")
    return df.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


def short_queries(
    df: DataFrame, max_query_length: int = 3, tokens: str = "query_normalised", freq: str = "freq"
) -> DataFrame:
    """Normalised queries of at most ``max_query_length`` tokens with summed frequency."""
    return df.filter(F.size(tokens) <= max_query_length).groupBy(tokens).agg(F.sum(freq).alias(freq))


def query_and_word_tables(df: DataFrame, query: str = "search_term", freq: str = "total_searches") -> tuple[DataFrame, DataFrame]:
    """First clean of a period's queries: query-level and word-level frequency tables."""
    queries = clean_queries(df, query, freq)
    words = (
        queries.select(F.explode_outer(F.array_distinct(normal_tokens(F.col("query")))).alias("word"), "freq").filter(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.sum("freq").alias("freq"), F.count(F.lit(1)).alias("queries"))
    )
    return queries, words


def word_query_pairs(queries: DataFrame, query: str = "query", freq: str = "freq") -> DataFrame:
    """Word to query, one row per pair: a common word's queries never gather in one row."""
    tokens = normal_tokens(F.col(query))
    return queries.select(F.explode_outer(F.array_distinct(tokens)).alias("word"), query, freq).filter(F.col("word").isNotNull())


def numeric_brands(brands: DataFrame, brand: str = "brandname") -> DataFrame:
    """Brands holding a digit or a number word."""
    words = F.array(*[F.lit(w) for w in NUMBER_WORDS])
    return brands.filter(F.col(brand).rlike("[0-9]") | F.arrays_overlap(normal_tokens(F.col(brand)), words))


def text_to_number(queries: DataFrame, brands: DataFrame, query: str = "query", brand: str = "brandname") -> DataFrame:
    """Number words of a query become digits, except where the whole query is a brand holding one."""
    words = F.create_map(*[F.lit(x) for pair in NUMBER_WORDS.items() for x in pair])
    digits = F.transform(normal_tokens(F.col(query)), lambda t: F.coalesce(F.try_element_at(words, t), t))
    kept = numeric_brands(brands, brand).select(F.lower(F.col(brand)).alias(query), F.lit(True).alias("_brand")).distinct()
    joined = lookup_join(queries, kept, [query], "left")
    return joined.withColumn("query_numeric", F.when(F.col("_brand"), F.col(query)).otherwise(F.array_join(digits, " "))).drop("_brand")


def brand_acronyms(sheet: DataFrame) -> DataFrame:
    return sheet.filter(F.col("variant") == "BRAND ACRONYM").select(
        F.lower("synonyms").alias("phrase"), F.col("keyword").alias("phrase_key"), F.lit("1").alias("is_acronym")
    )


def hinglish(sheet: DataFrame) -> DataFrame:
    return sheet.filter(F.col("variant") == "HINGLISH").select(
        F.lower("synonyms").alias("Word"), F.col("keyword").alias("Hinglish Translation"), F.lit("1").alias("is_hinglish")
    )


def uk_to_us(sheet: DataFrame) -> DataFrame:
    return sheet.filter(F.col("variant") == "UK TO US").select(
        F.lower("keyword").alias("uk"), F.lower("synonyms").alias("american")
    )


def external_variants(sheet: DataFrame) -> DataFrame:
    """Twelve-column layout numbered in keyword order (ties by synonyms)."""
    rows = sheet.filter(F.col("variant").isin(*EXTERNAL_VARIANTS))
    numbered = global_positions(rows, [F.asc("keyword"), F.asc("synonyms"), F.asc("variant")], "row_num")
    empty = F.lit(None).cast("string")
    return numbered.select(
        "row_num",
        F.lower("keyword").alias("word"),
        F.lower("synonyms").alias("rightword"),
        *[empty.alias(c) for c in ("_c3", "w_count", "r_count", "old_r_count", "soundex", "dropThese?", "RtoR", "Remarks")],
        F.lit("W2R").alias("mapping_type"),
    )


def external_vocabulary(sheet: DataFrame) -> DataFrame:
    rows = sheet.filter(F.col("variant").isin(*VOCABULARY_VARIANTS))
    return rows.withColumn("synonym", F.explode_outer(F.split("synonyms", r"\|"))).filter(F.col("synonym").isNotNull()).select(
        F.lower("keyword").alias("externalword"),
        F.lower("synonym").alias("rightword"),
        F.lit(None).cast("float").alias("score"),
        F.lit(None).cast("int").alias("rightword_count"),
        F.lit(None).cast("string").alias("Drop"),
        "variant",
    )


def external_synonyms(sheet: DataFrame) -> DataFrame:
    """Rows with a keyword keep it as token, the others use their synonyms; both lower case."""
    rows = sheet.filter(F.col("variant").isin(*SYNONYM_VARIANTS))
    return rows.select(F.lower(F.coalesce("keyword", "synonyms")).alias("token"), F.lower("synonyms").alias("synonyms"))


def clean_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clean_list(F.col(c)) for c in columns})


def _all_empty(columns: Sequence[str]) -> Column:
    empty = F.lit(True)
    for c in columns:
        empty = empty & (F.coalesce(F.size(c), F.lit(0)) <= 0)
    return empty


def split_all_empty(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with something in any list, rows whose lists are all empty)."""
    return df.filter(~_all_empty(columns)), df.filter(_all_empty(columns))


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop()


def click_anomalies(df: DataFrame) -> DataFrame:
    return df.filter(F.col("clicks") > F.col("impressions"))


def sample_queries(
    df: DataFrame, query: str = "query", max_length: int = 25, fraction: float = 0.5, limit: int = 2000, seed: int = 7
) -> DataFrame:
    """Sampling step of a test set: short queries, a seeded share of them, at most ``limit`` rows.

    The share is taken by a hash of the text, so the result does not depend on partitioning.
    """
    picked = seeded_int("sample", seed, F.lit(1_000_000), F.col(query)) < int(fraction * 1_000_000)
    return df.filter((F.length(query) <= max_length) & picked).orderBy(query).limit(limit)


def category_ranges(df: DataFrame, category: str, value: str, parts: int = 4) -> DataFrame:
    """Numeric values as equal-width ranges between their category's lowest and highest value."""
    spans = df.groupBy(category).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / parts
    raw = F.floor(F.try_divide(F.col(value) - F.col("_lo"), width)).cast("int")
    bucket = F.coalesce(F.least(raw, F.lit(parts - 1)), F.lit(0))
    return lookup_join(df, spans, [category]).withColumn("range_id", bucket).drop("_lo", "_hi")
