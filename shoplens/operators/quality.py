"""Search-quality measures: click-through, coverage, comparison reports, profiles, corpus diffs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators.scale import exact_percentiles, global_positions, lookup_join, top_n_per_group


def explode_products(results: DataFrame, list_col: str = "products") -> DataFrame:
    """One row per result of a query: id and score."""
    item = results.select("query", F.explode_outer(list_col).alias("product")).filter(F.col("product").isNotNull())
    return item.select("query", F.col("product.colorGroup_string").alias("id"), F.col("product.score").alias("score"))


def click_through(interactions: DataFrame) -> DataFrame:
    """Impressions, clicks and their ratio per (query, option_code)."""
    query = F.concat_ws(" ", "query_normalised").alias("query")
    sums = interactions.groupBy(query, "option_code").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks")
    )
    return sums.withColumn("ctr", F.try_divide("clicks", "impressions"))


def score_with_ctr(scores: DataFrame, ctr: DataFrame) -> DataFrame:
    """Result scores with their click-through, null when the pair was never shown."""
    return scores.join(ctr.select("query", F.col("option_code").alias("id"), "ctr"), ["query", "id"], "left")


def query_ctr(joined: DataFrame) -> DataFrame:
    """Mean click-through per query over matched rows, highest first, capped at 1 after averaging."""
    mean = joined.filter(F.col("ctr").isNotNull()).groupBy("query").agg(F.avg("ctr").alias("avg_ctr_query_level"))
    capped = mean.withColumn("_mean", F.col("avg_ctr_query_level"))
    return (
        capped.withColumn("avg_ctr_query_level", F.least("avg_ctr_query_level", F.lit(1.0)))
        .orderBy(F.desc("_mean"), "query")
        .drop("_mean")
    )


def sorted_query_ctr(joined: DataFrame) -> DataFrame:
    """``query_ctr`` with each query's position in the order of falling mean before the cap; equal means (to nine places) by query."""
    means = joined.filter(F.col("ctr").isNotNull()).groupBy("query").agg(F.avg("ctr").alias("mean"))
    placed = global_positions(means, [F.desc(F.round("mean", 9)), F.asc("query")])
    return placed.select("position", "query", F.least("mean", F.lit(1.0)).alias("avg_ctr_query_level"))


def ctr_coverage(joined: DataFrame) -> DataFrame:
    return joined.agg(F.count(F.when(F.col("ctr").isNull(), 1)).alias("null_ctr"), F.count(F.lit(1)).alias("total"))


def score_with_history(scores: DataFrame, history: DataFrame) -> DataFrame:
    renamed = history.withColumnsRenamed({"search_term": "query", "option_code": "id"})
    return scores.join(renamed, ["query", "id"])


def correlations(df: DataFrame, score: str, others: Sequence[str]) -> DataFrame:
    return df.agg(*[F.corr(score, c).alias(f"corr_{c}") for c in others])


def zero_results(df: DataFrame, response: str = "response") -> DataFrame:
    """Responses with an empty point list against all responses."""
    empty = F.col(response).rlike(r'\{"point_ids": \[\]')
    count = F.count(F.when(empty, 1))
    return df.agg(count.alias("zero_results"), F.count(F.lit(1)).alias("total")).withColumn(
        "ratio", F.try_divide("zero_results", "total")
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def min_max_scale(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ("user_id", "brandname", "score")
) -> DataFrame:
    """Scale columns to [0, 1] over the whole table; a constant column becomes 0. One aggregate for all."""
    columns = list(columns) if columns is not None else numeric_columns(df, exclude)
    stats = df.agg(
        F.struct(
            *[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns)],
            *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(columns)],
        )
    ).scalar()
    scaled = {}
    for i, c in enumerate(columns):
        low, high = stats[f"lo{i}"], stats[f"hi{i}"]
        scaled[c] = F.when(low == high, F.lit(0.0)).otherwise(F.try_divide(F.col(c).cast("double") - low, high - low))
    return df.withColumns(scaled)


def _moments(column: str) -> list[Column]:
    c = F.col(column)
    return [
        F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"), F.max(c).alias("max"),
    ]


def describe(df: DataFrame, column: str) -> DataFrame:
    return df.agg(*_moments(column))


QUARTILES = (0.25, 0.5, 0.75)


def describe_by_category(df: DataFrame, category: str = "category", value: str = "similarity") -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per category and for "All"."""
    groups = F.array_compact(F.array(F.col(category).cast("string"), F.lit("All")))
    both = df.select(F.col(value).alias("_value"), F.explode_outer(groups).alias("_group")).withColumnRenamed("_group", "category")
    moments = both.groupBy("category").agg(*_moments("_value")).withColumnRenamed("stddev", "std")
    quartiles = exact_percentiles(both, ["category"], "_value", QUARTILES, ["p25", "p50", "p75"])
    return moments.join(quartiles, "category", "left")


def bad_pairs(df: DataFrame, similarity: str = "similarity", below: float = 0.9) -> DataFrame:
    return df.filter(F.col(similarity) < below)


def score_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    score: str,
    probabilities: Sequence[float] = (0.0, 0.1, 0.15, 0.2, 0.25, 0.5, 0.75, 1.0),
) -> DataFrame:
    names = [f"q{int(round(p * 100)):03d}" for p in probabilities]
    return exact_percentiles(df, keys, score, probabilities, names)


def net_scores(df: DataFrame, scores: Sequence[str], count: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of score columns weighted by a count column; rows without a score do not weigh."""
    weighted = [
        F.try_divide(F.sum(F.col(s) * F.col(count)), F.sum(F.when(F.col(s).isNotNull(), F.col(count)))).alias(s)
        for s in scores
    ]
    return df.groupBy(*keys).agg(*weighted)


def under_performing(
    steps: DataFrame, performance: DataFrame, n: int, query: str = "query", freq: str = "freq", score: str = "score"
) -> DataFrame:
    """Queries losing the most: frequency x (1 - score), highest first."""
    loss = F.col(freq) * (1 - F.col(score))
    return steps.join(performance, query).withColumn("loss", loss).orderBy(F.desc("loss"), query).limit(n)


def word_coverage(words: DataFrame, corpus: DataFrame, word: str = "word", freq: str = "freq") -> DataFrame:
    """Share of history words, and of their frequency, found in the corpus."""
    known = corpus.select(word).distinct().withColumn("_known", F.lit(True))
    per_word = words.groupBy(word).agg(F.sum(freq).alias(freq)).join(known, word, "left")
    return per_word.agg(
        F.count(F.lit(1)).alias("words"),
        F.count("_known").alias("covered_words"),
        F.sum(freq).alias("freq"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col(freq))), F.lit(0)).alias("covered_freq"),
    ).withColumns(
        {
            "word_coverage": F.try_divide("covered_words", "words"),
            "freq_coverage": F.try_divide("covered_freq", "freq"),
        }
    )


def interaction_covered(
    interactions: DataFrame, catalogue: DataFrame, intents: DataFrame, attribute: str, keys: Sequence[str]
) -> DataFrame:
    """Percent of interacted products whose attribute is among the query's detected values.

    ``intents`` has one row per (query, attribute value). Groups by ``keys``: the query, or the intent.
    """
    pairs = interactions.groupBy("query", "sku").agg(F.sum("clicks").alias("clicks"))
    placed = lookup_join(pairs, catalogue.select("sku", attribute), ["sku"])
    per_value = placed.groupBy("query", attribute).agg(F.count(F.lit(1)).alias("products"), F.sum("clicks").alias("clicks"))
    detected = intents.select("query", attribute).distinct().withColumn("_hit", F.lit(True))
    judged = per_value.join(detected, ["query", attribute], "left")
    hit = F.when(F.col("_hit"), F.col("products")).otherwise(0)
    return judged.groupBy(*keys).agg(
        F.sum("products").alias("products"),
        F.sum(hit).alias("covered"),
        (100.0 * F.try_divide(F.sum(hit), F.sum("products"))).alias("percent_covered"),
    )


def history_coverage(category_clicks: DataFrame, detected: DataFrame, attribute: str = "category") -> DataFrame:
    """Share of a query's category clicks covered by its detected categories."""
    per_value = category_clicks.groupBy("query", attribute).agg(F.sum("clicks").alias("clicks"))
    hits = detected.select("query", attribute).distinct().withColumn("_hit", F.lit(True))
    covered = F.coalesce(F.sum(F.when(F.col("_hit"), F.col("clicks"))), F.lit(0))
    return (
        per_value.join(hits, ["query", attribute], "left")
        .groupBy("query")
        .agg(F.sum("clicks").alias("clicks"), covered.alias("covered_clicks"))
        .withColumn("history_coverage", F.try_divide("covered_clicks", "clicks"))
    )


def token_category_performance(detected: DataFrame, history: DataFrame, attribute: str = "category") -> DataFrame:
    """Precision and recall of a token's detected categories against its history categories."""
    left = detected.select("token", attribute).distinct().withColumn("_d", F.lit(1))
    right = history.select("token", attribute).distinct().withColumn("_h", F.lit(1))
    counts = left.join(right, ["token", attribute], "full").groupBy("token").agg(
        F.count("_d").alias("detected"),
        F.count("_h").alias("expected"),
        F.count(F.when(F.col("_d").isNotNull() & F.col("_h").isNotNull(), 1)).alias("common"),
    )
    return counts.withColumns(
        {"precision": F.try_divide("common", "detected"), "recall": F.try_divide("common", "expected")}
    )


def entity_performance(interactions: DataFrame, catalogue: DataFrame, intents: DataFrame, attribute: str) -> DataFrame:
    """Clicks on a detected entity's products, and queries naming it, by entity."""
    pairs = interactions.groupBy("query", "sku").agg(F.sum("clicks").alias("clicks"))
    placed = lookup_join(pairs, catalogue.select("sku", attribute), ["sku"])
    clicks = placed.groupBy("query", attribute).agg(F.sum("clicks").alias("clicks"))
    detected = intents.select("query", attribute).distinct()
    return (
        detected.join(clicks, ["query", attribute], "left")
        .groupBy(attribute)
        .agg(F.count(F.lit(1)).alias("queries"), F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"))
    )


def filter_product_counts(filters: DataFrame, catalogue: DataFrame, attribute: str, product: str = "sku") -> DataFrame:
    """Distinct catalogue products allowed by a query's filter values (list column ``values``)."""
    per_value = catalogue.select(attribute, product).distinct().groupBy(attribute).agg(F.count(F.lit(1)).alias("n"))
    wanted = filters.select("query", F.explode_outer(F.array_distinct("values")).alias(attribute)).filter(F.col(attribute).isNotNull())
    # a product has one attribute value, so counts of distinct values add up
    return lookup_join(wanted, per_value, [attribute]).groupBy("query").agg(F.sum("n").alias("products"))


def corpus_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], scores: Sequence[str]) -> DataFrame:
    """added, removed, changed or same per key, with score deltas."""
    keys = list(keys)
    a = old.select(*keys, *[F.col(s).alias(f"old_{s}") for s in scores]).withColumn("_a", F.lit(True))
    b = new.select(*keys, *[F.col(s).alias(f"new_{s}") for s in scores]).withColumn("_b", F.lit(True))
    same = F.lit(True)
    for s in scores:
        same = same & F.col(f"old_{s}").eqNullSafe(F.col(f"new_{s}"))
    status = (
        F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(same, "same").otherwise("changed")
    )
    deltas = [(F.col(f"new_{s}") - F.col(f"old_{s}")).alias(f"delta_{s}") for s in scores]
    return a.join(b, keys, "full").select(*keys, status.alias("status"), *deltas)


def issue_score_delta(now: DataFrame, before: DataFrame, query: str = "query", score: str = "score") -> DataFrame:
    earlier = before.select(query, F.col(score).alias("previous_score"))
    return now.join(earlier, query, "left").withColumn("delta", F.col(score) - F.col("previous_score"))


def null_profile(df: DataFrame, columns: Sequence[str], period: str) -> DataFrame:
    """Percent of null values per column and period, long form."""
    percents = [(100.0 * F.try_divide(F.count(F.when(F.col(c).isNull(), 1)), F.count(F.lit(1)))).alias(c) for c in columns]
    wide = df.groupBy(period).agg(*percents)
    return wide.unpivot([period], list(columns), "column", "percent_null")


def null_row_profile(
    df: DataFrame, file: str, columns: Sequence[str], amount: str, ts: str, as_of: Column, months: Sequence[int] = (3, 6, 12)
) -> DataFrame:
    """Per file: rows, rows with any null, their percentage, and sales of the last months."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    sales = [
        F.sum(F.when(F.col(ts) >= F.add_months(as_of, -m), F.col(amount)).otherwise(0.0)).alias(f"sales_last_{m}_months")
        for m in months
    ]
    null_rows = F.count(F.when(any_null, 1))
    return df.groupBy(file).agg(
        F.count(F.lit(1)).alias("total_rows"),
        null_rows.alias("null_rows"),
        (100.0 * F.try_divide(null_rows, F.count(F.lit(1)))).alias("null_row_percentage"),
        *sales,
    )


def family_share(articles: DataFrame, matches: DataFrame, files: Sequence[str]) -> DataFrame:
    """Percent of each family's article ids found in each standard file, one column per file.

    ``articles``: family, article_id. ``matches``: article_id, file.
    """
    distinct = articles.select("family", "article_id").distinct()
    sizes = distinct.groupBy("family").agg(F.count(F.lit(1)).alias("articles"))
    found = distinct.join(matches.select("article_id", "file").distinct(), "article_id")
    wide = found.groupBy("family").pivot("file", list(files)).agg(F.count(F.lit(1)))
    percent = [(100.0 * F.coalesce(F.col(f"`{f}`"), F.lit(0)) / F.col("articles")).alias(f) for f in files]
    return sizes.join(wide, "family", "left").select("family", *percent)


def wrong_tokens(queries: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unknown tokens with total query frequency, and (token, query, freq) rows.

    ``queries``: query, tokens, freq. ``vocabulary``: token.
    """
    exploded = queries.select("query", "freq", F.explode_outer(F.array_distinct("tokens")).alias("token")).filter(F.col("token").isNotNull())
    totals = exploded.groupBy("token").agg(F.sum("freq").alias("freq"))
    unknown = totals.join(vocabulary.select("token").distinct(), "token", "left_anti")
    known = vocabulary.select("token").distinct().withColumn("_known", F.lit(True))
    pairs = lookup_join(exploded, known, ["token"], "left").filter(F.col("_known").isNull()).drop("_known")
    return unknown, pairs


def spell_distance(pairs: DataFrame, more_than: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rows whose correction is far from the query, and the averages over them.

    ``pairs``: query, mistake_queries, corrected.
    """
    rows = pairs.withColumns(
        {
            "mistake_distance": F.levenshtein("query", "mistake_queries"),
            "correction_distance": F.levenshtein("query", "corrected"),
        }
    ).filter(F.col("correction_distance") > more_than)
    summary = rows.agg(*_moments("correction_distance"), F.avg("mistake_distance").alias("avg_mistake_distance"))
    return rows, summary


def detected_vs_truth(df: DataFrame, truth: str, detected: str) -> DataFrame:
    """Per query hit, missed and extra category counts, with precision and recall."""
    hit = F.size(F.array_intersect(truth, detected))
    out = df.withColumns(
        {
            "hits": hit,
            "missed": F.size(F.array_except(truth, detected)),
            "extra": F.size(F.array_except(detected, truth)),
        }
    )
    return out.withColumns(
        {
            "precision": F.try_divide(F.col("hits"), F.col("hits") + F.col("extra")),
            "recall": F.try_divide(F.col("hits"), F.col("hits") + F.col("missed")),
        }
    )


def first_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_n_per_group(df, keys, order, 1).drop("rank")
