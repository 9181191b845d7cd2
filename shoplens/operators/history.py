"""Search-history joins, range aggregation, relevance and category affinity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.scale import global_running_sum, hot_key_join, lookup_join, materialise, top_n_per_group


def _sums(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def range_sum(
    df: DataFrame, column: str, low, high, keys: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Rows with ``column`` in [low, high] grouped by ``keys``. On a table partitioned by ``column``
    the bounds prune partitions."""
    return _sums(df.filter(F.col(column).between(low, high)), keys, sums)


def merge_history(
    interactions: DataFrame, positions: DataFrame, term: str = "search_term", sku: str = "sku"
) -> DataFrame:
    """Product interactions and position impressions, full outer on (term, sku).

    Both sides are summed on the join keys first, so a key meets exactly one row on the other side.
    """
    keys = [term, sku]
    left = _sums(interactions, keys, ["product_unique_list_view", "product_unique_list_clicks"])
    right = _sums(positions, keys, ["product_unique_list_view"]).withColumnRenamed("product_unique_list_view", "position_views")
    views = F.coalesce(F.col("product_unique_list_view"), F.lit(0)) + F.coalesce(F.col("position_views"), F.lit(0))
    return left.join(right, keys, "full").select(
        *keys, views.alias("freq"), F.coalesce("product_unique_list_clicks", F.lit(0)).alias("clicks")
    )


def science_table(
    interactions: DataFrame, positions: DataFrame, term: str = "search_term", sku: str = "sku"
) -> DataFrame:
    """Impressions, clicks and quantity per (term, sku)."""
    keys = [term, sku]
    left = _sums(interactions, keys, ["product_unique_list_clicks", "unique_adds_to_cart"])
    right = _sums(positions, keys, ["product_unique_list_view"])
    return left.join(right, keys, "full").select(
        *keys,
        F.coalesce("product_unique_list_view", F.lit(0)).alias("impressions"),
        F.coalesce("product_unique_list_clicks", F.lit(0)).alias("clicks"),
        F.coalesce("unique_adds_to_cart", F.lit(0)).alias("total_quantity"),
    )


def group_queries(
    df: DataFrame, query: str = "search_term", sku: str = "sku", freq: str = "freq", clicks: str = "clicks"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Query frequency, (query, sku) impressions and (query, sku) clicks.

    All three come from one (query, sku) aggregate, the reuse of which Spark sees in a shared plan.
    """
    pairs = _sums(df, [query, sku], [freq, clicks])
    return (
        _sums(pairs, [query], [freq]),
        pairs.select(query, sku, F.col(freq).alias("impressions")),
        pairs.filter(F.col(clicks) > 0).select(query, sku, clicks),
    )


def relevance_scores(
    df: DataFrame,
    term: str = "search_term",
    ctr_weight: float = 0.5,
    order_weight: float = 0.3,
    revenue_weight: float = 0.0,
    revenue: str | None = None,
) -> DataFrame:
    """Weighted sum of click, order (and revenue) rates, each min-max scaled within the term.

    Definition is ours. The extremes come from a groupBy with partial aggregation rather than a
    window, so a term with many products is not held by one task.
    """
    rates = {"ctr": F.try_divide("clicks", "impressions"), "order_rate": F.try_divide("total_quantity", "clicks")}
    weights = {"ctr": ctr_weight, "order_rate": order_weight}
    if revenue:
        rates["revenue_rate"], weights["revenue_rate"] = F.try_divide(revenue, "clicks"), revenue_weight
    rated = materialise(df.withColumns({name: F.coalesce(rate, F.lit(0.0)) for name, rate in rates.items()}), "rated")  # read three times
    extremes = rated.groupBy(term).agg(
        *[F.min(r).alias(f"_min_{r}") for r in rates], *[F.max(r).alias(f"_max_{r}") for r in rates]
    )
    score = F.lit(0.0)
    for r, weight in weights.items():
        low, high = F.col(f"_min_{r}"), F.col(f"_max_{r}")
        score = score + weight * F.coalesce(F.try_divide(F.col(r) - low, high - low), F.lit(0.0))
    return hot_key_join(rated, extremes, [term]).withColumn("score", score).select(*df.columns, "score")


def nonzero_scores(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("score") > 0)


def share_until(
    df: DataFrame, keys: Sequence[str], item: str, weight: str, percentile: float
) -> DataFrame:
    """Items of a group by descending share, up to the first whose cumulative share reaches
    ``percentile``. Input has one row per (group, item); items are a bounded domain such as categories."""
    group = Window.partitionBy(*keys)
    order = group.orderBy(F.desc(weight), F.asc(item))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(weight).over(group)
    return (
        df.withColumn("share", F.try_divide(F.col(weight).cast("double"), total))
        .withColumn("_before", F.coalesce(F.try_divide(F.sum(weight).over(before).cast("double"), total), F.lit(0.0)))
        .filter((F.col("_before") < percentile) & F.col("share").isNotNull())
        .drop("_before")
    )


def history_affinity(
    history: DataFrame,
    catalogue: DataFrame,
    attribute: str,
    percentile: float,
    max_query_length: int = 3,
    by_token: bool = False,
) -> DataFrame:
    """Query (or token) to the catalogue attribute values its clicks fall on, with click share.

    History has search_term, query_normalised, sku, clicks; the catalogue sku and the attribute.
    """
    short = history.filter((F.size("query_normalised") <= max_query_length) & (F.col("clicks") > 0))
    per_sku = short.groupBy("search_term", "query_normalised", "sku").agg(F.sum("clicks").alias("clicks"))
    placed = lookup_join(per_sku, catalogue.select("sku", attribute), ["sku"]).filter(F.col(attribute).isNotNull())
    if by_token:
        key = "token"
        placed = placed.withColumn(key, F.explode_outer(F.array_distinct("query_normalised"))).filter(F.col(key).isNotNull())
    else:
        key = "search_term"
    clicks = placed.groupBy(key, attribute).agg(F.sum("clicks").alias("clicks"))
    return share_until(clicks, [key], attribute, "clicks", percentile)


def training_pairs(
    pairs: DataFrame, old: DataFrame, threshold: int = 2, query: str = "query", product: str = "product"
) -> DataFrame:
    """(query, product) with enough clicks, merged with the former table."""
    keys = [query, product]
    fresh = _sums(pairs, keys, ["clicks"]).filter(F.col("clicks") >= threshold)
    return _sums(fresh.unionByName(old.select(*keys, "clicks")), keys, ["clicks"])


def top_queries_by_length(
    history: DataFrame, catalogue: DataFrame, attribute: str, lengths: Sequence[int] = (1, 2), n: int = 2000
) -> DataFrame:
    """Top ``n`` queries of each wanted token length with the attribute values of their skus."""
    sized = history.withColumn("length", F.size("query_normalised")).filter(F.col("length").isin(*lengths))
    freq = sized.groupBy("length", "search_term").agg(F.sum("freq").alias("freq"))
    top = top_n_per_group(freq, ["length"], [F.desc("freq"), F.asc("search_term")], n)
    wanted = top.select("search_term").distinct()  # before value sets are built
    skus = sized.join(wanted, "search_term", "left_semi").select("search_term", "sku").distinct()
    values = lookup_join(skus, catalogue.select("sku", attribute), ["sku"]).groupBy("search_term").agg(
        F.array_sort(F.collect_set(attribute)).alias("values")
    )
    return top.join(values, "search_term", "left")


def combine_months(months: Sequence[DataFrame], max_query_length: int = 3) -> DataFrame:
    """Raw months united and summed, then short queries only."""
    united = reduce(lambda a, b: a.unionByName(b), months)
    return _sums(united.filter(F.size("query_normalised") <= max_query_length), ["query_normalised", "sku"], ["freq", "clicks"])


def history_rank(truth: DataFrame, history: DataFrame, query: str = "query", freq: str = "freq") -> DataFrame:
    """Rank of each truth query by history frequency (ties share a rank), null when unseen.

    A rank is one plus the number of queries with a higher frequency, so only the counts of the
    distinct frequencies are ordered: at most about sqrt(2 * total searches) of them exist, summed over a range-partitioned sort.
    """
    totals = history.groupBy(query).agg(F.sum(freq).alias("freq"))
    levels = totals.groupBy("freq").agg(F.count(F.lit(1)).alias("n"))
    ranks = global_running_sum(levels, [F.desc("freq")], "n").select("freq", (F.col("running") - F.col("n") + 1).alias("rank"))
    wanted = truth.select(query).distinct().join(totals, query, "left")
    return lookup_join(wanted, ranks, ["freq"], "left").select(query, "freq", "rank")
