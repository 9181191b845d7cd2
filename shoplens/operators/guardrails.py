"""Checks of detected entities against expected ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.arrays import empty_strings, value_for_entity, wrap_scalar
from shoplens.functions.text import normal_brand
from shoplens.operators.scale import global_positions, top_n_per_group

# The entity names of query templates, and the short name each is compared under.
ENTITY_COLUMNS = {
    "brickprimarycolor_en_string_mv": "colour",
    "brand_string_mv": "brand",
    "l1_category": "l1",
    "l2_category": "l2",
    "l3_category": "l3",
}


def _sorted_sets(left: str, right: str) -> tuple[Column, Column, Column]:
    return (
        F.array_sort(F.array_intersect(left, right)),
        F.array_sort(F.array_except(left, right)),
        F.array_sort(F.array_except(right, left)),
    )


def _listed(*columns: str) -> dict[str, Column]:
    return {c: F.coalesce(F.col(c), empty_strings()) for c in columns}


def set_compare(
    df: DataFrame, truth_category: str, category: str, truth_brand: str, brand: str
) -> DataFrame:
    """Common, missed and extra values for category and brand, each with its count."""
    out = df.withColumns(_listed(truth_category, category, truth_brand, brand))
    for prefix, (truth, found) in {"cat": (truth_category, category), "brand": (truth_brand, brand)}.items():
        common, missed, extra = _sorted_sets(truth, found)
        out = out.withColumns(
            {f"{prefix}_intersection": common, f"{prefix}_not_detected": missed, f"{prefix}_extra_detected": extra}
        ).withColumns(
            {
                f"{prefix}_intersection_count": F.size(f"{prefix}_intersection"),
                f"{prefix}_miss_count": F.size(f"{prefix}_not_detected"),
                f"{prefix}_extra_count": F.size(f"{prefix}_extra_detected"),
            }
        )
    return out


def set_compare_strict(
    df: DataFrame, truth_category: str, category: str, truth_brand: str, brand: str
) -> DataFrame:
    """Missed values only when nothing was detected, extra ones only without truth; detected brands
    are compared in lower case."""
    out = df.withColumns(_listed(truth_category, category, truth_brand, brand))
    out = out.withColumn("_brand", F.transform(brand, lambda b: F.lower(b)))
    for prefix, (truth, found) in {"cat": (truth_category, category), "brand": (truth_brand, "_brand")}.items():
        common, missed, extra = _sorted_sets(truth, found)
        out = out.withColumns(
            {
                f"{prefix}_hit": common,
                f"{prefix}_miss": F.when(F.size(found) == 0, missed).otherwise(empty_strings()),
                f"{prefix}_extra": F.when(F.size(truth) == 0, extra).otherwise(empty_strings()),
            }
        ).withColumns({f"{prefix}_{k}_count": F.size(f"{prefix}_{k}") for k in ("hit", "miss", "extra")})
    return out.drop("_brand")


def hit_status(truth: Sequence[str], detected: Sequence[str]) -> Column:
    """hit when all lists of both sides hold values, miss for truth only, extra for detected only."""

    def full(columns: Sequence[str]) -> Column:
        result = F.lit(True)
        for c in columns:
            result = result & (F.coalesce(F.size(c), F.lit(0)) > 0)
        return result

    has_truth, has_detected = full(truth), full(detected)
    return (
        F.when(has_truth & has_detected, "hit").when(has_truth, "miss").when(has_detected, "extra")
    )


def hit_miss_extra(df: DataFrame, truth: Sequence[str], detected: Sequence[str], query: str = "query") -> DataFrame:
    """Rows and distinct verticals by status per query. Verticals are a small fixed domain."""
    rows = df.withColumn("status", hit_status(truth, detected))
    kinds = ("hit", "extra", "miss")
    counts = [F.count(F.when(F.col("status") == k, 1)).alias(f"{k}_count") for k in kinds]
    sets = [F.array_sort(F.collect_set(F.when(F.col("status") == k, F.col("vertical")))).alias(f"{k}_verticals") for k in kinds]
    return rows.groupBy(query).agg(*counts, *sets)


def template_entities(df: DataFrame) -> DataFrame:
    """Expected entity lists of templated queries; the joined query text as ``input_query``."""
    expected = {
        f"{short}_gr": wrap_scalar(value_for_entity(F.col("query"), F.col("query_template"), entity))
        for entity, short in ENTITY_COLUMNS.items()
    }
    return df.withColumns(
        {
            **expected,
            "input_query": F.array_join("query", " "),
            "query_template_string": F.array_join("query_template", ", "),
        }
    )


def unique_queries(df: DataFrame, query: str = "input_query") -> DataFrame:
    """Rows whose query occurs exactly once.

    A groupBy counts with partial aggregation and keeps the one row of single queries, so rows of a
    much repeated query are merged before the shuffle instead of filling one window partition.
    """
    others = [c for c in df.columns if c != query]
    once = df.groupBy(query).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*others)).alias("_row"))
    return once.filter("_n = 1").select(query, *[F.col("_row")[c].alias(c) for c in others]).select(*df.columns)


def top_n_per_template(df: DataFrame, n: int, template: str = "query_template_string", query: str = "input_query") -> DataFrame:
    return top_n_per_group(df, [template], [F.asc(query)], n)


def first_per_template(df: DataFrame, template: str = "query_template_string", query: str = "input_query") -> DataFrame:
    return top_n_per_group(df, [template], [F.asc(query)], 1).drop("rank")


def join_detected(expected: DataFrame, detected: DataFrame) -> DataFrame:
    """Expected rows with the detected lists of the same query. ``detected``: query, one list per
    short entity name with the suffix _proc, all_syn."""
    return expected.join(detected.filter(F.col("query").isNotNull()).withColumnRenamed("query", "input_query"), "input_query")


def entity_mismatches(df: DataFrame) -> DataFrame:
    """Rows where any of the five expected lists differs from the detected one."""
    same = F.lit(True)
    for short in ENTITY_COLUMNS.values():
        same = same & F.col(f"{short}_gr").eqNullSafe(F.col(f"{short}_proc"))
    return df.filter(~same)


def synonym_check(df: DataFrame, literal: bool = False) -> DataFrame:
    """Whether any expected value is among the detected synonyms.

    ``literal`` keeps the form that looks for whole lists among strings, which never matches.
    """
    synonyms = F.coalesce("all_syn", empty_strings())
    expected = F.flatten(F.array(*[F.col(f"{short}_gr") for short in ENTITY_COLUMNS.values()]))
    return df.withColumn("check_syn", F.lit(False) if literal else F.arrays_overlap(expected, synonyms))


def entity_scores(df: DataFrame) -> DataFrame:
    """Common values per entity, the template's important entities, and whether the counts agree."""
    shorts = list(ENTITY_COLUMNS.values())
    scores = {
        f"{s}_score": F.size(F.array_intersect(F.coalesce(F.col(f"{s}_proc"), empty_strings()), F.col(f"{s}_gr"))) for s in shorts
    }
    important = F.array_sort(F.array_intersect("query_template", F.array(*[F.lit(e) for e in ENTITY_COLUMNS])))
    total = F.lit(0)
    for s in shorts:
        total = total + F.col(f"{s}_score")
    return df.withColumns(scores).withColumn("imp_entities", important).withColumn(
        "score_alignment", F.size("imp_entities") == total
    )


def failed_rows(scored: DataFrame) -> DataFrame:
    return scored.filter(~F.col("score_alignment"))


def brand_bands(
    brands: DataFrame, n: int = 30, more_than: int = 25, name: str = "brandname", count: str = "distinct_products"
) -> DataFrame:
    """Top, middle and least ``n`` brands by product count, stacked with their band."""
    ranked = global_positions(brands.filter(F.col(count) > more_than), [F.desc(count), F.asc(name)], "rn")
    total = ranked.agg(F.count(F.lit(1))).scalar()
    half = n // 2
    middle = F.floor(total / F.lit(2))
    bands = {
        "top": F.col("rn") <= n,
        "mid": (F.col("rn") > middle - half) & (F.col("rn") <= middle + half),
        "least": F.col("rn") > total - n,
    }
    stacked = None
    for band, keep in bands.items():
        part = ranked.filter(keep).select(name, count, F.lit(band).alias("band"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def brand_check(results: DataFrame, topk: int = 20) -> DataFrame:
    """Matching and other brand names among each query's first results; passed when none differ.

    ``results``: query, rank, brandname. At most ``topk`` rows of a query are gathered.
    """
    first = results.filter(F.col("rank") <= topk)
    matches = normal_brand(F.col("brandname")) == normal_brand(F.col("query"))
    other = F.count(F.when(~matches, 1))
    return first.groupBy("query").agg(
        F.array_sort(F.collect_set(F.when(~matches, F.col("brandname")))).alias("not_matching_brands"),
        other.alias("not_matching_count"),
        F.array_sort(F.collect_set(F.when(matches, F.col("brandname")))).alias("matching_brands"),
        F.count(F.when(matches, 1)).alias("matching_count"),
        F.lit(topk).alias("total_count"),
        (other == 0).alias("passed"),
    )
